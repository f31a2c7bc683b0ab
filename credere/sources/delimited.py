"""Delimited text, raw lines, Parquet and literal-row sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
                   sep: str = "|", header: bool = True) -> DataFrame:
    """Header + separator, every column text, nothing inferred.

    With ``columns`` the schema is declared up front (no header job, and the
    CSV reader prunes unread columns); otherwise names come from the header.
    """
    reader = spark.read.options(header=str(header).lower(), sep=sep, mode="PERMISSIVE")
    if columns is not None:
        reader = reader.schema(all_string_schema(columns))
    return reader.csv(path)


BAD_LINE = "_bad_line"


def read_checked(spark: SparkSession, path: str, columns: Iterable[str], sep: str = "|", header: bool = True) -> DataFrame:
    """S1 with a quarantine: the declared columns as text, and ``_bad_line`` with the whole line where it has too
    few or too many fields (NULL for a good one). With a header, a file whose names or order differ from
    ``columns`` is an error instead of a table with swapped columns. Lines are parsed whole, whichever columns are read;
    Spark refuses queries that read ``_bad_line`` alone (a bare count of bad lines), so read a column beside it."""
    fields = [*all_string_schema(columns).fields, T.StructField(BAD_LINE, T.StringType())]
    return (spark.read.schema(T.StructType(fields)).options(
        header=str(header).lower(), sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, enforceSchema=str(not header).lower(),
        columnPruning="false").csv(path))  # a pruned parse would not see all fields


def rejects(checked: DataFrame, sep: str = "|") -> DataFrame:
    """(kind, line, the columns as far as they were read) of the lines of :func:`read_checked` that do not fit: ``short`` or ``long``."""
    n = len(checked.columns) - 1
    seen = F.size(F.split(F.col(BAD_LINE), f"\\Q{sep}\\E", -1))
    return checked.filter(F.col(BAD_LINE).isNotNull()).select(F.when(seen < n, "short").otherwise("long").alias("kind"), F.col(BAD_LINE).alias("line"), *[c for c in checked.columns if c != BAD_LINE])


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True) -> str:
    """Write text with a header per part file; NULL is written as an empty field."""
    df.write.mode("overwrite").options(header=str(header).lower(), sep=sep).csv(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def data_lines(spark: SparkSession, path: str, header_line: str) -> DataFrame:
    """S2 without the header line each part file starts with."""
    return read_lines(spark, path).filter(F.col("value") != F.lit(header_line))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite; optional partition columns for later pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def stage_table(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under a shared folder and read it back (cuts lineage).

    Later passes scan the written table instead of recomputing the plan, and
    a lost executor only costs re-reading files. With ``files`` the rows are
    dealt to so many files first; by default they stay as they are partitioned.
    """
    if files:
        df = df.repartition(files)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_frame(spark: SparkSession, rows: list[dict | Row], schema: T.StructType) -> DataFrame:
    """Literal rows validated against an explicit schema (form input)."""
    fixed = [r if isinstance(r, Row) else Row(**{f.name: r.get(f.name) for f in schema.fields})
             for r in rows]
    return spark.createDataFrame(fixed, schema=schema)
