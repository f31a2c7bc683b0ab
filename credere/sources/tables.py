"""Driver tables and the deterministic dirty ``raw`` view of ``lineitem``.

The driver's parquet tables carry no NULLs, so the raw view adds dirt by key
arithmetic: the literal ``NA`` sentinel, NULLs and zeros, in the places the
loan file has them. Every value is text, as in the delimited source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


SCAN_PARTITIONS = "spark.credere.scanPartitions"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def balanced(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows dealt to ``partitions`` tasks: for a file of one row group, which one task reads.

    Without the argument, the session setting ``spark.credere.scanPartitions`` decides; without
    either the scan stays as it is, which is right for any table of many files.
    """
    n = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n) if n else df


def evenly_read(scan: DataFrame, slack: float = 1.3) -> bool:
    """Whether the scan's own partitions keep all cores busy: the longest-first schedule of their rows takes at most ``slack``
    times an even share. A Parquet file's row group is read by one task, whatever the number of splits; only footers are read here."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    rows = [r["count"] for r in scan.groupBy(F.spark_partition_id().alias("p")).count().orderBy(F.desc("count")).limit(64 * cores).collect()]
    load = [0] * cores
    for n in rows:
        load[load.index(min(load))] += n
    return max(load) * cores <= slack * sum(load)


def _text(c):
    return c.cast("bigint").cast("string")


def dirty_lineitem_columns(li: DataFrame) -> DataFrame:
    """All-text lineitem with dirt keyed on ``l_orderkey`` (works on streams too)."""
    k = F.col("l_orderkey")
    null = F.lit(None).cast("string")
    return li.select(
        F.year("l_shipdate").cast("string").alias("l_shipyear"),
        _text(k).alias("l_orderkey"),
        F.when(k % 17 == 0, F.lit("NA")).otherwise(F.col("l_linenumber").cast("string")).alias("l_linenumber"),
        F.when(k % 19 == 0, null).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        F.when(k % 23 == 0, null).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.when(k % 29 == 0, F.lit("NA")).otherwise(_text(F.col("l_suppkey"))).alias("l_suppkey"),
        _text(F.col("l_partkey")).alias("l_partkey"),
        F.when(k % 11 == 0, F.lit("NA")).when(k % 13 == 0, null)
         .otherwise(_text(F.floor("l_quantity"))).alias("l_quantity"),
        F.when(k % 7 == 0, null).otherwise(_text(F.floor("l_extendedprice"))).alias("l_extendedprice"),
        _text(F.round(F.col("l_discount") * 100)).alias("l_discount"),
        F.when(k % 31 == 0, null).otherwise(_text(F.round(F.col("l_tax") * 100))).alias("l_tax"),
    )


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_lineitem_columns(table(spark, sf_dir, "lineitem"))


# DuckDB twin of raw_lineitem(), used by the oracle queries.
RAW_LINEITEM_SQL = """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS l_shipyear,
       CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       CASE WHEN l_orderkey % 17 = 0 THEN 'NA' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
       CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_orderkey % 29 = 0 THEN 'NA' ELSE CAST(l_suppkey AS VARCHAR) END AS l_suppkey,
       CAST(l_partkey AS VARCHAR) AS l_partkey,
       CASE WHEN l_orderkey % 11 = 0 THEN 'NA' WHEN l_orderkey % 13 = 0 THEN NULL
            ELSE CAST(CAST(FLOOR(l_quantity) AS BIGINT) AS VARCHAR) END AS l_quantity,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL
            ELSE CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS VARCHAR) END AS l_extendedprice,
       CAST(CAST(ROUND(l_discount * 100) AS BIGINT) AS VARCHAR) AS l_discount,
       CASE WHEN l_orderkey % 31 = 0 THEN NULL
            ELSE CAST(CAST(ROUND(l_tax * 100) AS BIGINT) AS VARCHAR) END AS l_tax
FROM lineitem
"""
