"""Helpers shared by the corpus operators: texts as UTF-8 bytes, staged tables, row-wise Arrow maps.

Texts cross into Python tasks as Arrow buffers and are handled as UTF-8 ``bytes``: ``bytes.lower``
changes A-Z only, and ``bytes.split``/``bytes.strip`` without arguments act on exactly
``[\\x20\\x09-\\x0D]``, which is what the operators mean by case and white space.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.session import scratch_path, ship_package


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each value, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def extend(batch: pa.RecordBatch, schema: pa.Schema, **columns: Iterable) -> pa.RecordBatch:
    """The batch with some columns replaced or added, laid out as ``schema``."""
    out = []
    for field in schema:
        if field.name in columns:
            values = columns[field.name]
            out.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
        else:
            out.append(batch.column(field.name))
    return pa.RecordBatch.from_arrays(out, schema=schema)


def with_fields(df: DataFrame, *added: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` with columns replaced in place or added at the end."""
    types = dict(added)
    fields = [T.StructField(f.name, types.pop(f.name)) if f.name in types else T.StructField(f.name, f.dataType)
              for f in df.schema.fields]
    return T.StructType(fields + [T.StructField(n, t) for n, t in types.items()])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def blocks_of(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most about ``most`` bytes in a text column (a longer text alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Return freed memory to the system: a worker that ends a task may wait beside a JVM that needs it, or serve another operator."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task that gives its memory back when it ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def map_rows(df: DataFrame, schema: T.StructType, fn: Callable[[pa.RecordBatch, pa.Schema], pa.RecordBatch],
             text_col: str | None = None, most: int = 4 << 20, rows: int | None = None) -> DataFrame:
    """``fn`` over each Arrow batch, or over blocks of ``most`` bytes in ``text_col``, of ``rows`` rows at most; the rows stay in their partitions."""
    ship_package(df.sparkSession)
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for block in blocks_of(batch, text_col, most) if text_col else (batch,):
                    step = rows or block.num_rows
                    for i in range(0, block.num_rows, step):
                        yield fn(block.slice(i, step), out)

    return df.mapInArrow(lean(run), schema)


def hash_pairs(items: Iterable[bytes]) -> np.ndarray:
    """128-bit hashes as an (n, 2) int64 array."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, items)), dtype=">i8").astype(np.int64).reshape(-1, 2)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash a word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def ngram_hashes(words: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (empty if there are fewer)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = out * np.uint64(base) + words[i:i + size]
    return mix(out)


def same(left: DataFrame, right: DataFrame, *names: str):
    """Null-safe equality of columns that both sides have."""
    cond = F.lit(True)
    for i, n in enumerate(names):
        one = left[n].eqNullSafe(right[n])
        cond = one if i == 0 else cond & one
    return cond


def hot_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, share: int = 4096) -> DataFrame:
    """``rows`` left-joined with a table of one row a key, where one key may hold most of the rows.

    Keys with more than 1/``share`` of the table's ``weight`` (fewer than ``share`` at any size) are
    broadcast and meet their rows where these are; all other keys go through a shuffle join. Keys are not null.
    """
    table = stage(table, "join_table")
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = F.broadcast(table.where(F.col(weight) * share > total))
    told = rows.join(hot, keys)
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(table.where(F.col(weight) * share <= total), keys, "left")
    return told.unionByName(rest)


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``, a key of its own for every row, the same each time the rows are read.

    Rows of files are told apart by file and place in it; the rows of any other table are written first.
    """
    try:
        return df.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")))
    except AnalysisException:
        return with_row_key(stage(df, "rows"), name)
