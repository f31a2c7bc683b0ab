"""Training rows as blocks of arrays.

An iterative fit passes over its rows a hundred times and more. Rows of a cached frame are decoded one vector object a
row on every pass; blocks are a few arrays for tens of thousands of rows, stay serialised in memory or on disk
(MEMORY_AND_DISK: lost ones are recomputed from lineage), and a pass works on whole arrays. A task holds one block at a
time, so memory doesn't grow with the table. Everything that leaves a task is a sum whose size the model bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK_ROWS = 1 << 16
STORED = StorageLevel.MEMORY_AND_DISK


def _packed(batches):
    """Arrow batches of (y, x) to rows of two byte strings, BLOCK_ROWS rows or a little more in each."""
    ys, xs, rows = [], [], 0

    def out():
        return pa.RecordBatch.from_pydict({"y": pa.array([np.concatenate(ys).tobytes()], pa.binary()), "x": pa.array([np.concatenate(xs).tobytes()], pa.binary())})

    for b in batches:
        if not b.num_rows:
            continue
        if b.column(0).null_count or b.column(1).null_count:
            raise ValueError("labels and features must not be NULL")
        y, x = b.column(0).to_numpy(), b.column(1).flatten().to_numpy()
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("labels must be 0 or 1")
        if not np.isfinite(x).all():
            raise ValueError("features must not be NaN or infinite")
        ys.append(y)
        xs.append(x)
        rows += len(y)
        if rows >= BLOCK_ROWS:
            yield out()
            ys, xs, rows = [], [], 0
    if rows:
        yield out()


def _unpacked(row):
    y = np.frombuffer(row[0])
    return y, np.frombuffer(row[1]).reshape(len(y), -1)


def blocks(df: DataFrame, features: str, label: str) -> RDD:
    """(labels, features) arrays of ``df``'s rows, not yet stored. Up to 16 of the frame's partitions are put together, to one
    a core or a multiple: a pass costs every task a tenth of a second and its sums."""
    ship_package(df.sparkSession)
    rows = df.select(F.col(label).cast("double").alias("y"), vector_to_array(F.col(features)).alias("x"))
    packed = rows.mapInArrow(_packed, "y binary, x binary").rdd
    cores = df.sparkSession.sparkContext.defaultParallelism
    return packed.coalesce(cores * max(1, -(-packed.getNumPartitions() // (16 * cores)))).map(_unpacked)


def slots(df: DataFrame, features: str) -> tuple[int, dict[int, int]]:
    """(width of the vector, categories of its nominal slots) by the column's metadata; without metadata by a row."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    arity = {a["idx"]: 2 for a in attrs.get("binary", [])}
    arity |= {a["idx"]: a["num_vals"] if "num_vals" in a else len(a["vals"]) for a in attrs.get("nominal", []) if "num_vals" in a or "vals" in a}
    width = meta.get("num_attrs") or sum(len(a) for a in attrs.values())
    if not width:
        first = df.select(features).first()
        if first is None:
            raise ValueError("no rows to fit")
        width = len(first[0])
    return width, {i: n for i, n in arity.items() if n > 1}
