"""Line dedup: lines that many documents share go from all of them.

Method: every document's distinct line keys become 128-bit hashes. One grouped count over the
hashes gives the distinct lines; they are dealt to shards by hash, and each shard builds a minimal
perfect hash (levels of bit arrays, a key's slot is the rank of its bit) that indexes a compact
fingerprint array and a count array. Documents then probe the arrays of the shards that own their
lines; there is no join of lines with lines.

* A shard holds a bounded number of distinct keys (``SHARD_KEYS``); the number of shards grows with
  the corpus.
* A probe task streams: a shard's arrays arrive first, its probes follow in Arrow batches, so a
  task never holds more than one shard and one batch.
* A line with more than 1/4096 of all line occurrences is hot. There are fewer than 4,096 such lines at any
  size, so their verdicts are broadcast and their probes never meet in one task; no other line can
  put more than 1/4096 of the probes into a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import (arrow_schema, extend, hash_pairs, lean, map_rows, mix, stage, texts,
                                with_fields, with_row_key)

SHARD_KEYS = 1 << 18
HOT_SHARE = 4096
GAMMA = 2.0
LEVELS = 40


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


# ---------------------------------------------------------------- minimal perfect hash of a shard

def _slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix(h1.view(np.uint64) ^ (h2.view(np.uint64) * seed) ^ seed) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Bit arrays, one a level; a key lives at the first level where it alone claims its bit.

    Keys that no level separates (at most a handful) are listed and take the last slots.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        ones = [int(bits.sum()) for bits in levels]
        self.start = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)
        self.rank = [np.cumsum(bits, dtype=np.int64) - bits for bits in levels]

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        for level in range(LEVELS):
            if not len(h1):
                break
            size = max(64, int(GAMMA * len(h1)))
            slot = _slots(h1, h2, level, size)
            claims = np.bincount(slot, minlength=size)
            levels.append((claims == 1).astype(np.uint8))
            clash = claims[slot] > 1
            h1, h2 = h1[clash], h2[clash]
        return cls(levels, np.stack([h1, h2], 1).astype(np.int64) if len(h1) else np.empty((0, 2), np.int64))

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 for a key that the hash can tell it never held."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            if not len(left):
                return out
            slot = _slots(h1[left], h2[left], level, len(bits))
            hit = bits[slot] == 1
            out[left[hit]] = self.start[level] + self.rank[level][slot[hit]]
            left = left[~hit]
        listed = {tuple(k): self.start[-1] + i for i, k in enumerate(self.rest.tolist())}
        for i in left if listed else ():
            out[i] = listed.get((int(h1[i]), int(h2[i])), -1)
        return out

    def to_row(self) -> dict:
        return {"sizes": np.array([len(b) for b in self.levels], np.int64).tobytes(),
                "bits": b"".join(np.packbits(b).tobytes() for b in self.levels), "rest": self.rest.tobytes()}

    @classmethod
    def from_row(cls, row: dict) -> PerfectHash:
        levels, at = [], 0
        for size in np.frombuffer(row["sizes"], np.int64):
            take = (int(size) + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(row["bits"], np.uint8, take, at))[:size])
            at += take
        return cls(levels, np.frombuffer(row["rest"], np.int64).reshape(-1, 2))


INDEX = T.StructType([T.StructField("shard", T.LongType()), T.StructField("sizes", T.BinaryType()),
                      T.StructField("bits", T.BinaryType()), T.StructField("rest", T.BinaryType()),
                      T.StructField("prints", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def _build_shard(table: pa.Table) -> pa.Table:
    h1, h2 = (table.column(c).to_numpy() for c in ("h1", "h2"))
    found = PerfectHash.build(h1, h2)
    slot = found.index(h1, h2)
    prints, counts = np.empty(len(h1), np.uint32), np.empty(len(h1), np.uint32)
    prints[slot] = (h2.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    counts[slot] = np.minimum(table.column("n").to_numpy(), 0xFFFFFFFF)
    row = {"shard": table.column("shard")[0].as_py(), **found.to_row(),
           "prints": prints.tobytes(), "counts": counts.tobytes()}
    return pa.Table.from_pylist([row], schema=arrow_schema(INDEX))


class Shard:
    def __init__(self, row: dict):
        self.hash = PerfectHash.from_row(row)
        self.prints, self.counts = (np.frombuffer(row[c], np.uint32) for c in ("prints", "counts"))

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Documents that hold each line; 0 where the fingerprint says the line is another one."""
        slot = self.hash.index(h1, h2)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == (h2[known].view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        out = np.zeros(len(h1), np.int64)
        out[known] = self.counts[slot[known]]
        return out


# ---------------------------------------------------------------- the operator

def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, h1, h2): one row for each distinct line key of a document row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])

    def emit(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        keys: list[bytes] = []
        owner = np.empty(batch.num_rows, np.int64)
        for i, text in enumerate(texts(batch.column(text_col))):
            own = {line_key(line) for line in text.split(b"\n")}
            own = {k for k in own if k} if min_chars == 1 else {k for k in own if code_points(k) >= min_chars}
            owner[i] = len(own)
            keys += own
        pairs = hash_pairs(keys)
        ids = batch.column(id_col).take(pa.array(np.repeat(np.arange(batch.num_rows), owner)))
        return pa.RecordBatch.from_arrays([ids, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=out)

    return map_rows(docs.select(id_col, text_col), schema, emit)


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: its perfect hash, fingerprints and counts."""
    return (counts.withColumn("shard", _shard("h1", shards)).groupBy("shard")
            .applyInArrow(_build_shard, INDEX))


def _shard(column: str, shards: int):
    return F.pmod(F.shiftrightunsigned(F.col(column), 17), F.lit(shards)).cast("long")


def probe(index: DataFrame, lines: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """The (id, h1, h2) of ``lines`` whose count in the index is at least ``min_docs``."""
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in INDEX.fields[1:]]
    both = (index.select("shard", F.lit(0).alias("kind"), *[f.name for f in INDEX.fields[1:]],
                         F.lit(None).cast(lines.schema["id"].dataType).alias("id"),
                         F.lit(None).cast("long").alias("h1"), F.lit(None).cast("long").alias("h2"))
            .unionByName(lines.select(_shard("h1", shards).alias("shard"), F.lit(1).alias("kind"), *blank,
                                      "id", "h1", "h2")))
    dealt = both.repartition("shard").sortWithinPartitions("shard", "kind")
    schema = T.StructType([lines.schema[c] for c in ("id", "h1", "h2")])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for batch in batches:
            kind, owner = (batch.column(c).to_numpy() for c in ("kind", "shard"))
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(owner) != 0) | (np.diff(kind) != 0)) + 1, [len(kind)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if kind[a] == 0 and b > a:
                    shard, at = Shard(part.to_pylist()[0]), owner[a]
                elif b > a and at == owner[a]:
                    h1, h2 = (part.column(c).to_numpy() for c in ("h1", "h2"))
                    drop = pa.array(shard.count(h1, h2) >= min_docs)
                    yield pa.RecordBatch.from_arrays([part.column(c).filter(drop) for c in ("id", "h1", "h2")], schema=out)

    return dealt.mapInArrow(lean(run), schema)


def common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(id, h1 array, h2 array): the hashes of each document's lines that at least ``min_docs`` rows hold."""
    lines = stage(line_table(docs, id_col, text_col, min_chars), "lines")
    counts = stage(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")), "line_counts")
    size = counts.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    shards = max(1, -(-size["keys"] // SHARD_KEYS))
    index = stage(build_index(counts, shards), "line_index")
    hot = F.broadcast(counts.where(F.col("n") * HOT_SHARE > size["rows"])  # fewer than HOT_SHARE rows: their shares sum to 1
                      .select("h1", "h2", "n"))
    told = lines.join(hot.where(F.col("n") >= min_docs).drop("n"), ["h1", "h2"])
    probed = probe(index, lines.join(hot.drop("n"), ["h1", "h2"], "left_anti"), shards, min_docs)
    return (told.select("id", "h1", "h2").unionByName(probed).groupBy("id")
            .agg(F.collect_list("h1").alias("h1"), F.collect_list("h2").alias("h2")))


def dedup_lines(docs: DataFrame, text_col: str = "text",
                min_docs: int = 10, min_chars: int = 1, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or some of its ``columns``) with the lines that at least ``min_docs`` documents hold dropped from ``text_col``.

    Adds ``n_lines`` (before dropping) and ``n_dropped``, replacing columns of these names.
    Each row is a document. A null or empty text is one empty line and comes back empty; lines with
    keys under ``min_chars`` code points always stay; a line repeated within a document counts once
    there, and all its copies go. A null or repeated id is allowed: whether a line goes depends on
    the line alone, and rows are told apart by a key of their own. Very long texts are cut whole;
    other columns come back as they are. An empty table gives an empty table.
    """
    keyed = with_row_key(docs, "__line_row")
    if columns:
        keyed, docs = keyed.select(*columns, "__line_row"), docs.select(*columns)
    verdict = common_lines(keyed, "__line_row", text_col, min_docs, min_chars)
    verdict = verdict.select(F.col("id").alias("__line_row"), F.col("h1").alias("__line_h1"), F.col("h2").alias("__line_h2"))
    joined = keyed.join(verdict, "__line_row", "left").drop("__line_row")
    schema = with_fields(docs, (text_col, T.StringType()), ("n_lines", T.LongType()), ("n_dropped", T.LongType()))

    def cut(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        kept, total, dropped = [], [], []
        h1s, h2s = batch.column("__line_h1"), batch.column("__line_h2")
        for i, text in enumerate(texts(batch.column(text_col))):
            lines = text.split(b"\n")
            total.append(len(lines))
            if h1s[i].is_valid:
                gone = set(zip(h1s[i].as_py(), h2s[i].as_py(), strict=True))
                pairs = hash_pairs(line_key(line) for line in lines).tolist()
                left = [line for line, p in zip(lines, pairs, strict=True)
                        if tuple(p) not in gone or code_points(line_key(line)) < min_chars]
            else:
                left = lines
            dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left))
        return extend(batch, out, **{text_col: pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": total, "n_dropped": dropped})

    return map_rows(joined, schema, cut)


def line_report(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    kept = dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, columns=["doc_id", "text"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
