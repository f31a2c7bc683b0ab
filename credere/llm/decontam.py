"""Benchmark decontamination: passages of test items are found in training documents and cut out.

Method: each task packs its documents into shards and builds an FM-index over each shard's words -
suffix order, Burrows-Wheeler transform, a wavelet matrix for rank queries and suffix positions
sampled at every eighth word. All test windows are searched backwards through the index at once,
occurrences are located by walking to a sampled position, and overlapping occurrences become
removal spans.

* Documents never move: the index lives in the task that reads them, so there is no shuffle and a
  lost executor costs its own shards.
* Test items are taken in blocks of bounded size (``BLOCK_WORDS``). A block is broadcast;
  further blocks are further passes over the same rows, with the rows written to the shared folder in between.
* A word that occurs in no window of the block breaks every occurrence, so the indexed text is the
  runs of known words that are long enough to hold a window. A run of any length is indexed in
  pieces that overlap by one word less than the longest window, which bounds a shard's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import extend, map_rows, stage, texts, with_fields

WINDOW = 10
BLOCK_WORDS = 1 << 20
SHARD_WORDS = 1 << 18
SAMPLE = 8
BLOCK_BYTES = 8 << 20

# words are runs of [0-9a-z] and non-ASCII after lower-casing A-Z; all other ASCII separates them
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                  for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def word_spans(text: bytes) -> list[tuple[int, int]]:
    """(start, end) byte offsets of the words."""
    inside = np.concatenate([[0], np.frombuffer(text.translate(_TO_WORDS), np.uint8) != 0x20, [0]]).astype(np.int8)
    edges = np.diff(inside)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


# ---------------------------------------------------------------- FM-index

class WaveletMatrix:
    """Rank and access over a sequence of symbols, one bit array a level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.depth = len(symbols), max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros, self.bits = [], [], []
        for level in range(self.depth - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(np.uint8)
            self.bits.append(bit)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        a, b = np.zeros_like(end), end
        for i in range(self.depth):
            one = (symbol >> (self.depth - 1 - i)) & 1 == 1
            ra, rb = self.ones[i][a], self.ones[i][b]
            a, b = np.where(one, self.zeros[i] + ra, a - ra), np.where(one, self.zeros[i] + rb, b - rb)
        return b - a

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, its rank before the place) at each place."""
        symbol, first = np.zeros_like(at), np.zeros_like(at)
        for i in range(self.depth):
            bit = self.bits[i][at].astype(at.dtype)
            symbol = symbol << 1 | bit
            ra, rf = self.ones[i][at], self.ones[i][first]
            at = np.where(bit == 1, self.zeros[i] + ra, at - ra)
            first = np.where(bit == 1, self.zeros[i] + rf, first - rf)
        return symbol, at - first


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling. A 0 ends a run: each 0 is its own symbol, smaller than all words."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + n)
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = fresh
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Count and locate word sequences in a text of words (1..sigma-1) whose runs each end in a 0."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_order(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.ranks = WaveletMatrix(before.astype(np.int64), sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))]).astype(np.int64)
        # sampled: every SAMPLE-th position, and where a run begins (nothing is walked past a 0)
        keep = (order % SAMPLE == 0) | (before == 0)
        self.sampled = np.where(keep, order, -1)

    def search(self, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each window (rows of ``windows``)."""
        last = windows[:, length - 1]
        lo, hi = self.first[last].copy(), self.first[last + 1].copy()
        live = np.flatnonzero(lo < hi)
        for i in range(length - 2, -1, -1):
            if not len(live):
                break
            symbol = windows[live, i]
            lo[live] = self.first[symbol] + self.ranks.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.ranks.rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row's suffix."""
        out, rows, left = np.empty(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        steps = 0
        while len(left):
            at = self.sampled[rows[left]]
            done = at >= 0
            out[left[done]] = at[done] + steps
            left = left[~done]
            symbol, rank = self.ranks.access(rows[left])
            rows[left] = self.first[symbol] + rank
            steps += 1
        return out


# ---------------------------------------------------------------- test windows

@dataclass
class Block:
    """Distinct windows of a bounded number of test items, as symbols 1..sigma-1."""

    symbol: dict[bytes, int]
    windows: dict[int, np.ndarray]   # by length: (windows, length)
    owners: dict[int, list[list]]    # by length: the item ids of each window

    @classmethod
    def of(cls, items: list[tuple], window: int) -> Block:
        symbol: dict[bytes, int] = {}
        found: dict[int, dict[tuple, list]] = {}
        for item, text in items:
            ids = [symbol.setdefault(w, len(symbol) + 1) for w in words_of(text)]
            if ids:
                size = min(window, len(ids))
                for i in range(len(ids) - size + 1):
                    found.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), []).append(item)
        return cls(symbol, {n: np.array(list(w), np.int64) for n, w in found.items()},
                   {n: [list(dict.fromkeys(o)) for o in w.values()] for n, w in found.items()})


def benchmark_blocks(bench: DataFrame, window: int) -> Iterator[tuple[Block, bool]]:
    """The test items in blocks of at most about ``BLOCK_WORDS`` words, and whether a block is the last;
    only one block is on the driver at a time."""
    items = bench.select(F.col("item_id").alias("item"), "text").where("text is not null")
    size = F.length("text") + 1  # at least two code points to a word and its separator
    sized = items.withColumn("chars", size)
    total = sized.agg(F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first()["chars"]
    parts = max(1, -(-int(total) // (2 * BLOCK_WORDS)))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).distinct()
        rows = sorted(((r["item"], r["text"]) for r in own.toLocalIterator()), key=lambda r: (str(r[0]), r[1]))
        yield Block.of([(i, t.encode()) for i, t in rows], window), part == parts - 1


class Shards:
    """Runs of known words, packed into shards of bounded size and searched shard by shard."""

    def __init__(self, block: Block):
        self.block = block
        self.sigma = len(block.symbol) + 1
        self.least, self.most = min(block.windows), max(block.windows)
        self.reset()

    def reset(self) -> None:
        self.pieces, self.places, self.size = [], [], 0

    def add(self, doc: int, words: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        ids = np.fromiter(map(self.block.symbol.get, words, [0] * len(words)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            for at in range(a, b, SHARD_WORDS):
                end = min(b, at + SHARD_WORDS + self.most - 1)
                self.pieces.append(ids[at:end])
                self.places.append((doc, at))
                self.size += end - at + 1
                if self.size >= SHARD_WORDS:
                    yield from self.search()
                if end == b:
                    break

    def search(self) -> Iterator[tuple[int, int, int, int]]:
        """(document, first word, words, window number within its length) of every occurrence."""
        if not self.pieces:
            return
        starts = np.cumsum([0] + [len(p) + 1 for p in self.pieces])
        text = np.zeros(starts[-1], np.int64)
        for at, p in zip(starts, self.pieces, strict=False):
            text[at:at + len(p)] = p
        index = FmIndex(text, self.sigma)
        for length, windows in self.block.windows.items():
            lo, hi = index.search(windows, length)
            count = hi - lo
            which = np.repeat(np.arange(len(windows)), count)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
            at = index.locate(rows)
            piece = np.searchsorted(starts, at, "right") - 1
            for w, p, word in zip(which.tolist(), piece.tolist(), (at - starts[piece]).tolist(), strict=True):
                doc, first = self.places[p]
                yield doc, first + word, length, w
        self.reset()


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_leaks(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text", cut: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (merged [start, end) word ranges) and ``hit_items``
    (item ids as strings, sorted), replacing columns of these names.

    Null and empty texts have no words; null items and items without words match nothing; an item
    of fewer words than ``window`` is one window. Repeated rows and ids are searched like any other.
    Items with equal ids are one item. An empty benchmark leaves every document without hits. With
    ``cut`` the text comes back without its hit words.
    """
    schema = with_fields(docs, ("n_words", T.LongType()), ("hit_spans", SPANS), ("hit_items", T.ArrayType(T.StringType())))
    out_schema = schema
    sc = docs.sparkSession.sparkContext
    out = docs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in docs.columns])
    out = out.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("n_words", "hit_spans", "hit_items") else F.col(f"`{f.name}`")
                       for f in schema.fields])
    for i, (block, last) in enumerate(benchmark_blocks(bench, window)):
        if i:
            out = stage(out, "leaks")
        shared = sc.broadcast(block)

        def run(batch: pa.RecordBatch, form: pa.Schema, shared=shared, cuts=cut and last) -> pa.RecordBatch:
            block = shared.value
            raw = texts(batch.column(text_col))
            n_words = []
            spans = [[(s["start"], s["end"]) for s in x or ()] for x in batch.column("hit_spans").to_pylist()]
            items = [set(x or ()) for x in batch.column("hit_items").to_pylist()]

            def take(found):
                for doc, start, length, w in found:
                    spans[doc].append((start, start + length))
                    items[doc].update(map(str, block.owners[length][w]))

            shards = Shards(block) if block.windows else None
            for doc, text in enumerate(raw):
                words = words_of(text)
                n_words.append(len(words))
                if shards:
                    take(shards.add(doc, words))
            if shards:
                take(shards.search())
            spans = [merged(s) for s in spans]
            changed = {}
            if cuts:
                whole = batch.column(text_col).cast(pa.binary()).to_pylist()
                changed[text_col] = pa.array([without(t, s) if s else t for t, s in zip(whole, spans, strict=True)], pa.binary()).cast(pa.string())
            return extend(batch, form, n_words=n_words, hit_items=[sorted(x) for x in items],
                          hit_spans=[[{"start": a, "end": b} for a, b in s] for s in spans], **changed)

        out = map_rows(out, out_schema, run, text_col, BLOCK_BYTES)
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of its spans, each from its first word's start to its last one's end."""
    at = word_spans(text)
    keep, done = [], 0
    for a, b in spans:
        keep.append(text[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*keep, text[done:]])


def remove_leaks(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words cut out of ``text_col``: from the first hit word of a span to the
    end of its last. Texts without hits come back as they are (a null text too)."""
    return find_leaks(docs, bench, window, text_col, cut=True).select(*[F.col(f"`{c}`") for c in docs.columns])


def leak_report(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = find_leaks(docs.select("doc_id", "text"), bench, window)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
