"""Substring dedup: words in passages that an earlier document already holds are removed.

Method: seed and extend. The seed of a window of 13 words is its smallest 5-gram hash (winnowing:
windows that overlap mostly share a seed, and equal windows have equal seeds). Occurrences of a
seed meet by its hash with the extensions of all their windows, so each occurrence extends to both
sides as far as an earlier document agrees; neighbouring matches join into maximal repeats of at
least 13 words, which are cut from the later document.

* One row a seed occurrence is shuffled (about one for five words), sorted by seed and document. The task streams
  over Arrow batches and keeps one seed's windows at a time.
* Copies meet in the task that reads them: of equal rows only the smallest document's travel.
* A seed that more than 1/8192 of the rows still share (the edges of a passage that many documents
  hold, or a few words over and over) is dealt by window instead of by seed, once for each document
  and window; fewer than 8,192 such seeds exist at any size, and only they are broadcast.
* Rows without an id are told apart by a hash of their text, so that none is handed the repeats of all
  others; rows of equal text share their repeats, each once.
* Texts are packed before the one join that brings the repeats home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, extend, map_rows, mix, ngram_hashes, ship_package, stage, texts, with_fields, word_hashes

WINDOW = 13
SEED = 5
BLOCK_WORDS = 1 << 20
HOT_SHARE = 8192
PRINT = 5  # bytes of a window's hash that travel with its seed
LAST = (1 << 63) - 1
MARK = 32  # a row's mark sits above this bit of the places in its text

SEEDS = T.StructType([T.StructField("seed", T.LongType()), T.StructField("sub", T.IntegerType()),
                      T.StructField("id", T.LongType()), T.StructField("start", T.LongType()),
                      T.StructField("prints", T.BinaryType())])
REPEATS = T.StructType([T.StructField("id", T.LongType()), T.StructField("start", T.LongType()),
                        T.StructField("n", T.LongType()), T.StructField("check", T.LongType())])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return out if have == width else np.minimum(out[:len(out) - (width - have)], out[width - have:])


def prints_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - 8 * PRINT)


class Windows:
    """Windows of a block of documents, in runs of neighbours that share a seed."""

    def __init__(self, ids: np.ndarray, words: list[list[bytes]], window: int, seed: int, marks: np.ndarray | None = None):
        size = np.array([len(w) for w in words], np.int64)
        flat = word_hashes([x for w in words for x in w])
        ends = np.cumsum(size)
        self.first = ends - size
        n = len(flat) - window + 1
        if n <= 0:
            at = np.empty(0, np.int64)
            self.hash, smallest, owner = np.empty(0, np.uint64), np.empty(0, np.uint64), at
        else:
            owner = np.repeat(np.arange(len(size)), size)[:n]
            at = np.flatnonzero(np.arange(n) + window <= ends[owner])
            self.hash = ngram_hashes(flat, window, 0xC2B2AE3D27D4EB4F)[at]
            smallest = sliding_min(ngram_hashes(flat, seed), window - seed + 1)[at]
            owner = owner[at]
        begins = np.ones(len(at), bool)
        begins[1:] = (np.diff(at) != 1) | (smallest[1:] != smallest[:-1])
        self.run = np.flatnonzero(begins)                      # first window of each run
        self.size = np.diff(np.append(self.run, len(at)))      # windows of each run
        self.seed = mix(smallest[self.run]).view(np.int64)
        doc = owner[self.run]
        self.id = ids[doc]
        self.mark = np.zeros(len(doc), np.int64) if marks is None else marks[doc] << MARK
        self.start = at[self.run] - self.first[doc]

    def split_local(self) -> tuple[np.ndarray, np.ndarray]:
        """(runs to send, runs that an equal run of a smaller document of this block settles)."""
        if not len(self.run):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.arange(len(self.hash)) - np.repeat(self.run, self.size)
        whole = np.add.reduceat(mix(self.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), self.run)
        whole = mix(whole ^ self.seed.view(np.uint64))
        order = np.lexsort((self.id, whole))
        new = np.ones(len(order), bool)
        new[1:] = whole[order][1:] != whole[order][:-1]
        least = self.id[order][new][np.cumsum(new) - 1]
        later = self.id[order] > least
        return np.sort(order[~later]), order[later]


def _expand(runs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all windows of the runs, run after run."""
    return np.repeat(runs, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[list[bytes]]]]:
    ids, marks = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "mark"))
    raw = texts(batch.column("text"))
    first, words, size = 0, [], 0
    for i, text in enumerate(raw):
        words.append(text.split())
        size += len(words[-1])
        if size >= BLOCK_WORDS or i == len(raw) - 1:
            yield ids[first:i + 1], marks[first:i + 1], words
            first, words, size = i + 1, [], 0


def _binary(data: np.ndarray, widths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(widths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def seed_rows(docs: DataFrame, hot: np.ndarray, window: int, seed: int) -> DataFrame:
    """Rows of SEEDS. A settled run has sub -1 and carries (check, windows) instead of prints."""
    out = arrow_schema(SEEDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, marks, words in _blocks(batch):
                w = Windows(ids, words, window, seed, marks)
                send, settled = w.split_local()
                is_hot = np.isin(w.seed[send], hot)
                cold, warm = send[~is_hot], send[is_hot]
                raw = w.hash.view(np.uint8).reshape(-1, 8)
                # cold: one row a run
                own = _expand(w.run[cold], w.size[cold])
                parts = [(w.seed[cold], np.zeros(len(cold)), w.id[cold], w.mark[cold] + w.start[cold],
                          _binary(raw[own, 8 - PRINT:], PRINT * w.size[cold]))]
                # hot: one row a window of the smallest document that holds it here; the rest of its hash picks the task
                own = _expand(w.run[warm], w.size[warm])
                doc, mark, full = np.repeat(w.id[warm], w.size[warm]), np.repeat(w.mark[warm], w.size[warm]), w.hash[own]
                order = np.lexsort((mark, doc, full))
                doc, mark, full = doc[order], mark[order], full[order]
                new, once = np.ones(len(order), bool), np.ones(len(order), bool)
                new[1:] = full[1:] != full[:-1]
                once[1:] = new[1:] | (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
                least = doc[new][np.cumsum(new) - 1]
                here, later = once & (doc == least), once & (doc > least)
                raw = full[here].view(np.uint8).reshape(-1, 8)
                parts.append((np.repeat(w.seed[warm], w.size[warm])[order][here], (full[here] & np.uint64(0xFFFFFF)).astype(np.int64) + 1, doc[here],
                              mark[here], _binary(raw[:, 8 - PRINT:], np.full(int(here.sum()), PRINT))))
                told = np.stack([prints_of(full[later]).astype(np.int64), np.zeros(int(later.sum()), np.int64)], 1)
                parts.append((mix(full[later] ^ doc[later].view(np.uint64)).view(np.int64), np.full(len(told), -1), doc[later], mark[later],
                              _binary(told.view(np.uint8).reshape(-1), np.full(len(told), 16))))
                if len(settled):
                    check = np.add.reduceat(prints_of(w.hash[_expand(w.run[settled], w.size[settled])]), np.cumsum(w.size[settled]) - w.size[settled])
                    told = np.stack([check.astype(np.int64), w.size[settled].astype(np.int64)], 1)
                    key = mix((w.id[settled] + 1).view(np.uint64) * np.uint64(31) + w.start[settled].astype(np.uint64)).view(np.int64)
                    parts.append((key, np.full(len(settled), -1), w.id[settled], w.mark[settled] + w.start[settled], _binary(told.view(np.uint8).reshape(-1), np.full(len(settled), 16))))
                for s, sub, i, start, prints in parts:
                    yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(sub.astype(np.int32)), pa.array(i), pa.array(start.astype(np.int64)), prints], schema=out)

    return docs.mapInArrow(run, SEEDS)


def hot_seeds(docs: DataFrame, window: int, seed: int) -> np.ndarray:
    """Seeds that more than about 1/HOT_SHARE of the travelling rows share: fewer than HOT_SHARE."""
    schema = T.StructType([T.StructField("seed", T.LongType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, marks, words in _blocks(batch):
                w = Windows(ids, words, window, seed, marks)
                seeds, n = np.unique(w.seed[w.split_local()[0]], return_counts=True)
                total = int(n.sum())
                often = n * HOT_SHARE > max(total, HOT_SHARE)  # at least two
                seeds, n = seeds[often], n[often]
                yield pa.RecordBatch.from_arrays([pa.array([*seeds.tolist(), None], pa.int64()), pa.array([*n.tolist(), 0], pa.int64()),
                                                  pa.array([0] * len(seeds) + [total], pa.int64())], schema=out)

    sums = stage(docs.mapInArrow(run, schema).groupBy("seed").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "seed_counts")
    total = sums.where("seed is null").select("total").first()
    if not total:
        return np.empty(0, np.int64)
    rows = sums.where(F.col("seed").isNotNull() & (F.col("n") * HOT_SHARE > max(total[0], 64 * HOT_SHARE))).select("seed").collect()
    return np.array([r[0] for r in rows], np.int64)


class Repeats:
    """Windows of a stream of seed rows, ordered by seed and document, that an earlier document holds."""

    def __init__(self):
        self.group, self.prints, self.ids = None, np.empty(0, np.uint64), np.empty(0, np.int64)

    def take(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """(id, start, n, check) of the repeats in a batch."""
        seed, sub, ids = (batch.column(c).to_numpy() for c in ("seed", "sub", "id"))
        start = batch.column("start").to_numpy().astype(np.int64)
        column = batch.column("prints")
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        settled = sub < 0
        found = []
        width = np.diff(ends)
        byte_of = np.repeat(settled, width)
        told = data[byte_of].tobytes()
        pair = np.frombuffer(told, np.int64).reshape(-1, 2)
        found.append((ids[settled], start[settled], pair[:, 1], pair[:, 0]))

        live = ~settled
        seed, sub, ids, start, size = seed[live], sub[live], ids[live], start[live], width[live] // PRINT
        if len(seed):
            wide = np.zeros((int(size.sum()), 8), np.uint8)
            wide[:, :PRINT] = data[~byte_of].reshape(-1, PRINT)
            prints = wide.view(np.uint64).reshape(-1)
            row = np.repeat(np.arange(len(seed)), size)
            change = np.zeros(len(seed), np.int64)
            change[1:] = (seed[1:] != seed[:-1]) | (sub[1:] != sub[:-1])
            group = np.cumsum(change)
            if self.group != (seed[0], sub[0]):
                self.prints, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64)
            kept = len(self.prints)
            all_prints = np.concatenate([self.prints, prints])
            all_ids = np.concatenate([self.ids, ids[row]])
            key = np.concatenate([np.zeros(kept, np.uint64), group[row].astype(np.uint64)]) << np.uint64(8 * PRINT) | all_prints
            order = np.argsort(key, kind="stable")  # rows come by document: the first of equal keys is the smallest
            new = np.ones(len(order), bool)
            new[1:] = key[order][1:] != key[order][:-1]
            first = np.empty(len(order), np.int64)
            first[order] = all_ids[order][new][np.cumsum(new) - 1]
            gone = (all_ids > first)[kept:]
            at = np.flatnonzero(gone)
            if len(at):
                place = at - np.repeat(np.cumsum(size) - size, size)[at]
                begins = np.ones(len(at), bool)
                begins[1:] = (np.diff(at) != 1) | (row[at][1:] != row[at][:-1])
                b = np.flatnonzero(begins)
                found.append((ids[row[at[b]]], start[row[at[b]]] + place[b], np.where(sub[row[at[b]]] > 0, 0, np.diff(np.append(b, len(at)))),
                              np.add.reduceat(prints[at], b).astype(np.int64)))
            last = order[new]
            last = last[(key[last] >> np.uint64(8 * PRINT)) == np.uint64(group[-1])]
            self.group, self.prints, self.ids = (seed[-1], sub[-1]), all_prints[last], all_ids[last]
        return [np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)]


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, start, n, check) over (id, mark, text): runs of ``n`` windows from word ``start`` that a smaller id
    holds, ``check`` the sum of their prints; with n = 0, every window of the print ``check``. ``start`` has
    the row's mark, under 2^31, above bit MARK."""
    ship_package(docs.sparkSession)
    hot = hot_seeds(docs, window, seed)
    dealt = seed_rows(docs, hot, window, seed).repartition("seed", "sub").sortWithinPartitions("seed", "sub", "id")
    out = arrow_schema(REPEATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Repeats()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in state.take(batch)], schema=out)

    return dealt.mapInArrow(run, REPEATS)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` with ``kept_text`` (the words left, joined by one space), ``n_words``, ``n_removed``
    and ``spans`` (maximal repeats, [start, end) in words), replacing columns of these names.

    Ids are integers; a null id counts as larger than all others. Rows that share an id are one
    document: they never remove each other's words, and each loses what a smaller id holds. Null,
    empty and short texts have no windows. A passage repeated within one document alone stays. A very
    long text is read whole. An empty table gives an empty table.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    mark = F.when(F.col(id_col).isNull(), F.xxhash64(text_col).bitwiseAND(0x7FFFFFFF)).otherwise(F.lit(0))
    found = repeats(docs.select(key.alias("id"), mark.alias("mark"), F.col(text_col).alias("text")), window, seed)
    place = F.col("start").bitwiseAND((1 << MARK) - 1).alias("start")
    found = (found.groupBy(F.col("id").alias("__repeat_id"), F.shiftright("start", MARK).alias("__repeat_mark"))
             .agg(F.collect_set(F.struct(place, "n", "check")).alias("__repeats")))
    marked = docs.withColumn("__mark", mark.cast("long"))
    packed = map_rows(marked, with_fields(marked, (text_col, T.BinaryType())), lambda batch, out: extend(
        batch, out, **{text_col: [None if t is None else zstandard.compress(t) for t in batch.column(text_col).cast(pa.binary()).to_pylist()]}))
    joined = packed.join(found, (key == found["__repeat_id"]) & (F.col("__mark") == found["__repeat_mark"]), "left")
    joined = joined.drop("__repeat_id", "__repeat_mark", "__mark")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = with_fields(docs, ("kept_text", T.StringType()), ("n_words", T.LongType()), ("n_removed", T.LongType()), ("spans", spans))

    def cut(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        kept, n_words, n_removed, cuts, original = [], [], [], [], []
        for packed_text, runs in zip(batch.column(text_col).to_pylist(), batch.column("__repeats").to_pylist(), strict=True):
            text = b"" if packed_text is None else zstandard.decompress(packed_text)
            original.append(None if packed_text is None else text)
            words = text.split()
            merged: list[list[int]] = []
            if runs:
                own = prints_of(ngram_hashes(word_hashes(words), window, 0xC2B2AE3D27D4EB4F))
                told = np.array([r["check"] for r in runs if not r["n"]], np.int64).astype(np.uint64)
                runs = [r for r in runs if r["n"]] + [{"start": i, "n": 1, "check": int(own[i])} for i in np.flatnonzero(np.isin(own, told)).tolist()]
                for r in sorted(runs, key=lambda r: r["start"]):
                    a, b = r["start"], r["start"] + r["n"]
                    if b <= len(own) and int(own[a:b].sum(dtype=np.uint64).astype(np.int64)) == r["check"]:  # rows may share an id
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b + window - 1)
                        else:
                            merged.append([a, b + window - 1])
            n_words.append(len(words))
            for a, b in reversed(merged):
                del words[a:b]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
            cuts.append([{"start": a, "end": b} for a, b in merged])
        return extend(batch, out, **{text_col: pa.array(original, pa.binary()).cast(pa.string()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                                     "n_words": n_words, "n_removed": n_removed, "spans": pa.array(cuts, out.field("spans").type)})

    return map_rows(joined, schema, cut)


def substring_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    kept = dedup_substrings(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
