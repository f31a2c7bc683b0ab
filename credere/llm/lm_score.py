"""LM scoring: the probability of a text summed over all ways to cut its words into vocabulary pieces.

Method: every word is a lattice whose arcs are the pieces of an existing vocabulary file. A forward
recursion in log space sums all segmentations, so a word's marginal needs no best path. The file's
scores (ranks) give the pieces their first weights, p ~ 1 / (rank + 2.7); expected piece counts of
the training words, from forward and backward sums, then adapt the weights, with the first ones as
prior. Pieces, bytes (for characters without a piece) and the end of a document share one
distribution, so a document's score is the log10 probability of its pieces and its end.

* Words are counted per task before they are shuffled; lattices run once for each distinct word.
* Documents meet the counts of words in two ways. A word with more than 1/131072 of the training
  tokens is frequent; at most 131,072 exist at any size and they are broadcast. All other words go through
  a shuffle join, one row for each word of a document, where no word has more than that share.
* The piece weights are bounded by the vocabulary file; nothing else is collected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, map_rows, ship_package, stage, texts, with_fields

FOLDS, HELD_FOLD = 7, 2
ALPHA = 1
FREQUENT = 1 << 17
ROUNDS = 2
PRIOR = 32_000.0
RANK_SHIFT = 2.7
UNUSED_SCORE = -1e8
MARK = "▁"  # begins a word in the vocabulary file
END = b" "       # no word holds a space
WIDTHS = (6, 8, 10, 12, 16, 24, 32, 64)
WORDS = 4096
BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a file: characters' hashes, first weights, byte pieces. Index size is the end of a document."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        keys, ids, weight = [], [], np.zeros(self.size + 1)
        self.bytes = np.zeros(256, np.int64)
        self.longest = 1
        for i in range(self.size):
            piece, score = model.id_to_piece(i), model.get_score(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                weight[i] = 1.0 / (self.size + RANK_SHIFT)
            elif not (model.is_control(i) or model.is_unknown(i) or score <= UNUSED_SCORE):
                keys.append(self.hash(piece))
                ids.append(i)
                weight[i] = 1.0 / (-score + RANK_SHIFT)
                self.longest = max(self.longest, len(piece))
        weight[self.size] = 1.0 / (1 + RANK_SHIFT)
        order = np.argsort(np.array(keys, np.uint64))
        self.keys, self.ids = np.array(keys, np.uint64)[order], np.array(ids, np.int64)[order]
        self.first = weight / weight.sum()

    @staticmethod
    def hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if there is none."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.ids[at], -1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Forward and backward sums over all segmentations of words, many words at a time."""

    def __init__(self, vocab: Vocabulary, p: np.ndarray):
        self.vocab = vocab
        with np.errstate(divide="ignore"):
            self.log = np.append(np.log(p), -np.inf)  # index -1: no piece

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word numbers, lengths, code points padded with 0), words of like length together."""
        size = np.array([len(w) + 1 for w in words], np.int64)
        top = int(size.max(initial=0))
        widths = [w for w in WIDTHS if w < top] + [top]
        least = 0
        for width in widths:
            rows = np.flatnonzero((size <= width) & (size > least))
            least = width
            step = max(1, WORDS * 16 // max(width, 1))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                points = np.zeros((len(part), width), np.uint64)
                points[np.arange(width) < size[part][:, None]] = np.frombuffer("".join([MARK + words[i] for i in part]).encode("utf-32-le"), "<u4")
                yield part, size[part], points

    def _arcs(self, points: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each piece length: the piece and its log weight at each start."""
        n = points.shape[1]
        h = np.zeros_like(points)
        pieces, logs = [], []
        for length in range(1, min(self.vocab.longest, n) + 1):
            h = h[:, :n - length + 1] * BASE + points[:, length - 1:]
            found = self.vocab.find(h)
            log = self.log[found]
            if length == 1:
                for point in np.unique(points[(found < 0) & (points > 0)]):
                    log[points == point] = self.log[self.vocab.bytes[list(chr(int(point)).encode())]].sum()
            pieces.append(found)
            logs.append(log)
        return pieces, logs

    @staticmethod
    def _forward(logs: list[np.ndarray], words: int, n: int) -> np.ndarray:
        alpha = np.full((words, n + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, n + 1):
            for length in range(1, min(len(logs), j) + 1):
                arc = logs[length - 1][:, j - length]
                use = np.flatnonzero(arc > -np.inf)
                if len(use):
                    alpha[use, j] = np.logaddexp(alpha[use, j], alpha[use, j - length] + arc[use])
        return alpha

    def log_p(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability."""
        out = np.zeros(len(words))
        for part, size, points in self._groups(words):
            _, logs = self._arcs(points)
            out[part] = self._forward(logs, len(part), points.shape[1])[np.arange(len(part)), size]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece."""
        total = np.zeros(len(self.log))
        for part, size, points in self._groups(words):
            n, rows = points.shape[1], np.arange(len(part))
            pieces, logs = self._arcs(points)
            alpha = self._forward(logs, len(part), n)
            whole = alpha[rows, size]
            beta = np.full((len(part), n + 1), -np.inf)
            beta[rows, size] = 0.0
            for i in range(n - 1, -1, -1):
                for length in range(1, min(len(logs), n - i) + 1):
                    arc = logs[length - 1][:, i]
                    use = np.flatnonzero(arc > -np.inf)
                    if len(use):
                        beta[use, i] = np.logaddexp(beta[use, i], beta[use, i + length] + arc[use])
            for length, (piece, log) in enumerate(zip(pieces, logs, strict=True), 1):
                w, i = np.nonzero((log > -np.inf) & np.isfinite(beta[:, length:]))
                uses = np.exp(alpha[w, i] + log[w, i] + beta[w, i + length] - whole[w]) * counts[part[w]]
                total += np.bincount(np.where(piece[w, i] < 0, len(total) - 1, piece[w, i]), uses, len(total))
                if length == 1:
                    odd = piece[w, i] < 0
                    for point, n_uses in zip(points[w[odd], i[odd]].tolist(), uses[odd].tolist(), strict=True):
                        for b in chr(point).encode():
                            total[self.vocab.bytes[b]] += n_uses
        total[-1] = 0.0
        return total[:-1]


# ---------------------------------------------------------------- counts and weights

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every word of (held, text) with its number in documents that are not held out; END counts those documents."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(count: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], schema=out)

        count: Counter = Counter()
        for batch in batches:
            for held, text in zip(batch.column("held").to_pylist(), texts(batch.column("text")), strict=True):
                words = text.lower().split()
                if held:
                    for w in words:
                        if w not in count:
                            count[w] = 0
                else:
                    count.update(words)
                    count[END] += 1
                if len(count) > 500_000:
                    yield emit(count)
                    count = Counter()
        yield emit(count)

    return docs.mapInArrow(run, schema).groupBy("word").agg(F.sum("c").alias("c"))


def piece_weights(counts: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities after some rounds of expected counts over the training words."""
    vocab = vocabulary(path)
    p = vocab.first
    schema = T.StructType([T.StructField("piece", T.LongType()), T.StructField("n", T.DoubleType())])
    out = arrow_schema(schema)
    trained = counts.where("c > 0")
    for _ in range(rounds):
        shared = counts.sparkSession.sparkContext.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab = vocabulary(path)
            lattice, total = Lattice(vocab, shared.value), np.zeros(vocab.size + 1)
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("c").to_numpy().astype(float)
                ends = np.array([w == END for w in words], bool)
                total[vocab.size] += n[ends].sum()
                own = [w.decode() for w, e in zip(words, ends, strict=True) if not e]
                total += lattice.expected(own, n[~ends])
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], schema=out)

        sums = trained.mapInArrow(run, schema).groupBy("piece").agg(F.sum("n").alias("n")).orderBy("piece").collect()
        uses = np.zeros(vocab.size + 1)
        for r in sums:  # at most one row for each piece of the file
            uses[r["piece"]] = r["n"]
        p = (uses + PRIOR * vocab.first) / (uses.sum() + PRIOR)
    return p


# ---------------------------------------------------------------- scoring

def score_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from rows whose crc32 of the id as text, modulo 7, is not 2 (a null id counts as
    the empty text). ``base_score`` is the add-one unigram of whole words, ``score`` the lattice
    model, both log10. A null or empty text is the end token alone. Repeated rows each count and are
    scored alike. An empty table gives an empty result; without training rows every word is unknown.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_FOLD
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held"), F.col(text_col).alias("text"))
    counts = stage(word_counts(rows.select("held", "text")), "word_counts")
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("c") > 0, 1).otherwise(0)), F.lit(0)).alias("v")).first()
    n_train, scale = size["n"], math.log10(size["n"] + ALPHA * (size["v"] + 1))
    sc = docs.sparkSession.sparkContext
    weights = sc.broadcast(piece_weights(counts, path))

    def lattice_p(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        vocab = vocabulary(path)
        lattice, p = Lattice(vocab, weights.value), weights.value
        words = batch.column("word").to_pylist()
        ends = np.array([w == END for w in words], bool)
        log = np.full(len(words), math.log10(p[vocab.size]))
        log[~ends] = lattice.log_p([w.decode() for w in words if w != END]) / math.log(10)
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(log)], schema=out)

    scored = stage(map_rows(counts, with_fields(counts, ("lp", T.DoubleType())), lattice_p), "word_scores")
    frequent = scored.where((F.col("c") * FREQUENT > n_train) | (F.col("word") == F.lit(END))).collect()  # at most FREQUENT words and the end
    table = {bytes(r["word"]): (math.log10(r["c"] + ALPHA) - scale, r["lp"], 1 if r["c"] else 0) for r in frequent}
    # a table without rows or without training rows has no end count: the end is then as unlikely as any unknown token
    table.setdefault(END, (-scale, float(np.log10(weights.value[-1])), 0))
    shared = sc.broadcast(table)

    head = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("held", T.BooleanType()),
                         T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
                         T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("word", T.BinaryType()),
                           T.StructField("n", T.IntegerType()), T.StructField("head", head)])

    def split(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        """A head row for each document, with all that its frequent words give, and a row for each other word."""
        table = shared.value
        get = table.get
        row, word, n, at, known, base, score, tokens = [], [], [], [], [], [], [], []
        for number, text in zip(batch.column("row").to_pylist(), texts(batch.column("text")), strict=True):
            words = text.lower().split()
            b, s, k = table[END]
            own: list[bytes] = []
            at.append(len(row))
            row.append(number)
            word.append(b" %d" % number)  # meets no word, and spreads the heads over the tasks
            n.append(0)
            for w, times in Counter(words).items():
                found = get(w)
                if found is None:
                    own.append(w)
                    n.append(times)
                else:
                    b += times * found[0]
                    s += times * found[1]
                    k += times * found[2]
            word += own
            row += [number] * len(own)
            tokens.append(len(words) + 1)
            base.append(b)
            score.append(s)
            known.append(k)
        place = np.full(len(row), -1, np.int64)
        place[at] = np.arange(len(at))
        take = pa.array(place, mask=place < 0)
        values = [batch.column("doc_id"), batch.column("held"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
        heads = pa.StructArray.from_arrays([v.take(take) for v in values], fields=list(out.field("head").type), mask=pa.array(place < 0))
        return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(word, pa.binary()), pa.array(n, pa.int32()), heads], schema=out)

    parts = map_rows(rows.withColumn("row", F.monotonically_increasing_id()), schema, split)
    met = parts.join(scored, "word", "left").groupBy("row").agg(
        F.max("head").alias("head"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.coalesce(F.col("n") * (F.log10(F.col("c") + ALPHA) - F.lit(scale)), F.lit(0.0))).alias("base"),
        F.sum(F.coalesce(F.col("n") * F.col("lp"), F.lit(0.0))).alias("score"))
    return met.select("head.doc_id", F.col("head.held").alias("held_out"), "head.n_tokens", (F.col("head.known") + F.col("known")).alias("n_known"),
                      F.lit(n_train).cast("long").alias("train_tokens"), (F.col("head.base") + F.col("base")).alias("base_score"),
                      (F.col("head.score") + F.col("score")).alias("score"))
