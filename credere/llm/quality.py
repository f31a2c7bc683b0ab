"""Quality rules: counting rules first, then n-gram perplexity within bands of the text's language.

Method: a modified Kneser-Ney model of byte 5-grams for each language, counted by Spark over all
documents: the top order by its counts, each lower order by the number of bytes seen before it, three
discounts an order from the counts of counts. Every gram's interpolated log probability is a row of a
table, and the frequent ones are kept as sorted arrays, (gram, log probabilities) for each language;
five bytes are their own 40-bit hash, so a lookup is exact. A text is rejected where its perplexity
lies outside its language's band.

No text is scored by a model that has seen it: texts fall into two folds by their bytes, copies into
one, and each fold is scored by the model of the other. Noise would else explain itself.

* Grams of bytes, not of words: a word model of such a corpus is as large as the corpus, and its
  counts and its lookups would both cross the network. Bytes saturate: their grams are counted
  per task before they are shuffled.
* A gram with more than 1/2^21 of all positions is frequent: fewer than 2^21 exist at any size, and
  those are broadcast. All other grams of a document go through a shuffle join, one row for each distinct
  gram of a document, where no gram has more than that share.
* Log probabilities are whole numbers of 2^-16 nats, so that sums do not depend on their order.
* Bands come from a histogram of bins of 1/256 nat, counted per task; a language has a few thousand
  bins at most. Languages with more than 1/4096 of the documents meet their bands and discounts by
  a broadcast, all others by a shuffle join.
* Every document trains one of the two models, as it is: copies and rejected texts included. A
  language is a label; null counts as the empty one. A fold without any text of a language gives the uniform model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, blocks_of, hot_join, map_rows, ngram_hashes, ship_package, stage, texts, word_hashes

ORDER = 5
FOLDS = 2
BYTE = 8
FREQUENT = 1 << 21
PENDING = 1 << 20      # counted grams kept in a task before they leave it
BLOCK_BYTES = 2 << 20
UNIT = 1 << 16         # log probabilities a nat
BINS = 256             # histogram bins a nat
WINDOW = 5             # words of a repeated window
MIN_WORDS, MAX_REPEAT = 10, 20   # fewer words, or more per cent of them in repeated windows, fail
FEW_COUNTS = 0.75      # discount of an order whose counts of counts give none
LEAST_DISCOUNT = 0.1   # so that every context leaves something to the order below
WIDTH = 3.0            # interquartile ranges outside the quartiles that a text may lie
LEAST_RANGE = 0.06      # nats that count as the range of a language of like texts
SHORT = 5.0            # a text of n bytes may lie SHORT / sqrt(n) nats further out
EDGE = b"\n"           # stands before and after a text; none of its own bytes
_SYMBOLS = b"#*$%&|<>"
_FOLLOWING = bytes(range(0x80, 0xC0))


# ---------------------------------------------------------------- counting rules

def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of WINDOW words that occur twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    h = ngram_hashes(word_hashes(words), WINDOW)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice).tolist()
    count = Counter(tuple(words[i:i + WINDOW]) for i in starts)   # the words decide, not their hashes
    cover = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if count[tuple(words[i:i + WINDOW])] > 1:
            cover[i] += 1
            cover[i + WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def counts_of(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows)."""
    words = text.split()
    return (len(words), len(b"".join(words).translate(None, _FOLLOWING)), len(text) - len(text.translate(None, _SYMBOLS)),
            repeated_lines(text), repeated_words(words))


# ---------------------------------------------------------------- grams

def grams(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(grams of all texts one after another, number of each): one gram for each byte and one for the end."""
    edge = EDGE * (ORDER - 1)
    flat = np.frombuffer(edge.join([b"", *[b + EDGE for b in bodies]]), np.uint8).astype(np.int64)
    size = np.array([len(b) + 1 for b in bodies], np.int64)
    key = np.zeros(len(flat) - ORDER + 1, np.int64)
    for i in range(ORDER):
        key = (key << BYTE) | flat[i:i + len(key)]
    first = np.cumsum(size + ORDER - 1) - (size + ORDER - 1)
    at = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    return key[at], size


def body(text: bytes) -> bytes:
    """What the model reads: A-Z in lower case, one space between words."""
    return b" ".join(text.lower().split())


def by_fold(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[int], list[bytes]]]:
    """(language, fold, rows, bodies): the batch dealt out. Like bodies share a fold."""
    dealt: dict[tuple[str, int], tuple[list[int], list[bytes]]] = {}
    for i, (name, text) in enumerate(zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True)):
        own = body(text)
        rows, bodies = dealt.setdefault((name, xxhash.xxh3_64_intdigest(own) % FOLDS), ([], []))
        rows.append(i)
        bodies.append(own)
    for (name, fold), (rows, bodies) in dealt.items():
        yield name, fold, rows, bodies


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, g, n0, n1) over all rows of (lang, text): the occurrences in each fold."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("lang", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("g", "n0", "n1")]])
    out = arrow_schema(schema)

    def told(pending: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for name, parts in pending.items():
            for g, n in parts:
                yield pa.RecordBatch.from_arrays([pa.array([name]).take(pa.array(np.zeros(len(g), np.int64))), pa.array(g), *[pa.array(n[:, f].copy()) for f in range(FOLDS)]], schema=out)

    def merged(parts: list) -> list:
        g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.zeros((len(g), FOLDS), np.int64)
        np.add.at(n, at, np.concatenate([p[1] for p in parts]))
        return [(g, n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[str, list] = {}
        size = 0
        for batch in (b for whole in batches for b in blocks_of(whole, "text", BLOCK_BYTES)):
            for name, fold, _, bodies in by_fold(batch):
                g, n = np.unique(grams(bodies)[0], return_counts=True)
                both = np.zeros((len(g), FOLDS), np.int64)
                both[:, fold] = n
                pending.setdefault(name, []).append((g, both))
                size += len(g)
            if size > PENDING:
                pending = {name: merged(parts) for name, parts in pending.items()}
                size = sum(len(p[0][0]) for p in pending.values())
                if size > PENDING // 2:
                    yield from told(pending)
                    pending, size = {}, 0
        yield from told({name: merged(parts) for name, parts in pending.items()})

    return docs.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


# ---------------------------------------------------------------- the model

def counts_of_counts(levels: DataFrame, keys: list, most: int) -> DataFrame:
    """For each fold f: ``den_f``, the sum of ``c_f``, and ``n1_f`` to ``n{most}_f``, how many entries have that count (the last: at least that)."""
    of = [e for f in range(FOLDS) for e in (F.sum(f"c{f}").alias(f"den_{f}"), *[F.sum(((F.col(f"c{f}") == i) if i < most else (F.col(f"c{f}") >= i)).cast("long")).alias(f"n{i}_{f}") for i in range(1, most + 1)])]
    return levels.groupBy(*keys).agg(F.count("*").alias("entries"), *of)


def discounts(levels: DataFrame) -> DataFrame:
    """(lang, k, entries, d1_f, d2_f, d3_f) of each order of each language, from its counts of counts."""
    n = counts_of_counts(levels, ["lang", "k"], 5)

    def d(i: int, f: int) -> Column:
        n1, n2, own, more = (F.col(f"n{x}_{f}") for x in (1, 2, i, i + 1))
        told = F.lit(float(i)) - F.lit(i + 1.0) * (n1 / (n1 + 2 * n2)) * more / own
        return F.when((n1 > 0) & (n2 > 0) & (own > 0), F.greatest(F.lit(LEAST_DISCOUNT), told)).otherwise(F.lit(FEW_COUNTS)).alias(f"d{i}_{f}")

    return n.select("lang", "k", "entries", *[d(i, f) for f in range(FOLDS) for i in (1, 2, 3)])


def fit(docs: DataFrame) -> DataFrame:
    """(lang, g, n, lp0, lp1): every gram of (lang, text), its count and, in UNITs, its log probability in the model of each fold."""
    top = stage(gram_counts(docs), "grams")
    level = top.select("lang", F.lit(ORDER).alias("k"), "g", F.col("n0").alias("c0"), F.col("n1").alias("c1"))
    levels = level
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many grams of the order above it is the end
        level = (level.groupBy("lang", F.col("g").bitwiseAND((1 << BYTE * k) - 1).alias("g")).agg(*[F.sum((F.col(f"c{f}") > 0).cast("long")).alias(f"c{f}") for f in range(FOLDS)])
                 .select("lang", F.lit(k).alias("k"), "g", "c0", "c1"))
        levels = levels.unionByName(level)
    levels = stage(levels, "orders")
    of_context = counts_of_counts(levels, ["lang", "k", F.shiftright("g", BYTE).alias("ctx")], 3).drop("entries")
    met = levels.withColumn("ctx", F.shiftright("g", BYTE)).join(of_context, ["lang", "k", "ctx"])
    met = hot_join(met, discounts(levels), ["lang", "k"], "entries")

    def share(f: int) -> tuple[Column, Column]:
        """What the gram keeps of its context after the discount, and what the context leaves to the order below; all, if it is unknown."""
        c, den = F.col(f"c{f}"), F.col(f"den_{f}")
        less = F.when(c == 1, F.col(f"d1_{f}")).when(c == 2, F.col(f"d2_{f}")).otherwise(F.col(f"d3_{f}"))
        rest = sum((F.col(f"d{i}_{f}") * F.col(f"n{i}_{f}") for i in (2, 3)), F.col(f"d1_{f}") * F.col(f"n1_{f}")) / den
        return (F.when(den > 0, F.greatest(c - less, F.lit(0.0)) / den).otherwise(F.lit(0.0)).alias(f"a{f}"), F.when(den > 0, rest).otherwise(F.lit(1.0)).alias(f"rest{f}"))

    own = stage(met.select("lang", "k", "g", *[c for f in range(FOLDS) for c in share(f)]), "interpolation")
    p = own.where("k = 1").select("lang", F.col("g").alias("s"), *[(F.col(f"a{f}") + F.col(f"rest{f}") / 256.0).alias(f"p{f}") for f in range(FOLDS)])
    for k in range(2, ORDER + 1):
        mine = own.where(F.col("k") == k).withColumn("s", F.col("g").bitwiseAND((1 << BYTE * (k - 1)) - 1))
        p = mine.join(p, ["lang", "s"]).select("lang", F.col("g").alias("s"), *[(F.col(f"a{f}") + F.col(f"rest{f}") * F.col(f"p{f}")).alias(f"p{f}") for f in range(FOLDS)])
    p = p.withColumnRenamed("s", "g")
    return stage(top.join(p, ["lang", "g"]).select("lang", "g", (F.col("n0") + F.col("n1")).alias("n"), *[F.round(F.log(f"p{f}") * UNIT).cast("long").alias(f"lp{f}") for f in range(FOLDS)]), "gram_model")


def frequent_arrays(model: DataFrame, total: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted grams of each language that has frequent ones, and their log probabilities by fold: fewer than FREQUENT entries."""
    table = model.where(F.col("n") * FREQUENT > total).select("lang", "g", "lp0", "lp1").toArrow()
    lang, g = table.column("lang").combine_chunks().dictionary_encode(), table.column("g").to_numpy()
    lp = np.stack([table.column(f"lp{f}").to_numpy() for f in range(FOLDS)])
    code, out = lang.indices.to_numpy(), {}
    for i, name in enumerate(lang.dictionary.to_pylist()):
        own = np.flatnonzero(code == i)
        own = own[np.argsort(g[own])]
        out[name] = (g[own], lp[:, own])
    return out


# ---------------------------------------------------------------- the operator

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def perplexities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang, the five COUNTS, n_grams, log_p in UNITs) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    model = fit(rows)
    total = model.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = docs.sparkSession.sparkContext.broadcast(frequent_arrays(model, total))
    head = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang", T.StringType()),
                         *[T.StructField(c, T.LongType()) for c in (*COUNTS, "n_grams", "log_p")]])
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("g", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("fold", T.LongType()), T.StructField("head", head)])

    def split(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        """A head row for each document, with all that its frequent grams give, and a row for each other gram."""
        raw, number = texts(batch.column("text")), batch.column("row").to_numpy()
        none = (np.empty(0, np.int64), np.empty((FOLDS, 0), np.int64))
        size, log_p = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        row, lang, gram, count = [number], [pa.array([""] * len(raw), pa.string())], [-1 - number], [np.zeros(len(raw), np.int64)]  # heads meet no gram
        folds = [np.zeros(len(raw), np.int64)]
        for name, fold, own, bodies in by_fold(batch):
            g, n = grams(bodies)
            known, lp = shared.value.get(name, none)
            lp = lp[1 - fold]
            at = np.minimum(np.searchsorted(known, g), max(0, len(known) - 1))
            hit = known[at] == g if len(known) else np.zeros(len(g), bool)
            doc = np.repeat(np.array(own), n)
            size[own] = n
            log_p += np.bincount(doc[hit], lp[at[hit]].astype(float), len(raw)).astype(np.int64)  # exact: far below 2^53
            rest, times = np.unique(np.stack([doc[~hit], g[~hit]], 1), axis=0, return_counts=True)
            row.append(number[rest[:, 0]])
            lang.append(pa.array([name], pa.string()).take(pa.array(np.zeros(len(rest), np.int64))))
            gram.append(rest[:, 1])
            count.append(times)
            folds.append(np.full(len(rest), fold))
        told = np.array([counts_of(t) for t in raw], np.int64).reshape(-1, len(COUNTS))
        n_rows = sum(len(r) for r in row)
        take = pa.array(np.arange(n_rows), mask=np.arange(n_rows) >= len(raw))
        values = [batch.column("id"), batch.column("lang"), *[pa.array(told[:, i].copy()) for i in range(len(COUNTS))], pa.array(size), pa.array(log_p)]
        heads = pa.StructArray.from_arrays([v.take(take) for v in values], fields=list(out.field("head").type), mask=pa.array(np.arange(n_rows) >= len(raw)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(row)), pa.concat_arrays(lang), pa.array(np.concatenate(gram)),
                                           pa.array(np.concatenate(count)), pa.array(np.concatenate(folds)), heads], schema=out)

    parts = map_rows(rows.withColumn("row", F.monotonically_increasing_id()), schema, split, "text", BLOCK_BYTES)
    rare = model.where(F.col("n") * FREQUENT <= total).select("lang", "g", "lp0", "lp1")
    lp = F.when(F.col("fold") == 0, F.col("lp1")).otherwise(F.col("lp0"))
    met = parts.join(rare, ["lang", "g"], "left").groupBy("row").agg(F.max("head").alias("head"), F.coalesce(F.sum(F.col("n") * lp), F.lit(0)).alias("rare"))
    return met.select("head.id", F.col("head.lang").alias("lang"), *[f"head.{c}" for c in COUNTS], "head.n_grams", (F.col("head.log_p") + F.col("rare")).alias("log_p"))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, docs, low, high) in nats a byte over the rows of (lang, nats): the quartiles, widened."""
    hist = scored.groupBy("lang", F.floor(F.col("nats") * BINS).alias("bin")).agg(F.count("*").alias("n"))
    along = Window.partitionBy("lang").orderBy("bin")  # a few thousand bins a language
    cum = hist.select("lang", "bin", F.sum("n").over(along).alias("upto"), F.sum("n").over(Window.partitionBy("lang")).alias("docs"))
    at = [F.min(F.when(F.col("upto") * 4 >= F.col("docs") * q, F.col("bin"))) / BINS for q in (1, 3)]
    q = cum.groupBy("lang").agg(F.max("docs").alias("docs"), at[0].alias("q1"), at[1].alias("q3"))
    wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE)) * WIDTH
    return q.select("lang", "docs", (F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang, the five COUNTS, base_failed, perplexity, low, high, kept): one row for each row of ``docs``.

    ``perplexity`` is of a byte; ``low`` and ``high`` bound it for this text. A text fails by the rules
    where it has fewer than MIN_WORDS words or more than MAX_REPEAT per cent of them lie in repeated windows,
    and else where its perplexity is not between its bounds (the bounds themselves pass). The bands are
    of all texts of the language that pass the rules. A null or empty text has no words and fails; a
    null language is the empty label. Rows are judged one by one: repeated ids, null ids and ties are allowed,
    other columns are ignored, a text of any length is read whole. An empty table gives an empty result.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    scored = stage(perplexities(docs, id_col, text_col, lang_col).select(
        "id", "lang", *COUNTS, failed.alias("base_failed"), "n_grams", (-F.col("log_p") / F.col("n_grams") / UNIT).alias("nats")), "perplexities")
    met = hot_join(scored, bands(scored.where("not base_failed")), ["lang"], "docs")
    room = F.lit(SHORT) / F.sqrt("n_grams")
    low, high = F.col("low") - room, F.col("high") + room
    return met.select("id", "lang", *COUNTS, "base_failed", F.exp("nats").alias("perplexity"), F.exp(low).alias("low"), F.exp(high).alias("high"),
                      F.coalesce(~F.col("base_failed") & F.col("nats").between(low, high), F.lit(False)).alias("kept"))


def quality_report(docs: DataFrame) -> DataFrame:
    """(doc_id, the five COUNTS, base_failed, kept, lang, perplexity, low, high) of every document."""
    return judge(docs).select(F.col("id").alias("doc_id"), *COUNTS, "base_failed", "kept", "lang", "perplexity", "low", "high")
