"""Language ID: what the text says, what its markup declares, and where it was found, as one posterior.

Method: Bayesian evidence fusion. A text's likelihood under each language comes from byte trigrams
counted over all labelled documents. To it are added the log likelihood of the declared language
(how often pages of a language declare it) and of the address's path code, and the log prior
of the host, smoothed hierarchically: host towards domain, domain towards address suffix, suffix
towards the whole table. All tables are grouped aggregations over the whole input; none is sampled.

A text without letters is rejected. So is one that even the best language explains no better than
uniform trigrams, unless what is declared and the host outweigh that: a short text of rare words, names
or code keeps its correct label. A wrong declaration or a rare host is evidence, not a verdict.

* Every label is a language, however rare. Trigrams are counted per task before they are shuffled;
  the model is kept and scored in blocks of ``LANG_BLOCK`` languages, of which a task holds one.
* A row carries a likelihood for each language, and ``CELLS`` bounds rows x languages in a Python batch.
  Priors and declarations are kept as the counts that occur, not as tables of all languages.
* Hosts with more than 1/4096 of the rows (fewer than 4,096 at any size) meet their prior by a
  broadcast, all others by a shuffle join of narrow rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, blocks_of, extend, lean, map_rows, ship_package, stage, texts, with_fields, with_row_key

BUCKETS = 1 << 15
LANG_BLOCK = 8         # languages scored at a time
PENDING = 1 << 19      # trigram counts kept in a task before they are merged
CELLS = 1 << 20        # rows x languages in a batch
HOT_SHARE = 4096
SMOOTH = 0.5           # trigram pseudo-count
STRENGTH = 5.0         # rows that a parent level's prior counts as
DECLARED_SMOOTH = 1.0
EVIDENCE = 1.0 / 3.0   # trigrams overlap: each letter is in three
UNKNOWN = 1e-3         # prior share of texts in no known language among those that declare one
BLOCK_BYTES = 1 << 18
TEXT_BYTES = 4 << 20   # texts cleaned at a time

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_MARKUP = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", re.S | re.I)


def visible(html: bytes) -> bytes:
    """The text of a page without scripts, styles, comments, tags and entities."""
    return _MARKUP.sub(b" ", html)


def letters(text: bytes) -> bytes:
    """Runs of letters, lower-cased in A-Z, one space between and around them; empty without letters."""
    words = text.translate(_LETTERS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def trigram_blocks(cleaned: list[bytes]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, buckets, starts, ends) in blocks of bounded bytes: row i has the buckets [starts, ends)."""
    first, size = 0, 0
    for i, c in enumerate(cleaned):
        size += len(c)
        if size >= BLOCK_BYTES or i == len(cleaned) - 1:
            own = cleaned[first:i + 1]
            flat = np.frombuffer(b"".join(own) + b"  ", np.uint8).astype(np.uint32)
            code = (flat[:-2] << 16) | (flat[1:-1] << 8) | flat[2:]
            buckets = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int64)
            ends = np.cumsum([len(c) for c in own])
            starts = ends - np.array([len(c) for c in own])
            yield slice(first, i + 1), buckets, starts, np.maximum(starts, ends - 2)
            first, size = i + 1, 0


# ---------------------------------------------------------------- text model

@dataclass
class TextModel:
    langs: list[str]
    blocks: list[Broadcast]  # log probabilities (BUCKETS, languages) of LANG_BLOCK languages each

    def score(self, cleaned: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(log likelihoods over uniform trigrams, trigrams) of each text."""
        out, n = np.zeros((len(cleaned), len(self.langs))), np.zeros(len(cleaned), np.int64)
        for i, block in enumerate(self.blocks):
            over = block.value + np.log(BUCKETS)
            cols = slice(i * LANG_BLOCK, i * LANG_BLOCK + over.shape[1])
            for rows, buckets, starts, ends in trigram_blocks(cleaned):
                sums = np.concatenate([np.zeros((1, over.shape[1])), np.cumsum(over[buckets], axis=0)])
                out[rows, cols] = sums[ends] - sums[starts]
                n[rows] = ends - starts
            if len(self.blocks) > 1:
                block.__dict__.pop("_value", None)  # read again when it is needed: one block at a time
        return out, n


def languages(labelled: DataFrame) -> list[str]:
    """All labels."""
    return sorted(r["lang"] for r in labelled.where(F.col("lang").isNotNull() & (F.col("lang") != "")).select("lang").distinct().collect())


def _merged(pending: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate([c for c, _ in pending]), return_inverse=True)
    n = np.zeros(len(code), np.int64)
    np.add.at(n, at, np.concatenate([x for _, x in pending]))
    return code, n


def fit_text_model(labelled: DataFrame, html: bool = False) -> TextModel:
    """Trigram model over all rows of (lang, text)."""
    ship_package(labelled.sparkSession)
    langs = languages(labelled)
    place = {name: i for i, name in enumerate(langs)}
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("lang", "bucket", "n")])
    out = arrow_schema(schema)

    def told(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code // BUCKETS), pa.array(code % BUCKETS), pa.array(n)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in (b for whole in batches for b in blocks_of(whole, "text", TEXT_BYTES)):
            label = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            cleaned = [letters(visible(t) if html else t) if k >= 0 else b"" for k, t in zip(label, texts(batch.column("text")), strict=True)]
            for rows, buckets, starts, ends in trigram_blocks(cleaned):
                own = label[rows]
                present = np.unique(own[own >= 0])
                for part in (present[i:i + LANG_BLOCK] for i in range(0, len(present), LANG_BLOCK)):
                    pick = np.flatnonzero(np.isin(own, part))
                    length = (ends - starts)[pick]
                    each = np.repeat(np.arange(len(pick)), length)
                    at = np.arange(len(each)) + np.repeat(starts[pick] - np.cumsum(length) + length, length)
                    count = np.bincount(np.searchsorted(part, own[pick])[each] * BUCKETS + buckets[at], minlength=len(part) * BUCKETS)
                    seen = np.flatnonzero(count)
                    pending.append((part[seen // BUCKETS] * BUCKETS + seen % BUCKETS, count[seen].astype(np.int64)))
                    size += len(seen)
                    if size > PENDING:
                        pending = [_merged(pending)]
                        size = len(pending[0][0])
                        if size > PENDING // 2:
                            yield told(*pending[0])
                            pending, size = [], 0
        if pending:
            yield told(*_merged(pending))

    blocks = []
    if langs:
        counts = labelled.select("lang", "text").mapInArrow(lean(run), schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        counts = stage(counts.repartitionByRange("lang").sortWithinPartitions("lang"), "trigrams")
        for first in range(0, len(langs), LANG_BLOCK):
            width = min(LANG_BLOCK, len(langs) - first)
            total = np.full((BUCKETS, width), SMOOTH)
            lang, bucket, n = (c.to_numpy() for c in counts.where(F.col("lang").between(first, first + width - 1)).toArrow().columns)
            total[bucket, lang - first] += n  # at most BUCKETS rows a language, each once
            blocks.append(labelled.sparkSession.sparkContext.broadcast(np.log(total / total.sum(axis=0))))
    return TextModel(langs, blocks)


# ---------------------------------------------------------------- priors

def host_priors(seen: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """((host, rows, prior) of (host, domain, suffix, guess), p(language) in the whole table).

    ``prior`` holds the counts by language of the host's suffix, domain and own rows, for ``prior_of``.
    """
    host = stage(seen.where(F.col("guess") >= 0).groupBy("host", "domain", "suffix", "guess").agg(F.count("*").alias("n")), "hosts")
    entries = F.collect_list(F.struct("guess", "n"))  # at most one a language
    domain = host.groupBy("domain", "suffix", "guess").agg(F.sum("n").alias("n"))
    suffix = domain.groupBy("suffix", "guess").agg(F.sum("n").alias("n"))
    whole = np.zeros(k)
    for r in suffix.groupBy("guess").agg(F.sum("n").alias("n")).collect():
        whole[r["guess"]] = r["n"]
    by_suffix = suffix.groupBy(F.col("suffix").alias("s")).agg(entries.alias("of_suffix"))
    by_domain = (domain.groupBy(F.col("domain").alias("d"), "suffix").agg(entries.alias("of_domain"))
                 .join(by_suffix, F.col("suffix") == F.col("s")).select("d", "of_domain", "of_suffix"))
    by_host = host.groupBy(F.col("host").alias("h"), "domain").agg(F.sum("n").alias("rows"), entries.alias("of_host"))
    priors = by_host.join(by_domain, F.col("domain") == F.col("d")).select("h", "rows", F.struct("of_suffix", "of_domain", "of_host").alias("prior"))
    return priors, (whole + 1.0) / (whole.sum() + k)


def prior_of(counts: dict | None, whole: np.ndarray) -> np.ndarray:
    """p(language | host) from the counts of its levels, each drawn towards the one above; uniform for an unseen host."""
    if counts is None:
        return np.full(len(whole), 1.0 / len(whole))
    p = whole
    for level in ("of_suffix", "of_domain", "of_host"):
        own = np.zeros(len(whole))
        for e in counts[level]:
            own[e["guess"]] = e["n"]
        p = (own + STRENGTH * p) / (own.sum() + STRENGTH)
    return p


@dataclass
class Evidence:
    """p(value | language) of a column of language numbers (-1: none or another value)."""
    total: np.ndarray                                # rows by language
    by_value: dict[int, tuple[np.ndarray, np.ndarray]]  # languages and rows with a value

    def log_p(self, value: int) -> np.ndarray:
        k = len(self.total)
        own = np.full(k, DECLARED_SMOOTH)
        if value in self.by_value:
            lang, n = self.by_value[value]
            own[lang] += n
        return np.log(own / (self.total + DECLARED_SMOOTH * (k + 1)))


def evidence_table(seen: DataFrame, column: str, k: int) -> Evidence:
    total, pairs = np.zeros(k), {}
    for r in seen.where(F.col("guess") >= 0).groupBy("guess", column).agg(F.count("*").alias("n")).collect():  # the pairs that occur
        total[r["guess"]] += r["n"]
        if r[column] >= 0:
            pairs.setdefault(r[column], []).append((r["guess"], r["n"]))
    return Evidence(total, {v: (np.array([g for g, _ in p]), np.array([n for _, n in p], float)) for v, p in pairs.items()})


# ---------------------------------------------------------------- the operator

def address_parts(url: Column) -> dict[str, Column]:
    """Host, domain (its last two labels), suffix (the last) and the language code of a path's first part."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    labels = F.split(host, r"\.")
    return {"host": host, "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
            "suffix": F.element_at(labels, -1),
            "path": F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/([A-Za-z]{2})(?:[/?#]|$)", 1))}


def declared_markup(html: Column) -> Column:
    """The primary part of the root element's lang attribute."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))


def identify(rows: DataFrame, model: TextModel, html: bool = False) -> DataFrame:
    """``rows`` (text, declared, host, domain, suffix, path, any others) with ``text`` dropped and
    ``lang``, ``posterior``, ``text_lang`` and ``rejected`` added.

    Rejected rows have a null language and posterior. Nulls in any evidence column are no evidence.
    Without any language (no labelled rows) all rows are rejected. Repeated rows are judged alike.
    """
    langs = model.langs
    k = len(langs)
    sc = rows.sparkSession.sparkContext
    if not k:
        return rows.drop("text").select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("posterior", "double"), ("text_lang", "string"))],
                                        F.lit(True).alias("rejected"))
    schema = with_fields(rows.drop("text"), ("declared", T.IntegerType()), ("path", T.IntegerType()), ("guess", T.IntegerType()), ("ll", T.ArrayType(T.DoubleType())))

    place = {name: i for i, name in enumerate(langs)}

    def score(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        raw = texts(batch.column("text"))
        ll, n = model.score([letters(visible(t) if html else t) for t in raw])
        guess = np.where(n == 0, -2, np.where(ll.max(axis=1) > 0, ll.argmax(axis=1), -1))  # -2: no letters, -1: no language by the text
        code = {c: [place.get(x, -1) for x in batch.column(c).to_pylist()] for c in ("declared", "path")}
        return extend(batch.drop_columns(["text"]), out, guess=guess.tolist(), **code,
                      ll=pa.ListArray.from_arrays(pa.array(np.arange(len(ll) + 1) * k, pa.int32()), pa.array(ll.ravel())).cast(out.field("ll").type))

    filled = rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("host", "domain", "suffix") else F.col(f"`{c}`") for c in rows.columns])
    seen = stage(map_rows(filled, schema, score, "text", TEXT_BYTES, rows=max(1, CELLS // k)), "language_evidence")
    priors, whole = host_priors(seen, k)
    priors = stage(priors, "host_priors")
    tables = sc.broadcast({c: evidence_table(seen, c, k) for c in ("declared", "path")})
    total = priors.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = priors.where(F.col("rows") * HOT_SHARE > total).select("h", "prior")  # fewer than HOT_SHARE hosts
    marked = seen.join(F.broadcast(hot.withColumnRenamed("prior", "hot_prior")), seen["host"] == F.col("h"), "left").drop("h")
    told = marked.where("hot_prior is not null").withColumnRenamed("hot_prior", "prior")
    rest = (marked.where("hot_prior is null").drop("hot_prior")
            .join(priors.where(F.col("rows") * HOT_SHARE <= total).select("h", "prior"), F.col("host") == F.col("h"), "left").drop("h"))
    both = told.unionByName(rest)
    schema = with_fields(both.drop("ll", "guess", "prior"), ("declared", T.StringType()), ("path", T.StringType()), ("lang", T.StringType()), ("posterior", T.DoubleType()),
                         ("text_lang", T.StringType()), ("rejected", T.BooleanType()))

    def fuse(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        names = langs
        ll = batch.column("ll").flatten().to_numpy().reshape(batch.num_rows, k)
        guess = batch.column("guess").to_numpy()
        _, first, at = np.unique(batch.column("host").dictionary_encode().indices.to_numpy(), return_index=True, return_inverse=True)
        total = EVIDENCE * ll + np.log(np.array([prior_of(p, whole) for p in batch.column("prior").take(pa.array(first)).to_pylist()]))[at]
        code = {c: batch.column(c).to_pylist() for c in ("declared", "path")}
        # over no language: uniform trigrams, declarations and hosts
        over = total + np.log(k)
        over += np.where(np.max([np.array(v) for v in code.values()], axis=0) >= 0, np.log((1 - UNKNOWN) / UNKNOWN), 0.0)[:, None]
        for c, values in code.items():
            log_p = {v: tables.value[c].log_p(v) for v in set(values) if v >= 0} | {-1: np.zeros(k)}
            own = np.array([log_p[v] for v in values])
            total += own
            over += own + np.where(np.array(values) >= 0, np.log(k + 1), 0.0)[:, None]
        total -= total.max(axis=1, keepdims=True)
        post = np.exp(total) / np.exp(total).sum(axis=1, keepdims=True)
        best, ok = post.argmax(axis=1), (guess >= 0) | ((guess == -1) & (over.max(axis=1) > 0))
        return extend(batch, out, rejected=(~ok).tolist(), text_lang=[names[g] if g >= 0 else None for g in guess.tolist()],
                      lang=[names[b] if o else None for b, o in zip(best.tolist(), ok.tolist(), strict=True)],
                      posterior=[float(p[b]) if o else None for p, b, o in zip(post, best, ok.tolist(), strict=True)],
                      **{c: [names[v] if v >= 0 else None for v in values] for c, values in code.items()})

    return map_rows(both, schema, fuse, rows=max(1, CELLS // k))


def identify_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, host, declared, path, lang, posterior, text_lang, rejected) of every page; the text model learns from ``documents``."""
    model = fit_text_model(documents.select("lang", "text"))
    parts = address_parts(F.col("url"))
    rows = pages.select("page_id", F.col("html").alias("text"), declared_markup(F.col("html")).alias("declared"), *[c.alias(n) for n, c in parts.items()])
    return identify(rows, model, html=True).select("page_id", "host", "declared", "path", "lang", "posterior", "text_lang", "rejected")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", host_col: str = "source") -> DataFrame:
    """``docs`` without the rows whose language cannot be told; ``lang_col`` holds the language found.

    The declared language is ``lang_col`` itself, the host ``host_col``; documents have no address.
    Only a row key, the evidence and the text go through Python; the verdict is joined to the
    whole rows by that key. A null or empty text is rejected; null labels and hosts are no
    evidence; repeated rows and ids are judged row by row; very long texts are read whole; other
    columns come back as they are; an empty table gives an empty one.
    """
    keyed = with_row_key(docs, "__id_row")
    model = fit_text_model(keyed.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    host = F.col(host_col).cast("string")
    rows = keyed.select("__id_row", F.col(text_col).alias("text"), F.col(lang_col).alias("declared"), host.alias("host"), host.alias("domain"),
                        F.lit("").alias("suffix"), F.lit(None).cast("string").alias("path"))
    found = stage(identify(rows, model).where("not rejected").select("__id_row", F.col("lang").alias("__id_lang")), "identified_rows")
    return keyed.join(found, "__id_row").select(*[F.col("__id_lang").alias(c) if c == lang_col else F.col(f"`{c}`") for c in docs.columns])
