"""The corpus pipeline: raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a
DataFrame that is written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credere.llm.bpe import bpe_encode
from credere.llm.common import documents, stage
from credere.llm.decontam import remove_leaks
from credere.llm.jaccard_join import Spec, keep_one
from credere.llm.language_id import keep_identified
from credere.llm.line_dedup import dedup_lines
from credere.llm.queries import tokenizer_path

#: Near duplicates share 80 % of their shingles of five words.
NEAR = Spec(n=5, num=80, den=100)


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` for the text as it is now."""
    return changed.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    return _like(docs, keep_identified(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that ten documents or more hold."""
    return _like(docs, dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages of test items."""
    return _like(docs, remove_leaks(docs, documents(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded_sha256): token ids as little-endian unsigned 32-bit integers."""
    coded = bpe_encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("encode", encode)]

#: SQL has no trigram model to tell languages with; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table: (doc_id, lang, source, n_tokens, ids, decoded_sha256).

    Null and empty texts, and others whose language cannot be told, leave in the first stage; null ids, labels and sources
    stay nulls; of repeated rows and near duplicates one document stays, ties to the smaller id; very long texts are
    read whole; an empty table gives an empty result; columns other than these are ignored by the last stage.
    """
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
