"""Small tables with every awkward case, and plain versions of the operators to hold them against."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

SYLLABLES = "an the on er ti sh ou ble re nd ing wh th ea es le üb eñ çoi ß".split()


def prose(rng: random.Random, words: int, distinct: int = 400) -> str:
    vocab = ["".join(random.Random(i).choices(SYLLABLES, k=1 + i % 3)) for i in range(distinct)]
    out = []
    for _ in range(words):
        w = vocab[min(distinct - 1, int(rng.paretovariate(0.7)) - 1)]
        out.append(w.capitalize() if rng.random() < 0.1 else w)
        if rng.random() < 0.12:
            out[-1] += rng.choice([".", ",", "\n", "\t", " \n\n"])
    return " ".join(out)


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    return " ".join(rng.choice(SYLLABLES) + str(rng.randrange(99)) if rng.random() < share else w for w in words)


def awkward(seed: int = 1) -> list[tuple]:
    """Documents with nulls, blanks, long texts, repeats, copies, near copies, shared lines and passages."""
    rng = random.Random(seed)
    shared = prose(rng, 60, 4000).replace("\n", " ")
    line = "Shared LINE of many \t"
    texts = [None, "", " \t\n ", "\n\n", "word", "two words", "Three short words", "three short words", "a\x0bb\x0cc\rd", "É é é ﬁ Σ ΑΣ   x y \x1c z",
             "<|endoftext|> hi <|startoftext|>", "😀 " * 30]
    texts += [prose(rng, rng.randrange(1, 120)) for _ in range(25)]
    base = prose(rng, 150, 5000)
    texts += [base, base, base.replace(" ", "  "), *[edited(rng, base, s) for s in (0.005, 0.01, 0.02, 0.03, 0.2)]]
    texts += [prose(rng, 30) + " " + shared + " " + prose(rng, 20) for _ in range(4)]
    texts += [prose(rng, 8) + "\n  " + line + "\n" + prose(rng, 8) for _ in range(11)]
    texts += [line + "\n" + line.upper(), prose(rng, 9000, 3000)]
    small = "one two three four five six seven eight nine ten eleven twelve"
    texts += [small, small + " thirteen", small + " thirteen fourteen", "zero " + small]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra: tuple[str, ...] = ()):
    """A table of the rows over several partitions, with further string columns of the given names."""
    schema = T.StructType(DOCS.fields + [T.StructField(c, T.StringType()) for c in extra])
    return spark.createDataFrame([(*r, *["x" for _ in extra]) for r in rows], schema).repartition(3)
