import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from credere.llm import prefix_trie as P

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                      T.StructField("depth", T.StringType()), T.StructField("parent", T.StringType())])
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        block = c - int(c / 20) * 20
        convs[c] = tuple(own.get(c - block, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(n[:len(k)] == k and len(n) == len(k) + 1 for n in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode().split()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(members) if convs[c] == key)
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else -1, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def dialogues(rng, convs=90):
    rows = []
    said = [f"{w} and  more\t{w}" for w in "abcde"] + [None, "", "long " * 3000]
    for c in range(-25, convs):
        if rng.random() < 0.15:
            continue  # absent, as the first of a block may be
        for t in range(rng.randrange(0, 6)):
            turn = rng.choice([t, t, t, 1, None])
            rows.append((c, turn, rng.choice(["user", "user", "assistant", None, ""]), rng.choice(said[:rng.choice([2, 8])])))
    rows += [(7, t, "user", "one of many") for t in range(400)]      # a conversation over several partitions
    rows += [(200 + i, t, "user", f"same {t}") for i in range(60) for t in range(3)]  # copies
    rows += rows[:20]                                                # repeated rows are turns
    rows += [(None, 1, "user", "of no conversation")] * 30
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(4)


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(COLS).collect())


@pytest.mark.parametrize("few", [P.RANK_ROWS, 3])
def test_trie_equals_brute_force(spark, few, monkeypatch):
    """``few`` = 3 ranks nearly all elements by absorbing; small batches make many of them."""
    rows = dialogues(random.Random(few))
    if few == 3:
        rows = [r for r in rows if r[0] is None or r[0] < 30]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert got(P.trie(frame(spark, rows), few=few)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_places_are_an_euler_tour(spark):
    """Arcs have all places from 0 on, and a child lies within its parent."""
    found = P.trie(frame(spark, dialogues(random.Random(2), 40))).collect()
    assert sorted([r["enter"] for r in found] + [r["exit"] for r in found]) == list(range(2 * len(found)))
    at = {(r["conv_id"], r["depth"]): r for r in found}
    for r in found:
        if r["depth"]:
            up = at[r["parent_conv_id"], r["depth"] - 1]
            assert up["enter"] < r["enter"] < r["exit"] < up["exit"]
            assert (r["exit"] - r["enter"] + 1) % 2 == 0


def test_empty_and_turnless(spark):
    assert got(P.trie(frame(spark, []))) == []
    assert got(P.trie(frame(spark, [(None, 1, "user", "x")]))) == []
    rows = [(c, 0, None, None) for c in (1, 2, 3, 4, 5, 6)]  # some lose their only turn to an absent opening
    assert got(P.trie(frame(spark, rows))) == plain(rows)


def test_like_keys_are_told_apart(spark, monkeypatch):
    """Bases under which all keys are alike are found out, and others taken."""
    tried = []

    def weak(attempt, real=P.bases):
        tried.append(attempt)
        return real(attempt) * 0 + (P.PRIMES if attempt == 0 else real(attempt))

    monkeypatch.setattr(P, "powers", lambda base, e, real=P.powers: real(base, e) if (base < P.PRIMES).all() else real(base * 0 + 1, e) * 0)
    monkeypatch.setattr(P, "bases", weak)
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(12) for t in range(3)]
    assert got(P.trie(frame(spark, rows))) == plain(rows)
    assert tried == [0, 1]
