import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from corpus import awkward, frame, prose

from credere.llm import substring_dedup as S


def brute(rows, window=13):
    least = {}
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    big = 1 << 63
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, big), big - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < (big - 1 if i is None else i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def take(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=str)


def deal_all_by_window(monkeypatch, rows):
    every = np.unique(np.concatenate([S.Windows(np.zeros(1, np.int64), [(t or "").encode().split()], 13, 5).seed for _, t, *_ in rows]))
    monkeypatch.setattr(S, "hot_seeds", lambda *_: every)


@pytest.mark.parametrize("hot", [False, True])
def test_matches_brute_force(spark, monkeypatch, hot):
    rng = random.Random(9)
    passage = prose(rng, 60, 3000)
    rows = awkward() + [(i, prose(rng, 25, 2000) + " " + passage + " " + prose(rng, 25, 2000), "en", "s", 1) for i in range(500, 540)]
    rows += [(3000, passage, "en", "s", 1), (3000, prose(rng, 5) + " " + passage, "en", "s", 1), (None, passage, "en", "s", 1), (None, passage, "en", "s", 1)]
    rows += [(4000, "same " * 300, "en", "s", 1), (4001, "same " * 40, "en", "s", 1), (4001, "same " * 40, "en", "s", 1)]
    if hot:  # every seed is dealt by window
        deal_all_by_window(monkeypatch, rows)
    df = frame(spark, rows, ("seed", "id", "start", "spans"))
    assert take(S.dedup_substrings(df)) == brute(rows)


@pytest.mark.parametrize("hot", [False, True])
def test_a_third_of_the_ids_null(spark, monkeypatch, hot):
    """Rows without an id lose what documents with ids hold, each by its own repeats."""
    rng = random.Random(4)
    passages = [prose(rng, 30, 3000) for _ in range(6)]
    rows = [(i if i % 3 else None, f"{prose(rng, 20, 2000)} {passages[i % 6]} {prose(rng, 20, 2000)}", "en", "s", 1) for i in range(240)]
    rows += [(None, rows[3][1], "en", "s", 1)] * 20 + [(9000, rows[3][1], "en", "s", 1)]
    if hot:
        deal_all_by_window(monkeypatch, rows)
    df = frame(spark, rows).repartition(5)
    assert take(S.dedup_substrings(df)) == brute(rows)
    found = S.repeats(df.selectExpr(f"coalesce(doc_id, {S.LAST}) as id", "if(doc_id is null, xxhash64(text) & 2147483647, 0) as mark", "text"))
    # a text of 70 words has 58 windows, each told by its run or by its print
    lists = found.where(f"id = {S.LAST}").selectExpr(f"shiftright(start, {S.MARK}) as mark", f"struct(start & {(1 << S.MARK) - 1}, n, check) as run")
    assert lists.groupBy("mark").agg({"run": "collect_set"}).selectExpr("max(size(`collect_set(run)`))").first()[0] <= 2 * 58


def test_workers_find_the_package_from_any_folder(tmp_path):
    """Operators that are called as library functions ship their own modules."""
    home = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(home)!r})
from credere.session import build_session
from credere.llm.jaccard_join import jaccard_report
from credere.llm.lm_score import score_documents
from credere.llm.queries import tokenizer_path
from credere.llm.substring_dedup import substring_report
docs = build_session("local[2]", shuffle_partitions=2).createDataFrame([(1, "a b c d e " * 9), (2, "a b c d e " * 9)], "doc_id long, text string")
which = sys.argv[1]
rows = substring_report(docs) if which == "3" else jaccard_report(docs) if which == "6" else score_documents(docs, tokenizer_path("piece_bpe_32k.model"))
assert len(rows.collect()) == 2
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for which in "368":
        done = subprocess.run([sys.executable, "-c", code, which], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]


def test_streamed_state_spans_batches(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"a{i} {passage} b{i}", "en", "s", 1) for i in range(200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert take(S.dedup_substrings(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert S.dedup_substrings(frame(spark, [])).collect() == []
    assert take(S.dedup_substrings(frame(spark, [(1, None, None, None, None)]))) == [(1, 0, 0, "")]


def test_sliding_min():
    x = np.random.default_rng(2).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 2, 5, 9):
        assert S.sliding_min(x, w).tolist() == [min(x[i:i + w]) for i in range(50 - w + 1)]
