import random

import numpy as np
import pytest
from corpus import awkward, frame, prose

from credere.llm import decontam as D


def brute(rows, items, window=10):
    """(id, words, hit words, item ids) of every row."""
    wins = {}
    for i, t in items:
        w = D.words_of((t or "").encode())
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t, *_ in rows:
        w = D.words_of((t or "").encode())
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    items = [(i, prose(rng, 14, 2000)) for i in range(12)] + [(50, "Only, three WORDS"), (51, "single"), (52, None), (53, ""), (54, "?!"), (12, prose(rng, 40, 2000)), (12, "a second text of the same item id")]
    items.append((60, items[0][1] + " and more"))
    rows = awkward()
    rows += [(600 + k, prose(rng, 30) + " " + items[k % 12][1].upper().replace(" ", "-") + " " + prose(rng, 5), "en", "s", 1) for k in range(20)]
    rows += [(700, "here are only three words", "en", "s", 1), (701, items[-3][1], "en", "s", 1), (701, items[-3][1], "en", "s", 1), (None, items[3][1], "en", "s", 1)]
    rows += [(702, " ".join([items[1][1]] * 400), "en", "s", 1)]
    return rows, items


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # several blocks of items; shards and pieces far smaller than the documents
        monkeypatch.setattr(D, "BLOCK_WORDS", 100)
        monkeypatch.setattr(D, "SHARD_WORDS", 64)
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.find_leaks(frame(spark, rows, ("hit_spans", "item", "n_words")), bench)
    assert found.columns[:8] == ["doc_id", "text", "lang", "source", "n_chars", "hit_spans", "item", "n_words"]
    got = sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.hit_spans), list(r.hit_items)) for r in found.collect()), key=str)
    assert got == brute(rows, items)


def test_removal_takes_the_words_and_nothing_else(spark):
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.text): [tuple(s) for s in r.hit_spans] for r in D.find_leaks(frame(spark, rows), bench).collect()}
    left = D.remove_leaks(frame(spark, rows), bench)
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = sorted((str(r.doc_id), r.text) for r in left.collect())
    want = []
    for (i, t), spans in found.items():
        if spans:
            at = D.word_spans(t.encode())
            gone = {b for s, e in spans for b in range(at[s][0], at[e - 1][1])}
            t2 = bytes(x for k, x in enumerate(t.encode()) if k not in gone).decode()
        else:
            t2 = t
        want += [(str(i), t2)] * sum((r[0], r[1]) == (i, t) for r in rows)
    assert sorted(out, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {(r.doc_id, len(r.hit_spans)) for r in D.find_leaks(frame(spark, awkward()), bench).collect()} == {(r[0], 0) for r in awkward()}
    assert D.leak_report(frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_index_against_naive_search():
    rng = np.random.default_rng(3)
    runs = [rng.integers(1, 6, rng.integers(1, 40)) for _ in range(60)] + [np.ones(200, np.int64)] * 3
    text = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int64)
    index = D.FmIndex(text, 6)
    order = D.suffix_order(text)
    ends = np.where(text == 0, np.cumsum(text == 0) - 1, text + len(text)).tolist()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: ends[i:])
    for n in (1, 2, 5):
        windows = np.unique(rng.integers(1, 6, (40, n)), axis=0)
        lo, hi = index.search(windows, n)
        for w, a, b in zip(windows, lo, hi, strict=True):
            want = [i for i in range(len(text) - n) if (text[i:i + n] == w).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 11, 300)
    m = D.WaveletMatrix(x, 11)
    at = rng.integers(0, 300, 50)
    for s in range(11):
        assert m.rank(np.full(50, s), at).tolist() == [int((x[:i] == s).sum()) for i in at]
    symbol, rank = m.access(at)
    assert symbol.tolist() == x[at].tolist() and rank.tolist() == [int((x[:i] == x[i]).sum()) for i in at]
