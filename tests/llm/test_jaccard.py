import random
from itertools import combinations

import pytest
from corpus import awkward, edited, frame, prose

from credere.llm import jaccard_join as J


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, spec):
    """id -> (set size, component)."""
    sets = {i: shingle_set(t, spec.n) for i, t, *_ in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        o = len(sets[a] & sets[b])
        if o and spec.linked(o, len(sets[a]), len(sets[b])):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus():
    rng = random.Random(8)
    rows, at = awkward(), 1000
    for size in (5, 6, 7, 8, 11, 14, 18, 25, 40, 90):
        words = [f"w{rng.randrange(10_000)}" for _ in range(size)]
        rows += [(at + k, " ".join(words[:size - k]), "en", "s", 1) for k in range(4)]
        rows += [(at + 10 + k, " ".join(words + [f"x{j}" for j in range(k)]), "en", "s", 1) for k in range(4)]
        at += 20
    base = prose(rng, 220, 5000)  # copies of copies, and a text with many near copies whose id is not the smallest
    rows += [(3000 + k, edited(rng, base, 0.012), "en", "s", 1) for k in range(15)] + [(3007 + 100, base, "en", "s", 1)]
    for k in range(8):
        base = edited(rng, base, 0.015)
        rows.append((4000 - k, base, "en", "s", 1))
    return rows


@pytest.mark.parametrize("spec", [J.Spec(), J.Spec(5, 80, 100)])
@pytest.mark.parametrize("boundary", [None, 0, 13])
def test_matches_brute_force(spark, monkeypatch, spec, boundary):
    if boundary is not None:
        if spec.n == 5:
            pytest.skip("once is enough")
        monkeypatch.setattr(J, "light_boundary", lambda *_: boundary)
    rows = corpus()
    got = J.jaccard_components(frame(spark, rows, ("n", "a", "comp", "rep")), spec)
    assert {r.id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, spec)


def test_hot_shingles_and_salted_hubs(spark, monkeypatch):
    monkeypatch.setattr(J, "SALT_ROWS", 2)
    monkeypatch.setattr(J, "SHORT_LIST", 3)  # longer lists meet in joins
    monkeypatch.setattr(J, "SENT_IDS", 0)
    monkeypatch.setattr(J, "ROUND_PAIRS", 1)
    rows = corpus()[:70]
    monkeypatch.setattr(J, "common_shingles", lambda *_: J.np.sort(J.shingles(rows[3][1].encode() if rows[3][1] else b"a b c d e", 4)))
    got = J.jaccard_components(frame(spark, rows))
    assert {r.id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, J.Spec())


def test_null_and_repeated_ids(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(None, text, None, None, 1), (None, None, None, None, 1), (2, text, "en", "s", 1), (2, text, "en", "s", 1), (1, text, "en", "s", 1), (5, "", "en", "s", 1), (4, None, "en", "s", 1)]
    df = frame(spark, rows)
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 27, None), (None, 0, None), (2, 27, 1), (2, 27, 1), (1, 27, 1), (5, 0, 5), (4, 0, 4)], key=str)
    kept = J.keep_one(df, J.Spec())
    assert kept.columns == df.columns and sorted((str(r.doc_id) for r in kept.collect())) == ["1", "4", "5", "None", "None"]
    two = [(9, text, "en", "s", 1), (9, text + " more words here", "en", "s", 1), (8, "other", "en", "s", 1)]
    assert {(r.id, r.component_id) for r in J.jaccard_components(frame(spark, two)).collect()} == {(9, 9), (8, 8)}


def test_empty_table(spark):
    assert J.jaccard_components(frame(spark, [])).collect() == []
    assert [tuple(r) for r in J.jaccard_components(frame(spark, [(1, None, None, None, None)])).collect()] == [(1, 0, 1)]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 140)], "a long, b long")
    got = {r.id: r.comp for r in J.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 140: 100}


def test_parity_never_exceeds_the_difference():
    rng = J.np.random.default_rng(5)
    for n, m, o in ((5, 5, 3), (100, 110, 90), (900, 1100, 850), (3, 400, 2)):
        x = rng.integers(0, 2**63, n + m - o).astype(J.np.uint64)
        a, b = J.np.sort(x[:n]), J.np.sort(x[n - o:])
        assert J.parity_distance(J.parity(a), J.parity(b)) <= n + m - 2 * o
