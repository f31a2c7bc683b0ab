from collections import Counter

import numpy as np
import pytest
from corpus import awkward, frame

from credere.llm.line_dedup import PerfectHash, Shard, dedup_lines, line_key
from credere.llm.line_dedup import _build_shard


def brute(rows, min_docs, min_chars):
    keys = [(line, line_key(line.encode()).decode()) for _, t, *_ in rows for line in (t or "").split("\n")]
    docs = Counter(k for _, t, *_ in rows for k in {line_key(x.encode()).decode() for x in (t or "").split("\n")})
    gone = {k for _, k in keys if len(k) >= min_chars and docs[k] >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if line_key(x.encode()).decode() not in gone]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_docs", "min_chars"), [(10, 1), (2, 4), (1, 0)])
def test_matches_brute_force(spark, min_docs, min_chars):
    rows = awkward() + [(7, "again", None, None, 5), (7, "again", None, None, 5), (None, "Shared line of many", None, None, 1), (None, None, None, None, None)]
    df = frame(spark, rows, ("h1", "shard", "n_lines", "id"))
    got = dedup_lines(df, min_docs=min_docs, min_chars=min_chars)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "h1", "shard", "n_lines", "id", "n_dropped"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == brute(rows, min_docs, min_chars)


def test_hot_line_and_empty_table(spark):
    rows = [(i, f"everywhere\nown {i}\neverywhere", "en", "s", 1) for i in range(300)]
    got = dedup_lines(frame(spark, rows)).collect()
    assert {(r.text, r.n_dropped) for r in got} == {(f"own {i}", 2) for i in range(300)}
    assert dedup_lines(frame(spark, [])).collect() == []


def test_rows_without_ids_do_not_share_their_lines(spark, monkeypatch):
    """Each row's list of dropped lines is its own, whether a third of the ids are null or all are alike."""
    import credere.llm.line_dedup as L
    sizes = []
    real = L.common_lines

    def watched(*args, **kw):
        found = real(*args, **kw)
        sizes.extend(r[0] for r in found.selectExpr("size(h1)").collect())
        return found

    monkeypatch.setattr(L, "common_lines", watched)
    rows = [(None if i % 3 else i, "".join(f"shared {j}\n" for j in range(20)) + f"own {i}", "en", "s", 1) for i in range(90)]
    rows += [(7, f"repeated id {i}\nshared 1", "en", "s", 1) for i in range(30)]
    df = frame(spark, rows)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(df).collect()), key=str)
    assert got == brute(rows, 10, 1)
    assert max(sizes) == 20


def test_perfect_hash_is_minimal():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-2**63, 2**63, (2, 20_000))
    h1[:5], h2[:5] = 3, [1, 2, 3, 4, 5]
    found = PerfectHash.build(h1, h2)
    assert sorted(found.index(h1, h2)) == list(range(len(h1)))
    n = rng.integers(1, 90, len(h1))
    row = _build_shard(pa.table({"shard": np.zeros(len(h1), np.int64), "h1": h1, "h2": h2, "n": n})).to_pylist()[0]
    assert (Shard(row).count(h1, h2) == n).all()
    other = rng.integers(-2**63, 2**63, (2, 5_000))
    assert (Shard(row).count(*other) == 0).mean() > 0.999


def test_keys_no_level_separates():
    one = np.zeros(3, np.int64)
    found = PerfectHash([], np.array([[0, 1], [0, 2], [0, 3]]))
    assert found.index(one, np.array([1, 2, 9])).tolist() == [0, 1, -1]
