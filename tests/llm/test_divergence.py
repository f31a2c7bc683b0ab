import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus import awkward, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from credere.llm import divergence as D

COLS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows, min_docs, top=50):
    """Every divergence from its definition: dense counts, Python integers."""
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    docs = [(lang or "", source or "", [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t, n in held.items() if n >= min_docs), key=str.encode)
        share = {}
        for group in [None, *sorted({d[1] for d in own})]:
            n = Counter(t for d in own if group in (None, d[1]) for t in d[2])
            den = sum(n[t] for t in kept) + 5 * len(kept)
            share[group] = {t: (n[t], 1 + 10**9 * (n[t] + 5) // den) for t in kept}
        for a in share:
            if a is None:
                continue
            pairs = [(sum(abs(share[a][t][1] - share[b][t][1]) for t in kept), b) for b in share if b not in (None, a)]
            terms = [(share[a][t][1] - share[None][t][1], t) for t in kept if share[a][t][0] and share[a][t][1] > share[None][t][1]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, a, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(COLS).collect())


def test_audit_equals_brute_force(spark):
    rows = awkward(3) + [(None, "Straße STRASSE éa " + "Wort " * 9, "de", "hot", None)] * 40
    assert got(D.audit(frame(spark, rows, ("idx", "n", "ord", "term")), min_docs=3)) == plain(rows, 3)


def test_audit_through_shards_and_tiles(spark, monkeypatch):
    """All terms past the frequent transducer, several shards, several tiles of sources and chunks of terms, small task buffers."""
    for name, value in (("FREQUENT", 4), ("SHARD_WEIGHT", 64), ("TILE", 2), ("CHUNK", 16), ("PENDING", 50), ("KNOWN", 60), ("BITS", 1 << 10)):
        monkeypatch.setattr(D, name, value)
    rng = random.Random(5)
    rows = [(i, prose(rng, 60), rng.choice(["en", "de"]), rng.choice(["a", "b", "c", "d", "e", "é", "f", None]), None) for i in range(60)]
    rows += [(0, "x" * 20_000 + " lang " * 3, "en", "a", None)] * 4
    assert got(D.audit(frame(spark, rows), min_docs=4)) == plain(rows, 4)


def test_audit_of_few_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", None), (3, "one", "en", "b", None)]
    assert got(D.audit(frame(spark, rows), min_docs=2)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert got(D.audit(frame(spark, []))) == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abné", min_size=1, max_size=7), max_size=60))
def test_transducer_gives_lexicographic_ordinals_and_is_minimal(words):
    words = sorted(w.encode() for w in words)
    built = D.Transducer.build([(D.LANGS, *w) for w in words])
    probes = words + [w + b"a" for w in words] + [w[:-1] for w in words if len(w) > 1] + [b"zz"]
    size = np.array([len(w) for w in probes])
    flat = np.frombuffer(b"".join(probes) + b" ", np.uint8).astype(np.int64)
    found = built.ordinals(np.full(len(probes), D.LANGS), flat, np.cumsum(size) - size, size).tolist()
    assert found == [words.index(w) if w in words else -1 for w in probes]
    endings = {frozenset(w[i:] for w in words if w.startswith(p)) for q in words for i in range(len(q) + 1) for p in [q[:i]]}
    assert len(built.final) == (len(endings) if words else 0) + 2  # the start, and a dead state


@pytest.mark.parametrize(("a", "den"), [(5, 5), (1, 3), (10**12, 10**12 + 7), (7, 2**53 - 1), (2**53 - 9, 2**53 - 1)])
def test_long_division_is_exact(a, den):
    assert D.long_division(np.array([a]), np.array([den])).tolist() == [1 + 10**9 * a // den]
