import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from corpus import awkward, frame, prose

from credere.llm import quality as Q


def rules(text):
    """The counts from their definitions."""
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), sum(line in lines[:i] for i, line in enumerate(lines)), len(covered))


def model(bodies):
    """p(byte after up to four others) by interpolated modified Kneser-Ney, from lists and dictionaries."""
    level = {5: Counter(), **{k: Counter() for k in (1, 2, 3, 4)}}
    for b in bodies:
        seq = b"\n" * 4 + b + b"\n"
        level[5].update(seq[i:i + 5] for i in range(len(b) + 1))
    for k in (4, 3, 2, 1):
        level[k].update(g[1:] for g in level[k + 1])
    discount, context = {}, defaultdict(list)
    for k in (1, 2, 3, 4, 5):
        n = [sum(c == i for c in level[k].values()) for i in range(5)]
        for i in (1, 2, 3):
            discount[k, i] = max(0.1, i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i]) if n[1] and n[2] and n[i] else 0.75
        for g, c in level[k].items():
            context[k, g[:-1]].append(c)

    def p(g):
        k, c = len(g), level[len(g)][g]
        lower = p(g[1:]) if k > 1 else 1 / 256
        counts = context.get((k, g[:-1]))
        if not counts:
            return lower
        return (max(c - discount[k, min(c, 3)], 0) if c else 0) / sum(counts) + sum(discount[k, min(x, 3)] for x in counts) / sum(counts) * lower

    return p


def plain(rows):
    """(perplexity, kept) of each row."""
    by_lang = defaultdict(list)
    for i, r in enumerate(rows):
        by_lang[r[2] or ""].append(i)
    nats, size = {}, {}
    for own in by_lang.values():
        bodies = {i: b" ".join((rows[i][1] or "").encode().lower().split()) for i in own}
        fold = {i: xxhash.xxh3_64_intdigest(b) % 2 for i, b in bodies.items()}
        p = [model([b for i, b in bodies.items() if fold[i] == f]) for f in (0, 1)]
        for i, b in bodies.items():
            seq = b"\n" * 4 + b + b"\n"
            nats[i], size[i] = -sum(math.log(p[1 - fold[i]](seq[j:j + 5])) for j in range(len(b) + 1)) / (len(b) + 1), len(b) + 1
    out = {}
    for own in by_lang.values():
        failed = {i: (c := rules(rows[i][1]))[0] < 10 or 100 * c[4] > 20 * c[0] for i in own}
        bins = sorted(math.floor(nats[i] * 256) for i in own if not failed[i])
        for i in own:
            kept = False
            if not failed[i]:
                q1, q3 = (bins[math.ceil(len(bins) * q / 4) - 1] / 256 for q in (1, 3))
                room = max(q3 - q1, 0.06) * 3 + 5 / math.sqrt(size[i])
                kept = q1 - room <= nats[i] <= q3 + room
            out[i] = (math.exp(nats[i]), failed[i], kept)
    return out


def corpus_rows(seed):
    rng = random.Random(seed)
    rows = awkward(seed)
    rows += [(900 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzQXZ0123456789~^{}", k=9)) for _ in range(80)), "en", "noise", None) for i in range(2)]
    rows += [(None, "again and again and so on and on it goes\n" * 4, None, None, None)] * 3 + [(5, prose(rng, 40), "one of a kind", "s", None)]
    rows += [(i, prose(rng, 300), "en", "s", None) for i in range(1000, 1040)]
    return rows


@pytest.mark.parametrize("frequent", [1 << 21, 1 << 7])
def test_judge_equals_brute_force(spark, monkeypatch, frequent):
    """With 1 << 7, nearly all grams meet their log probability by the shuffle join."""
    monkeypatch.setattr(Q, "FREQUENT", frequent)
    monkeypatch.setattr(Q, "PENDING", 20_000)
    monkeypatch.setattr(Q, "BLOCK_BYTES", 3_000)
    rows = [(i, *r[1:]) for i, r in enumerate(corpus_rows(4))]
    want = plain(rows)
    found = Q.judge(frame(spark, rows, ("row", "g", "id", "low"))).collect()
    assert sorted(r["id"] for r in found) == sorted(want)
    for r in found:
        perplexity, failed, kept = want[r["id"]]
        assert tuple(r[c] for c in Q.COUNTS) == rules(rows[r["id"]][1])
        assert (r["base_failed"], r["kept"]) == (failed, kept), rows[r["id"]]
        assert r["perplexity"] == pytest.approx(perplexity, rel=1e-4)
    noise = [r for r in found if rows[r["id"]][3] == "noise"]
    assert noise and not any(r["kept"] for r in noise)
    assert sum(r["kept"] for r in found) > 60


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = corpus_rows(6)
    found = Q.judge(frame(spark, rows))
    assert found.count() == len(rows)
    assert found.where("id is null").count() == sum(r[0] is None for r in rows)


def test_empty_table(spark):
    assert Q.judge(frame(spark, [])).collect() == []
    only = Q.judge(frame(spark, [(1, None, None, None, None)])).collect()
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in only] == [(0, True, False)]


def test_hashes_do_not_decide_repeats():
    words = [b"w%d" % (i % 7) for i in range(40)]
    assert Q.repeated_words(words) == 40
    assert Q.repeated_words([b"a", b"b", b"c", b"d", b"e"] + [b"x"] + [b"a", b"b", b"c", b"d", b"e"]) == 10
    assert Q.repeated_words([b"%d" % i for i in range(50)]) == 0
