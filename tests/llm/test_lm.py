import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from corpus import awkward, frame

from credere.llm import lm_score as M

PATH = public_tokenizers.path("piece_bpe_32k.model")


def spelled(lattice, word):
    """The word's probability from a plain recursion over its first pieces."""
    vocab, memo = lattice.vocab, {}
    known = {int(k): int(i) for k, i in zip(vocab.keys, vocab.ids, strict=True)}
    word = M.MARK + word

    def rest(i):
        if i == len(word):
            return 1.0
        if i not in memo:
            total = 0.0
            for j in range(i + 1, min(len(word), i + vocab.longest) + 1):
                piece = known.get(vocab.hash(word[i:j]))
                if piece is not None:
                    total += math.exp(lattice.log[piece]) * rest(j)
                elif j == i + 1:
                    total += math.exp(sum(lattice.log[vocab.bytes[b]] for b in word[i].encode())) * rest(j)
            memo[i] = total
        return memo[i]

    return rest(0)


WORDS = ["the", "thing", "a", "naïve", "日本語", "x☃y", "and,", "antidisestablishmentarianism", "😀", "ñ", "w" * 70]


def test_forward_sums_all_segmentations():
    lattice = M.Lattice(M.vocabulary(PATH), M.vocabulary(PATH).first)
    for w, log in zip(WORDS, lattice.log_p(WORDS), strict=True):
        want = spelled(lattice, w)
        assert (want == 0 and log < -700) or math.isclose(log, math.log(want), rel_tol=1e-9)


def test_expected_uses_are_the_gradient():
    vocab = M.vocabulary(PATH)
    lattice = M.Lattice(vocab, vocab.first)
    for w in ("thing", "x☃y"):
        uses = lattice.expected([w], np.array([2.0]))
        for piece in np.flatnonzero(uses)[:6]:
            p = vocab.first.copy()
            p[piece] *= 1 + 1e-6
            slope = (M.Lattice(vocab, p).log_p([w])[0] - lattice.log_p([w])[0]) / 1e-6
            assert math.isclose(2 * slope, uses[piece], rel_tol=1e-3, abs_tol=1e-6)


def test_weights_are_one_distribution(spark):
    counts = spark.createDataFrame([(b"the", 5), (b"thing", 2), (b" ", 3), (b"held", 0)], "word binary, c long")
    p = M.piece_weights(counts, PATH)
    assert math.isclose(p.sum(), 1.0) and (p >= 0).all() and p[M.vocabulary(PATH).size] > M.vocabulary(PATH).first[-1]


def check(spark, rows, df):
    tokens = [((t or "").encode().lower().split() + [M.END]) for _, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in rows]
    c = Counter(x for w, h in zip(tokens, held, strict=True) if not h for x in w)
    n, v = sum(c.values()), len(c)
    want = sorted((str(r[0]), h, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for r, w, h in zip(rows, tokens, held, strict=True))
    got = M.score_documents(df, PATH).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    return got


def test_scores(spark, monkeypatch):
    rows = awkward() + [(9, "again", "en", "s", 1), (9, "again", "en", "s", 1), (None, "none here", "en", "s", 1)]
    df = frame(spark, rows, ("row", "held", "word"))
    few = check(spark, rows, df)
    monkeypatch.setattr(M, "FREQUENT", 1)      # all words but the end go through the join
    monkeypatch.setattr(M, "ROUNDS", 2)
    same = check(spark, rows, df)
    assert sorted(round(r.score, 6) for r in few) == sorted(round(r.score, 6) for r in same)
    # the score is the lattice's, word by word
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t, *_ in rows], df.schema.names[:5] and "doc_id long, text string, lang string, source string, n_chars long")
    held = docs.selectExpr("pmod(crc32(cast(coalesce(cast(doc_id as string), '') as binary)), 7) = 2 as held", "text")
    p = M.piece_weights(M.word_counts(held), PATH)
    lattice = M.Lattice(M.vocabulary(PATH), p)
    by_id = {r.doc_id: r for r in few}
    for i, t, *_ in random.Random(1).sample(awkward(), 12):
        if i == 9:
            continue
        want = (lattice.log_p([w.decode() for w in (t or "").encode().lower().split()]).sum() + math.log(p[-1])) / math.log(10)
        assert math.isclose(by_id[i].score, want, rel_tol=1e-6)


def test_empty_and_untrained(spark):
    assert M.score_documents(frame(spark, []), PATH).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = M.score_documents(frame(spark, [(held, "a b", "en", "s", 1)]), PATH).collect()[0]
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.base_score) == (True, 3, 0, 0, 0.0)
