import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from corpus import awkward, frame
from tokenizers import Tokenizer

from credere.llm.bpe import NO_RANK, Bpe, MinTree, bpe_encode, bpe_report, bpe_round_trip, load

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expect(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_matches_the_library(spark, library):
    rows = awkward() + [(900, "x" * 5000 + " " + "ab" * 3000, "en", "s", 1), (900, "x", "en", "s", 1)]
    df = frame(spark, rows, ("ids", "extra"))
    got = bpe_round_trip(df, PATH)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "extra", "n_tokens", "decoded"]
    for r in got.collect():
        ids, decoded = expect(library, r.text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and r.decoded == decoded
    short = {(r.doc_id, r.text): r for r in bpe_encode(df, PATH).collect()}
    for r in got.collect():
        assert short[r.doc_id, r.text].ids == r.ids and short[r.doc_id, r.text].decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    told = {r.doc_id: r for r in bpe_report(frame(spark, awkward()), PATH).collect()}
    for i, t, *_ in awkward():
        ids, decoded = expect(library, t)
        assert told[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert told[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table(spark):
    assert bpe_round_trip(frame(spark, []), PATH).collect() == []


def test_random_unicode(library):
    rng = random.Random(3)
    ranges = [(0, 0x7F), (0x80, 0x24F), (0x300, 0x5FF), (0x2000, 0x2FFF), (0x1F000, 0x1FAFF)]
    texts = ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    bpe = load(PATH)
    for t, ids in zip(texts, bpe.encode_batch(texts), strict=True):
        assert (np.frombuffer(ids, "<u4").tolist(), bpe.decode(ids)) == expect(library, t)


def test_tree_and_batched_trees_agree():
    bpe, rng = Bpe(PATH), random.Random(5)
    words = ["".join(rng.choices("aeinorst", k=rng.randint(1, 64))) for _ in range(300)]
    for w, ids in zip(words, bpe.encode_words(words), strict=True):
        raw = list(w.encode())
        one = [*bpe.inner[raw[:-1]].tolist(), int(bpe.last[raw[-1]])]
        assert bpe.merge(one) == ids


def test_root_is_leftmost_lowest():
    rng = random.Random(6)
    ranks = [rng.choice([3, 5, 7, NO_RANK]) for _ in range(13)]
    tree = MinTree(ranks)
    for _ in range(60):
        i = rng.randrange(13)
        ranks[i] = rng.choice([1, 3, 5, NO_RANK])
        tree.put(i, ranks[i])
        low = min(ranks)
        assert tree.root() == (-1 if low == NO_RANK else ranks.index(low))
    assert MinTree([]).root() == -1
