"""Language posterior and the whole pipeline against plain Python: every row compared, no Spark, no arrays."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import awkward, frame, prose
from test_jaccard import brute as near_brute
from tokenizers import Tokenizer

import corpus_pipeline
from credere.llm import language_id as L

TRIGRAM_SLOTS = 2 ** 15


def trigrams(text):
    words = re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())
    t = b" " + b" ".join(w.lower() for w in words) + b" " if words else b""
    return [((t[i] * 65536 + t[i + 1] * 256 + t[i + 2]) * 0x9E3779B1 % 2 ** 32) // 2 ** 17 for i in range(len(t) - 2)]


def posterior(train, rows):
    """(language, posterior, text language) or Nones of each (text, declared, path, host, domain, suffix), from (label, text) pairs."""
    langs = sorted({label for label, _ in train if label})
    k = len(langs)
    seen = {label: Counter() for label in langs}
    for label, text in train:
        if label:
            seen[label].update(trigrams(text))
    size = {label: sum(c.values()) + 0.5 * TRIGRAM_SLOTS for label, c in seen.items()}
    score, told = [], []
    for text, *_ in rows:
        grams = trigrams(text)
        score.append([sum(math.log((seen[a][g] + 0.5) / size[a] * TRIGRAM_SLOTS) for g in grams) for a in langs])
        told.append("letterless" if not grams else langs[score[-1].index(max(score[-1]))] if max(score[-1]) > 0 else None)
    judged = [(row, a) for row, a in zip(rows, told, strict=True) if a in langs]
    share = {a: (sum(b == a for _, b in judged) + 1) / (len(judged) + k) for a in langs}

    def prior(row):
        if not any(r[3] == row[3] for r, _ in judged):
            return dict.fromkeys(langs, 1 / k)
        p = share
        for same in (lambda r: r[5] == row[5], lambda r: r[4:] == row[4:], lambda r: r[3:] == row[3:]):
            own = [a for r, a in judged if same(r)]
            p = {a: (own.count(a) + 5 * p[a]) / (len(own) + 5) for a in langs}
        return p

    def declares(at, value, a):
        own = [r for r, b in judged if b == a]
        return (sum(r[at] == value for r in own) + 1) / (len(own) + k + 1)

    out = []
    for row, ll, a in zip(rows, score, told, strict=True):
        p = prior(row)
        known = [(at, row[at]) for at in (1, 2) if row[at] in langs]
        log_p = [s / 3 + math.log(p[b]) + sum(math.log(declares(at, v, b)) for at, v in known) for s, b in zip(ll, langs, strict=True)]
        against = max(log_p) + math.log(k) + len(known) * math.log(k + 1) + (math.log(0.999 / 0.001) if known else 0)
        if a == "letterless" or (a is None and against <= 0):
            out.append((None, None, None))
        else:
            best = max(log_p)
            out.append((langs[log_p.index(best)], 1 / sum(math.exp(x - best) for x in log_p), a))
    return out


@pytest.mark.parametrize("share", [4096, 4])
def test_posterior_of_pages(spark, monkeypatch, share):
    monkeypatch.setattr(L, "HOT_SHARE", share)   # a share of 4: some hosts are broadcast, others joined
    rng = random.Random(12)
    words = {"aa": ["kala", "mika", "tola", "saku"], "bb": ["xuvu", "zuxu", "vuzu", "mika"], "cc": ["örö", "äpä", "kala", "vuzu"]}
    docs = [(i, " ".join(rng.choices(words[a], k=rng.randrange(1, 30))), a if i % 5 else None, "s", 1) for i, a in enumerate(["aa", "bb", "bb", "cc"] * 15)]
    pages, rows = [], []
    for i in range(160):
        a = rng.choice(list(words))
        text = " ".join(rng.choices(words[a] + [rng.choice(words["aa"])], k=rng.choice([0, 1, 2, 9]))) if i % 11 else rng.choice(["123 -", "Qwrt Pfgh", "漢字 仮名"])
        host = rng.choice([f"{a}.one.org", "big.org", "big.org", f"h{i}.two.net", "x.one.org"])
        declared, path = rng.choice([a, a, "aa", "zz", ""]), rng.choice([a, "bb", "qq", ""])
        pages.append((i, f"https://{host}/{path}/{i}" if path else f"https://{host}/page{i}", f"<html lang='{declared}'><p>{text}</p></html>" if declared else f"<p>{text}</p>"))
        rows.append((text, declared, path, host, ".".join(host.split(".")[-2:]), host.split(".")[-1]))
    pages.append((900, None, None))
    rows.append((None, "", "", "", "", ""))
    got = {r.page_id: r for r in L.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), frame(spark, docs)).collect()}
    want = posterior([(a, t) for _, t, a, *_ in docs], rows)
    assert len(got) == len(pages) and {w[0] for w in want} == {"aa", "bb", "cc", None}
    for (i, *_), (lang, p, by_text) in zip(pages, want, strict=True):
        assert (got[i].lang, got[i].text_lang, got[i].rejected) == (lang, by_text, lang is None), (i, rows[i if i < 900 else -1])
        assert p is None and got[i].posterior is None or math.isclose(got[i].posterior, p, rel_tol=1e-6)


def plain_pipeline(docs, items):
    """(doc_id, lang, source, n_tokens, ids, decoded_sha256) after the five stages."""
    found = posterior([(a, t) for _, t, a, *_ in docs], [(t, a, None, s or "", s or "", "") for _, t, a, s, _ in docs])
    docs = [(i, t, lang, s) for (i, t, _, s, _), (lang, *_) in zip(docs, found, strict=True) if lang]

    def key(line):
        return re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))

    held = Counter(k for _, t, *_ in docs for k in {key(x) for x in t.split("\n")})
    docs = [(i, "\n".join(x for x in t.split("\n") if not key(x) or held[key(x)] < 10), a, s) for i, t, a, s in docs]
    groups = near_brute(docs, corpus_pipeline.NEAR)
    docs = [d for d in docs if groups[d[0]][1] == d[0]]

    def words(text):
        return [(re.sub("[A-Z]", lambda c: c[0].lower(), m[0]), m.start(), m.end()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text or "")]

    windows = defaultdict(set)
    for _, t in items:
        w = [x for x, *_ in words(t)]
        for a in range(max(0, len(w) - 10) + 1 if w else 0):
            windows[min(10, len(w))].add(tuple(w[a:a + 10]))
    out, library = [], Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t, a, s in docs:
        w, hit = words(t), set()
        for n, known in windows.items():
            for b in range(len(w) - n + 1):
                if tuple(x for x, *_ in w[b:b + n]) in known:
                    hit.update(range(b, b + n))
        for b in sorted(hit, reverse=True):   # a hit word, and what lies between it and a hit word after it
            t = t[:w[b][1]] + t[w[b + 1][1] if b + 1 in hit else w[b][2]:]
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((i, a, s, len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(decoded.encode()).hexdigest()))
    return out


def test_whole_pipeline(spark, tmp_path):
    rng = random.Random(21)
    items = [(i, prose(rng, 13, 3000)) for i in range(6)] + [(7, "only, three WORDS"), (8, None)]
    rows = awkward(3) + [(600 + k, prose(rng, 40) + " " + items[k % 6][1].upper() + " " + prose(rng, 9), "en", "src0", 1) for k in range(12)]
    rows += [(650, "here are only three words", "en", None, 1), (651, "qzx " * 200, "de", "src1", 1), (652, None, "en", "src1", None), (653, "a\nShared line of many\nb", "de", None, 9)]
    frame(spark, rows, ("html", "lines")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    want = plain_pipeline(rows, items)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"] and 30 < len(want) < len(rows)
    assert sorted(((*r[:4], bytes(r.ids), r.decoded_sha256) for r in got.collect()), key=str) == sorted(want, key=str)
