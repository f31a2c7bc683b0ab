import random

import duckdb
import numpy as np
import pytest
from corpus import SYLLABLES, awkward, frame

import __spark_entry__ as entry
import corpus_pipeline
from credere.llm import language_id as L
from credere.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_model_is_right_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1").collect()
    model = L.fit_text_model(train.select("lang", "text"))
    ll, n = model.score([L.letters(r.text.encode()) for r in rest])
    right = [model.langs[k] == r.lang for k, r in zip(ll.argmax(axis=1), rest, strict=True)]
    assert np.mean(right) > 0.97 and min(n) > 0


def test_trigram_counts_match_a_loop():
    texts = [b"", b" a ", b" ab cd ", " é ".encode()]
    seen = {}
    for rows, buckets, starts, ends in L.trigram_blocks(texts):
        for i, a, b in zip(range(rows.start, rows.stop), starts, ends, strict=True):
            seen[i] = buckets[a:b].tolist()
    for i, t in enumerate(texts):
        assert seen[i] == [(((t[k] << 16 | t[k + 1] << 8 | t[k + 2]) * 0x9E3779B1) & 0xFFFFFFFF) >> 17 for k in range(len(t) - 2)]


def test_address_and_markup(spark):
    rows = [("https://u@Blog.Example.co.uk:80/fr/1?x", "<HTML class=a lang='de-AT'>"), ("http://one", "<p>"), (None, None), ("mailto:x", "<html>"), ("https://h.org/fra/1", '<html xml:lang="es" lang=es>')]
    df = spark.createDataFrame(rows, "url string, html string")
    got = [tuple(r) for r in df.select(*L.address_parts(L.F.col("url")).values(), L.declared_markup(L.F.col("html"))).collect()]
    assert got[0] == ("blog.example.co.uk", "co.uk", "uk", "fr", "de") and got[1] == ("one", "one", "one", "", "")
    assert got[2] == ("", "", "", "", "") and got[4] == ("h.org", "h.org", "org", "", "es")


def test_evidence_outweighs_a_short_text_and_noise_is_rejected(spark):
    rng = random.Random(2)
    words = {"aa": ["kala", "mika", "tola"], "bb": ["xuvu", "zuxu", "vuzu"]}
    docs = [(i, " ".join(rng.choices(words[k], k=30)), k, "s", 1) for i, k in enumerate(["aa", "bb"] * 40)]
    model = L.fit_text_model(frame(spark, docs).select("lang", "text"))
    url, page = "https://{}.example.org/{}/1", "<html lang='{}'><script>xuvu zuxu</script>{}</html>"
    pages = [(i, url.format("h" + k, k), page.format(k, " ".join(rng.choices(words[k], k=20)))) for i, k in enumerate(["aa", "bb"] * 40)]
    pages += [(900, url.format("haa", "aa"), page.format("aa", "")), (901, None, None), (902, url.format("haa", "aa"), page.format("aa", "kala zuxu")), (902, url.format("hbb", "bb"), page.format("bb", "kala zuxu")),
              (903, "https://new.example.net/", "<p>kala mika"), (904, url.format("haa", "aa"), page.format("aa", "漢字仮名交じり文 " * 9))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = L.identify_pages(df, frame(spark, docs)).collect()
    assert len(got) == len(pages)
    assert all(r.lang == ["aa", "bb"][r.page_id % 2] for r in got if r.page_id < 80)
    by = {(r.page_id, r.host): r for r in got}
    assert by[900, "haa.example.org"].rejected and by[901, ""].rejected and by[904, "haa.example.org"].rejected and by[901, ""].lang is None
    assert by[902, "haa.example.org"].lang == "aa" and by[902, "hbb.example.org"].lang == "bb" and by[903, "new.example.net"].lang == "aa"
    assert model.langs == ["aa", "bb"]


def test_documents_keep_columns_rows_and_order_of_columns(spark):
    rows = awkward() + [(5, "the and thing", None, None, 1), (5, "the and thing", None, None, 1), (None, "the and other thing", "en", None, 1)]
    df = frame(spark, rows, ("host", "row", "declared", "ll"))
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    # rows go that have no letters or a few that no language explains; a text of some length in a known language never does
    texts = [r.text for r in kept.collect()]
    gone = [t for _, t, *_ in rows if t not in texts]
    assert all(not t or len(t.split()) < 20 or not any(s in t.lower() for s in SYLLABLES) for t in gone) and sum(t == "the and thing" for t in texts) == 2
    assert L.keep_identified(frame(spark, [])).collect() == []
    assert L.keep_identified(frame(spark, [(1, "text", None, None, 4)])).collect() == []  # no label, no language


def test_every_label_is_a_language_however_rare(spark):
    rng = random.Random(3)
    common = [(i, " ".join(rng.choices(["kala", "mika", "tola"], k=8)), "aa", "s", 1) for i in range(1500)]
    rare = [(9000 + i, " ".join("".join(rng.choices([chr(0x400 + 20 * i + j) for j in range(6)], k=4)) for _ in range(60)), f"r{i:02}", "s", 1) for i in range(2 * L.LANG_BLOCK + 3)]
    docs = frame(spark, common + rare)
    model = L.fit_text_model(docs.select("lang", "text"))
    assert model.langs == ["aa"] + [r[2] for r in rare] and len(model.blocks) == 3
    counts = np.full((L.BUCKETS, len(model.langs)), L.SMOOTH)
    for _, t, lang, *_ in common + rare:
        for _, buckets, a, b in L.trigram_blocks([L.letters(t.encode())]):
            np.add.at(counts[:, model.langs.index(lang)], buckets[a[0]:b[0]], 1)
    assert np.allclose(np.concatenate([b.value for b in model.blocks], axis=1), np.log(counts / counts.sum(axis=0)))
    kept = {r.doc_id: r.lang for r in L.keep_identified(docs).collect()}
    assert kept == {r[0]: r[2] for r in common + rare}


def test_short_labelled_clean_texts_stay(spark):
    rng = random.Random(4)
    words = {"aa": ["kala", "mika", "tola"], "BB": ["xuvu", "zuxu", "vuzu"]}
    plain = [(i, " ".join(rng.choices(words[k], k=14)), k, "s", 1) for i, k in enumerate(["aa", "BB"] * 1000)]
    noise = "".join(rng.choices("bcdfghjnpqrswy", k=900))
    short = [(5000, "Fjord Wyng", "aa", "s", 1), (5001, "def ghy(p)", "BB", None, 1), (5002, "Bryn Hjqr", "aa", None, 1)]
    gone = [(6000, "Gwyr Pdqs", None, None, 1), (6001, noise, "aa", "s", 1), (6002, "123 ...", "aa", "s", 1)]
    docs = frame(spark, plain + short + gone)
    ll, n = L.fit_text_model(docs.select("lang", "text")).score([L.letters(r[1].encode()) for r in short])
    assert (ll.max(axis=1) <= 0).all() and (n > 0).all()  # the text alone tells nothing
    assert {r.doc_id: r.lang for r in L.keep_identified(docs).collect()} == {r[0]: r[2] for r in plain + short}


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = docs
    for name, fn in corpus_pipeline.STAGES[:-1]:
        out = fn(spark, step, SF)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        step = spark.read.parquet(str(tmp_path / name))
    last = corpus_pipeline.STAGES[-1][1](spark, step, SF)
    whole = entry.queries()["pipeline"](spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect())) and 150 < step.count() < docs.count()


def test_pipeline_stages_take_awkward_tables(spark):
    rows = awkward() + [(None, None, None, None, None), (3, "again and again", "en", "s", 1), (3, "again and again", "en", "s", 1)]
    for _, fn in corpus_pipeline.STAGES:
        fn(spark, frame(spark, rows, ("n", "item")), SF).collect()
        assert fn(spark, frame(spark, []), SF).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = sorted(d[0] for d in res.description)
    want = sorted(tuple(dict(zip([d[0] for d in res.description], r, strict=True))[c] for c in cols) for r in res.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == cols and sorted(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_corpus_queries_state_their_awkward_cases():
    for name, fn in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
        doc = " ".join((fn.__doc__ or "").lower().split())
        assert all(word in doc for word in ("null", "empty", "empty table", "ignored")) and ("very long" in doc or "any length" in doc), name
