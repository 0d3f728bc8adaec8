import zlib

from voxloom.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_toxicity_held_out(spark):
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    held = [(rows[i].score, rows[i].predicted, t) for i, t in labels.items() if rows[i].held_out]
    good, bad = [s for s, _, t in held if t == 0], [s for s, _, t in held if t == 1]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.85, auc
    assert sum(p for _, p, t in held if t == 0) <= 0.05 * len(good)


def test_toxicity_of_awkward_rows(docs, rows, empty):
    model = toxicity.fit([b"you are a%d horrid fool%d and more words" % (i, i) for i in range(200)], [b"you are a%d kind soul%d and more words" % (i, i) for i in range(200)])
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted == 0 for r in out)
    s = toxicity.Savings(model)
    assert model.probability(toxicity._features(__import__("numpy").array([s.top_two(b"what a horrid foolish day")])))[0] > 0.5
    for only in (([], []), ([b"a"], []), ([], [b"a"])):
        assert {r.predicted for r in toxicity.score(docs, toxicity.fit(*only)).collect()} == {int(bool(only[0]))}


def test_language(spark, docs, rows, empty):
    out = {r.doc_id: r for r in queries.op8_langid(spark, SF).collect()}
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(out) == set(truth)
    held = [(out[i].lang_pred, t.lang) for i, t in truth.items() if out[i].held_out and t.lang is not None and out[i].lang_pred != "und"]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    model = langid.fit({"en": [b"the quick brown fox"], "de": ["der schnelle Fuß".encode()]})
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    letters = lambda t: any(c.isalpha() for c in t or "")
    for i, t, *_ in rows:
        own = [r for r in got if r.doc_id == i]
        assert any((r.lang_pred != "und") == letters(t) for r in own)
    assert {r.lang_pred for r in langid.predict(docs, langid.fit({})).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0
    assert [len(p) for p in langid.pieces(b"x" * 10001, 4096)] == [3333, 3334, 3334] and langid.pieces(b"", 10) == []


def test_toxicity_of_more_labels(spark):
    """Held-out labels of sf0.1: AUC, and shares of toxic rows found and of others rejected."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in queries.op7_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, t in held if t == 0], [s for s, _, t in held if t == 1]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.95, auc
    assert sum(p for _, p, t in held if t == 1) >= 0.75 * len(bad) and sum(p for _, p, t in held if t == 0) <= 0.05 * len(good)


def test_numerals_are_no_letters(spark):
    texts = ["½", "²³", "Ⅷ", "①②", "12 !?", None, "", "a½", "ß", "日"]
    model = langid.fit({"en": [b"the quick brown fox"], "de": ["der schnelle Fuß".encode()]})
    out = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.lang_pred == "und" for r in sorted(out, key=lambda r: r.doc_id)] == [True] * 7 + [False] * 3


def test_dictionaries_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(langid, "DICTIONARY_BYTES", 20)
    model = langid.fit({"en": [b"one two", b"far too long to fit", b"", b"three four"], "x": [b"first alone is longer than it all"]})
    assert model.contents == {"en": b"one two\nthree four", "x": b"first alone is longe"}


def test_language_sample_is_that_of_the_smallest_hashes(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(langid, "SAMPLE", 7)
    rows = [(i % 900, "en" if i % 3 else "de" if i % 2 else None, f"text {i % 900}", 1) for i in range(1000)] + [(None, "fr", "bonjour", 1), (5000, "fr", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, n int")
    got = langid.labelled_sample(docs, F.lit(True))
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(23)).alias("h")).collect()}
    for lang in ("en", "de"):
        ids = sorted({r[0] for r in rows if r[1] == lang}, key=lambda i: hashed[i])[:7]
        assert got[lang] == [f"text {i}".encode() for i in ids]
    assert got["fr"] == [b"bonjour"]
