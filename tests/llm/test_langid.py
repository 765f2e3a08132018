import zlib

import numpy as np
from llm_docs import SF_MID, edge, make_docs, nothing  # noqa: F401

from tallyhouse.llm import langid as L
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op6_language_id


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in read_table(spark, SF_MID, "documents").collect()}
    rows = op6_language_id(spark, SF_MID).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out and len(truth[r.doc_id].text) > 40]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in out]) >= 0.99
    assert np.mean([r.rejected for r in rows]) <= 0.005
    assert all(0 <= r.score <= 1 for r in rows)


def test_rejects_what_is_in_no_language(spark):
    model = L.fit(read_table(spark, SF_MID, "documents"))
    for text in ["Привет мир как дела сегодня", "日本語の文章です", "ελληνικά κείμενα εδώ"]:
        lang, p = L.predict_text(text, model)
        assert lang in model.languages and p < model.threshold
    assert L.predict_text("² ½ Ⅷ 12", model) == ("und", 0.0)
    assert L.predict_text("the of and to this is with that", model)[1] > model.threshold


def test_held_out_rows_teach_nothing(spark):
    rows = [(k, "the river and the stone" if k % 2 else "der Fluss und das Haus", "en" if k % 2 else "de", "a")
            for k in range(400)]
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    assert L.fit(make_docs(spark, wrong)).languages == ["de", "en"]


def test_prediction_ignores_lang_source_and_id(spark, edge):  # noqa: F811
    model = L.fit(read_table(spark, SF_MID, "documents"))
    rows = L.predict(edge, model).collect()
    assert len(rows) == edge.count()
    want = sorted(L.predict_text(r.text, model) for r in edge.collect())
    assert sorted((r.lang_pred, r.score) for r in rows) == want
    for r in edge.collect():
        lang, p = L.predict_text(r.text, model)
        if not any(c.isalpha() for c in r.text or ""):
            assert (lang, p) == ("und", 0.0)
        else:
            assert lang in model.languages


def test_accepted(spark, edge, nothing):  # noqa: F811
    model = L.fit(read_table(spark, SF_MID, "documents"))
    kept = L.accepted(edge, model)
    assert kept.columns == edge.columns
    want = [r for r in edge.collect() if L.predict_text(r.text, model)[0] != "und"
            and L.predict_text(r.text, model)[1] >= model.threshold]
    assert sorted(map(str, kept.collect())) == sorted(map(str, want))
    assert L.accepted(nothing, model).collect() == [] and L.predict(nothing, model).collect() == []


def test_without_labels(spark, nothing):  # noqa: F811
    model = L.fit(nothing)
    assert L.predict_text("some text", model) == ("und", 0.0)


def test_subwords():
    assert len(L.subwords(L.letters("ab"))) == 3 + 2 + 1           # " a", "ab", "b "; " ab", "ab "; " ab "
    assert len(L.subwords(L.letters("1 2 !"))) == 0
    assert len(L.subwords(L.letters("a b"))) == 4 + 2              # no run has a blank inside


def test_rejects_latin_script_that_it_has_not_learnt(spark):
    rows = [r for r in read_table(spark, SF_MID, "documents").collect() if r.text and len(r.text) > 40]
    rng = np.random.default_rng(3)
    noise = [" ".join("".join(map(chr, rng.integers(97, 123, rng.integers(2, 10)))) for _ in range(n)) for n in (8, 30, 300) * 20]
    for names in (["de", "en", "fr"], ["de", "en", "es"], ["de", "en"], ["en"]):
        taught = [r for r in rows if r.lang in names and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
        model = L.train([r.text for r in taught], [r.lang for r in taught])
        rejected = lambda texts: np.mean([L.predict_text(t, model)[1] < model.threshold for t in texts])
        assert rejected([r.text for r in rows if r.lang not in names]) >= 0.95
        assert rejected(noise) >= 0.95
        assert rejected([r.text for r in rows if r.lang in names]) <= 0.02


def test_language_of_long_documents_only(spark):
    """Documents beyond the sample's length teach their language too."""
    texts = {"en": "the quiet river runs below the old stone bridge and the town sleeps on", "de":
             "der stille Fluss fließt unter der alten Brücke und die kleine Stadt schläft noch lange weiter"}
    rng = np.random.default_rng(1)
    mixed = lambda lang, n: " ".join(rng.choice(texts[lang].split(), n))
    rows = [(k, mixed("en", 60), "en", "a") for k in range(100)]
    rows += [(1000 + k, mixed("de", 5000), "de", "a") for k in range(100)]
    docs = make_docs(spark, rows)
    assert min(len(t) for _, t, lang, _ in rows if lang == "de") > L.SAMPLE_CHARS
    found = L.predict(docs, L.fit(docs)).collect()
    assert all(r.lang_pred == ("en" if r.doc_id < 1000 else "de") and not r.rejected for r in found)


def test_sample_is_spread_over_long_documents(spark):
    """What stands at the end of a long document is learnt like its beginning."""
    rows = [(k, "anfang wort " * 5000 + "schluss ende " * 5000, "de", "a") for k in range(40)]
    rows += [(100 + k, "start word " * 20, "en", "a") for k in range(40)]
    model = L.fit(make_docs(spark, rows))
    for text in ("anfang wort anfang wort", "schluss ende schluss ende"):
        assert L.predict_text(text, model)[0] == "de"
        assert L.familiarity(L.subwords(L.letters(text)), model) > 0.95
