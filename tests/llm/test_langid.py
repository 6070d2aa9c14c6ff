import zlib

import numpy as np
import pyarrow as pa

from shiftloom.llm import langid, texts

from .conftest import ODD, words

TONGUES = {"xx": "an el ti on re".split(), "yy": "ßu öz ver sch mü".split(), "zz": "qua ixo lhe çõ ja".split()}


def corpus(n=360):
    names = sorted(TONGUES)
    return [(k, words(k, 1 + k % 40, TONGUES[names[k % 3]]), names[k % 3]) for k in range(100, 100 + n)]


def test_logits_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    weights, known = (rng.normal(size=(1 << langid.BUCKET_BITS, *shape)).astype(np.float32) for shape in ((2,), ()))
    model = langid.Model(("a", "b"), weights, np.zeros(2), 1.0, 0.0, known)
    some = [words(k, 30).encode() for k in range(7)] + [b"", b"x"]
    whole = langid.logits(some, model)
    assert np.allclose(whole, np.concatenate([langid.logits([t], model) for t in some]), atol=1e-5)
    monkeypatch.setattr(langid, "SPAN", 11)
    assert np.allclose(whole, langid.logits(some, model), atol=1e-5)
    assert np.allclose([*langid.measured(some, model)[1]], [langid.measured([t], model)[1][0] for t in some], atol=1e-5)


def test_held_out_accuracy_and_rejection(stored):
    rows = corpus() + [(1, "文字 データ 漢字 語学", None), (2, "...", None), (3, None, None)]
    found = {r.doc_id: r for r in langid.report(stored(rows)).collect()}
    assert len(found) == len(rows)
    for doc, _, _ in rows:
        assert found[doc].held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
    held = [(found[d], lang) for d, _, lang in corpus() if found[d].held_out]
    assert np.mean([r.lang_pred == lang for r, lang in held]) > 0.98
    assert np.mean([r.rejected for r, _ in held]) < 0.03
    assert all(0 <= r.score <= 1 for r in found.values())
    assert found[1].rejected and found[1].lang_pred in TONGUES, found[1]
    assert [(found[k].lang_pred, found[k].score, found[k].rejected) for k in (2, 3)] == [("und", 0.0, True)] * 2


def test_odd_rows_and_kept_columns(stored):
    docs = stored(corpus() + [(d, t, None) for d, t in ODD])
    kept = langid.recognised(docs)
    assert kept.schema == docs.schema
    texts_kept = {r.text for r in kept.collect()}
    assert None not in texts_kept and "" not in texts_kept
    assert {t for _, t, _ in corpus() if len(t) > 60} <= texts_kept
    assert langid.report(docs).count() == docs.count()


def test_no_labels(stored):
    assert {r.lang_pred for r in langid.report(stored(ODD)).collect()} == {"und"}
    assert langid.report(stored([], 1)).count() == 0
    assert texts.whole_text(stored(ODD), "doc_id").columns == ["doc_id", "text"]


def test_rejection_is_nearer_to_a_blind_guess():
    weights = np.zeros((1 << langid.BUCKET_BITS, 4), np.float32)
    held = [(k % 4, words(k, 30).encode()) for k in range(200)]
    for _, text in held:
        for _, _, bucket in langid.subwords(langid._joined([text])[0]):
            weights[bucket, 2] += 0.01
    model = langid._calibrated(langid.Model(tuple("abcd"), weights, np.zeros(4), 1.0, 0.0, weights[:, 0]), held, langid.Settings(), np.random.default_rng(1))
    blind = langid.softmax(langid.logits(["文字".encode()], model)).max()
    assert blind < model.threshold <= langid.softmax(langid.logits([t for _, t in held], model)).max(axis=1).max()


#: Written for this test: one sentence of everyday life in languages that the table has, and in others.
OTHERS = {
    "ja": "日本語の文章は漢字とひらがなとカタカナで書かれています。今日は天気がとても良いので散歩に行きました。",
    "ru": "Сегодня утром мы пошли в магазин и купили хлеб, молоко и немного свежих овощей для супа на обед.",
    "pl": "Wczoraj wieczorem poszliśmy do sklepu, żeby kupić chleb, mleko i świeże warzywa na zupę, którą zawsze gotuje moja babcia.",
    "tr": "Dün akşam büyükannemin her zaman yaptığı çorba için ekmek, süt ve taze sebze almak üzere markete gittik.",
}


def test_languages_never_learned_are_rejected_and_mixed_texts_kept(spark):
    docs = texts.table(spark, "/root/testdata/sf0.01", "documents")
    model, rows = langid.fit(docs), docs.where("text is not null and lang is not null").select("lang", "text").collect()
    assert set(model.labels) == {"de", "en", "es", "fr"}
    found, _, rejected = langid.predict(pa.array(OTHERS.values()), model)
    assert rejected.all() and set(found) <= set(model.labels)
    by = {lang: [r.text for r in rows if r.lang == lang] for lang in model.labels}
    mixed = [f"{a} {b}" for one in by for two in by if one < two for a, b in zip(by[one][:20], by[two][:20])]
    assert not langid.predict(pa.array(mixed), model)[2].any()
    assert langid.predict(pa.array([r.text for r in rows]), model)[2].mean() < 0.002
    assert docs.where("text is not null").count() - langid.recognised(docs).count() <= 2
