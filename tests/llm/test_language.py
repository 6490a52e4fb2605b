import zlib
from collections import Counter

import numpy as np

from millrace.llm import language
from millrace.llm.language import identify, op7_language, score_texts, train


def brute(text: str, weights: np.ndarray) -> np.ndarray:
    """The likelihood from one n-gram at a time."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    total = np.zeros(weights.shape[1])
    for n, buckets in language._hashed(codes):
        for bucket, count in Counter(buckets.tolist()).items():
            total += weights[bucket] * count
    return total


def test_scores_are_sums_over_all_ngrams():
    rng = np.random.default_rng(1)
    weights = np.vstack([rng.normal(size=(1 << language.BITS, 3)), np.zeros((1, 3))])
    texts = ["a", "", "Zwei Worte", "é😀", "x y " * 50]
    before, language.CHUNK = language.CHUNK, 16
    try:
        cut = score_texts(texts, weights)
    finally:
        language.CHUNK = before
    for text, got, whole in zip(texts, cut, score_texts(texts, weights), strict=True):
        assert np.allclose(got, brute(text, weights)) and np.allclose(whole, brute(text, weights))


def test_training_reads_every_labelled_text(sp):
    df = sp.createDataFrame([("aa", "x"), ("aa", "x"), ("zz", "y"), (None, "x"), ("q", None)], "text string, lang string")
    labels, logs = train(df, "text", "lang")
    assert labels == ["x", "y"]
    counts = np.full(1 << language.BITS, 0.5)
    codes = np.frombuffer(" aa ".encode("utf-32-le"), np.uint32)
    for _, buckets in language._hashed(codes):
        np.add.at(counts, buckets, 2)
    assert np.allclose(logs[0], np.log(counts / counts.sum()))


def test_held_out_accuracy(sp, sample):
    documents = sample("documents")
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = op7_language(documents).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_edges(sp, docs, no_docs):
    rows = op7_language(docs).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    by_text = {r.doc_id: r for r in rows}
    assert all(by_text[i].lang_pred == "und" and by_text[i].score == 0 for i in (2, 3, 4))
    assert not by_text[None].held_out
    assert op7_language(no_docs).collect() == []
    untaught = op7_language(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_clashing_names(sp):
    """Columns named like those the operator adds stay as they are."""
    df = sp.createDataFrame([(1, "the cat", "en", "mine", 7.0), (2, None, "de", "yours", 8.0)], "doc_id long, text string, lang string, Lang_Pred string, score double")
    labels, logs = train(df, "text", "lang")
    found = identify(df, labels, logs)
    assert found.columns == [*df.columns, "lang_pred_", "score_"]
    assert sorted((r.doc_id, r.Lang_Pred, r.score) for r in found.collect()) == [(1, "mine", 7.0), (2, "yours", 8.0)]
    assert {r.doc_id: r["lang_pred_"] for r in found.collect()} == {1: "en", 2: "und"}
