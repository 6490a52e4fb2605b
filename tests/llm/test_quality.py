import numpy as np
import pyarrow as pa

from millrace.llm import quality
from millrace.llm.quality import _cut, _kth_largest, fit, keep_quality, log_weights


def brute(text: bytes, ratio) -> float:
    total = 0.0
    for k, n in enumerate(quality.ORDERS):
        for i in range(len(text) - n + 1):
            gram = int.from_bytes(text[i : i + n], "big") * 0x9E3779B97F4A7C15 & (1 << 64) - 1
            total += ratio[(gram >> (64 - quality.BITS)) + (k << quality.BITS)]
    return total


def test_weights_are_sums_over_all_ngrams():
    ratio = np.append(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.0)
    texts = ["", "ab", "abc", "hello world", "é" * 40, "long text " * 30]
    array = pa.array(texts, pa.large_string())
    want = [brute(t.encode(), ratio) for t in texts]
    assert np.allclose(log_weights(array, ratio), want)
    before, quality.CHUNK = quality.CHUNK, 16
    try:
        assert np.allclose(log_weights(array, ratio), want)
    finally:
        quality.CHUNK = before


def test_kth_largest(sp):
    values = [5, -3, 5, 1 << 40, 0, -(1 << 50), 7]
    df = sp.createDataFrame([(v,) for v in values], "ticks long")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert _kth_largest(df, k) == want


def test_cut_has_the_fewest_errors():
    assert _cut(np.array([1.0, 2.0, 3.0]), np.array([-5.0, -4.0])) == -1.5
    assert _cut(np.array([]), np.array([1.0])) == -np.inf


def corpus(sp, n=120):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        poor = i % 4 == 0
        words = ["".join(rng.choice(list("###$$|%%" if poor else "etaoinsr"), 6)) for _ in range(30)]
        rows.append((i, " ".join(words)))
        if i < n // 2:
            labels.append((i, 0 if poor else 1, 0))
    return sp.createDataFrame(rows, "doc_id long, text string"), sp.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_good_documents_stay_and_poor_ones_go(sp):
    df, labels = corpus(sp)
    assert {r.doc_id for r in keep_quality(df, labels).collect()} == {i for i in range(120) if i % 4}


def test_fit_counts_every_document(sp):
    df, labels = corpus(sp)
    fitted = fit(df, labels)
    counts = np.full((2, quality.BUCKETS), 0.5)
    targets, _ = quality._sample(labels, quality.SAMPLE)
    for r in df.collect():
        for k, n in enumerate(quality.ORDERS):
            text = r.text.encode()
            for i in range(len(text) - n + 1):
                gram = int.from_bytes(text[i : i + n], "big") * 0x9E3779B97F4A7C15 & (1 << 64) - 1
                at = (gram >> (64 - quality.BITS)) + (k << quality.BITS)
                counts[0, at] += 1
                counts[1, at] += r.doc_id in targets
    shares = counts.reshape(2, len(quality.ORDERS), -1)
    logs = np.log(shares / shares.sum(axis=2, keepdims=True)).reshape(2, -1)
    assert np.allclose(fitted.ratio, logs[1] - logs[0])


def test_labelled_documents_of_the_corpus(sp, sample):
    documents, labels = sample("documents"), sample("labels")
    kept = {r.doc_id for r in keep_quality(documents, labels).collect()}
    rows = labels.collect()
    good = [r.doc_id for r in rows if r.quality == 1 and not r.toxic]
    poor = [r.doc_id for r in rows if r.quality == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in poor) <= 0.2 * len(poor)


def test_edges(sp, docs, no_docs):
    labels = sp.createDataFrame([(1, 1, 0), (9, 0, 0), (6, 1, None), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    kept = keep_quality(docs.withColumnRenamed("source", "score"), labels)
    assert kept.columns[-2:] == ["log_weight", "score_"] and kept.count() <= 12
    assert keep_quality(no_docs, labels).collect() == []
    none = labels.filter("false")
    assert keep_quality(docs, none).count() == 12


def test_long_text_after_empty_ones(monkeypatch):
    ratio = np.append(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.0)
    monkeypatch.setattr(quality, "CHUNK", 16)
    texts = ["", "", "a rather long text that takes many pieces " * 4, "", "b"]
    assert np.allclose(log_weights(pa.array(texts, pa.large_string()), ratio), [brute(t.encode(), ratio) for t in texts])
