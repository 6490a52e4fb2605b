import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffix_dedup
from millrace.llm.suffix_array import common_prefixes, suffix_array
from millrace.llm.suffix_dedup import _by_class, merged, op5_suffix_dedup, remove_repeats, repeated


def brute(docs, length):
    """docs in order: (bytes kept, removed spans) of each, one string at a time."""
    seen, out = set(), []
    for text in docs:
        data = (text or "").encode()
        keep = np.ones(len(data), bool)
        for p in range(len(data) - length + 1):
            gram = data[p : p + length]
            if gram in seen:
                keep[p : p + length] = False
            seen.add(gram)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(int)))
        out.append((np.frombuffer(data, np.uint8)[keep].tobytes(), [tuple(e) for e in edges.reshape(-1, 2).tolist()]))
    return out


def corpus(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcd ") for _ in range(rng.randint(20, 120))) for _ in range(12)]
    docs = []
    for _ in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 9))]
        docs.append("".join(parts))
    return docs + ["a" * 500, "ab" * 300, "a" * 700, "", "é" * 100, "x\x00y" * 80]


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, rng.integers(2, 6), rng.integers(1, 250)).astype(np.uint8)
    if seed % 3 == 0:
        text = np.tile(text[: max(1, len(text) // 7)], 9)
    data = text.tobytes()
    order = suffix_array(text, 400)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])

    def shared(i, j):
        k = 0
        while max(i, j) + k < len(data) and data[i + k] == data[j + k] and k < 50:
            k += 1
        return k

    assert common_prefixes(text, order, 50).tolist() == [0] + [shared(a, b) for a, b in zip(order, order[1:], strict=False)]


@pytest.mark.parametrize("length", [32, 45, 100])
def test_against_brute_force(sp, length):
    docs = corpus(length)
    rows = remove_repeats(sp.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5), length=length).collect()
    want = brute(docs, length)
    assert {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.removed]) for r in rows} == dict(enumerate(want))


def test_pieces_and_flushes(monkeypatch):
    """The passes inside tasks, with bounds so small that every one is reached."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    monkeypatch.setattr(suffix_dedup, "HELD", 5)
    monkeypatch.setattr(suffix_dedup, "SORTED", 200)
    docs = corpus(9)
    length = 40
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(docs)), pa.int64()), pa.array(range(len(docs)), pa.int64()), pa.array(docs)], names=["doc", "hash", "text"]
    )
    sent = pa.Table.from_batches(list(suffix_dedup._sender(length, 3)([batch]))).sort_by("bucket")
    found = pa.Table.from_batches(list(suffix_dedup._sorter(sent.to_batches()))).to_pylist()
    gone = {}
    asked = {}
    for r in found:
        if r["anchor"] is None:
            gone.setdefault(r["doc"], []).append(r["run"])
        else:
            asked.setdefault(r["doc"], []).append({"anchor": r["anchor"], "run": r["run"]})
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("run", pa.int64())]))
    reading = pa.RecordBatch.from_arrays(
        [pa.array(list(asked)), pa.array(list(asked)), pa.array([docs[d] for d in asked]), pa.array(list(asked.values()), kind)], names=["doc", "hash", "text", "asked"]
    )
    stretches = pa.Table.from_batches(list(suffix_dedup._reader(length, "doc", "hash", "text", "asked")([reading]))).sort_by([("anchor", "ascending"), ("doc", "ascending"), ("run", "ascending")])
    for b in suffix_dedup._comparer(length)(stretches.to_batches()):
        for r in b.to_pylist():
            gone.setdefault(r["doc"], []).append(r["run"])
    want = brute(docs, length)
    assert [merged(np.array(gone.get(d, []), np.int64), length) for d in range(len(docs))] == [w[1] for w in want]


def test_classes_find_what_one_array_finds(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORTED", 2000)
    stretches = [d.encode()[:160] for d in corpus(1) if len(d) > 60]
    n = len(stretches)
    args = (np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), 40)
    one = set(zip(*(x.tolist() for x in repeated(stretches, *args)), strict=True))
    many = {(int(i), int(w)) for owner, at in _by_class(stretches, *args) for i, w in zip(owner, at, strict=True)}
    assert one == many and one


def test_edges(sp, docs, no_docs):
    rows = remove_repeats(docs.withColumnRenamed("source", "kept")).collect()
    assert len(rows) == 12
    long = next(r for r in rows if r.doc_id == 5)
    assert bytes(long["kept_"]) == brute([long.text], 100)[0][0]
    assert all(not r.removed and bytes(r["kept_"]) == (r.text or "").encode() for r in rows if r.doc_id not in (5, 9))
    assert op5_suffix_dedup(no_docs).collect() == []


def test_order_of_documents(sp):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(2, text), (1, "pre " + text), (None, text), (3, text), (3, text), (3, text + "!")]
    found = {(r.doc_id, r.n_bytes): r.n_removed for r in op5_suffix_dedup(sp.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(text)
    assert found == {(1, n + 4): 0, (2, n): n, (3, n): n, (3, n + 1): n, (None, n): n}
    alone = sp.createDataFrame([(3, text), (3, text)], "doc_id long, text string")
    assert [r.n_removed for r in op5_suffix_dedup(alone).collect()] == [0, 0]  # equal rows are one document


def test_corpus(sp, sample):
    documents = sample("documents")
    rows = sorted(documents.collect(), key=lambda r: r.doc_id)
    want = {r.doc_id: (len(w[0]), len(w[1]), hashlib.sha256(w[0]).hexdigest()) for r, w in zip(rows, brute([r.text for r in rows], 100), strict=True)}
    got = {r.doc_id: (r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) for r in op5_suffix_dedup(documents).collect()}
    assert got == want


@pytest.mark.parametrize("hot", [0, 3000])
def test_hot_anchors_are_spread(sp, monkeypatch, hot):
    """A passage in many documents, each with another text around it, is not gathered in one task."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    passage = "".join(chr(97 + i * i % 26) + str(i) for i in range(40))
    docs = corpus(5) + [f"{i * 7919 % 1000:05d}{passage}{i * 104729 % 1000:05d}" for i in range(300)]
    found = remove_repeats(sp.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5))
    monkeypatch.setattr(suffix_dedup, "_spread", None)
    assert {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.removed]) for r in found.collect()} == dict(enumerate(brute(docs, 100)))
    with pytest.raises(TypeError):
        remove_repeats(sp.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
