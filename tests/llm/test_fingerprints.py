import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import fingerprints
from millrace.llm.fingerprints import (
    BREAK, beside_next, digests, fingerprints as with_fingerprints, op13_fingerprints, peel, sketch, subtract, with_differences, with_edits,
    written,
)


def paragraphs(text):
    return {p for p in re.split(BREAK, text or "") if p.strip(" ")}


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


def edited(text, after):
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def signed_hash(text):
    return (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(text.encode(), 42))


def expected(rows):
    """The contract, document by document: (id, text) pairs, each with the one after it."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1] or "")))
    out = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        new = edited(text, after)
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), alike(text, new), alike(text, after)))
    return out


def found(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *(v or 0 for v in r[:1]), r[2], r[3:]))


def test_against_brute_force(sp, docs, sample):
    for df in (docs, sample("documents")):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert ordered(found(op13_fingerprints(df))) == ordered(expected(rows))


@pytest.mark.parametrize("buckets", [1, 2, 7, 500])
def test_neighbours_over_buckets(sp, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice([None, 5, 5, 5, rng.randrange(-50, 50)]), rng.choice(["same", "same", None, "", f"t{i}"])) for i in range(300)]
    df = sp.createDataFrame(rows, "doc_id long, text string")
    near = beside_next(df, "doc_id", {"body": F.coalesce(F.col("text"), F.lit(""))}, buckets=buckets).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1])))
    pairs = [(i, t, u) for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.body, r.next_body) for r in near), key=key) == sorted(pairs, key=key)


def test_edges(sp, no_docs):
    assert op13_fingerprints(no_docs).collect() == []
    one = sp.createDataFrame([(1, "One. Two.\nThree.")], "doc_id long, text string")
    assert found(op13_fingerprints(one)) == expected([(1, "One. Two.\nThree.")])
    blank = [(1, None), (2, ""), (3, " \n \n "), (4, "a")]
    rows = op13_fingerprints(sp.createDataFrame(blank, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.fingerprint, r.near_next) for r in rows if r.doc_id < 3} == {1: ("", 1.0), 2: ("", 1.0)}


def test_equal_texts_equal_fingerprints(sample):
    rows = op13_fingerprints(sample("documents")).join(sample("documents").select("doc_id", "text"), "doc_id").collect()
    by, whole = {}, {}
    for r in rows:
        by.setdefault(r.text, set()).add(r.fingerprint)
        whole.setdefault(r.fingerprint, set()).add(frozenset(paragraphs(r.text)))
    assert all(len(v) == 1 for v in by.values()) and all(len(v) == 1 for v in whole.values())


def pairs_of_sets(seed):
    rng = random.Random(seed)
    for shared, left, right in [(0, 0, 0), (5, 0, 0), (50, 1, 0), (50, 3, 4), (0, 40, 40), (1000, 5, 5), (300, 700, 20), (0, 3000, 0), (9, 2500, 2500)]:
        names = [f"s{rng.random()}" for _ in range(shared + left + right)]
        yield "\n".join(names[: shared + left]), "\n".join(rng.sample(names[:shared], shared) + names[shared + left :])


def differences(sp, texts):
    df = sp.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "id int, a string, b string")
    df = df.withColumns({"x": digests("a"), "y": digests("b")}).withColumns({"p": sketch(F.col("x")), "q": sketch(F.col("y"))})
    return with_differences(df, {"apart": ("x", "y", "p", "q")}).collect()


def same_differences(rows):
    for r in rows:
        x, y = {d.k for d in r.x}, {d.k for d in r.y}
        assert sorted((d.n, d.k) for d in r.apart) == sorted([(1, k) for k in x - y] + [(-1, k) for k in y - x])


def test_differences_are_whole(sp):
    rows = differences(sp, list(pairs_of_sets(1)))
    same_differences(rows)
    assert [len(r.apart) for r in rows] == [0, 0, 1, 7, 80, 10, 720, 3000, 5000]


def test_what_sketches_leave_open_is_compared(sp, monkeypatch):
    monkeypatch.setattr(fingerprints, "RETRIES", 1)
    same_differences(differences(sp, list(pairs_of_sets(2))))


def test_peeling(sp):
    """Few differences are found by subtraction and peeling alone; too many are reported, not guessed."""
    df = sp.createDataFrame([("\n".join(map(str, range(n))), "\n".join(map(str, range(3, n + k))), k) for n in (10, 1000) for k in (0, 2, 4, 200)], "a string, b string, k int")
    rows = df.select("k", peel(subtract(sketch(digests("a")), sketch(digests("b")))).alias("p")).collect()
    for r in rows:
        assert r.p.done == (r.k < 200)
        assert not r.p.done or sorted(d.n for d in r.p.found) == [-1] * r.k + [1] * 3


def test_sketches_are_linear(sp):
    df = sp.createDataFrame([("a\nb\nc", "d\nb", "a\nc", "d")], "a string, b string, c string, d string")
    cells = {c: sketch(digests(c)) for c in "abcd"}
    row = df.select(subtract(cells["a"], cells["b"]).alias("x"), subtract(cells["c"], cells["d"]).alias("y")).first()
    assert row.x == row.y and sum(c.n for c in row.x) == 3


def test_general_form_and_clashing_names(sp):
    df = sp.createDataFrame([(1, "a. b.", "f", "t"), (2, "b. a. a.", "g", "u")], "doc_id long, text string, fingerprint string, _text string")
    rows = with_fingerprints(df).collect()
    assert [r.fingerprint for r in rows] == ["f", "g"] and rows[0].fingerprint_ == rows[1].fingerprint_ != ""
    near = with_edits(df)
    assert near.columns == [*df.columns, "n_chars", "edited", "fingerprint_", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((r.doc_id, r.fingerprint, r["_text"], r.edited, r.near_next) for r in near.collect()) == [
        (1, "f", "t", "a. b.", 1.0),
        (2, "g", "u", "b. aa. b", 1.0),
    ]
    assert df.select(written(sketch(digests("text"))).alias("w")).distinct().count() == 1
