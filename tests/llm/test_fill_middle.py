import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fill_middle
from millrace.llm.boundaries import Bitmap, BoundarySet, Listed, Runs, container
from millrace.llm.fill_middle import Cutter, fill_in_middle, op11_fill_middle, restored
from millrace.llm.queries import ORACLES


def plainly(doc_id, text):
    """The contract, word for word."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(
    "low, kind",
    [
        (np.arange(3, 60_000), Runs),
        (np.arange(0, 7000, 3), Listed),
        (np.flatnonzero(np.random.default_rng(1).random(1 << 16) < 0.4), Bitmap),
        (np.array([0]), Listed),
        (np.array([0, 1, 2, 5, 6, 7, 8, 65535]), Runs),
        (np.array([63, 64, 127, 128, 65535]), Listed),
        (np.arange(1 << 16), Runs),
    ],
)
def test_containers(low, kind):
    held = container(low)
    assert isinstance(held, kind)
    assert [held.select(k) for k in range(0, len(low), 7)] == low[::7].tolist()
    assert held.select(len(low) - 1) == low[-1]
    if len(low) > 4096:
        assert [Bitmap(low).select(k) for k in range(0, len(low), 11)] == low[::11].tolist()


def test_select_over_containers_and_blocks():
    rng = np.random.default_rng(2)
    dense = np.flatnonzero(rng.random(200_000) < 0.5)
    offsets = np.concatenate([dense, np.arange(300_000, 390_000), 1_000_000 + np.sort(rng.choice(10**6, 500, replace=False))])
    for size in (1, 1000, 70_000, len(offsets)):
        if size == 1:
            some = offsets[:3000]
            blocks = [some[i : i + 1] for i in range(len(some))]
        else:
            some = offsets
            blocks = [some[i : i + size] for i in range(0, len(some), size)]
        found = BoundarySet([*blocks, some[:0]])
        assert len(found) == len(some)
        assert all(found.select(k) == some[k] for k in range(0, len(some), 97))
    with pytest.raises(IndexError):
        BoundarySet([]).select(0)


def test_cutter_over_blocks(monkeypatch):
    text = "Straße 😀 abc,def\n" * 50 + "x" * 100 + "😀" * 9
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    data = np.frombuffer(text.encode(), np.uint8)
    for block in (1, 2, 7, 64, 1 << 20):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        cutter = Cutter(data)
        assert len(cutter.ends) == len(units)
        for k in (0, 1, 2, 3, 17, len(units) // 2, len(units) - 1, len(units)):
            before = "".join(units[:k])
            assert cutter.after(k) == (len(before), len(before.encode()))


def test_against_brute_force(sp, docs, no_docs, sample):
    more = sp.createDataFrame(
        [(100 + i, t) for i, t in enumerate(["<P>", "a<S>b", "x <M", "<<S", "<S", ">", "\0 a", "é", "a" * 70_000, "é1" * 70_000, "<P<S<M> " * 3])],
        "doc_id long, text string",
    )
    for df in (docs.select("doc_id", "text"), more, sample("documents").select("doc_id", "text")):
        rows = fill_in_middle(df).withColumn("back", restored()).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim) == plainly(r.doc_id, r.text)
            assert r.back == (r.text or "")
    digests = op11_fill_middle(more).collect()
    assert all(r.restored_sha256 == hashlib.sha256(t.encode()).hexdigest() for r in digests for t in [dict(more.collect())[r.doc_id]])
    assert op11_fill_middle(no_docs).collect() == []


def test_forms_appear(sample):
    forms = {r.form for r in op11_fill_middle(sample("documents")).select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"} and "op11_fill_middle" in ORACLES


def test_clashing_names(sp):
    df = sp.createDataFrame([(1, "a b c", "n", "f", "k")], "doc_id long, text string, N string, fim string, key string")
    found = fill_in_middle(df)
    assert found.columns == ["doc_id", "text", "N", "fim", "key", "n_", "form", "prefix_chars", "middle_chars", "fim_"]
    row = found.select("N", "n_", "fim", "key", "fim_", restored(F.col("fim_")).alias("back")).first()
    assert (row.N, row["n_"], row.fim, row.key, row.back) == ("n", 5, "f", "k", "a b c")


def test_oracle(sp, sample):
    import check_oracle

    folder = "/root/testdata/sf0.001"
    assert check_oracle.compare(op11_fill_middle(sample("documents")), check_oracle.duck(folder), ORACLES["op11_fill_middle"]) is None
