import zlib

import numpy as np
import pytest

from millrace.llm import sharding
from millrace.llm.sharding import communication_matrix, hypergeometric, op1_shards, uniform_shards


def test_hypergeometric_moments_and_limits():
    rng = np.random.default_rng(3)
    draws = np.array([hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(draws.mean() - 6) < 0.15 and abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    assert hypergeometric(rng, 0, 5, 3) == 0 and hypergeometric(rng, 5, 0, 3) == 3
    big = hypergeometric(rng, 10**12, 10**13, 10**9)
    assert abs(big - 10**9 / 11) < 10**6


def test_matrix_adds_up():
    rows, room = [5, 0, 17, 3], [9, 8, 8]
    matrix = communication_matrix(rows, room, 1)
    assert matrix.sum(axis=1).tolist() == rows and matrix.sum(axis=0).tolist() == room
    with pytest.raises(ValueError):
        communication_matrix([1] * (sharding.MATRIX_CELLS + 1), [1], 1)


def test_sizes_slots_and_nothing_lost(sp):
    df = sp.range(0, 1003).selectExpr("id", "id % 3 as shard", "id as of_shard", "id as block").repartition(5)
    rows = uniform_shards(df, 24, block_rows=16).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard_"], []).append(r["slot"])
    assert sorted(r["id"] for r in rows) == list(range(1003))
    assert {len(v) for v in by.values()} == {41, 42}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_every_place_is_equally_likely(sp):
    seen = np.zeros((6, 6))
    df = sp.range(0, 6, 1, 2)
    for seed in range(60):
        for r in uniform_shards(df, 2, seed=seed).collect():
            seen[r["id"], r["shard"] * 3 + r["slot"]] += 1
    assert (abs(seen - 10) < 12).all()


def test_edges(sp, docs, no_docs):
    rows = op1_shards(docs).collect()
    assert len(rows) == 12 and {r.law for r in rows} == {"rows"}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id != 7}
    for r in rows:
        if r.doc_id in texts:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    assert op1_shards(no_docs).collect() == []
