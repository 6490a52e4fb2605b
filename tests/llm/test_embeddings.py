import numpy as np

from millrace.llm import embedding_dups
from millrace.llm.embedding_dups import links, near_vectors, op2_embeddings

KINDS = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    """(n_links, component) of every vector, one pair at a time."""
    def direction(r):
        v = r[1]
        if r[0] is None or r[2] is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, np.float32).astype(np.float64)

    vectors = [direction(r) for r in rows]
    count, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())) >= least:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return sorted((r[0], count[i], best[find(i)]) for i, r in enumerate(rows) if r[0] is not None)


def clusters(n, seed, dims=16, labels=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        centre = np.random.default_rng(1000 + i % 25).normal(size=dims)
        rows.append((i, [float(np.float32(x)) for x in centre + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.15, 0.6])], i % labels))
    return rows


def result(df):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in op2_embeddings(df).collect() if r.vec_id is not None)


def test_against_all_pairs(sp):
    rows = clusters(400, 1)
    assert result(sp.createDataFrame(rows, KINDS).repartition(4)) == brute(rows)


def test_many_tiles(sp, monkeypatch):
    monkeypatch.setattr(embedding_dups, "TILE", 32)
    rows = clusters(500, 2, dims=6, labels=1)
    assert result(sp.createDataFrame(rows, KINDS).repartition(4)) == brute(rows)


def test_blocks_of_rows_find_every_pair():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(700, 40)), rng.normal(size=(300, 40))
    b[:200] = a[:200] + rng.normal(size=(200, 40)) * 0.1
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    axes = embedding_dups._axes(a.tolist())
    got = {(int(x), int(y)) for i, j in links(a, b, axes, 0.98) for x, y in zip(i, j, strict=True)}
    assert got == {(int(x), int(y)) for x, y in zip(*np.nonzero(unit(a) @ unit(b).T >= 0.98), strict=True)}
    got = {(int(x), int(y)) for i, j in links(np.vstack([a, b]), None, axes, 0.98) for x, y in zip(i, j, strict=True)}
    cosines = unit(np.vstack([a, b]))
    assert got == {(int(x), int(y)) for x, y in zip(*np.nonzero(np.triu(cosines @ cosines.T >= 0.98, 1)), strict=True)}


def test_dense_group_in_blocks():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(1, 32)) + rng.normal(size=(1300, 32)) * 0.01
    found = sum(len(i) for i, _ in links(a, None, {}, 0.98))
    assert found == 1300 * 1299 // 2


def test_edges(sp):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [0.0, 0.0], 0), (5, None, 0),
        (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 1),
        (11, [1.0, 0.0, 0.0], 0), (12, [], 0), (None, [1.0, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [3e38, 0.0], 0), (15, [1e-40, 0.0], 0),
    ]
    df = sp.createDataFrame(rows, KINDS)
    found = near_vectors(df.withColumn("node", df.vec_id)).collect()
    assert len(found) == len(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id)
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, True)]
    assert op2_embeddings(df.filter("false")).collect() == []


def test_exact_threshold(sp):
    rows = [(1, [1.0, 0.0], 0), (2, [3.0, 4.0], 0), (3, [4.0, 3.0], 0)]
    found = near_vectors(sp.createDataFrame(rows, KINDS), least=0.6).collect()
    assert {r.vec_id: r.n_links for r in found} == {1: 2, 2: 2, 3: 2}


def test_corpus(sp, sample):
    rows = [tuple(r) for r in sample("embeddings").select("vec_id", "embedding", "label").limit(600).collect()]
    assert result(sp.createDataFrame(rows, KINDS)) == brute(rows)
