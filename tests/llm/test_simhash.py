import re

import numpy as np
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components, forest
from millrace.llm.simhash import drop_near_copies, near_fingerprints, op10_simhash, simhash_groups


def brute_fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """items: (node, fingerprint); the smallest node reachable of each."""
    root = {n: n for n, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if bin(x ^ y).count("1") <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {n: find(n) for n in root}


def test_fingerprints_and_groups_of_the_corpus(sp, sample):
    documents = sample("documents")
    texts = {r.doc_id: r.text for r in documents.collect()}
    want = brute_components([(i, brute_fingerprint(t)) for i, t in texts.items()])
    rows = op10_simhash(documents).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{brute_fingerprint(t):016x}" for i, t in texts.items()}
    assert {r.doc_id: r.component_id for r in rows} == want


def test_every_distance_up_to_the_radius_is_found(sp):
    rng = np.random.default_rng(2)
    items, node = [], 0
    for centre in rng.integers(0, 1 << 63, 40).tolist():
        for distance in (0, 1, 2, 3, 4, 5, 6):
            bits = rng.choice(64, distance, replace=False).tolist()
            items.append((node, centre ^ sum(1 << b for b in bits)))
            node += 1
    distinct = list({f: n for n, f in reversed(items)}.items())
    signed = [(f - (1 << 64) if f >> 63 else f, n) for f, n in distinct]
    found = near_fingerprints(sp.createDataFrame(signed, "fingerprint long, node long"))
    got = {r.node: r.component for r in components(found).collect()}
    want = brute_components([(n, f) for f, n in distinct])
    assert {n: got.get(n, n) for n in want} == want


def test_large_bucket_in_classes():
    """One bucket with many fingerprints, compared class by class, gives the groups of all at once."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 1 << 62))
    prints = np.unique(np.array([base ^ int(sum(1 << int(b) for b in rng.choice(48, 4, replace=False))) for _ in range(300)], np.uint64))
    import pyarrow as pa

    top = np.full(len(prints), base >> 48, np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(top), pa.array(prints.view(np.int64)), pa.array(np.arange(len(prints)))], names=["bucket", "f", "n"])

    def groups():
        pairs = np.concatenate([np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in simhash._links(2, 4)([batch])])
        return forest(pairs[:, 0], pairs[:, 1], len(prints)).tolist()

    whole = groups()
    before, simhash.VARIANTS = simhash.VARIANTS, 1 << 13
    try:
        assert groups() == whole
    finally:
        simhash.VARIANTS = before
    want = brute_components([(i, int(f)) for i, f in enumerate(prints)])
    # One bucket alone need not show every link, but shows no false one.
    assert all(want[i] == want[r] for i, r in enumerate(whole))


def test_components_of_chains_stars_and_rings(sp):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.component for r in components(sp.createDataFrame(links + links[::-1], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 180)}, 201: 200, 202: 200}
    assert components(sp.createDataFrame([], "a long, b long")).collect() == []


def test_edges(sp, docs, no_docs):
    rows = simhash_groups(docs).collect()
    assert len(rows) == 12
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {(0, 2)}
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    kept = drop_near_copies(docs.withColumnRenamed("source", "text_hash")).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [1, 2, 5, 6, 7, 7, 9]
    assert sum(r.doc_id is None for r in kept) == 2
    assert op10_simhash(no_docs).collect() == [] and drop_near_copies(no_docs).collect() == []


def test_texts_under_one_id_stay_apart(sp):
    """Two texts under one id neither drop one another nor bring their groups together."""
    words = "the quick brown fox jumps over the lazy dog while many small birds sing in tall trees near our old house".split()
    a, b = " ".join(words), " ".join(words[::-1])
    rows = [(7, a, "x"), (7, b, "y"), (8, a, "x"), (9, b, "y"), (5, "something else entirely, of no relation to either of them", "z"), (7, a, "x")]
    df = sp.createDataFrame(rows, "doc_id long, text string, LABEL string")
    assert sorted((r.doc_id, r.LABEL) for r in drop_near_copies(df).collect()) == [(5, "z"), (7, "x"), (7, "y")]
    assert {(r.doc_id, r.component_id) for r in op10_simhash(df).collect()} == {(5, 5), (7, 7), (8, 7), (9, 7)}


def test_clashing_names(sp):
    names = "doc_id long, text string, Text_Hash string, kept_id int, kept_hash int, fingerprint int, label int, least int"
    df = sp.createDataFrame([(1, "a b c d e", "h", 1, 2, 3, 4, 5), (2, "a b c d e", "i", 6, 7, 8, 9, 10)], names)
    kept = drop_near_copies(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d e", "h", 1, 2, 3, 4, 5)]
