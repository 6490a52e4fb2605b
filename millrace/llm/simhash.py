"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two 64-bit fingerprints within ``radius`` bits of each other share a value within half the radius of
both. So every fingerprint stands for all variants within half the radius, equal variants meet, and
the pairs that meet are verified.

A variant's leading bits name its bucket. Most variants of a fingerprint share few buckets, so what
is shuffled is one row per fingerprint and bucket; the variants of the bucket are made where they
are compared. Fingerprints that share a variant are linked to the smallest of them, and a task
reports a forest of its links: their number stays below that of the rows, however many fingerprints meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import bytes_of, fresh, over_batches, runs, text_of
from millrace.llm.components import components, forest
from millrace.session import cut_lineage

WIDTH = 64
#: Leading bits that name a bucket.
BUCKET_BITS = 16
#: Variants compared at once, and shingles counted at once.
VARIANTS, SHINGLES = 1 << 19, 1 << 15


def _balls(bits: int, radius: int) -> list[np.ndarray]:
    """For each distance up to ``radius``: all masks of ``bits`` bits that far or nearer, by distance left."""
    exact = [np.array([sum(1 << i for i in c) for c in combinations(range(bits), r)], np.uint64) for r in range(radius + 1)]
    return [np.concatenate(exact[: r + 1]) for r in range(radius + 1)]


def fingerprint(text: bytes, words: int, seed: int) -> int:
    """Majority bits of the XXH64 of all shingles of ``words`` words; 0 without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        counts, total = _bits([xxhash.xxh64_intdigest(joined, seed)]), 1
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - words + 1].tolist()
        ends = ends[words - 1 :].tolist()
        total, counts = len(ends), np.zeros(WIDTH, np.int64)
        digest = xxhash.xxh64_intdigest
        for i in range(0, total, SHINGLES):
            counts += _bits([digest(joined[a:b], seed) for a, b in zip(starts[i : i + SHINGLES], ends[i : i + SHINGLES], strict=True)])
    over = counts * 2 > total
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def _bits(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    each = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8), bitorder="little").reshape(-1, WIDTH)
    return each.sum(axis=0, dtype=np.int64)


def with_fingerprints(df: DataFrame, keys: list[str], text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """The ``keys`` of every row and the ``fingerprint`` (long) of its whole text. ASCII letters are lower-cased."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_of(batch, "text_")
            data, starts = bytes_of(texts)
            found = [fingerprint(data[a:b].tobytes(), words, seed) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            values = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*batch.schema.names[:-1], "fingerprint"])

    rows = df.select(*keys, F.col(text).alias("text_"))
    return over_batches(rows, compute, T.StructType([*rows.schema.fields[:-1], T.StructField("fingerprint", T.LongType())]))


def _links(near: int, radius: int):
    """Links among fingerprints of whole buckets, from rows (bucket, fingerprint, node) in order of bucket."""
    masks = _balls(WIDTH - BUCKET_BITS, near)
    shift = np.uint64(WIDTH - BUCKET_BITS)

    def variants(bucket, prints):
        """Each variant inside its bucket, and the row it comes from."""
        off = np.bitwise_count((prints >> shift) ^ bucket)
        base = (prints & ((np.uint64(1) << shift) - np.uint64(1))) | (bucket << shift)
        made, owner = [], []
        for distance, ball in enumerate(reversed(masks)):
            rows = np.flatnonzero(off == distance)
            made.append((base[rows, None] ^ ball[None, :]).ravel())
            owner.append(np.repeat(rows, len(ball)))
        return np.concatenate(made), np.concatenate(owner)

    def stars(values, owner, prints):
        """Pairs of rows (first of a variant in order, any other of it)."""
        ordered = np.sort(values)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return np.zeros((0, 2), np.int64)
        # A small table keeps out nearly all values that occur once; the rest is looked up.
        table = np.zeros(1 << 20, bool)
        fold = lambda x: (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        table[fold(twice)] = True
        at = np.flatnonzero(table[fold(values)])
        values, owner = values[at], owner[at]
        order = np.lexsort((owner, values))
        values, owner = values[order], owner[order]
        first = np.concatenate([[True], values[1:] != values[:-1]])
        head = owner[np.flatnonzero(first)][np.cumsum(first) - 1]
        pairs = np.stack([head, owner], axis=1)[~first]
        close = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= radius
        pairs = pairs[close]
        keys = np.unique(pairs[:, 0] * len(prints) + pairs[:, 1])
        return np.stack([keys // len(prints), keys % len(prints)], axis=1)

    def compare(bucket, prints, nodes):
        order = np.lexsort((nodes, bucket))
        bucket, prints, nodes = bucket[order], prints[order], nodes[order]
        sizes = np.array([len(m) for m in reversed(masks)])[np.bitwise_count((prints >> shift) ^ bucket)]
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        total = np.add.reduceat(sizes, edges[:-1])
        out = []
        for a, b in runs(total, VARIANTS):
            rows = slice(edges[a], edges[b])
            rounds = int(-(-int(total[a:b].sum()) // (2 * VARIANTS)))
            out.append(_forest_of(bucket[rows], prints[rows], nodes[rows], rounds))
        return np.concatenate(out) if out else np.zeros((0, 2), np.int64)

    def _forest_of(bucket, prints, nodes, rounds):
        found = []
        if rounds <= 1:
            found.append(stars(*variants(bucket, prints), prints))
        else:  # one large bucket: its variants are made in slices of rows and compared class by class
            for k in range(rounds):
                values, owner = [], []
                step = max(1, VARIANTS // len(masks[-1]))
                for i in range(0, len(prints), step):
                    v, o = variants(bucket[i : i + step], prints[i : i + step])
                    mine = (v * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % np.uint64(rounds) == np.uint64(k)
                    values.append(v[mine])
                    owner.append(o[mine] + i)
                found.append(stars(np.concatenate(values), np.concatenate(owner), prints))
        pairs = np.concatenate(found)
        if not len(pairs):
            return np.zeros((0, 2), np.int64)
        ids, place = np.unique(nodes, return_inverse=True)
        root = forest(place[pairs[:, 0]], place[pairs[:, 1]], len(ids))
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return np.stack([ids[moved], ids[root[moved]]], axis=1)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            bucket, prints, nodes = arrays[0].astype(np.uint64), arrays[1].view(np.uint64), arrays[2]
            held.append((bucket, prints, nodes))
            size += len(bucket)
            if size < 1 << 16 or not len(bucket) or held[0][0][0] == bucket[-1]:
                continue
            joined = [np.concatenate(x) for x in zip(*held, strict=True)]
            whole = int(np.searchsorted(joined[0], joined[0][-1]))
            yield _batch(compare(*[x[:whole] for x in joined]))
            held = [tuple(x[whole:] for x in joined)]
            size = len(joined[0]) - whole
        if size:
            yield _batch(compare(*[np.concatenate(x) for x in zip(*held, strict=True)]))

    return link


def _batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])


def near_fingerprints(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints lie within ``radius`` bits, enough to connect all that are linked.

    ``prints``: distinct ``fingerprint`` with its ``node``, both long and not null.
    """
    near = radius // 2
    if radius % 2 or near >= BUCKET_BITS:
        raise ValueError("the radius must be even, and half of it below the bits of a bucket")
    touched = [int(m) for m in _balls(BUCKET_BITS, near)[-1]]
    top = F.shiftrightunsigned("fingerprint", WIDTH - BUCKET_BITS).cast("int")
    buckets = F.explode(F.transform(F.array(*[F.lit(m) for m in touched]), lambda m: top.bitwiseXOR(m)))
    rows = prints.select(buckets.alias("bucket"), "fingerprint", "node")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return over_batches(rows, _links(near, radius), "a long, b long")


def simhash_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """Rows (doc_id, text_hash, fingerprint, component_id): every document's group of near copies.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most ``radius``
    bits. Texts without a word (null, empty, blank) have fingerprint 0, which is linked like any
    other. Rows without an id have a fingerprint but take no part in linking; their component is null. Repeated ids
    and rows are compared by each row's own text. An empty table gives no rows; other columns are not
    read. Fingerprints are computed once and written to the checkpoint folder with the ids.
    """
    rows, prints = _labelled(df, doc_id, text, words, radius, seed)
    named = prints.join(prints.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("fingerprint", "component_id")
    named = rows.join(named, "fingerprint", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return named.select("doc_id", "text_hash", "fingerprint", component.alias("component_id"))


def _labelled(df: DataFrame, doc_id: str, text: str, words: int, radius: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fingerprint), and for each fingerprint of a row with an id its group's ``label`` and ``least`` id.

    The nodes that are linked are fingerprints, not ids, so that two texts under one id do not bring their groups together.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = cut_lineage(with_fingerprints(rows, ["doc_id", "text_hash"], "text", words, seed))
    prints = rows.dropna(subset=["doc_id"]).groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    links = near_fingerprints(prints.select("fingerprint", F.col("fingerprint").alias("node")), radius)
    grouped = components(links).withColumnRenamed("node", "fingerprint")
    return rows, prints.join(grouped, "fingerprint", "left").select("fingerprint", F.coalesce("component", "fingerprint").alias("label"), "least")


def hex_digits(fingerprint: str):
    """16 lower-case hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def drop_near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """The rows of ``df`` that open their group: smallest id, then smallest text hash, one of equal rows.

    Rows without an id stay, and different texts under one id are kept apart. Null, empty and blank texts are near copies of each
    other. Very long texts count as a whole. ``rules`` are those of ``simhash_groups``; an empty table gives no rows, and
    other columns, whatever their names, stay as they are.
    """
    own, id_, first = fresh(df, "text_hash", "kept_id", "kept_hash")
    rows, prints = _labelled(df, doc_id, text, **{"words": 4, "radius": 4, "seed": 42, **rules})
    opening = F.min(F.struct("doc_id", "text_hash")).alias("opening")
    kept = rows.dropna(subset=["doc_id"]).join(prints.select("fingerprint", "label"), "fingerprint").groupBy("label").agg(opening)
    kept = kept.select(F.col("opening.doc_id").alias(id_), F.col("opening.text_hash").alias(first))
    rows = df.withColumn(own, F.xxhash64(F.col(text)))
    opening = rows.join(kept, (F.col(doc_id).cast("long") == F.col(id_)) & (F.col(own) == F.col(first)))
    opening = opening.dropDuplicates([doc_id, own]).select(*df.columns)
    return opening.union(df.filter(F.col(doc_id).isNull()))


def op10_simhash(documents: DataFrame) -> DataFrame:
    return simhash_groups(documents).select("doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id")
