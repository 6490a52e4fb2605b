"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a string of ``length`` bytes which also begins earlier in the corpus goes. A
corpus has no suffix array in one place, so equal strings are first brought together: of the
``ANCHOR``-byte grams inside a string the one of least hash is its anchor. Equal strings have equal anchors at
equal places, and neighbouring strings share theirs, so an anchor stands for a run of strings.

1. Runs are dealt by the hash of their anchor, with a hash of the bytes the whole run covers. Of runs
   that cover equal bytes, all but the first repeat it in full.
2. Where runs of one anchor cover different bytes, one of each kind is read again, and the suffix
   array of these stretches, with the common prefixes of neighbours, tells which of their strings are equal.
   The strings of an anchor with very many such runs are dealt by their own hashes instead, and an aggregation
   finds where each begins first, so that no task sorts all surroundings of one passage.
3. What is to be removed is gathered by document.

Each string belongs to one run, so nothing is found twice and nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, bytes_of, fresh, over_batches, runs, small, text_of, with_columns
from millrace.llm.suffix_array import common_prefixes, suffix_array
from millrace.session import cut_lineage

#: Bytes of an anchor.
ANCHOR = 32
#: Text bytes searched for anchors at once, runs combined before they are sent, and text bytes per bucket of runs, about.
CHUNK, HELD, BUCKET = 1 << 20, 1 << 19, 1 << 24
#: Bytes of stretches sorted at once.
SORTED = 1 << 20
#: Bytes of the stretches of one anchor, beyond which its strings are dealt by their hashes; and how often such a hash is spread.
HOT, SPREAD = 1 << 18, 8
#: Place bits in the key that finds the least hash; a chunk is shorter.
PLACE = np.uint64((1 << 24) - 1)
MIXERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each position on, where there are as many."""
    n = len(data) - ANCHOR + 1
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
    mixed = words[:n] * MIXERS[0]
    for i in range(1, ANCHOR // 8):
        mixed += words[8 * i : 8 * i + n] * MIXERS[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    return mixed ^ (mixed >> np.uint64(29))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row, from least-so-far forwards and backwards in blocks."""
    n = len(keys)
    blocks = np.concatenate([keys, np.full(-n % width, ~np.uint64(0))]).reshape(-1, width)
    forwards = np.minimum.accumulate(blocks, axis=1).ravel()
    backwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backwards[: n - width + 1], forwards[width - 1 : n])


def _runs_of(data: np.ndarray, starts: np.ndarray, length: int):
    """Runs in texts laid end to end: ``(anchor hash, covered hash, text, first, strings)`` as arrays."""
    if len(data) < length:
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
    hashes = _hashes(data)
    places = np.arange(len(hashes), dtype=np.uint64)
    at = (_least((hashes & ~PLACE) | places, length - ANCHOR + 1) & PLACE).astype(np.int64)
    sizes = np.diff(starts)
    whole = np.arange(len(at)) + length <= np.repeat(starts[1:], sizes)[: len(at)]
    breaks = np.concatenate([[True], (at[1:] != at[:-1]) | ~whole[:-1] | ~whole[1:]])
    first = np.flatnonzero(breaks & whole)
    stops = np.append(np.flatnonzero(breaks), len(at))
    last = stops[np.searchsorted(stops, first, side="right")]
    raw = data.tobytes()
    digest = xxhash.xxh64_intdigest
    covered = np.fromiter((digest(raw[a:b]) for a, b in zip(first.tolist(), (last + length - 1).tolist(), strict=True)), np.uint64, len(first))
    text = np.searchsorted(starts, first, side="right") - 1
    return [hashes[at[first]], covered, text, first - starts[text], last - first]


def _pieces(data: np.ndarray, starts: np.ndarray, length: int):
    """Texts in groups of about a chunk, ``(first text, bytes, starts, offset)``; longer ones in overlapping pieces."""
    for a, b in runs(np.diff(starts), CHUNK):
        low, high = int(starts[a]), int(starts[b])
        if high - low <= 2 * CHUNK:
            yield a, data[low:high], starts[a : b + 1] - low, 0
            continue
        for first in range(0, high - low, CHUNK):
            part = data[low + first : min(high, low + first + CHUNK + length - 1)]
            yield a, part, np.array([0, len(part)]), first


#: Columns of a run on its way: anchor, covered bytes, document, hash of its text, first string, strings.
FIELDS = (("anchor", "<u8"), ("covered", "<u8"), ("doc", "<i8"), ("hash", "<i8"), ("first", "<i8"), ("strings", "<i4"))


def _ordered(cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Runs by anchor, covered bytes and place, each once; and which open a kind of covered bytes."""
    anchor, covered, doc, text_hash, first, _ = cols
    order = np.lexsort((first, text_hash, doc, covered, anchor))
    cols = [c[order] for c in cols]
    anchor, covered, doc, text_hash, first, _ = cols
    if not len(anchor):
        return cols, np.zeros(0, bool)
    opens = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (covered[1:] != covered[:-1])])
    again = np.concatenate([[False], (doc[1:] == doc[:-1]) & (text_hash[1:] == text_hash[:-1]) & (first[1:] == first[:-1])]) & ~opens
    return [c[~again] for c in cols], opens[~again]


def _packed(cols: list[np.ndarray]) -> bytes:
    """The columns of some runs as one compressed value."""
    raw = b"".join(c.astype(kind).tobytes() for c, (_, kind) in zip(cols, FIELDS, strict=True))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(value: bytes) -> list[np.ndarray]:
    size = int.from_bytes(value[:8], "little")
    raw = pa.decompress(value[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n, at, cols = size // sum(np.dtype(k).itemsize for _, k in FIELDS), 0, []
    for _, kind in FIELDS:
        cols.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return cols


def _sender(length: int, buckets: int):
    """Runs of a partition, combined and packed by bucket; ``settled`` ones already follow an equal one."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0

        def flushed():
            cols, opens = _ordered([np.concatenate(c) for c in zip(*held, strict=True)])
            bucket = np.where(opens, cols[0] >> np.uint64(20), cols[2].astype(np.uint64)) % np.uint64(buckets)
            out = []
            for settled, rows in ((False, np.flatnonzero(opens)), (True, np.flatnonzero(~opens))):
                rows = rows[np.argsort(bucket[rows], kind="stable")]
                edges = np.flatnonzero(np.diff(bucket[rows], prepend=np.uint64(1 << 63), append=np.uint64(1 << 63)))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    out.append((int(bucket[rows[a]]), settled, _packed([c[rows[a:b]] for c in cols])))
            names = ["bucket", "settled", "value"]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            docs, hashes = (batch.column(i).to_numpy() for i in (0, 1))
            data, starts = bytes_of(text_of(batch))
            for a, part, inside, offset in _pieces(data, starts, length):
                anchor, covered, text, first, strings = _runs_of(part, inside, length)
                if len(anchor):
                    held.append([anchor, covered, docs[a + text], hashes[a + text], first + offset, strings])
                    count += len(anchor)
                if count >= HELD:
                    yield flushed()
                    held, count = [], 0
        if held:
            yield flushed()

    return send


def _sorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: runs that repeat an earlier one, and with their anchor the first of each kind where there are several."""

    def found(values, settled):
        def joined(kind):
            parts = [_unpacked(v) for v, s in zip(values, settled, strict=True) if s == kind]
            return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for _, k in FIELDS]

        cols, gone = joined(False), joined(True)
        cols, opens = _ordered(cols)
        gone = [np.concatenate([g, c[~opens]]) for g, c in zip(gone, cols, strict=True)]
        group = np.cumsum(np.concatenate([[False], cols[0][1:] != cols[0][:-1]]))[: len(opens)]
        several = opens & (np.bincount(group, opens)[group] > 1)
        asked = [c[several] for c in cols]
        anchors = np.concatenate([np.zeros(len(gone[0]), np.int64), asked[0].astype(np.uint64).view(np.int64)])
        missing = np.concatenate([np.ones(len(gone[0]), bool), np.zeros(len(asked[0]), bool)])
        rest = [np.concatenate([g, c]).astype(np.int64) for g, c in zip(gone[2:], asked[2:], strict=True)]
        arrays = [*(pa.array(c, pa.int64()) for c in rest[:2]), pa.array((rest[2] << 20) | rest[3]), pa.array(anchors, mask=missing)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "hash", "run", "anchor"])

    bucket, values, settled = None, [], []
    for batch in batches:
        for b, s, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket and values:
                yield found(values, settled)
                values, settled = [], []
            bucket = b
            values.append(v)
            settled.append(s)
    if values:
        yield found(values, settled)


def _reader(length: int, doc_name: str, hash_name: str, text_name: str, asked_name: str):
    """The stretches that runs cover, one row per asked run of a document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = (doc_name, hash_name, asked_name)
            docs, hashes, asked = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
            data, starts = bytes_of(text_of(batch, text_name))
            out = []
            for i, (doc, text_hash, wanted) in enumerate(zip(docs, hashes, asked, strict=True)):
                text = data[starts[i] : starts[i + 1]]
                for row in wanted:
                    first, strings = row["run"] >> 20, row["run"] & 0xFFFFF
                    out.append((row["anchor"], doc, text_hash, row["run"], text[first : first + strings + length - 1].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            if out:
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "doc", "hash", "run", "covered"])

    return read


def repeated(covered: list[bytes], doc: np.ndarray, text_hash: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings inside stretches that also begin earlier: index of the stretch, and first byte in its document.

    The stretches are laid end to end; strings are compared by the suffix array of the whole and the prefixes
    that neighbours in it share. A string lies inside its own stretch, so borders need no marks.
    """
    sizes = np.array([len(c) for c in covered], np.int64)
    text = np.frombuffer(b"".join(covered), np.uint8)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(covered)), sizes)
    inside = np.arange(len(text)) + length <= ends[owner]
    order = suffix_array(text, length)
    order = order[inside[order]]
    same = common_prefixes(text, order, length) >= length
    if not same.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = np.cumsum(~same)
    taken = same | np.append(same[1:], False)
    order, group = order[taken], group[taken]
    at = order - (ends - sizes)[owner[order]] + first[owner[order]]
    ranked = np.lexsort((at, text_hash[owner[order]], doc[owner[order]], group))
    order, group, at = order[ranked], group[ranked], at[ranked]
    later = np.concatenate([[False], group[1:] == group[:-1]])
    return owner[order[later]], at[later]


def _by_class(covered: list[bytes], doc, text_hash, first, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``repeated`` for stretches too many for one array: their strings in classes by hash, one class at a time."""
    strings = sum(len(c) - length + 1 for c in covered)
    classes = -(-strings * length // SORTED)
    for k in range(classes):
        parts, owner, at = [], [], []
        for i, c in enumerate(covered):
            for j in range(len(c) - length + 1):
                if xxhash.xxh64_intdigest(c[j : j + length]) % classes == k:
                    parts.append(c[j : j + length])
                    owner.append(i)
                    at.append(j)
        if parts:
            own, begins = np.array(owner), np.array(at) + first[owner]
            i, where = repeated(parts, doc[own], text_hash[own], begins, length)
            yield own[i], where


def _comparer(length: int):
    """Runs of strings that repeat an earlier one, from stretches in order of anchor."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        held: list[list] = [[], [], [], []]
        size = 0

        def found():
            doc, text_hash, run = (np.array(held[i], np.int64) for i in range(3))
            first = run >> 20
            if size <= 4 * SORTED:
                parts = [repeated(held[3], doc, text_hash, first, length)]
            else:
                parts = _by_class(held[3], doc, text_hash, first, length)
            for owner, at in parts:
                order = np.lexsort((at, owner))
                owner, at = owner[order], at[order]
                opens = np.ones(len(at), bool)
                opens[1:] = (owner[1:] != owner[:-1]) | (at[1:] > at[:-1] + 1)
                begin = np.flatnonzero(opens)
                count = np.diff(np.append(begin, len(at)))
                run_of = (at[begin] << 20) | count
                arrays = [pa.array(x) for x in (doc[owner[begin]], text_hash[owner[begin]], run_of)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "hash", "run"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:4] == last:  # the same place of an equal row
                    continue
                if last and size >= SORTED and row[0] != last[0]:
                    yield from found()
                    held, size = [[], [], [], []], 0
                last = row[:4]
                for column, value in zip(held, row[1:], strict=True):
                    column.append(value)
                size += len(row[4])
        if size:
            yield from found()

    return compare


def _strings(length: int):
    """Every string of stretches: its hash in two halves, and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, doc, text_hash, place, covered = row
                n = len(covered) - length + 1
                raw = b"".join([xxhash.xxh3_128_digest(covered[j : j + length]) for j in range(n)])
                halves = np.frombuffer(raw, "<i8").reshape(-1, 2)
                where = np.arange(n) + (place >> 20)
                arrays = [halves[:, 0], halves[:, 1], np.full(n, doc), np.full(n, text_hash), where]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["high", "low", "doc", "hash", "first"])

    return run


def _spread(stretches: DataFrame, length: int) -> DataFrame:
    """Rows (doc, hash, run): strings of stretches that also begin earlier, compared by 128 bits of hash."""
    strings = over_batches(stretches, _strings(length), "high long, low long, doc long, hash long, first long")
    place = F.struct("doc", "hash", "first")
    earliest = strings.groupBy("high", "low").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    earliest = earliest.select("high", "low", "least", copies.alias("copy"))
    strings = strings.withColumn("copy", F.pmod(F.xxhash64("doc", "hash", "first"), F.lit(SPREAD)).cast("int"))
    later = strings.join(earliest, ["high", "low", "copy"]).filter(place != F.col("least"))
    return later.select("doc", "hash", F.shiftleft("first", 20).bitwiseOR(F.lit(1).cast("long")).alias("run"))


def _remover(length: int, text: str, names: list[str], runs_name: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = bytes_of(text_of(batch, text))
            lists = batch.column(batch.schema.get_field_index(runs_name)).to_pylist()
            kept, spans = [], []
            for i, own in enumerate(lists):
                part = data[starts[i] : starts[i + 1]]
                found = merged(np.array(own or [], np.int64), length)
                keep = np.ones(len(part), bool)
                for a, b in found:
                    keep[a:b] = False
                kept.append(part[keep].tobytes())
                spans.append([{"start": a, "end": b} for a, b in found])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            rest = batch.drop_columns([runs_name])
            yield appended(rest, **{names[0]: pa.array(kept, pa.binary()), names[1]: pa.array(spans, kind)})

    return remove


def merged(found: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal removed byte ranges of runs of strings (first << 20 | number)."""
    if not len(found):
        return []
    found = np.sort(found)
    low = found >> 20
    high = np.maximum.accumulate(low + (found & 0xFFFFF) + length - 1)
    opens = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
    return list(zip(low[opens].tolist(), high[np.append(opens[1:], len(low)) - 1].tolist(), strict=True))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``df`` with ``kept`` (the bytes that stay) and ``removed`` (maximal byte ranges that go, end exclusive).

    A byte goes if a string of ``length`` bytes over it also begins earlier: in a smaller document or
    further left in the same one; copies may overlap, and strings are judged on the whole input. Strings
    do not cross documents. Null and empty texts keep nothing and lose nothing. Rows with one id are in
    order of a hash of their texts, rows without id come last, and rows equal in both are one document with one
    result. An empty table gives no rows; taken column names make the new ones end in an underscore. ``length`` is at
    least ANCHOR.
    """
    if length < ANCHOR:
        raise ValueError(f"strings must have {ANCHOR} bytes at least")
    spark = df.sparkSession
    doc, text_hash, runs_name, asked_name, kept, removed = fresh(df, "doc", "hash", "runs", "asked", "kept", "removed")
    rows = df.withColumns({doc: F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)), text_hash: F.xxhash64(F.col(text))})
    plain = rows.select(F.col(doc).alias("doc"), F.col(text_hash).alias("hash"), F.col(text).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET)
    sent = over_batches(plain, _sender(length, buckets), "bucket int, settled boolean, value binary")
    sent = sent.repartition("bucket").sortWithinPartitions("bucket")
    found = cut_lineage(over_batches(sent, _sorter, "doc long, hash long, run long, anchor long"))
    asked = found.filter("anchor is not null")
    covered = F.sum(F.col("run").bitwiseAND(F.lit(0xFFFFF)) + length - 1)
    hot = cut_lineage(asked.groupBy("anchor").agg(covered.alias("size")).filter(F.col("size") > HOT).select("anchor"))
    n_hot = hot.count()

    def stretches_of(asked: DataFrame) -> DataFrame:
        wanted = asked.groupBy(F.col("doc").alias(doc), F.col("hash").alias(text_hash))
        wanted = wanted.agg(F.collect_list(F.struct("anchor", "run")).alias(asked_name))
        # All columns of the joins are the same, so the texts are shuffled once for all.
        read = rows.join(wanted, [doc, text_hash])
        return over_batches(read, _reader(length, doc, text_hash, text, asked_name), "anchor long, doc long, hash long, run long, covered binary")

    stretches = stretches_of(asked.join(small(hot, n_hot), "anchor", "left_anti") if n_hot else asked)
    stretches = stretches.repartition("anchor").sortWithinPartitions("anchor", "doc", "hash", "run")
    more = over_batches(stretches, _comparer(length), "doc long, hash long, run long")
    if n_hot:
        more = more.union(_spread(stretches_of(asked.join(small(hot, n_hot), "anchor", "left_semi")), length))
    gone = found.filter("anchor is null").select("doc", "hash", "run").union(more)
    gone = gone.groupBy(F.col("doc").alias(doc), F.col("hash").alias(text_hash)).agg(F.collect_list("run").alias(runs_name))
    joined = rows.join(gone, [doc, text_hash], "left").select(*df.columns, runs_name)
    out = with_columns(df, **{kept: "binary", removed: "array<struct<start:long,end:long>>"})
    return over_batches(joined, _remover(length, text, [kept, removed], runs_name), out)


def op5_suffix_dedup(documents: DataFrame) -> DataFrame:
    found = remove_repeats(documents.select("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return found.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
