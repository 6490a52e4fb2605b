"""Quality classifier by importance resampling.

Two generative models over hashed n-grams of bytes are fitted: one on target texts, one on the raw
corpus. A document's importance weight is the product of the models' ratio over its n-grams; a
sample of k documents without replacement, with these weights, is the k largest values of log weight
plus Gumbel noise.

The raw model counts every n-gram of every document. The target model counts those of at most
``sample`` labelled target documents. The size k is the number of documents whose weight is on the
target side of the cut that best parts the labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, bytes_of, fresh, over_batches, runs, text_of, with_columns
from millrace.session import cut_lineage

#: n-gram lengths in bytes and the logarithm of the number of buckets for each.
ORDERS, BITS = (3, 5), 15
BUCKETS = len(ORDERS) << BITS
#: Bytes whose n-grams are held at once.
CHUNK = 1 << 19
#: Labelled rows the target model and the cut are fitted on, at most (16 bytes each on the driver).
SAMPLE = 20_000
SEED = 20_240_607


@dataclass(frozen=True)
class Fitted:
    """Log ratio of target and raw probability by bucket, and the lowest perturbed weight that stays (none: nothing stays)."""

    ratio: np.ndarray
    least: int | None


def _grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of texts laid end to end, one row per length; ``BUCKETS`` where there is none."""
    found = np.full((len(ORDERS), len(data)), BUCKETS, np.int32)
    if not len(data):
        return found
    ends = np.repeat(starts[1:], np.diff(starts))
    left = ends - np.arange(len(data))
    mixed = np.zeros(len(data), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        mixed = (mixed[:size] << np.uint64(8)) | data[n - 1 :]
        if n in ORDERS:
            k = ORDERS.index(n)
            hashed = mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
            found[k, :size] = np.where(left[:size] >= n, hashed.astype(np.int32) + (k << BITS), BUCKETS)
    return found


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in bounded groups: ``(first, last, bytes, starts)``. A longer text comes alone, in pieces."""
    data, starts = bytes_of(texts)
    over = max(ORDERS) - 1
    for a, b in runs(np.diff(starts), CHUNK):
        low, high = int(starts[a]), int(starts[b])
        if high - low <= 2 * CHUNK:
            yield a, b, data[low:high], starts[a : b + 1] - low
            continue
        for first in range(low, high, CHUNK):
            # The overlap completes n-grams that begin before the cut; those after it are the next piece's.
            yield a, b, data[first : min(high, first + CHUNK + over)], np.array([0, min(high - first, CHUNK + over)])


def _own(found: np.ndarray, size: int) -> np.ndarray:
    """Leaves out the n-grams that begin in the overlap with the next piece."""
    return found[:, :CHUNK] if size > 2 * CHUNK else found


def _vectors(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    sizes = bytes_of(texts)[1]
    for a, b, data, starts in _chunks(texts):
        found = _own(_grams(data, starts), int(sizes[b] - sizes[a]))
        yield a, b, found, np.minimum(starts, found.shape[1])


def _counter(targets):
    """Counts per model (0 raw, 1 target) and bucket of a partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            texts = text_of(batch)
            ids = batch.column(0).to_pylist()
            chosen = np.array([i in targets.value for i in ids], bool)
            for a, b, found, starts in _vectors(texts):
                held[0] += np.bincount(found.ravel(), minlength=BUCKETS + 1)
                wanted = np.repeat(chosen[a:b], np.diff(starts))
                if wanted.any():
                    held[1] += np.bincount(found[:, wanted].ravel(), minlength=BUCKETS + 1)
        for model in (0, 1):
            at = np.flatnonzero(held[model, :-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), model, np.int32)), pa.array(at.astype(np.int32)), pa.array(held[model, at])],
                names=["model", "bucket", "n"],
            )

    return count


def log_weights(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """The sum of log ratios over each text's n-grams. ``ratio`` has a zero for "no n-gram" at its end."""
    total = np.zeros(len(texts))
    for a, b, found, starts in _vectors(texts):
        each = ratio[found].sum(axis=0)
        filled = np.flatnonzero(np.diff(starts))
        if len(filled):
            total[a + filled] += np.add.reduceat(each, starts[:-1][filled])
    return total


def _weigher(ratio, text: str, weight: str):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(log_weights(text_of(batch, text), ratio.value), pa.float64())
            yield appended(batch, **{weight: values})

    return weigh


def weighted(df: DataFrame, ratio: np.ndarray, text: str = "text", weight: str = "log_weight") -> DataFrame:
    """``df`` with the log importance weight of each text; 0 for a null or empty text."""
    shared = df.sparkSession.sparkContext.broadcast(np.append(ratio, 0.0))
    return over_batches(df, _weigher(shared, text, weight), with_columns(df, **{weight: "double"}))


def gumbel(*keys: Column) -> Column:
    """Gumbel noise that depends on the row alone, so that a task run again draws the same."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(unit))


def _sample(labels: DataFrame, sample: int) -> tuple[frozenset, frozenset]:
    """Ids of target and of poor documents among the first ``sample`` labelled ones in hash order.

    Quality 1 makes a target and quality 0 a poor document; an id labelled both ways is poor. A toxic
    document of quality 1 is neither: the target model must not learn from it.
    """
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")
    each = labels.dropna(subset=["doc_id", "quality"]).groupBy("doc_id")
    each = each.agg(F.min("quality").alias("quality"), F.max(toxic).alias("toxic"))
    rows = each.orderBy(F.xxhash64(F.lit(SEED), F.col("doc_id")), "doc_id").limit(sample).collect()
    targets = frozenset(r.doc_id for r in rows if r.quality == 1 and not r.toxic)
    return targets, frozenset(r.doc_id for r in rows if r.quality == 0)


def _cut(targets: np.ndarray, others: np.ndarray) -> float:
    """The log weight that parts the two with the fewest errors, in the middle of the gap it lies in."""
    if not len(targets):
        return -np.inf
    if not len(others):
        return float(targets.min())
    values = np.unique(np.concatenate([targets, others]))
    lost = np.searchsorted(np.sort(targets), values)
    passed = len(others) - np.searchsorted(np.sort(others), values)
    best = int(np.argmin(lost + passed))
    return float((values[best] + values[best - 1]) / 2) if best else float(values[0])


def ticks(score: Column) -> Column:
    """A score in steps of 2^-20, the resolution at which the sample is cut."""
    return F.floor(score * F.lit(float(1 << 20))).cast("long")


def _kth_largest(scores: DataFrame, k: int) -> int:
    """The k-th largest of the long column ``ticks``, exactly: it is fixed 16 bits at a time.

    Each round brings at most 65,536 counts to the driver.
    """
    prefix, rest = 0, k
    for shift in (48, 32, 16, 0):
        if shift < 48:
            scores = scores.filter(F.shiftright("ticks", shift + 16) == prefix)
        rows = scores.groupBy(F.shiftright("ticks", shift).alias("digit")).count().collect()
        for row in sorted(rows, key=lambda r: -r.digit):
            if rest <= row["count"]:
                prefix = row.digit
                break
            rest -= row["count"]
    return prefix


def fit(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Fitted:
    """The models and the cut for ``resample``; ``df`` needs doc_id and text, ``labels`` doc_id, quality and toxic."""
    spark = df.sparkSession
    rows = df.select("doc_id", "text")
    targets, others = _sample(labels, sample)
    if not targets:
        return Fitted(np.zeros(BUCKETS), -(1 << 63))
    shared = spark.sparkContext.broadcast(targets)
    counted = over_batches(rows, _counter(shared), "model int, bucket int, n long")
    table = counted.groupBy("model", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((2, BUCKETS), 0.5)
    counts[table["model"].to_numpy(), table["bucket"].to_numpy()] += table["n"].to_numpy()
    shares = counts.reshape(2, len(ORDERS), 1 << BITS)
    logs = np.log(shares / shares.sum(axis=2, keepdims=True)).reshape(2, BUCKETS)
    ratio = logs[1] - logs[0]
    scores = weighted(rows, ratio)
    noisy = F.col("log_weight") + gumbel("doc_id", F.xxhash64("text"))
    scores = cut_lineage(scores.select("doc_id", "log_weight", ticks(noisy).alias("ticks")))
    wanted = [(i, True) for i in targets] + [(i, False) for i in others]
    marks = F.broadcast(spark.createDataFrame(wanted, "doc_id long, good boolean"))  # at most ``sample`` rows
    seen = scores.join(marks, "doc_id").select("good", "log_weight").toArrow()
    good = seen["good"].to_numpy().astype(bool)
    values = seen["log_weight"].to_numpy()
    cut = _cut(values[good], values[~good])
    k = scores.filter(F.col("log_weight") >= cut).count()
    return Fitted(ratio, _kth_largest(scores, k) if k else None)


def resample(df: DataFrame, fitted: Fitted) -> DataFrame:
    """The documents of ``df`` that the sample keeps, with ``log_weight`` and ``score``.

    The k documents with the largest perturbed weights stay; what ties with the last of them stays
    too. Null and empty texts weigh 1 (log 0) like any text without evidence. Repeated rows draw the
    same noise and share one fate. Without labelled targets nothing can be told apart and all stay.
    An empty table gives no rows; taken column names make the new ones end in an underscore.
    """
    weight, score = fresh(df, "log_weight", "score")
    scored = weighted(df, fitted.ratio, "text", weight)
    scored = scored.withColumn(score, F.col(weight) + gumbel("doc_id", F.xxhash64("text")))
    if fitted.least is None:
        return scored.filter(F.lit(False))
    return scored.filter(ticks(F.col(score)) >= F.lit(fitted.least))


def keep_quality(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``fit`` and ``resample`` on the same documents: nulls, ties, repeats, empty tables and taken names as stated there.

    Texts of any length are scored as a whole; a batch ends at a number of bytes, and a longer text makes one of its own.
    """
    return resample(df, fit(df, labels, sample))


def op9_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return keep_quality(documents.select("doc_id", "text"), labels).select("doc_id", "log_weight", "score")
