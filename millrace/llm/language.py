"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language over all training texts. The matrix of log probabilities
(languages x buckets) is broadcast, and each Arrow batch is scored at once: the n-grams of all its
texts are one sparse count matrix, multiplied with the log probabilities by gathering and summing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, fresh, over_batches, runs, text_of, with_columns

#: n-gram lengths and the logarithm of the number of buckets; the model takes 8 bytes x languages x 2^BITS.
ORDERS, BITS = (1, 2, 3), 15
#: Characters whose n-grams are held at once.
CHUNK = 1 << 18
UNDETERMINED = "und"


def _hashed(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each length n: the bucket of every n-gram, by the position of its first character."""
    mixed = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        mixed = (mixed[: len(codes) - n + 1] ^ codes[n - 1 :]) * np.uint32(0x9E3779B1) + np.uint32(n)
        if n in ORDERS and len(mixed):
            yield n, (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)


def _pieces(text: str) -> Iterator[str]:
    """A text in lower case between blanks, cut so that no n-gram is lost or counted twice."""
    text = f" {text.lower()} "
    step = CHUNK - max(ORDERS) + 1
    for first in range(0, len(text), step):
        yield text[first : first + CHUNK]
        if first + CHUNK >= len(text):
            break


def _grams(pieces: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: buckets of the n-grams of all pieces, and where each piece's begin.

    N-grams that would cross into the next piece are sent to the bucket 2^BITS. The overlap of the
    cuts is one less than the longest n-gram, so shorter ones at a cut belong to the later piece.
    """
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for n, buckets in _hashed(codes):
        for back in range(1, n):
            at = ends - back
            buckets[at[at < len(buckets)]] = 1 << BITS
        yield n, buckets, starts


def _owned(texts: list[str]) -> tuple[list[str], list[int], list[bool]]:
    pieces, owner, cut = [], [], []
    for i, text in enumerate(texts):
        mine = list(_pieces(text))
        pieces += mine
        owner += [i] * len(mine)
        cut += [True] * (len(mine) - 1) + [False]
    return pieces, owner, cut


def _each_gram(texts: list[str]):
    """``(owners, buckets, starts)`` for bounded groups of pieces and every n-gram length."""
    pieces, owner, cut = _owned(texts)
    sizes = np.array([len(p) for p in pieces], np.int64)
    for a, b in runs(sizes, CHUNK):
        for n, buckets, starts in _grams(pieces[a:b]):
            buckets = buckets.astype(np.int64)
            # Where a text goes on in the next piece, the shared characters count there.
            for i in range(a, b):
                if cut[i]:
                    end = starts[i - a] + sizes[i]
                    buckets[end - max(ORDERS) + 1 : min(end, len(buckets))] = 1 << BITS
            yield owner[a:b], buckets, starts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def emptied():
        for label, vector in counts.items():
            at = np.flatnonzero(vector)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(vector[at], pa.int64())],
                names=["label", "bucket", "n"],
            )
        counts.clear()

    for batch in batches:
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        texts = text_of(batch).to_pylist()
        by_label: dict[str, list[str]] = {}
        for label, text in zip(labels, texts, strict=True):
            by_label.setdefault(label, []).append(text)
        for label, own in by_label.items():
            if label not in counts and len(counts) >= 64:
                yield from emptied()
            vector = counts.setdefault(label, np.zeros(1 << BITS, np.int64))
            for _, buckets, _ in _each_gram(own):
                vector += np.bincount(buckets, minlength=(1 << BITS) + 1)[: 1 << BITS]
    yield from emptied()


def train(df: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Labels in order and their smoothed log probabilities by bucket, from all rows of ``df``.

    What comes to the driver is one count per label and bucket. Rows without a label or text are left out.
    """
    rows = df.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).dropna()
    counted = over_batches(rows, _count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    labels = sorted(set(table["label"].to_pylist()))
    place = {name: i for i, name in enumerate(labels)}
    counts = np.full((len(labels), 1 << BITS), 0.5)
    at = np.array([place[x] for x in table["label"].to_pylist()], np.int64)
    if len(at):
        counts[at, table["bucket"].to_numpy()] += table["n"].to_numpy()
        counts = np.log(counts / counts.sum(axis=1, keepdims=True))
    return labels, counts


def score_texts(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Log likelihood of each text under each label. ``weights``: buckets (and one of zeros) x labels."""
    total = np.zeros((len(texts), weights.shape[1]))
    for owners, buckets, starts in _each_gram(texts):
        inside = starts < len(buckets)
        sums = np.add.reduceat(weights[buckets], starts[inside], axis=0, dtype=np.float64)
        np.add.at(total, np.array(owners)[inside], sums)
    return total


def identify(df: DataFrame, labels: list[str], logs: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the posterior probability under equal priors.

    A null text, a text without a letter, or a model without labels gives ``und`` and 0. Ties go to
    the first label in order. Repeated rows get equal answers; an empty table gives no rows; taken
    column names make the new ones end in an underscore. Any length of text is scored whole.
    """
    predicted, score = fresh(df, "lang_pred", "score")
    weights = np.zeros(((1 << BITS) + 1, max(1, len(labels))), np.float32)
    if labels:
        weights[:-1] = logs.T
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_of(batch, text).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if labels and any(map(str.isalpha, t))]
            if known:
                logs = score_texts([texts[i] for i in known], shared.value)
                best = logs.argmax(axis=1)
                odds = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i, b, o in zip(known, best, odds, strict=True):
                    names[i], scores[i] = labels[b], 1 / o
            yield appended(batch, **{predicted: pa.array(names, pa.string()), score: pa.array(scores, pa.float64())})

    return over_batches(df, predict, with_columns(df, **{predicted: "string", score: "double"}))


def held_out(doc_id: Column) -> Column:
    """True where the documents are kept from training; false for a null id, which is not trained on either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op7_language(documents: DataFrame) -> DataFrame:
    rows = documents.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    learn = rows.filter(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    labels, logs = train(learn, "text", "lang")
    return identify(rows.select("doc_id", "text", "held_out"), labels, logs).select("doc_id", "held_out", "lang_pred", "score")
