"""Uniform shuffle into shards of exact size, by a communication matrix.

How many rows each partition sends to each shard is drawn first, from the multivariate
hypergeometric distribution that a uniform shuffle would give. Every partition then permutes its
rows, deals them out by its line of the matrix, the rows are exchanged, and each shard permutes what
it received. The result is uniform over all arrangements, and shard sizes are exact without a
global sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import appended, fresh, over_batches, with_columns
from millrace.session import cut_lineage

#: Counts the driver holds at most (8 bytes each): partitions x shards.
MATRIX_CELLS = 1 << 26
#: Rows of a shard that are put in order together, about.
BLOCK_ROWS = 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` taken from ``good + bad``, for numbers of any size.

    The distribution is inverted over a window around its mode that leaves out less than 2^-60 of it;
    its shape comes from the ratios of neighbouring probabilities.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    spread = drawn / total * good * (1 - good / total) * (total - drawn) / max(1, total - 1)
    reach = int(10 * spread**0.5) + 50
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(rows: list[int], capacity: list[int], seed: int) -> np.ndarray:
    """Rows from each partition (line) to each shard (column); lines add up to ``rows``, columns to ``capacity``."""
    if len(rows) * len(capacity) > MATRIX_CELLS:
        raise ValueError(f"{len(rows)} partitions x {len(capacity)} shards exceed {MATRIX_CELLS} cells: coalesce the input")
    rng = np.random.default_rng(seed)
    left = list(capacity)
    matrix = np.zeros((len(rows), len(capacity)), np.int64)
    for p, n in enumerate(rows):
        free = sum(left)
        for s, room in enumerate(left):
            free -= room
            taken = hypergeometric(rng, room, free, n) if n else 0
            matrix[p, s] = taken
            left[s] -= taken
            n -= taken
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart; the first shards take what is left over."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def uniform_shards(df: DataFrame, shards: int, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (0 without gaps inside a shard), a uniform shuffle.

    The input is written to the checkpoint folder first, because matrix and deal must see the same
    partitions; a task run again draws the same numbers. A shard is permuted in blocks: each row
    draws a block, and blocks follow one another, so no task holds a shard. All rows stay, repeated
    and null ones too; rows need no key. An empty table gives no rows. With fewer rows than shards
    some shards are empty. Values of any length travel with their row and decide nothing. Taken column names make the new ones end in an underscore.
    """
    shard, slot, block, place, before, own_shard, own_block = fresh(df, "shard", "slot", "block", "place", "before", "of_shard", "of_block")
    fixed = cut_lineage(df)
    counted = fixed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    rows = [0] * (max((r.p for r in counted), default=-1) + 1)
    for r in counted:
        rows[r.p] = r["count"]
    total = sum(rows)
    matrix = communication_matrix(rows, shard_sizes(total, shards), seed)
    blocks = max(1, round(total / shards / block_rows))
    lines = df.sparkSession.sparkContext.broadcast(matrix)  # at most MATRIX_CELLS counts

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        if p >= len(rows):  # no rows
            return
        rng = np.random.default_rng([seed, p])
        # Drawn for the whole partition at once, so that batch sizes do not matter.
        dealt_to = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), lines.value[p]))
        in_block = rng.integers(0, blocks, rows[p])
        at = rng.integers(-(1 << 63), (1 << 63) - 1, rows[p])
        first = 0
        for batch in batches:
            own = slice(first, first + batch.num_rows)
            first = own.stop
            columns = {shard: pa.array(dealt_to[own], pa.int32()), block: pa.array(in_block[own]), place: pa.array(at[own])}
            yield appended(batch, **columns)

    dealt = over_batches(fixed, deal, with_columns(df, **{shard: "int", block: "long", place: "long"}))
    sizes = dealt.groupBy(shard, block).count()
    earlier = F.sum("count").over(Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col(shard).alias(own_shard), F.col(block).alias(own_block), F.coalesce(earlier, F.lit(0)).alias(before))
    starts = cut_lineage(starts)
    inside = F.row_number().over(Window.partitionBy(shard, block).orderBy(place)) - 1
    placed = dealt.withColumn(place, inside)
    # One row per block: a broadcast is left to the measured size of the table.
    placed = placed.join(starts, (F.col(shard) == F.col(own_shard)) & (F.col(block) == F.col(own_block)))
    return placed.select(*df.columns, shard, (F.col(before) + F.col(place)).cast("long").alias(slot))


def op1_shards(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Sizes and checksums of all documents, dealt into shards. A null text has no bytes and the checksum of none."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select("doc_id", (F.length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = uniform_shards(rows, shards)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
