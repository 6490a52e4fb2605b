"""Consecutive numbers over a whole table or inside large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.skew import hot_keys, HOT_ROWS, split_hot
from millrace.session import cut_lineage


def _ranged(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    """``df`` in order: range-partitioned, sorted, each row with its range ``_pid`` and place ``_at`` in it.

    Range and place are only true for one run of the range sampler, so the rows are
    checkpointed with them before anything is counted.
    """
    # Without a number of their own, neighbouring ranges of few rows are read and written as one.
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    # The id counts rows inside a partition in its lower 33 bits.
    placed = cut_lineage(ranged.withColumn("_row", F.monotonically_increasing_id()))
    at = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*df.columns, F.shiftright("_row", 33).cast("int").alias("_pid"), (at + 1).alias("_at"))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    after: tuple[DataFrame, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 1..n in ``order_by`` order (a unique key), after a maximum.

    ``after`` is (table, id column): numbering goes on after its maximum, or starts
    at 1 when it is empty. ``partitions`` is the number of ranges, by default at most that of shuffle
    partitions: one shuffle, after which no row moves again.
    """
    ranged = _ranged(df, order_by, partitions)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range, so this single group is bounded by the number of partitions.
    before = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_pid").alias("_start_pid"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    first = F.col("_start")
    if after is not None:
        table, column = after
        first = first + table.agg(F.coalesce(F.max(column), F.lit(0))).scalar()
    numbered = ranged.join(F.broadcast(starts), F.col("_pid") == F.col("_start_pid"))
    number = (F.col("_at") + first).cast("long")
    return numbered.withColumn(out, number).select(
        *[c for c in df.columns if c != out], out
    )


def number_in_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    out: str,
    hot_rows: int = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """1..n inside each group. Groups too large for one task are cut into ranges.

    ``sizes`` is a cheaper table with at least as many rows per group, to look for
    large groups in.
    """
    plain = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by)).cast("long")
    hot = hot_keys(df if sizes is None else sizes, group, hot_rows)
    if hot is None:
        return df.withColumn(out, plain)
    rest, large = split_hot(df, hot, group)
    cold = rest.withColumn(out, plain)
    return cold.select(*df.columns, out).unionByName(_number_ranges(large, group, order_by, out))


def number_runs(
    df: DataFrame,
    group: Sequence[str],
    run: Sequence[str],
    out: str,
    hot_rows: int = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number of the run (distinct ``run`` value, in order) a row falls in, per group.

    In groups too large for one task the distinct runs are numbered and joined back.
    """
    rank = F.dense_rank().over(Window.partitionBy(*group).orderBy(*run)).cast("long")
    hot = hot_keys(df if sizes is None else sizes, group, hot_rows)
    if hot is None:
        return df.withColumn(out, rank)
    rest, large = split_hot(df, hot, group)
    cold = rest.withColumn(out, rank)
    runs = large.select(*group, *run).distinct()
    numbered = number_in_group(runs, group, run, out, hot_rows)
    named = [*group, *run]
    numbered = numbered.select(*[F.col(c).alias(f"_r_{c}") for c in named], out)
    joined = large.join(numbered, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in named])
    return cold.select(*df.columns, out).unionByName(joined.select(*df.columns, out))


def _number_ranges(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str], out: str
) -> DataFrame:
    ranged = _ranged(df, [*group, *order_by], None)
    # Pieces of one group: at most one per range. All pieces: at most one per range and per large group.
    pieces = ranged.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    names = {g: f"_g_{g}" for g in group}
    starts = starts.select("_pid", "_first", "_start", *[F.col(g).alias(n) for g, n in names.items()]).withColumnRenamed("_pid", "_p")
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]
    joined = ranged.join(starts, [F.col("_pid") == F.col("_p"), *same])
    number = F.col("_at") - F.col("_first") + 1 + F.col("_start")
    return joined.withColumn(out, number.cast("long")).select(*df.columns, out)


def allocate_codes(
    df: DataFrame, order_by: Sequence[str], code: str, prefix: str, width: int = 5
) -> DataFrame:
    """Serial codes for the rows that have none, after the largest code in use.

    A number wider than ``width`` is kept whole, so codes never collide.
    """
    used = df.filter(F.col(code).startswith(prefix)).agg(
        F.coalesce(max_sequence(code, prefix), F.lit(0))
    )
    without = number_rows(df.filter(F.col(code).isNull()), order_by, "_n")
    number = (F.col("_n") + used.scalar()).cast("string")
    padded = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    coded = without.withColumn(code, F.concat(F.lit(prefix), padded)).select(*df.columns)
    return df.filter(F.col(code).isNotNull()).unionByName(coded)


def max_sequence(code: str, prefix: str) -> Column:
    """Aggregate: largest number behind ``prefix`` among codes of the form prefix + digits."""
    rest = F.substring(F.col(code), len(prefix) + 1, 2147483647)
    return F.max(F.when(F.col(code).startswith(prefix), rest.try_cast("long")))
