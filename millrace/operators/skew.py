"""Helpers against hot keys and hot nulls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: A group above this many rows is not handled by one task.
HOT_ROWS = 1_000_000
#: Rows up to which one side of a join is broadcast; beyond, the join is shuffled.
BROADCAST_ROWS = 1 << 17


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; they are counted for it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def row_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the first two columns outside ``keys`` (by convention the row's own id).

    Not of the whole row: that would stop column pruning at the scan.
    """
    others = [c for c in df.columns if c not in keys][:2] or list(df.columns)
    return F.xxhash64(*[F.col(c) for c in others])


def null_spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for a complete key; for an incomplete one a hash of the row.

    As an extra equality column it leaves every match alone (a null key never
    matches) and sends the null rows to all tasks instead of a single one.
    """
    return F.when(any_null(keys), row_hash(df, keys)).otherwise(F.lit(0).cast("long"))


def spread_zero(keys: Sequence[str]) -> Column:
    """What the dimension side of a spread join meets ``null_spread`` with: 0 for a key.

    Computed rather than a literal: a literal would be folded out of the join keys,
    and the null rows would meet in one task again.
    """
    return F.when(any_null(keys), F.lit(-1)).otherwise(F.lit(0)).cast("long")


def key_side(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Distinct keys as the other side of a spread join, with ``_zero`` to meet the spread.

    The distinct and the join share one hash partitioning; the distinct combines
    map-side, which flattens a hot key.
    """
    names = [F.col(k).alias(f"{prefix}{k}") for k in keys]
    return df.select(*names, spread_zero(keys).alias("_zero")).distinct()


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, weight: str | None = None
) -> DataFrame | None:
    """Keys that hold ``hot_rows`` rows or more, or None if there are none.

    Every row counts, as many times as its column ``weight`` says if one is named: a table with fewer rows in all has none,
    and else keys are counted map-side, so that no hot key is missed and none is gathered to be found. The keys come marked
    for broadcast, unless very many: dealt out by key to meet them, all rows of a hot key would be read by one task.
    """
    rows = df.select(*keys, (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("_w"))
    held = rows.count() if weight is None else rows.agg(F.sum("_w").alias("n")).first()["n"] or 0
    if held < hot_rows:
        return None
    found = rows.groupBy(*keys).agg(F.sum("_w").alias("_n")).filter(F.col("_n") >= hot_rows).drop("_n")
    # Both branches of a caller must see the same keys, so found keys are pinned.
    found = cut_lineage(found)
    return None if found.isEmpty() else small(found)


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` outside the ``hot`` keys, and those of them; a null is a key like any other."""
    side = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")
