"""One row per key: latest, nearest, unambiguous, top n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.skew import any_null


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows no other row of the same key exceeds in ``order``.

    As in the anti self join, a row with a null key part or null ``order`` has no
    rival and stays. The rank is limited per group ahead of the shuffle, so a hot
    key sends at most its best rows.
    """
    open_rows = any_null([*keys, order])
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    ranked = df.filter(~open_rows).withColumn("_rank", rank)
    best = ranked.filter(F.col("_rank") == 1).drop("_rank")
    return best.unionByName(df.filter(open_rows))


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column | str], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group with their rank; ``order_by`` ends in a unique key."""
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
    return df.withColumn(rank, position).filter(F.col(rank) <= n)


def nearest_first(df: DataFrame, key: str, distance: str, value: str) -> DataFrame:
    """The value at the smallest distance per key."""
    return df.groupBy(key).agg(F.min_by(value, distance).alias(value))


def unambiguous_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows whose key occurs in one distinct row only.

    Keys compare by column, null equal to null; joined strings could collide. Both
    steps combine map-side.
    """
    others = [c for c in df.columns if c not in keys]
    rest = F.struct(*others) if others else F.struct(F.lit(1).alias("_one"))
    groups = df.distinct().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(rest).alias("_rest")
    )
    single = groups.filter(F.col("_n") == 1)
    return single.select(*keys, *[F.col(f"_rest.{c}").alias(c) for c in others]).select(*df.columns)


def singleton_groups(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups that hold exactly one row."""
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") == 1).drop("_n")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once; incomplete keys do not count."""
    counted = df.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return counted.filter(F.col(count) > 1)
