"""Group counts that follow their table: a change batch updates the groups it touches, and the table itself is not read again.

The counts are a keyed snapshot table (``snapshots``) with a row for every different row of the watched columns and ``n``, how often it
occurs. Duplicate, unambiguous and single keys are questions to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.skew import any_null
from millrace.session import cut_lineage
from millrace.sources import snapshots
from millrace.sources.snapshots import Change, Layout, Snapshot

#: The key as text, so that null is a value like any other, and the count.
GROUP, COUNT = "_group", "n"


def _counted(df: DataFrame, keys: Sequence[str], values: Sequence[str], sign: int) -> DataFrame:
    each = df.groupBy(*keys, *values).agg((F.count(F.lit(1)) * sign).alias(COUNT))
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return each.select(group.alias(GROUP), *keys, *values, COUNT)


def update_counts(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    values: Sequence[str] = (),
    added: DataFrame | None = None,
    removed: DataFrame | None = None,
    layout: Layout | None = None,
) -> int:
    """Bring the counts at ``root`` up to date with rows ``added`` to the watched table and rows ``removed`` from it.

    The batch is counted first, map-side; then only files that may hold one of its groups are read and replaced. The first call
    makes the table. Taking away a row that was never added fails and changes nothing; a group whose count falls to
    zero leaves the table. Two updates at once both count. Returns the number of files replaced.
    """
    parts = [_counted(df, keys, values, sign) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    if not parts:
        return 0
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    group = [GROUP, *keys, *values]
    delta = cut_lineage(both.groupBy(*group).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0))
    layout = layout or Layout((GROUP,))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in delta.schema.fields])

    def build(base: Snapshot | None) -> Change | None:
        files = snapshots.touched_files(spark, root, base, delta) if base is not None else []
        old = snapshots.read_files(spark, root, base, files) if files else delta.limit(0)
        total = old.unionByName(delta).groupBy(*group).agg(F.sum(COUNT).alias(COUNT))
        below = F.raise_error(F.concat(F.lit("counts: removed a row that is not there: "), F.col(GROUP)))
        checked = total.withColumn(COUNT, F.when(F.col(COUNT) < 0, below.cast("long")).otherwise(F.col(COUNT)))
        write = snapshots.write_files(checked.filter(F.col(COUNT) != 0), root, layout)
        touched = delta.select(F.pmod(F.xxhash64(GROUP), F.lit(layout.buckets)).cast("int")).distinct().collect()  # one per bucket
        return Change(write, files, frozenset(r[0] for r in touched), result=len(files))

    if delta.isEmpty() and snapshots.snapshot(spark, root) is not None:
        return 0
    return snapshots.transact(spark, root, build, schema, layout)


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """Every different row of the watched columns with its count."""
    return snapshots.read_table(spark, root).drop(GROUP)


def duplicate_keys(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Complete keys that occur more than once, with their count."""
    counted = read_counts(spark, root).filter(~any_null(keys)).groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))
    return counted.filter(F.col(COUNT) > 1)


def unambiguous_rows(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Different rows whose key has no other; null keys are equal."""
    counts = read_counts(spark, root).drop(COUNT)
    others = [c for c in counts.columns if c not in keys]
    groups = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    return groups.filter(F.col("_n") == 1).select(*keys, *others)


def singleton_groups(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Keys of exactly one row."""
    counted = read_counts(spark, root).groupBy(*keys).agg(F.sum(COUNT).alias("_n"))
    return counted.filter(F.col("_n") == 1).drop("_n")
