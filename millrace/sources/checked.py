"""Loads that check rules on the way: clean rows, rejects and counts from one pass over the source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Checked:
    """``counts`` holds rows, rejected rows, and rows that break each rule."""

    clean: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def load_checked(df: DataFrame, rules: Mapping[str, Column], root: str) -> Checked:
    """Write ``df`` to ``root``, rows that break no rule apart from those that do, and count by rule while writing.

    Rejects carry ``reasons``, the names of the broken rules in their order. As with a CHECK constraint only a false rule rejects,
    and an unknown one passes. The source is scanned once: the counts are metrics observed in the pass that writes, and both parts are
    read back from what it wrote. The rules' names must not be ``rows`` or ``rejected``; the columns not ``reasons`` or ``_clean``.
    """
    spark = df.sparkSession
    broken = {name: F.coalesce(~rule, F.lit(False)) for name, rule in rules.items()}
    reasons = F.array_compact(F.array(*[F.when(b, F.lit(name)) for name, b in broken.items()])) if rules else F.array()
    checked = df.withColumn("reasons", F.array_join(reasons.cast("array<string>"), ","))
    marked = checked.withColumn("_clean", F.col("reasons") == "")
    watch = Observation()
    sums = [F.count_if(b).alias(name) for name, b in broken.items()]
    seen = marked.observe(watch, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_clean")).alias("rejected"), *sums)
    seen.write.mode("overwrite").partitionBy("_clean").parquet(root)
    read = lambda clean: spark.read.schema(marked.schema).parquet(root).filter(F.col("_clean") == clean).drop("_clean")
    return Checked(read(True).drop("reasons"), read(False), {k: int(v) for k, v in watch.get.items()})
