"""Tables bucketed and sorted by their key, which join and merge without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.skew import any_null


def write_cobucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` files by the hash of its key, sorted by it, as the external table ``name``; read it back.

    One shuffle now; joins on the key with a table of as many buckets need none later. Rows with a null in their key
    share a bucket with the keys of the same hash.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def attach_cobucketed(spark: SparkSession, name: str, path: str, ddl: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Register files that ``write_cobucketed`` left, as in a session whose catalog does not know them."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def merge_cobucketed(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """``merge_upsert`` of two tables bucketed alike: every task joins one bucket of each, and no row is shuffled.

    Rows with a null in their key match nothing and all stay; they are scanned apart, so that they meet no join. A complete
    source key that repeats fails.
    """
    have = set(source.columns)
    update = set(have if update is None else update) - set(keys)
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    flag = F.when(copies > 1, F.raise_error(F.lit("merge: source key is not unique")).cast("boolean")).otherwise(F.lit(True))
    side = source.filter(~any_null(keys)).withColumn("_in", flag)
    side = side.select(*[F.col(c).alias(f"_s_{c}") for c in side.columns])
    left = target.filter(~any_null(keys)).withColumn("_in", F.lit(True))
    joined = left.join(side, [F.col(k) == F.col(f"_s_{k}") for k in keys], "full_outer")
    in_target, in_source = F.col("_in").isNotNull(), F.col("_s__in").isNotNull()
    out = []
    for f in target.schema.fields:
        old = F.col(f.name)
        new = (F.col(f"_s_{f.name}") if f.name in have else F.lit(None)).cast(f.dataType)
        takes = f.name in update and f.name in have
        out.append((F.when(in_source, new).otherwise(old) if takes else F.when(in_target, old).otherwise(new)).alias(f.name))
    fresh = source.filter(any_null(keys))
    typed = fresh.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return joined.select(*out).unionByName(target.filter(any_null(keys))).unionByName(typed)
