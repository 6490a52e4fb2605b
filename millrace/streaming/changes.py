"""Polling a change table, as a batch and as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import newer_than
from millrace.operators.merge import first_per_key, merge_upsert
from millrace.operators.skew import any_null
from millrace.sources.load import merge_versions


def newest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of every key; rows without a complete key are no one's change and all stay."""
    return first_per_key(changes, keys, [F.desc(c) for c in order])


def poll_changes(
    changes: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tie: str,
    as_of: str,
    interval: str,
) -> DataFrame:
    """Re-read the last interval and merge it. Overlapping polls give the same target."""
    recent = changes.filter(newer_than(stamp, as_of, interval))
    return merge_upsert(target, newest_per_key(recent, keys, [stamp, tie]), keys)


def poll_changes_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    target_root: str,
    target_schema: T.StructType,
    checkpoint: str,
    keys: Sequence[str],
    stamp: str,
    event_id: str,
    buckets: int = 64,
    files_per_trigger: int | None = None,
) -> None:
    """Merge an append-only change folder into a bucketed table, as far as it has grown.

    There is no watermark: however late a change comes, it competes with what the target has, and
    the newer one stays. A micro-batch rewrites the buckets its keys fall in. The merge is keyed, and
    rows without a key by ``event_id``, so repeated events and repeated batches give the same target.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    by = F.when(any_null(keys), F.xxhash64(event_id)).otherwise(F.xxhash64(*keys))
    bucket = F.pmod(by, F.lit(buckets)).cast("int")

    def newest(rows: DataFrame) -> DataFrame:
        keyed = newest_per_key(rows.filter(~any_null(keys)), keys, [stamp, event_id])
        return keyed.unionByName(rows.filter(any_null(keys)).dropDuplicates([event_id]))

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = batch.select(*[f.name for f in target_schema.fields])
        merge_versions(batch.sparkSession, target_root, target_schema, rows, bucket, newest)

    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
