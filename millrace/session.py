"""Session set-up and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every job relies on. Broadcast joins are left to Catalyst and
#: AQE, which compare the measured size with ``spark.sql.autoBroadcastJoinThreshold``.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when the aggregate above it then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Whether a plan's shuffle files go with its end; taken over when the plan is made.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # A checkpoint goes once nothing refers to it; a cluster sets the same.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is refused, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the files.

    The shuffles it took go at once: left to the cleaner, they stay on disk until the driver collects garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        # Selected anew: the plan is run here only, so no other action looks for its shuffles.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def release(df: DataFrame) -> None:
    """Delete the files of a frame from ``cut_lineage`` of which nothing is read any more.

    The cleaner would keep them until the driver collects garbage.
    """
    path = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if path.isDefined():
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(path.get())
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
