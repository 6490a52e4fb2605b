"""Tables of immutable files: snapshots, statistics and key filters per file, and commits that no other writer can lose.

A snapshot is a list of files. With each file go the bounds of the layout's columns, its hash bucket, and, for a keyed table, a Bloom
filter of its keys; lists and filters are tables themselves, so that choosing files is a join and not a loop. Layout under the root:

- ``data/<write>/``: Parquet files; those of a keyed table in a folder per bucket of the key's hash.
- ``filters/<write>/``: (bucket, file, word, bits) of the Bloom filters.
- ``lists/<write>/``: the file list of a snapshot.
- ``manifest/<number>``: the commit, a line of JSON that names the list, the schema and the number it was built on.

A commit is the creation of the next number, which file systems grant to one writer only (``create`` without overwrite: atomic on
HDFS; an object store needs conditional writes). Whoever comes second reads the winner's snapshot, and either keeps the files written,
if the winner touched other buckets, or computes the change anew.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import newer_than
from millrace.operators.lookup import missing_from
from millrace.operators.merge import merge_upsert
from millrace.operators.skew import any_null, row_hash
from millrace.session import cut_lineage

#: Commits that are tried before a writer gives up, and seconds before an unfinished one counts as abandoned.
ATTEMPTS, PATIENCE = 20, 10.0
#: Bits a key sets in its word of a Bloom filter.
MARKS = 4


class Conflict(RuntimeError):
    """Another writer took the number."""


@dataclass(frozen=True)
class Layout:
    """How the files of a table are cut and what is kept of each.

    ``keys`` deal rows to ``buckets`` by hash and get a Bloom filter of 2^``word_bits`` words of 64 bits a file (a dozen bits a key are
    enough for 2 % false hits); without keys, ``cluster`` columns cut the table into ranges. The least and greatest value
    of the columns of both are kept for every file.
    """

    keys: tuple[str, ...] = ()
    buckets: int = 64
    word_bits: int = 10
    cluster: tuple[str, ...] = ()

    @property
    def tracked(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.keys, *self.cluster]))


@dataclass(frozen=True)
class Snapshot:
    number: int
    files: str
    schema: T.StructType
    layout: Layout


@dataclass(frozen=True)
class Change:
    """A change of a snapshot: files of one write that join it, files that leave it, and the buckets it depends on (None: all)."""

    added: str | None = None
    removed: Sequence[str] = ()
    buckets: frozenset[int] | None = None
    schema: T.StructType | None = None
    result: int = field(default=0, compare=False)


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file; ``Conflict`` if it is there already."""
    fs, there = _path(spark, path)
    try:
        out = fs.create(there, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(there):
            raise Conflict(path) from error
        raise
    out.write(bytearray(text.encode()))
    out.close()


def _read(spark: SparkSession, path: str) -> str:
    fs, there = _path(spark, path)
    source = fs.open(there)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _path(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return []
    return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit())


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot | None:
    """The snapshot of a number, or the last one; None before the first commit.

    A commit still being written (a line without its end) is waited for; if it stays so, its writer died, and the error names
    the file to delete.
    """
    known = numbers(spark, root)
    if not known:
        return None
    number = known[-1] if number is None else number
    until = time.monotonic() + PATIENCE
    while not (text := _read(spark, f"{root}/manifest/{number}")).endswith("\n"):
        if time.monotonic() > until:
            raise RuntimeError(f"commit {root}/manifest/{number} was never finished: delete it")
        time.sleep(0.1)
    line = json.loads(text)
    layout = Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in line["layout"].items()})
    return Snapshot(number, line["files"], T.StructType.fromJson(line["schema"]), layout)


def _list_schema(schema: T.StructType, layout: Layout) -> T.StructType:
    bounds = T.StructType([T.StructField(c, schema[c].dataType) for c in layout.tracked])
    fixed = T.StructType.fromDDL("file string, write string, bucket int, rows long")
    return T.StructType([*fixed.fields, T.StructField("low", bounds), T.StructField("high", bounds)] if layout.tracked else fixed.fields)


def file_list(spark: SparkSession, root: str, snap: Snapshot) -> DataFrame:
    """The files of a snapshot: file, write, bucket, rows, and the bounds ``low`` and ``high`` of the tracked columns."""
    return spark.read.schema(_list_schema(snap.schema, snap.layout)).parquet(f"{root}/{snap.files}")


def read_files(spark: SparkSession, root: str, snap: Snapshot, files: Sequence[str]) -> DataFrame:
    """Rows of some files in the snapshot's schema: columns a file lacks are null, narrower numbers are widened."""
    if not files:
        return spark.createDataFrame([], snap.schema)
    return spark.read.schema(snap.schema).parquet(*[f"{root}/{f}" for f in sorted(files)])


def _names(files: DataFrame) -> list[str]:
    """Names of the files a job is about to open: as many as there are files, a line each."""
    return [r[0] for r in files.select("file").distinct().collect()]


def read_table(spark: SparkSession, root: str, where: Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The last snapshot. ``where`` is a condition on ``low`` and ``high`` that files without any wanted row fail."""
    snap = snapshot(spark, root)
    if snap is None:
        return spark.createDataFrame([], schema)
    files = file_list(spark, root, snap)
    return read_files(spark, root, snap, _names(files if where is None else files.filter(where)))


def lookback_files(spark: SparkSession, root: str, column: str, as_of: str, interval: str = "1 month") -> DataFrame:
    """Rows newer than ``as_of - interval``, from the files that may hold any: the others are left out before the scan is planned."""
    return read_table(spark, root, newer_than(F.col(f"high.{column}"), as_of, interval)).filter(newer_than(column, as_of, interval))


def between_files(spark: SparkSession, root: str, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high``, from the files whose bounds meet the range."""
    meets = (F.col(f"high.{column}") >= F.lit(low)) & (F.col(f"low.{column}") <= F.lit(high))
    return read_table(spark, root, meets).filter(F.col(column).between(low, high))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _bucket(df: DataFrame, layout: Layout) -> Column:
    """Bucket of the key's hash; rows without a complete key go by a hash of the row, to all buckets."""
    by = F.when(any_null(layout.keys), row_hash(df, layout.keys)).otherwise(_hash(layout.keys))
    return F.pmod(by, F.lit(layout.buckets)).cast("int")


def _word(layout: Layout) -> Column:
    return F.shiftrightunsigned(_hash(layout.keys), 64 - layout.word_bits).cast("int")


def _marks(layout: Layout) -> Column:
    """The bits of a key in its word, from parts of the hash that choose neither word nor bucket."""
    h = F.xxhash64(_hash(layout.keys))
    marks = F.lit(0).cast("long")
    for i in range(MARKS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        marks = marks.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return marks


def write_files(df: DataFrame, root: str, layout: Layout, files: int | None = None, bucket: Column | None = None) -> str:
    """Write ``df`` as new files with their list and filters; no snapshot has them yet. Returns the write's name.

    A keyed table is shuffled by bucket, a clustered one by range into ``files`` files (default: shuffle partitions). ``bucket``
    takes the place of the key's hash.
    """
    spark = df.sparkSession
    write = uuid.uuid4().hex
    at = f"{root}/data/{write}"
    if layout.keys or bucket is not None:
        tagged = df.withColumn("_bucket", _bucket(df, layout) if bucket is None else bucket)
        tagged.repartition("_bucket").write.partitionBy("_bucket").parquet(at)
        written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(at)
    else:
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranged = df.repartitionByRange(n, *layout.cluster).sortWithinPartitions(*layout.cluster) if layout.cluster else df
        ranged.write.parquet(at)
        written = spark.read.schema(df.schema).parquet(at).withColumn("_bucket", F.lit(None).cast("int"))
    name = F.concat(F.lit(f"data/{write}/"), F.element_at(F.split(F.col("_metadata.file_path"), f"data/{write}/"), -1))
    named = written.withColumn("file", name)
    bounds = {
        side: F.struct(*[fn(c).alias(c) for c in layout.tracked]).alias(side) for side, fn in (("low", F.min), ("high", F.max))
    } if layout.tracked else {}
    stats = named.groupBy("file").agg(F.first("_bucket").alias("bucket"), F.count(F.lit(1)).alias("rows"), *bounds.values())
    listed = stats.withColumn("write", F.lit(write)).select("file", "write", "bucket", "rows", *bounds)
    listed.coalesce(1).write.parquet(f"{root}/lists/{write}")
    if layout.keys:
        marked = named.filter(~any_null(layout.keys)).select("file", "_bucket", _word(layout).alias("word"), _marks(layout).alias("bits"))
        words = marked.groupBy("_bucket", "file", "word").agg(F.bit_or("bits").alias("bits"))
        words.write.parquet(f"{root}/filters/{write}")
    return write


def touched_files(spark: SparkSession, root: str, snap: Snapshot, source: DataFrame) -> list[str]:
    """Files of a keyed table that may hold a key of ``source``: by the bounds of the keys, then by the Bloom filters.

    A file that holds one is always among them. Keys are met with the filters by bucket and word, so that neither the
    keys nor the filters pass through the driver; only names do.
    """
    layout = snap.layout
    complete = source.filter(~any_null(layout.keys))
    bounds = complete.agg(*[fn(k).alias(f"{fn.__name__}_{i}") for i, k in enumerate(layout.keys) for fn in (F.min, F.max)]).first()
    if bounds[0] is None:
        return []
    files = file_list(spark, root, snap)
    for i, k in enumerate(layout.keys):
        files = files.filter((F.col(f"high.{k}") >= F.lit(bounds[2 * i])) & (F.col(f"low.{k}") <= F.lit(bounds[2 * i + 1])))
    writes = [r[0] for r in files.select("write").distinct().collect()]  # at most one per commit still in use
    if not writes:
        return []
    keys = complete.select(_bucket(complete, layout).alias("_b"), _word(layout).alias("_w"), _marks(layout).alias("_m")).distinct()
    kind = "file string, word int, bits long, _bucket int"
    filters = spark.read.schema(kind).parquet(*[f"{root}/filters/{w}" for w in sorted(writes)])
    hit = (F.col("_bucket") == F.col("_b")) & (F.col("word") == F.col("_w")) & (F.col("bits").bitwiseAND(F.col("_m")) == F.col("_m"))
    return _names(files.join(filters.join(keys, hit, "left_semi").select("file").distinct(), "file", "left_semi"))


def _commit(spark: SparkSession, root: str, base: Snapshot | None, change: Change, schema: T.StructType, layout: Layout) -> Snapshot:
    """The next snapshot: the base's files without those removed, and those added. ``Conflict`` if its number is taken."""
    schema = change.schema or schema
    kind = _list_schema(schema, layout)
    parts = []
    if base is not None:
        kept = file_list(spark, root, base)
        if change.removed:
            gone = spark.createDataFrame([(f,) for f in change.removed], "file string")
            kept = kept.join(gone, "file", "left_anti")
        parts.append(kept.select(*kind.fieldNames()))
    if change.added is not None:
        parts.append(spark.read.schema(kind).parquet(f"{root}/lists/{change.added}"))
    name = f"lists/{uuid.uuid4().hex}"
    files = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else spark.createDataFrame([], kind)
    files.repartition(1).write.parquet(f"{root}/{name}")
    number = base.number + 1 if base is not None else 1
    line = {"base": number - 1, "files": name, "schema": schema.jsonValue(), "layout": asdict(layout)}
    _create(spark, f"{root}/manifest/{number}", json.dumps(line) + "\n")
    return Snapshot(number, name, schema, layout)


def _buckets_changed(spark: SparkSession, root: str, old: Snapshot, new: Snapshot) -> set[int | None]:
    """Buckets whose files differ between two snapshots; None stands for files without a bucket."""
    a, b = (file_list(spark, root, s).select("file", "bucket") for s in (old, new))
    return {r[0] for r in a.exceptAll(b).unionAll(b.exceptAll(a)).select("bucket").distinct().collect()}


def transact(
    spark: SparkSession, root: str, build: Callable[[Snapshot | None], Change | None], schema: T.StructType, layout: Layout, keep: int = 0
) -> int:
    """Build a change on the last snapshot and commit it; returns the change's ``result``.

    If another writer commits first, the change is committed on the winner's snapshot where that left the buckets it depends on
    and the schema alone, and else built anew. ``build`` returns None if there is nothing to do. With ``keep``, files that only
    older snapshots than the last ``keep`` name are removed.
    """
    base = snapshot(spark, root)
    change = build(base)
    for _ in range(ATTEMPTS):
        if change is None:
            return 0
        try:
            own = base.layout if base is not None else layout
            _commit(spark, root, base, change, base.schema if base is not None else schema, own)
        except Conflict:
            latest = snapshot(spark, root)
            apart = (
                base is not None and change.buckets is not None and change.schema is None and latest.schema == base.schema
                and not change.buckets & _buckets_changed(spark, root, base, latest)
            )
            base = latest
            if not apart:
                change = build(base)
            continue
        if keep:
            expire(spark, root, keep)
        return change.result
    raise Conflict(f"{root}: {ATTEMPTS} commits lost against other writers")


def replace_table(df: DataFrame, root: str, layout: Layout, files: int | None = None, keep: int = 2) -> None:
    """A full refresh: the rows of ``df`` become the next snapshot. ``df`` may read the table itself."""
    spark = df.sparkSession
    write = write_files(df, root, layout, files)

    def build(base: Snapshot | None) -> Change:
        gone = _names(file_list(spark, root, base)) if base is not None else []
        return Change(write, gone, schema=df.schema)

    transact(spark, root, build, df.schema, layout, keep)


def append_rows(df: DataFrame, root: str, layout: Layout, files: int | None = None) -> None:
    """Rows in files of their own; no other writer's work can be in the way."""
    write = write_files(df, root, layout, files)
    transact(df.sparkSession, root, lambda _: Change(write, buckets=frozenset()), df.schema, layout)


def insert_missing_files(spark: SparkSession, root: str, source: DataFrame) -> int:
    """Append the rows of ``source`` whose key a keyed table lacks, opening only the files that may hold one of its keys.

    ``source`` has one row a key; rows without a complete key are always new. Returns the number of files opened.
    """
    source = cut_lineage(source)

    def build(base: Snapshot) -> Change | None:
        files = touched_files(spark, root, base, source)
        keys = base.layout.keys
        known = read_files(spark, root, base, files).select(*keys)
        new = cut_lineage(missing_from(source, known, {k: k for k in keys}))
        if new.isEmpty():
            return None
        write = write_files(_conformed(new, base.schema), root, base.layout)
        return Change(write, buckets=_own_buckets(spark, root, base, [], write), result=len(files))

    first = snapshot(spark, root)
    return transact(spark, root, build, first.schema, first.layout)


def merge_files(spark: SparkSession, root: str, source: DataFrame, update: Sequence[str] | None = None, keep: int = 0) -> int:
    """Upsert into a keyed table: files that hold a key of ``source`` are written anew, all others stay as they are.

    Returns the number of files replaced.
    """
    source = cut_lineage(source)

    def build(base: Snapshot) -> Change:
        keys = list(base.layout.keys)
        rows = read_files(spark, root, base, touched_files(spark, root, base, source))
        hit = rows.select(*keys, F.col("_metadata.file_path").alias("_file")) if rows.inputFiles() else None
        paths = []
        if hit is not None:  # those that only a filter took for a match stay
            met = hit.join(source.select(*keys).distinct(), keys, "left_semi")
            paths = [r[0] for r in met.select("_file").distinct().collect()]
        replaced = ["data/" + p.rsplit("/data/", 1)[1] for p in paths]
        target = read_files(spark, root, base, replaced)
        merged = merge_upsert(target, _conformed(source, base.schema), keys, update if update is not None else source.columns)
        write = write_files(merged, root, base.layout)
        return Change(write, replaced, _own_buckets(spark, root, base, replaced, write), result=len(replaced))

    first = snapshot(spark, root)
    return transact(spark, root, build, first.schema, first.layout, keep)


def _own_buckets(spark: SparkSession, root: str, base: Snapshot, removed: Sequence[str], write: str) -> frozenset[int]:
    """Buckets a change writes to or takes files from."""
    added = spark.read.schema(_list_schema(base.schema, base.layout)).parquet(f"{root}/lists/{write}")
    gone = [int(f.split("_bucket=")[1].split("/")[0]) for f in removed]
    return frozenset([*gone, *(r[0] for r in added.select("bucket").distinct().collect())])


def _conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


# Types a column may change to without its files being written anew.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint",), "float": ("double",),
}


def evolve_table(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Give a table another schema without writing a row: columns may be added, widened (``WIDER``) or dropped.

    Older files are read in the new schema. A column that would be narrowed, a tracked one that would be changed, and
    one that comes back with another type than files hold are refused.
    """

    def build(base: Snapshot) -> Change:
        for number in numbers(spark, root):
            past = snapshot(spark, root, number)
            for f in past.schema.fields:
                if f.name in schema.fieldNames() and f.dataType != schema[f.name].dataType:
                    if schema[f.name].dataType.simpleString() not in WIDER.get(f.dataType.simpleString(), ()):
                        raise ValueError(f"{f.name}: {f.dataType.simpleString()} cannot become {schema[f.name].dataType.simpleString()}")
        for c in base.layout.tracked:
            if c not in schema.fieldNames() or schema[c].dataType != base.schema[c].dataType:
                raise ValueError(f"{c} orders the files of the table and cannot change")
        return Change(schema=schema)

    first = snapshot(spark, root)
    transact(spark, root, build, first.schema, first.layout)


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Forget all but the last ``keep`` commits, and remove the files that only they name.

    Files no commit ever named, so those that another writer is about to commit, are left alone.
    """
    known = numbers(spark, root)
    old, live = known[:-keep], known[-keep:]
    if not old:
        return
    lists = {n: snapshot(spark, root, n) for n in known}
    named = [file_list(spark, root, lists[n]).select("file") for n in live]
    gone = [file_list(spark, root, lists[n]).select("file") for n in old]
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionAll(union(parts[1:]))
    for name in _names(union(gone).join(union(named), "file", "left_anti")):
        fs, path = _path(spark, f"{root}/{name}")
        fs.delete(path, False)
    for n in old:
        for name in (f"manifest/{n}", lists[n].files):
            fs, path = _path(spark, f"{root}/{name}")
            fs.delete(path, True)


def merge_buckets(
    spark: SparkSession, root: str, schema: T.StructType, batch: DataFrame, bucket: Column, combine: Callable[[DataFrame], DataFrame], keep: int = 2
) -> int:
    """Merge a batch into a table of buckets: only those it touches are written anew, by ``combine`` from old rows and the batch's.

    Readers see all of a merge or nothing, a merge that fails changes nothing, and of two at once none is lost. A batch
    without rows writes nothing. Returns the number of buckets written.
    """
    # At most one number per bucket comes back.
    touched = sorted(r[0] for r in batch.select(bucket.alias("_bucket")).distinct().collect())
    layout = Layout(buckets=0)

    def build(base: Snapshot | None) -> Change | None:
        if not touched:
            return None
        files = _names(file_list(spark, root, base).filter(F.col("bucket").isin(touched))) if base is not None else []
        rows = batch.unionByName(read_files(spark, root, base, files)) if files else batch
        write = write_files(combine(rows).select(*schema.fieldNames()), root, layout, bucket=bucket)
        return Change(write, files, frozenset(touched), result=len(touched))

    return transact(spark, root, build, schema, layout, keep)
