import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import insert_missing, merge_upsert
from millrace.sources import snapshots
from millrace.sources.snapshots import Change, Conflict, Layout

DDL = "k long, v string"
KEYED = Layout(("k",), 16, 8)


@pytest.fixture
def table(spark, tmp_path):
    """A keyed table of even numbers, one file a bucket."""
    root = str(tmp_path / "t")
    snapshots.replace_table(spark.range(0, 4000, 2).selectExpr("id as k", "concat('v', id) as v"), root, KEYED)
    return root


def files_of(spark, root):
    return {r.file for r in snapshots.file_list(spark, root, snapshots.snapshot(spark, root)).collect()}


def test_every_key_is_in_a_touched_file(spark, table):
    snap = snapshots.snapshot(spark, table)
    where = {r.k: r.f for r in spark.read.parquet(f"{table}/data/*/*").select("k", F.element_at(F.split("_metadata.file_path", "/t/"), -1).alias("f")).collect()}
    for keys in ([0], [2, 3998], list(range(100, 140))):
        found = set(snapshots.touched_files(spark, table, snap, spark.createDataFrame([(k, "") for k in keys], DDL)))
        assert {where[k] for k in keys if k in where} <= found
    for nothing in ([(None, "x")], [(5000, "beyond the bounds")], [(-1, "")]):
        assert snapshots.touched_files(spark, table, snap, spark.createDataFrame(nothing, DDL)) == []


def test_filters_keep_most_files_out(spark, table):
    """Of the files that share a bucket with an absent key few are opened, and a false hit does no harm."""
    snap = snapshots.snapshot(spark, table)
    opened = sum(len(snapshots.touched_files(spark, table, snap, spark.createDataFrame([(k, "")], DDL))) for k in range(101, 161, 2))
    assert opened <= 6
    odd = spark.range(1, 4000, 2).selectExpr("id as k", "'new' as v")
    few_words = Layout(("k",), 16, 1)  # filters so full that every key hits
    root = table + "-full"
    snapshots.replace_table(spark.range(0, 4000, 2).selectExpr("id as k", "'old' as v"), root, few_words)
    assert len(snapshots.touched_files(spark, root, snapshots.snapshot(spark, root), odd)) == 16
    snapshots.insert_missing_files(spark, root, odd)
    assert rows(snapshots.read_table(spark, root).groupBy("v").count()) == [("new", 2000), ("old", 2000)]


def test_insert_missing_reads_touched_files_only(spark, table, monkeypatch):
    read, before = [], snapshots.read_files
    monkeypatch.setattr(snapshots, "read_files", lambda s, r, n, f: read.append(list(f)) or before(s, r, n, f))
    source = spark.createDataFrame([(10, "known"), (11, "new"), (None, "x"), (None, "x")], DDL)
    whole = snapshots.read_table(spark, table)
    expected = rows(insert_missing(whole, source, ["k"]))
    read.clear()
    opened = snapshots.insert_missing_files(spark, table, source)
    assert opened == len(read[0]) <= 2 and len(files_of(spark, table)) > 16
    assert rows(snapshots.read_table(spark, table)) == expected
    again = snapshots.numbers(spark, table)
    assert snapshots.insert_missing_files(spark, table, spark.createDataFrame([(10, "a"), (11, "b")], DDL)) == 0
    assert snapshots.numbers(spark, table) == again  # nothing new, no commit


def test_merge_rewrites_matched_files_only(spark, table):
    before = files_of(spark, table)
    source = spark.createDataFrame([(10, "ten"), (11, "eleven"), (3998, "last"), (None, "none")], DDL)
    expected = rows(merge_upsert(snapshots.read_table(spark, table), source, ["k"]))
    replaced = snapshots.merge_files(spark, table, source)
    assert 1 <= replaced <= 2 and len(before - files_of(spark, table)) == replaced
    assert rows(snapshots.read_table(spark, table)) == expected
    snapshots.merge_files(spark, table, spark.createDataFrame([(10, "ten"), (11, "eleven"), (3998, "last")], DDL))
    assert rows(snapshots.read_table(spark, table)) == expected
    only_new = spark.createDataFrame([(9001, "beyond")], DDL)
    assert snapshots.merge_files(spark, table, only_new) == 0 and snapshots.read_table(spark, table).count() == len(expected) + 1


def between_read_and_commit(monkeypatch, act):
    """Run ``act`` once, when the first writer has built its change and not yet committed."""
    commit, left = snapshots._commit, [act]

    def late(*args, **kwargs):
        if left:
            left.pop()()
        return commit(*args, **kwargs)

    monkeypatch.setattr(snapshots, "_commit", late)


def test_two_merges_from_one_base(spark, table, monkeypatch):
    """The second to commit keeps both changes: in other buckets its files as they are, in the same ones built anew."""
    builds, write = [], snapshots.write_files
    monkeypatch.setattr(snapshots, "write_files", lambda *a, **k: builds.append(1) or write(*a, **k))
    values = lambda: {r.k: r.v for r in snapshots.read_table(spark, table).filter("k < 100").collect()}
    buckets = {r.k: r.b for r in spark.range(0, 100, 2).select(F.col("id").alias("k"), F.pmod(F.xxhash64("id"), F.lit(16)).alias("b")).collect()}
    other = next(k for k in buckets if buckets[k] != buckets[10])
    same = next(k for k in buckets if buckets[k] == buckets[10] and k != 10)
    one = lambda k, v: spark.createDataFrame([(k, v)], DDL)
    between_read_and_commit(monkeypatch, lambda: snapshots.merge_files(spark, table, one(other, "theirs")))
    snapshots.merge_files(spark, table, one(10, "mine"))
    assert (values()[other], values()[10]) == ("theirs", "mine") and len(builds) == 2
    between_read_and_commit(monkeypatch, lambda: snapshots.merge_files(spark, table, one(same, "theirs")))
    snapshots.merge_files(spark, table, one(10, "mine again"))
    assert (values()[same], values()[10], values()[other]) == ("theirs", "mine again", "theirs") and len(builds) == 5
    assert len(values()) == 50 and snapshots.read_table(spark, table).count() == 2000


def test_two_inserts_of_one_key(spark, table, monkeypatch):
    new = spark.createDataFrame([(7, "first"), (9, "x")], DDL)
    between_read_and_commit(monkeypatch, lambda: snapshots.insert_missing_files(spark, table, spark.createDataFrame([(7, "winner")], DDL)))
    snapshots.insert_missing_files(spark, table, new)
    assert rows(snapshots.read_table(spark, table).filter("k in (7, 9)")) == [(7, "winner"), (9, "x")]


def test_appends_and_a_replacement_at_once(spark, table, monkeypatch):
    between_read_and_commit(monkeypatch, lambda: snapshots.append_rows(spark.createDataFrame([(1, "theirs")], DDL), table, KEYED))
    snapshots.append_rows(spark.createDataFrame([(3, "mine")], DDL), table, KEYED)
    assert snapshots.read_table(spark, table).count() == 2002
    between_read_and_commit(monkeypatch, lambda: snapshots.append_rows(spark.createDataFrame([(5, "late")], DDL), table, KEYED))
    snapshots.replace_table(spark.createDataFrame([(0, "all")], DDL), table, KEYED)
    assert rows(snapshots.read_table(spark, table)) == [(0, "all")]


def test_buckets_merged_by_two_writers(spark, tmp_path, monkeypatch):
    """The table of the stream: both writers' rows are there, whichever buckets they share."""
    root, schema = str(tmp_path / "t"), T.StructType.fromDDL(DDL)
    bucket = F.pmod(F.col("k"), F.lit(4)).cast("int")
    merge = lambda *r: snapshots.merge_buckets(spark, root, schema, spark.createDataFrame(list(r), DDL), bucket, lambda d: d.dropDuplicates(["k"]))
    merge(*[(i, "old") for i in range(8)])
    between_read_and_commit(monkeypatch, lambda: merge((11, "theirs"), (12, "theirs")))
    assert merge((9, "mine"), (16, "mine")) == 2
    assert rows(snapshots.read_table(spark, root).filter("k > 7")) == [(9, "mine"), (11, "theirs"), (12, "theirs"), (16, "mine")]
    assert snapshots.read_table(spark, root).count() == 12


def test_unfinished_commits_and_lost_races(spark, table, monkeypatch):
    with pytest.raises(Conflict):
        snapshots._create(spark, f"{table}/manifest/1", "x\n")
    monkeypatch.setattr(snapshots, "PATIENCE", 0.2)
    snapshots._create(spark, f"{table}/manifest/2", '{"base": 1')
    with pytest.raises(RuntimeError, match="never finished"):
        snapshots.read_table(spark, table)
    monkeypatch.setattr(snapshots, "_commit", lambda *a: (_ for _ in ()).throw(Conflict("taken")))
    monkeypatch.setattr(snapshots, "snapshot", lambda *a: None)
    with pytest.raises(Conflict, match="commits lost"):
        snapshots.transact(spark, table, lambda _: Change(), T.StructType.fromDDL(DDL), KEYED)


def test_expiry_removes_only_what_no_kept_snapshot_names(spark, table):
    pending = snapshots.write_files(spark.createDataFrame([(1, "in flight")], DDL), table, KEYED)
    first = files_of(spark, table)
    for v in ("a", "b", "c"):
        snapshots.merge_files(spark, table, spark.createDataFrame([(10, v)], DDL), keep=2)
    assert len(snapshots.numbers(spark, table)) == 2
    fs = lambda name: snapshots._path(spark, f"{table}/{name}")
    there = [f for f in first if fs(f)[0].exists(fs(f)[1])]
    assert len(there) == len(first) - 1
    assert fs(f"data/{pending}")[0].exists(fs(f"data/{pending}")[1])
    assert rows(snapshots.read_table(spark, table).filter("k = 10")) == [(10, "c")]


def test_clustered_lookback_opens_few_files(spark, tmp_path):
    root = str(tmp_path / "t")
    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(hours=i * 7 % 2000)) for i in range(2000)] + [(5000, None)]
    df = spark.createDataFrame(data, "id int, at timestamp_ntz").repartition(5)
    snapshots.replace_table(df, root, Layout(cluster=("at",)), files=20)
    every = len(snapshots.read_table(spark, root).inputFiles())
    recent = snapshots.lookback_files(spark, root, "at", "2024-03-24 08:00:00", "3 days")
    assert every >= 15 and 1 <= len(recent.inputFiles()) <= 3
    assert rows(recent) == rows(df.filter("at > timestamp_ntz'2024-03-21 08:00:00'")) and recent.count() > 50
    day = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11))
    found = snapshots.between_files(spark, root, "at", *day)
    assert len(found.inputFiles()) <= 3 and rows(found) == rows(df.filter(F.col("at").between(*day)))
    assert snapshots.lookback_files(spark, root, "at", "2030-01-01 00:00:00", "1 day").collect() == []


def test_schema_history(spark, tmp_path):
    """Files of three schemas read as one: a column added, one widened, one dropped."""
    root, layout = str(tmp_path / "t"), Layout(cluster=("id",))
    snapshots.replace_table(spark.createDataFrame([(1, 10, "x")], "id long, n int, old string"), root, layout, 1)
    snapshots.evolve_table(spark, root, T.StructType.fromDDL("id long, n int, old string, more string"))
    snapshots.append_rows(spark.createDataFrame([(2, 20, "y", "m")], "id long, n int, old string, more string"), root, layout, 1)
    snapshots.evolve_table(spark, root, T.StructType.fromDDL("id long, n long, more string"))
    snapshots.append_rows(spark.createDataFrame([(3, 1 << 40, "p")], "id long, n long, more string"), root, layout, 1)
    found = snapshots.read_table(spark, root)
    assert found.schema.simpleString() == "struct<id:bigint,n:bigint,more:string>"
    assert rows(found) == [(1, 10, None), (2, 20, "m"), (3, 1 << 40, "p")]
    for bad in ("id long, n int, more string", "id int, n long, more string", "n long, more string", "id long, n long, more string, old int"):
        with pytest.raises(ValueError):
            snapshots.evolve_table(spark, root, T.StructType.fromDDL(bad))
    old = snapshots.snapshot(spark, root, 1)
    assert rows(snapshots.read_files(spark, root, old, [r.file for r in snapshots.file_list(spark, root, old).collect()])) == [(1, 10, "x")]


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    empty = spark.createDataFrame([], DDL)
    assert snapshots.read_table(spark, root, schema=empty.schema).collect() == []
    snapshots.replace_table(empty, root, KEYED)
    assert snapshots.read_table(spark, root).collect() == []
    assert snapshots.insert_missing_files(spark, root, empty) == 0
    snapshots.insert_missing_files(spark, root, spark.createDataFrame([(1, "a"), (None, "b")], DDL))
    snapshots.merge_files(spark, root, empty)
    assert rows(snapshots.read_table(spark, root)) == [(None, "b"), (1, "a")]
