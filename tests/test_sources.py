"""Loads, outbox and streaming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace import session
from millrace.sources import load, outbox, schemas
from millrace.operators.merge import merge_upsert_last
from millrace.streaming.changes import newest_per_key, poll_changes_stream

SCHEMA = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())


def test_type_mapping():
    cases = {
        "bigint(11) unsigned": "bigint", "int(11)": "int", "int unsigned": "bigint", "tinyint(1)": "smallint",
        "varchar(255)": "string", "datetime": "timestamp_ntz", "decimal(10,6)": "decimal(10,6)", "NUMERIC(18, 2)": "decimal(18,2)",
        "double precision": "double", "bit(1)": "boolean", "BIGSERIAL": "bigint", "text": "string",
    }
    assert {k: schemas.spark_type(k) for k in cases} == cases
    with pytest.raises(ValueError):
        schemas.spark_type("geometry")


def test_cast_to_trims_padding(frame):
    declared = schemas.schema_of({"a": "char(8)", "n": "int"})
    assert rows(schemas.cast_to(frame("a string, n string", ("x   ", "5")), declared)) == [("x", 5)]


def test_failed_load_keeps_the_previous_one(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    assert load.read_current(spark, root, SCHEMA).count() == 0
    load.truncate_load(frame("id int, v string", (1, "a")), root, SCHEMA)
    broken = frame("id int, v string", (2, "b")).withColumn("v", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        load.truncate_load(broken, root, SCHEMA)
    assert rows(load.read_current(spark, root, SCHEMA)) == [(1, "a")]
    # The next run may read the table it replaces.
    load.truncate_load(load.read_current(spark, root, SCHEMA).withColumn("v", F.upper("v")), root, SCHEMA)
    assert rows(load.read_current(spark, root, SCHEMA)) == [(1, "A")]


def test_bucketed_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "b")
    target = spark.range(200).select(F.col("id").cast("int").alias("id"), F.lit("old").alias("v"))
    load.write_bucketed(target, path, ["id"], 16)
    before = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    source = spark.createDataFrame([(3, "new"), (999, "add")], SCHEMA)
    touched = load.merge_bucketed(spark, path, SCHEMA, source, ["id"], 16)
    after = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert touched <= 2 and len(set(before.items()) & set(after.items())) >= 14
    spark.catalog.refreshByPath(path)
    got = dict(rows(spark.read.schema(SCHEMA).parquet(path), "id", "v"))
    assert len(got) == 201 and got[3] == "new" and got[999] == "add" and got[4] == "old"


def test_lookback_and_newest(frame):
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 20)) for i in range(40)]
    df = frame("id int, at timestamp_ntz", *data)
    got = load.extract_latest_n(df, "at", "2024-01-20 00:00:00", 3, "id", "10 days")
    assert rows(got, "id") == [(19,), (38,), (39,)]


def test_declared_loads(frame):
    assert len(load.LOADS) == 20
    prices = frame("s_price_id int, is_delete int, s_price_type boolean", (1, 0, True), (2, 1, False))
    assert rows(load.LOADS["auxiliary_material_price"].extract(prices)) == [(1, 0, 1)]
    old, new = dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 20)
    punch = frame("s_id int, s_created_time timestamp_ntz, is_write boolean", (1, old, True), (2, new, True))
    assert rows(load.LOADS["punch_clock"].extract(punch, "2024-02-01 00:00:00"), "s_id", "is_write") == [(2, 1)]
    record = frame("dd_id long, s_created_time timestamp_ntz", *[(i, new) for i in range(600)])
    newest = load.LOADS["attendance_record"].extract(record, "2024-02-01 00:00:00")
    assert newest.count() == 500 and newest.agg(F.min("dd_id")).first()[0] == 100


def test_outbox(spark, frame, tmp_path):
    path = str(tmp_path / "o")
    for run, key in (("a", 1), ("b", 2), ("b", 2)):
        outbox.export_documents(frame("k int, d string", (key, '{"a":1}')), "k", "d", path, "item", run)
    got = rows(spark.read.text(path), "value", "entity", "run")
    assert got == [(f'{{"key":{k},"document":"{{\\"a\\":1}}"}}', "item", r) for k, r in ((1, "a"), (2, "b"))]


def test_loads_keep_their_last_versions(spark, frame, tmp_path):
    root, schema = str(tmp_path / "t"), T.StructType.fromDDL("id int")
    for i in range(4):
        load.truncate_load(frame("id int", (i,)), root, schema)
    assert rows(load.read_current(spark, root, schema)) == [(3,)]
    assert sorted(p.name for p in (tmp_path / "t").glob("load_*")) == ["load_000003", "load_000004"]


DDL = "user_id int, event_id int, v string, ts timestamp_ntz"
START = dt.datetime(2024, 1, 1)


def _poll(spark, tmp_path, *parts, **args):
    """Each part as files of its own, polled one after the other."""
    source, root = str(tmp_path / "changes"), str(tmp_path / "t")
    for part in parts:
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(source)
        poll_changes_stream(
            spark, source, DDL, root, T.StructType.fromDDL(DDL), str(tmp_path / "c"), ["user_id"], "ts", "event_id", **args
        )
    return load.read_versions(spark, root, T.StructType.fromDDL(DDL))


def test_stream_equals_batch(spark, tmp_path):
    events = [(i % 7, i, f"v{i}", START + dt.timedelta(hours=i * 7 % 100)) for i in range(100)]
    parts = [events[k * 25 : k * 25 + 30] for k in range(4)]  # five rows arrive twice
    batch = newest_per_key(spark.createDataFrame(events, DDL), ["user_id"], ["ts", "event_id"])
    assert rows(_poll(spark, tmp_path, *parts, files_per_trigger=1, buckets=4)) == rows(batch)
    # A late, older event must not win; a newer one must.
    late = [(1, 500, "late", START - dt.timedelta(days=1)), (2, 501, "new", START + dt.timedelta(days=20))]
    got = {r.user_id: r.v for r in _poll(spark, tmp_path, late, buckets=4).collect()}
    assert got[2] == "new" and got[1] != "late"


def test_stream_loses_no_row(spark, tmp_path):
    early, late = START, START + dt.timedelta(days=300)
    first = [(1, 1, "a", late), (None, 2, "b", late), (None, 3, "c", late)]
    second = [(9, 4, "only row, very late", early), (None, 3, "c", late), (None, 5, "d", early)]
    got = rows(_poll(spark, tmp_path, first, second, first), "user_id", "event_id")
    assert got == [(None, 2), (None, 3), (None, 5), (1, 1), (9, 4)]
    assert len(list((tmp_path / "t" / "manifest").glob("[0-9]*"))) == 2


def test_empty_batches_write_nothing(spark, tmp_path):
    _poll(spark, tmp_path, [(1, 1, "a", START)])
    before = sorted(p.name for p in (tmp_path / "t").rglob("*"))
    _poll(spark, tmp_path, [])
    assert sorted(p.name for p in (tmp_path / "t").rglob("*")) == before


def test_null_keys_do_not_conflict(spark):
    target = spark.createDataFrame([(1, "old"), (None, "kept")], "k int, v string")
    batch = spark.createDataFrame([(None, "x", 1), (None, "y", 2), (1, "z", 1), (1, "w", 2)], "k int, v string, n int")
    merged = merge_upsert_last(target, batch, ["k"], [F.desc("n")])
    assert rows(merged, "k", "v") == [(None, "kept"), (None, "x"), (None, "y"), (1, "w")]


def test_checkpoint_dir_comes_from_the_session(spark):
    assert session.ensure_checkpoint_dir(spark)
    df = session.cut_lineage(spark.range(3))
    assert df.count() == 3 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(load.DECLARED))
def test_declared_targets_are_written_as_declared(spark, tmp_path, name):
    schema = load.schema_of(load.DECLARED[name])
    wide = T.StructType([*schema.fields, T.StructField("s_password", T.StringType()), T.StructField("other", T.IntegerType())])
    values = {"s_activate_flag": 1, "s_employee_num": "7", "is_delete": None, "s_created_time": dt.datetime(2024, 1, 20)}
    row = tuple(values.get(f.name) if f.name != "is_delete" else (False if isinstance(f.dataType, T.BooleanType) else 0) for f in wide.fields)
    root = str(tmp_path)
    load.refresh(name, spark.createDataFrame([row], wide), root, "2024-02-01 00:00:00")
    got = load.read_current(spark, f"{root}/{name}", schema)
    assert got.count() == 1 and spark.read.parquet(load.current_path(spark, f"{root}/{name}")).schema == schema
    gone = next(c for c in load.DECLARED[name] if c not in values and c not in ("is_delete", "s_lead_flag", "dd_id"))
    with pytest.raises(Exception, match=gone):
        load.refresh(name, spark.createDataFrame([row], wide).drop(gone), root, "2024-02-01 00:00:00")


def test_columns_from_the_source_database(spark, frame, tmp_path):
    """A wide table's target is declared by the database's own column list."""
    columns = [(f"s_value_{i:03d}", "decimal(10,2)" if i % 3 else "bigint(20) unsigned") for i in range(110)]
    columns += [("s_price_type", "tinyint(1)"), ("is_delete", "int(11)"), ("s_password", "varchar(64)")]
    listed = frame(
        "table_name string, column_name string, ordinal_position int, column_type string",
        *[("erp_auxiliary_material_price", c, i, t) for i, (c, t) in reversed(list(enumerate(columns)))], ("other", "x", 1, "int"),
    )
    declared = load.declared_columns(listed, "auxiliary_material_price")
    assert list(declared) == [c for c, _ in columns[:-1]] and declared["s_price_type"] == "int"
    row = tuple([1.5 if t.startswith("dec") else 7 for _, t in columns[:110]] + [True, 0, "secret"])
    kinds = ", ".join(f"{c} {'double' if t.startswith('dec') else 'long'}" for c, t in columns[:110])
    source = frame(f"{kinds}, s_price_type boolean, is_delete int, s_password string", row, row[:-2] + (1, "deleted"))
    load.refresh("auxiliary_material_price", source, str(tmp_path), declared=declared)
    got = load.read_current(spark, f"{tmp_path}/auxiliary_material_price", load.schema_of(declared))
    assert got.count() == 1 and got.first().s_price_type == 1 and "s_password" not in got.columns
    assert got.schema["s_value_001"].dataType == T.DecimalType(10, 2)
    with pytest.raises(ValueError, match="no columns listed"):
        load.declared_columns(listed, "area")


def test_every_load_is_declared(frame):
    """Fifteen by their targets, five by the column list of their source."""
    wide = set(load.LOADS) - set(load.DECLARED)
    listed = frame(
        "table_name string, column_name string, ordinal_position int, column_type string",
        *[(load.LOADS[n].source, c, i, "int") for n in wide for i, c in enumerate(["id", "is_delete", "s_price_type", "is_hidden"])],
    )
    assert len(load.DECLARED) == 15 and all(load.declared_columns(listed, n) for n in wide)
