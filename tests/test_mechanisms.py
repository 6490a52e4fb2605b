"""Cycles, incremental trees, claimed ids, checked loads, maintained counts and co-bucketed tables."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import tree
from millrace.operators.keys import duplicate_keys, singleton_groups, unambiguous_rows
from millrace.operators.merge import merge_upsert
from millrace.sources import bucketed, checked, claims, counts, snapshots

EDGES = "id long, parent_id long"


def cycles(edges):
    up = {i: p for i, p in edges if i is not None}
    found = {}
    for i in up:
        way, at = [i], up[i]
        while at in up and at not in way:
            way.append(at)
            at = up[at]
        found[i] = min(way[way.index(at) :]) if at in way and at == i else None
    return found


@pytest.mark.parametrize("seed", range(4))
def test_cycle_members(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.choice([None, rng.randrange(60), rng.randrange(60), 999])) for i in range(60)] + [(None, 3), (None, None)]
    if seed == 0:
        edges = [(i, (i + 1) % 50) for i in range(50)] + [(70, 70), (71, 70), (72, 5)]  # one long ring, a row that is its own parent
    got = tree.cycle_members(spark.createDataFrame(edges, EDGES))
    assert got.count() == len(edges)
    assert {r.id: r.cycle for r in got.collect() if r.id is not None} == cycles(edges)


def test_tables_without_cycles(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    assert {r.cycle for r in tree.cycle_members(spark.createDataFrame(chain, EDGES)).collect()} == {None}
    assert tree.cycle_members(spark.createDataFrame([], EDGES)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_changed_paths_equal_a_full_run(spark, seed):
    rng = random.Random(seed)
    ddl = "id long, parent_id long, name string"

    def changed(nodes):
        out = []
        for i, p, n in nodes:
            draw = rng.random()
            if draw < 0.06:
                continue  # went; its children dangle
            if draw < 0.12:
                p = rng.choice([None, rng.randrange(80), 999])  # moved, also into a cycle or under nothing
            elif draw < 0.18:
                n = n + "'"
            out.append((i, p, n))
        return out + [(100 + k, rng.randrange(110), f"new{k}") for k in range(4)]

    first = [(i, rng.choice([None, rng.randrange(max(1, i)), rng.randrange(90)]) if i % 9 else None, f"n{i}") for i in range(80)]
    old = tree.tree_paths(spark.createDataFrame(first, ddl))
    for _ in range(2):
        first = changed(first)
        new = spark.createDataFrame(first, ddl)
        got = tree.update_paths(old, new)
        assert rows(got, "id", "name", "complete_name", "parent_path") == rows(tree.tree_paths(new), "id", "name", "complete_name", "parent_path")
        first = [(i, p, n) for i, p, n in first if i < 100]
        new = spark.createDataFrame(first, ddl)
        old = tree.tree_paths(new)


def test_unchanged_parts_are_not_walked(spark, monkeypatch):
    """Only rows below a change go through the walk."""
    first = [(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 1, "d"), (5, 4, "e"), (6, 5, "f"), (7, None, "g"), (8, 7, "h")]
    ddl = "id long, parent_id long, name string"
    old = tree.tree_paths(spark.createDataFrame(first, ddl))
    seen, walk = [], tree.tree_paths
    monkeypatch.setattr(tree, "tree_paths", lambda df, *a: seen.append({r.id for r in df.collect()}) or walk(df, *a))
    new = spark.createDataFrame([(i, p, "D" if i == 4 else n) for i, p, n in first], ddl)
    got = {r.id: r.complete_name for r in tree.update_paths(old, new).collect()}
    assert seen == [{4, 5, 6}] and got[6] == "a / D / e / f" and got[3] == "a / b / c"
    assert {r.id: r.complete_name for r in tree.update_paths(old, spark.createDataFrame(first, ddl)).collect()}[6] == "a / d / e / f"


def test_claims_do_not_overlap(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert claims.claim_range(spark, root, "a", 10, 100) == 100
    assert claims.claim_range(spark, root, "a", 5) == 110 and claims.claim_range(spark, root, "b", 5) == 1
    # Another caller claims between this one's look and its claim.
    create, left = claims._create, [1]

    def late(*args):
        if left:
            left.pop()
            assert claims.claim_range(spark, root, "a", 7) == 115
        return create(*args)

    monkeypatch.setattr(claims, "_create", late)
    assert claims.claim_range(spark, root, "a", 3) == 122
    with pytest.raises(ValueError):
        claims.claim_range(spark, root, "a", 0)


def test_numbers_of_two_runs(spark, tmp_path):
    root = str(tmp_path)
    left = claims.number_claimed(spark.range(100).repartition(3), ["id"], "n", root, "s")
    none = claims.number_claimed(spark.range(0), ["id"], "n", root, "s")
    right = claims.number_claimed(spark.range(50), ["id"], "n", root, "s")
    assert none.collect() == []
    assert rows(left) == [(i, i + 1) for i in range(100)] and rows(right) == [(i, 101 + i) for i in range(50)]
    assert len(claims._claims(spark, f"{root}/s")) <= 2


def test_checked_load(spark, frame, tmp_path):
    df = frame("k int, v string", (1, "a"), (2, None), (None, "b"), (-1, "zzz"), (-2, "c"))
    rules = {"sign": F.col("k") > 0, "short": F.length("v") < 3}
    got = checked.load_checked(df, rules, str(tmp_path / "t"))
    assert rows(got.clean) == [(None, "b"), (1, "a"), (2, None)]
    assert rows(got.rejects) == [(-2, "c", "sign"), (-1, "zzz", "sign,short")]
    assert got.counts == {"rows": 5, "rejected": 2, "sign": 2, "short": 1}
    empty = checked.load_checked(df.limit(0), rules, str(tmp_path / "e"))
    assert empty.clean.collect() == [] and empty.rejects.collect() == [] and set(empty.counts.values()) == {0}
    free = checked.load_checked(df, {}, str(tmp_path / "f"))
    assert free.clean.count() == 5 and free.counts == {"rows": 5, "rejected": 0}


def test_a_checked_load_scans_its_source_once(spark, tmp_path):
    """Counting and splitting add no pass: the source's rows are read by one job."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.range(1000).mapInArrow(counted, "id long")
    got = checked.load_checked(source, {"even": F.col("id") % 2 == 0}, str(tmp_path / "t"))
    assert got.clean.count() == got.rejects.count() == got.counts["even"] == 500
    assert read.value == 1000


def test_commits_name_their_base(spark, tmp_path):
    root = str(tmp_path / "t")
    layout = snapshots.Layout(("id",), 2, 4)
    for i in range(3):
        snapshots.append_rows(spark.range(i, i + 1), root, layout)
    assert snapshots.numbers(spark, root) == [1, 2, 3] and snapshots.snapshot(spark, root, 2).number == 2
    assert rows(snapshots.read_table(spark, root)) == [(0,), (1,), (2,)]


COUNTED = "k int, g string, v string"


def random_rows(rng, n):
    return [(rng.choice([None, *range(12)]), rng.choice(["a", "b", None]), rng.choice(["x", "y", "z"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_maintained_counts_equal_a_full_run(spark, tmp_path, seed):
    """After every batch of added and removed rows the answers are those of the whole table."""
    rng, root, keys = random.Random(seed), str(tmp_path / "c"), ["k", "g"]
    held: list[tuple] = []
    for step in range(4):
        gone = rng.sample(held, len(held) // 3)
        new = random_rows(rng, 25 if step else 60)
        for r in gone:
            held.remove(r)
        held += new
        frames = {"added": spark.createDataFrame(new, COUNTED), "removed": spark.createDataFrame(gone, COUNTED) if gone else None}
        counts.update_counts(spark, root, keys, ["v"], **frames, layout=snapshots.Layout((counts.GROUP,), 8, 6))
        whole = spark.createDataFrame(held, COUNTED)
        assert rows(counts.read_counts(spark, root), "k", "g", "v", "n") == rows(whole.groupBy("k", "g", "v").agg(F.count("*").alias("n")))
        assert rows(counts.unambiguous_rows(spark, root, keys), *keys, "v") == rows(unambiguous_rows(whole, keys), *keys, "v")
        assert rows(counts.duplicate_keys(spark, root, keys)) == rows(duplicate_keys(whole, keys))
        assert rows(counts.singleton_groups(spark, root, keys)) == rows(singleton_groups(whole.select(*keys), keys))


def test_counts_touch_few_files_and_fail_whole(spark, tmp_path):
    root = str(tmp_path / "c")
    base = spark.range(5000).selectExpr("cast(id as int) as k")
    assert counts.update_counts(spark, root, ["k"], added=base) == 0
    assert counts.update_counts(spark, root, ["k"], added=spark.createDataFrame([(7,), (7,)], "k int")) == 1
    assert rows(counts.duplicate_keys(spark, root, ["k"])) == [(7, 3)]
    before = snapshots.numbers(spark, root)
    with pytest.raises(Exception, match="removed a row that is not there"):
        counts.update_counts(spark, root, ["k"], removed=spark.createDataFrame([(7,), (90000,)], "k int"))
    assert snapshots.numbers(spark, root) == before and rows(counts.duplicate_keys(spark, root, ["k"])) == [(7, 3)]
    one = spark.createDataFrame([(9,)], "k int")
    assert counts.update_counts(spark, root, ["k"], added=one, removed=one) == 0 and snapshots.numbers(spark, root) == before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_of_cobucketed_tables_has_no_exchange(spark, tmp_path):
    import uuid

    names = [f"t_{uuid.uuid4().hex}" for _ in range(3)]
    old = [(k, f"t{k}", k) for k in range(0, 500, 2)] + [(None, "kept", 1)]
    new = [(k, f"s{k}") for k in range(0, 500, 3)] + [(None, "x"), (None, "y")]
    target, source = spark.createDataFrame(old, "k long, v string, n long"), spark.createDataFrame(new, "k long, v string")
    a = bucketed.write_cobucketed(target, names[0], str(tmp_path / "a"), ["k"], 8)
    b = bucketed.write_cobucketed(source, names[1], str(tmp_path / "b"), ["k"], 8)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        merged = bucketed.merge_cobucketed(a, b, ["k"])
        assert "Exchange" not in plan_of(merged) and "Exchange" in plan_of(merge_upsert(target, source, ["k"]))
        assert rows(merged) == rows(merge_upsert(target, source, ["k"]))
        again = bucketed.attach_cobucketed(spark, names[2], str(tmp_path / "a"), "k long, v string, n long", ["k"], 8)
        assert rows(bucketed.merge_cobucketed(again, b, ["k"], ["n"])) == rows(merge_upsert(target, source, ["k"], ["n"]))
        assert "Exchange" not in plan_of(again.join(b, "k"))
        twice = bucketed.write_cobucketed(source.union(source), names[1], str(tmp_path / "c"), ["k"], 8)
        with pytest.raises(Exception, match="not unique"):
            bucketed.merge_cobucketed(a, twice, ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
