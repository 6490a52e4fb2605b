"""Laws that hold for any input."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import keys, lookup, merge, nesting, numbering, tree
from millrace.plans import erp


def random_state(seed, n, keep):
    rng = random.Random(seed)
    return [(k, rng.choice(["a", "b", None])) for k in range(n) if rng.random() < keep]


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_twice_is_merge_once(frame, seed):
    target = frame("id int, v string", *random_state(seed, 60, 0.6))
    source = frame("id int, v string", *random_state(seed + 100, 60, 0.6))
    once = merge.merge_upsert(target, source, ["id"])
    assert rows(merge.merge_upsert(once, source, ["id"])) == rows(once)


@pytest.mark.parametrize("seed", [3, 4])
def test_reconcile_equals_its_steps(frame, seed):
    rng = random.Random(seed)
    old = [(k, v, rng.random() < 0.5) for k, v in random_state(seed, 60, 0.6)] + [(None, "local", True)]
    target = frame("origin_id int, v string, active boolean", *old)
    source = frame("origin_id int, v string", *random_state(seed + 100, 60, 0.6))
    fused = merge.reconcile(target, source, ["origin_id"], ["v"])
    steps = merge.archive_missing(target, source, ["origin_id"])
    steps = merge.insert_missing(steps, source.withColumn("active", F.lit(True)), ["origin_id"])
    steps = merge.reactivate_returned(steps, source, ["origin_id"])
    steps = merge.update_changed(steps, source, ["origin_id"], ["v"])
    assert rows(fused) == rows(steps)
    live = {r[0] for r in rows(fused.filter("active"), "origin_id")}
    assert live == {r[0] for r in rows(source, "origin_id")}


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_ids_do_not_depend_on_partitions(spark, partitions):
    data = spark.range(0, 5000, 1, 7).withColumn("k", F.col("id") * 31 % 5003)
    top = spark.range(10).withColumnRenamed("id", "last")
    numbered = numbering.number_rows(data, ["k"], "n", after=(top, "last"), partitions=partitions)
    assert rows(numbered.select("n")) == [(i,) for i in range(10, 5010)]
    expected = {k: i for i, k in enumerate(sorted(i * 31 % 5003 for i in range(5000)), start=10)}
    assert {r.k: r.n for r in numbered.collect()} == expected


def test_latest_equals_anti_join(frame):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None])) for i in range(80)]
    expected = [
        r for r in data
        if not any(o[1] == r[1] and o[2] == r[2] and None not in (r[1], r[2]) and o[0] > r[0] for o in data)
    ]
    got = keys.latest_per_key(frame("id int, a string, b int", *data), ["a", "b"], "id")
    assert [r[0] for r in rows(got, "id")] == [r[0] for r in expected]


def hot_rows(frame):
    """One key holds two thirds of the rows."""
    rng = random.Random(6)
    return [(0 if rng.random() < 0.66 else rng.randrange(1, 20), i, rng.randrange(5)) for i in range(600)]


def test_hot_group_is_numbered_the_same(frame):
    data = frame("g int, o int, v int", *hot_rows(frame))
    plain = numbering.number_in_group(data, ["g"], ["o"], "n", hot_rows=10_000_000)
    ranged = numbering.number_in_group(data, ["g"], ["o"], "n", hot_rows=50)
    assert rows(plain) == rows(ranged)


def test_hot_runs_are_numbered_the_same(frame):
    data = frame("g int, o int, v int", *hot_rows(frame))
    plain = numbering.number_runs(data, ["g"], ["v"], "n", hot_rows=10_000_000)
    assert rows(plain) == rows(numbering.number_runs(data, ["g"], ["v"], "n", hot_rows=50))


def test_rows_are_not_dealt_by_hot_group(frame):
    data = frame("g int, o int, v int", *hot_rows(frame))
    ranged = numbering.number_in_group(data, ["g"], ["o"], "n", hot_rows=50)
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "LeftAnti" in line or "LeftSemi" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_null_is_a_hot_group_too(frame, monkeypatch):
    data = frame("g int, o int, v int", *[(g or None, o, v or None) for g, o, v in hot_rows(frame)])
    seen, real = [], numbering._number_ranges
    monkeypatch.setattr(numbering, "_number_ranges", lambda df, *a: seen.append(df.filter("g IS NULL").count()) or real(df, *a))
    for number, order in ((numbering.number_in_group, "o"), (numbering.number_runs, "v")):
        plain = number(data, ["g"], [order], "n", hot_rows=10_000_000)
        assert rows(number(data, ["g"], [order], "n", hot_rows=50)) == rows(plain)
    assert seen[0] == data.filter("g IS NULL").count()


@pytest.mark.parametrize("max_items", [7, 50, 1000])
def test_parts_hold_every_child_in_order(frame, max_items):
    data = hot_rows(frame)
    df = frame("g int, o int, v int", *data)
    parts = nesting.nested_collect(df, ["g"], ["o"], F.col("o"), "items", max_items=max_items).collect()
    assert all(len(p["items"]) <= max_items for p in parts)
    joined = {}
    for p in sorted(parts, key=lambda r: r.part):
        joined.setdefault(p.g, []).extend(p["items"])
    expected = {}
    for g, o, _ in data:
        expected.setdefault(g, []).append(o)
    assert joined == {g: sorted(v) for g, v in expected.items()}
    # Detected or not, the parts are the same.
    blind = nesting.nested_collect(df, ["g"], ["o"], F.col("o"), "items", max_items=max_items, detect=False)
    assert sorted(map(tuple, blind.collect())) == sorted(map(tuple, parts))


@pytest.mark.parametrize("max_items", [7, 1000])
def test_several_lists_share_their_parts(frame, max_items):
    data = hot_rows(frame)
    many = frame("g int, o int, v int", *data)
    few = many.filter("o < 100")
    heads = frame("g int, name string", *[(g, f"h{g}") for g in range(25)])
    lists = {"a": (many, ["o"], F.col("o")), "b": (few, ["o"], F.col("v"))}
    hot = frame("g int", (0,)) if max_items == 7 else None
    with_hot = nesting.collect_lists(heads, ["g"], lists, hot, max_items)
    without = nesting.collect_lists(heads, ["g"], lists, None, max_items)
    key = lambda r: (r.g, r.part)
    assert sorted(with_hot.collect(), key=key) == sorted(without.select(*with_hot.columns).collect(), key=key)
    got = sorted(without.filter("g = 0").collect(), key=key)
    assert [x for r in got for x in r.a] == [o for g, o, _ in data if g == 0]
    assert [x for r in got for x in r.b] == [v for g, o, v in data if g == 0 and o < 100]
    assert without.select("g").distinct().count() == 25


def test_single_part_fails_rather_than_cuts(frame):
    df = frame("g int, v int", *[(1, i) for i in range(10)])
    whole = nesting.single_part(nesting.distinct_list(df, ["g"], "v", "l"))
    assert rows(whole) == [(1, "[0,1,2,3,4,5,6,7,8,9]")]
    with pytest.raises(Exception, match="one cell"):
        nesting.single_part(nesting.distinct_list(df, ["g"], "v", "l", max_items=4)).collect()


def test_salted_and_spread_lookup_change_nothing(frame):
    fact = frame("id int, k int", *[(i, None if i % 3 == 0 else i % 5) for i in range(100)])
    dim = frame("k int, name string", (0, "z"), (1, "a"), (2, "b"), (None, "never"))
    plain = rows(lookup.lookup(fact, dim, {"k": "k"}, {"name": "name"}))
    names = {0: "z", 1: "a", 2: "b"}
    key = {i: None if i % 3 == 0 else i % 5 for i in range(100)}
    assert {r[0]: r[2] for r in plain} == {i: names.get(k) for i, k in key.items()}
    assert rows(lookup.lookup(fact, dim, {"k": "k"}, {"name": "name"}, salt=4)) == plain


def test_folded_role_lookup_equals_joins(frame):
    rng = random.Random(8)
    fact = frame("id int, a int, b int", *[(i, rng.choice([None, 1, 2, 9]), rng.choice([None, 1, 3])) for i in range(40)])
    dim = frame("k int, name string, code string", (1, "x", None), (2, "y", "Y"), (3, "z", "Z"))
    roles = {"a": {"an": "name", "ac": "code"}, "b": {"bn": "name"}}
    chained = lookup.role_lookup(fact, dim, "k", roles)
    folded = lookup.role_lookup_folded(fact, dim, "k", "id", roles)
    columns = ["id", "a", "b", "an", "ac", "bn"]
    assert rows(chained, *columns) == rows(folded, *columns)


def test_override_by_parent_counts_the_repeats(frame):
    children = frame("p int, c int, v int", (1, 1, 10), (1, 2, 11), (2, 1, 12), (2, 1, 12))
    overrides = frame("p int, c int, v int", (1, 5, 50), (1, 6, 60))
    out = lookup.override_by_parent(children, overrides, ["p"], ["c", "v"])
    assert rows(out) == [(1, 5, 50, 2), (1, 6, 60, 2), (2, 1, 12, 2)]


@pytest.mark.parametrize("seed", [11, 12])
def test_tree_walks_agree_with_a_plain_walk(frame, seed):
    rng = random.Random(seed)
    parent = {0: None}
    for i in range(1, 120):
        # Long chains and bushy parts, with a few parents that do not exist.
        parent[i] = rng.choice([i - 1, i - 1, rng.randrange(i), 1000 + i if rng.random() < 0.1 else i - 1])
    code = {i: (f"c{i}" if rng.random() < 0.1 else None) for i in parent}
    df = frame("id int, parent_id int, name string, code string", *[(i, p, f"n{i}", code[i]) for i, p in parent.items()])

    def chain(i):
        out = []
        while i is not None:
            if i not in parent:
                return None
            out.append(i)
            i = parent[i]
        return out[::-1]

    def nearest(i):
        while i in parent:
            if code[i] is not None:
                return code[i]
            i = parent[i]
        return None

    got = {r.id: r.parent_path for r in tree.tree_paths(df).collect()}
    assert got == {i: ("/".join(map(str, chain(i))) + "/" if chain(i) else None) for i in parent}
    assert {r.id: r.code for r in tree.inherit_from_ancestor(df).collect()} == {i: nearest(i) for i in parent}


def test_a_wide_tree_meets_its_root_without_a_shuffle(frame, spark):
    """One root, 100,000 children: they are joined with a broadcast root, so no task gathers them."""
    root = spark.createDataFrame([(0, None, "top", "R")], "id long, parent_id long, name string, code string")
    wide = spark.range(1, 100_001).selectExpr("id", "0L as parent_id", "concat('n', id) as name", "cast(null as string) as code")
    deep = spark.range(100_001, 100_051).selectExpr("id", "id - 100000 as parent_id", "'d' as name", "cast(null as string) as code")
    df = root.unionByName(wide).unionByName(deep)
    plans = []
    cut = tree.cut_lineage

    def watched(part):
        plans.append(part._jdf.queryExecution().executedPlan().toString())
        return cut(part)

    tree.cut_lineage = watched
    try:
        paths = {r.id: r.parent_path for r in tree.tree_paths(df).select("id", "parent_path").collect()}
        codes = tree.inherit_from_ancestor(df).filter("code = 'R'").count()
    finally:
        tree.cut_lineage = cut
    assert paths[0] == "0/" and paths[77] == "0/77/" and paths[100_050] == "0/50/100050/"
    assert codes == 100_051
    assert any("BroadcastHashJoin" in p for p in plans)


def test_numbering_moves_rows_once(spark, monkeypatch):
    df = spark.range(0, 1000).selectExpr("id * 7919 % 1000 as k", "id")
    numbered = numbering.number_rows(df, ["k"], "n", partitions=5)
    assert {r.k: r.n for r in numbered.collect()} == {k: k + 1 for k in range(1000)}
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number" not in plan and "Window [sum" in plan


def test_only_new_rows_are_numbered(spark):
    target = spark.createDataFrame([(1, "a", "x"), (5, "b", "y")], "id long, k string, v string")
    source = spark.createDataFrame([("b", "z"), ("c", "n"), (None, "m")], "k string, v string")
    merged = merge.upsert_numbered(target, source, ["k"], ["v"])
    got = {r.k: (r.id, r.v) for r in merged.collect()}
    assert got["a"] == (1, "x") and got["b"] == (5, "z") and {got["c"], got[None]} == {(6, "m"), (7, "n")}
    again = merge.upsert_numbered(merged.dropna(subset=["k"]), source.dropna(), ["k"], ["v"])
    assert {r.k: r.id for r in again.collect()} == {"a": 1, "b": 5, "c": got["c"][0]}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _departments(frame):
    target = frame(
        "id long, origin_id long, name string, origin_parent_id long, parent_id long, complete_name string, parent_path string, "
        "active boolean, company_id int, write_date timestamp_ntz",
        (5, 1, '{"zh_CN":"a"}', None, None, None, None, True, None, None), (6, None, '{"zh_CN":"l"}', 1, None, "kept", "kept", True, None, None),
    )
    depart = frame(
        "dd_id long, dd_name string, s_en_name string, s_jp_name string, dd_parent_id long",
        (1, "a", None, None, None), (2, "b", None, None, 1), (3, "c", None, None, 2), (4, "lost", None, None, 99), (None, "n", None, None, 77),
    )
    return erp.departments(target, depart, F.lit(1), F.lit("2024-01-01").cast("timestamp_ntz"))


def test_departments_are_reconciled_once(frame):
    found = _departments(frame)
    assert rows(found.filter("origin_id < 4"), "origin_id", "id", "complete_name", "parent_path") == [
        (1, 5, "a", "5/"), (2, 7 + 1, "a / b", "5/8/"), (3, 7 + 2, "a / b / c", "5/8/9/")]
    # What is left is the walk's join with files: neither the source nor the join with the target is read again.
    assert "dd_id" not in _plan(found) and _plan(found).count("Join") == 1


def test_people_are_joined_once_for_resources_and_employees(frame):
    resources = frame("id long, origin_id long, name string, resource_type string, active boolean", (50, 1, "Old", "user", True))
    staff = frame(
        "id long, resource_id long, origin_id long, name string, employee_type string, active boolean, barcode string, "
        "department_id long, job_id long", (7, None, 2, "old", "employee", True, None, None, None),
    )
    manager = frame(
        "s_manager_id long, s_account string, s_cellphone string, s_email string, s_activate_flag int, dd_depart_ids string, s_talent_id long",
        (1, "a", None, None, 1, "3", 1), (2, "b", None, None, 0, "", 2), (3, "c", None, None, 1, None, 3),
    )
    archive = frame("s_talent_archives_id long, s_employee_num string, s_talent_position_id long", (1, "E1", 4), (2, None, 4), (3, "E3", None))
    job = frame("id long, origin_id long", (40, 4))
    people = erp.employees(resources, staff, manager, archive, _departments(frame), job, F.lit(1), F.lit("2024-01-01").cast("timestamp_ntz"))
    assert rows(people[0], "id", "origin_id", "name", "active") == [(50, 1, "a", True), (51, 2, "b", False), (52, 3, "c", True)]
    assert rows(people[1], "id", "origin_id", "resource_id", "department_id", "job_id", "barcode") == [
        (7, 2, None, None, 40, None), (8, 1, 50, 9, 40, "E1"), (9, 3, 52, None, None, "E3")]
    for out in people:
        assert "s_talent_archives_id" not in _plan(out) and "dd_depart_ids" not in _plan(out)
