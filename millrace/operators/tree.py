"""Adjacency-list trees of any depth.

Both walks double the distance they look ahead in every round, so a tree of depth
d takes about log2(d) joins, and each round starts from checkpointed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import null_spread, small, spread_zero
from millrace.session import cut_lineage


def _rounds(state: DataFrame) -> int:
    """Rounds after which every chain without a cycle has ended."""
    return max(1, state.count()).bit_length() + 1


def _above(df: DataFrame) -> DataFrame:
    """Rows as others look up at them."""
    return df.select(*[F.col(c).alias(f"a_{c}") for c in ("node", "up", "names", "ids", "reached")])


def tree_paths(
    df: DataFrame,
    id_column: str = "id",
    parent: str = "parent_id",
    name: str = "name",
    name_path: str = "complete_name",
    id_path: str = "parent_path",
    separator: str = " / ",
) -> DataFrame:
    """Readable path ``a / b / c`` and id path ``1/4/9/`` from the root down.

    Rows that no root reaches (dangling parent, cycle) get null in both columns.
    """
    state = df.select(
        F.col(id_column).alias("node"),
        F.col(parent).alias("up"),
        F.col(name).alias("names"),
        F.concat(F.col(id_column).cast("string"), F.lit("/")).alias("ids"),
        F.lit(True).alias("reached"),
        # A root names itself, any other row nobody.
        F.when(F.col(parent).isNull(), F.col(id_column)).alias("root"),
    )
    root_type = state.schema["root"].dataType
    state = cut_lineage(state)
    rounds = _rounds(state)
    roots = cut_lineage(state.filter(F.col("up").isNull()))
    # Finished rows are set aside: they are looked up, but not joined or written again. In a wide
    # tree most rows soon point at a root; these are joined with the roots alone.
    done, active = roots, state.filter(F.col("up").isNotNull())
    top = small(_above(roots))
    for _ in range(rounds):
        if active.isEmpty():
            break
        under_root = active.join(top, F.col("up") == F.col("a_node"))
        others = active.join(top, F.col("up") == F.col("a_node"), "left_anti")
        above = _above(active.unionByName(done.filter(F.col("root").isNull())))
        spread = others.withColumn("_spread", null_spread(others, ["up"]))
        moved = spread.join(
            above.withColumn("_zero", spread_zero(["a_node"])),
            (F.col("up") == F.col("a_node")) & (F.col("_spread") == F.col("_zero")), "left",
        ).drop("_spread", "_zero")
        both = under_root.unionByName(moved)
        reached = F.coalesce("a_reached", F.lit(False))
        ids = F.concat("a_ids", "ids")
        # A lost chain needs no further joins, and a cycle must not grow its text.
        lost = ~reached | ids.rlike(r"^([^/]+)/(.*/)?\1/")
        step = both.select(
            "node",
            F.when(~lost, F.col("a_up")).alias("up"),
            F.when(~lost, F.concat("a_names", F.lit(separator), "names")).alias("names"),
            F.when(~lost, ids).alias("ids"),
            (~lost).alias("reached"),
            F.lit(None).cast(root_type).alias("root"),
        )
        step = cut_lineage(step)
        open_rows = F.col("up").isNotNull() & F.col("reached")
        done, active = done.unionByName(step.filter(~open_rows)), step.filter(open_rows)
    state = done.unionByName(active)
    finished = F.col("reached") & F.col("up").isNull()
    paths = state.select(
        F.col("node").alias("_node"),
        F.when(finished, F.col("names")).alias(name_path),
        F.when(finished, F.col("ids")).alias(id_path),
    )
    kept = df.drop(name_path, id_path)
    return kept.join(paths, kept[id_column] == paths["_node"], "left").drop("_node")


def inherit_from_ancestor(
    df: DataFrame, id_column: str = "id", parent: str = "parent_id", column: str = "code"
) -> DataFrame:
    """Fill a null ``column`` with the value of the nearest ancestor that has one."""
    state = cut_lineage(
        df.select(
            F.col(id_column).alias("node"), F.col(parent).alias("up"), F.col(column).alias("value"),
            F.col(parent).isNull().alias("root"),
        )
    )
    rounds = _rounds(state)
    open_rows = F.col("value").isNull() & F.col("up").isNotNull()
    done, pending = state.filter(~open_rows), state.filter(open_rows)

    def above(df: DataFrame) -> DataFrame:
        return df.select(F.col("node").alias("a_node"), F.col("up").alias("a_up"), F.col("value").alias("a_value"))

    # As in tree_paths: settled rows stay aside, and rows under a root meet the roots alone.
    roots = small(above(cut_lineage(state.filter("root"))))
    for _ in range(rounds):
        if pending.isEmpty():
            break
        under_root = pending.join(roots, F.col("up") == F.col("a_node"))
        others = pending.join(roots, F.col("up") == F.col("a_node"), "left_anti")
        inner = above(pending.unionByName(done.filter("not root")))
        # Between a row and its pointer no row has a value, so the first hit is the nearest.
        moved = under_root.unionByName(others.join(inner, F.col("up") == F.col("a_node"), "left"))
        moved = cut_lineage(moved.select("node", F.col("a_up").alias("up"), F.col("a_value").alias("value"), F.lit(False).alias("root")))
        done, pending = done.unionByName(moved.filter(~open_rows)), moved.filter(open_rows)
    state = done.unionByName(pending)
    found = state.select(F.col("node").alias("_node"), F.col("value").alias("_value"))
    joined = df.join(found, F.col(id_column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce(column, "_value")).select(*df.columns)


def cycle_members(df: DataFrame, id_column: str = "id", parent: str = "parent_id", out: str = "cycle") -> DataFrame:
    """``df`` with ``out``: for a row that lies on a cycle of parents the smallest id of that cycle, else null.

    Rows below a cycle, rows under a root or a missing parent, and rows with a null id are on none; a row that is its own parent is
    a cycle of one. Ids are unique. Only rows that are someone's parent can lie on a cycle; from these, pointers double their
    distance each round and rows no pointer reaches any more are dropped, so that trees vanish in about log2(depth) rounds and a
    table without cycles ends there.
    """
    edges = df.select(F.col(id_column).alias("node"), F.col(parent).alias("up")).filter("node IS NOT NULL AND up IS NOT NULL")
    state = edges.join(edges.select(F.col("up").alias("node")).distinct(), "node", "left_semi")
    state = cut_lineage(state.withColumn("least", F.least("node", "up")))
    # After a distance of all rows, what is still pointed at lies on a cycle, and the least id of the way is that of the cycle.
    for _ in range(_rounds(state)):
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("a_up"), F.col("least").alias("a_least"))
        moved = state.join(ahead, "up").select("node", F.col("a_up").alias("up"), F.least("least", "a_least").alias("least"))
        moved = cut_lineage(moved)
        state = cut_lineage(moved.join(moved.select(F.col("up").alias("node")).distinct(), "node", "left_semi"))
        if state.isEmpty():
            break
    found = state.select(F.col("node").alias("_node"), F.col("least").alias("_least"))
    joined = df.withColumn("_spread", null_spread(df, [id_column])).join(
        found.withColumn("_zero", spread_zero(["_node"])), (F.col(id_column) == F.col("_node")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    return joined.select(*[c for c in df.columns if c != out], F.col("_least").alias(out))


def update_paths(
    old: DataFrame,
    new: DataFrame,
    id_column: str = "id",
    parent: str = "parent_id",
    name: str = "name",
    name_path: str = "complete_name",
    id_path: str = "parent_path",
    separator: str = " / ",
) -> DataFrame:
    """The paths of a changed snapshot from those of the last one: what ``tree_paths(new)`` gives.

    ``old`` has the columns and paths of the last snapshot, ``new`` the rows of this one. Rows that came or whose name or parent
    changed, and children whose parent went, begin the parts to do; from them the change goes down, a level a round, to all rows below.
    Only these are walked again, hung under the paths above them that still hold; all other rows keep theirs.
    """
    before = old.select(
        F.col(id_column).alias("_id"), F.col(parent).alias("_up"), F.col(name).alias("_name"),
        F.col(name_path).alias(name_path), F.col(id_path).alias(id_path), F.lit(True).alias("_was"),
    )
    kept = [c for c in new.columns if c not in (name_path, id_path)]
    state = new.select(*kept).join(before, F.col(id_column) == F.col("_id"), "left")
    same = F.col("_was").isNotNull() & F.col("_up").eqNullSafe(F.col(parent)) & F.col("_name").eqNullSafe(F.col(name))
    state = cut_lineage(state.withColumn("_changed", ~same).select(*kept, name_path, id_path, "_changed"))
    edges = state.select(F.col(id_column).alias("node"), F.col(parent).alias("up"))
    went = old.select(F.col(id_column).alias("up")).join(edges.select(F.col("node").alias("up")), "up", "left_anti")
    below = edges.join(small(went), "up", "left_semi").select("node")
    todo = cut_lineage(state.filter("_changed").select(F.col(id_column).alias("node")).unionByName(below).distinct())
    front = todo
    while not front.isEmpty():
        reached = edges.join(small(front.select(F.col("node").alias("up"))), "up", "left_semi").select("node")
        front = cut_lineage(reached.join(todo, "node", "left_anti"))
        todo = cut_lineage(todo.unionByName(front))
    again = state.join(todo, F.col(id_column) == F.col("node"), "left_semi")
    # A row whose parent is not walked again is the top of its part.
    top = todo.select(F.col("node").alias("_todo"))
    inner = again.select(id_column, parent, name).join(top, F.col(parent) == F.col("_todo"), "left")
    cut = F.when(F.col("_todo").isNotNull(), F.col(parent))
    parts = tree_paths(inner.select(id_column, F.col(parent).alias("_real"), cut.alias(parent), name), id_column, parent, name, name_path, id_path, separator)
    parts = cut_lineage(parts.withColumn("_top", F.split_part(F.col(id_path), F.lit("/"), F.lit(1))))
    # Paths above the tops: those of rows that hold, looked up by the tops' parents.
    tops = parts.filter(F.col(parent).isNull()).select(F.col(id_column).cast("string").alias("_t"), F.col("_real").alias("_above"))
    above = state.join(todo, F.col(id_column) == F.col("node"), "left_anti").select(
        F.col(id_column).alias("_a"), F.col(name_path).alias("_names"), F.col(id_path).alias("_ids"))
    hung = tops.join(above, F.col("_above") == F.col("_a"), "left")
    # A root hangs under nothing; a top whose parent is missing or has no path gives none to its part.
    hung = hung.select(
        "_t", F.when(F.col("_above").isNull(), F.lit("")).otherwise(F.concat("_names", F.lit(separator))).alias("_names"),
        F.when(F.col("_above").isNull(), F.lit("")).otherwise(F.col("_ids")).alias("_ids"),
    )
    walked = parts.join(hung, F.col("_top") == F.col("_t"), "left").select(
        F.col(id_column).alias("_id"), F.concat("_names", name_path).alias(name_path), F.concat("_ids", id_path).alias(id_path))
    rest = state.select(*kept).join(walked, F.col(id_column) == F.col("_id"))
    holding = state.join(todo, F.col(id_column) == F.col("node"), "left_anti")
    return holding.select(*kept, name_path, id_path).unionByName(rest.select(*kept, name_path, id_path))


def leaf_flag(
    df: DataFrame, id_column: str = "id", parent: str = "parent_id", out: str = "is_leaf"
) -> DataFrame:
    """True for rows nobody points to; recomputed both ways."""
    parents = df.select(F.col(parent).alias("_parent")).filter(F.col("_parent").isNotNull())
    joined = df.join(parents.distinct(), F.col(id_column) == F.col("_parent"), "left")
    kept = [c for c in df.columns if c != out]
    return joined.select(*kept, F.col("_parent").isNull().alias(out))


def children_of(df: DataFrame, node, parent: str = "parent_id") -> DataFrame:
    return df.filter(F.col(parent) == F.lit(node))


def _with_parent(df: DataFrame, id_column: str, parent: str, deleted: str) -> DataFrame:
    above = df.select(
        F.col(id_column).alias("_p_id"), F.col(deleted).alias("_p_deleted"), spread_zero([id_column]).alias("_zero")
    )
    return df.withColumn("_spread", null_spread(df, [parent])).join(
        above, (F.col(parent) == F.col("_p_id")) & (F.col("_spread") == F.col("_zero")), "left"
    )


def visible_rows(
    df: DataFrame,
    id_column: str = "id",
    parent: str = "parent_id",
    deleted: str = "deleted_time",
    strict: bool = False,
) -> DataFrame:
    """Rows not deleted whose parent is none or not deleted.

    A parent that is missing from the table counts as not deleted, unless ``strict``.
    """
    joined = _with_parent(df, id_column, parent, deleted)
    parent_ok = F.col("_p_deleted").isNull()
    if strict:
        parent_ok = parent_ok & F.col("_p_id").isNotNull()
    visible = F.col(deleted).isNull() & (F.col(parent).isNull() | parent_ok)
    return joined.filter(visible).select(*df.columns)


def dangling_parents(
    df: DataFrame,
    id_column: str = "id",
    parent: str = "parent_id",
    deleted: str = "deleted_time",
) -> DataFrame:
    """Live rows under a deleted parent."""
    joined = _with_parent(df, id_column, parent, deleted)
    bad = F.col(deleted).isNull() & F.col("_p_deleted").isNotNull()
    return joined.filter(bad).select(*df.columns)
