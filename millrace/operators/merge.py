"""Keyed merges that turn (target snapshot, source) into the next target snapshot.

Presence is decided by flags on both sides, never by testing data for null. Rows
whose key has a null never match; they are kept, and spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions import differs
from millrace.operators.lookup import fan_out, missing_from, present_in
from millrace.operators.numbering import number_rows
from millrace.operators.skew import any_null, key_side, null_spread, spread_zero
from millrace.session import cut_lineage


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` in the columns and types of ``like``; absent columns become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def _source_side(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source with prefixed columns and a presence flag that fails on a repeated key.

    The count runs over the partitioning the join needs anyway, so the check costs
    no shuffle of its own.
    """
    spread = source.withColumn("_spread", null_spread(source, keys))
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_spread"))
    repeated = (copies > 1) & ~any_null(keys)
    flag = F.when(repeated, F.raise_error(F.lit("merge: source key is not unique"))).otherwise(
        F.lit(True)
    )
    flagged = spread.withColumn("_in", flag.cast("boolean"))
    return flagged.select(*[F.col(c).alias(f"_s_{c}") for c in [*source.columns, "_spread", "_in"]])


def _full_join(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    left = target.withColumn("_spread", null_spread(target, keys)).withColumn("_in", F.lit(True))
    condition = [F.col(k) == F.col(f"_s_{k}") for k in [*keys, "_spread"]]
    return left.join(_source_side(source, keys), condition, "full_outer")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Insert or update by key. Matched rows take only the ``update`` columns from
    the source; new rows take every column the source has."""
    have = set(source.columns)
    update = set(have if update is None else update) - set(keys)
    in_target, in_source = F.col("_in").isNotNull(), F.col("_s__in").isNotNull()
    out = []
    for field in target.schema.fields:
        name = field.name
        old = F.col(name)
        new = (F.col(f"_s_{name}") if name in have else F.lit(None)).cast(field.dataType)
        if name in update and name in have:
            value = F.when(in_source, new).otherwise(old)
        else:
            value = F.when(in_target, old).otherwise(new)
        out.append(value.alias(name))
    return _full_join(target, source, keys).select(*out)


def merge_upsert_last(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert of a batch that may repeat a key: the first row in ``order_by`` wins.

    Rows with a null in their key conflict with nothing, not even with each other: all are inserted.
    """
    return merge_upsert(target, first_per_key(source, keys, order_by), keys, update)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every complete key (limited per group ahead of the shuffle), and all rows without one."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    keyed = df.filter(~any_null(keys)).withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")
    return keyed.unionByName(df.filter(any_null(keys)))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the source rows whose key the target lacks; leave matched rows alone."""
    new = missing_from(source, target, {k: k for k in keys})
    return target.unionByName(_typed(new, target))


def insert_numbered(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    id_column: str = "id",
) -> DataFrame:
    """``insert_missing`` that also gives the new rows surrogate ids after the maximum."""
    new = missing_from(source, target, {k: k for k in keys})
    numbered = number_rows(new, list(keys), id_column, after=(target, id_column))
    return target.unionByName(_typed(numbered, target))


def upsert_numbered(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    id_column: str = "id",
    ids_in: DataFrame | None = None,
) -> DataFrame:
    """``merge_upsert`` that gives the new rows surrogate ids after the maximum of
    ``ids_in`` (default: the target)."""
    known = set(update) - {id_column}
    return merge_upsert(target, give_ids(source, target, keys, id_column, ids_in), keys, sorted(known))


def give_ids(
    source: DataFrame, target: DataFrame, keys: Sequence[str], id_column: str = "id", ids_in: DataFrame | None = None
) -> DataFrame:
    """``source`` with ids, after the maximum of ``ids_in`` (default: the target), for the rows the target lacks.

    Rows the target has come without an id; a merge keeps the target's. Only the new rows are
    ordered and written to be numbered, however large the target is.
    """
    on = {k: k for k in keys}
    plain = source.drop(id_column)
    ids_in = target if ids_in is None else ids_in
    new = number_rows(missing_from(plain, target, on), list(keys), id_column, after=(ids_in, id_column))
    known = present_in(plain, target, on).withColumn(id_column, F.lit(None).cast(new.schema[id_column].dataType))
    return known.unionByName(new)


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()):
    """Target rows with ``_in`` set where the source has the key, and its ``extra`` columns.

    Without extra columns a repeated source key is harmless; with them it fails.
    """
    left = target.withColumn("_spread", null_spread(target, keys))
    if extra:
        side = _source_side(source.select(*keys, *extra), keys).withColumnRenamed("_s__in", "_in")
        meet = "_s__spread"
    else:
        side = key_side(source, keys, "_s_").withColumn("_in", F.lit(True))
        meet = "_zero"
    condition = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    return left.join(side, [*condition, F.col("_spread") == F.col(meet)], "left")


def archive_missing(
    target: DataFrame, source: DataFrame, keys: Sequence[str], active: str = "active"
) -> DataFrame:
    """Rows whose key left the source (or is null) become inactive."""
    state = F.when(F.col("_in").isNull(), F.lit(False)).otherwise(F.col(active))
    return _matched(target, source, keys).withColumn(active, state).select(*target.columns)


def reactivate_returned(
    target: DataFrame, source: DataFrame, keys: Sequence[str], active: str = "active"
) -> DataFrame:
    """Inactive rows whose key is back in the source become active."""
    back = F.col("_in").isNotNull() & (F.col(active) == F.lit(False))
    state = F.when(back, F.lit(True)).otherwise(F.col(active))
    return _matched(target, source, keys).withColumn(active, state).select(*target.columns)


def update_changed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stamp: tuple[str, Column] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Overwrite ``columns`` where any of them differs and stamp the changed rows.

    ``null_safe=False`` is the plain ``<>`` test, blind to changes from or to null.
    """
    changed = F.lit(False)
    for c in columns:
        one = differs(F.col(c), F.col(f"_s_{c}"), null_safe)
        changed = changed | (one if null_safe else F.coalesce(one, F.lit(False)))
    changed = F.col("_in").isNotNull() & changed
    joined = _matched(target, source, keys, columns).withColumn("_changed", changed)
    out = []
    for field in target.schema.fields:
        value = F.col(field.name)
        if field.name in columns:
            new = F.col(f"_s_{field.name}").cast(field.dataType)
            value = F.when(F.col("_changed"), new).otherwise(value)
        elif stamp and field.name == stamp[0]:
            value = F.when(F.col("_changed"), stamp[1].cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return joined.select(*out)


def reconcile(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    active: str = "active",
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Archive, insert, reactivate and update in one pass over one join.

    New rows arrive active unless the source brings the ``active`` column itself,
    in which case it is also kept up to date for matched rows.
    """
    have = set(source.columns)
    in_target, in_source = F.col("_in").isNotNull(), F.col("_s__in").isNotNull()
    both = in_target & in_source
    tracked = [*columns, *([active] if active in have else [])]
    changed = F.lit(False)
    for c in tracked:
        changed = changed | differs(F.col(c), F.col(f"_s_{c}"))
    joined = _full_join(target, source, keys).withColumn("_changed", both & changed)
    out = []
    for field in target.schema.fields:
        name, old = field.name, F.col(field.name)
        new = (F.col(f"_s_{name}") if name in have else F.lit(None)).cast(field.dataType)
        if name == active:
            value = F.when(in_source, new if active in have else F.lit(True)).otherwise(F.lit(False))
        elif name in columns:
            value = F.when(in_source, new).otherwise(old)
        elif stamp and name == stamp[0]:
            value = F.when(F.col("_changed"), stamp[1].cast(field.dataType))
            value = value.otherwise(F.when(in_target, old).otherwise(new))
        else:
            value = F.when(in_target, old).otherwise(new)
        out.append(value.alias(name))
    return joined.select(*out)


def deactivate_unlinked(
    target: DataFrame, key: str, active: str = "active", only: Column | None = None
) -> DataFrame:
    """Rows without a natural key become inactive, optionally only some kinds of row."""
    hit = F.col(key).isNull() if only is None else F.col(key).isNull() & F.coalesce(only, F.lit(False))
    return target.withColumn(active, F.when(hit, F.lit(False)).otherwise(F.col(active)))


def insert_two_tables(
    parents: DataFrame,
    children: DataFrame,
    source: DataFrame,
    key: str,
    parent_id: str = "id",
    child_id: str = "id",
    link: str = "parent_id",
) -> tuple[DataFrame, DataFrame]:
    """Add missing parents, then missing children that point at their parent's id.

    One pass: a child finds its parent whether that row is old or new.
    """
    new_parents = missing_from(source, parents, {key: key})
    numbered = number_rows(new_parents, [key], parent_id, after=(parents, parent_id))
    parents_out = parents.unionByName(_typed(numbered, parents))
    new_children = missing_from(source, children, {key: key})
    ids = parents_out.select(F.col(key).alias("_key"), F.col(parent_id).alias(link))
    linked = new_children.drop(link).join(ids, F.col(key) == F.col("_key")).drop("_key")
    numbered = number_rows(linked, [key], child_id, after=(children, child_id))
    return parents_out, children.unionByName(_typed(numbered, children))


def insert_with_sidecar(
    target: DataFrame,
    sidecar: DataFrame,
    candidates: DataFrame,
    order_by: Sequence[str],
    link: str,
    id_column: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """Give every candidate one new sidecar row and link it by id.

    ``order_by`` is a unique key of the candidates. Both ids come from a single numbering.
    """
    numbered = number_rows(candidates, order_by, "_rn")
    last_main = target.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    last_side = sidecar.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    rows = numbered.withColumn(id_column, F.col("_rn") + last_main).withColumn(
        link, F.col("_rn") + last_side
    )
    side_rows = rows.select(F.col(link).alias(id_column))
    return (
        target.unionByName(_typed(rows, target)),
        sidecar.unionByName(_typed(side_rows, sidecar)),
    )


def backfill_parent(
    df: DataFrame,
    natural: str = "origin_id",
    natural_parent: str = "origin_parent_id",
    id_column: str = "id",
    out: str = "parent_id",
) -> DataFrame:
    """Set the parent's surrogate id from its natural key; unresolved rows keep theirs."""
    ids = df.filter(F.col(natural).isNotNull()).select(
        F.col(natural).alias("_natural"), F.col(id_column).alias("_parent"), spread_zero([natural]).alias("_zero")
    )
    joined = df.withColumn("_spread", null_spread(df, [natural_parent])).join(
        ids,
        (F.col(natural_parent) == F.col("_natural")) & (F.col("_spread") == F.col("_zero")),
        "left",
    )
    return joined.withColumn(out, F.coalesce("_parent", out)).select(*df.columns)


def fill_null_from(df: DataFrame, values: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Set ``column`` from ``values`` only where it is null and a value exists."""
    side = values.select(*on, F.col(column).alias("_fill"))
    joined = df.join(side, list(on), "left")
    return joined.withColumn(column, F.coalesce(column, "_fill")).select(*df.columns)


def overwrite_from(df: DataFrame, values: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Write an aggregate back by key; rows without a value keep theirs."""
    side = values.select(*on, F.col(column).alias("_new"), F.lit(True).alias("_in"))
    joined = df.join(side, list(on), "left")
    value = F.when(F.col("_in").isNotNull(), F.col("_new")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns)


def assign_default(
    entities: DataFrame, links: DataFrame, on: Sequence[str], default: Column, out: str
) -> DataFrame:
    """Link rows to add: entities without any of the given (active) links get ``default``."""
    lacking = missing_from(entities, links, {k: k for k in on})
    return lacking.withColumn(out, default)


def missing_pairs(
    entities: DataFrame, entity: str, constants: DataFrame, constant: str, existing: DataFrame
) -> DataFrame:
    """Pairs of every entity with a constant set that ``existing`` lacks."""
    pairs = fan_out(entities.select(entity), constants, constant, constant)
    return missing_from(pairs, existing, {entity: entity, constant: constant})
