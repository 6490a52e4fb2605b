"""Children collected under their parents, in arrays of bounded size.

A collected group comes back as numbered parts of at most ``max_items`` children:
one part for nearly every parent, more for a parent too large for one cell. No task
gathers more than one part of a parent that is known to be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import bracket_list, document
from millrace.operators.numbering import _number_ranges, number_rows
from millrace.operators.skew import hot_keys
from millrace.session import cut_lineage

#: Children per array.
MAX_ITEMS = 100_000


def nested_collect(
    children: DataFrame,
    parent: Sequence[str],
    order_by: Sequence[str],
    item: Column,
    out: str = "items",
    max_items: int = MAX_ITEMS,
    sizes: DataFrame | None = None,
    detect: bool = True,
) -> DataFrame:
    """(parent, part, array of ``item`` in ``order_by`` order).

    ``sizes`` is a cheaper table with the same parent keys (for example the raw
    child table) to look for hot parents in. ``detect=False`` says the caller knows
    the groups to be small.
    """
    keys = list(parent)
    shaped = children.select(
        *keys, F.struct(*[F.col(c) for c in order_by]).alias("_ord"), item.alias("_item")
    )
    hot = hot_keys(sizes if sizes is not None else children, keys, max_items) if detect else None
    if hot is None:
        return _collect_whole(shaped, keys, out, max_items)
    cold = _collect_whole(shaped.join(hot, keys, "left_anti"), keys, out, max_items)
    return cold.unionByName(_collect_hot(shaped.join(hot, keys, "left_semi"), keys, out, max_items))


def _collect_hot(shaped: DataFrame, keys: list[str], out: str, max_items: int) -> DataFrame:
    """Groups numbered in ranges and collected part by part."""
    numbered = _number_ranges(shaped, keys, ["_ord"], "_n")
    part = (F.floor((F.col("_n") - 1) / max_items) + 1).cast("long")
    return numbered.withColumn("part", part).groupBy(*keys, "part").agg(_in_order().alias(out))


def _in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct("_ord", "_item"))).getField("_item")


def _collect_whole(shaped: DataFrame, keys: list[str], out: str, max_items: int) -> DataFrame:
    """One shuffle; an array that still exceeds ``max_items`` is sliced into its parts.

    Rows move to their parent before they are collected: arrays built ahead of the
    shuffle would not be smaller than the rows, and cost a sort of the input.
    """
    whole = shaped.repartition(*keys).groupBy(*keys).agg(_in_order().alias("_all"))
    last = F.ceil(F.size("_all") / F.lit(max_items)).cast("int")
    numbered = whole.withColumn("_part", F.explode(F.sequence(F.lit(1), last)))
    first = (F.col("_part") - 1) * max_items + 1
    piece = F.when(F.size("_all") <= max_items, F.col("_all")).otherwise(
        F.slice("_all", first, F.lit(max_items))
    )
    return numbered.select(*keys, F.col("_part").cast("long").alias("part"), piece.alias(out))


def attach_parts(heads: DataFrame, keys: Sequence[str], lists: dict[str, DataFrame]) -> DataFrame:
    """Heads with several collected lists, one row per part (``part`` 1 always exists).

    Lists with fewer parts than another are empty in the later ones.
    """
    on = [*keys, "part"]
    numbered = None
    for parts in lists.values():
        numbered = parts if numbered is None else numbered.join(parts, on, "full_outer")
    joined = heads.join(numbered, list(keys), "left")
    out = joined.withColumn("part", F.coalesce("part", F.lit(1).cast("long")))
    return out.withColumns({name: F.coalesce(name, F.array()) for name in lists})


def collect_lists(
    heads: DataFrame,
    keys: Sequence[str],
    lists: dict[str, tuple[DataFrame, Sequence[str], Column]],
    hot: DataFrame | None,
    max_items: int = MAX_ITEMS,
    whole: str | None = None,
    whole_limit: int | None = None,
) -> DataFrame:
    """``nested_collect`` of several child tables, attached to their heads, by part.

    ``lists`` maps an output column to (children, order, item); ``hot`` holds the keys
    known to have too many children in any of them. All other lists are joined whole
    by key, on the partitioning they were collected in, and cut into parts at the end.
    The list named ``whole`` also comes uncut in every part, as ``<name>_whole``: for what
    must be combined with all of it, and hence must fit one cell. A key with more than ``whole_limit`` rows of it fails
    the job by name; they are counted before any are gathered.
    """
    on = list(keys)
    shaped = {
        name: rows.select(*on, F.struct(*order).alias("_ord"), item.alias("_item"))
        for name, (rows, order, item) in lists.items()
    }
    out = heads if hot is None else heads.join(hot, on, "left_anti")
    for name, rows in shaped.items():
        cold = rows if hot is None else rows.join(hot, on, "left_anti")
        gathered = cold.repartition(*on).groupBy(*on).agg(_in_order().alias(name))
        out = out.join(gathered, on, "left")
    if whole is not None:
        out = out.withColumn(f"{whole}_whole", F.coalesce(whole, F.array()))
    out = cut_parts(out, list(lists), max_items)
    if hot is None:
        return out
    parts = {
        name: _collect_hot(rows.join(hot, on, "left_semi"), on, name, max_items) for name, rows in shaped.items()
    }
    large = attach_parts(heads.join(hot, on, "left_semi"), on, parts)
    if whole is not None:
        name = f"{whole}_whole"
        gathered = shaped[whole].join(hot, on, "left_semi")
        if whole_limit is not None:
            gathered = gathered.join(_within(gathered, on, whole_limit), on, "left_semi")
        uncut = gathered.groupBy(*on).agg(_in_order().alias(name))
        large = large.join(uncut, on, "left").withColumn(name, F.coalesce(name, F.array()))
    return out.unionByName(large.select(*out.columns))


def _within(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The keys of ``rows``; one with more than ``limit`` of them fails. They are counted map-side, not gathered."""
    counted = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    largest = counted.orderBy(F.desc("_n")).limit(1).collect()
    if largest and largest[0]["_n"] > limit:
        named = ", ".join(f"{k} {largest[0][k]}" for k in keys)
        raise ValueError(f"{named}: {largest[0]['_n']} are too many entries for one cell")
    return counted.select(*keys)


def cut_parts(df: DataFrame, names: list[str], max_items: int) -> DataFrame:
    """One row per part of the longest list; a shorter list is empty in the later ones."""
    filled = df.withColumns({n: F.coalesce(n, F.array()) for n in names})
    longest = F.greatest(*[F.size(n) for n in names], F.lit(1))
    parts = F.sequence(F.lit(1).cast("long"), F.ceil(longest / F.lit(max_items)).cast("long"))
    numbered = filled.withColumn("part", F.explode(parts))
    first = ((F.col("part") - 1) * max_items + 1).cast("int")
    return numbered.withColumns(
        {
            n: F.when(longest <= max_items, F.col(n)).otherwise(F.slice(n, first, F.lit(max_items)))
            for n in names
        }
    )


def numbered_items(items: str | Column, field: str = "idx", max_items: int = MAX_ITEMS) -> Column:
    """Items with their 1-based place in the parent as first field (``part`` in scope)."""
    start = (F.col("part") - 1) * max_items
    return F.transform(
        items,
        lambda x, i: F.struct((i + 1 + start).cast("long").alias(field), x.alias("item")),
    )


def distinct_list(
    df: DataFrame, keys: Sequence[str], value: str, out: str, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Distinct values per key, ascending, as ``"[1,2,3]"`` text (with its part)."""
    pairs = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    lists = nested_collect(pairs, keys, [value], F.col(value), "_list", max_items, sizes=df)
    return lists.select(*keys, "part", bracket_list(F.col("_list")).alias(out))


def single_part(parts: DataFrame) -> DataFrame:
    """For a value that must fit one cell: fail, never cut, when a key has two parts."""
    flag = F.when(F.col("part") > 1, F.raise_error(F.lit("list does not fit one cell")))
    return parts.filter(F.coalesce(flag.cast("boolean"), F.lit(True))).drop("part")


def ordered_values(df: DataFrame, parent: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct values per parent in ascending order (with its part)."""
    pairs = df.select(*parent, value).distinct()
    return nested_collect(pairs, parent, [value], F.col(value), out, sizes=df)


def string_agg(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[Column], out: str, separator: str = ""
) -> DataFrame:
    """Values joined in order, for groups already bounded (a top n)."""
    entry = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order_by)], F.col(value).alias("v"))
    ordered = F.sort_array(F.collect_list(entry)).getField("v")
    return df.groupBy(*keys).agg(F.array_join(ordered, separator).alias(out))


def split_collect(
    df: DataFrame,
    parent: Sequence[str],
    kind: str,
    kinds: dict[str, str],
    order_by: Sequence[str],
    item: Column,
    max_items: int = MAX_ITEMS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Children in one array per kind: ``kinds`` maps an output column to its kind."""
    chosen = df.filter(F.col(kind).isin(list(kinds.values())))
    tagged = F.struct(F.col(kind).alias("kind"), item.alias("item"))
    parts = nested_collect(chosen, parent, order_by, tagged, "_all", max_items, sizes)

    def of(value: str) -> Column:
        return F.transform(F.filter("_all", lambda x: x["kind"] == value), lambda x: x["item"])

    return parts.select(*parent, "part", *[of(v).alias(out) for out, v in kinds.items()])


def complete(df: DataFrame, arrays: Sequence[str], require_all: bool = True) -> DataFrame:
    """Rows whose arrays are all (or at least one is) non-empty."""
    filled = [F.coalesce(F.size(a), F.lit(0)) > 0 for a in arrays]
    test = filled[0]
    for one in filled[1:]:
        test = (test & one) if require_all else (test | one)
    return df.filter(test)


def json_chunks(
    df: DataFrame, order_by: Sequence[str], item: Column, chunk_rows: int, out: str = "postdata"
) -> DataFrame:
    """The whole table as JSON arrays of ``chunk_rows`` entries in ``order_by`` order."""
    shaped = df.select(*order_by, item.alias("_item"))
    numbered = number_rows(shaped, order_by, "_n")
    chunk = F.floor((F.col("_n") - 1) / chunk_rows).cast("long")
    entry = F.struct(F.col("_n"), F.col("_item"))
    items = F.sort_array(F.collect_list(entry)).getField("_item")
    return (
        numbered.withColumn("chunk", chunk)
        .groupBy("chunk")
        .agg(items.alias("_items"))
        .select("chunk", document(F.col("_items")).alias(out))
    )


def first_non_empty(df: DataFrame, keys: Sequence[str], value: str, order: str, out: str) -> DataFrame:
    """The first non-empty value in ``order`` per key."""
    filled = df.filter((F.col(value).isNotNull()) & (F.col(value) != ""))
    return filled.groupBy(*keys).agg(F.min_by(value, order).alias(out))


def key_value_pivot(df: DataFrame, group: Sequence[str], key: str, value: str, names: dict) -> DataFrame:
    """Key/value rows to columns: ``names`` maps an output column to its key."""
    return df.groupBy(*group).agg(
        *[F.max(F.when(F.col(key) == k, F.col(value))).alias(out) for out, k in names.items()]
    )
