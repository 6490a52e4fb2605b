"""Joins that resolve codes, names and parents.

No side is broadcast by hint: Catalyst and AQE broadcast a side once its measured
size is under the threshold, and shuffle it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.skew import key_side, null_spread, row_hash, spread_zero

#: Join keys a constant set is copied to.
FAN_KEYS = 32


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    how: str = "left",
    salt: int = 1,
) -> DataFrame:
    """Add ``columns`` (output name to dimension column) from ``dim``.

    ``on`` maps fact columns to dimension columns. Rows with a null key are spread
    over tasks. ``salt`` above 1 also spreads every key over that many tasks, for a
    fact known to have hot keys; the dimension is then repeated ``salt`` times.
    """
    joined, helpers = _attach(fact, dim, on, columns, how, salt)
    return joined.drop(*helpers)


def _attach(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    how: str,
    salt: int = 1,
    tag: str = "",
) -> tuple[DataFrame, list[str]]:
    """The joined rows and the names of the helper columns to drop."""
    keys = list(on)
    key_names = {d: f"_k{tag}_{d}" for d in on.values()}
    side = dim.select(
        *[F.col(d).alias(k) for d, k in key_names.items()],
        *[F.col(d).alias(out) for out, d in columns.items()],
    )
    condition = [F.col(f) == F.col(key_names[d]) for f, d in on.items()]
    if how == "left":
        condition.append(null_spread(fact, keys) == spread_zero(list(key_names.values())))
    helpers = list(key_names.values())
    if salt > 1:
        copy = f"_copy{tag}"
        side = side.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        condition.append(F.pmod(row_hash(fact, keys), F.lit(salt)).cast("int") == F.col(copy))
        helpers.append(copy)
    return fact.join(side, condition, how), helpers


def role_lookup(
    fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """One dimension joined once per role: ``roles`` maps a key column to its outputs."""
    helpers: list[str] = []
    for i, (key, columns) in enumerate(roles.items()):
        fact, more = _attach(fact, dim, {key: dim_key}, columns, "left", tag=str(i))
        helpers += more
    return fact.drop(*helpers)


def role_lookup_folded(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    row_key: str,
    roles: Mapping[str, Mapping[str, str]],
) -> DataFrame:
    """Same result with a single join, for a dimension too large to broadcast.

    The role keys are unpivoted to (row, role, key), joined once, and folded back
    with conditional aggregates; ``row_key`` is unique and ``dim_key`` is unique.
    """
    roles_array = F.array(
        *[F.struct(F.lit(k).alias("role"), F.col(k).cast("long").alias("key")) for k in roles]
    )
    long = fact.select(F.col(row_key), F.explode(roles_array).alias("_r")).select(
        row_key, F.col("_r.role").alias("_role"), F.col("_r.key").alias("_key")
    )
    long = long.filter(F.col("_key").isNotNull())
    wanted = {c for columns in roles.values() for c in columns.values()}
    side = dim.select(
        F.col(dim_key).cast("long").alias("_dim_key"),
        *[F.col(c).alias(f"_d_{c}") for c in sorted(wanted)],
    )
    hits = long.join(side, F.col("_key") == F.col("_dim_key"))
    folded = hits.groupBy(row_key).agg(
        *[
            F.max(F.when(F.col("_role") == role, F.col(f"_d_{source}"))).alias(out)
            for role, columns in roles.items()
            for out, source in columns.items()
        ]
    )
    return fact.join(folded, row_key, "left")


def dictionary(header: DataFrame, detail: DataFrame, code: str = "code") -> DataFrame:
    """(dict_code, code) to id, from a header (id, code) and its details."""
    heads = header.select(F.col("id").alias("_head"), F.col("code").alias("dict_code"))
    return detail.join(heads, F.col("dict_id") == F.col("_head")).select(
        "dict_code", F.col(code).alias("entry_code"), F.col("id").alias("entry_id")
    )


def dictionary_lookup(
    fact: DataFrame, entries: DataFrame, fields: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Resolve codes against named dictionaries.

    ``fields`` maps an output column to (fact column, dictionary code).
    """
    for out, (column, dict_code) in fields.items():
        one = entries.filter(F.col("dict_code") == dict_code)
        fact = lookup(fact, one, {column: "entry_code"}, {out: "entry_id"})
    return fact


def first_match(
    fact: DataFrame,
    candidates: DataFrame,
    on: Mapping[str, str],
    order_by: Sequence[str],
    columns: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Join to the first candidate per key in ``order_by`` order.

    The candidates are cut to one per key before the join (a group limit runs
    ahead of the shuffle), so a key with many candidates never multiplies rows.
    """
    keys = list(on.values())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    first = candidates.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")
    return lookup(fact, first, on, columns, how)


def override_join(
    common: DataFrame,
    override: DataFrame,
    on: Sequence[str],
    value: str,
    default: str,
    out: str,
) -> DataFrame:
    """Value from ``override`` when the key has one, else the ``default`` column."""
    side = override.select(*on, F.col(value).alias("_override"))
    joined = common.join(side, list(on), "left")
    return joined.withColumn(out, F.coalesce("_override", default)).drop("_override")


def override_by_parent(
    children: DataFrame, overrides: DataFrame, parent: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overrides that name only the parent: they replace all of its children.

    A join by parent alone repeats every override once per child. The repetition is
    returned as ``copies`` instead of as rows, so no parent turns into all its pairs.
    ``columns`` exist on both sides.
    """
    keys = list(parent)
    per_parent = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    replaced = (
        overrides.groupBy(*keys, *columns)
        .agg(F.count(F.lit(1)).alias("_same"))
        .join(per_parent, keys)
        .withColumn("copies", F.col("copies") * F.col("_same"))
        .drop("_same")
    )
    own = children.join(overrides.select(*keys).distinct(), keys, "left_anti")
    kept = own.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("copies"))
    return replaced.select(*kept.columns).unionByName(kept)


def anti_null_aware(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN``: one null in a non-empty list removes every row."""
    # One aggregate row: is the list empty, does it hold a null.
    facts = listed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(listed_column).isNull(), 1)).alias("nulls"),
    ).select(F.struct("n", "nulls").alias("f"))
    flagged = df.withColumn("_f", facts.scalar())
    values = listed.select(F.col(listed_column).alias(column)).filter(F.col(column).isNotNull())
    kept = flagged.filter(
        (F.col("_f.n") == 0) | ((F.col("_f.nulls") == 0) & F.col(column).isNotNull())
    )
    return kept.join(values.distinct(), column, "left_anti").select(*df.columns)


def missing_from(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """``NOT EXISTS``: rows without a partner; a null key counts as missing."""
    side = key_side(other, list(on.values()), "_o_")
    condition = [F.col(a) == F.col(f"_o_{b}") for a, b in on.items()]
    condition.append(null_spread(df, list(on)) == F.col("_zero"))
    return df.join(side, condition, "left_anti")


def present_in(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """``EXISTS``: rows with at least one partner."""
    side = other.select(*[F.col(c).alias(f"_o_{c}") for c in on.values()]).distinct()
    condition = [F.col(a) == F.col(f"_o_{b}") for a, b in on.items()]
    return df.join(side, condition, "left_semi")


def scalar(df: DataFrame, column: str) -> Column:
    """The single value of a one-row table; Spark raises when there are more rows."""
    return df.select(column).scalar()


def fan_out(entities: DataFrame, constants: DataFrame, column: str, out: str) -> DataFrame:
    """Every entity with every value of a constant set.

    Entities are spread over ``FAN_KEYS`` join keys and the set is given to each of them, so the join is an
    ordinary one: Catalyst broadcasts a small set, and a large one meets the entities in as many tasks.
    """
    copies = F.explode(F.sequence(F.lit(0), F.lit(FAN_KEYS - 1)))
    side = constants.select(F.col(column).alias("_value"), copies.alias("_copy"))
    spread = F.pmod(F.xxhash64(*entities.columns), F.lit(FAN_KEYS)).cast("int")
    joined = entities.withColumn("_key", spread).join(side, F.col("_key") == F.col("_copy"))
    return joined.withColumn(out, F.col("_value")).drop("_key", "_copy", "_value")


def resolve_places(
    suppliers: DataFrame,
    text: str,
    countries: DataFrame,
    areas: DataFrame,
    ids: Sequence[Column],
) -> DataFrame:
    """Up to four place ids: the first is a country, the others are areas.

    ``countries`` has (id, name), ``areas`` has (id, name). Adds place_1..place_4.
    """
    for position, expr in enumerate(ids, start=1):
        suppliers = suppliers.withColumn(f"_place_{position}", expr)
    suppliers = lookup(suppliers, countries, {"_place_1": "id"}, {"place_1": "name"})
    for position in range(2, len(ids) + 1):
        suppliers = lookup(
            suppliers, areas, {f"_place_{position}": "id"}, {f"place_{position}": "name"}
        )
    return suppliers.drop(*[f"_place_{i}" for i in range(1, len(ids) + 1)])
