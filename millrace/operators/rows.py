"""Routing rows and checking them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the predicate holds, all others); an unknown predicate is "other"."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def exclude_values(df: DataFrame, column: str, values: Sequence[str] = (), like: str | None = None):
    """Drop the listed values or a pattern; null rows go too, as with ``<>`` and ``NOT LIKE``."""
    if values:
        df = df.filter(~F.col(column).isin(list(values)))
    return df if like is None else df.filter(~F.col(column).like(like))


def check_domain(
    df: DataFrame, rules: Mapping[str, Column], defaults: Mapping[str, object] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Apply defaults to nulls, then split into (accepted, rejected with reasons).

    As with a CHECK constraint, only a rule that is false rejects; unknown passes.
    """
    for column, value in (defaults or {}).items():
        df = df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    broken = F.filter(
        F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]),
        lambda x: x.isNotNull(),
    )
    checked = df.withColumn("reasons", F.array_join(broken, ","))
    return checked.filter(F.col("reasons") == "").drop("reasons"), checked.filter(F.col("reasons") != "")


def evolve_schema(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each missing column as null of its type; existing ones stay as they are."""
    for name, kind in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def select_cast(df: DataFrame, columns: Mapping[str, str | None]) -> DataFrame:
    """Keep the listed columns, cast those that name a type."""
    return df.select(
        *[F.col(c) if kind is None else F.col(c).cast(kind).alias(c) for c, kind in columns.items()]
    )


def require(df: DataFrame, columns: Iterable[str]) -> None:
    """Fail by name when a declared column is missing: a renamed source column must not empty a target."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
