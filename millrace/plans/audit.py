"""Response audit and the quality report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import keys, rows, tree
from millrace.sources.outbox import parse_responses

# Fixed value: status of an accepted request.
OK = 200


def response_audit(responses: DataFrame, body: str = "response_body") -> tuple[DataFrame, DataFrame]:
    """(entries of accepted requests, whole responses that failed)."""
    accepted, failed = rows.route(responses, F.col("status_code") == OK)
    return parse_responses(accepted, body), failed


def quality_report(
    users: DataFrame,
    unique: Mapping[str, Sequence[str]],
    departments: DataFrame,
    id_column: str,
    parent: str,
    deleted: str,
) -> DataFrame:
    """One row per finding: rule, offending key, number of rows."""
    report = None
    for rule, columns in unique.items():
        found = keys.duplicate_keys(users, columns)
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        part = found.select(F.lit(rule).alias("rule"), key.alias("key"), "n")
        report = part if report is None else report.unionByName(part)
    dangling = tree.dangling_parents(departments, id_column, parent, deleted)
    part = dangling.select(
        F.lit("deleted parent").alias("rule"),
        F.col(id_column).cast("string").alias("key"),
        F.lit(1).cast("long").alias("n"),
    )
    return part if report is None else report.unionByName(part)
