"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.functions import (
    any_true, blank_to_default, blank_to_null, code_map, digits_to_long, first_known, is_set, newer_than, offset_id,
)
from millrace.operators import rows, tree


@query(
    "offset_ids",
    ctes("depart")
    + """ SELECT dd_id + 10000 AS new_id, coalesce(dd_parent_id + 10000, 0) AS parent_or_zero,
       dd_parent_id + 10000 AS parent_or_null FROM depart""",
)
def offset_ids(t):
    return m.depart(t).select(
        offset_id("dd_id", 10000).alias("new_id"),
        offset_id("dd_parent_id", 10000, missing=0).alias("parent_or_zero"),
        offset_id("dd_parent_id", 10000).alias("parent_or_null"),
    )


@query(
    "numeric_guard",
    ctes("manager")
    + """ SELECT s_manager_id, CASE WHEN regexp_matches(dd_depart_ids, '^[0-9]+$')
         THEN TRY_CAST(dd_depart_ids AS BIGINT) + 10000 END AS dept_id FROM manager""",
)
def numeric_guard(t):
    return m.manager(t).select(
        "s_manager_id", offset_id(digits_to_long("dd_depart_ids"), 10000).alias("dept_id")
    )


@query(
    "fallback_chain",
    ctes("depart")
    + """ SELECT dd_id, coalesce(dd_created_time, TIMESTAMP '2024-02-01') AS created_at,
       coalesce(dd_updated_time, dd_created_time, TIMESTAMP '2024-02-01') AS updated_at FROM depart""",
)
def fallback_chain(t):
    now = m.ntz("2024-02-01")
    return m.depart(t).select(
        "dd_id",
        first_known("dd_created_time", now).alias("created_at"),
        first_known("dd_updated_time", "dd_created_time", now).alias("updated_at"),
    )


@query(
    "blank_to_null",
    ctes("archive") + " SELECT s_talent_archives_id, nullif(s_email, '') AS email FROM archive",
)
def blank_null(t):
    return m.archive(t).select("s_talent_archives_id", blank_to_null("s_email").alias("email"))


@query(
    "blank_to_default",
    ctes("position")
    + """ SELECT s_talent_position_id, coalesce(nullif(s_en_position, ''), s_position) AS code,
       coalesce(nullif(s_en_position, ''), '/') AS label FROM position""",
)
def blank_default(t):
    return m.position(t).select(
        "s_talent_position_id",
        blank_to_default("s_en_position", F.col("s_position")).alias("code"),
        blank_to_default("s_en_position", "/").alias("label"),
    )


@query(
    "flag_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS active,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 2
    ELSE 1 END AS source_kind, CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN 1 ELSE 0 END AS closed
    FROM orders""",
)
def flag_map(t):
    kinds = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 2, "5-LOW": 2}
    return t.orders.select(
        "o_orderkey",
        code_map("o_orderstatus", {"F": False, "O": True}).alias("active"),
        code_map("o_orderpriority", kinds, default=1).alias("source_kind"),
        is_set(F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("closed"),
    )


@query(
    "constant_columns",
    """SELECT c_custkey, 0 AS sex, '' AS avatar, CAST(NULL AS VARCHAR) AS login_ip,
    CAST(NULL AS TIMESTAMP) AS login_date, 1 AS tenant_id FROM customer""",
)
def constant_columns(t):
    return t.customer.select(
        "c_custkey",
        F.lit(0).alias("sex"),
        F.lit("").alias("avatar"),
        F.lit(None).cast("string").alias("login_ip"),
        F.lit(None).cast("timestamp_ntz").alias("login_date"),
        F.lit(1).alias("tenant_id"),
    )


_VISIBLE = """ SELECT c.dd_id, c.dd_name, c.dd_parent_id FROM depart c LEFT JOIN depart p ON c.dd_parent_id = p.dd_id
WHERE c.dd_deleted_time IS NULL AND (c.dd_parent_id IS NULL OR p.dd_deleted_time IS NULL{})"""


@query("visible_rows", ctes("depart") + _VISIBLE.format(""))
def visible_rows(t):
    visible = tree.visible_rows(m.depart(t), "dd_id", "dd_parent_id", "dd_deleted_time")
    return visible.select("dd_id", "dd_name", "dd_parent_id")


@query(
    "visible_rows_strict",
    ctes("depart")
    + """ SELECT c.dd_id, c.dd_name, c.dd_parent_id FROM depart c
    WHERE c.dd_deleted_time IS NULL AND (c.dd_parent_id IS NULL OR EXISTS
      (SELECT 1 FROM depart p WHERE p.dd_id = c.dd_parent_id AND p.dd_deleted_time IS NULL))""",
)
def visible_rows_strict(t):
    live = m.depart(t).filter(F.col("dd_deleted_time").isNull())
    visible = tree.visible_rows(live, "dd_id", "dd_parent_id", "dd_deleted_time", strict=True)
    return visible.select("dd_id", "dd_name", "dd_parent_id")


@query(
    "visible_rows_orphans",
    ctes("depart")
    + """, held AS (SELECT * FROM depart WHERE dd_id % 50 <> 3)
    SELECT c.dd_id, c.dd_parent_id, c.dd_parent_id IS NULL OR p.dd_id IS NOT NULL AS has_parent FROM held c
    LEFT JOIN held p ON p.dd_id = c.dd_parent_id
    WHERE c.dd_deleted_time IS NULL AND (c.dd_parent_id IS NULL OR p.dd_deleted_time IS NULL)""",
)
def visible_rows_orphans(t):
    """Where parents are missing, the plain form keeps their children and the strict form drops them."""
    held = m.depart(t).filter("dd_id % 50 <> 3")
    plain, strict = (tree.visible_rows(held, "dd_id", "dd_parent_id", "dd_deleted_time", strict=s) for s in (False, True))
    strict = strict.select(F.col("dd_id").alias("_id"))
    return plain.join(strict, F.col("dd_id") == F.col("_id"), "left").select("dd_id", "dd_parent_id", F.col("_id").isNotNull().alias("has_parent"))


@query("live_rows", ctes("depart") + " SELECT dd_id, dd_name, sort FROM depart WHERE dd_deleted_time IS NULL")
def live_rows(t):
    return m.depart(t).filter(F.col("dd_deleted_time").isNull()).select("dd_id", "dd_name", "sort")


@query(
    "exclude_values",
    ctes("material_price")
    + """ SELECT s_material_price_id, s_new_material_num, s_fabric_composition FROM material_price
    WHERE s_fabric_composition NOT IN ('SMALL', 'LARGE') AND s_new_material_num NOT LIKE '-%'""",
)
def exclude_values(t):
    kept = rows.exclude_values(m.material_price(t), "s_fabric_composition", ["SMALL", "LARGE"])
    kept = rows.exclude_values(kept, "s_new_material_num", like="-%")
    return kept.select("s_material_price_id", "s_new_material_num", "s_fabric_composition")


@query(
    "route_rows",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS accepted,
    count(*) FILTER (WHERE o_orderstatus = 'F' IS NOT TRUE) AS rejected FROM
    (SELECT o_custkey, nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders) GROUP BY o_custkey""",
)
def route_rows(t):
    status = t.orders.select("o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"))
    accepted, rejected = rows.route(status, F.col("status") == "F")
    both = accepted.withColumn("ok", F.lit(1)).unionByName(rejected.withColumn("ok", F.lit(0)))
    return both.groupBy("o_custkey").agg(
        F.sum("ok").alias("accepted"), F.sum(1 - F.col("ok")).alias("rejected")
    )


@query(
    "changed_since",
    """SELECT event_id, ts, user_id FROM events
    WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 6 HOUR OR ts > TIMESTAMP '2024-01-30' - INTERVAL 3 DAY""",
)
def changed_since(t):
    recent = newer_than("ts", m.EVENTS_AS_OF, "6 hours") | newer_than("ts", m.EVENTS_AS_OF, "3 days")
    return t.events.filter(recent).select("event_id", "ts", "user_id")


@query(
    "boolean_any",
    """SELECT s_suppkey, s_name FROM supplier
    WHERE s_acctbal < 0 OR s_nationkey = 3 OR nullif(s_acctbal, 0) > 9000""",
)
def boolean_any(t):
    roles = t.supplier.withColumns(
        {
            "material": F.col("s_acctbal") < 0,
            "processing": F.col("s_nationkey") == 3,
            "service": F.nullif(F.col("s_acctbal"), F.lit(0.0)) > 9000,
        }
    )
    return roles.filter(any_true("material", "processing", "service")).select("s_suppkey", "s_name")


@query("distinct_rows", "SELECT DISTINCT trim(p_name) AS name, p_brand FROM part")
def distinct_rows(t):
    return t.part.select(F.trim("p_name").alias("name"), "p_brand").distinct()
