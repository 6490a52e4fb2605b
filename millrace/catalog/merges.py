"""Upserts, inserts and reconciling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.functions import blank_to_default, falsy_to_default
from millrace.operators import merge, nesting
from millrace.session import ensure_checkpoint_dir
from millrace.sources import bucketed

_STATE_COLUMNS = "origin_id, title, code, sort, amount, created_at, updated_at"


@query(
    "merge_upsert",
    ctes("tgt", "src")
    + """ SELECT coalesce(t.origin_id, s.origin_id) AS origin_id,
      CASE WHEN s.origin_id IS NULL THEN t.title ELSE s.title END AS title,
      CASE WHEN t.origin_id IS NULL THEN s.code ELSE t.code END AS code,
      CASE WHEN s.origin_id IS NULL THEN t.sort ELSE s.sort END AS sort,
      CASE WHEN s.origin_id IS NULL THEN t.amount ELSE s.amount END AS amount,
      CASE WHEN t.origin_id IS NULL THEN s.created_at ELSE t.created_at END AS created_at,
      CASE WHEN s.origin_id IS NULL THEN t.updated_at ELSE s.updated_at END AS updated_at
    FROM tgt t FULL JOIN src s ON s.origin_id = t.origin_id""",
)
def merge_upsert(t):
    """``code`` and ``created_at`` are written on insert only."""
    return merge.merge_upsert(
        m.tgt(t), m.src(t), ["origin_id"], update=["title", "sort", "amount", "updated_at"]
    )


@query(
    "merge_cobucketed",
    ctes("tgt", "src")
    + """ SELECT coalesce(t.origin_id, s.origin_id) AS origin_id,
      CASE WHEN s.origin_id IS NULL THEN t.title ELSE s.title END AS title,
      CASE WHEN t.origin_id IS NULL THEN s.code ELSE t.code END AS code,
      CASE WHEN s.origin_id IS NULL THEN t.amount ELSE s.amount END AS amount
    FROM tgt t FULL JOIN src s ON s.origin_id = t.origin_id""",
)
def merge_cobucketed(t):
    """The same merge of two tables bucketed alike: it shuffles nothing."""
    columns = ["origin_id", "title", "code", "amount"]
    sides = []
    for side in (m.tgt(t), m.src(t)):
        name = f"side_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}"
        sides.append(bucketed.write_cobucketed(side.select(*columns), name, path, ["origin_id"], 16))
    return bucketed.merge_cobucketed(*sides, ["origin_id"], update=["title", "amount"])


@query(
    "merge_insert_only",
    ctes("tgt", "src")
    + f" SELECT {_STATE_COLUMNS} FROM tgt UNION ALL SELECT {_STATE_COLUMNS} FROM src "
    "WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.origin_id = src.origin_id)",
)
def merge_insert_only(t):
    return merge.insert_missing(m.tgt(t), m.src(t), ["origin_id"])


_PAIRS = """SELECT o_custkey AS user_id, o_orderpriority AS post_id, count(*) AS n, max(o_orderdate) AS updated_at
FROM orders WHERE o_orderstatus {} GROUP BY ALL"""


def _pairs(t, when):
    return (
        t.orders.filter(when)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("post_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("updated_at"))
    )


@query(
    "merge_composite_key",
    f"""WITH t AS ({_PAIRS.format("= 'F'")}), s AS ({_PAIRS.format("<> 'F'")})
    SELECT user_id, post_id, coalesce(s.n, t.n) AS n, coalesce(s.updated_at, t.updated_at) AS updated_at
    FROM t FULL JOIN s USING (user_id, post_id)""",
)
def merge_composite_key(t):
    closed = F.col("o_orderstatus") == "F"
    return merge.merge_upsert(_pairs(t, closed), _pairs(t, ~closed), ["user_id", "post_id"])


@query(
    "upsert_on_conflict",
    """WITH t AS (SELECT user_id, event_type, max(value) AS value, 'old' AS origin FROM events
      WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'view' GROUP BY ALL),
    b AS (SELECT CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, event_type, value, event_id FROM events
      WHERE ts >= TIMESTAMP '2024-01-10'),
    s AS (SELECT user_id, event_type, arg_max(value, event_id) AS value FROM b WHERE user_id IS NOT NULL GROUP BY ALL)
    SELECT user_id, event_type, coalesce(s.value, t.value) AS value, coalesce(t.origin, 'new') AS origin
    FROM t FULL JOIN s USING (user_id, event_type)
    UNION ALL SELECT user_id, event_type, value, 'new' FROM b WHERE user_id IS NULL""",
)
def upsert_on_conflict(t):
    """A batch that repeats keys: the newest row per key is merged, rows without a key are all inserted."""
    keys = ["user_id", "event_type"]
    early = F.col("ts") < m.ntz("2024-01-10")
    old = (
        t.events.filter(early & (F.col("event_type") != "view"))
        .groupBy(*keys)
        .agg(F.max("value").alias("value"))
        .withColumn("origin", F.lit("old"))
    )
    known = F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id")
    batch = t.events.filter(~early).select(known, "event_type", "event_id", "value", F.lit("new").alias("origin"))
    return merge.merge_upsert_last(old, batch, keys, [F.desc("event_id")], update=["value"])


@query(
    "upsert_with_fallback",
    ctes("tgt", "src")
    + """, s AS (SELECT origin_id, CASE WHEN sort IN (0, 2) THEN 99 ELSE sort END AS sort,
      coalesce(nullif(CASE code WHEN 'P' THEN '' WHEN 'O' THEN NULL ELSE code END, ''), '/') AS code FROM src)
    SELECT origin_id, coalesce(s.code, t.code) AS code, coalesce(s.sort, t.sort) AS sort
    FROM (SELECT origin_id, code, sort FROM tgt) t FULL JOIN s USING (origin_id)""",
)
def upsert_with_fallback(t):
    raw = F.when(F.col("code") == "P", F.lit("")).when(F.col("code") != "O", F.col("code"))
    sort = F.when(F.col("sort") == 2, F.lit(0).cast("long")).otherwise(F.col("sort"))
    source = m.src(t).select(
        "origin_id",
        blank_to_default(raw, "/").alias("code"),
        falsy_to_default(sort, F.lit(99).cast("long"), 0).alias("sort"),
    )
    return merge.merge_upsert(m.tgt(t).select("origin_id", "code", "sort"), source, ["origin_id"])


_FLAGGED = ctes("tgt", "src", "tgt_flagged")
_SOURCE = "src.origin_id = t.origin_id"


@query(
    "insert_missing",
    _FLAGGED
    + f""", new AS (SELECT * FROM src WHERE origin_id NOT IN (SELECT origin_id FROM tgt))
    SELECT origin_id, id, title, code, active, write_date FROM tgt_flagged
    UNION ALL SELECT origin_id, row_number() OVER (ORDER BY origin_id) + (SELECT max(id) FROM tgt_flagged),
      title, code, true, CAST(NULL AS TIMESTAMP) FROM new""",
)
def insert_missing(t):
    """New rows get ids after the largest one in use."""
    source = m.src(t).select("origin_id", "title", "code", F.lit(True).alias("active"))
    return merge.insert_numbered(m.tgt_flagged(t), source, ["origin_id"])


@query(
    "archive_missing",
    _FLAGGED
    + f""" SELECT origin_id, id, title, code, CASE WHEN EXISTS (SELECT 1 FROM src WHERE {_SOURCE}) THEN active
      ELSE false END AS active, write_date FROM tgt_flagged t""",
)
def archive_missing(t):
    return merge.archive_missing(m.tgt_flagged(t), m.src(t), ["origin_id"])


@query(
    "reactivate_returned",
    _FLAGGED
    + f""" SELECT origin_id, id, title, code, active OR EXISTS (SELECT 1 FROM src WHERE {_SOURCE}) AS active,
      write_date FROM tgt_flagged t""",
)
def reactivate_returned(t):
    return merge.reactivate_returned(m.tgt_flagged(t), m.src(t), ["origin_id"])


_CHANGED = (
    _FLAGGED
    + """, s AS (SELECT origin_id, title, nullif(code, 'P') AS code FROM src)
SELECT t.origin_id, id, CASE WHEN c THEN s.title ELSE t.title END AS title,
  CASE WHEN c THEN s.code ELSE t.code END AS code, active,
  CASE WHEN c THEN TIMESTAMP '2024-02-01' ELSE write_date END AS write_date
FROM tgt_flagged t LEFT JOIN s ON s.origin_id = t.origin_id
CROSS JOIN LATERAL (SELECT s.origin_id IS NOT NULL AND coalesce({}, false) AS c)"""
)


def _update(t, null_safe):
    source = m.src(t).select("origin_id", "title", F.nullif(F.col("code"), F.lit("P")).alias("code"))
    return merge.update_changed(
        m.tgt_flagged(t), source, ["origin_id"], ["title", "code"], ("write_date", m.ntz("2024-02-01")), null_safe
    )


@query(
    "update_changed",
    _CHANGED.format("s.title IS DISTINCT FROM t.title OR s.code IS DISTINCT FROM t.code"),
)
def update_changed(t):
    return _update(t, True)


@query("update_changed_plain", _CHANGED.format("s.title <> t.title OR s.code <> t.code"))
def update_changed_plain(t):
    """The plain comparison: a change to null alone goes unseen."""
    return _update(t, False)


@query(
    "reconcile",
    _FLAGGED
    + """ SELECT coalesce(t.origin_id, s.origin_id) AS origin_id, id,
      CASE WHEN s.origin_id IS NULL THEN t.title ELSE s.title END AS title,
      CASE WHEN s.origin_id IS NULL THEN t.code ELSE s.code END AS code,
      s.origin_id IS NOT NULL AS active,
      CASE WHEN s.title IS DISTINCT FROM t.title AND s.origin_id IS NOT NULL AND t.id IS NOT NULL
        OR s.code IS DISTINCT FROM t.code AND s.origin_id IS NOT NULL AND t.id IS NOT NULL
        THEN TIMESTAMP '2024-02-01' ELSE t.write_date END AS write_date
    FROM tgt_flagged t FULL JOIN src s ON s.origin_id = t.origin_id""",
)
def reconcile(t):
    """Archive, insert, reactivate and update over a single join."""
    source = m.src(t).select("origin_id", "title", "code")
    stamp = ("write_date", m.ntz("2024-02-01"))
    return merge.reconcile(m.tgt_flagged(t), source, ["origin_id"], ["title", "code"], stamp=stamp)


@query(
    "deactivate_unlinked",
    _FLAGGED
    + """ SELECT id, CASE WHEN origin_id IS NULL AND title LIKE '%2%' THEN false ELSE active END AS active
      FROM tgt_flagged""",
)
def deactivate_unlinked(t):
    flagged = m.tgt_flagged(t)
    return merge.deactivate_unlinked(flagged, "origin_id", only=F.col("title").like("%2%")).select("id", "active")


_TWO = (
    ctes("tgt", "src")
    + """, parents AS (SELECT origin_id + 100 AS id, origin_id, title AS name FROM tgt),
  children AS (SELECT origin_id + 900 AS id, origin_id, origin_id + 100 AS resource_id, code FROM tgt WHERE sort > 1),
  new_p AS (SELECT origin_id, title AS name FROM src WHERE origin_id NOT IN (SELECT origin_id FROM parents)),
  all_p AS (SELECT id, origin_id, name FROM parents UNION ALL SELECT row_number() OVER (ORDER BY origin_id)
    + (SELECT max(id) FROM parents), origin_id, name FROM new_p)"""
)


def _two_tables(t):
    parents = m.tgt(t).select((F.col("origin_id") + 100).alias("id"), "origin_id", F.col("title").alias("name"))
    children = (
        m.tgt(t)
        .filter(F.col("sort") > 1)
        .select(
            (F.col("origin_id") + 900).alias("id"),
            "origin_id",
            (F.col("origin_id") + 100).alias("resource_id"),
            "code",
        )
    )
    source = m.src(t).select("origin_id", F.col("title").alias("name"), "code")
    return merge.insert_two_tables(parents, children, source, "origin_id", link="resource_id")


@query("two_table_insert_parents", _TWO + " SELECT id, origin_id, name FROM all_p")
def two_table_insert_parents(t):
    return _two_tables(t)[0]


@query(
    "two_table_insert_children",
    _TWO
    + """ SELECT id, origin_id, resource_id, code FROM children UNION ALL
    SELECT row_number() OVER (ORDER BY s.origin_id) + (SELECT max(id) FROM children), s.origin_id, p.id, s.code
    FROM src s JOIN all_p p ON p.origin_id = s.origin_id
    WHERE s.origin_id NOT IN (SELECT origin_id FROM children)""",
)
def two_table_insert_children(t):
    return _two_tables(t)[1]


@query(
    "insert_with_sidecar",
    """WITH cand AS (SELECT DISTINCT trim(p_name) AS name FROM part),
    numbered AS (SELECT name, row_number() OVER (ORDER BY name) AS rn FROM cand)
    SELECT n_nationkey AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS template_id FROM nation
    UNION ALL SELECT rn + (SELECT max(n_nationkey) FROM nation), name, rn + (SELECT max(r_regionkey) FROM region)
    FROM numbered""",
)
def insert_with_sidecar(t):
    """Every new row gets a sidecar row of its own and carries its id."""
    colours = t.nation.select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("long").alias("template_id"),
    )
    templates = t.region.select(F.col("r_regionkey").cast("long").alias("id"))
    names = t.part.select(F.trim("p_name").alias("name")).distinct()
    return merge.insert_with_sidecar(colours, templates, names, ["name"], "template_id")[0]


@query(
    "insert_with_sidecar_rows",
    """SELECT CAST(r_regionkey AS BIGINT) AS id FROM region UNION ALL
    SELECT row_number() OVER () + (SELECT max(r_regionkey) FROM region)
    FROM (SELECT DISTINCT trim(p_name) AS name FROM part)""",
)
def insert_with_sidecar_rows(t):
    colours = t.nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    templates = t.region.select(F.col("r_regionkey").cast("long").alias("id"))
    names = t.part.select(F.trim("p_name").alias("name")).distinct()
    return merge.insert_with_sidecar(colours, templates, names, ["name"], "template_id")[1]


@query(
    "backfill_parent",
    ctes("depart")
    + """, d AS (SELECT dd_id + 7 AS id, dd_id AS origin_id, dd_parent_id AS origin_parent_id FROM depart
      WHERE dd_deleted_time IS NULL)
    SELECT d.id, d.origin_id, p.id AS parent_id FROM d LEFT JOIN d p ON p.origin_id = d.origin_parent_id""",
)
def backfill_parent(t):
    live = m.depart(t).filter(F.col("dd_deleted_time").isNull())
    rows = live.select(
        (F.col("dd_id") + 7).alias("id"),
        F.col("dd_id").alias("origin_id"),
        F.col("dd_parent_id").alias("origin_parent_id"),
        F.lit(None).cast("long").alias("parent_id"),
    )
    return merge.backfill_parent(rows).select("id", "origin_id", "parent_id")


@query(
    "fill_collapsed_list",
    """WITH posts AS (SELECT o_custkey, '[' || string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) || ']' AS ids FROM
      (SELECT DISTINCT o_custkey, month(o_orderdate) AS k FROM orders WHERE o_orderstatus <> 'P') GROUP BY o_custkey)
    SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN '[0]' END, ids) AS post_ids
    FROM customer LEFT JOIN posts ON o_custkey = c_custkey""",
)
def fill_collapsed_list(t):
    """Only where it is null, and from active child rows only."""
    preset = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("[0]"))
    users = t.customer.select("c_custkey", preset.alias("post_ids"))
    active = t.orders.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("k")
    )
    lists = nesting.single_part(nesting.distinct_list(active, ["c_custkey"], "k", "post_ids"))
    return merge.fill_null_from(users, lists, ["c_custkey"], "post_ids")


@query(
    "assign_default",
    """SELECT u.c_custkey, u.c_nationkey, (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AS role_id
    FROM customer u LEFT JOIN orders o ON o.o_custkey = u.c_custkey AND o.o_orderpriority = '1-URGENT'
    WHERE u.c_nationkey < 13 AND o.o_orderkey IS NULL""",
)
def assign_default(t):
    tenants = t.customer.filter(F.col("c_nationkey") < 13).select("c_custkey", "c_nationkey")
    links = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    role = t.region.filter(F.col("r_name") == "ASIA").select("r_regionkey").scalar()
    return merge.assign_default(tenants, links, ["c_custkey"], role, "role_id")


@query(
    "fan_out_property",
    """SELECT c_custkey, r_name AS property FROM customer CROSS JOIN region WHERE NOT EXISTS
    (SELECT 1 FROM nation WHERE n_nationkey = c_custkey AND 'ASIA' = r_name)""",
)
def fan_out_property(t):
    existing = t.nation.select(F.col("n_nationkey").cast("long").alias("c_custkey"), F.lit("ASIA").alias("property"))
    constants = t.region.select(F.col("r_name").alias("property"))
    return merge.missing_pairs(t.customer, "c_custkey", constants, "property", existing)


@query(
    "update_from_aggregate",
    """SELECT p_partkey, coalesce(n, -1) AS used FROM part LEFT JOIN
    (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey) ON l_partkey = p_partkey""",
)
def update_from_aggregate(t):
    used = t.lineitem.filter(F.col("l_quantity") > 45).groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("used")
    )
    parts = t.part.select("p_partkey", F.lit(-1).cast("long").alias("used"))
    return merge.overwrite_from(parts, used, ["p_partkey"], "used")
