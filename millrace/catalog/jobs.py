"""Composite jobs and polling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.catalog import ORACLES, QUERIES, query
from millrace.catalog import loads
from millrace.catalog import mapping as m
from millrace.catalog.mapping import VIEWS, ctes
from millrace.operators import merge
from millrace.plans import audit, erp, materials, org, punches, yarn
from millrace.session import ensure_checkpoint_dir
from millrace.sources.load import read_versions
from millrace.sources.schemas import TABLES
from millrace.streaming.changes import poll_changes as poll
from millrace.streaming.changes import poll_changes_stream as poll_stream

NOW_SQL = "TIMESTAMP '2024-02-01'"


def _now():
    return m.ntz("2024-02-01")


def _none(kind: str):
    return F.lit(None).cast(kind)


# --- C1 -----------------------------------------------------------------------

VIEWS["visible"] = """
SELECT c.* FROM depart c LEFT JOIN depart p ON c.dd_parent_id = p.dd_id
WHERE c.dd_deleted_time IS NULL AND (c.dd_parent_id IS NULL OR p.dd_deleted_time IS NULL)"""

VIEWS["portal_old"] = """
SELECT c_custkey + 10000 AS id, 'Old ' || c_name AS title, CAST(NULL AS BIGINT) AS parent_id,
  TIMESTAMP '2019-01-01' AS created_at, TIMESTAMP '2019-01-01' AS updated_at, 0 AS sort, true AS is_leaf, 'X' AS code
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'"""

VIEWS["portal_new"] = f"""
SELECT coalesce(t.id, s.dd_id + 10000) AS id, CASE WHEN s.dd_id IS NULL THEN t.title ELSE s.dd_name END AS title,
  CASE WHEN s.dd_id IS NULL THEN t.parent_id ELSE s.dd_parent_id + 10000 END AS parent_id,
  coalesce(t.created_at, s.dd_created_time, {NOW_SQL}) AS created_at,
  CASE WHEN s.dd_id IS NULL THEN t.updated_at ELSE coalesce(dd_updated_time, dd_created_time, {NOW_SQL}) END
    AS updated_at,
  CASE WHEN s.dd_id IS NULL THEN t.sort ELSE s.sort END AS sort, coalesce(t.is_leaf, false) AS is_leaf,
  CASE WHEN s.dd_id IS NULL THEN t.code ELSE s.code END AS code
FROM portal_old t FULL JOIN visible s ON s.dd_id + 10000 = t.id"""


def _portal_old(t):
    return t.customer.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(
        (F.col("c_custkey") + 10000).alias("id"),
        F.concat(F.lit("Old "), "c_name").alias("title"),
        _none("long").alias("parent_id"),
        m.ntz("2019-01-01").alias("created_at"),
        m.ntz("2019-01-01").alias("updated_at"),
        F.lit(0).alias("sort"),
        F.lit(True).alias("is_leaf"),
        F.lit("X").alias("code"),
    )


@query("org_departments", ctes("depart", "visible", "portal_old", "portal_new") + " SELECT * FROM portal_new")
def org_departments(t):
    return org.portal_departments(m.depart(t), _portal_old(t), _now())


@query(
    "org_departments_finished",
    ctes("depart", "visible", "portal_old", "portal_new")
    + """, walk AS (SELECT id, parent_id AS up, code, 0 AS level FROM portal_new UNION ALL
      SELECT w.id, d.parent_id, d.code, w.level + 1 FROM walk w JOIN portal_new d ON d.id = w.up WHERE w.code IS NULL),
    found AS (SELECT id, arg_min(code, level) FILTER (WHERE code IS NOT NULL) AS code FROM walk GROUP BY id)
    SELECT n.id, f.code, n.id NOT IN (SELECT parent_id FROM portal_new WHERE parent_id IS NOT NULL) AS is_leaf
    FROM portal_new n JOIN found f ON f.id = n.id""",
)
def org_departments_finished(t):
    """Portal departments with recomputed leaf flags and inherited codes."""
    done = org.finish_departments(org.portal_departments(m.depart(t), _portal_old(t), _now()))
    return done.select("id", "code", "is_leaf")


@query(
    "org_departments_workflow",
    ctes("depart", "visible")
    + f""", old AS (SELECT n_nationkey + 10000 AS id, n_name AS name FROM nation)
    SELECT coalesce(t.id, s.dd_id + 10000) AS id, CASE WHEN s.dd_id IS NULL THEN t.name ELSE dd_name END AS name,
      CASE WHEN s.dd_id IS NOT NULL THEN coalesce(dd_parent_id + 10000, 0) END AS parent_id, s.sort,
      CASE WHEN s.dd_id IS NOT NULL THEN 0 END AS status, CASE WHEN s.dd_id IS NOT NULL THEN '' END AS creator,
      CASE WHEN s.dd_id IS NOT NULL THEN coalesce(dd_created_time, {NOW_SQL}) END AS create_time,
      CASE WHEN s.dd_id IS NOT NULL THEN coalesce(dd_updated_time, dd_created_time, {NOW_SQL}) END AS update_time,
      CASE WHEN s.dd_id IS NOT NULL THEN 0 END AS deleted, CASE WHEN s.dd_id IS NOT NULL THEN 1 END AS tenant_id
    FROM old t FULL JOIN visible s ON s.dd_id + 10000 = t.id""",
)
def org_departments_workflow(t):
    old = t.nation.select((F.col("n_nationkey") + 10000).cast("long").alias("id"), F.col("n_name").alias("name"))
    for name, kind in {
        "parent_id": "long", "sort": "int", "status": "int", "creator": "string", "create_time": "timestamp_ntz",
        "update_time": "timestamp_ntz", "deleted": "int", "tenant_id": "int",
    }.items():
        old = old.withColumn(name, _none(kind))
    return org.workflow_departments(m.depart(t), old, _now())


# --- C2 -----------------------------------------------------------------------

EXCLUDED = ["Customer#000000003"]

VIEWS["person"] = """
SELECT m.*, a.* EXCLUDE (s_email), a.s_email AS ta_email FROM manager m
JOIN archive a ON a.s_talent_archives_id = m.s_talent_id
WHERE a.s_employee_num IS NOT NULL AND s_activate_flag = 1 AND s_account <> 'Customer#000000003'"""

_USERS_OLD = """SELECT s_suppkey + 10000 AS id, s_name AS nickname, 'old' AS username FROM supplier"""


def _with_nulls(df, columns):
    for name, kind in columns.items():
        df = df.withColumn(name, _none(kind))
    return df


def _users_old(t):
    return t.supplier.select(
        (F.col("s_suppkey") + 10000).alias("id"), F.col("s_name").alias("nickname"), F.lit("old").alias("username")
    )


def _portal_users(t):
    extra = {
        "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz", "email": "string", "phone": "string",
        "employee_num": "string",
    }
    return org.portal_users(m.manager(t), m.archive(t), _with_nulls(_users_old(t), extra), _now(), EXCLUDED)


VIEWS["portal_users"] = f"""
SELECT coalesce(t.id, s.s_manager_id + 10000) AS id, coalesce(s.s_account, t.nickname) AS nickname,
  CASE WHEN s.s_manager_id IS NULL THEN t.username ELSE replace(s_employee_num, '.', '') END AS username,
  CASE WHEN s.s_manager_id IS NOT NULL THEN coalesce(s_created_time, {NOW_SQL}) END AS created_at,
  CASE WHEN s.s_manager_id IS NOT NULL THEN coalesce(s_updated_time, s_created_time, {NOW_SQL}) END AS updated_at,
  nullif(s.ta_email, '') AS email, s.s_cellphone AS phone, s.s_employee_num AS employee_num
FROM ({_USERS_OLD}) t FULL JOIN person s ON s.s_manager_id + 10000 = t.id"""


@query("org_users", ctes("manager", "archive", "person", "portal_users") + " SELECT * FROM portal_users")
def org_users(t):
    return _portal_users(t)


@query(
    "org_users_workflow",
    ctes("manager", "archive", "person")
    + f""" SELECT coalesce(t.id, s_manager_id + 10000) AS id,
      CASE WHEN s_manager_id IS NULL THEN t.nickname ELSE coalesce(s_name, s_account) END AS nickname,
      CASE WHEN s_manager_id IS NULL THEN t.username ELSE replace(s_employee_num, '.', '') END AS username,
      CASE WHEN regexp_matches(dd_depart_ids, '^[0-9]+$') THEN TRY_CAST(dd_depart_ids AS BIGINT) + 10000 END AS dept_id,
      CAST(NULL AS VARCHAR) AS post_ids, nullif(ta_email, '') AS email, left(s_cellphone, 11) AS mobile,
      CASE WHEN s_manager_id IS NOT NULL THEN CAST(s_deleted_time IS NOT NULL AS INTEGER) END AS deleted,
      CASE WHEN s_manager_id IS NOT NULL THEN 1 END AS tenant_id
    FROM ({_USERS_OLD}) t FULL JOIN person ON s_manager_id + 10000 = t.id""",
)
def org_users_workflow(t):
    columns = {
        "dept_id": "long", "post_ids": "string", "email": "string", "mobile": "string", "deleted": "int",
        "tenant_id": "int",
    }
    return org.workflow_users(m.manager(t), m.archive(t), _with_nulls(_users_old(t), columns), _now(), EXCLUDED)


# --- C3 -----------------------------------------------------------------------


@query(
    "org_memberships",
    ctes("depart", "visible", "portal_old", "portal_new", "manager", "archive", "person", "portal_users")
    + f""", old AS (SELECT n_nationkey + 10000 AS department_id, n_regionkey + 10000 AS user_id, false AS is_main,
      false AS is_owner, TIMESTAMP '2019-01-01' AS created_at, TIMESTAMP '2019-01-01' AS updated_at FROM nation),
    pairs AS (SELECT TRY_CAST(dd_depart_ids AS BIGINT) + 10000 AS department_id, s_manager_id + 10000 AS user_id,
      is_lead = 1 AS is_owner FROM person WHERE regexp_matches(dd_depart_ids, '^[0-9]+$')),
    known AS (SELECT p.* FROM pairs p JOIN portal_users u ON u.id = p.user_id
      JOIN portal_new d ON d.id = p.department_id)
    SELECT department_id, user_id, coalesce(k.is_owner, old.is_owner) AS is_owner,
      k.user_id IS NOT NULL AS is_main, coalesce(old.created_at, {NOW_SQL}) AS created_at,
      CASE WHEN k.user_id IS NULL THEN old.updated_at ELSE {NOW_SQL} END AS updated_at
    FROM old FULL JOIN (SELECT department_id, user_id, is_owner FROM known) k USING (department_id, user_id)""",
)
def org_memberships(t):
    old = t.nation.select(
        (F.col("n_nationkey") + 10000).cast("long").alias("department_id"),
        (F.col("n_regionkey") + 10000).cast("long").alias("user_id"),
        F.lit(False).alias("is_main"),
        F.lit(False).alias("is_owner"),
        m.ntz("2019-01-01").alias("created_at"),
        m.ntz("2019-01-01").alias("updated_at"),
    )
    departments = org.portal_departments(m.depart(t), _portal_old(t), _now())
    return org.memberships(m.manager(t), m.archive(t), _portal_users(t), departments, old, _now(), EXCLUDED)


# --- C4 -----------------------------------------------------------------------


def _empty(t, ddl: str):
    return t.spark.createDataFrame([], ddl)


# Target columns of a post and their constants.
_POSTS = f"""SELECT s_talent_position_id + 10000 AS id, s_position AS name,
  coalesce(nullif(s_en_position, ''), s_position) AS code, coalesce(sort, 0) AS sort, 0 AS status, '' AS remark,
  '' AS creator, coalesce(gmt_create, {NOW_SQL}) AS create_time, '' AS updater,
  coalesce(gmt_modified, gmt_create, {NOW_SQL}) AS update_time, false AS deleted, 1 AS tenant_id
  FROM position WHERE is_delete = 0"""


@query("org_posts", ctes("position") + " " + _POSTS)
def org_posts(t):
    ddl = (
        "id long, name string, code string, sort int, status int, remark string, creator string, "
        "create_time timestamp_ntz, updater string, update_time timestamp_ntz, deleted boolean, tenant_id int"
    )
    return org.posts(m.position(t), _empty(t, ddl), _now())


VIEWS["user_posts"] = """
SELECT s_manager_id + 10000 AS user_id, s_talent_position_id + 10000 AS post_id, gmt_create AS create_time,
  gmt_modified AS update_time, is_delete AS deleted, 1 AS tenant_id FROM person
UNION ALL SELECT s_suppkey + 10000, s_nationkey + 20000, NULL, NULL, s_acctbal < 0, 1 FROM supplier"""


def _user_posts(t):
    old = t.supplier.select(
        (F.col("s_suppkey") + 10000).alias("user_id"),
        (F.col("s_nationkey") + 20000).cast("long").alias("post_id"),
        _none("timestamp_ntz").alias("create_time"),
        _none("timestamp_ntz").alias("update_time"),
        (F.col("s_acctbal") < 0).alias("deleted"),
        F.lit(1).alias("tenant_id"),
    )
    return org.user_posts(m.manager(t), m.archive(t), old, _now(), EXCLUDED)


@query("org_user_posts", ctes("manager", "archive", "person", "user_posts") + " SELECT * FROM user_posts")
def org_user_posts(t):
    return _user_posts(t)


@query(
    "org_post_lists",
    ctes("manager", "archive", "person", "user_posts")
    + """, lists AS (SELECT user_id, '[' || string_agg(CAST(post_id AS VARCHAR), ',' ORDER BY post_id) || ']' AS ids
      FROM (SELECT DISTINCT user_id, post_id FROM user_posts WHERE NOT deleted) GROUP BY user_id)
    SELECT c_custkey + 10000 AS id, coalesce(CASE WHEN c_nationkey = 1 THEN '[1]' END, ids) AS post_ids
    FROM customer LEFT JOIN lists ON user_id = c_custkey + 10000""",
)
def org_post_lists(t):
    users = t.customer.select(
        (F.col("c_custkey") + 10000).alias("id"),
        F.when(F.col("c_nationkey") == 1, F.lit("[1]")).alias("post_ids"),
        F.lit(1).alias("tenant_id"),
    )
    return org.fill_post_lists(users, _user_posts(t)).select("id", "post_ids")


@query(
    "org_default_roles",
    ctes("manager", "archive", "person", "user_posts")
    + f""" SELECT c_custkey + 10000 AS user_id, CASE WHEN c_nationkey < 20 THEN 1 ELSE 2 END AS tenant_id,
      (SELECT min(r_regionkey) FROM region WHERE r_name = 'ASIA') AS role_id, {NOW_SQL} AS create_time
    FROM customer WHERE c_acctbal >= 0 AND c_nationkey < 20
      AND c_custkey + 10000 NOT IN (SELECT user_id FROM user_posts WHERE NOT deleted)""",
)
def org_default_roles(t):
    users = t.customer.select(
        (F.col("c_custkey") + 10000).alias("id"),
        F.when(F.col("c_acctbal") >= 0, 0).otherwise(1).alias("deleted"),
        F.when(F.col("c_nationkey") < 20, 1).otherwise(2).alias("tenant_id"),
    )
    roles = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"), F.lit(1).alias("tenant_id"))
    return org.default_roles(users, _user_posts(t), roles, "ASIA", _now())


# --- C5, C6 -------------------------------------------------------------------

VIEWS["hr_old"] = """
SELECT c_custkey + 1 AS id, c_custkey AS origin_id,
  CAST(to_json({'zh_CN': c_name, 'en_US': c_name, 'ja_JP': c_name}) AS VARCHAR) AS name,
  CASE WHEN c_custkey > 0 THEN c_custkey // 8 END AS origin_parent_id, CAST(NULL AS BIGINT) AS parent_id,
  c_mktsegment <> 'FURNITURE' AS active
FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY')"""

VIEWS["hr_new"] = f"""
SELECT coalesce(t.id, row_number() OVER (PARTITION BY t.id IS NULL ORDER BY s.dd_id) + (SELECT max(id) FROM hr_old))
    AS id, coalesce(t.origin_id, s.dd_id) AS origin_id,
  CASE WHEN s.dd_id IS NULL THEN t.name ELSE s.name END AS name,
  CASE WHEN s.dd_id IS NULL THEN t.origin_parent_id ELSE s.dd_parent_id END AS origin_parent_id,
  s.dd_id IS NOT NULL AS active,
  CASE WHEN t.id IS NOT NULL AND s.dd_id IS NOT NULL AND (s.name <> t.name
    OR s.dd_parent_id IS DISTINCT FROM t.origin_parent_id) THEN {NOW_SQL} END AS write_date
FROM hr_old t FULL JOIN (SELECT dd_id, dd_parent_id, CAST(to_json({{'zh_CN': dd_name,
    'en_US': coalesce(s_en_name, dd_name), 'ja_JP': coalesce(s_jp_name, dd_name)}}) AS VARCHAR) AS name
  FROM depart WHERE dd_deleted_time IS NULL) s ON s.dd_id = t.origin_id"""

VIEWS["hr_linked"] = """
SELECT n.*, p.id AS parent_id FROM hr_new n LEFT JOIN hr_new p ON p.origin_id = n.origin_parent_id"""


def _hr_old(t):
    name = F.col("c_name")
    kept = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "MACHINERY"))
    return kept.select(
        (F.col("c_custkey") + 1).alias("id"),
        F.col("c_custkey").alias("origin_id"),
        F.to_json(F.struct(name.alias("zh_CN"), name.alias("en_US"), name.alias("ja_JP"))).alias("name"),
        F.when(F.col("c_custkey") > 0, F.expr("c_custkey div 8")).alias("origin_parent_id"),
        _none("long").alias("parent_id"),
        _none("string").alias("complete_name"),
        _none("string").alias("parent_path"),
        (F.col("c_mktsegment") != "FURNITURE").alias("active"),
        _none("int").alias("company_id"),
        _none("timestamp_ntz").alias("write_date"),
    )


def _hr_departments(t):
    live = m.depart(t).filter(F.col("dd_deleted_time").isNull())
    company = t.region.filter(F.col("r_name") == "ASIA").select("r_regionkey").scalar()
    return erp.departments(_hr_old(t), live, company, _now())


@query(
    "erp_departments",
    ctes("depart", "hr_old", "hr_new", "hr_linked")
    + """, walk AS (SELECT id, name ->> '$.zh_CN' AS names, id || '/' AS ids FROM hr_linked WHERE parent_id IS NULL
      UNION ALL SELECT d.id, w.names || ' / ' || (d.name ->> '$.zh_CN'), w.ids || d.id || '/'
      FROM hr_linked d JOIN walk w ON d.parent_id = w.id)
    SELECT h.*, w.names AS complete_name, w.ids AS parent_path FROM hr_linked h LEFT JOIN walk w ON w.id = h.id""",
)
def erp_departments(t):
    return _hr_departments(t).drop("company_id")


VIEWS["hr_job_old"] = """
SELECT s_nationkey + 1 AS id, s_nationkey + 20 AS origin_id, 'old' AS name, true AS active FROM supplier
GROUP BY s_nationkey"""

VIEWS["hr_job_new"] = """
SELECT coalesce(t.id, row_number() OVER (PARTITION BY t.id IS NULL ORDER BY s_talent_position_id)
    + (SELECT max(id) FROM hr_job_old)) AS id, coalesce(t.origin_id, s_talent_position_id) AS origin_id,
  CASE WHEN s_talent_position_id IS NULL THEN t.name ELSE CAST(to_json({'zh_CN': s_position,
    'en_US': coalesce(s_en_position, s_position)}) AS VARCHAR) END AS name,
  coalesce(is_delete = 0, false) AS active
FROM hr_job_old t FULL JOIN position ON s_talent_position_id = t.origin_id"""


def _hr_jobs(t):
    old = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("s_nationkey") + 1).cast("long").alias("id"),
        (F.col("s_nationkey") + 20).cast("long").alias("origin_id"),
        F.lit("old").alias("name"),
        F.lit(True).alias("active"),
        _none("int").alias("company_id"),
    )
    return erp.jobs(old, m.position(t), F.lit(1))


@query("erp_jobs", ctes("position", "hr_job_old", "hr_job_new") + " SELECT * FROM hr_job_new")
def erp_jobs(t):
    return _hr_jobs(t).drop("company_id")


# --- C7 -----------------------------------------------------------------------

VIEWS["resource_old"] = """
SELECT c_custkey + 50 AS id, CASE WHEN c_nationkey <> 4 THEN c_custkey END AS origin_id, 'Old' AS name,
  CASE WHEN c_nationkey = 5 THEN 'material' ELSE 'user' END AS resource_type, true AS active
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'"""

VIEWS["staff_source"] = """
SELECT m.s_manager_id AS origin_id, m.s_account AS name, m.s_activate_flag = 1 AS active, a.s_employee_num AS barcode,
  d.id AS department_id, j.id AS job_id
FROM manager m JOIN archive a ON a.s_talent_archives_id = m.s_talent_id
LEFT JOIN hr_linked d ON d.origin_id = CASE WHEN regexp_matches(dd_depart_ids, '^[0-9]+$')
  THEN TRY_CAST(dd_depart_ids AS BIGINT) END
LEFT JOIN hr_job_new j ON j.origin_id = a.s_talent_position_id"""

VIEWS["resource_typed"] = """
SELECT coalesce(t.id, row_number() OVER (PARTITION BY t.id IS NULL ORDER BY s.origin_id)
    + (SELECT max(id) FROM resource_old)) AS id, coalesce(t.origin_id, s.origin_id) AS origin_id,
  coalesce(s.name, t.name) AS name, 'user' AS resource_type, coalesce(s.active, t.active) AS active
FROM (SELECT * FROM resource_old WHERE resource_type = 'user') t FULL JOIN staff_source s ON s.origin_id = t.origin_id"""

_RESOURCES = """ SELECT id, origin_id, name, resource_type, active AND origin_id IS NOT NULL AS active FROM (
  SELECT * FROM resource_typed UNION ALL
  SELECT r.id, r.origin_id, coalesce(s.name, r.name), r.resource_type, coalesce(s.active, r.active)
  FROM resource_old r LEFT JOIN staff_source s ON s.origin_id = r.origin_id WHERE r.resource_type <> 'user')"""

_STAFF_VIEWS = (
    "depart", "hr_old", "hr_new", "hr_linked", "position", "hr_job_old", "hr_job_new", "manager", "archive",
    "staff_source", "resource_old", "resource_typed",
)


def _employees(t):
    resources = t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(
        (F.col("c_custkey") + 50).alias("id"),
        F.when(F.col("c_nationkey") != 4, F.col("c_custkey")).alias("origin_id"),
        F.lit("Old").alias("name"),
        F.when(F.col("c_nationkey") == 5, F.lit("material")).otherwise(F.lit("user")).alias("resource_type"),
        F.lit(True).alias("active"),
    )
    staff = t.supplier.select(
        (F.col("s_suppkey") + 7).alias("id"),
        _none("long").alias("resource_id"),
        F.when(F.col("s_nationkey") != 4, F.col("s_suppkey")).alias("origin_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") == 5, F.lit("student")).otherwise(F.lit("employee")).alias("employee_type"),
        F.lit(True).alias("active"),
        _none("string").alias("barcode"),
        _none("long").alias("department_id"),
        _none("long").alias("job_id"),
    )
    from millrace.session import cut_lineage

    department, job = cut_lineage(_hr_departments(t)), cut_lineage(_hr_jobs(t))
    return erp.employees(resources, staff, m.manager(t), m.archive(t), department, job, F.lit(1), _now())


@query("erp_resources", ctes(*_STAFF_VIEWS) + _RESOURCES)
def erp_resources(t):
    return _employees(t)[0]


@query(
    "erp_employees",
    ctes(*_STAFF_VIEWS)
    + """, old AS (SELECT s_suppkey + 7 AS id, CASE WHEN s_nationkey <> 4 THEN s_suppkey END AS origin_id,
      s_name AS name, CASE WHEN s_nationkey = 5 THEN 'student' ELSE 'employee' END AS employee_type FROM supplier),
    merged AS (SELECT coalesce(t.id, row_number() OVER (PARTITION BY t.id IS NULL ORDER BY s.origin_id)
        + (SELECT max(id) FROM old)) AS id, CASE WHEN t.id IS NULL THEN r.id END AS resource_id,
      coalesce(t.origin_id, s.origin_id) AS origin_id, coalesce(s.name, t.name) AS name, 'employee' AS employee_type,
      coalesce(s.active, true) AS active, CASE WHEN t.id IS NULL THEN s.barcode END AS barcode,
      s.department_id, s.job_id
      FROM (SELECT * FROM old WHERE employee_type = 'employee') t FULL JOIN staff_source s ON s.origin_id = t.origin_id
      LEFT JOIN resource_typed r ON r.origin_id = s.origin_id)
    SELECT * REPLACE (active AND origin_id IS NOT NULL AS active) FROM merged
    UNION ALL SELECT id, NULL, origin_id, name, employee_type, true, NULL, NULL, NULL FROM old
    WHERE employee_type <> 'employee'""",
)
def erp_employees(t):
    return _employees(t)[1]


# --- C8 -----------------------------------------------------------------------


@query(
    "erp_partners",
    ctes("place_text")
    + """, ids AS (SELECT *, string_split(trim(s_country_id, '[]'), ',') AS parts FROM place_text),
    split AS (SELECT *, TRY_CAST(nullif(parts[1], '') AS BIGINT) AS p1, TRY_CAST(nullif(parts[2], '') AS BIGINT) AS p2,
      TRY_CAST(nullif(parts[3], '') AS BIGINT) AS p3 FROM ids)
    SELECT s_supplier_id AS origin_id, s_supplier_name AS name, s_email AS email, 'Asia/Shanghai' AS tz,
      (SELECT r_regionkey FROM region WHERE r_name = 'EUROPE') AS supplier_type,
      r.r_regionkey + 100 AS country_id, a.n_nationkey + 200 AS state_id, b.n_name AS city, true AS active, 'draft' AS status,
      's_supplier_num' || s_supplier_id AS customer_code, s_supplier_name AS complete_name,
      's_supplier_short_name' || s_supplier_id AS customer_short_name, 's_address' || s_supplier_id AS street,
      's_total_person' || s_supplier_id AS employee_number, 's_workshop_person' || s_supplier_id AS production_staff,
      's_technical_person' || s_supplier_id AS technical_staff, s_email AS email_normalized,
      's_remark' || s_supplier_id AS comment, CASE WHEN s_supplier_id % 4 <> 0 THEN CAST(s_supplier_id AS INTEGER) END AS score
    FROM split LEFT JOIN region r ON r_regionkey = p1 LEFT JOIN nation a ON a.n_nationkey = p2
    LEFT JOIN nation b ON b.n_nationkey = p3
    WHERE is_delete = 0 AND s_email IS NOT NULL AND s_supplier_id NOT IN (SELECT n_nationkey FROM nation)""",
)
def erp_partners(t):
    known = t.nation.select(F.col("n_nationkey").cast("long").alias("origin_id"))
    countries = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    areas = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    kind = t.region.filter(F.col("r_name") == "EUROPE").select("r_regionkey").scalar()
    places = m.place_text(t)
    plain = sorted({c for c in erp.PARTNER_COLUMNS.values() if c not in places.columns})
    supplier = places.withColumns({c: F.concat(F.lit(c), "s_supplier_id") for c in plain})
    score = F.when(F.col("s_supplier_id") % 4 != 0, F.col("s_supplier_id").cast("string")).otherwise(F.lit("n/a"))
    rows = erp.partners(
        known, supplier.withColumn("s_score", score), countries, areas,
        countries.withColumn("id", F.col("id") + 100), areas.withColumn("id", F.col("id") + 200), kind,
    )
    return rows.select(
        "origin_id", "name", "email", "tz", "supplier_type", "country_id", "state_id", "city", "active", "status",
        *[c for c in erp.PARTNER_COLUMNS if c not in ("name", "email")], "score",
    )


@query(
    "erp_partner_properties",
    """SELECT s_suppkey AS partner_id, r_regionkey AS property_id FROM supplier CROSS JOIN region
    WHERE r_name IN ('ASIA', 'EUROPE') AND s_acctbal >= 0 AND NOT EXISTS (SELECT 1 FROM nation
      WHERE n_nationkey = s_suppkey AND n_regionkey = r_regionkey)""",
)
def erp_partner_properties(t):
    partners = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).alias("origin_id")
    )
    properties = t.region.filter(F.col("r_name").isin("ASIA", "EUROPE")).select(F.col("r_regionkey").alias("id"))
    existing = t.nation.select(
        F.col("n_nationkey").cast("long").alias("partner_id"), F.col("n_regionkey").alias("property_id")
    )
    return erp.partner_properties(partners, properties, existing)


# --- C9 -----------------------------------------------------------------------

VIEWS["yarn_tree"] = """
SELECT p_size AS s_tree_id, CASE WHEN p_size <= 5 THEN 'L' ELSE 'C' || (p_size // 2) END AS s_code,
  CASE WHEN p_size > 20 THEN 'N' || (p_size // 2) END AS s_name
FROM part GROUP BY p_size"""

VIEWS["yarn_entries"] = """
SELECT h.code AS dict_code, least_size * 10 + h.k AS id, 'N' || (least_size // 2) AS code, mnemonic_code,
  'N' || (least_size // 2) AS name
FROM (SELECT min(p_size) AS least_size, CASE WHEN p_size <= 5 THEN 'L' ELSE 'C' || (p_size // 2) END AS mnemonic_code
  FROM part WHERE p_size < 40 GROUP BY 2),
  (VALUES ('yarn_type', 1), ('quality_of_yarn', 2), ('spinning_method', 3), ('special_fiber', 4),
   ('yarn_count_unit', 5), ('fiber', 6)) h(code, k)"""


def _yarn_code():
    return F.when(F.col("p_size") <= 5, F.lit("L")).otherwise(F.concat(F.lit("C"), F.expr("p_size div 2")))


def _yarn_tree(t):
    size = F.col("p_size")
    return t.part.select("p_size").distinct().select(
        size.alias("s_tree_id"),
        _yarn_code().alias("s_code"),
        F.when(size > 20, F.concat(F.lit("N"), F.expr("p_size div 2"))).alias("s_name"),
    )


def _yarn_entries(t):
    """Six dictionaries that share their codes and lack the largest sizes."""
    codes = ["yarn_type", "quality_of_yarn", "spinning_method", "special_fiber", "yarn_count_unit", "fiber"]
    heads = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(k).alias("k")) for k, c in enumerate(codes, start=1)])
    listed = t.part.filter(F.col("p_size") < 40).groupBy(_yarn_code().alias("mnemonic_code")).agg(
        F.min("p_size").alias("least")
    )
    name = F.concat(F.lit("N"), F.expr("least div 2"))
    return listed.select("least", "mnemonic_code", F.explode(heads).alias("h")).select(
        F.col("h.code").alias("dict_code"),
        (F.col("least") * 10 + F.col("h.k")).alias("id"),
        name.alias("code"),
        "mnemonic_code",
        name.alias("name"),
    )


VIEWS["yarn_store"] = """
SELECT p_partkey AS s_yarn_store_id, 'Y' || p_partkey AS s_yarn_code, p_size AS s_yarn_type_id,
  CASE WHEN p_type <> 'PROMO' THEN (p_partkey // 7) % 50 + 1 END AS s_yarn_color_id,
  p_partkey % 60 AS s_staple_yarn_quality_id, (p_partkey // 3) % 50 + 1 AS s_staple_spinning_method_id,
  CASE WHEN p_type = 'SMALL' THEN p_size END AS s_staple_special_fiber_id,
  CASE WHEN p_type = 'LARGE' THEN p_size END AS s_blended_special_fiber_id,
  (p_partkey // 11) % 50 + 1 AS s_yarn_count_unit_id, 'F' || p_size AS s_yarn_count_unit_f,
  CASE WHEN p_size > 9 THEN p_name END AS s_remark, CAST(p_retailprice > 990 AS INTEGER) AS is_delete
FROM part"""


def _yarn_store(t):
    key = F.col("p_partkey")
    return t.part.select(
        key.alias("s_yarn_store_id"),
        F.concat(F.lit("Y"), key).alias("s_yarn_code"),
        F.col("p_size").alias("s_yarn_type_id"),
        F.when(F.col("p_type") != "PROMO", F.expr("(p_partkey div 7) % 50 + 1")).alias("s_yarn_color_id"),
        (key % 60).alias("s_staple_yarn_quality_id"),
        F.expr("(p_partkey div 3) % 50 + 1").alias("s_staple_spinning_method_id"),
        F.when(F.col("p_type") == "SMALL", F.col("p_size")).alias("s_staple_special_fiber_id"),
        F.when(F.col("p_type") == "LARGE", F.col("p_size")).alias("s_blended_special_fiber_id"),
        F.expr("(p_partkey div 11) % 50 + 1").alias("s_yarn_count_unit_id"),
        F.concat(F.lit("F"), "p_size").alias("s_yarn_count_unit_f"),
        F.when(F.col("p_size") > 9, F.col("p_name")).alias("s_remark"),
        (F.col("p_retailprice") > 990).cast("int").alias("is_delete"),
    )


VIEWS["yarn_coded"] = """
SELECT s.*, b.s_code AS yarn_type, c.s_code AS colour, q.s_code AS quality, k.s_code AS spinning,
  coalesce(f1.s_name, f2.s_name) AS special, u.s_name AS unit
FROM yarn_store s LEFT JOIN yarn_tree b ON b.s_tree_id = s_yarn_type_id
LEFT JOIN yarn_tree c ON c.s_tree_id = s_yarn_color_id LEFT JOIN yarn_tree q ON q.s_tree_id = s_staple_yarn_quality_id
LEFT JOIN yarn_tree k ON k.s_tree_id = s_staple_spinning_method_id
LEFT JOIN yarn_tree f1 ON f1.s_tree_id = s_staple_special_fiber_id
LEFT JOIN yarn_tree f2 ON f2.s_tree_id = s_blended_special_fiber_id
LEFT JOIN yarn_tree u ON u.s_tree_id = s_yarn_count_unit_id
WHERE s_yarn_store_id NOT IN (SELECT s_suppkey FROM supplier)"""


def _entry(alias: str, dict_code: str, column: str, key: str) -> str:
    return (
        f"LEFT JOIN (SELECT * FROM yarn_entries WHERE dict_code = '{dict_code}') {alias} ON {alias}.{column} = {key} "
    )


VIEWS["yarn_colours"] = """
SELECT e.id + 5000 AS id, 'C' || (e.id // 20) AS code, e.id AS yarn_type FROM yarn_entries e
WHERE dict_code = 'yarn_type'"""

VIEWS["yarn_library"] = (
    """
SELECT s_suppkey + 1 AS id, s_suppkey AS origin_id, 'old' AS technical_code, CAST(NULL AS INTEGER) AS yarn_type,
  CAST(NULL AS INTEGER) AS color_of_yarn, CAST(NULL AS INTEGER) AS quality_of_yarn, CAST(NULL AS INTEGER)
  AS spinning_method, CAST(NULL AS INTEGER) AS special_fiber, CAST(NULL AS INTEGER) AS yarn_count_unit,
  CAST(NULL AS VARCHAR) AS f_number, CAST(NULL AS VARCHAR) AS remark, true AS active, 'done' AS status,
  CAST(NULL AS VARCHAR) AS composition_code, CASE WHEN s_nationkey > 3 THEN 'SX' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS yarn_code
FROM supplier
UNION ALL
SELECT row_number() OVER (ORDER BY s_yarn_store_id) + (SELECT max(s_suppkey) + 1 FROM supplier), s_yarn_store_id,
  s_yarn_code, y.id, col.id, q.id, k.id, f.id, u.id, CASE WHEN a.yarn_type = 'L' THEN s_yarn_count_unit_f END,
  CAST(to_json({'zh_CN': s_remark, 'en_US': s_remark}) AS VARCHAR), is_delete = 0, 'draft', NULL, NULL
FROM yarn_coded a """
    + _entry("y", "yarn_type", "mnemonic_code", "a.yarn_type")
    + _entry("q", "quality_of_yarn", "mnemonic_code", "a.quality")
    + _entry("k", "spinning_method", "mnemonic_code", "a.spinning")
    + _entry("f", "special_fiber", "name", "a.special")
    + _entry("u", "yarn_count_unit", "code", "a.unit")
    + "LEFT JOIN yarn_colours col ON col.code = a.colour AND col.yarn_type = y.id"
)


def _yarn_old(t):
    base = t.supplier.select(
        (F.col("s_suppkey") + 1).alias("id"), F.col("s_suppkey").alias("origin_id"), F.lit("old").alias("technical_code")
    )
    for name in ("yarn_type", "color_of_yarn", "quality_of_yarn", "spinning_method", "special_fiber", "yarn_count_unit"):
        base = base.withColumn(name, _none("int"))
    base = base.withColumn("f_number", _none("string")).withColumn("remark", _none("string"))
    base = base.withColumns(
        {"active": F.lit(True), "status": F.lit("done"), "composition_code": _none("string")}
    )
    code = F.when(
        F.col("s_nationkey") > 3, F.concat(F.lit("SX"), F.lpad(F.col("origin_id").cast("string"), 5, "0"))
    )
    nations = t.supplier.select(F.col("s_suppkey").alias("origin_id"), "s_nationkey")
    return base.join(nations, "origin_id").withColumn("yarn_code", code).select(*base.columns, "yarn_code")


def _yarn_library(t):
    entries = _yarn_entries(t)
    types = entries.filter(F.col("dict_code") == "yarn_type")
    colours = types.select(
        (F.col("id") + 5000).alias("id"),
        F.concat(F.lit("C"), F.expr("id div 20")).alias("code"),
        F.col("id").alias("yarn_type"),
    )
    store = _yarn_store(t)
    roles = {k: v for k, v in yarn.ROLES.items() if k in store.columns}
    fields = {k: yarn.DICTIONARIES[k] for k in ("yarn_type", "quality_of_yarn", "spinning_method", "special_fiber", "yarn_count_unit")}
    return yarn.library(_yarn_old(t), store, _yarn_tree(t), entries, colours, roles, fields)


_YARN = ("yarn_tree", "yarn_entries", "yarn_store", "yarn_coded", "yarn_colours", "yarn_library")


@query("yarn_library", ctes(*_YARN) + " SELECT * FROM yarn_library")
def yarn_library(t):
    return _yarn_library(t)


def _role_key(k: int) -> str:
    """Tree key of role ``k``: differs from role to role and misses some."""
    return f"(p_partkey // {k + 2} + {k}) % 60"


VIEWS["yarn_dictionaries"] = (
    "SELECT h.code AS dict_code, least_size * 20 + h.k AS id, 'N' || (least_size // 2) AS code, mnemonic_code, "
    "'N' || (least_size // 2) AS name FROM (SELECT min(p_size) AS least_size, CASE WHEN p_size <= 5 THEN 'L' "
    "ELSE 'C' || (p_size // 2) END AS mnemonic_code FROM part WHERE p_size < 40 GROUP BY 2), (VALUES "
    + ", ".join(f"('{code}', {k})" for k, (code, _) in enumerate(yarn.DICTIONARIES.values(), start=1))
    + ") h(code, k)"
)

_ROLE_OF = {out: (k, column) for k, (out, column) in enumerate(yarn.ROLES.values())}
_CODED = {
    **{out: f"r{k}.{column}" for out, (k, column) in _ROLE_OF.items() if not out.startswith("special_")},
    "special_fiber": "coalesce(" + ", ".join(f"r{k}.{c}" for out, (k, c) in _ROLE_OF.items() if out.startswith("special_")) + ")",
}


@query(
    "yarn_attributes",
    ctes("yarn_tree", "yarn_dictionaries")
    + " SELECT p_partkey AS s_yarn_store_id, r1.s_code AS color_of_yarn, "
    + ", ".join(f"d{i}.id AS {field}" for i, field in enumerate(yarn.DICTIONARIES))
    + " FROM part "
    + " ".join(f"LEFT JOIN yarn_tree r{k} ON r{k}.s_tree_id = {_role_key(k)}" for k in range(len(yarn.ROLES)))
    + " "
    + " ".join(
        f"LEFT JOIN (SELECT * FROM yarn_dictionaries WHERE dict_code = '{code}') d{i} ON d{i}.{column} = {_CODED[field]}"
        for i, (field, (code, column)) in enumerate(yarn.DICTIONARIES.items())
    ),
)
def yarn_attributes(t):
    """All seventeen roles and all fourteen dictionaries of the library."""
    store = t.part.select(
        F.col("p_partkey").alias("s_yarn_store_id"),
        *[F.expr(_role_key(k).replace("//", "div")).alias(key) for k, key in enumerate(yarn.ROLES)],
    )
    codes = list(dict.fromkeys(code for code, _ in yarn.DICTIONARIES.values()))
    heads = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(k).alias("k")) for k, c in enumerate(codes, start=1)])
    listed = t.part.filter(F.col("p_size") < 40).groupBy(_yarn_code().alias("mnemonic_code")).agg(
        F.min("p_size").alias("least")
    )
    name = F.concat(F.lit("N"), F.expr("least div 2"))
    entries = listed.select("least", "mnemonic_code", F.explode(heads).alias("h")).select(
        F.col("h.code").alias("dict_code"), (F.col("least") * 20 + F.col("h.k")).alias("id"), name.alias("code"),
        "mnemonic_code", name.alias("name"),
    )
    coded = yarn.merge_special(yarn.resolve_roles(store, _yarn_tree(t)))
    found = yarn.resolve_dictionaries(coded, entries)
    return found.select("s_yarn_store_id", "color_of_yarn", *yarn.DICTIONARIES)


VIEWS["yarn_parts"] = """
SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey) AS s_component_id, l_partkey AS s_yarn_store_id,
  l_orderkey % 55 AS s_tree_id, n AS s_ratio FROM (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS INTEGER) AS n
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)"""

VIEWS["yarn_components"] = (
    """
SELECT c.id AS fiber, CAST(s_ratio * 0.01 AS DOUBLE) AS proportion, l.id AS yarn_library_id, s_component_id AS origin_id
FROM yarn_parts a JOIN yarn_tree b ON b.s_tree_id = a.s_tree_id """
    + _entry("c", "fiber", "mnemonic_code", "b.s_code")
    + " LEFT JOIN yarn_library l ON l.origin_id = a.s_yarn_store_id"
)


def _yarn_components(t, library):
    from millrace.operators.numbering import number_rows

    sums = (
        t.lineitem.filter(F.col("l_returnflag") == "A")
        .groupBy("l_orderkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("int").alias("s_ratio"))
    )
    rows = number_rows(sums, ["l_orderkey", "l_partkey"], "s_component_id").select(
        "s_component_id",
        F.col("l_partkey").alias("s_yarn_store_id"),
        (F.col("l_orderkey") % 55).alias("s_tree_id"),
        "s_ratio",
    )
    target = _empty(t, "fiber int, proportion double, yarn_library_id long, origin_id long")
    return yarn.components(target, rows, _yarn_tree(t), _yarn_entries(t), library)


@query("yarn_components", ctes(*_YARN, "yarn_parts", "yarn_components") + " SELECT * FROM yarn_components")
def yarn_components(t):
    return _yarn_components(t, _yarn_library(t))


@query(
    "yarn_composition_codes",
    ctes(*_YARN, "yarn_parts", "yarn_components")
    + """, ranked AS (SELECT yarn_library_id, mnemonic_code, row_number() OVER (PARTITION BY yarn_library_id
      ORDER BY proportion DESC, origin_id) AS rank FROM yarn_components c JOIN yarn_entries e ON e.id = c.fiber
      WHERE yarn_library_id IS NOT NULL)
    SELECT l.id, codes AS composition_code FROM yarn_library l LEFT JOIN (SELECT yarn_library_id,
      string_agg(mnemonic_code, '' ORDER BY rank) AS codes FROM ranked WHERE rank <= 2 GROUP BY yarn_library_id) c
      ON c.yarn_library_id = l.id""",
)
def yarn_composition_codes(t):
    from millrace.session import cut_lineage

    library = cut_lineage(_yarn_library(t))
    coded = yarn.composition_codes(library, _yarn_components(t, library), _yarn_entries(t))
    return coded.select("id", "composition_code")


@query(
    "yarn_prices",
    ctes(*_YARN)
    + """ SELECT l_shipdate AS inquiry_date, CAST(CAST(p AS DECIMAL(18,2)) AS VARCHAR) AS price, l.id AS yarn_library_id,
      origin FROM (SELECT l_partkey, l_orderkey * 100000 + l_partkey AS origin, min(l_shipdate) AS l_shipdate,
        min(nullif(l_extendedprice, 0)) AS p FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
    JOIN yarn_library l ON l.origin_id = l_partkey WHERE p IS NOT NULL
    AND origin NOT IN (SELECT o_orderkey * 100000 FROM orders)""",
)
def yarn_prices(t):
    rows = (
        t.lineitem.filter(F.col("l_returnflag") != "A")
        .groupBy("l_partkey", (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("s_yarn_price_id"))
        .agg(
            F.min("l_shipdate").alias("s_inquiry_date"),
            F.min(F.nullif(F.col("l_extendedprice"), F.lit(0.0))).cast("decimal(18,2)").alias("s_price"),
        )
        .withColumnRenamed("l_partkey", "s_yarn_store_id")
    )
    loaded = t.orders.select(
        _none("timestamp_ntz").alias("inquiry_date"),
        _none("decimal(18,2)").alias("price"),
        _none("long").alias("yarn_library_id"),
        (F.col("o_orderkey") * 100000).alias("origin_id"),
    )
    merged = yarn.prices(loaded, rows, _yarn_library(t)).filter(F.col("price").isNotNull())
    return merged.select(
        "inquiry_date", F.col("price").cast("string").alias("price"), "yarn_library_id", F.col("origin_id").alias("origin")
    )


@query(
    "yarn_serial_codes",
    ctes(*_YARN)
    + """ SELECT id, coalesce(yarn_code, 'SX' || lpad(CAST(row_number() OVER (PARTITION BY yarn_code IS NULL ORDER BY id)
      + (SELECT max(CAST(substr(yarn_code, 3) AS BIGINT)) FROM yarn_library) AS VARCHAR), 5, '0')) AS yarn_code
    FROM yarn_library""",
)
def yarn_serial_codes(t):
    from millrace.session import cut_lineage

    return yarn.serial_codes(cut_lineage(_yarn_library(t).select("id", "yarn_code")))


# --- C10 ----------------------------------------------------------------------

VIEWS["unit"] = """
SELECT lower(upper(substr(p_brand, 1, 1)) || substr(p_type, 2, 2)) AS code, min(p_partkey) AS id FROM part
WHERE p_type <> 'LARGE' GROUP BY ALL"""


def _units(t):
    code = F.lower(F.concat(F.upper(F.substring("p_brand", 1, 1)), F.substring("p_type", 2, 2)))
    kept = t.part.filter(F.col("p_type") != "LARGE")
    return kept.groupBy(code.alias("code")).agg(F.min("p_partkey").alias("id"))


VIEWS["fabric_old"] = """
SELECT CAST(s_suppkey AS BIGINT) AS id, '{"zh_CN":"' || s_name || '"}' AS name, s_nationkey AS weight_value,
  CAST(NULL AS VARCHAR) AS composition, CAST(NULL AS BIGINT) AS unit_id, 9 AS type_id, s_suppkey AS template_id
FROM supplier"""

VIEWS["fabric_new"] = """
SELECT * FROM fabric_old UNION ALL
SELECT row_number() OVER w + (SELECT max(id) FROM fabric_old), '{"zh_CN":"' || s_material_name || '"}', s_weight,
  s_fabric_composition, unit_id, 1, row_number() OVER w + (SELECT max(n_nationkey) FROM nation)
FROM (SELECT s_material_name, s_weight, s_fabric_composition, min(unit_id) AS unit_id FROM
  (SELECT DISTINCT s_material_name, s_weight, s_fabric_composition, lower(s_unit) AS u, unit.id AS unit_id
   FROM material_price LEFT JOIN unit ON unit.code = lower(s_unit) WHERE s_supplier_name IS NOT NULL)
  GROUP BY s_material_name, s_weight, s_fabric_composition HAVING count(*) = 1)
WINDOW w AS (ORDER BY '{"zh_CN":"' || s_material_name || '"}', s_weight, s_fabric_composition NULLS FIRST)"""


def _fabrics(t):
    old = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit('{"zh_CN":"'), "s_name", F.lit('"}')).alias("name"),
        F.col("s_nationkey").alias("weight_value"),
        _none("string").alias("composition"),
        _none("long").alias("unit_id"),
        F.lit(9).alias("type_id"),
        F.col("s_suppkey").alias("template_id"),
    )
    templates = t.nation.select(F.col("n_nationkey").cast("long").alias("id"))
    return materials.add_fabrics(old, templates, m.material_price(t), _units(t), F.lit(1))


@query("materials_fabrics", ctes("material_price", "unit", "fabric_old", "fabric_new") + " SELECT * FROM fabric_new")
def materials_fabrics(t):
    return _fabrics(t)[0]


VIEWS["accessory"] = """
SELECT o_orderkey AS s_material_id, CASE WHEN o_orderpriority <> '5-LOW' THEN 'Acc ' || o_custkey END AS s_material_name,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'u' || o_orderstatus END AS s_unit,
  CAST(o_totalprice < 20000 AS INTEGER) AS is_delete FROM orders"""


@query(
    "materials_accessories",
    ctes("accessory")
    + """ SELECT s_material_id AS origin_fl_id, CAST(to_json({'zh_CN': s_material_name}) AS VARCHAR) AS name,
      CASE s_unit WHEN 'uF' THEN 1 ELSE 2 END AS unit_id FROM accessory a
    WHERE s_material_name IS NOT NULL AND is_delete = 0 AND s_unit IS NOT NULL AND NOT EXISTS (SELECT 1 FROM accessory c
      WHERE c.s_material_name = a.s_material_name AND c.s_material_id > a.s_material_id)
    AND s_material_id NOT IN (SELECT n_nationkey FROM nation)""",
)
def materials_accessories(t):
    status = F.col("o_orderstatus")
    rows = t.orders.select(
        F.col("o_orderkey").alias("s_material_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("Acc "), "o_custkey")).alias("s_material_name"),
        F.when(status != "P", F.concat(F.lit("u"), status)).alias("s_unit"),
        (F.col("o_totalprice") < 20000).cast("int").alias("is_delete"),
    )
    units = t.orders.select("o_orderstatus").distinct().select(
        F.concat(F.lit("u"), "o_orderstatus").alias("name"), F.when(status == "F", 1).otherwise(2).alias("id")
    )
    known = t.nation.select(F.col("n_nationkey").alias("origin_fl_id"))
    return materials.accessories(rows, units, known)


_FABRIC_JOIN = """material_price a JOIN fabric_new c ON c.name ->> '$.zh_CN' = a.s_material_name
  AND c.weight_value = a.s_weight AND c.composition = a.s_fabric_composition"""


@query(
    "materials_colours",
    ctes("material_price", "unit", "fabric_old", "fabric_new")
    + f""" SELECT DISTINCT trim(a.s_color_name) AS name FROM {_FABRIC_JOIN}
    WHERE trim(a.s_color_name) NOT IN (SELECT 'Brand#' || n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def materials_colours(t):
    listed = t.nation.filter(F.col("n_regionkey") == 1).select(
        F.to_json(F.struct(F.concat(F.lit("Brand#"), "n_nationkey").alias("zh_CN"))).alias("name")
    )
    return materials.new_colours(m.material_price(t), _fabrics(t)[0], listed)


@query(
    "materials_fabric_variants",
    ctes("material_price", "unit", "fabric_old", "fabric_new")
    + f""" SELECT s_material_price_id AS origin_id, s_width AS name, s_new_material_num AS code,
      s_development_price AS price, b.n_nationkey AS color_id, c.id AS material_id, s_remark AS memo,
      gmt_create AS create_date, gmt_modified AS write_date
    FROM {_FABRIC_JOIN} JOIN nation b ON 'Brand#' || b.n_nationkey = a.s_color_name
    WHERE s_supplier_name IS NOT NULL AND s_width IS NOT NULL AND s_new_material_num NOT LIKE '-%'
    AND s_material_price_id NOT IN (SELECT s_suppkey FROM supplier) AND NOT EXISTS (SELECT 1 FROM material_price d
      WHERE d.s_material_name = a.s_material_name AND d.s_weight = a.s_weight
      AND d.s_fabric_composition = a.s_fabric_composition AND d.s_color_name = a.s_color_name
      AND d.s_material_price_id > a.s_material_price_id)""",
)
def materials_fabric_variants(t):
    colours = t.nation.select(
        F.col("n_nationkey").alias("id"),
        F.to_json(F.struct(F.concat(F.lit("Brand#"), "n_nationkey").alias("zh_CN"))).alias("name"),
    )
    known = t.supplier.select(F.col("s_suppkey").alias("origin_id"))
    rows = materials.fabric_variants(m.material_price(t), _fabrics(t)[0], colours, known)
    return rows.withColumn("price", F.col("price").cast("string"))


VIEWS["accessory_price"] = """
SELECT l_orderkey * 1000000 + l_partkey AS s_price_id, l_partkey AS s_material_id, min(l_suppkey) AS s_supplier_id,
  'c' || (min(l_linenumber)) AS s_color, 'st' || max(l_linenumber) AS s_standards,
  CAST(CAST(min(l_extendedprice) AS DECIMAL(18,2)) AS VARCHAR) AS s_bulk_price FROM lineitem GROUP BY l_orderkey, l_partkey"""


@query(
    "materials_accessory_variants",
    ctes("accessory_price")
    + """, known AS (SELECT p_partkey AS origin_fl_id, p_partkey + 5 AS id FROM part WHERE p_type = 'SMALL')
    SELECT s_price_id AS origin_fl_id, CAST(substr(s_color, 2) AS INTEGER) AS color_id, s_standards AS name,
      s_bulk_price AS price, k.id AS material_id FROM accessory_price a JOIN known k ON k.origin_fl_id = a.s_material_id
    WHERE s_color IN ('c1', 'c2', 'c3') AND s_material_id IN (SELECT s_material_id FROM accessory_price
      JOIN known ON origin_fl_id = s_material_id JOIN part p ON p.p_partkey = s_material_id AND p_size < 40 GROUP BY s_material_id, s_supplier_id HAVING count(*) = 1)
    AND NOT EXISTS (SELECT 1 FROM accessory_price b WHERE b.s_color = a.s_color
      AND b.s_material_id = a.s_material_id AND b.s_price_id > a.s_price_id)""",
)
def materials_accessory_variants(t):
    price = (
        t.lineitem.groupBy("l_orderkey", F.col("l_partkey").alias("s_material_id"))
        .agg(
            F.min("l_suppkey").alias("s_supplier_id"),
            F.concat(F.lit("c"), F.min("l_linenumber")).alias("s_color"),
            F.concat(F.lit("st"), F.max("l_linenumber")).alias("s_standards"),
            F.min("l_extendedprice").cast("decimal(18,2)").cast("string").alias("s_bulk_price"),
        )
        .withColumn("s_price_id", F.col("l_orderkey") * 1000000 + F.col("s_material_id"))
        .drop("l_orderkey")
    )
    known = t.part.filter(F.col("p_type") == "SMALL").select(
        F.col("p_partkey").alias("origin_fl_id"), (F.col("p_partkey") + 5).alias("id")
    )
    colours = t.region.filter(F.col("r_regionkey").between(1, 3)).select(
        F.col("r_regionkey").alias("id"),
        F.to_json(F.struct(F.concat(F.lit("c"), "r_regionkey").alias("zh_CN"))).alias("name"),
    )
    listed = t.part.filter("p_size < 40").select(F.col("p_partkey").alias("s_material_id"))
    rows = materials.accessory_variants(price, known, colours, _empty(t, "origin_fl_id long"), listed)
    return rows.withColumn("price", F.col("price").cast("string"))


@query(
    "materials_attribute_values",
    ctes("depart")
    + """ SELECT 'N' || sort AS code, CAST(to_json({'zh_CN': dd_name, 'en_US': s_en_name}) AS VARCHAR) AS name FROM depart
    WHERE dd_parent_id = 2 AND dd_deleted_time IS NULL AND 'N' || sort NOT IN (SELECT 'N' || r_regionkey FROM region)""",
)
def materials_attribute_values(t):
    tree = m.depart(t).select(
        F.col("dd_parent_id").alias("s_tree_pid"),
        F.concat(F.lit("N"), "sort").alias("s_code"),
        F.col("dd_name").alias("s_name"),
        F.col("s_en_name"),
        F.when(F.col("dd_deleted_time").isNull(), 0).otherwise(1).alias("is_delete"),
    )
    known = t.region.select(F.concat(F.lit("N"), "r_regionkey").alias("code"))
    return materials.new_attribute_values(tree, 2, known)


# --- C11 ----------------------------------------------------------------------

VIEWS["supplier_named"] = """
SELECT p.*, CASE WHEN n_regionkey <> 2 THEN 'Group ' || (s_supplier_id // 3) END AS s_name,
  CASE WHEN n_regionkey > 0 THEN 'G' || (s_supplier_id // 3) END AS s_short
FROM place_text p JOIN supplier ON s_suppkey = s_supplier_id JOIN nation ON n_nationkey = s_nationkey"""


@query(
    "material_partners",
    ctes("place_text", "supplier_named")
    + """, ids AS (SELECT *, coalesce(s_name, s_short) AS nm, string_split(trim(s_country_id, '[]'), ',') AS parts
      FROM supplier_named)
    SELECT s_supplier_id AS origin_id, coalesce(s_short, s_name) AS short_name, nm AS name, s_email AS email,
      CASE WHEN s_country_id IS NOT NULL THEN coalesce(r_name, '') || coalesce(a.n_name, '') || coalesce(b.n_name, '')
      END AS description, 'memo ' || s_supplier_id AS memo, true AS supplier_material
    FROM ids i LEFT JOIN region ON r_regionkey = TRY_CAST(nullif(parts[1], '') AS BIGINT)
    LEFT JOIN nation a ON a.n_nationkey = TRY_CAST(nullif(parts[2], '') AS BIGINT)
    LEFT JOIN nation b ON b.n_nationkey = TRY_CAST(nullif(parts[3], '') AS BIGINT)
    WHERE is_delete = 0 AND s_supplier_id NOT IN (SELECT n_nationkey FROM nation)
    AND NOT EXISTS (SELECT 1 FROM ids j WHERE j.nm = i.nm AND j.s_supplier_id > i.s_supplier_id)""",
)
def material_partners(t):
    region_of = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("s_suppkey").alias("s_supplier_id"), "n_regionkey"
    )
    group = F.expr("s_supplier_id div 3")
    named = m.place_text(t).join(region_of, "s_supplier_id").withColumns(
        {
            "s_supplier_name": F.when(F.col("n_regionkey") != 2, F.concat(F.lit("Group "), group)),
            "s_supplier_short_name": F.when(F.col("n_regionkey") > 0, F.concat(F.lit("G"), group)),
            "s_remark": F.concat(F.lit("memo "), "s_supplier_id"),
        }
    )
    countries = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    areas = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    known = t.nation.select(F.col("n_nationkey").alias("origin_id"))
    return materials.partners(named, countries, areas, known)


@query(
    "material_review_partners",
    """SELECT c_custkey AS origin_fl_id, '(' || c_name || ')' AS code, c_mktsegment AS short_name,
    'Full ' || c_name AS name, 'at ' || c_nationkey AS address, true AS supplier_material FROM customer WHERE c_nationkey > 2 AND c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
    AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def material_review_partners(t):
    company = t.customer.select(
        F.col("c_custkey").alias("s_company_id"),
        F.when(F.col("c_nationkey") > 2, F.lit("02")).otherwise(F.lit("01")).alias("s_company_sort"),
        F.when(F.col("c_acctbal") >= 0, 0).otherwise(1).alias("is_hidden"),
        F.col("c_mktsegment").alias("s_company_name"),
        F.col("c_name").alias("s_company_num"),
        F.concat(F.lit("Full "), "c_name").alias("s_company_full_name"),
        F.concat(F.lit("at "), "c_nationkey").alias("s_address"),
    )
    known = t.supplier.select(F.col("s_suppkey").alias("origin_fl_id"))
    return materials.review_partners(company, known, "BUILDING")


def _partners(t):
    return t.supplier.select(
        (F.col("s_suppkey") + 3).alias("id"),
        F.col("s_suppkey").alias("origin_id"),
        (F.col("s_acctbal") > 0).alias("supplier_material"),
        F.when(F.col("s_nationkey") > 12, F.col("s_nationkey")).alias("currency_id"),
    )


@query(
    "material_contacts",
    """SELECT c_custkey AS origin_id, s_suppkey + 3 AS partner_id, coalesce(nullif(c_name, 'Customer#000000009'), '/')
    AS name, c_mktsegment AS phone FROM customer JOIN supplier ON s_suppkey = c_custkey // 20 AND s_acctbal > 0
    WHERE c_custkey NOT IN (SELECT n_nationkey FROM nation)""",
)
def material_contacts(t):
    contact = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.expr("c_custkey div 20").alias("s_supplier_id"),
        F.nullif(F.col("c_name"), F.lit("Customer#000000009")).alias("s_contact_name"),
        F.col("c_mktsegment").alias("s_contact_phone"),
    )
    known = t.nation.select(F.col("n_nationkey").alias("origin_id"))
    return materials.contacts(contact, _partners(t), known)


@query(
    "material_banks",
    """SELECT c_custkey AS origin_id, s_suppkey + 3 AS partner_id, CASE WHEN s_nationkey > 12 THEN s_nationkey
      ELSE (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') END AS currency_id, c_name AS name,
    coalesce(nullif(c_mktsegment, 'MACHINERY'), '/') AS bank_name, 'B' || c_custkey AS code,
    CASE WHEN c_nationkey > 5 THEN 'default' END AS memo
    FROM customer JOIN supplier ON s_suppkey = c_custkey // 20 AND s_acctbal > 0
    WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE') AND c_acctbal < 9000
    AND c_custkey NOT IN (SELECT n_nationkey FROM nation)""",
)
def material_banks(t):
    segment = F.col("c_mktsegment")
    unit = F.when(segment == "BUILDING", F.lit("")).when(segment != "FURNITURE", F.col("c_name"))
    transfer = t.customer.select(
        F.col("c_custkey").alias("s_id"),
        F.expr("c_custkey div 20").alias("s_company_id"),
        unit.alias("s_receiving_unit"),
        F.nullif(segment, F.lit("MACHINERY")).alias("s_opening_bank"),
        F.concat(F.lit("B"), "c_custkey").alias("s_bank_account"),
        F.when(F.col("c_acctbal") < 9000, 0).otherwise(1).alias("is_delete"),
        (F.col("c_nationkey") > 5).alias("s_default_flag"),
    )
    known = t.nation.select(F.col("n_nationkey").alias("origin_id"))
    currency = t.region.filter(F.col("r_name") == "ASIA").select("r_regionkey").scalar()
    return materials.banks(transfer, _partners(t), known, currency, "default")


# --- C10, C11: targets with their templates ------------------------------------

# Natural key of every job's target.
_TEMPLATED = {
    "materials_accessories": "origin_fl_id", "materials_colours": "name", "materials_fabric_variants": "origin_id",
    "materials_accessory_variants": "origin_fl_id", "materials_attribute_values": "code", "material_partners": "origin_id",
    "material_review_partners": "origin_fl_id", "material_contacts": "origin_id", "material_banks": "origin_id",
}


def _register_templated(job: str, key: str) -> None:
    """Two queries per job: its next target, and the templates that go with it."""
    candidates, sql = QUERIES[job], ORACLES[job]
    numbered = f"WITH c AS ({sql}), n AS (SELECT *, row_number() OVER (ORDER BY {key}) AS rn FROM c)"

    def added(t):
        found = candidates(t.spark, t.folder)
        old = t.region.select(
            (F.col("r_regionkey") + 10).cast("long").alias("id"), (F.col("r_regionkey") + 1).cast("long").alias("template_id")
        )
        target = old.unionByName(found.limit(0), allowMissingColumns=True)
        templates = t.nation.select(F.col("n_nationkey").cast("long").alias("id"))
        return materials.add_with_template(target, templates, found, [key])

    rows = f"""{numbered} SELECT rn + (SELECT max(r_regionkey) + 10 FROM region) AS id,
      rn + (SELECT max(n_nationkey) FROM nation) AS template_id, * EXCLUDE (rn) FROM n
      UNION ALL BY NAME SELECT r_regionkey + 10 AS id, r_regionkey + 1 AS template_id FROM region"""
    side = f"""{numbered} SELECT rn + (SELECT max(n_nationkey) FROM nation) AS id FROM n
      UNION ALL SELECT n_nationkey FROM nation"""
    query(f"{job}_added", rows)(lambda t: added(t)[0])
    query(f"{job}_templates", side)(lambda t: added(t)[1])


for _job, _key in _TEMPLATED.items():
    _register_templated(_job, _key)


@query(
    "materials_fabric_templates",
    ctes("material_price", "unit", "fabric_old", "fabric_new")
    + """ SELECT n_nationkey AS id FROM nation UNION ALL
    SELECT template_id FROM fabric_new WHERE id > (SELECT max(id) FROM fabric_old)""",
)
def materials_fabric_templates(t):
    return _fabrics(t)[1]


# --- C12 ----------------------------------------------------------------------


@query(
    "punch_detail",
    ctes("archive")
    + """, old AS (SELECT event_id AS dk_id, 'T0' AS terminal_id, CAST(NULL AS VARCHAR) AS employee_num,
      CAST(NULL AS VARCHAR) AS username, CAST(NULL AS VARCHAR) AS device_name, ts AS dk_time FROM events
      WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-10')
    SELECT * FROM old UNION ALL
    SELECT event_id, 'T' || user_id, s_employee_num, s_name, props ->> '$.k', ts FROM events
    JOIN archive ON s_talent_archives_id = user_id AND s_employee_num IS NOT NULL
    WHERE event_type = 'click' AND ts > TIMESTAMP '2024-03-20' - INTERVAL 3 MONTH
    AND event_id NOT IN (SELECT dk_id FROM old)""",
)
def punch_detail(t):
    clicks = t.events.filter(F.col("event_type") == "click")
    old = clicks.filter(F.col("ts") < m.ntz("2024-01-10")).select(
        F.col("event_id").alias("dk_id"),
        F.lit("T0").alias("terminal_id"),
        _none("string").alias("employee_num"),
        _none("string").alias("username"),
        _none("string").alias("device_name"),
        F.col("ts").alias("dk_time"),
    )
    rows = t.events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("T"), "user_id").alias("terminal_id"),
        F.col("event_type").alias("check_type"),
        F.col("user_id").alias("ext_id"),
        F.col("ts").alias("check_time"),
        F.replace("props", F.lit('"k"'), F.lit('"device_name"')).alias("check_data"),
    )
    return punches.punch_detail(rows, m.archive(t), old, "2024-03-20 00:00:00", kind="click")


# --- C19, C20 -----------------------------------------------------------------

_RESPONSE_LINES = """ WITH l AS (SELECT *, max(l_returnflag) OVER (PARTITION BY l_orderkey) AS worst FROM lineitem)"""


@query(
    "response_audit",
    _RESPONSE_LINES
    + """ SELECT l_orderkey AS id, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS is_success,
    CASE WHEN l_linestatus = 'F' THEN 'm' || l_suppkey END AS error_msg, 'P' || l_partkey AS entity_code
    FROM l WHERE worst <> 'N'""",
)
def response_audit(t):
    entries, _ = audit.response_audit(loads.responses(t))
    return entries.drop("status_code")


@query(
    "response_failures",
    _RESPONSE_LINES + " SELECT DISTINCT l_orderkey AS id, 500 AS status_code FROM l WHERE worst = 'N'",
)
def response_failures(t):
    return audit.response_audit(loads.responses(t))[1].select("id", "status_code")


@query(
    "quality_report",
    ctes("depart", "manager")
    + """, active AS (SELECT * FROM manager WHERE s_activate_flag = 1)
    SELECT 'email' AS rule, s_email AS key, count(*) AS n FROM active WHERE s_email IS NOT NULL GROUP BY s_email
      HAVING count(*) > 1
    UNION ALL SELECT 'phone', s_cellphone, count(*) FROM active GROUP BY s_cellphone HAVING count(*) > 1
    UNION ALL SELECT 'department', dd_depart_ids, count(*) FROM active WHERE dd_depart_ids IS NOT NULL
      GROUP BY dd_depart_ids HAVING count(*) > 1
    UNION ALL SELECT 'deleted parent', CAST(c.dd_id AS VARCHAR), 1 FROM depart c JOIN depart p
      ON p.dd_id = c.dd_parent_id WHERE c.dd_deleted_time IS NULL AND p.dd_deleted_time IS NOT NULL""",
)
def quality_report(t):
    active = m.manager(t).filter(F.col("s_activate_flag") == 1)
    unique = {"email": ["s_email"], "phone": ["s_cellphone"], "department": ["dd_depart_ids"]}
    return audit.quality_report(active, unique, m.depart(t), "dd_id", "dd_parent_id", "dd_deleted_time")


# --- S1, S2 -------------------------------------------------------------------

_POLL = """WITH old AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  max(ts) AS ts FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'view' GROUP BY user_id)"""


def _poll_columns(df):
    return df.select("user_id", "event_id", "event_type", "ts")


@query(
    "poll_changes",
    _POLL
    + """, new AS (SELECT user_id, event_id, event_type, ts FROM events WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 6 DAY
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, coalesce(n.event_id, o.event_id) AS event_id, coalesce(n.event_type, o.event_type) AS event_type,
      coalesce(n.ts, o.ts) AS ts FROM old o FULL JOIN new n USING (user_id)""",
)
def poll_changes(t):
    early = t.events.filter((F.col("ts") < m.ntz("2024-01-20")) & (F.col("event_type") != "view"))
    old = early.groupBy("user_id").agg(
        F.max("event_id").alias("event_id"),
        F.max_by("event_type", "event_id").alias("event_type"),
        F.max("ts").alias("ts"),
    )
    return poll(_poll_columns(t.events), old, ["user_id"], "ts", "event_id", m.EVENTS_AS_OF, "6 days")


@query(
    "poll_changes_stream",
    """SELECT user_id, event_id, event_type, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def poll_changes_stream(t):
    """The whole change table read as a stream of its files, which the glob lets be one or many."""
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/poll-{uuid.uuid4().hex}"
    changes = _poll_columns(t.events)
    poll_stream(
        t.spark, f"{t.folder}/events.parquet*", TABLES["events"], f"{root}/target", changes.schema, f"{root}/progress",
        ["user_id"], "ts", "event_id", files_per_trigger=1000,
    )
    return read_versions(t.spark, f"{root}/target", changes.schema)
