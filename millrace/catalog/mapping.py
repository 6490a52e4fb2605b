"""The driver's tables seen as the tables of the source and target systems.

Every view exists twice: as a DataFrame and as a SQL common table expression of the
same name and columns, so that the oracle builds its input by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed instant the look-back windows of the queries end at.
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-30 00:00:00"

VIEWS: dict[str, str] = {}


def ctes(*names: str) -> str:
    """``WITH a AS (..), b AS (..)`` for the named views."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def days_after(start: str, days: str) -> Column:
    return F.expr(f"timestamp_ntz'{start}' + make_dt_interval({days})")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# --- organisation -------------------------------------------------------------

VIEWS["depart"] = """
SELECT c_custkey AS dd_id, c_name AS dd_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'D' || c_custkey END AS code,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'En ' || c_name END AS s_en_name,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Jp ' || c_name END AS s_jp_name,
       CASE WHEN c_custkey > 0 THEN c_custkey // 8 END AS dd_parent_id,
       CASE WHEN c_nationkey > 4 THEN TIMESTAMP '2020-01-01' + to_days(c_nationkey) END AS dd_created_time,
       CASE WHEN c_nationkey > 14 THEN TIMESTAMP '2021-01-01' + to_days(c_nationkey) END AS dd_updated_time,
       CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-01' END AS dd_deleted_time,
       c_nationkey AS sort
FROM customer"""


def depart(t) -> DataFrame:
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    return t.customer.select(
        F.col("c_custkey").alias("dd_id"),
        name.alias("dd_name"),
        F.when(segment == "BUILDING", F.concat(F.lit("D"), "c_custkey")).alias("code"),
        F.when(segment == "MACHINERY", F.concat(F.lit("En "), name)).alias("s_en_name"),
        F.when(segment == "FURNITURE", F.concat(F.lit("Jp "), name)).alias("s_jp_name"),
        F.when(F.col("c_custkey") > 0, F.expr("c_custkey div 8")).alias("dd_parent_id"),
        F.when(F.col("c_nationkey") > 4, days_after("2020-01-01", "c_nationkey")).alias("dd_created_time"),
        F.when(F.col("c_nationkey") > 14, days_after("2021-01-01", "c_nationkey")).alias("dd_updated_time"),
        F.when(F.col("c_acctbal") < 0, ntz("2024-01-01")).alias("dd_deleted_time"),
        F.col("c_nationkey").alias("sort"),
    )


VIEWS["manager"] = """
SELECT c_custkey AS s_manager_id, c_name AS s_account,
       '138' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS s_cellphone,
       CASE WHEN c_nationkey > 2 THEN 'n' || c_nationkey || '@x.test' END AS s_email,
       CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS s_activate_flag,
       CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN '1,2' WHEN 'FURNITURE' THEN NULL
            ELSE CAST(c_nationkey AS VARCHAR) END AS dd_depart_ids,
       CASE WHEN c_nationkey > 4 THEN TIMESTAMP '2020-01-01' + to_days(c_nationkey) END AS s_created_time,
       CASE WHEN c_nationkey > 14 THEN TIMESTAMP '2021-01-01' + to_days(c_nationkey) END AS s_updated_time,
       CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '2024-01-01' END AS s_deleted_time,
       CASE WHEN c_custkey > 2 THEN c_custkey END AS s_talent_id
FROM customer"""


def manager(t) -> DataFrame:
    depart_ids = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("1,2"))
        .when(F.col("c_mktsegment") != "FURNITURE", F.col("c_nationkey").cast("string"))
    )
    return t.customer.select(
        F.col("c_custkey").alias("s_manager_id"),
        F.col("c_name").alias("s_account"),
        F.concat(F.lit("138"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("s_cellphone"),
        F.when(
            F.col("c_nationkey") > 2, F.concat(F.lit("n"), "c_nationkey", F.lit("@x.test"))
        ).alias("s_email"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("s_activate_flag"),
        depart_ids.alias("dd_depart_ids"),
        F.when(F.col("c_nationkey") > 4, days_after("2020-01-01", "c_nationkey")).alias("s_created_time"),
        F.when(F.col("c_nationkey") > 14, days_after("2021-01-01", "c_nationkey")).alias("s_updated_time"),
        F.when(F.col("c_acctbal") > 9000, ntz("2024-01-01")).alias("s_deleted_time"),
        F.when(F.col("c_custkey") > 2, F.col("c_custkey")).alias("s_talent_id"),
    )


VIEWS["archive"] = """
SELECT o_custkey AS s_talent_archives_id, 'Name ' || o_custkey AS s_name,
       CASE WHEN count(*) > 5 THEN 'E.' || o_custkey END AS s_employee_num,
       CASE WHEN max(o_orderstatus) = min(o_orderstatus) THEN '' ELSE 'p' || o_custkey || '@x.test' END AS s_email,
       CASE WHEN count(*) > 12 THEN 1 ELSE 0 END AS is_lead,
       count(*) AS s_talent_position_id,
       min(o_orderdate) AS gmt_create, max(o_orderdate) AS gmt_modified,
       count(*) < 7 AS is_delete
FROM orders GROUP BY o_custkey"""


def archive(t) -> DataFrame:
    n = F.count(F.lit(1))
    key = F.col("o_custkey")
    return (
        t.orders.groupBy("o_custkey")
        .agg(
            n.alias("n"),
            (F.max("o_orderstatus") == F.min("o_orderstatus")).alias("same"),
            F.min("o_orderdate").alias("gmt_create"),
            F.max("o_orderdate").alias("gmt_modified"),
        )
        .select(
            key.alias("s_talent_archives_id"),
            F.concat(F.lit("Name "), key).alias("s_name"),
            F.when(F.col("n") > 5, F.concat(F.lit("E."), key)).alias("s_employee_num"),
            F.when(F.col("same"), F.lit("")).otherwise(F.concat(F.lit("p"), key, F.lit("@x.test"))).alias("s_email"),
            F.when(F.col("n") > 12, 1).otherwise(0).alias("is_lead"),
            F.col("n").alias("s_talent_position_id"),
            "gmt_create",
            "gmt_modified",
            (F.col("n") < 7).alias("is_delete"),
        )
    )


VIEWS["position"] = """
SELECT CAST(p_size AS BIGINT) AS s_talent_position_id, 'Position ' || p_size AS s_position,
       CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN '' ELSE min(p_brand) END AS s_en_position,
       CASE WHEN p_size > 10 THEN p_size END AS sort,
       CASE WHEN p_size = 13 THEN 1 ELSE 0 END AS is_delete,
       CASE WHEN p_size > 5 THEN TIMESTAMP '2020-01-01' + to_days(p_size) END AS gmt_create,
       CASE WHEN p_size > 25 THEN TIMESTAMP '2021-01-01' + to_days(p_size) END AS gmt_modified
FROM part GROUP BY p_size"""


def position(t) -> DataFrame:
    size = F.col("p_size")
    return (
        t.part.groupBy("p_size")
        .agg(F.min("p_brand").alias("brand"))
        .select(
            size.cast("long").alias("s_talent_position_id"),
            F.concat(F.lit("Position "), size).alias("s_position"),
            F.when(size > 40, None).when(size > 30, F.lit("")).otherwise(F.col("brand")).alias("s_en_position"),
            F.when(size > 10, size).alias("sort"),
            F.when(size == 13, 1).otherwise(0).alias("is_delete"),
            F.when(size > 5, days_after("2020-01-01", "p_size")).alias("gmt_create"),
            F.when(size > 25, days_after("2021-01-01", "p_size")).alias("gmt_modified"),
        )
    )


# --- two states of one entity, for merges -------------------------------------

_STATE = """
SELECT o_custkey AS origin_id, max(o_orderpriority) AS title, max(o_orderstatus) AS code,
       count(*) AS sort, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       min(o_orderdate) AS created_at, max(o_orderdate) AS updated_at
FROM orders WHERE o_orderdate {} GROUP BY o_custkey"""

VIEWS["tgt"] = _STATE.format("< TIMESTAMP '1996-07-01'")
VIEWS["src"] = _STATE.format(">= TIMESTAMP '2000-03-01'")


def _state(t, when: Column) -> DataFrame:
    return (
        t.orders.filter(when)
        .groupBy(F.col("o_custkey").alias("origin_id"))
        .agg(
            F.max("o_orderpriority").alias("title"),
            F.max("o_orderstatus").alias("code"),
            F.count(F.lit(1)).alias("sort"),
            F.sum(money("o_totalprice")).cast("double").alias("amount"),
            F.min("o_orderdate").alias("created_at"),
            F.max("o_orderdate").alias("updated_at"),
        )
    )


def tgt(t) -> DataFrame:
    """The target as an early load left it."""
    return _state(t, F.col("o_orderdate") < ntz("1996-07-01"))


def src(t) -> DataFrame:
    """The source as it is now: some keys are new, some have gone."""
    return _state(t, F.col("o_orderdate") >= ntz("2000-03-01"))


VIEWS["tgt_flagged"] = """
SELECT origin_id, origin_id + 500 AS id, title, code, code <> 'O' AS active, CAST(NULL AS TIMESTAMP) AS write_date
FROM tgt
UNION ALL
SELECT NULL, n_nationkey, n_name, NULL, n_regionkey > 1, CAST(NULL AS TIMESTAMP) FROM nation"""


def tgt_flagged(t) -> DataFrame:
    """Target with ids and an active flag; nations play locally created rows."""
    none = F.lit(None)
    loaded = tgt(t).select(
        "origin_id",
        (F.col("origin_id") + 500).alias("id"),
        "title",
        "code",
        (F.col("code") != "O").alias("active"),
        none.cast("timestamp_ntz").alias("write_date"),
    )
    local = t.nation.select(
        none.cast("long").alias("origin_id"),
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("title"),
        none.cast("string").alias("code"),
        (F.col("n_regionkey") > 1).alias("active"),
        none.cast("timestamp_ntz").alias("write_date"),
    )
    return loaded.unionByName(local)


# --- products and materials ---------------------------------------------------

VIEWS["material_price"] = """
SELECT p_partkey AS s_material_price_id, p_name AS s_material_name, p_size AS s_weight,
       CASE WHEN p_type <> 'PROMO' THEN p_type END AS s_fabric_composition,
       p_brand AS s_color_name, upper(substr(p_brand, 1, 1)) || substr(p_type, 2, 2) AS s_unit,
       CASE WHEN p_retailprice < 990 THEN 'S' || p_size END AS s_supplier_name,
       CASE WHEN p_size > 45 THEN '-' || p_partkey ELSE 'M' || p_partkey END AS s_new_material_num,
       CASE WHEN p_size <> 7 THEN p_size * 10 END AS s_width,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS s_development_price,
       CASE WHEN p_size > 3 THEN 'r' || p_size END AS s_remark, TIMESTAMP '2024-01-01' + INTERVAL (p_size) DAY AS gmt_create,
       CASE WHEN p_size < 30 THEN TIMESTAMP '2024-02-01' + INTERVAL (p_size) DAY END AS gmt_modified
FROM part"""


def material_price(t) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("s_material_price_id"),
        F.col("p_name").alias("s_material_name"),
        F.col("p_size").alias("s_weight"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("s_fabric_composition"),
        F.col("p_brand").alias("s_color_name"),
        F.concat(F.upper(F.substring("p_brand", 1, 1)), F.substring("p_type", 2, 2)).alias("s_unit"),
        F.when(F.col("p_retailprice") < 990, F.concat(F.lit("S"), "p_size")).alias("s_supplier_name"),
        F.when(F.col("p_size") > 45, F.concat(F.lit("-"), "p_partkey"))
        .otherwise(F.concat(F.lit("M"), "p_partkey"))
        .alias("s_new_material_num"),
        F.when(F.col("p_size") != 7, F.col("p_size") * 10).alias("s_width"),
        money("p_retailprice").cast("string").alias("s_development_price"),
        F.when(F.col("p_size") > 3, F.concat(F.lit("r"), "p_size")).alias("s_remark"),
        (ntz("2024-01-01") + F.make_dt_interval(F.col("p_size"))).alias("gmt_create"),
        F.when(F.col("p_size") < 30, ntz("2024-02-01") + F.make_dt_interval(F.col("p_size"))).alias("gmt_modified"),
    )


VIEWS["place_text"] = """
SELECT s_suppkey AS s_supplier_id, s_name AS s_supplier_name,
       CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey = 7 THEN '[]'
            WHEN s_nationkey > 20 THEN '[' || n_regionkey || ']'
            ELSE '[' || n_regionkey || ',' || s_nationkey || ',' || (s_nationkey // 2) || ']' END AS s_country_id,
       CASE WHEN s_nationkey <> 3 THEN 'm' || s_suppkey || '@x.test' END AS s_email,
       CASE WHEN s_acctbal > 9500 THEN 1 ELSE 0 END AS is_delete
FROM supplier JOIN nation ON n_nationkey = s_nationkey"""


def place_text(t) -> DataFrame:
    """Suppliers with a text field of place ids."""
    joined = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    full = F.concat(
        F.lit("["), "n_regionkey", F.lit(","), "s_nationkey", F.lit(","), F.expr("s_nationkey div 2"), F.lit("]")
    )
    return joined.select(
        F.col("s_suppkey").alias("s_supplier_id"),
        F.col("s_name").alias("s_supplier_name"),
        F.when(F.col("s_acctbal") < 0, None)
        .when(F.col("s_nationkey") == 7, F.lit("[]"))
        .when(F.col("s_nationkey") > 20, F.concat(F.lit("["), "n_regionkey", F.lit("]")))
        .otherwise(full)
        .alias("s_country_id"),
        F.when(F.col("s_nationkey") != 3, F.concat(F.lit("m"), "s_suppkey", F.lit("@x.test"))).alias("s_email"),
        F.when(F.col("s_acctbal") > 9500, 1).otherwise(0).alias("is_delete"),
    )


VIEWS["dict_head"] = """
SELECT row_number() OVER (ORDER BY code) AS id, code FROM (VALUES ('brand'), ('size'), ('type')) v(code)"""

VIEWS["dict_detail"] = """
SELECT 1 AS dict_id, CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS code FROM part GROUP BY p_brand
UNION ALL SELECT 2, CAST(1000 + p_size AS BIGINT), CAST(p_size AS VARCHAR) FROM part GROUP BY p_size
UNION ALL SELECT 3, CAST(2000 + min(p_size) * 100 + length(p_type) * 7 + ascii(p_type) AS BIGINT), p_type
FROM part GROUP BY p_type"""


def dict_tables(t) -> tuple[DataFrame, DataFrame]:
    """Dictionary headers and details taken from the part attributes."""
    from millrace.operators.numbering import number_rows

    attributes = t.part.select(F.explode(F.array(F.lit("brand"), F.lit("size"), F.lit("type"))).alias("code"))
    head = number_rows(attributes.distinct(), ["code"], "id")

    def detail(number: int, code: Column, group: str, id_: Column) -> DataFrame:
        grouped = t.part.groupBy(group).agg(F.min("p_size").alias("least"))
        return grouped.select(F.lit(number).alias("dict_id"), id_.cast("long").alias("id"), code.alias("code"))

    brand = detail(1, F.col("p_brand"), "p_brand", F.substring("p_brand", 7, 10))
    size = detail(2, F.col("p_size").cast("string"), "p_size", F.col("p_size") + 1000)
    kind = detail(
        3,
        F.col("p_type"),
        "p_type",
        F.lit(2000) + F.col("least") * 100 + F.length("p_type") * 7 + F.ascii("p_type"),
    )
    return head, brand.unionByName(size).unionByName(kind)
