"""Joins (J1-J22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.functions import bracket_ids, json_field, localized
from millrace.operators import keys, lookup, nesting


@query(
    "inner_equi_join",
    """SELECT l_orderkey, l_linenumber, c_name, p_name, s_name,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS qty
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE o_orderstatus = 'F' AND l_returnflag = 'A'""",
)
def inner_equi_join(t):
    lines = t.lineitem.filter(F.col("l_returnflag") == "A")
    orders = t.orders.filter(F.col("o_orderstatus") == "F")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "c_name", "p_name", "s_name",
            m.money("l_quantity").cast("string").alias("qty"),
        )
    )


@query(
    "left_lookup_join",
    """SELECT o_orderkey, c_name, n_name, r_name FROM
    (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)
    LEFT JOIN customer ON c_custkey = k LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def left_lookup_join(t):
    """A third of the facts has no key; those rows are spread over tasks."""
    fact = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k")
    )
    fact = lookup.lookup(fact, t.customer, {"k": "c_custkey"}, {"c_name": "c_name", "nk": "c_nationkey"})
    fact = lookup.lookup(fact, t.nation, {"nk": "n_nationkey"}, {"n_name": "n_name", "rk": "n_regionkey"})
    fact = lookup.lookup(fact, t.region, {"rk": "r_regionkey"}, {"r_name": "r_name"})
    return fact.select("o_orderkey", "c_name", "n_name", "r_name")


_SALTED = """SELECT l_orderkey, l_linenumber, l_partkey, s_name, s_nationkey FROM lineitem
LEFT JOIN supplier ON s_suppkey = l_suppkey"""


@query("left_lookup_salted", _SALTED)
def left_lookup_salted(t):
    """The same lookup with every key spread over eight tasks."""
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wanted = {"s_name": "s_name", "s_nationkey": "s_nationkey"}
    return lookup.lookup(fact, t.supplier, {"l_suppkey": "s_suppkey"}, wanted, salt=8).drop("l_suppkey")


_ROLES = """SELECT o_orderkey, cn.n_name AS customer_nation, sn.n_name AS status_nation, pn.n_name AS date_nation
FROM (SELECT o_orderkey, o_custkey % 25 AS a, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 30 END AS b,
      month(o_orderdate) AS c FROM orders)
LEFT JOIN nation cn ON cn.n_nationkey = a LEFT JOIN nation sn ON sn.n_nationkey = b
LEFT JOIN nation pn ON pn.n_nationkey = c"""

_ROLE_COLUMNS = {
    "a": {"customer_nation": "n_name"},
    "b": {"status_nation": "n_name"},
    "c": {"date_nation": "n_name"},
}


def _role_fact(t):
    return t.orders.select(
        "o_orderkey",
        (F.col("o_custkey") % 25).alias("a"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey") % 30).alias("b"),
        F.month("o_orderdate").alias("c"),
    )


@query("role_playing_lookup", _ROLES)
def role_playing_lookup(t):
    return lookup.role_lookup(_role_fact(t), t.nation, "n_nationkey", _ROLE_COLUMNS).drop("a", "b", "c")


@query("role_playing_lookup_folded", _ROLES)
def role_playing_lookup_folded(t):
    folded = lookup.role_lookup_folded(_role_fact(t), t.nation, "n_nationkey", "o_orderkey", _ROLE_COLUMNS)
    return folded.drop("a", "b", "c")


@query(
    "dictionary_code_lookup",
    ctes("dict_head", "dict_detail")
    + """ SELECT p_partkey, b.id AS brand_id, s.id AS size_id, k.id AS type_id FROM part
    LEFT JOIN (SELECT d.* FROM dict_detail d JOIN dict_head h ON h.id = d.dict_id WHERE h.code = 'brand') b
      ON b.code = p_brand
    LEFT JOIN (SELECT d.* FROM dict_detail d JOIN dict_head h ON h.id = d.dict_id WHERE h.code = 'size') s
      ON s.code = CAST(nullif(p_size, 7) AS VARCHAR)
    LEFT JOIN (SELECT d.* FROM dict_detail d JOIN dict_head h ON h.id = d.dict_id WHERE h.code = 'type') k
      ON k.code = p_type""",
)
def dictionary_code_lookup(t):
    entries = lookup.dictionary(*m.dict_tables(t))
    fact = t.part.select(
        "p_partkey", "p_brand", F.nullif(F.col("p_size"), F.lit(7)).cast("string").alias("size"), "p_type"
    )
    fields = {"brand_id": ("p_brand", "brand"), "size_id": ("size", "size"), "type_id": ("p_type", "type")}
    return lookup.dictionary_lookup(fact, entries, fields).drop("p_brand", "size", "p_type")


@query(
    "compound_code_lookup",
    """WITH colour AS (SELECT p_type AS yarn, p_brand AS code, min(p_partkey) AS id FROM part
      WHERE p_size < 25 GROUP BY ALL)
    SELECT p_partkey, id AS colour_id FROM part LEFT JOIN colour ON code = p_brand AND yarn = p_type""",
)
def compound_code_lookup(t):
    colour = t.part.filter(F.col("p_size") < 25).groupBy("p_type", "p_brand").agg(
        F.min("p_partkey").alias("id")
    )
    fact = t.part.select("p_partkey", "p_brand", "p_type")
    found = lookup.lookup(fact, colour, {"p_brand": "p_brand", "p_type": "p_type"}, {"colour_id": "id"})
    return found.select("p_partkey", "colour_id")


@query(
    "json_name_join",
    """WITH named AS (SELECT n_nationkey, '{"zh_CN":"' || n_name || ' ","en_US":"' || n_name || ' "}' AS name
      FROM nation)
    SELECT s_suppkey, n_nationkey FROM supplier JOIN named
    ON trim(name ->> '$.zh_CN') = 'NATION_' || s_nationkey""",
)
def json_name_join(t):
    padded = F.concat("n_name", F.lit(" "))
    named = t.nation.select("n_nationkey", localized(zh_CN=padded, en_US=padded).alias("name"))
    side = named.select("n_nationkey", F.trim(json_field("name", "zh_CN")).alias("key"))
    fact = t.supplier.select("s_suppkey", F.concat(F.lit("NATION_"), "s_nationkey").alias("key"))
    return fact.join(side, "key").select("s_suppkey", "n_nationkey")


@query(
    "multi_column_natural_join",
    ctes("material_price")
    + """, base AS (SELECT s_material_name AS name, s_weight AS weight, s_fabric_composition AS composition,
      min(s_material_price_id) AS id FROM material_price GROUP BY ALL)
    SELECT a.s_material_price_id, b.id AS material_id FROM material_price a JOIN base b
    ON b.name = a.s_material_name AND b.weight = a.s_weight AND b.composition = a.s_fabric_composition""",
)
def multi_column_natural_join(t):
    price = m.material_price(t)
    on = ["s_material_name", "s_weight", "s_fabric_composition"]
    base = price.groupBy(*on).agg(F.min("s_material_price_id").alias("material_id"))
    return price.select("s_material_price_id", *on).join(base, on).select("s_material_price_id", "material_id")


@query(
    "case_insensitive_join",
    ctes("material_price")
    + """, unit AS (SELECT lower(substr(p_brand, 1, 1)) || lower(substr(p_type, 2, 2)) AS code,
      min(p_partkey) AS id FROM part WHERE p_type <> 'LARGE' GROUP BY ALL)
    SELECT s_material_price_id, unit.id AS unit_id FROM material_price LEFT JOIN unit
    ON unit.code = lower(s_unit)""",
)
def case_insensitive_join(t):
    code = F.concat(F.lower(F.substring("p_brand", 1, 1)), F.lower(F.substring("p_type", 2, 2)))
    unit = t.part.filter(F.col("p_type") != "LARGE").groupBy(code.alias("code")).agg(
        F.min("p_partkey").alias("id")
    )
    fact = m.material_price(t).select("s_material_price_id", F.lower("s_unit").alias("u"))
    return lookup.lookup(fact, unit, {"u": "code"}, {"unit_id": "id"}).drop("u")


@query(
    "self_join_parent",
    ctes("depart")
    + """ SELECT c.dd_id, p.dd_name AS parent_name FROM depart c LEFT JOIN depart p
    ON p.dd_id = c.dd_parent_id""",
)
def self_join_parent(t):
    d = m.depart(t)
    child = d.select("dd_id", "dd_parent_id")
    joined = lookup.lookup(child, d, {"dd_parent_id": "dd_id"}, {"parent_name": "dd_name"})
    return joined.select("dd_id", "parent_name")


@query(
    "anti_join_exists",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS
    (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49 AND l_returnflag = 'R')""",
)
def anti_join_exists(t):
    lines = t.lineitem.filter((F.col("l_quantity") > 49) & (F.col("l_returnflag") == "R"))
    return lookup.missing_from(t.part.select("p_partkey", "p_name"), lines, {"p_partkey": "l_partkey"})


@query(
    "anti_join_left_null",
    """SELECT c_custkey, c_mktsegment FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' WHERE o_orderkey IS NULL""",
)
def anti_join_left_null(t):
    active = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    users = t.customer.select("c_custkey", "c_mktsegment")
    return lookup.missing_from(users, active, {"c_custkey": "o_custkey"})


_BUSY = """SELECT c_custkey, code FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS code FROM customer)
WHERE code NOT IN (SELECT {} FROM supplier WHERE s_acctbal > 9900)"""


def _coded(t):
    return t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("code"))


@query("not_in_list", _BUSY.format("s_nationkey"))
def not_in_list(t):
    listed = t.supplier.filter(F.col("s_acctbal") > 9900)
    return lookup.anti_null_aware(_coded(t), "code", listed, "s_nationkey")


@query(
    "not_in_null_aware",
    """SELECT count(*) AS n FROM (SELECT nullif(c_nationkey, 3) AS code FROM customer)
    WHERE code NOT IN (SELECT nullif(s_nationkey, s_nationkey) FROM supplier)""",
)
def not_in_null_aware(t):
    """A null in the list removes every row."""
    listed = t.supplier.select(F.nullif(F.col("s_nationkey"), F.col("s_nationkey")).alias("k"))
    return lookup.anti_null_aware(_coded(t), "code", listed, "k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "semi_join",
    """SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS
    (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.09)""",
)
def semi_join(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    return lookup.present_in(orders, t.lineitem.filter(F.col("l_discount") > 0.09), {"o_orderkey": "l_orderkey"})


_LATEST = """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders a WHERE NOT EXISTS
(SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority
 AND b.o_orderkey > a.o_orderkey)"""


def _order_keys(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")


@query("theta_anti_self_join", _LATEST)
def theta_anti_self_join(t):
    return keys.latest_per_key(_order_keys(t), ["o_custkey", "o_orderpriority"], "o_orderkey")


@query(
    "latest_per_key_nulls",
    """WITH a AS (SELECT p_partkey, p_name, p_brand, nullif(p_type, 'PROMO') AS composition FROM part)
    SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.p_name = a.p_name AND b.p_brand = a.p_brand
    AND b.composition = a.composition AND b.p_partkey > a.p_partkey)""",
)
def latest_per_key_nulls(t):
    """Rows with a null key part all stay."""
    parts = t.part.select(
        "p_partkey", "p_name", "p_brand", F.nullif(F.col("p_type"), F.lit("PROMO")).alias("composition")
    )
    return keys.latest_per_key(parts, ["p_name", "p_brand", "composition"], "p_partkey")


@query(
    "cross_join",
    "SELECT s_suppkey, r_name FROM supplier CROSS JOIN region",
)
def cross_join(t):
    """Every supplier with every region; the constant side is read once as an array."""
    return lookup.fan_out(t.supplier.select("s_suppkey"), t.region, "r_name", "r_name")


@query(
    "scalar_subquery",
    """SELECT s_suppkey, (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AS company_id,
    (SELECT max(o_orderdate) FROM orders) AS as_of FROM supplier""",
)
def scalar_subquery(t):
    asia = t.region.filter(F.col("r_name") == "ASIA")
    last = t.orders.agg(F.max("o_orderdate").alias("d"))
    return t.supplier.select(
        "s_suppkey",
        lookup.scalar(asia, "r_regionkey").alias("company_id"),
        lookup.scalar(last, "d").alias("as_of"),
    )


@query(
    "correlated_aggregate_subquery",
    """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS n_closed,
    (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS last_order FROM customer""",
)
def correlated_aggregate_subquery(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_closed"),
        F.max("o_orderdate").alias("last_order"),
    )
    columns = {"n_closed": "n_closed", "last_order": "last_order"}
    found = lookup.lookup(t.customer.select("c_custkey"), per, {"c_custkey": "o_custkey"}, columns)
    return found.withColumn("n_closed", F.coalesce("n_closed", F.lit(0)))


@query(
    "derived_table_join",
    """SELECT o_orderkey, o_custkey, g.plan_date FROM orders LEFT JOIN
    (SELECT l_orderkey, min(l_shipdate) AS plan_date FROM lineitem GROUP BY l_orderkey) g
    ON g.l_orderkey = o_orderkey""",
)
def derived_table_join(t):
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("plan_date"))
    orders = t.orders.select("o_orderkey", "o_custkey")
    return lookup.lookup(orders, first, {"o_orderkey": "l_orderkey"}, {"plan_date": "plan_date"})


@query(
    "coalesced_default_join",
    """WITH o AS (SELECT p_brand, p_type, max(p_size) AS value FROM part WHERE p_retailprice > 950 AND p_size > 30
      GROUP BY ALL)
    SELECT p_partkey, coalesce(o.value, p_size) AS spec FROM part LEFT JOIN o USING (p_brand, p_type)""",
)
def coalesced_default_join(t):
    override = (
        t.part.filter((F.col("p_retailprice") > 950) & (F.col("p_size") > 30))
        .groupBy("p_brand", "p_type")
        .agg(F.max("p_size").alias("value"))
    )
    common = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    merged = lookup.override_join(common, override, ["p_brand", "p_type"], "value", "p_size", "spec")
    return merged.select("p_partkey", "spec")


@query(
    "partial_key_join",
    """WITH override AS (SELECT l_orderkey AS parent_id, l_linenumber AS color_id, min(l_suppkey) AS value
      FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
    joined AS (SELECT l_orderkey, coalesce(a.color_id, l_linenumber) AS color_id, coalesce(a.value, l_suppkey) AS value
      FROM lineitem LEFT JOIN override a ON a.parent_id = l_orderkey WHERE l_returnflag = 'N')
    SELECT *, count(*) AS copies FROM joined GROUP BY ALL""",
)
def partial_key_join(t):
    """Overrides joined by parent only; repeated rows are counted, not produced."""
    override = (
        t.lineitem.filter(F.col("l_returnflag") == "A")
        .groupBy("l_orderkey", F.col("l_linenumber").alias("color_id"))
        .agg(F.min("l_suppkey").alias("value"))
    )
    lines = t.lineitem.filter(F.col("l_returnflag") == "N").select(
        "l_orderkey", F.col("l_linenumber").alias("color_id"), F.col("l_suppkey").alias("value")
    )
    return lookup.override_by_parent(lines, override, ["l_orderkey"], ["color_id", "value"])


_PLACES = (
    ctes("place_text")
    + """, ids AS (SELECT *, string_split(trim(s_country_id, '[]'), ',') AS parts FROM place_text),
  split AS (SELECT *, TRY_CAST(nullif(parts[1], '') AS BIGINT) AS p1, TRY_CAST(nullif(parts[2], '') AS BIGINT) AS p2,
    TRY_CAST(nullif(parts[3], '') AS BIGINT) AS p3, TRY_CAST(nullif(parts[4], '') AS BIGINT) AS p4 FROM ids)
  SELECT s_supplier_id, r_name AS country, a.n_name AS state, b.n_name AS city,
    coalesce(r_name, '') || coalesce(a.n_name, '') || coalesce(b.n_name, '') || coalesce(c.n_name, '') AS description
  FROM split LEFT JOIN region ON r_regionkey = p1 LEFT JOIN nation a ON a.n_nationkey = p2
  LEFT JOIN nation b ON b.n_nationkey = p3 LEFT JOIN nation c ON c.n_nationkey = p4"""
)


@query("geo_code_resolution", _PLACES)
def geo_code_resolution(t):
    countries = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    areas = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    found = lookup.resolve_places(
        m.place_text(t), "s_country_id", countries, areas, bracket_ids("s_country_id", 4)
    )
    names = [F.coalesce(f"place_{i}", F.lit("")) for i in range(1, 5)]
    return found.select(
        "s_supplier_id",
        F.col("place_1").alias("country"),
        F.col("place_2").alias("state"),
        F.col("place_3").alias("city"),
        F.concat(*names).alias("description"),
    )


@query(
    "lookup_limit_one",
    """WITH wanted AS (SELECT l_orderkey, l_partkey, list(DISTINCT l_linenumber) AS specs FROM lineitem GROUP BY ALL),
    offers AS (SELECT l_partkey AS k, l_linenumber AS spec, min(CASE WHEN l_linestatus = 'F' AND l_linenumber <> 2
      THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT l_orderkey, l_partkey, CAST(first(price ORDER BY price, spec) AS VARCHAR) AS price,
      first(spec ORDER BY price, spec) AS spec
    FROM wanted JOIN offers ON k = l_partkey AND list_contains(specs, spec) GROUP BY l_orderkey, l_partkey""",
)
def lookup_limit_one(t):
    """Cheapest offer of a part in any of the specs the order lists; one without a price only if there is no other."""
    priced = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") != 2)
    offers = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy("l_partkey", F.col("l_linenumber").alias("spec"))
        .agg(F.min(F.when(priced, m.money("l_extendedprice"))).alias("price"))
    )
    # Listed specs as rows: an equality join instead of a test per pair.
    wanted = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("spec")).distinct()
    hits = wanted.join(offers, ["l_partkey", "spec"])
    best = hits.groupBy("l_orderkey", "l_partkey").agg(
        F.min(F.struct(F.col("price").isNull(), "price", "spec")).alias("b")
    )
    return best.select(
        "l_orderkey", "l_partkey", F.col("b.price").cast("string").alias("price"), F.col("b.spec").alias("spec")
    )


@query(
    "first_match",
    """SELECT o_orderkey, o_custkey, first(s_suppkey ORDER BY s_acctbal DESC, s_suppkey) AS supplier_id
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_nationkey = c_nationkey
    GROUP BY o_orderkey, o_custkey""",
)
def first_match(t):
    fact = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    found = lookup.first_match(
        fact, t.supplier, {"c_nationkey": "s_nationkey"}, [F.desc("s_acctbal"), F.asc("s_suppkey")],
        {"supplier_id": "s_suppkey"},
    )
    return found.drop("c_nationkey")
