"""Aggregations, windows, numbering and ordering."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.functions import document
from millrace.operators import keys, nesting, numbering
from millrace.session import ensure_checkpoint_dir
from millrace.sources import counts

#: Part a child falls in, as SQL over a window.
_PART = "CAST((row_number() OVER ({}) - 1) // " + str(nesting.MAX_ITEMS) + " + 1 AS BIGINT)"


@query(
    "duplicate_keys",
    """SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(t):
    return keys.duplicate_keys(t.part, ["p_name", "p_brand"])


@query(
    "unambiguous_keys",
    ctes("material_price")
    + """, d AS (SELECT DISTINCT s_material_name, s_fabric_composition, s_weight, s_unit FROM material_price
      WHERE s_supplier_name IS NOT NULL)
    SELECT s_material_name, s_fabric_composition, s_weight, min(s_unit) AS s_unit FROM d
    GROUP BY s_material_name, s_fabric_composition, s_weight HAVING count(*) = 1""",
)
def unambiguous_keys(t):
    price = m.material_price(t).filter(F.col("s_supplier_name").isNotNull())
    rows = price.select("s_material_name", "s_fabric_composition", "s_weight", "s_unit")
    return keys.unambiguous_rows(rows, ["s_material_name", "s_fabric_composition", "s_weight"])


def _followed(t, keys, values):
    """Counts of a table that came in one load and two batches of changes, each followed by the counts alone."""
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/counts-{uuid.uuid4().hex}"
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    early, late = part.filter("p_partkey % 3 <> 0"), part.filter("p_partkey % 3 = 0")
    passing = part.filter("p_partkey % 5 = 0")
    counts.update_counts(t.spark, root, keys, values, added=early.unionByName(passing))
    counts.update_counts(t.spark, root, keys, values, added=late.filter("p_size < 25"), removed=passing)
    counts.update_counts(t.spark, root, keys, values, added=late.filter("p_size >= 25"))
    return root


@query("duplicate_keys_followed", "SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys_followed(t):
    """Duplicates out of counts that follow the table."""
    return counts.duplicate_keys(t.spark, _followed(t, ["p_name", "p_brand"], []), ["p_name", "p_brand"])


@query(
    "unambiguous_keys_followed",
    "SELECT p_name, p_size, min(p_brand) AS p_brand FROM (SELECT DISTINCT p_name, p_size, p_brand FROM part) GROUP BY ALL HAVING count(*) = 1",
)
def unambiguous_keys_followed(t):
    keys = ["p_name", "p_size"]
    return counts.unambiguous_rows(t.spark, _followed(t, keys, ["p_brand"]), keys)


@query(
    "singleton_groups",
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey IN
    (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) = 1)""",
)
def singleton_groups(t):
    single = keys.singleton_groups(t.lineitem, ["l_orderkey", "l_suppkey"]).select("l_orderkey").distinct()
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(single, "l_orderkey", "left_semi")


_TOP2 = """SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_extendedprice) AS rank FROM lineitem"""


def _top2(t):
    order = [F.desc("l_quantity"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice")
    return keys.top_n_per_group(lines, ["l_orderkey"], order, 2)


@query(
    "ordered_string_agg",
    f"""SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '' ORDER BY rank) AS codes
    FROM ({_TOP2}) WHERE rank <= 2 GROUP BY l_orderkey""",
)
def ordered_string_agg(t):
    codes = _top2(t).withColumn("code", F.col("l_partkey").cast("string"))
    return nesting.string_agg(codes, ["l_orderkey"], "code", [F.col("rank")], "codes")


@query(
    "distinct_list_agg",
    f"""SELECT l_orderkey, part, '[' || string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) || ']' AS supp_list
    FROM (SELECT *, {_PART.format('PARTITION BY l_orderkey ORDER BY k')} AS part
      FROM (SELECT DISTINCT l_orderkey, l_suppkey AS k FROM lineitem)) GROUP BY l_orderkey, part""",
)
def distinct_list_agg(t):
    return nesting.distinct_list(t.lineitem, ["l_orderkey"], "l_suppkey", "supp_list")


@query("min_by_group", "SELECT l_orderkey, min(l_shipdate) AS plan_date FROM lineitem GROUP BY l_orderkey")
def min_by_group(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("plan_date"))


@query(
    "kv_pivot",
    """SELECT user_id, max(CASE WHEN event_type = 'click' THEN props ->> '$.k' END) AS click_k,
    max(CASE WHEN event_type = 'view' THEN props ->> '$.k' END) AS view_k,
    max(CASE WHEN event_type = 'error' THEN props ->> '$.k' END) AS error_k FROM events GROUP BY user_id""",
)
def kv_pivot(t):
    pairs = t.events.select("user_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    names = {"click_k": "click", "view_k": "view", "error_k": "error"}
    return nesting.key_value_pivot(pairs, ["user_id"], "event_type", "k", names)


@query(
    "json_array_agg",
    """SELECT CAST((n - 1) // 500 AS BIGINT) AS chunk, CAST(to_json(list({'code': c_custkey, 'name': c_name,
    'headquarters': '', 'remark': remark} ORDER BY n)) AS VARCHAR) AS postdata
    FROM (SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS remark,
          row_number() OVER (ORDER BY c_custkey) AS n FROM customer) GROUP BY 1""",
)
def json_array_agg(t):
    remark = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    item = F.struct(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        F.lit("").alias("headquarters"),
        remark.alias("remark"),
    )
    return nesting.json_chunks(t.customer, ["c_custkey"], item, 500)


@query(
    "max_sequence",
    """SELECT c_mktsegment, max(CAST(substr(c_name, 10) AS BIGINT)) AS last_number FROM customer
    WHERE c_name LIKE 'Customer#%' GROUP BY c_mktsegment""",
)
def max_sequence(t):
    return t.customer.groupBy("c_mktsegment").agg(
        numbering.max_sequence("c_name", "Customer#").alias("last_number")
    )


@query(
    "ordered_distinct_list",
    f"""SELECT o_custkey, part, CAST(to_json(list({{'idx': n, 'item': o_orderpriority}} ORDER BY n)) AS VARCHAR) AS models
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS n,
      {_PART.format('PARTITION BY o_custkey ORDER BY o_orderpriority')} AS part
      FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)) GROUP BY o_custkey, part""",
)
def ordered_distinct_list(t):
    lists = nesting.ordered_values(t.orders, ["o_custkey"], "o_orderpriority", "v")
    return lists.select("o_custkey", "part", document(nesting.numbered_items("v")).alias("models"))


@query(
    "nested_collect",
    f"""SELECT l_orderkey, part, CAST(to_json(list({{'line': l_linenumber, 'part': l_partkey,
    'qty': CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)}}
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)) AS VARCHAR) AS lines
    FROM (SELECT *, {_PART.format('PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity')}
      AS part FROM lineitem) GROUP BY l_orderkey, part""",
)
def nested_collect(t):
    item = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        m.money("l_quantity").cast("string").alias("qty"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    nested = nesting.nested_collect(t.lineitem, ["l_orderkey"], order, item, "v")
    return nested.select("l_orderkey", "part", document(F.col("v")).alias("lines"))


_SPLIT = f"""SELECT l_orderkey, part,
coalesce(CAST(to_json(list(l_partkey ORDER BY l_partkey, l_linenumber) FILTER (WHERE l_returnflag = 'A')) AS VARCHAR),
  '[]') AS fabric,
coalesce(CAST(to_json(list(l_partkey ORDER BY l_partkey, l_linenumber) FILTER (WHERE l_returnflag = 'R')) AS VARCHAR),
  '[]') AS accessory
FROM (SELECT *, {_PART.format('PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_returnflag')} AS part
  FROM lineitem WHERE l_returnflag IN ('A', 'R')) GROUP BY l_orderkey, part"""


def _split(t):
    return nesting.split_collect(
        t.lineitem, ["l_orderkey"], "l_returnflag", {"fabric": "A", "accessory": "R"},
        ["l_partkey", "l_linenumber"], F.col("l_partkey"),
    )


def _split_text(df):
    return df.select(
        "l_orderkey", "part", document(F.col("fabric")).alias("fabric"), document(F.col("accessory")).alias("accessory")
    )


@query("partition_collect", _SPLIT)
def partition_collect(t):
    return _split_text(_split(t))


@query(
    "completeness_gate_all",
    f"SELECT * FROM ({_SPLIT}) WHERE fabric <> '[]' AND accessory <> '[]'",
)
def completeness_gate_all(t):
    return _split_text(nesting.complete(_split(t), ["fabric", "accessory"]))


@query("completeness_gate_any", f"SELECT * FROM ({_SPLIT}) WHERE fabric <> '[]' OR accessory <> '[]'")
def completeness_gate_any(t):
    return _split_text(nesting.complete(_split(t), ["fabric", "accessory"], require_all=False))


@query(
    "first_non_empty",
    """SELECT o_custkey, arg_min(v, o_orderkey) FILTER (WHERE v <> '') AS spec FROM
    (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN NULL ELSE o_orderpriority END AS v
     FROM orders) GROUP BY o_custkey HAVING count(*) FILTER (WHERE v <> '') > 0""",
)
def first_non_empty(t):
    status = F.col("o_orderstatus")
    value = F.when(status == "F", F.lit("")).when(status != "P", F.col("o_orderpriority"))
    return nesting.first_non_empty(t.orders.withColumn("v", value), ["o_custkey"], "v", "o_orderkey", "spec")


@query("top_n_per_group", f"SELECT l_orderkey, l_partkey, CAST(rank AS INTEGER) AS rank FROM ({_TOP2}) WHERE rank <= 2")
def top_n_per_group(t):
    return _top2(t).select("l_orderkey", "l_partkey", "rank")


@query(
    "nearest_first",
    """SELECT o_custkey, o_orderpriority AS code FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def nearest_first(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("code"))
    return keys.nearest_first(rows, "o_custkey", "o_orderkey", "code")


@query(
    "group_sequence",
    """SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, dense_rank() OVER
    (PARTITION BY l_orderkey ORDER BY l_suppkey) AS colour_no FROM lineitem""",
)
def group_sequence(t):
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    return numbering.number_runs(lines, ["l_orderkey"], ["l_suppkey"], "colour_no", sizes=t.lineitem)


@query(
    "item_sequence",
    """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS idx
    FROM orders""",
)
def item_sequence(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return numbering.number_in_group(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "idx").drop("o_orderdate")


@query(
    "item_sequence_ranges",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS idx FROM lineitem""",
)
def item_sequence_ranges(t):
    """Three groups hold all rows, so each is numbered in ranges."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    rows = t.lineitem.select("l_returnflag", *order)
    return numbering.number_in_group(rows, ["l_returnflag"], order, "idx", hot_rows=1000).drop("l_quantity")


@query(
    "cap_per_group",
    """SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_returnflag, l_orderkey, l_linenumber, l_suppkey) AS rn FROM lineitem) WHERE rn <= 30""",
)
def cap_per_group(t):
    """Thirty rows per product, as the bill of materials report lists them."""
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    order = ["l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey"]
    return keys.top_n_per_group(rows, ["l_partkey"], order, 30).select("l_partkey", "l_orderkey", "l_linenumber")


@query(
    "allocate_ids",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + (SELECT max(c_custkey) FROM customer) AS id
    FROM orders""",
)
def allocate_ids(t):
    return numbering.number_rows(t.orders.select("o_orderkey"), ["o_orderkey"], "id", after=(t.customer, "c_custkey"))


@query(
    "allocate_codes",
    """WITH lib AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'SX' || lpad(CAST(p_partkey AS VARCHAR), 5, '0')
      WHEN p_type = 'SMALL' THEN 'LEGACY' END AS code FROM part)
    SELECT p_partkey, coalesce(code, 'SX' || lpad(CAST(row_number() OVER (PARTITION BY code IS NULL ORDER BY p_partkey)
      + (SELECT max(CAST(substr(code, 3) AS BIGINT)) FROM lib WHERE code LIKE 'SX%') AS VARCHAR), 5, '0')) AS code
    FROM lib""",
)
def allocate_codes(t):
    code = F.when(
        F.col("p_type") == "PROMO", F.concat(F.lit("SX"), F.lpad(F.col("p_partkey").cast("string"), 5, "0"))
    ).when(F.col("p_type") == "SMALL", F.lit("LEGACY"))
    return numbering.allocate_codes(t.part.select("p_partkey", code.alias("code")), ["p_partkey"], "code", "SX")


@query(
    "order_limit",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50",
)
def order_limit(t):
    """The newest fifty orders (a top-k report)."""
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)


_CANDIDATES = """SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN
    (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""


def _candidates(t):
    from millrace.operators.lookup import missing_from

    done = t.lineitem.filter(F.col("l_returnflag") == "R")
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    return missing_from(urgent, done, {"o_orderkey": "l_orderkey"})


@query("batch_whole", _CANDIDATES)
def batch_whole(t):
    """All open candidates in one run."""
    return _candidates(t)


@query("batch_cap", f"{_CANDIDATES} ORDER BY o_orderkey LIMIT 200")
def batch_cap(t):
    """At most 200 open candidates a run, lowest key first; the next run takes the rest."""
    return _candidates(t).orderBy("o_orderkey").limit(200)
