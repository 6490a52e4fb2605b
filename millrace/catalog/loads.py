"""Sources, sinks and load patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.functions import document
from millrace.operators import rows
from millrace.session import ensure_checkpoint_dir
from millrace.sources import checked, claims, load, outbox, schemas, snapshots


def _scratch(t, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("extract_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def extract_table(t):
    return load.extract_filtered(t.supplier, ["s_suppkey", "s_name", "s_nationkey"], None)


@query(
    "extract_filtered",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def extract_filtered(t):
    keep = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")
    return load.extract_filtered(t.orders, ["o_orderkey", "o_custkey", "o_orderpriority"], keep)


@query(
    "extract_lookback",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 1 MONTH",
)
def extract_lookback(t):
    return load.extract_lookback(t.orders, "o_orderdate", m.ORDERS_AS_OF).select("o_orderkey", "o_orderdate")


@query(
    "extract_latest_n",
    """SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 1 MONTH
    ORDER BY ts DESC, event_id DESC LIMIT 500""",
)
def extract_latest_n(t):
    newest = load.extract_latest_n(t.events, "ts", m.EVENTS_AS_OF, 500, "event_id")
    return newest.select("event_id", "ts", "user_id")


@query("truncate_load", "SELECT c_custkey, c_name, upper(c_mktsegment) AS segment FROM customer")
def truncate_load(t):
    """Two loads of one table; readers see the second."""
    root = _scratch(t, "load")
    schema = schemas.schema_of({"c_custkey": "bigint", "c_name": "varchar(64)", "segment": "varchar(16)"})
    base = t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    load.truncate_load(base, root, schema)
    again = load.read_current(t.spark, root, schema).withColumn("segment", F.upper("segment"))
    load.truncate_load(again, root, schema)
    return load.read_current(t.spark, root, schema)


@query(
    "refresh",
    """SELECT CAST(event_id AS INTEGER) AS s_id, CAST(event_id * 2 AS INTEGER) AS id, CAST(user_id AS INTEGER) AS user_id,
      CAST(NULL AS INTEGER) AS ext_id, 'T' || (user_id % 9) AS terminal_id, event_type AS check_type, ts AS check_time,
      CAST(event_id AS VARCHAR) AS check_data, ts AS s_created_time,
      CAST(event_type = 'click' AS SMALLINT) AS is_write
    FROM events WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 1 MONTH""",
)
def refresh(t):
    """The declared load of punch records, end to end: extract, look back, cast to the declared types, replace."""
    root = _scratch(t, "refresh")
    source = t.events.select(
        F.col("event_id").alias("s_id"), (F.col("event_id") * 2).cast("string").alias("id"), "user_id",
        F.lit(None).cast("string").alias("ext_id"), F.concat(F.lit("T"), F.col("user_id") % 9, F.lit("  ")).alias("terminal_id"),
        F.col("event_type").alias("check_type"), F.col("ts").alias("check_time"), F.col("event_id").alias("check_data"),
        F.col("ts").alias("s_created_time"), (F.col("event_type") == "click").alias("is_write"), F.lit("x").alias("other"),
    )
    load.refresh("punch_clock", source, root, m.EVENTS_AS_OF)
    return load.read_current(t.spark, f"{root}/punch_clock", schemas.schema_of(load.DECLARED["punch_clock"]))


@query(
    "lookback_files",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 1 MONTH",
)
def lookback_files(t):
    """The look-back extract over a table cut into ranges of its date: other files are not opened."""
    root = _scratch(t, "clustered")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    snapshots.replace_table(orders, root, snapshots.Layout(cluster=("o_orderdate",)), files=32)
    return snapshots.lookback_files(t.spark, root, "o_orderdate", m.ORDERS_AS_OF)


#: Orders in two loads: the first holds all but every seventh customer's, the second brings those and some of the first again.
SECOND_LOAD = "o_custkey % 7 = 0 OR o_orderkey % 50 = 0"


@query(
    "insert_missing_files",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 THEN 'second' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""",
)
def insert_missing_files(t):
    """Insert into a keyed table whose Bloom filters say which files may hold a key."""
    root = _scratch(t, "keyed")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    snapshots.replace_table(orders.filter("o_custkey % 7 <> 0"), root, snapshots.Layout(("o_orderkey",), 32))
    source = orders.filter(SECOND_LOAD).withColumn("o_orderpriority", F.lit("second"))
    snapshots.insert_missing_files(t.spark, root, source)
    return snapshots.read_table(t.spark, root)


@query(
    "merge_files",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {SECOND_LOAD} THEN 'second' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""",
)
def merge_files(t):
    """Two upserts into a keyed table: each replaces the files that hold its keys and appends what is new."""
    root = _scratch(t, "keyed")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    snapshots.replace_table(orders.filter("o_custkey % 7 <> 0"), root, snapshots.Layout(("o_orderkey",), 32))
    source = orders.filter(SECOND_LOAD).withColumn("o_orderpriority", F.lit("second"))
    for part in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0"):
        snapshots.merge_files(t.spark, root, source.filter(part), ["o_orderpriority"])
    return snapshots.read_table(t.spark, root)


@query(
    "schema_history",
    """SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS s_name FROM supplier""",
)
def schema_history(t):
    """Files of three schemas read as one: a name was added, the nation widened, the balance dropped."""
    root, layout = _scratch(t, "history"), snapshots.Layout(cluster=("s_suppkey",))
    part = lambda k: t.supplier.filter(F.col("s_suppkey") % 3 == k)
    snapshots.replace_table(part(0).select("s_suppkey", "s_nationkey", "s_acctbal"), root, layout)
    second = part(1).select("s_suppkey", "s_nationkey", "s_acctbal", "s_name")
    snapshots.evolve_table(t.spark, root, second.schema)
    snapshots.append_rows(second, root, layout)
    third = part(2).select("s_suppkey", F.col("s_nationkey").cast("long").alias("s_nationkey"), "s_name")
    snapshots.evolve_table(t.spark, root, third.schema)
    snapshots.append_rows(third, root, layout)
    return snapshots.read_table(t.spark, root)


@query(
    "merge_bucketed",
    """WITH t AS (SELECT p_partkey, p_name, p_size FROM part),
    s AS (SELECT s_suppkey AS p_partkey, s_name AS p_name, s_nationkey AS p_size FROM supplier)
    SELECT p_partkey, coalesce(s.p_name, t.p_name) AS p_name, coalesce(t.p_size, s.p_size) AS p_size
    FROM t FULL JOIN s USING (p_partkey)""",
)
def merge_bucketed(t):
    """Upsert that rewrites only the hash buckets its keys fall in."""
    path = _scratch(t, "bucketed")
    target = t.part.select("p_partkey", "p_name", "p_size")
    source = t.supplier.select(
        F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"), F.col("s_nationkey").alias("p_size")
    )
    load.write_bucketed(target, path, ["p_partkey"], 16)
    load.merge_bucketed(t.spark, path, target.schema, source, ["p_partkey"], 16, update=["p_name"])
    return t.spark.read.schema(target.schema).parquet(path).select("p_partkey", "p_name", "p_size")


@query(
    "select_cast",
    """SELECT s_suppkey, s_name, CAST(s_acctbal < 0 AS INTEGER) AS s_lead_flag,
    CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier""",
)
def select_cast(t):
    flagged = t.supplier.withColumn("s_lead_flag", F.col("s_acctbal") < 0)
    return rows.select_cast(
        flagged, {"s_suppkey": None, "s_name": None, "s_lead_flag": "int", "s_nationkey": "bigint"}
    )


@query(
    "type_map_load",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(12,1)) AS VARCHAR) AS total, o_orderdate FROM orders""",
)
def type_map_load(t):
    declared = schemas.schema_of(
        {
            "o_orderkey": "int(11)",
            "o_custkey": "bigint(11) unsigned",
            "o_orderstatus": "char(255)",
            "o_totalprice": "decimal(12,1)",
            "o_orderdate": "datetime",
        }
    )
    typed = schemas.cast_to(t.orders, declared)
    return typed.withColumn("total", F.col("o_totalprice").cast("string")).drop("o_totalprice")


@query(
    "bit_to_int",
    "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS is_write FROM lineitem",
)
def bit_to_int(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("is_write"))


@query(
    "evolve_schema",
    """SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS origin_id, CAST(NULL AS BIGINT) AS origin_parent_id
    FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier""",
)
def evolve_schema(t):
    """A column added twice stays one column; rows with it can then be appended."""
    base = t.customer.select("c_custkey", "c_name")
    evolved = rows.evolve_schema(base, {"origin_id": "int", "origin_parent_id": "bigint"})
    evolved = rows.evolve_schema(evolved, {"origin_id": "int"})
    more = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("origin_id")
    )
    return evolved.unionByName(more, allowMissingColumns=True)


_DOMAIN = """WITH c AS (SELECT c_custkey, coalesce(nullif(c_nationkey, 7), 99999) AS sort, c_acctbal, c_mktsegment
  FROM customer), checked AS (SELECT *, concat_ws(',', CASE WHEN NOT c_acctbal >= 0 THEN 'balance' END,
  CASE WHEN NOT c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'segment' END) AS reasons FROM c)"""


def _checked(t):
    source = t.customer.select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(7)).alias("sort"), "c_acctbal", "c_mktsegment"
    )
    rules = {
        "balance": F.col("c_acctbal") >= 0,
        "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"),
    }
    return rows.check_domain(source, rules, {"sort": 99999})


@query("check_domain", _DOMAIN + " SELECT c_custkey, sort FROM checked WHERE reasons = ''")
def check_domain(t):
    return _checked(t)[0].select("c_custkey", "sort")


@query("check_domain_rejects", _DOMAIN + " SELECT c_custkey, sort, reasons FROM checked WHERE reasons <> ''")
def check_domain_rejects(t):
    return _checked(t)[1].select("c_custkey", "sort", "reasons")


_RULES = {"quantity": "l_quantity < 45", "discount": "l_discount <= 0.09", "flag": "l_returnflag <> 'R' OR l_tax < 0.07"}


def _load_checked(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    return checked.load_checked(lines, {name: F.expr(rule) for name, rule in _RULES.items()}, _scratch(t, "checked"))


@query(
    "load_checked",
    f"""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN NOT ({_RULES["quantity"]}) THEN 'quantity' END,
      CASE WHEN NOT ({_RULES["discount"]}) THEN 'discount' END, CASE WHEN NOT ({_RULES["flag"]}) THEN 'flag' END) AS reasons
    FROM lineitem""",
)
def load_checked(t):
    """Clean rows and rejects, as one pass wrote them."""
    parts = _load_checked(t)
    both = parts.clean.withColumn("reasons", F.lit("")).unionByName(parts.rejects)
    return both.select("l_orderkey", "l_linenumber", "reasons")


@query(
    "load_checked_counts",
    "WITH "
    + ", ".join(f"r_{name} AS (SELECT '{name}' AS rule, count(*) FILTER (NOT ({rule})) AS n FROM lineitem)" for name, rule in _RULES.items())
    + f""" SELECT 'rows' AS rule, count(*) AS n FROM lineitem UNION ALL SELECT 'rejected', count(*) FILTER (NOT ({") OR NOT (".join(_RULES.values())}))
    FROM lineitem UNION ALL FROM r_quantity UNION ALL FROM r_discount UNION ALL FROM r_flag""",
)
def load_checked_counts(t):
    """The counts observed while the rows were written."""
    return t.spark.createDataFrame(sorted(_load_checked(t).counts.items()), "rule string, n long")


@query(
    "claim_ids",
    """SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderkey) - 1 AS id
    FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def claim_ids(t):
    """Two runs number their rows out of one sequence: neither reads the other's."""
    root = _scratch(t, "claims")
    runs = [t.orders.filter(F.col("o_orderstatus") == s).select("o_orderkey") for s in ("F", "O")]
    first, second = (claims.number_claimed(r, ["o_orderkey"], "id", root, "orders", 1000) for r in runs)
    return first.unionByName(second)


@query(
    "export_documents",
    """SELECT CAST(to_json({'key': s_suppkey, 'document': CAST(to_json({'name': s_name, 'nation': s_nationkey})
    AS VARCHAR)}) AS VARCHAR) AS value, 'provider' AS entity, CASE WHEN s_nationkey < 12 THEN 'r1' ELSE 'r2' END AS run
    FROM supplier""",
)
def export_documents(t):
    """Two runs, the second one repeated: all documents are there, each once."""
    path = _scratch(t, "outbox")
    body = document(F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))
    docs = t.supplier.select("s_suppkey", "s_nationkey", body.alias("body"))
    first, second = docs.filter("s_nationkey < 12"), docs.filter("s_nationkey >= 12")
    for run, part in (("r1", first), ("r2", second), ("r2", second)):
        outbox.export_documents(part, "s_suppkey", "body", path, "provider", run)
    return t.spark.read.schema("value string, entity string, run string").text(path)




def responses(t):
    """One response per order: a JSON body with one entry per line, messages partly missing."""
    entry = F.struct(
        F.when(F.col("l_returnflag") == "A", 0).otherwise(1).alias("isSuccess"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("m"), "l_suppkey")).alias("subMsg"),
        F.concat(F.lit("P"), "l_partkey").alias("code"),
    )
    from millrace.operators.nesting import nested_collect

    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    lines = nested_collect(t.lineitem, ["l_orderkey"], order, F.struct(entry.alias("e"), "l_returnflag"), "v")
    worst = F.array_max(F.transform("v", lambda x: x["l_returnflag"]))
    body = F.to_json(F.struct(F.transform("v", lambda x: x["e"]).alias("data")))
    return lines.select(
        F.col("l_orderkey").alias("id"),
        F.when(worst == "N", 500).otherwise(200).alias("status_code"),
        body.alias("response_body"),
    )


@query(
    "parse_responses",
    """SELECT l_orderkey AS id, CASE WHEN max(l_returnflag) OVER (PARTITION BY l_orderkey) = 'N' THEN 500 ELSE 200 END
      AS status_code, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS is_success,
    CASE WHEN l_linestatus = 'F' THEN 'm' || l_suppkey END AS error_msg, 'P' || l_partkey AS entity_code
    FROM lineitem""",
)
def parse_responses(t):
    return outbox.parse_responses(responses(t))


@query(
    "load_registry",
    """SELECT c_custkey AS s_manager_id, c_name AS s_account, CAST(c_nationkey = 3 AS INTEGER) AS s_lead_flag
    FROM customer WHERE c_acctbal >= 0""",
)
def load_registry(t):
    """The declared load of the account table: filter, casts, no credential column."""
    source = t.customer.select(
        F.col("c_custkey").alias("s_manager_id"),
        F.col("c_name").alias("s_account"),
        F.lit("never carried").alias("s_password"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("s_activate_flag"),
        (F.col("c_nationkey") == 3).alias("s_lead_flag"),
    )
    return load.LOADS["manager"].extract(source).drop("s_activate_flag")
