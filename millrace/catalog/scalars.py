"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.functions import (
    bracket_ids, date_text, document, falsy_to_default, first_number, json_field, localized, timestamp_text, value_map,
)


@query(
    "string_functions",
    """SELECT c_custkey, trim(' ' || c_name || ' ') AS trimmed, trim('[' || c_custkey || ']', '[]') AS bare,
    split_part(c_name, '#', 2) AS digits, replace(c_name, '#', '.') AS replaced, left(c_name, 11) AS head,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS padded, substr(c_name, 10) AS tail, lower(c_mktsegment) AS lowered,
    c_name || '_' || nullif(c_mktsegment, 'BUILDING') AS joined FROM customer""",
)
def string_functions(t):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.trim(F.concat(F.lit(" "), name, F.lit(" "))).alias("trimmed"),
        F.trim(F.concat(F.lit("["), "c_custkey", F.lit("]")), F.lit("[]")).alias("bare"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("digits"),
        F.replace(name, F.lit("#"), F.lit(".")).alias("replaced"),
        F.left(name, F.lit(11)).alias("head"),
        F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("padded"),
        F.substring(name, 10, 100).alias("tail"),
        F.lower("c_mktsegment").alias("lowered"),
        F.concat(name, F.lit("_"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("joined"),
    )


@query(
    "regex_first_number",
    """WITH w AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 'abc' WHEN 'LARGE' THEN ''
      ELSE 'w ' || p_size || '.5g/m' || p_size END AS weight FROM part)
    SELECT p_partkey, TRY_CAST(nullif(regexp_extract(weight, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE) AS weight FROM w""",
)
def regex_first_number(t):
    kind = F.col("p_type")
    weight = (
        F.when(kind == "PROMO", None)
        .when(kind == "SMALL", F.lit("abc"))
        .when(kind == "LARGE", F.lit(""))
        .otherwise(F.concat(F.lit("w "), "p_size", F.lit(".5g/m"), "p_size"))
    )
    return t.part.select("p_partkey", first_number(weight).alias("weight"))


@query(
    "text_first_number",
    """SELECT doc_id, TRY_CAST(nullif(regexp_extract(translate(text, '０１２３４５６７８９', '0123456789'),
    '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE) AS first_number FROM documents""",
)
def text_first_number(t):
    """First number of every whole text."""
    return t.documents.select("doc_id", first_number("text").alias("first_number"))


@query(
    "pattern_functions",
    """SELECT c_custkey, c_name LIKE 'Customer#0000000%' AS matches, c_name NOT LIKE '%5' AS differs,
    regexp_matches(c_mktsegment, '^[A-F]') AS early FROM customer""",
)
def pattern_functions(t):
    return t.customer.select(
        "c_custkey",
        F.col("c_name").like("Customer#0000000%").alias("matches"),
        (~F.col("c_name").like("%5")).alias("differs"),
        F.col("c_mktsegment").rlike("^[A-F]").alias("early"),
    )


@query(
    "null_functions",
    """SELECT s_suppkey, coalesce(nullif(s_nationkey, 0), 99) AS nation, coalesce(nullif(s_acctbal, 0), 1.0) AS balance,
    coalesce(nullif(substr('abc', s_nationkey + 1, 1), ''), '0.0') AS rate FROM supplier""",
)
def null_functions(t):
    letter = F.substring(F.lit("abc"), F.col("s_nationkey") + 1, F.lit(1))
    return t.supplier.select(
        "s_suppkey",
        falsy_to_default("s_nationkey", F.lit(99), 0).alias("nation"),
        falsy_to_default("s_acctbal", F.lit(1.0), 0.0).alias("balance"),
        falsy_to_default(letter, F.lit("0.0"), "").alias("rate"),
    )


@query(
    "date_functions",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d') AS day,
    ts > TIMESTAMP '2024-01-30' - INTERVAL 1 MONTH AS in_month, ts + INTERVAL 3 MONTH AS due FROM events""",
)
def date_functions(t):
    from millrace.functions import newer_than

    return t.events.select(
        "event_id",
        timestamp_text("ts").alias("at"),
        date_text("ts").alias("day"),
        newer_than("ts", m.EVENTS_AS_OF, "1 month").alias("in_month"),
        (F.col("ts") + F.expr("interval 3 month")).alias("due"),
    )


@query(
    "math_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS INTEGER) * 0.01 AS DOUBLE) AS proportion,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(floor(l_tax * 100 + 0.5) AS INTEGER) AS score
    FROM lineitem""",
)
def math_functions(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity").cast("int") * F.lit(0.01).cast("decimal(2,2)")).cast("double").alias("proportion"),
        m.money("l_extendedprice").cast("string").alias("price"),
        F.floor(F.col("l_tax") * 100 + 0.5).cast("int").alias("score"),
    )


@query(
    "json_functions",
    ctes("depart")
    + """ SELECT dd_id, CAST(to_json({'zh_CN': dd_name, 'en_US': coalesce(s_en_name, dd_name),
      'ja_JP': coalesce(s_jp_name, dd_name)}) AS VARCHAR) AS name,
    to_json({'zh_CN': dd_name, 'en_US': coalesce(s_en_name, dd_name)}) ->> '$.en_US' AS en_name,
    CAST(to_json({'code': code, 'sort': sort}) AS VARCHAR) AS doc FROM depart""",
)
def json_functions(t):
    name = localized(zh_CN="dd_name", en_US="s_en_name", ja_JP="s_jp_name")
    return m.depart(t).select(
        "dd_id",
        name.alias("name"),
        json_field(name, "en_US").alias("en_name"),
        document(F.struct("code", "sort")).alias("doc"),
    )


@query(
    "array_functions",
    ctes("place_text")
    + """, p AS (SELECT *, string_split(trim(s_country_id, '[]'), ',') AS parts FROM place_text)
    SELECT s_supplier_id, TRY_CAST(nullif(parts[1], '') AS BIGINT) AS first_id,
    TRY_CAST(nullif(parts[3], '') AS BIGINT) AS third_id, list_contains(parts, '2') AS has_two FROM p""",
)
def array_functions(t):
    ids = bracket_ids("s_country_id", 3)
    parts = F.split(F.trim(F.col("s_country_id"), F.lit("[]")), ",")
    return m.place_text(t).select(
        "s_supplier_id",
        ids[0].alias("first_id"),
        ids[2].alias("third_id"),
        F.array_contains(parts, "2").alias("has_two"),
    )


@query(
    "value_map",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Ag+' WHEN 'SMALL' THEN 'S' ELSE p_type END AS kind FROM part""",
)
def value_mapping(t):
    return t.part.select("p_partkey", value_map("p_type", {"PROMO": "Ag+", "SMALL": "S"}).alias("kind"))
