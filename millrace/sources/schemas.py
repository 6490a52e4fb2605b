"""Declared schemas and the mapping from database column types to Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Columns of the driver's tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

# Database type names.
DATABASE_TYPES = {
    "serial": "int",
    "int": "int",
    "integer": "int",
    "mediumint": "int",
    "bigserial": "bigint",
    "bigint": "bigint",
    "smallserial": "smallint",
    "smallint": "smallint",
    "tinyint": "smallint",
    "char": "string",
    "varchar": "string",
    "text": "string",
    "longtext": "string",
    "json": "string",
    "jsonb": "string",
    "datetime": "timestamp_ntz",
    "timestamp": "timestamp_ntz",
    "date": "date",
    "boolean": "boolean",
    "bit": "boolean",
    "float": "float",
    "double": "double",
    "double precision": "double",
}


def spark_type(database_type: str) -> str:
    """Spark type of a database column type such as ``bigint(11) unsigned``.

    An unsigned integer may exceed the signed type of its width, so it is widened.
    """
    text = database_type.strip().lower()
    decimal = re.match(r"(?:numeric|decimal)\s*(\(\s*\d+\s*(?:,\s*\d+\s*)?\))?", text)
    if decimal:
        return "decimal" + (decimal.group(1) or "(38,10)").replace(" ", "")
    unsigned = "unsigned" in text
    base = re.sub(r"\(.*?\)|unsigned|zerofill", "", text).strip()
    mapped = DATABASE_TYPES.get(base)
    if mapped is None:
        raise ValueError(f"no Spark type for database type {database_type!r}")
    if unsigned and mapped in ("smallint", "int"):
        return {"smallint": "int", "int": "bigint"}[mapped]
    return mapped


def schema_of(columns: dict[str, str]) -> T.StructType:
    """Schema from column name to database type."""
    return T.StructType.fromDDL(", ".join(f"`{n}` {spark_type(t)}" for n, t in columns.items()))


def cast_to(df, schema: T.StructType):
    """Project ``df`` on a declared schema: same names, declared types."""
    from pyspark.sql import functions as F

    fields = []
    for f in schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            # Blank-padded char columns lose their padding.
            value = F.rtrim(value.cast("string"))
        fields.append(value.cast(f.dataType).alias(f.name))
    return df.select(*fields)
