"""Documents out, responses in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shape of a response body.
RESPONSE = "struct<data:array<struct<isSuccess:int,subMsg:string,code:string>>>"


def export_documents(df: DataFrame, key: str, document: str, path: str, entity: str, run: str) -> None:
    """Append documents as JSON lines ``{"key":..,"document":..}`` under one folder per entity and run.

    Other runs' documents stay. A run that is repeated under its own name replaces what it
    wrote before, so a retry adds nothing.
    """
    line = F.to_json(F.struct(F.col(key).alias("key"), F.col(document).alias("document")))
    df.select(line.alias("value")).write.mode("overwrite").text(f"{path}/entity={entity}/run={run}")


def parse_responses(df: DataFrame, body: str = "response_body") -> DataFrame:
    """One row per entry of ``data``; a body without entries keeps one row of nulls."""
    kept = [c for c in df.columns if c != body]
    parsed = df.withColumn("_r", F.from_json(F.col(body), RESPONSE))
    opened = parsed.select(*kept, F.explode_outer("_r.data").alias("_e"))
    return opened.select(
        *kept,
        F.col("_e.isSuccess").alias("is_success"),
        F.col("_e.subMsg").alias("error_msg"),
        F.col("_e.code").alias("entity_code"),
    )
