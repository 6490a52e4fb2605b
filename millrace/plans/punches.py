"""Attendance punches of known employees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import json_field, newer_than
from millrace.operators import merge

# Fixed value: check type of a face punch.
FACE = "fa"


def punch_detail(
    punches: DataFrame, archive: DataFrame, target: DataFrame, as_of: str, kind: str = FACE, interval: str = "3 month"
) -> DataFrame:
    """Detail layer with the window's punches added; loaded rows are never touched.

    ``target``: dk_id, terminal_id, employee_num, username, device_name, dk_time.
    """
    recent = punches.filter((F.col("check_type") == kind) & newer_than("check_time", as_of, interval))
    people = archive.filter(F.col("s_employee_num").isNotNull()).select(
        F.col("s_talent_archives_id").alias("ext_id"),
        F.col("s_employee_num").alias("employee_num"),
        F.col("s_name").alias("username"),
    )
    rows = recent.join(people, "ext_id").select(
        F.col("id").alias("dk_id"),
        "terminal_id",
        "employee_num",
        "username",
        json_field("check_data", "device_name").alias("device_name"),
        F.col("check_time").alias("dk_time"),
    )
    return merge.insert_missing(target, rows, ["dk_id"])
