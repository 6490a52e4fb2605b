"""Departments, jobs, employees and partners of the ERP."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import bracket_ids, code_map, digits_to_long, json_field, localized
from millrace.operators import merge, tree
from millrace.operators.lookup import lookup, missing_from, resolve_places
from millrace.operators.rows import require
from millrace.session import cut_lineage

# Constants of mandatory target columns.
TIME_ZONE = "Asia/Shanghai"
PARTNER_COLUMNS = {
    "customer_code": "s_supplier_num",
    "name": "s_supplier_name",
    "complete_name": "s_supplier_name",
    "customer_short_name": "s_supplier_short_name",
    "street": "s_address",
    "employee_number": "s_total_person",
    "production_staff": "s_workshop_person",
    "technical_staff": "s_technical_person",
    "email": "s_email",
    "email_normalized": "s_email",
    "comment": "s_remark",
}
PARTNER_CONSTANTS = {
    "supplier_rank": 1,
    "lang": "zh_CN",
    "type": "contact",
    "active": True,
    "is_company": True,
    "partner_share": True,
    "state": "active",
    "status": "draft",
}


def departments(target: DataFrame, depart: DataFrame, company: Column, as_of: Column) -> DataFrame:
    """Next department snapshot: reconciled, linked to parents, with paths.

    ``target``: id, origin_id, name, origin_parent_id, parent_id, complete_name,
    parent_path, active, company_id, write_date.
    """
    source = depart.select(
        F.col("dd_id").alias("origin_id"),
        localized(zh_CN="dd_name", en_US="s_en_name", ja_JP="s_jp_name").alias("name"),
        F.col("dd_parent_id").alias("origin_parent_id"),
        company.alias("company_id"),
    )
    source = merge.give_ids(source, target, ["origin_id"])
    merged = merge.reconcile(
        target, source, ["origin_id"], ["name", "origin_parent_id"], stamp=("write_date", as_of)
    )
    # Both sides of the join by parent, and the walk and its rows, read these from files.
    linked = cut_lineage(merge.backfill_parent(cut_lineage(merged)))
    named = linked.withColumn("_name", json_field("name", "zh_CN"))
    paths = tree.tree_paths(named, name="_name", name_path="new_name", id_path="new_path")
    # Rows that no root reaches keep their old paths.
    return (
        paths.withColumn("complete_name", F.coalesce("new_name", "complete_name"))
        .withColumn("parent_path", F.coalesce("new_path", "parent_path"))
        .select(*target.columns)
    )


def jobs(target: DataFrame, position: DataFrame, company: Column) -> DataFrame:
    """Next job snapshot; the active flag follows the source's delete flag."""
    source = position.select(
        F.col("s_talent_position_id").alias("origin_id"),
        localized(zh_CN="s_position", en_US="s_en_position").alias("name"),
        code_map("is_delete", {1: False, 0: True}).alias("active"),
        company.alias("company_id"),
    )
    source = merge.give_ids(source, target, ["origin_id"])
    return merge.reconcile(target, source, ["origin_id"], ["name"])


def employees(
    resources: DataFrame,
    staff: DataFrame,
    manager: DataFrame,
    archive: DataFrame,
    department: DataFrame,
    job: DataFrame,
    company: Column,
    as_of: Column,
) -> tuple[DataFrame, DataFrame]:
    """Next (resource, employee) snapshots in one pass: a new employee finds the
    resource row that the same run created."""
    record = archive.select(
        F.col("s_talent_archives_id").alias("_record"),
        F.col("s_employee_num").alias("barcode"),
        F.col("s_talent_position_id").alias("_position"),
    )
    people = manager.join(record, F.col("s_talent_id") == F.col("_record")).select(
        F.col("s_manager_id").alias("origin_id"),
        F.col("s_account").alias("name"),
        F.col("s_cellphone").alias("work_phone"),
        F.col("s_email").alias("work_email"),
        code_map("s_activate_flag", {1: True, 0: False}).alias("active"),
        "barcode",
        digits_to_long("dd_depart_ids").alias("_depart"),
        "_position",
    )
    people = lookup(people, department, {"_depart": "origin_id"}, {"department_id": "id"})
    people = lookup(people, job, {"_position": "origin_id"}, {"job_id": "id"})
    # Read by both merges, each of which looks for new rows and for known ones.
    people = cut_lineage(people.withColumn("company_id", company).withColumn("create_date", as_of))

    users = F.col("resource_type") == "user"
    source = people.withColumn("resource_type", F.lit("user")).withColumn("tz", F.lit(TIME_ZONE))
    typed = merge.upsert_numbered(
        resources.filter(users),
        source.withColumn("time_efficiency", F.lit(100.0)),
        ["origin_id"],
        ["name", "active"],
        ids_in=resources,
    )
    typed = cut_lineage(typed)
    # Rows of another type are renamed with their origin, but never added.
    others = resources.filter(~F.coalesce(users, F.lit(False)))
    others = merge.update_changed(others, people, ["origin_id"], ["name", "active"])
    resources_out = merge.deactivate_unlinked(typed.unionByName(others), "origin_id")

    ids = typed.filter(F.col("origin_id").isNotNull()).select(
        F.col("origin_id"), F.col("id").alias("resource_id")
    )
    linked = cut_lineage(people.join(ids, "origin_id").withColumn("employee_type", F.lit("employee")))
    own = F.col("employee_type") == "employee"
    merged = merge.upsert_numbered(
        staff.filter(own), linked, ["origin_id"], ["name", "active", "department_id", "job_id"], ids_in=staff
    )
    rest = staff.filter(~F.coalesce(own, F.lit(False)))
    staff_out = merge.deactivate_unlinked(merged.unionByName(rest), "origin_id", only=own)
    return resources_out, staff_out


def partners(
    target: DataFrame,
    supplier: DataFrame,
    countries: DataFrame,
    areas: DataFrame,
    country_ids: DataFrame,
    state_ids: DataFrame,
    supplier_type: Column,
    require_email: bool = True,
    columns: Mapping[str, str] = PARTNER_COLUMNS,
    score: str | None = "s_score",
) -> DataFrame:
    """Partner rows to insert: suppliers unknown to the target, with resolved places.

    ``countries`` and ``areas`` are (id, name) of the source, ``country_ids`` and
    ``state_ids`` are (id, name) of the target. Suppliers without email are left out
    unless ``require_email`` is off. ``columns`` (partner column to supplier column) and ``score`` are
    taken over; one that the supplier table lacks is an error.
    """
    require(supplier, [*columns.values(), *([score] if score else [])])
    live = supplier.filter(F.col("is_delete") == 0)
    if require_email:
        live = live.filter(F.col("s_email").isNotNull())
    new = missing_from(live, target, {"s_supplier_id": "origin_id"})
    placed = resolve_places(new, "s_country_id", countries, areas, bracket_ids("s_country_id", 4))
    placed = lookup(placed, country_ids, {"place_1": "name"}, {"country_id": "id"})
    placed = lookup(placed, state_ids, {"place_2": "name"}, {"state_id": "id"})
    return placed.select(
        F.col("s_supplier_id").alias("origin_id"),
        *[F.col(c).alias(out) for out, c in columns.items()],
        *([F.col(score).try_cast("int").alias("score")] if score else []),
        F.lit(TIME_ZONE).alias("tz"),
        supplier_type.alias("supplier_type"),
        "country_id",
        "state_id",
        F.col("place_3").alias("city"),
        *[F.lit(v).alias(k) for k, v in PARTNER_CONSTANTS.items()],
    )


def partner_properties(partners: DataFrame, properties: DataFrame, existing: DataFrame) -> DataFrame:
    """(partner_id, property_id) pairs to insert for every linked partner."""
    linked = partners.filter(F.col("origin_id").isNotNull()).select(F.col("id").alias("partner_id"))
    constants = properties.select(F.col("id").alias("property_id"))
    return merge.missing_pairs(linked, "partner_id", constants, "property_id", existing)
