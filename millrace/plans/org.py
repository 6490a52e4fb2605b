"""Departments, users, memberships and posts for two target systems.

The portal keeps null parents; the workflow system wants 0, a tenant and audit
columns. Credential columns are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import (
    blank_to_default, blank_to_null, digits_to_long, first_known, is_set, offset_id,
)
from millrace.operators import merge, nesting, tree
from millrace.operators.lookup import lookup

# Id offset and the constants of mandatory target columns.
OFFSET = 10000
TENANT = 1


def _audit(created: Column, updated: Column) -> dict[str, Column]:
    return {
        "creator": F.lit(""),
        "create_time": created,
        "updater": F.lit(""),
        "update_time": updated,
    }


def _visible(depart: DataFrame) -> DataFrame:
    return tree.visible_rows(depart, "dd_id", "dd_parent_id", "dd_deleted_time")


def portal_departments(depart: DataFrame, target: DataFrame, as_of: Column) -> DataFrame:
    """Target snapshot (id, title, parent_id, created_at, updated_at, sort, is_leaf, code)."""
    rows = _visible(depart).select(
        offset_id("dd_id", OFFSET).alias("id"),
        F.col("dd_name").alias("title"),
        offset_id("dd_parent_id", OFFSET).alias("parent_id"),
        first_known("dd_created_time", as_of).alias("created_at"),
        first_known("dd_updated_time", "dd_created_time", as_of).alias("updated_at"),
        "sort",
        F.lit(False).alias("is_leaf"),
        "code",
    )
    return merge.merge_upsert(target, rows, ["id"], ["title", "parent_id", "updated_at", "sort", "code"])


def finish_departments(departments: DataFrame) -> DataFrame:
    """Leaf flags recomputed and missing codes inherited from the nearest ancestor."""
    coded = tree.inherit_from_ancestor(departments, "id", "parent_id", "code")
    return tree.leaf_flag(coded, "id", "parent_id", "is_leaf")


def workflow_departments(depart: DataFrame, target: DataFrame, as_of: Column) -> DataFrame:
    created = first_known("dd_created_time", as_of)
    rows = _visible(depart).select(
        offset_id("dd_id", OFFSET).alias("id"),
        F.col("dd_name").alias("name"),
        offset_id("dd_parent_id", OFFSET, missing=0).alias("parent_id"),
        "sort",
        F.lit(0).alias("status"),
        *[v.alias(k) for k, v in _audit(created, first_known("dd_updated_time", created)).items()],
        is_set("dd_deleted_time").alias("deleted"),
        F.lit(TENANT).alias("tenant_id"),
    )
    return merge.merge_upsert(target, rows, ["id"])


def _active_users(manager: DataFrame, archive: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Active accounts whose personnel record has an employee number."""
    active = manager.filter(F.col("s_activate_flag") == 1)
    for account in excluded:
        active = active.filter(F.col("s_account") != account)
    record = archive.filter(F.col("s_employee_num").isNotNull())
    prefixed = record.select(*[F.col(c).alias(f"ta_{c}") for c in record.columns])
    return active.join(prefixed, F.col("s_talent_id") == F.col("ta_s_talent_archives_id"))


def portal_users(
    manager: DataFrame, archive: DataFrame, target: DataFrame, as_of: Column, excluded: Sequence[str] = ()
) -> DataFrame:
    rows = _active_users(manager, archive, excluded).select(
        offset_id("s_manager_id", OFFSET).alias("id"),
        first_known("s_created_time", as_of).alias("created_at"),
        first_known("s_updated_time", "s_created_time", as_of).alias("updated_at"),
        F.col("s_account").alias("nickname"),
        F.replace("ta_s_employee_num", F.lit("."), F.lit("")).alias("username"),
        blank_to_null("ta_s_email").alias("email"),
        F.col("s_cellphone").alias("phone"),
        F.col("ta_s_employee_num").alias("employee_num"),
    )
    return merge.merge_upsert(target, rows, ["id"])


def workflow_users(
    manager: DataFrame, archive: DataFrame, target: DataFrame, as_of: Column, excluded: Sequence[str] = ()
) -> DataFrame:
    created = first_known("s_created_time", as_of)
    none = F.lit(None)
    rows = _active_users(manager, archive, excluded).select(
        offset_id("s_manager_id", OFFSET).alias("id"),
        F.replace("ta_s_employee_num", F.lit("."), F.lit("")).alias("username"),
        first_known("ta_s_name", "s_account").alias("nickname"),
        none.cast("string").alias("remark"),
        offset_id(digits_to_long("dd_depart_ids"), OFFSET).alias("dept_id"),
        none.cast("string").alias("post_ids"),
        blank_to_null("ta_s_email").alias("email"),
        F.left("s_cellphone", F.lit(11)).alias("mobile"),
        F.lit(0).alias("sex"),
        F.lit("").alias("avatar"),
        F.lit(0).alias("status"),
        none.cast("string").alias("login_ip"),
        none.cast("timestamp_ntz").alias("login_date"),
        *[v.alias(k) for k, v in _audit(created, first_known("s_updated_time", created)).items()],
        is_set("s_deleted_time").alias("deleted"),
        F.lit(TENANT).alias("tenant_id"),
    )
    return merge.merge_upsert(target, rows, ["id"])


def memberships(
    manager: DataFrame,
    archive: DataFrame,
    users: DataFrame,
    departments: DataFrame,
    target: DataFrame,
    as_of: Column,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """User-department pairs with an owner flag; ``created_at`` is written on insert only."""
    pairs = _active_users(manager, archive, excluded).select(
        offset_id("s_manager_id", OFFSET).alias("user_id"),
        offset_id(digits_to_long("dd_depart_ids"), OFFSET).alias("department_id"),
        F.coalesce(F.col("ta_is_lead") == 1, F.lit(False)).alias("is_owner"),
    )
    pairs = pairs.filter(F.col("department_id").isNotNull())
    known = pairs.join(users.select(F.col("id").alias("user_id")), "user_id").join(
        departments.select(F.col("id").alias("department_id")), "department_id"
    )
    rows = known.select(
        "department_id",
        "user_id",
        F.lit(True).alias("is_main"),
        "is_owner",
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )
    return merge.merge_upsert(
        target, rows, ["department_id", "user_id"], ["is_main", "is_owner", "updated_at"]
    )


def posts(position: DataFrame, target: DataFrame, as_of: Column) -> DataFrame:
    created = first_known("gmt_create", as_of)
    rows = position.filter(F.col("is_delete") == 0).select(
        offset_id("s_talent_position_id", OFFSET).alias("id"),
        F.col("s_position").alias("name"),
        blank_to_default("s_en_position", F.col("s_position")).alias("code"),
        F.coalesce("sort", F.lit(0)).alias("sort"),
        F.lit(0).alias("status"),
        F.lit("").alias("remark"),
        *[v.alias(k) for k, v in _audit(created, first_known("gmt_modified", created)).items()],
        (F.col("is_delete") == 1).alias("deleted"),
        F.lit(TENANT).alias("tenant_id"),
    )
    return merge.merge_upsert(target, rows, ["id"])


def user_posts(
    manager: DataFrame, archive: DataFrame, target: DataFrame, as_of: Column, excluded: Sequence[str] = ()
) -> DataFrame:
    """User-post pairs keyed by both columns; ``tenant_id`` is written on insert only."""
    placed = _active_users(manager, archive, excluded).filter(F.col("ta_s_talent_position_id").isNotNull())
    rows = placed.select(
        offset_id("s_manager_id", OFFSET).alias("user_id"),
        offset_id("ta_s_talent_position_id", OFFSET).alias("post_id"),
        first_known("ta_gmt_create", as_of).alias("create_time"),
        first_known("ta_gmt_modified", "ta_gmt_create", as_of).alias("update_time"),
        F.coalesce("ta_is_delete", F.lit(False)).alias("deleted"),
        F.lit(TENANT).alias("tenant_id"),
    )
    return merge.merge_upsert(
        target, rows, ["user_id", "post_id"], ["create_time", "update_time", "deleted"]
    )


def fill_post_lists(users: DataFrame, links: DataFrame) -> DataFrame:
    """``post_ids`` as ``"[1,2]"`` where it is null and active links in the tenant exist."""
    active = links.filter(~F.col("deleted")).select(F.col("user_id").alias("id"), "tenant_id", "post_id")
    lists = nesting.single_part(nesting.distinct_list(active, ["id", "tenant_id"], "post_id", "post_ids"))
    return merge.fill_null_from(users, lists, ["id", "tenant_id"], "post_ids")


def default_roles(users: DataFrame, links: DataFrame, roles: DataFrame, role_code: str, as_of: Column) -> DataFrame:
    """Role links to add for live users of the tenant that have no active one."""
    mine = users.filter((F.col("deleted") == 0) & (F.col("tenant_id") == TENANT))
    role = roles.filter((F.col("code") == role_code) & (F.col("tenant_id") == TENANT))
    first_role = role.agg(F.min("id").alias("id")).scalar()
    active = links.filter(~F.col("deleted"))
    people = mine.select(F.col("id").alias("user_id"), "tenant_id")
    added = merge.assign_default(people, active, ["user_id"], first_role, "role_id")
    return added.withColumn("create_time", as_of)
