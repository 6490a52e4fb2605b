"""Yarn library: role lookups, dictionary lookups, components, prices and codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import localized, value_map
from millrace.operators import keys, lookup, merge, nesting, numbering
from millrace.operators.rows import require

# Key columns of the store and the tree column each one brings.
ROLES = {
    "s_yarn_type_id": ("yarn_type", "s_code"),
    "s_yarn_color_id": ("color_of_yarn", "s_code"),
    "s_green_components_id": ("green_properties_verified", "s_code"),
    "s_functional_materials_id": ("functional_material", "s_name"),
    "s_filament_staple_processing_method_id": ("after_treatment_method", "s_code"),
    "s_filament_lustre_id": ("iustre", "s_code"),
    "s_filament_cross_sectional_shape_id": ("cross_section_shape", "s_code"),
    "s_staple_special_fiber_id": ("special_staple", "s_name"),
    "s_staple_yarn_quality_id": ("quality_of_yarn", "s_code"),
    "s_staple_spinning_method_id": ("spinning_method", "s_code"),
    "s_staple_twist_id": ("twist_tpi", "s_code"),
    "s_staple_twist_direction_id": ("twist_direction", "s_code"),
    "s_fancy_special_fiber_id": ("special_fancy", "s_name"),
    "s_fancy_yarn_name_id": ("name_of_fancy_yarn", "s_code"),
    "s_blended_special_fiber_id": ("special_blended", "s_name"),
    "s_blended_method_id": ("composite_method", "s_code"),
    "s_yarn_count_unit_id": ("yarn_count_unit", "s_name"),
}
# Field, dictionary, and the detail column its code is found in.
DICTIONARIES = {
    "yarn_type": ("yarn_type", "mnemonic_code"),
    "green_properties_verified": ("green_properties_verified", "mnemonic_code"),
    "functional_material": ("functional_material", "name"),
    "after_treatment_method": ("after_treatment_method", "mnemonic_code"),
    "iustre": ("iustre", "mnemonic_code"),
    "cross_section_shape": ("cross_section", "mnemonic_code"),
    "special_fiber": ("special_fiber", "name"),
    "quality_of_yarn": ("quality_of_yarn", "mnemonic_code"),
    "spinning_method": ("spinning_method", "mnemonic_code"),
    "twist_tpi": ("twist_tpi", "mnemonic_code"),
    "twist_direction": ("twist_direction", "mnemonic_code"),
    "name_of_fancy_yarn": ("name_of_fancy_yarn", "mnemonic_code"),
    "composite_method": ("composed_method", "mnemonic_code"),
    "yarn_count_unit": ("yarn_count_unit", "code"),
}
# Library columns taken over as they are.
LIBRARY_COLUMNS = {
    "origin_id": "s_yarn_store_id",
    "technical_code": "s_yarn_code",
    "fiber_brand": "s_fiber_brand",
    "fiber_supplier": "s_fiber_supplier",
    "fiber_structure": "s_filament_fiber_structure",
    "value": "s_yarn_count_value",
    "ply_number": "s_yarn_count_count",
    "coding": "s_num_prefix",
    "tec_seq": "s_num_suffix",
    "yarn_count": "s_yarn_count_text",
    "create_date": "s_create_time",
    "write_date": "s_update_time",
}
FIBER_NAMES = {"银离子": "Ag+"}
FILAMENT = "L"
CODE_PREFIX = "SX"


def resolve_roles(store: DataFrame, tree: DataFrame, roles: Mapping[str, tuple[str, str]] = ROLES) -> DataFrame:
    """Tree codes and names of every role. A role column the store lacks is an error, not an empty result."""
    require(store, roles)
    return lookup.role_lookup(store, tree, "s_tree_id", {k: {out: c} for k, (out, c) in roles.items()})


def resolve_dictionaries(
    rows: DataFrame, entries: DataFrame, fields: Mapping[str, tuple[str, str]] = DICTIONARIES
) -> DataFrame:
    """Replace codes by dictionary ids. ``entries``: dict_code, id, code, mnemonic_code, name. Every field must be there."""
    require(rows, fields)
    for field, (dict_code, column) in fields.items():
        one = entries.filter(F.col("dict_code") == dict_code)
        code = value_map(column, FIBER_NAMES) if field == "special_fiber" else F.col(column)
        side = one.select(code.alias("_code"), F.col("id").alias("_id"))
        found = lookup.lookup(rows, side, {field: "_code"}, {"_id": "_id"})
        rows = found.withColumn(field, F.col("_id")).drop("_id")
    return rows


def merge_special(coded: DataFrame) -> DataFrame:
    """``special_fiber``: the one special fibre a yarn has, whatever its kind."""
    kinds = [c for c in ("special_staple", "special_fancy", "special_blended") if c in coded.columns]
    return coded.withColumn("special_fiber", F.coalesce(*kinds)).drop(*kinds) if kinds else coded


def library(
    target: DataFrame,
    store: DataFrame,
    tree: DataFrame,
    entries: DataFrame,
    colours: DataFrame,
    roles: Mapping[str, tuple[str, str]] = ROLES,
    fields: Mapping[str, tuple[str, str]] = DICTIONARIES,
) -> DataFrame:
    """Library with the store's unknown yarns added under new ids.

    ``roles`` and ``fields`` are what the store of this library has; all of them by default.
    ``colours``: id, code, yarn_type (an already resolved id): a colour code only
    means something within its yarn type.
    """
    new = lookup.missing_from(store, target, {"s_yarn_store_id": "origin_id"})
    coded = merge_special(resolve_roles(new, tree, roles))
    filament = F.col("yarn_type") == FILAMENT
    coded = coded.withColumn("f_number", F.when(filament, F.col("s_yarn_count_unit_f")))
    ids = resolve_dictionaries(coded, entries, fields)
    ids = lookup.lookup(ids, colours, {"color_of_yarn": "code", "yarn_type": "yarn_type"}, {"_colour": "id"})
    rows = ids.withColumns(
        {
            "color_of_yarn": F.col("_colour"),
            **{out: F.col(c) for out, c in LIBRARY_COLUMNS.items() if c in store.columns},
            "remark": localized(zh_CN="s_remark", en_US="s_remark"),
            "active": F.coalesce(F.col("is_delete") == 0, F.lit(False)),
            "status": F.lit("draft"),
        }
    )
    return merge.insert_numbered(target, rows, ["origin_id"])


def components(target: DataFrame, component: DataFrame, tree: DataFrame, entries: DataFrame, library: DataFrame):
    """Fibre shares of the yarns, unknown ones added. ``target``: fiber, proportion, yarn_library_id, origin_id."""
    codes = tree.select("s_tree_id", "s_code")
    rows = component.join(codes, "s_tree_id")
    fibers = entries.filter(F.col("dict_code") == "fiber")
    rows = lookup.lookup(rows, fibers, {"s_code": "mnemonic_code"}, {"fiber": "id"})
    rows = lookup.lookup(rows, library, {"s_yarn_store_id": "origin_id"}, {"yarn_library_id": "id"})
    share = F.col("s_ratio") * F.lit(0.01).cast("decimal(2,2)")
    rows = rows.select("fiber", share.alias("proportion"), "yarn_library_id", F.col("s_component_id").alias("origin_id"))
    return merge.insert_missing(target, rows, ["origin_id"])


def composition_codes(library: DataFrame, composition: DataFrame, entries: DataFrame) -> DataFrame:
    """``composition_code``: codes of the two largest fibres, largest first."""
    fibers = entries.select(F.col("id").alias("fiber"), "mnemonic_code")
    known = composition.filter(F.col("yarn_library_id").isNotNull()).join(fibers, "fiber")
    order = [F.desc("proportion"), F.asc("origin_id")]
    top = keys.top_n_per_group(known, ["yarn_library_id"], order, 2)
    codes = nesting.string_agg(top, ["yarn_library_id"], "mnemonic_code", [F.col("rank")], "composition_code")
    codes = codes.withColumnRenamed("yarn_library_id", "id")
    return merge.overwrite_from(library, codes, ["id"], "composition_code")


def prices(target: DataFrame, price: DataFrame, library: DataFrame) -> DataFrame:
    """Yarn prices with unknown ones added. ``target``: inquiry_date, price, yarn_library_id, origin_id."""
    known = library.filter(F.col("origin_id").isNotNull()).select(
        F.col("origin_id").alias("s_yarn_store_id"), F.col("id").alias("yarn_library_id")
    )
    rows = price.filter(F.col("s_price").isNotNull()).join(known, "s_yarn_store_id")
    rows = rows.select(
        F.col("s_inquiry_date").alias("inquiry_date"),
        F.col("s_price").alias("price"),
        "yarn_library_id",
        F.col("s_yarn_price_id").alias("origin_id"),
    )
    return merge.insert_missing(target, rows, ["origin_id"])


def serial_codes(library: DataFrame) -> DataFrame:
    """A serial code for every yarn that has none."""
    return numbering.allocate_codes(library, ["id"], "yarn_code", CODE_PREFIX)
