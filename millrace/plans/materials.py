"""Materials, colours, variants and their partners.

Every insert carries its natural key, so a second run adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank_to_null, bracket_ids, document, first_known, json_field
from millrace.operators import keys, lookup, merge

# Natural key of a fabric, and the placeholder for unknown text.
FABRIC_KEY = ["s_material_name", "s_fabric_composition", "s_weight"]
PLACEHOLDER = "/"


def name_json(column: str) -> Column:
    return document(F.struct(F.col(column).alias("zh_CN")))


def fabrics(price: DataFrame, units: DataFrame) -> DataFrame:
    """Fabrics whose (name, composition, weight) has a single unit.

    A lot without supplier or name is no fabric.
    """
    named = price.filter(F.col("s_supplier_name").isNotNull() & F.col("s_material_name").isNotNull())
    rows = named.select(*FABRIC_KEY, F.lower("s_unit").alias("_unit")).distinct()
    rows = lookup.lookup(rows, units, {"_unit": "code"}, {"unit_id": "id"}).drop("_unit")
    return keys.unambiguous_rows(rows, FABRIC_KEY)


def add_fabrics(
    target: DataFrame, templates: DataFrame, price: DataFrame, units: DataFrame, type_id: Column
) -> tuple[DataFrame, DataFrame]:
    """(materials, templates) with the new fabrics. ``target``: id, name (JSON),
    weight_value, composition, unit_id, type_id, template_id."""
    rows = fabrics(price, units).select(
        name_json("s_material_name").alias("name"),
        F.col("s_weight").alias("weight_value"),
        F.col("s_fabric_composition").alias("composition"),
        "unit_id",
        type_id.alias("type_id"),
    )
    key = ["name", "weight_value", "composition"]
    # Null parts count as equal here, or a second run would add such a fabric again.
    known = target.select(*key).distinct()
    matches = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    new = rows.alias("a").join(known.alias("b"), matches, "left_anti")
    return merge.insert_with_sidecar(target, templates, new, key, "template_id")


def add_with_template(
    target: DataFrame, templates: DataFrame, candidates: DataFrame, key: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Next (target, templates): every candidate under a new id, with a template row of its own.

    The candidates are those of one of the jobs below, which leave out what the target has by its
    natural key; a second run therefore has no candidates and adds neither rows nor templates.
    """
    return merge.insert_with_sidecar(target, templates, candidates, key, "template_id")


def accessories(material: DataFrame, units: DataFrame, known: DataFrame) -> DataFrame:
    """The latest accessory of every name that the target lacks.

    The rival may be a deleted row, so the latest is taken before the filters.
    """
    latest = keys.latest_per_key(
        material.select("s_material_id", "s_material_name", "s_unit", "is_delete"), ["s_material_name"], "s_material_id"
    )
    live = latest.filter(
        F.col("s_material_name").isNotNull() & (F.col("is_delete") == 0) & F.col("s_unit").isNotNull()
    )
    measured = live.join(units.select(F.col("name").alias("s_unit"), F.col("id").alias("unit_id")), "s_unit")
    return lookup.missing_from(measured, known, {"s_material_id": "origin_fl_id"}).select(
        F.col("s_material_id").alias("origin_fl_id"), name_json("s_material_name").alias("name"), "unit_id"
    )


def _material_keys(materials: DataFrame) -> DataFrame:
    return materials.select(
        F.col("id").alias("material_id"),
        json_field("name", "zh_CN").alias("s_material_name"),
        F.col("weight_value").alias("s_weight"),
        F.col("composition").alias("s_fabric_composition"),
    )


def new_colours(price: DataFrame, materials: DataFrame, colours: DataFrame) -> DataFrame:
    """Trimmed colour names of known materials that the colour table lacks (``NOT IN``)."""
    used = price.join(_material_keys(materials), FABRIC_KEY, "left_semi")
    names = used.select(F.trim("s_color_name").alias("name")).distinct()
    listed = colours.select(F.trim(json_field("name", "zh_CN")).alias("name"))
    return lookup.anti_null_aware(names, "name", listed, "name")


def fabric_variants(
    price: DataFrame, materials: DataFrame, colours: DataFrame, known: DataFrame
) -> DataFrame:
    """Latest price row per (material, colour), with width and a regular number."""
    latest = keys.latest_per_key(price, [*FABRIC_KEY, "s_color_name"], "s_material_price_id")
    chosen = latest.filter(
        F.col("s_supplier_name").isNotNull()
        & F.col("s_material_name").isNotNull()
        & F.col("s_width").isNotNull()
        & ~F.col("s_new_material_num").like("-%")
    )
    named = colours.select(json_field("name", "zh_CN").alias("s_color_name"), F.col("id").alias("color_id"))
    rows = chosen.join(named, "s_color_name").join(_material_keys(materials), FABRIC_KEY)
    return lookup.missing_from(rows, known, {"s_material_price_id": "origin_id"}).select(
        F.col("s_material_price_id").alias("origin_id"),
        F.col("s_width").alias("name"),
        F.col("s_new_material_num").alias("code"),
        F.col("s_development_price").try_cast("decimal(18,2)").alias("price"),
        "color_id",
        "material_id",
        F.col("s_remark").alias("memo"),
        F.col("gmt_create").alias("create_date"),
        F.col("gmt_modified").alias("write_date"),
    )


def accessory_variants(
    price: DataFrame, materials: DataFrame, colours: DataFrame, known: DataFrame, accessory: DataFrame
) -> DataFrame:
    """Latest price row per (material, colour) of materials that some supplier offers
    in exactly one price row.

    ``materials``: id, origin_fl_id; the accessory itself (``accessory``: s_material_id) must be known too.
    """
    linked = materials.filter(F.col("origin_fl_id").isNotNull()).select(
        F.col("origin_fl_id").alias("s_material_id"), F.col("id").alias("material_id")
    )
    offered = price.join(linked, "s_material_id", "left_semi").join(accessory, "s_material_id", "left_semi")
    single = keys.singleton_groups(offered, ["s_material_id", "s_supplier_id"])
    latest = keys.latest_per_key(price, ["s_color", "s_material_id"], "s_price_id")
    named = colours.select(json_field("name", "zh_CN").alias("s_color"), F.col("id").alias("color_id"))
    rows = (
        latest.join(single.select("s_material_id").distinct(), "s_material_id", "left_semi")
        .join(named, "s_color")
        .join(linked, "s_material_id")
    )
    return lookup.missing_from(rows, known, {"s_price_id": "origin_fl_id"}).select(
        F.col("s_price_id").alias("origin_fl_id"),
        "color_id",
        F.col("s_standards").alias("name"),
        F.col("s_bulk_price").try_cast("decimal(18,2)").alias("price"),
        "material_id",
    )


def new_attribute_values(tree: DataFrame, parent: int, known_codes: DataFrame) -> DataFrame:
    """Live children of a tree node whose code the attribute lacks (``NOT IN``)."""
    children = tree.filter((F.col("s_tree_pid") == parent) & (F.col("is_delete") == 0))
    rows = children.select(
        F.col("s_code").alias("code"),
        document(F.struct(F.col("s_name").alias("zh_CN"), F.col("s_en_name").alias("en_US"))).alias("name"),
    )
    return lookup.anti_null_aware(rows, "code", known_codes, "code")


def partners(supplier: DataFrame, countries: DataFrame, areas: DataFrame, known: DataFrame) -> DataFrame:
    """Latest live supplier per name that the target lacks, with its places as text.

    A rival counts even if it is deleted, so the latest is taken first.
    """
    named = supplier.withColumns(
        {
            "_name": first_known("s_supplier_name", "s_supplier_short_name"),
            "_short": first_known("s_supplier_short_name", "s_supplier_name"),
        }
    )
    latest = keys.latest_per_key(named, ["_name"], "s_supplier_id").filter(F.col("is_delete") == 0)
    new = lookup.missing_from(latest, known, {"s_supplier_id": "origin_id"})
    placed = lookup.resolve_places(new, "s_country_id", countries, areas, bracket_ids("s_country_id", 4))
    places = F.concat(*[F.coalesce(f"place_{i}", F.lit("")) for i in range(1, 5)])
    return placed.select(
        F.col("s_supplier_id").alias("origin_id"),
        F.col("_short").alias("short_name"),
        F.col("_name").alias("name"),
        F.col("s_email").alias("email"),
        F.when(F.col("s_country_id").isNotNull(), places).alias("description"),
        F.col("s_remark").alias("memo"),
        F.lit(True).alias("supplier_material"),
    )


def review_partners(company: DataFrame, known: DataFrame, excluded: str, cap: int | None = None) -> DataFrame:
    """Reviewed companies the target lacks, by number; ``cap`` limits one run's candidates."""
    rows = company.filter(
        (F.col("s_company_sort") == "02") & (F.col("is_hidden") == 0) & (F.col("s_company_name") != excluded)
    )
    new = lookup.missing_from(rows, known, {"s_company_id": "origin_fl_id"})
    if cap is not None:
        new = new.orderBy("s_company_num", "s_company_id").limit(cap)
    return new.select(
        F.col("s_company_id").alias("origin_fl_id"),
        F.concat(F.lit("("), "s_company_num", F.lit(")")).alias("code"),
        F.coalesce("s_company_name", F.lit(PLACEHOLDER)).alias("short_name"),
        F.col("s_company_full_name").alias("name"),
        F.col("s_address").alias("address"),
        F.lit(True).alias("supplier_material"),
    )


def _material_partners(partners: DataFrame) -> DataFrame:
    kept = partners.filter(F.col("supplier_material") & F.col("origin_id").isNotNull())
    return kept.select(F.col("origin_id").alias("_supplier"), F.col("id").alias("partner_id"), "currency_id")


def contacts(contact: DataFrame, partners: DataFrame, known: DataFrame) -> DataFrame:
    """Contacts keyed by their own id, so one that comes later still loads."""
    rows = contact.join(_material_partners(partners), F.col("s_supplier_id") == F.col("_supplier"))
    return lookup.missing_from(rows, known, {"id": "origin_id"}).select(
        F.col("id").alias("origin_id"),
        "partner_id",
        F.coalesce("s_contact_name", F.lit(PLACEHOLDER)).alias("name"),
        F.col("s_contact_phone").alias("phone"),
    )


def banks(transfer: DataFrame, partners: DataFrame, known: DataFrame, default_currency: Column, memo: str) -> DataFrame:
    """Bank accounts of material suppliers, in the partner's or the default currency."""
    live = transfer.filter(blank_to_null("s_receiving_unit").isNotNull() & (F.col("is_delete") == 0))
    rows = live.join(_material_partners(partners), F.col("s_company_id") == F.col("_supplier"))
    return lookup.missing_from(rows, known, {"s_id": "origin_id"}).select(
        F.col("s_id").alias("origin_id"),
        "partner_id",
        F.coalesce("currency_id", default_currency).alias("currency_id"),
        F.col("s_receiving_unit").alias("name"),
        F.coalesce("s_opening_bank", F.lit(PLACEHOLDER)).alias("bank_name"),
        F.coalesce("s_bank_account", F.lit(PLACEHOLDER)).alias("code"),
        F.when(F.col("s_default_flag"), F.lit(memo)).alias("memo"),
    )
