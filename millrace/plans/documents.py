"""Nested documents: materials, items, bills of materials, orders, purchases, partners.

Each level is one join and one collect on its parent's id, built bottom-up; there is
no query per row. Every result is (key, part, document): ``part`` counts on when a
list is too long for one document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import (
    any_true, code_map, date_text, document, falsy_to_default, first_number, newer_than, timestamp_text,
)
from millrace.operators import keys, nesting, numbering
from millrace.operators.lookup import lookup
from millrace.operators.skew import hot_keys, small, split_hot
from millrace.session import cut_lineage, release

# Codes of the exchange format. The keys of every document object below (the arguments
# of ``_item``) are fixed by that format too, odd spellings included.
FABRIC, ACCESSORY = "B", "F"
SOURCES = {"M1": 1, "M2": 3, "M3": 2, "M4": 2}

#: Entries (colours x sizes) one material of a bill may repeat in one cell.
CELL_ITEMS = 1_000_000

#: Sizes, colours and overrides up to which a bill's lists are made of its product's in place: each entry looks for its override.
LIST_ITEMS = 256
#: Entries of one product up to which its rows meet in one task.
PRODUCT_ITEMS = 100_000


def _named(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """(prefix_id, prefix_<column>...) of a small master table."""
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("id", *columns)])


def _inner(df: DataFrame, side: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.join(side, F.col(key) == F.col(f"{prefix}_id")).drop(f"{prefix}_id")


def _item(**fields: Column | str | int) -> Column:
    """Document object: a column name stays a column, any Column is taken as it is."""
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


# --- materials ----------------------------------------------------------------


def material_documents(
    material: DataFrame,
    types: DataFrame,
    units: DataFrame,
    categories: DataFrame,
    partners: DataFrame,
    details: DataFrame,
    colours: DataFrame,
    as_of: str,
    interval: str,
) -> DataFrame:
    """Changed materials with their distinct models and colours, numbered from 1."""
    heads = material.filter(newer_than("write_date", as_of, interval))
    heads = _inner(heads, _named(types, "t", "code"), "type_id", "t")
    heads = _inner(heads, _named(units, "u", "name"), "unit_id", "u")
    heads = _inner(heads, _named(categories, "c", "full_code", "name"), "first_id", "c")
    supplier = {"supplier_code": "code", "supplier_name": "name"}
    # The changed rows select their details and head the documents: written once.
    heads = cut_lineage(lookup(heads, partners, {"supplier_id": "id"}, supplier))

    rows = details.select(F.col("material_id").alias("id"), F.col("name").alias("model"), "color_id")
    rows = rows.join(heads.select("id"), "id", "left_semi")
    rows = _inner(rows, _named(colours, "f", "name", "code"), "color_id", "f")
    models = nesting.ordered_values(rows, ["id"], "model", "models")
    # One entry per colour code, whatever names it goes by.
    codes = rows.groupBy("id", "f_code").agg(F.min("f_name").alias("f_name"))
    shades = nesting.nested_collect(codes, ["id"], ["f_code"], F.struct("f_code", "f_name"), "shades")

    start = (F.col("part") - 1) * nesting.MAX_ITEMS + 1
    model_list = F.transform("models", lambda m, i: _item(model=m, orderId=i + start))
    colour_list = F.transform(
        "shades",
        lambda c, i: _item(colorCode=c["f_code"], colorName=c["f_name"], orderId=i + start),
    )
    docs = nesting.attach_parts(heads, ["id"], {"models": models, "shades": shades})
    body = _item(
        code=falsy_to_default("code", F.col("name"), ""),
        name="name",
        createTime=timestamp_text("create_date"),
        mateType=F.when(F.col("t_code") == FABRIC, "1").otherwise("2"),
        state=F.when(F.col("active"), "1").otherwise("0"),
        categoryCode="c_full_code",
        categoryName="c_name",
        unit="u_name",
        element="composition",
        providerCode="supplier_code",
        providerName="supplier_name",
        modelList=model_list,
        colorList=colour_list,
    )
    return docs.select(F.col("id").alias("key"), "part", document(body).alias("document"))


# --- items --------------------------------------------------------------------


def item_documents(
    product: DataFrame,
    masters: Mapping[str, tuple[DataFrame, str, Mapping[str, str]]],
    units: DataFrame,
    product_colours: DataFrame,
    product_sizes: DataFrame,
    colours: DataFrame,
    sizes: DataFrame,
    as_of: str,
    interval: str,
) -> DataFrame:
    """Changed products that have both colours and sizes.

    ``masters`` names optional attributes: label to (table, key column of the
    product, output column to table column). ``sizes``: id, name, sequence, category.
    """
    heads = product.filter(F.col("active") & newer_than("write_date", as_of, interval))
    heads = _inner(heads, _named(units, "u", "name"), "unit_id", "u")
    for table, key, columns in masters.values():
        heads = lookup(heads, table, {key: "id"}, columns)
    heads = cut_lineage(heads)

    ids = heads.select(F.col("id").alias("product_id"))
    shades = _inner(
        product_colours.join(ids, "product_id", "left_semi").withColumn("cid", F.col("color_id")),
        _named(colours, "c", "name", "code"), "color_id", "c",
    )
    colour_list = nesting.nested_collect(
        shades.withColumnRenamed("product_id", "id"), ["id"], ["cid"],
        F.struct("c_code", "c_name"), "shades", sizes=product_colours.withColumnRenamed("product_id", "id"),
    )
    fits = _inner(
        product_sizes.join(ids, "product_id", "left_semi").withColumn("sid", F.col("size_id")),
        _named(sizes, "s", "name", "sequence", "category"), "size_id", "s",
    ).withColumnRenamed("product_id", "id")
    size_list = nesting.nested_collect(
        fits, ["id"], ["s_sequence", "sid"], F.struct("s_name", "s_category"), "fits",
        sizes=product_sizes.withColumnRenamed("product_id", "id"),
    )
    complete = heads.join(colour_list.select("id").distinct(), "id", "left_semi").join(
        size_list.select("id").distinct(), "id", "left_semi"
    )
    first = F.struct("s_sequence", "sid")
    category = fits.groupBy("id").agg(F.min_by("s_category", first).alias("category"))
    complete = complete.join(category, "id")

    start = (F.col("part") - 1) * nesting.MAX_ITEMS + 1
    one = F.lit(1)
    blank = F.lit("")
    optional = [c for _, _, columns in masters.values() for c in columns]
    body = _item(
        code="design_no",
        name="name",
        sizeCode=blank,
        sizeName=F.coalesce("category", blank),
        unit="u_name",
        **{c: c for c in optional},
        creater=blank,
        createDate=blank,
        sex=F.lit("/"),
        customerItem="design_no",
        state=one,
        remark="memo",
        colorList=F.transform(
            "shades",
            lambda c, i: _item(colorCode=c["c_code"], colorName=c["c_name"], orderId=i + start, state=one),
        ),
        sizeList=F.transform(
            "fits",
            lambda s, i: _item(sizeCode=s["s_name"], sizeName=s["s_name"], orderId=i + start, state=one),
        ),
    )
    docs = nesting.attach_parts(complete, ["id"], {"shades": colour_list, "fits": size_list})
    return docs.select(F.col("id").alias("key"), "part", document(body).alias("document"))


# --- bills of materials -------------------------------------------------------


def bom_rows(
    bom: DataFrame, product: DataFrame, material: DataFrame, types: DataFrame, cap: int | None = None,
    extra: Sequence[str] = (),
):
    """Active fabric and accessory rows per product, ordered by type, sequence, id, and what they were cut from, to be
    released with them.

    ``cap`` limits the rows per product; only a report that lists so many asks for it. ``extra`` names more
    columns of the material to take along.
    """
    live = product.filter(F.col("active")).select(F.col("id").alias("product_id"))
    # Written before the materials are joined: by then the shuffles of all rows are gone.
    own = cut_lineage(bom.filter(F.col("active")).join(live, "product_id").drop("active"))
    listed = types.filter(F.col("code").isin(FABRIC, ACCESSORY))
    listed = listed.select(F.col("id").alias("type_id"), F.col("code").alias("type_code"))
    m = material.join(listed, "type_id").select(
        F.col("id").alias("material_id"), "type_id", "type_code",
        F.col("code").alias("m_code"), F.col("name").alias("m_name"), "composition", "weight", "price", *extra,
    )
    rows = own.join(m, "material_id").withColumnRenamed("id", "bom_id")
    if cap is not None:
        order = ["type_id", "sequence", "bom_id"]
        rows = keys.top_n_per_group(rows, ["product_id"], order, cap).drop("rank")
    return rows, own


def _own_sizes(rows: DataFrame, product_sizes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(product_id, sid, sequence, size name) of the products of ``rows``."""
    own = product_sizes.join(rows, "product_id", "left_semi").withColumn("sid", F.col("size_id"))
    own = _inner(own, _named(sizes, "s", "name", "sequence"), "size_id", "s")
    return own.select("product_id", "sid", "s_sequence", "s_name")


def _own_colours(rows: DataFrame, product_colours: DataFrame, colours: DataFrame) -> DataFrame:
    """(product_id, cid, name and code of the product colour) of the products of ``rows``."""
    own = product_colours.join(rows, "product_id", "left_semi").withColumn("cid", F.col("color_id"))
    own = _inner(own, _named(colours, "b", "name", "code"), "color_id", "b")
    return own.select("product_id", "cid", "b_name", "b_code")


def bom_sizes(rows: DataFrame, own_sizes: DataFrame, overrides: DataFrame) -> DataFrame:
    """(bom_id, sequence, size name, spec): the override of the size, else the common spec."""
    own = rows.select("bom_id", "product_id", "common_spec").join(own_sizes, "product_id")
    given = overrides.select(F.col("parent_id").alias("bom_id"), F.col("size_id").alias("sid"), F.col("value").alias("given"))
    merged = own.join(given, ["bom_id", "sid"], "left")
    merged = merged.withColumn("spec", F.coalesce("given", "common_spec"))
    return merged.select("bom_id", "sid", "s_sequence", "s_name", "spec")


def bom_colours(rows: DataFrame, own_colours: DataFrame, overrides: DataFrame, colours: DataFrame) -> DataFrame:
    """(bom_id, product colour, material colour): the override of that colour, else the common one."""
    own = rows.select("bom_id", "product_id", "material_id", "common_color").join(own_colours, "product_id")
    given = overrides.select(F.col("parent_id").alias("bom_id"), F.col("color_id").alias("cid"), F.col("value").alias("given"))
    merged = own.join(given, ["bom_id", "cid"], "left")
    merged = merged.withColumn("mate_color", F.coalesce("given", "common_color"))
    merged = merged.withColumn("mid", F.col("mate_color"))
    return _inner(merged, _named(colours, "c", "name", "code"), "mate_color", "c").select(
        "bom_id", "material_id", "cid", "mid", "b_name", "b_code", "c_name", "c_code"
    )


def _offers(details: DataFrame) -> DataFrame:
    """Lowest price per (material_id, mid, spec)."""
    return (
        details.groupBy(F.col("material_id"), F.col("color_id").alias("mid"), F.col("name").alias("spec"))
        .agg(F.min("price").alias("price"))
        .filter(F.col("spec").isNotNull())
    )


def _cheapest() -> Column:
    return F.min(F.struct(F.col("price").isNull(), "price", "spec")).alias("b")  # without a price last


def bom_prices(colours: DataFrame, sizes: DataFrame, details: DataFrame) -> DataFrame:
    """Cheapest detail per BOM colour among the specs of the BOM row."""
    wanted = sizes.select("bom_id", "spec").distinct()
    hits = colours.select("bom_id", "material_id", "cid", "mid", "c_name", "c_code").join(
        _offers(details), ["material_id", "mid"]
    )
    hits = hits.join(wanted, ["bom_id", "spec"], "left_semi")
    best = hits.groupBy("bom_id", "cid", "c_name", "c_code").agg(_cheapest())
    return best.select("bom_id", "cid", "c_name", "c_code", F.col("b.price").alias("price"), F.col("b.spec").alias("spec"))


def _lists_by_rows(
    rows: DataFrame, own_sizes: DataFrame, own_colours: DataFrame, size_overrides: DataFrame, colour_overrides: DataFrame,
    colours: DataFrame, details: DataFrame, hot: DataFrame | None, max_items: int, whole: str | None,
) -> DataFrame:
    """BOM rows with their lists, each list collected from rows of its own: for bills of any size and repeated ids."""
    size_rows = cut_lineage(bom_sizes(rows, own_sizes, size_overrides))
    colour_rows = cut_lineage(bom_colours(rows, own_colours, colour_overrides, colours))
    price_rows = bom_prices(colour_rows, size_rows, details)
    size_rank = F.struct("s_sequence", "sid")
    first_spec = size_rows.filter(F.col("spec") != "").groupBy("bom_id").agg(
        F.min_by("spec", size_rank).alias("model")
    )
    headed = rows.join(first_spec, "bom_id", "left")
    lists = {
        "size_list": (size_rows, ["s_sequence", "sid"], F.struct("s_name", "spec")),
        "colour_list": (colour_rows, ["cid"], F.struct("b_code", "b_name", "c_code", "c_name")),
        "price_list": (price_rows, ["cid"], F.struct("c_code", "c_name", "spec", "price")),
    }
    return nesting.collect_lists(headed, ["bom_id"], lists, hot, max_items, whole, CELL_ITEMS)


def _gathered(rows: DataFrame, extras: Mapping[str, tuple[DataFrame, Sequence[str]]], own: Mapping[str, tuple[DataFrame, Sequence[str]]]):
    """``rows`` with arrays of what belongs to each (``extras``: tables by product_id and bom_id) and to its product
    (``own``: tables by product_id), an empty one where there is nothing; dealt by product_id, in one shuffle of each table.

    A bom_id stands for one row here.
    """
    pair = ["product_id", "bom_id"]
    fields = [c for c in rows.columns if c not in pair]
    shape = {"_row": (rows, fields), **extras}
    tagged = None
    for name, (table, columns) in shape.items():
        kind = F.struct(*columns)
        one = table.select(*pair, kind.alias(name))
        tagged = one if tagged is None else tagged.unionByName(one, allowMissingColumns=True)
    # Only a record's own field is filled, and collecting leaves out nulls.
    met = tagged.repartition("product_id").groupBy(*pair).agg(*[F.collect_list(n).alias(n) for n in shape])
    met = met.filter(F.size("_row") > 0).select(*pair, F.col("_row")[0].alias("_row"), *extras)
    for name, (table, columns) in own.items():
        each = table.select("product_id", F.struct(*columns).alias(name)).repartition("product_id")
        met = met.join(each.groupBy("product_id").agg(F.collect_list(name).alias(name)), "product_id", "left")
        met = met.withColumn(name, F.coalesce(name, F.array()))
    return met.select(*pair, *[F.col("_row")[c].alias(c) for c in fields], *extras, *own)


def _specs(size: Column) -> Column:
    """Specs of a product size (with ``sid``): what overrides it in ``given_sizes``, else the common spec."""
    given = F.filter("given_sizes", lambda g: g["sid"] == size["sid"])
    return F.when(F.size(given) == 0, F.array("common_spec")).otherwise(
        F.transform(given, lambda g: F.coalesce(g["given"], F.col("common_spec")))
    )


def _mates(colour: Column) -> Column:
    """(mid, entries) of a product colour (with ``cid``), as ``_specs``: ``given_colours``, else the common colour."""
    common = F.struct(F.col("common_color").alias("mid"), F.col("common_entries").alias("entries"))
    given = F.filter("given_colours", lambda g: g["cid"] == colour["cid"])
    return F.when(F.size(given) == 0, F.array(common)).otherwise(
        F.transform(given, lambda g: F.when(g["mid"].isNull(), common).otherwise(F.struct(g["mid"], g["entries"])))
    )


def _lists_by_product(
    rows: DataFrame, own_sizes: DataFrame, own_colours: DataFrame, given_sizes: DataFrame, given_colours: DataFrame,
    details: DataFrame, max_items: int, whole: str | None,
) -> DataFrame:
    """``_lists_by_rows`` for bills of up to ``LIST_ITEMS`` entries whose bom_id is theirs alone, dealt by product_id.

    Sizes and colours travel once per product, overrides and prices as they are, and meet in the product's task: the
    products of rows with sizes and colours are never written.
    """
    given = {"given_sizes": (given_sizes, ["sid", "given"]), "given_colours": (given_colours, ["cid", "mid", "entries"])}
    # Prices first: each material colour of a row once, with the specs it may have.
    slim = _gathered(
        rows.select("product_id", "bom_id", "material_id", "common_spec", "common_color", F.lit(None).cast("int").alias("common_entries")),
        {**given, "given_colours": (given_colours.withColumn("entries", F.lit(None).cast("int")), ["cid", "mid", "entries"])},
        {"sizes": (own_sizes, ["sid"]), "colours": (own_colours, ["cid"])},
    )
    mids = F.transform(F.flatten(F.transform("colours", _mates)), lambda m: m["mid"])
    asked = slim.select(
        "product_id", "bom_id", "material_id", F.array_distinct(F.flatten(F.transform("sizes", _specs))).alias("specs"),
        F.explode(F.array_distinct(mids)).alias("mid"),
    ).filter(F.size("specs") > 0)
    asked = cut_lineage(asked.filter(F.col("mid").isNotNull()))
    hits = asked.join(_offers(details), ["material_id", "mid"]).filter(F.array_contains("specs", F.col("spec")))
    best = cut_lineage(hits.groupBy("product_id", "bom_id", "mid").agg(_cheapest()))
    release(asked)

    met = _gathered(
        rows.drop("material_id"), {**given, "best": (best, ["mid", "b"])},
        {"sizes": (own_sizes, ["s_sequence", "sid", "s_name"]), "colours": (own_colours, ["cid", "b_code", "b_name"])},
    )
    fits = F.transform(
        "sizes",
        lambda s: F.transform(_specs(s), lambda v: F.struct(s["s_sequence"], s["sid"], s["s_name"], v.alias("spec"))),
    )
    shades = F.transform(
        "colours",
        lambda c: F.flatten(F.transform(_mates(c), lambda m: F.transform(
            F.coalesce(m["entries"], F.array()),
            lambda e: F.struct(c["cid"], c["b_code"], c["b_name"], e["c_code"], e["c_name"], m["mid"]),
        ))),
    )
    met = met.withColumns({"fits": F.sort_array(F.flatten(fits)), "shades": F.sort_array(F.flatten(shades))})
    priced = F.transform(
        "shades",
        lambda c: F.transform(
            F.filter("best", lambda x: x["mid"] == c["mid"]),
            lambda x: F.struct(F.struct(c["cid"], c["c_code"], c["c_name"]).alias("of"), x["b"].alias("b")),
        ),
    )
    met = met.withColumn("priced", F.sort_array(F.flatten(priced)))

    def leads(x: Column, i: Column) -> Column:
        """Whether a colour's cheapest offer, which is sorted first, stands here."""
        return (i == 0) | ~F.get("priced", i - 1)["of"].eqNullSafe(x["of"])

    met = met.withColumns({
        "model": F.get(F.filter("fits", lambda s: s["spec"] != ""), F.lit(0))["spec"],
        "size_list": F.transform("fits", lambda s: F.struct(s["s_name"], s["spec"])),
        "colour_list": F.transform("shades", lambda c: F.struct(c["b_code"], c["b_name"], c["c_code"], c["c_name"])),
        "price_list": F.transform(
            F.filter("priced", leads),
            lambda p: F.struct(p["of"]["c_code"], p["of"]["c_name"], p["b"]["spec"], p["b"]["price"]),
        ),
    })
    met = met.drop("fits", "shades", "priced", "sizes", "colours", "best", "common_spec", "common_color", "common_entries", *given)
    if whole is not None:
        met = met.withColumn(f"{whole}_whole", F.col(whole))
    return nesting.cut_parts(met, ["size_list", "colour_list", "price_list"], max_items)


def _apart(rows: DataFrame, entries: DataFrame, overrides: Sequence[DataFrame], max_items: int):
    """(bom_ids, null among them, that need lists collected by rows, those with ``max_items`` entries, products with many); all None if there are none.

    ``entries`` holds a row (product_id) for each size and colour. Counts are sums over keys, so no group is gathered.
    """
    per_product = entries.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    counted = rows.select("product_id", "bom_id").join(per_product, "product_id", "left")
    counted = cut_lineage(counted.select("product_id", "bom_id", F.coalesce("n", F.lit(0)).alias("n"), F.lit(1).alias("rows")))
    members = counted.drop("product_id")
    for given in overrides:
        members = members.unionByName(given.select("bom_id", F.lit(1).alias("n"), F.lit(0).alias("rows")))
    hot = hot_keys(members, ["bom_id"], max_items, "n")
    held = members.groupBy("bom_id").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    found = held.filter((F.col("n") > LIST_ITEMS) | (F.col("rows") > 1) | F.col("bom_id").isNull()).select("bom_id")
    # A product's rows meet in one task, so a product with many is not dealt by product either.
    crowded = counted.groupBy("product_id").agg(F.sum(F.col("n") + 1).alias("n")).filter(F.col("n") > PRODUCT_ITEMS)
    found = found.unionByName(counted.join(crowded.select("product_id"), "product_id", "left_semi").select("bom_id"))
    if hot is not None:
        found = found.unionByName(hot)
    found = cut_lineage(found.distinct())
    release(counted)
    if found.isEmpty():
        return None, None, None
    return small(found), hot, small(cut_lineage(per_product.filter(F.col("n") > LIST_ITEMS).select("product_id")))


def bom_materials(
    bom: DataFrame,
    product: DataFrame,
    material: DataFrame,
    types: DataFrame,
    units: DataFrame,
    partners: DataFrame,
    supplier_types: DataFrame,
    part_names: DataFrame,
    product_sizes: DataFrame,
    product_colours: DataFrame,
    size_overrides: DataFrame,
    colour_overrides: DataFrame,
    sizes: DataFrame,
    colours: DataFrame,
    details: DataFrame,
    form: str = "item",
    cap: int | None = None,
    max_items: int = nesting.MAX_ITEMS,
    wanted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(BOM rows, material objects with product_id, type_code and ordering columns, and what to
    measure the products by: as many rows as objects).

    ``wanted`` (product_id) restricts the work to these products before anything is expanded. A
    colour carries all sizes in whichever part it stands; a row whose colours and sizes do not fit
    one cell fails by name.
    ``form`` is "item" or "order": the two consumers name and type some fields differently.
    Rows, sizes and colours of the products and overrides feed several lists each, so they are written once. They meet
    where the documents are made; only bills too long for that, and repeated ids, are collected from rows of their own.
    """
    if wanted is not None:
        bom = bom.join(wanted.select("product_id").distinct(), "product_id", "left_semi")
    # Looked up per material, of which there are fewer than rows.
    named = lookup(material, units, {"unit_id": "id"}, {"mate_unit": "name"})
    named = lookup(named, units, {"min_package_unit_id": "id"}, {"pack_unit": "name"})
    named = lookup(named, partners, {"supplier_id": "id"}, {"provider_code": "code", "provider_name": "name"})
    extra = ["mate_unit", "pack_unit", "provider_code", "provider_name"]
    rows, own = bom_rows(bom, product, named, types, cap, extra)
    rows = lookup(rows, supplier_types, {"supplier_type_id": "id"}, {"source_code": "code"})
    rows = lookup(rows, part_names, {"parts_id": "id"}, {"part_name": "name"})
    shade = _named(colours, "c", "name", "code").groupBy("c_id").agg(F.collect_list(F.struct("c_code", "c_name")).alias("entries"))
    rows = lookup(rows, shade, {"common_color": "c_id"}, {"common_entries": "entries"})
    rows = cut_lineage(rows.drop("supplier_type_id", "parts_id"))
    release(own)

    ids = rows.select("product_id", "bom_id")
    own_sizes = cut_lineage(_own_sizes(ids, product_sizes, sizes))
    own_colours = cut_lineage(_own_colours(ids, product_colours, colours))
    given_sizes = size_overrides.select(F.col("parent_id").alias("bom_id"), F.col("size_id").alias("sid"), F.col("value").alias("given"))
    given_sizes = cut_lineage(given_sizes.join(ids, "bom_id"))
    given_colours = colour_overrides.select(F.col("parent_id").alias("bom_id"), F.col("color_id").alias("cid"), F.col("value").alias("mid"))
    given_colours = cut_lineage(lookup(given_colours.join(ids, "bom_id"), shade, {"mid": "c_id"}, {"entries": "entries"}))

    entries = own_sizes.select("product_id").unionByName(own_colours.select("product_id"))
    apart, hot, wide = _apart(rows, entries, [given_sizes, given_colours], max_items)
    is_item = form == "item"
    whole = "size_list" if is_item else None

    def narrow(df: DataFrame) -> DataFrame:
        return df if wide is None else df.join(wide, "product_id", "left_anti")

    def alone(df: DataFrame) -> DataFrame:
        return df if apart is None else split_hot(df, apart, ["bom_id"])[0]

    full = _lists_by_product(
        alone(rows), narrow(own_sizes), narrow(own_colours), alone(given_sizes), alone(given_colours), details, max_items, whole
    )
    if apart is not None:
        large = _lists_by_rows(
            split_hot(rows, apart, ["bom_id"])[1], own_sizes, own_colours, size_overrides, colour_overrides, colours, details, hot, max_items, whole
        )
        full = full.unionByName(large.select(*full.columns))

    def amount(c: Column) -> Column:
        return c.cast("string") if is_item else c.cast("double")

    quantity = F.col("quantity").cast("string")
    model = F.coalesce("model", F.lit(""))
    fits = F.transform(
        "size_list", lambda s: _item(sizeCode=s["s_name"], sizeName=s["s_name"], model=s["spec"], qty=quantity)
    )
    offers = F.transform(
        "price_list",
        lambda p: _item(colorCode=p["c_code"], colorName=p["c_name"], model=p["spec"], price=amount(p["price"])),
    )
    zero, one = F.lit(0), F.lit(1)
    if is_item:
        # Computed once per row: every colour repeats the sizes.
        every = F.transform(
            "size_list_whole",
            lambda s: _item(sizeCode=s["s_name"], sizeName=s["s_name"], model=s["spec"], qty=quantity),
        )
        full = full.withColumn("every", _fitting("bom_id", "colour_list", "size_list_whole", every))
        shades = F.transform(
            "colour_list",
            lambda c: _item(
                itemColorCode=c["b_code"], itemColorName=c["b_name"], colorCode=c["c_code"],
                colorName=c["c_name"], mateSizeList=F.col("every"),
            ),
        )
    else:
        shades = F.transform(
            "colour_list",
            lambda c: _item(
                orderColorCode=c["b_code"], orderColorName=c["b_name"], colorCode=c["c_code"],
                colorName=c["c_name"], model=model, price=amount(F.col("price")), wastRate=zero,
                sizeQty=zero, remark=F.lit(""),
            ),
        )
    common = dict(
        mateCode="m_code",
        mateName="m_name",
        mateUnit="mate_unit",
        mateSource=code_map("source_code", SOURCES, default=1),
        unit=falsy_to_default("pack_unit", F.col("mate_unit"), ""),
        providerCode="provider_code",
        providerName="provider_name",
        price=amount(F.col("price")),
        element="composition",
        model=model,
        weight=first_number("weight"),
        wastRate=zero,
        part="part_name",
        remarks="memo",
    )
    own = dict(mate5ource=one, colorList=shades) if is_item else dict(termType=one, mateColorList=shades)
    entry = _item(**common, **own, mateSizeList=fits, mateColorPriceList=offers)
    materials = full.select(
        "product_id", "type_code", "type_id", "sequence", "bom_id", F.col("part").alias("piece"), entry.alias("entry")
    )
    return rows, materials, rows if hot is None else materials


def _fitting(key: str, outer: str, inner: str, value: Column) -> Column:
    """``value`` where ``outer`` times ``inner`` entries fit one cell; else the job fails and names the key."""
    size = F.size(outer).cast("long") * F.size(inner)
    message = F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(": too many entries for one cell"))
    return F.when(size > CELL_ITEMS, F.raise_error(message)).otherwise(value)


def bom_documents(
    rows: DataFrame, materials: DataFrame, sizes: DataFrame, heads: DataFrame, head_field: str, require_all: bool
) -> DataFrame:
    """BOM documents of the heads (product_id, key, head text): fabrics and accessories apart.

    ``require_all`` asks for both lists, otherwise one is enough. The gate looks at
    the product's rows, not at one part of its document.
    """
    kinds = F.collect_set("type_code")
    passed = rows.groupBy("product_id").agg(F.size(kinds).alias("kinds"))
    passed = passed.filter(F.col("kinds") == (2 if require_all else F.col("kinds"))).select("product_id")
    order = ["type_id", "sequence", "bom_id", "piece"]
    lists = nesting.split_collect(
        materials.join(passed, "product_id", "left_semi"), ["product_id"], "type_code",
        {"fabrics": FABRIC, "accessories": ACCESSORY}, order, F.col("entry"), sizes=sizes,
    )
    docs = heads.join(lists, "product_id")
    body = F.struct(
        F.col("head").alias(head_field),
        F.col("fabrics").alias("fabricBOMList"),
        F.col("accessories").alias("accessBOMList"),
    )
    return docs.select("key", "part", document(body).alias("document"))


def item_heads(
    product: DataFrame, product_colours: DataFrame, product_sizes: DataFrame, as_of: str, interval: str
) -> DataFrame:
    """(product_id, design_no) of the changed active products that have colours and sizes."""
    changed = product.filter(F.col("active") & newer_than("write_date", as_of, interval))
    heads = changed.select(F.col("id").alias("product_id"), "design_no")
    return heads.join(product_colours, "product_id", "left_semi").join(product_sizes, "product_id", "left_semi")


# --- orders -------------------------------------------------------------------


def order_heads(
    orders: DataFrame,
    lines: DataFrame,
    batches: DataFrame,
    quantities: DataFrame,
    product: DataFrame,
    partners: DataFrame,
    users: DataFrame,
    as_of: str,
    interval: str,
) -> DataFrame:
    """Changed order lines that have quantities, with customer, product and first plan date."""
    changed = lines.filter(newer_than("write_date", as_of, interval)).select(
        F.col("id").alias("line_id"), "order_id", "product_id"
    )
    live = orders.filter(F.col("active")).select(
        F.col("id").alias("order_id"), "contract_no", "partner_id", "create_date", "create_uid"
    )
    heads = changed.join(live, "order_id")
    customers = partners.filter(F.col("active")).select(
        F.col("id").alias("partner_id"), F.col("code").alias("cus_code"), F.col("name").alias("cus_name")
    )
    heads = heads.join(customers, "partner_id")
    heads = heads.join(product.select(F.col("id").alias("product_id"), "design_no"), "product_id")
    heads = lookup(heads, users, {"create_uid": "id"}, {"creater": "login"})
    heads = heads.join(quantities.select("line_id").distinct(), "line_id", "left_semi")
    heads = cut_lineage(heads.withColumn("bill_no", F.concat_ws("_", "contract_no", "design_no")))
    # Only the changed lines' batches are grouped.
    own = batches.join(heads.select("line_id"), "line_id", "left_semi")
    first = own.groupBy("line_id").agg(F.min("plan_date").alias("plan_date"))
    return heads.join(first, "line_id", "left")


def order_documents(heads: DataFrame, quantities: DataFrame, colours: DataFrame, sizes: DataFrame) -> DataFrame:
    """Order lines with their colour and size quantities; colours numbered in order."""
    rows = quantities.join(heads.select("line_id"), "line_id", "left_semi")
    rows = rows.withColumn("cid", F.col("color_id")).withColumn("sid", F.col("size_id"))
    rows = _inner(rows, _named(colours, "c", "name", "code"), "color_id", "c")
    rows = _inner(rows, _named(sizes, "s", "name"), "size_id", "s")
    rows = numbering.number_runs(rows, ["line_id"], ["cid"], "colour_no", sizes=quantities)
    item = _item(
        colorErpId="colour_no",
        colorCode="c_code",
        colorName="c_name",
        deliveryDate=date_text("batch_date"),
        po="batch_name",
        qty="value",
        sizeCode="s_name",
        sizeName="s_name",
        outBarCode=F.lit(""),
    )
    order = ["cid", "sid", "batch_date", "batch_name", "value"]
    items = nesting.nested_collect(rows, ["line_id"], order, item, "items", sizes=quantities)
    docs = heads.join(items, "line_id")
    body = _item(
        billNo="bill_no",
        customerCode="cus_code",
        customerName="cus_name",
        depotDeliveryDate=F.coalesce(date_text("plan_date"), F.lit("")),
        createTime=timestamp_text("create_date"),
        creater="creater",
        state=F.lit(1),
        itemCode="design_no",
        itemList="items",
        fillDate=date_text("create_date"),
    )
    return docs.select(F.col("line_id").alias("key"), "part", document(body).alias("document"))


# --- purchases ----------------------------------------------------------------


def purchase_documents(
    purchases: DataFrame,
    purchase_lines: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    product: DataFrame,
    partners: DataFrame,
    currencies: DataFrame,
    users: DataFrame,
    material: DataFrame,
    units: DataFrame,
    colours: DataFrame,
    as_of: str,
    interval: str,
) -> DataFrame:
    """One document per audited purchase and sale order line, materials numbered."""
    audited = purchases.filter(
        F.col("active") & (F.col("state") == "audit") & newer_than("write_date", as_of, interval)
    )
    heads = audited.select(
        F.col("id").alias("order_id"), F.col("name").alias("purchase_no"), "type", "create_date",
        "delivery_date", "tax_rate", "currency_rate", "supplier_id", "currency_id", "create_uid",
    )
    # A purchase meets a sale order line once, however many materials it buys for it.
    changed = purchase_lines.join(heads.select("order_id"), "order_id", "left_semi")
    pairs = changed.select("order_id", "sale_order_line").distinct()
    heads = heads.join(pairs, "order_id")
    sold = lines.select(
        F.col("id").alias("sale_order_line"), F.col("order_id").alias("sale_order"), "product_id"
    )
    heads = heads.join(sold, "sale_order_line")
    heads = heads.join(orders.select(F.col("id").alias("sale_order"), "contract_no"), "sale_order")
    heads = heads.join(product.select(F.col("id").alias("product_id"), "design_no"), "product_id")
    heads = _inner(heads, _named(partners, "b", "code", "name", "phone"), "supplier_id", "b")
    heads = _inner(heads, _named(currencies, "h", "name"), "currency_id", "h")
    heads = cut_lineage(lookup(heads, users, {"create_uid": "id"}, {"creater": "login"}))

    pair = ["order_id", "sale_order_line"]
    bought = purchase_lines.filter(F.col("active")).withColumnRenamed("price", "line_price")
    bought = bought.join(heads.select(*pair), pair, "left_semi")
    bought = _inner(
        bought, _named(material, "m", "code", "name", "weight", "unit_id"), "material_material_id", "m"
    )
    bought = _inner(bought, _named(units, "u", "name"), "m_unit_id", "u")
    bought = _inner(bought, _named(colours, "c", "name", "code"), "material_color_id", "c")
    entry = F.struct(
        "m_code", "m_name", "u_name", "c_code", "c_name", "material_name",
        F.col("quantity").cast("string").alias("qty"),
        first_number("m_weight").alias("weight"),
        F.col("line_price").cast("double").alias("price"),
        F.col("total_price").cast("double").alias("amount"),
    )
    order = ["sequence", "id"]
    lists = nesting.nested_collect(bought, pair, order, entry, "bought", sizes=purchase_lines)
    docs = heads.join(lists, pair)

    start = (F.col("part") - 1) * nesting.MAX_ITEMS + 1
    items = F.transform(
        "bought",
        lambda x, i: _item(
            idx=i + start, mateCode=x["m_code"], mateName=x["m_name"], mateUnit=x["u_name"], qty=x["qty"],
            colorCode=x["c_code"], colorName=x["c_name"], model=x["material_name"], weight=x["weight"],
            currPrice=x["price"], currAmount=x["amount"],
        ),
    )
    order_no = F.concat_ws("_", "contract_no", "design_no")
    tax = F.when(F.coalesce(F.col("tax_rate"), F.lit(0)) == 0, "0.0").otherwise(F.col("tax_rate").cast("string"))
    body = _item(
        billNo=F.concat_ws("_", F.col("purchase_no"), order_no),
        mateType=F.when(F.col("type") == FABRIC, 1).otherwise(2),
        fillDate=date_text("create_date"),
        providerCode="b_code",
        providerName="b_name",
        deliveryDate=date_text("delivery_date"),
        orderBillNO=order_no,
        deliveryType=F.lit(""),
        taxRate=tax,
        currency="h_name",
        exchangeRate=F.col("currency_rate").cast("string"),
        creater="creater",
        checkTime=date_text("create_date"),
        linkTel="b_phone",
        state=F.lit(1),
        wmsPurListList=items,
    )
    return docs.select("order_id", "sale_order_line", "part", document(body).alias("document"))


# --- partners -----------------------------------------------------------------

_PARTNER = {"code": "code", "name": "name", "shortName": "short_name"}
_CONTACT = {"remark": "memo", "linkTel": "phone", "linkAdress": "address"}


def customer_entry(headquarters: bool = False) -> Column:
    extra = {"headquarters": F.lit("")} if headquarters else {}
    return _item(**_PARTNER, **extra, **_CONTACT)


def provider_entry() -> Column:
    kind = F.when(F.col("supplier_material"), "3").otherwise("4")
    return _item(
        providerType=kind, **_PARTNER, linkAdress="address", linkTel="phone", linkName="represent", remark="memo"
    )


def partner_documents(
    partners: DataFrame, roles: tuple[str, ...], entry: Column, as_of: str, interval: str, chunk_rows: int = 500
) -> DataFrame:
    """(chunk, JSON array) of the changed partners that have any of the roles."""
    rows = partners.filter(any_true(*roles) & newer_than("write_date", as_of, interval))
    return nesting.json_chunks(rows, ["id"], entry, chunk_rows, out="document")
