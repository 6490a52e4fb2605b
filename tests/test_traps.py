"""Hand-written rows for the semantics that generated data does not reach."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions import (
    any_true, bracket_ids, code_map, digits_to_long, first_number, localized, newer_than, offset_id,
)
from millrace.operators import keys, lookup, merge, nesting, numbering, tree
from millrace.operators import rows as row_ops
from millrace.plans import audit, documents, erp, materials, org, punches, yarn
from millrace.session import cut_lineage, release

T0 = dt.datetime(2024, 1, 1)


def nodes(frame, *data):
    return frame("id int, parent_id int, name string, code string, deleted_time timestamp_ntz", *data)


def test_t1_null_safe_change_detection(frame):
    target = frame("origin_id int, v string, write_date timestamp_ntz", (1, "a", None), (2, None, None), (3, "c", None), (4, "d", None))
    source = frame("origin_id int, v string", (1, "b"), (2, "x"), (3, None), (4, "d"))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    stamp = ("write_date", now)
    changed = merge.update_changed(target, source, ["origin_id"], ["v"], stamp)
    assert rows(changed, "origin_id", "v") == [(1, "b"), (2, "x"), (3, None), (4, "d")]
    assert rows(changed.filter("write_date is not null"), "origin_id") == [(1,), (2,), (3,)]
    plain = merge.update_changed(target, source, ["origin_id"], ["v"], stamp, null_safe=False)
    assert rows(plain.filter("write_date is not null"), "origin_id") == [(1,)]


def test_t2_update_joins_on_the_key(frame):
    target = frame("id long, origin_id long, name string, active boolean, company_id int", (7, 1, "old", True, 1), (8, 2, '{"zh_CN":"B","en_US":"B"}', True, 1))
    position = frame("s_talent_position_id long, s_position string, s_en_position string, is_delete int", (1, "A", None, 0), (2, "B", None, 0), (3, "C", "Sea", 1))
    out = erp.jobs(target, position, F.lit(1))
    assert rows(out, "id", "name", "active") == [
        (7, '{"zh_CN":"A","en_US":"A"}', True),
        (8, '{"zh_CN":"B","en_US":"B"}', True),
        (9, '{"zh_CN":"C","en_US":"Sea"}', False),
    ]


def test_t3_child_finds_parent_of_the_same_run(frame):
    parents = frame("id long, origin_id long, name string", (5, 1, "a"))
    children = frame("id long, origin_id long, parent_id long, name string", (9, 1, 5, "a"))
    source = frame("origin_id long, name string", (1, "a"), (2, "b"), (3, "c"))
    new_parents, new_children = merge.insert_two_tables(parents, children, source, "origin_id")
    assert rows(new_parents, "id", "origin_id") == [(5, 1), (6, 2), (7, 3)]
    assert rows(new_children, "id", "origin_id", "parent_id") == [(9, 1, 5), (10, 2, 6), (11, 3, 7)]


def test_t4_numeric_guard(frame):
    texts = frame("t string", ("12",), ("1,2",), ("",), (None,), ("99999999999999999999",))
    got = texts.select("t", offset_id(digits_to_long("t"), 10000).alias("v"))
    assert rows(got, "t", "v") == [(None, None), ("", None), ("1,2", None), ("12", 10012), ("99999999999999999999", None)]


def test_t5_missing_parent_is_visible_unless_strict(frame):
    tree_rows = nodes(
        frame, (1, None, "root", None, None), (2, 1, "child", None, None), (3, 1, "gone", None, T0),
        (4, 3, "under deleted", None, None), (5, 99, "dangling", None, None),
    )
    assert rows(tree.visible_rows(tree_rows), "id") == [(1,), (2,), (5,)]
    assert rows(tree.visible_rows(tree_rows, strict=True), "id") == [(1,), (2,)]
    assert rows(tree.dangling_parents(tree_rows), "id") == [(4,)]


def test_t6_null_key_rows_all_stay(frame):
    data = frame("id int, name string, comp string", (1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, "a", None))
    assert rows(keys.latest_per_key(data, ["name", "comp"], "id"), "id") == [(2,), (3,), (4,)]


def test_t7_keys_do_not_collide(frame):
    data = frame("a string, b string, unit int", ("ab", "c", 1), ("a", "bc", 2), ("z", None, 1), ("z", None, 2), ("y", None, 4), ("y", None, 4))
    assert rows(keys.unambiguous_rows(data, ["a", "b"])) == [("a", "bc", 2), ("ab", "c", 1), ("y", None, 4)]


def bom_fixture(frame):
    day = T0
    return dict(
        bom=frame(
            "id long, product_id long, material_id long, quantity decimal(8,2), memo string, parts_id int, "
            "supplier_type_id int, sequence int, common_spec string, common_color int, active boolean",
            (1, 100, 10, D(2), "m", 1, 1, 2, "std", 7, True),
            (2, 100, 11, D(1), None, None, None, 1, None, 7, True),
            (3, 101, 10, D(1), None, None, None, 1, "std", 7, True),
            (4, 100, 12, D(1), None, None, None, 1, "std", 7, True),
            (5, 100, 10, D(9), None, None, None, 1, "std", 7, False),
        ),
        product=frame("id long, design_no string, active boolean", (100, "D100", True), (101, "D101", True), (102, "D102", False)),
        material=frame(
            "id long, code string, name string, composition string, weight string, price decimal(8,2), type_id int, "
            "unit_id int, min_package_unit_id int, supplier_id int",
            (10, "F1", "fab", "cotton", "220g/m2", D("3.5"), 1, 1, None, 1),
            (11, "A1", "zip", None, "", D(1), 2, 1, 2, None),
            (12, "O1", "other", None, "abc", D(1), 3, 1, None, None),
        ),
        types=frame("id int, code string", (1, "B"), (2, "F"), (3, "X")),
        units=frame("id int, name string", (1, "kg"), (2, "box")),
        partners=frame("id int, code string, name string", (1, "S1", "Sup")),
        supplier_types=frame("id int, code string", (1, "M2")),
        part_names=frame("id int, name string", (1, "body")),
        product_sizes=frame("product_id long, size_id int", (100, 1), (100, 2), (101, 1)),
        product_colours=frame("product_id long, color_id int", (100, 5), (100, 6), (101, 5)),
        size_overrides=frame("parent_id long, size_id int, value string", (1, 1, "")),
        colour_overrides=frame("parent_id long, color_id int, value int", (1, 6, 8)),
        sizes=frame("id int, name string, sequence int", (1, "S", 1), (2, "M", 2)),
        colours=frame("id int, name string, code string", (5, "red", "R"), (6, "blue", "B"), (7, "raw", "W"), (8, "navy", "N")),
        details=frame(
            "material_id long, color_id int, name string, price decimal(8,2)",
            (10, 7, "std", D(4)), (10, 7, "std", D(3)), (10, 8, "std", D(9)), (10, 8, "wide", D(1)), (11, 7, "std", D(2)),
        ),
    ), day


def bom_docs(frame, form, require_all):
    import json

    tables, _ = bom_fixture(frame)
    listed = documents.bom_materials(**tables, form=form)
    heads = tables["product"].select(F.col("id").alias("product_id"), F.col("id").alias("key"), F.col("design_no").alias("head"))
    docs = documents.bom_documents(*listed, heads, "itemCode", require_all)
    return {r.key: json.loads(r.document) for r in docs.collect()}


def test_t8_a13_a14_bill_of_materials(frame):
    docs = bom_docs(frame, "item", True)
    # Product 101 has fabrics only, so the strict gate drops it.
    assert set(docs) == {100}
    fabric = docs[100]["fabricBOMList"][0]
    # The colour override touches blue only; red keeps the common colour.
    assert [(c["itemColorName"], c["colorName"]) for c in fabric["colorList"]] == [("red", "raw"), ("blue", "navy")]
    # Size S is overridden by an empty spec, so the model is the first non-empty one.
    assert [s["model"] for s in fabric["mateSizeList"]] == ["", "std"]
    assert fabric["model"] == "std" and fabric["weight"] == 220.0 and fabric["mateSource"] == 3
    assert [(p["colorName"], p["price"]) for p in fabric["mateColorPriceList"]] == [("raw", "3.00"), ("navy", "9.00")]
    zipper = docs[100]["accessBOMList"][0]
    assert zipper["weight"] is None and zipper["unit"] == "box" and zipper["model"] == ""
    assert zipper["mateColorPriceList"] == []


@pytest.mark.parametrize("form", ["item", "order"])
@pytest.mark.parametrize("hot", [True, False])
def test_every_colour_keeps_all_sizes(frame, monkeypatch, form, hot):
    """Parts of two entries, by the hot and by the cold path, add up to the unsplit bill."""
    tables, _ = bom_fixture(frame)
    tables["product_sizes"] = frame("product_id long, size_id int", *[(p, s) for p in (100, 101) for s in range(1, 6)])
    tables["product_colours"] = frame("product_id long, color_id int", *[(p, c) for p in (100, 101) for c in range(20, 25)])
    tables["sizes"] = frame("id int, name string, sequence int", *[(s, f"S{s}", s) for s in range(1, 6)])
    tables["colours"] = frame("id int, name string, code string", (7, "raw", "W"), (8, "navy", "N"), *[(c, f"c{c}", f"C{c}") for c in range(20, 25)])
    found = [frame("bom_id long", (1,), (3,))] if hot else [None]
    monkeypatch.setattr(documents, "hot_keys", lambda *a: found[0])

    def lists(max_items):
        _, materials, _ = documents.bom_materials(**tables, form=form, max_items=max_items)
        out = {}
        for r in sorted(materials.select("bom_id", "piece", "entry").collect(), key=lambda r: (r.bom_id, r.piece)):
            entry = r.entry.asDict(True)
            name = "colorList" if form == "item" else "mateColorList"
            held = out.setdefault(r.bom_id, {"shades": [], "fits": [], "offers": []})
            held["shades"] += entry[name]
            held["fits"] += entry["mateSizeList"]
            held["offers"] += entry["mateColorPriceList"]
        return out

    small = lists(2)
    assert small == lists(1000)
    if form == "item":
        assert all([s["sizeCode"] for s in c["mateSizeList"]] == ["S1", "S2", "S3", "S4", "S5"] for c in small[1]["shades"])


def mixed_bills(frame):
    """Bills with repeated and null ids, shared by products, overrides given twice, with nulls or of unknown colours."""
    tables, _ = bom_fixture(frame)
    tables["bom"] = frame(
        "id long, product_id long, material_id long, quantity decimal(8,2), memo string, parts_id int, "
        "supplier_type_id int, sequence int, common_spec string, common_color int, active boolean",
        (1, 100, 10, D(2), "m", 1, 1, 2, "std", 7, True), (2, 100, 11, D(1), None, None, None, 1, None, 7, True),
        (3, 101, 10, D(1), None, None, None, 1, "std", 8, True), (3, 101, 10, D(4), None, None, None, 1, "wide", 7, True),
        (4, 100, 10, D(1), None, None, None, 3, "std", 9, True), (4, 101, 11, D(1), None, None, None, 3, "std", 7, True),
        (None, 100, 10, D(1), None, None, None, 4, "std", 7, True), (None, 100, 11, D(1), None, None, None, 4, "std", 7, True),
        (5, 103, 10, D(1), "none", None, None, 1, "std", 7, True), (6, 101, 11, D(1), None, None, None, 1, "", None, True),
        (7, 104, 10, D(1), None, None, None, 1, "std", 7, True), (8, 104, 10, D(1), None, None, None, 2, "std", 8, True),
    )
    tables["product"] = frame("id long, design_no string, active boolean", *[(p, f"D{p}", True) for p in (100, 101, 103, 104)])
    tables["product_sizes"] = frame(
        "product_id long, size_id int", *[(p, s) for p in (100, 101) for s in (3, 1, 2, 9)], (100, 2), *[(104, s) for s in range(10, 40)]
    )
    tables["product_colours"] = frame(
        "product_id long, color_id int", *[(p, c) for p in (100, 101) for c in (6, 5, 77)], (101, 5), *[(104, c) for c in range(10, 30)]
    )
    tables["size_overrides"] = frame(
        "parent_id long, size_id int, value string", (1, 1, ""), (1, 2, "wide"), (1, 2, "std"), (2, 1, None), (3, 3, "wide"),
        (None, 1, "std"), (7, 12, "wide"), (9, 1, "std"),
    )
    tables["colour_overrides"] = frame(
        "parent_id long, color_id int, value int", (1, 6, 8), (1, 6, 7), (1, 5, None), (2, 5, 99), (4, 6, 8), (6, 5, 8), (7, 11, 8),
    )
    tables["sizes"] = frame("id int, name string, sequence int", (1, "S", 2), (2, "M", 2), (3, "L", None), *[(s, f"s{s}", -s) for s in range(10, 40)])
    tables["colours"] = frame(
        "id int, name string, code string", (5, "red", "R"), (6, "blue", "B"), (7, "raw", "W"), (8, "navy", "N"), (8, "navy two", "N"),
        *[(c, f"c{c}", None) for c in range(10, 30)],
    )
    tables["details"] = frame(
        "material_id long, color_id int, name string, price decimal(8,2)", (10, 7, "std", D(4)), (10, 7, "std", D(3)),
        (10, 7, "wide", D(3)), (10, 8, "std", None), (10, 8, "wide", D(1)), (11, 7, "std", D(2)), (11, 7, None, D(1)), (11, 8, "", D(7)),
    )
    return tables


@pytest.mark.parametrize("form", ["item", "order"])
def test_lists_by_product_are_those_by_rows(frame, monkeypatch, form):
    """Made in the product's task or collected from rows of their own, bills hold the same."""
    tables = mixed_bills(frame)

    def entries(**bounds):
        for name, bound in bounds.items():
            monkeypatch.setattr(documents, name, bound)
        found = documents.bom_materials(**tables, form=form)[1].collect()
        return sorted(repr((r.product_id, r.type_code, r.type_id, r.sequence, r.bom_id, r.piece, r.entry)) for r in found)

    made = entries(LIST_ITEMS=1000)
    assert len(made) == 12
    assert made == entries(LIST_ITEMS=1000, PRODUCT_ITEMS=100) == entries(LIST_ITEMS=-1)


def test_sizes_and_colours_of_bills_are_not_written_per_row(frame, monkeypatch):
    """30 rows of a product with 40 sizes and 40 colours: nothing of 1,200 rows is written or dealt."""
    tables, _ = bom_fixture(frame)
    row = (D(1), "m", 1, 1, 1, "std", 7, True)
    tables["bom"] = frame(tables["bom"].schema, *[(i, 100, 10, *row) for i in range(30)])
    tables["product_sizes"] = frame("product_id long, size_id int", *[(100, s) for s in range(40)])
    tables["product_colours"] = frame("product_id long, color_id int", *[(100, c) for c in range(40)])
    tables["sizes"] = frame("id int, name string, sequence int", *[(s, f"S{s}", s) for s in range(40)])
    tables["colours"] = frame("id int, name string, code string", *[(c, f"c{c}", f"C{c}") for c in range(40)])
    written = []

    def counted(df):
        cut = cut_lineage(df)
        written.append(cut.count())
        return cut

    monkeypatch.setattr(documents, "cut_lineage", counted)
    found = documents.bom_materials(**tables, form="order")[1].select("entry.mateSizeList", "entry.mateColorList").collect()
    assert [(len(r[0]), len(r[1])) for r in found] == [(40, 40)] * 30
    assert max(written) == 40


def test_a_cut_leaves_no_shuffle_files(spark):
    import time

    def blocks():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {b for b in held.split() if b.startswith("shuffle_")}

    before = blocks()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    cut = cut_lineage(df)
    until = time.time() + 20
    while blocks() - before and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not blocks() - before
    assert cut.count() == 7 == df.count()
    release(cut)
    with pytest.raises(Exception):
        cut.collect()


def test_a_bill_too_large_for_a_cell_is_named(frame, monkeypatch):
    tables, _ = bom_fixture(frame)
    monkeypatch.setattr(documents, "CELL_ITEMS", 3)
    with pytest.raises(Exception, match="bom_id [12]: too many entries"):
        documents.bom_materials(**tables, form="item")[1].collect()


def test_a_hot_list_is_counted_before_it_is_gathered(frame, monkeypatch):
    tables, _ = bom_fixture(frame)
    found = [frame("bom_id long", (1,), (3,))]
    monkeypatch.setattr(documents, "hot_keys", lambda *a: found[0])
    monkeypatch.setattr(documents, "CELL_ITEMS", 0)
    with pytest.raises(ValueError, match="bom_id [13]: [0-9]+ are too many entries"):
        documents.bom_materials(**tables, form="item")


def test_every_row_counts_for_a_hot_key(spark):
    from millrace.operators.skew import hot_keys

    df = spark.range(1000).selectExpr("CASE WHEN id < 300 THEN 7 WHEN id < 599 THEN NULL ELSE id END AS k")
    assert hot_keys(df, ["k"], 1001) is None and hot_keys(df, ["k"], 301) is None
    assert rows(hot_keys(df, ["k"], 300)) == [(7,)] and rows(hot_keys(df, ["k"], 299)) == [(None,), (7,)]


def test_bills_only_of_wanted_products(frame):
    tables, _ = bom_fixture(frame)
    wanted = frame("product_id long", (101,), (101,))
    assert {r.product_id for r in documents.bom_materials(**tables, wanted=wanted)[1].collect()} == {101}


def test_an_offer_without_price_comes_last(frame):
    colours = frame("bom_id long, material_id long, cid int, mid int, c_name string, c_code string", (1, 10, 5, 7, "raw", "W"), (2, 11, 5, 7, "raw", "W"))
    sizes = frame("bom_id long, spec string", (1, "V1"), (1, "V2"), (2, "V1"))
    details = frame("material_id long, color_id int, name string, price decimal(8,2)", (10, 7, "V1", None), (10, 7, "V2", D(5)), (11, 7, "V1", None))
    assert rows(documents.bom_prices(colours, sizes, details), "bom_id", "price", "spec") == [(1, D("5.00"), "V2"), (2, None, "V1")]


def test_order_form_needs_either_list(frame):
    docs = bom_docs(frame, "order", False)
    assert set(docs) == {100, 101}
    assert docs[101]["accessBOMList"] == []
    assert docs[100]["fabricBOMList"][0]["mateColorPriceList"][0]["price"] == 3.0


def test_t9_t16_lists_and_default_roles(frame):
    users = frame("id int, post_ids string, tenant_id int, deleted int", (1, None, 1, 0), (2, None, 1, 0), (3, "[9]", 1, 0), (4, None, 2, 0))
    links = frame("user_id int, post_id int, tenant_id int, deleted boolean", (1, 20, 1, False), (1, 3, 1, False), (1, 3, 1, False), (2, 5, 1, True), (3, 4, 1, False), (4, 1, 2, False))
    assert rows(org.fill_post_lists(users, links), "id", "post_ids") == [(1, "[3,20]"), (2, None), (3, "[9]"), (4, "[1]")]
    roles = frame("id int, code string, tenant_id int", (70, "user", 1), (71, "user", 2))
    added = org.default_roles(users, links, roles, "user", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert rows(added, "user_id", "role_id") == [(2, 70)]


def test_t10_ties_are_broken(frame):
    library = frame("id int, composition_code string", (1, None), (2, "keep"))
    parts = frame("yarn_library_id int, fiber int, proportion double, origin_id int", (1, 1, 0.3, 9), (1, 2, 0.3, 8), (1, 3, 0.3, 7))
    entries = frame("id int, mnemonic_code string", (1, "A"), (2, "B"), (3, "C"))
    assert rows(yarn.composition_codes(library, parts, entries)) == [(1, "CB"), (2, "keep")]


def test_t11_serial_codes(frame):
    fresh = frame("id int, yarn_code string", (1, None), (2, None))
    assert rows(yarn.serial_codes(fresh)) == [(1, "SX00001"), (2, "SX00002")]
    full = frame("id int, yarn_code string", (1, "SX99999"), (2, None), (3, "other"), (4, None))
    assert rows(yarn.serial_codes(full)) == [(1, "SX99999"), (2, "SX100000"), (3, "other"), (4, "SX100001")]


def test_t12_leaf_flag_goes_both_ways(frame):
    data = frame("id int, parent_id int, is_leaf boolean", (1, None, True), (2, 1, False))
    assert rows(tree.leaf_flag(data)) == [(1, None, False), (2, 1, True)]


def test_t13_second_run_adds_nothing(frame):
    price = frame(
        "s_material_price_id int, s_material_name string, s_weight int, s_fabric_composition string, s_color_name string, "
        "s_unit string, s_supplier_name string, s_new_material_num string, s_width int, s_development_price string, "
        "s_remark string, gmt_create timestamp_ntz, gmt_modified timestamp_ntz",
        *[(*r, "m", T0, None) for r in ((1, "a", 1, "x", "red", "KG", "s", "m1", 5, "2.5"), (2, "a", 1, "x", "red", "KG", "s", "m2", 5, "abc"),
        (3, "b", 1, None, "red", "KG", "s", "m3", 5, "1"), (4, "a", 1, "x", "blue", "KG", "s", "-m4", 5, "1"))],
    )
    units = frame("id int, code string", (1, "kg"))
    target = frame("id long, name string, weight_value int, composition string, unit_id int, type_id int, template_id long")
    once, templates = materials.add_fabrics(target, frame("id long"), price, units, F.lit(1))
    assert once.count() == 2 and templates.count() == 2
    twice, more = materials.add_fabrics(once, templates, price, units, F.lit(1))
    assert twice.count() == 2 and more.count() == 2
    colours = frame("id int, name string", (1, '{"zh_CN":"red"}'), (2, '{"zh_CN":"blue"}'))
    found = materials.fabric_variants(price, once, colours, frame("origin_id int"))
    # The latest red row has no readable price; the blue one has a number that starts with a dash.
    assert rows(found, "origin_id", "price") == [(2, None)]
    assert materials.fabric_variants(price, once, colours, found).count() == 0
    empty = found.limit(0).withColumn("id", F.lit(0).cast("long")).withColumn("template_id", F.lit(0).cast("long"))
    first, sides = materials.add_with_template(empty, frame("id long", (40,)), found, ["origin_id"])
    assert rows(first, "origin_id", "id", "template_id") == [(2, 1, 41)] and sides.count() == 2
    again, more = materials.add_with_template(first, sides, materials.fabric_variants(price, once, colours, first), ["origin_id"])
    assert again.count() == 1 and more.count() == 2


def test_t14_late_contact_still_loads(frame):
    partners = frame("id int, origin_id int, supplier_material boolean, currency_id int", (5, 1, True, None), (6, 2, False, None))
    contact = frame("id int, s_supplier_id int, s_contact_name string, s_contact_phone string", (1, 1, "a", "x"), (2, 1, None, "y"), (3, 2, "c", "z"))
    known = frame("origin_id int", (1,))
    assert rows(materials.contacts(contact, partners, known), "origin_id", "name") == [(2, "/")]


def test_t15_no_change_gives_an_empty_result(frame):
    orders = frame("id int, contract_no string, partner_id int, create_date timestamp_ntz, create_uid int, active boolean", (1, "K1", 1, T0, 1, True))
    lines = frame("id int, order_id int, product_id int, write_date timestamp_ntz", (10, 1, 100, T0))
    batches = frame("line_id int, plan_date timestamp_ntz")
    quantities = frame(
        "line_id int, color_id int, size_id int, value int, batch_date timestamp_ntz, batch_name string",
        (10, 6, 1, 3, T0, "b"), (10, 5, 2, 4, T0, "b"), (10, 5, 1, 1, T0, "b"), (10, 6, 2, 2, T0, "b"),
    )
    product = frame("id int, design_no string", (100, "D"))
    partners = frame("id int, code string, name string, active boolean", (1, "C", "Cust", True))
    users = frame("id int, login string")
    colours = frame("id int, name string, code string", (5, "red", "R"), (6, "blue", "B"))
    sizes = frame("id int, name string", (1, "S"), (2, "M"))

    def build(as_of):
        heads = documents.order_heads(orders, lines, batches, quantities, product, partners, users, as_of, "6 hours")
        return documents.order_documents(heads, quantities, colours, sizes).collect()

    assert build("2024-03-01 00:00:00") == []
    import json

    doc = json.loads(build("2024-01-01 02:00:00")[0].document)
    assert doc["depotDeliveryDate"] == "" and doc["creater"] is None and doc["billNo"] == "K1_D"
    assert [(i["colorErpId"], i["sizeName"], i["qty"]) for i in doc["itemList"]] == [(1, "S", 1), (1, "M", 4), (2, "S", 3), (2, "M", 2)]


def test_t16_u10_rows_without_origin(frame):
    target = frame("id int, origin_id int, kind string, active boolean", (1, 1, "e", True), (2, None, "e", True), (3, None, "s", True), (4, 9, "e", True))
    source = frame("origin_id int", (1,))
    assert rows(merge.archive_missing(target, source, ["origin_id"]), "id", "active") == [(1, True), (2, False), (3, False), (4, False)]
    only = merge.deactivate_unlinked(target, "origin_id", only=F.col("kind") == "e")
    assert rows(only, "id", "active") == [(1, True), (2, False), (3, True), (4, True)]


def test_t17_credentials_are_not_carried(frame):
    from millrace.sources.load import LOADS

    source = frame("s_manager_id int, s_account string, s_password string, s_activate_flag int, s_lead_flag boolean", (1, "a", "x", 1, True), (2, "b", "y", 0, False))
    out = LOADS["manager"].extract(source)
    assert "s_password" not in out.columns and rows(out, "s_manager_id", "s_lead_flag") == [(1, 1)]


def test_t18_j21_places_and_missing_email(frame):
    suppliers = frame(
        "s_supplier_id int, s_supplier_name string, s_country_id string, s_email string, is_delete int",
        (1, "a", "[1,2,3]", "m", 0), (2, "b", "[1]", "m", 0), (3, "c", "[]", "m", 0), (4, "d", None, "m", 0),
        (5, "e", "[1,2,3]", None, 0), (6, "f", "[ 1 , 2 ]", "m", 1),
    )
    countries = frame("id int, name string", (1, "CN"))
    areas = frame("id int, name string", (2, "FJ"), (3, "QZ"))
    args = (frame("origin_id int", (99,)), suppliers, countries, areas, frame("id int, name string", (10, "CN")), frame("id int, name string", (20, "FJ")), F.lit(1))
    few = dict(columns={"name": "s_supplier_name", "email": "s_email"}, score=None)
    with pytest.raises(ValueError, match="missing columns: s_address"):
        erp.partners(*args)
    assert rows(erp.partners(*args, **few), "origin_id", "country_id", "state_id", "city") == [
        (1, 10, 20, "QZ"), (2, 10, None, None), (3, None, None, None), (4, None, None, None),
    ]
    assert erp.partners(*args, require_email=False, **few).count() == 5


def test_t19_c12_punches(frame):
    punch = frame(
        "id int, ext_id int, terminal_id string, check_type string, check_time timestamp_ntz, check_data string",
        (1, 1, "t", "fa", T0, '{"device_name":"a device name longer than sixteen"}'),
        (2, 1, "t", "card", T0, "{}"), (3, 9, "t", "fa", T0, "{}"), (4, 1, "t", "fa", dt.datetime(2023, 1, 1), "{}"),
        (5, 1, "t", "fa", T0, "{}"),
    )
    people = frame("s_talent_archives_id int, s_name string, s_employee_num string", (1, "n", "E1"), (9, "x", None))
    target = frame("dk_id int, terminal_id string, employee_num string, username string, device_name string, dk_time timestamp_ntz", (5, "old", None, None, None, None))
    out = punches.punch_detail(punch, people, target, "2024-02-01 00:00:00")
    assert rows(out, "dk_id", "terminal_id", "device_name") == [(1, "t", "a device name longer than sixteen"), (5, "old", None)]


def test_h1_h2_cycles_and_orphans(frame):
    data = nodes(
        frame, (1, None, "a", None, None), (4, 1, "b", "B", None), (9, 4, "c", None, None), (10, 9, "d", None, None),
        (20, 99, "orphan", None, None), (21, 20, "below orphan", None, None), (30, 30, "self", None, None),
        (31, 32, "x", None, None), (32, 31, "y", None, None), (33, 32, "into cycle", None, None),
    )
    paths = tree.tree_paths(data)
    assert rows(paths.filter("parent_path is not null"), "id", "complete_name", "parent_path") == [
        (1, "a", "1/"), (4, "a / b", "1/4/"), (9, "a / b / c", "1/4/9/"), (10, "a / b / c / d", "1/4/9/10/"),
    ]
    coded = tree.inherit_from_ancestor(data)
    assert rows(coded.filter("code is not null"), "id", "code") == [(4, "B"), (9, "B"), (10, "B")]
    assert coded.count() == 10


def test_j12_null_in_the_list(frame):
    names = frame("name string", ("red",), ("blue",), (None,))
    assert rows(lookup.anti_null_aware(names, "name", frame("name string", ("red",)), "name")) == [("blue",)]
    assert rows(lookup.anti_null_aware(names, "name", frame("name string", ("red",), (None,)), "name")) == []
    assert lookup.anti_null_aware(names, "name", frame("name string"), "name").count() == 3
    assert rows(lookup.missing_from(names, frame("name string", ("red",), (None,)), {"name": "name"})) == [(None,), ("blue",)]


def test_l12_p10_responses(frame):
    replies = frame(
        "id int, status_code int, response_body string",
        (1, 200, '{"data":[{"isSuccess":1,"subMsg":"m","code":"a"},{"isSuccess":0,"code":"b"}]}'),
        (2, 500, "oops"), (3, 200, '{"data":[]}'), (4, None, "x"), (5, 200, "not json"),
    )
    entries, failed = audit.response_audit(replies)
    assert rows(entries, "id", "is_success", "error_msg", "entity_code") == [
        (1, 0, None, "b"), (1, 1, "m", "a"), (3, None, None, None), (5, None, None, None),
    ]
    assert rows(failed, "id") == [(2,), (4,)]


def test_l10_domain_check(frame):
    data = frame("id int, flag int, sort int", (1, 1, None), (2, 7, 3), (3, None, 1))
    good, bad = row_ops.check_domain(data, {"flag": F.col("flag").isin(0, 1)}, {"sort": 99999})
    assert rows(good, "id", "sort") == [(1, 99999), (3, 1)]
    assert rows(bad, "id", "reasons") == [(2, "flag")]


def test_u1_repeated_source_key_fails(frame):
    target = frame("id int, v string", (1, "a"))
    with pytest.raises(Exception, match="not unique"):
        merge.merge_upsert(target, frame("id int, v string", (1, "x"), (1, "y")), ["id"]).collect()


def test_u1_null_values_and_null_keys(frame):
    target = frame("id int, v string", (1, "a"), (None, "local"), (2, None))
    source = frame("id int, v string", (1, None), (2, "b"), (None, "n1"), (None, "n1"))
    assert rows(merge.merge_upsert(target, source, ["id"])) == [(None, "local"), (None, "n1"), (None, "n1"), (1, None), (2, "b")]


def test_scalar_with_more_than_one_row_fails(frame):
    two = frame("id int", (1,), (2,))
    with pytest.raises(Exception):
        two.select(lookup.scalar(two, "id")).collect()


def test_expressions(frame):
    one = frame("a string, b boolean, n int", ("[3,,5]", None, 2))
    ids = bracket_ids("a", 4)
    got = one.select(
        *[c.alias(f"i{k}") for k, c in enumerate(ids)],
        code_map("n", {1: False, 2: True}).alias("flag"),
        code_map("n", {1: False}).alias("none"),
        any_true("b", F.lit(True)).alias("any"),
        localized(zh_CN="a", en_US=F.lit(None).cast("string")).alias("name"),
        first_number(F.lit("约２２０.5g")).alias("wide"),
        newer_than(F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"), "2024-02-01 00:00:00", "1 month").alias("new"),
    )
    assert rows(got) == [(3, None, 5, None, True, None, True, '{"zh_CN":"[3,,5]","en_US":"[3,,5]"}', 220.5, True)]


def test_first_non_empty_and_numbering(frame):
    data = frame("k int, o int, v string", (1, 1, ""), (1, 2, None), (1, 3, "x"), (1, 4, "y"), (2, 1, ""))
    assert rows(nesting.first_non_empty(data, ["k"], "v", "o", "spec")) == [(1, "x")]
    assert numbering.number_rows(data.filter("k > 5"), ["k", "o"], "n").count() == 0
