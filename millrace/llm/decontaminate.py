"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units turn into typed placeholders, so that a benchmark question with other
numbers or names has the same template. Windows of template words are hash-joined; a document
that holds enough of an item's windows is a candidate, and its placeholders must map one to one to
the item's: a question with new parameters replaces each value consistently, a chance match does not.
A capitalised word that may open a sentence counts as a name and as a plain word. Copies in any case, and items
of few words or few plain ones, are found by windows of their literal words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import fresh, small
from millrace.session import cut_lineage

#: Template words per window, and the share of an item's windows that a document must hold.
WORDS, SHARE = 5, 0.8
#: A window with fewer plain words says nothing about its item and is left out on the item's side.
PLAIN = 2

NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
MARKS = f"[{NUMBER}-{UNIT}]"
#: Stands before a capitalised word that opens a sentence, a quotation or a line or follows a number: a name or not.
OPENER = "\ue003"
# Units of measure after a number.
UNITS = (
    "kilometers|kilometres|meters|metres|centimeters|millimeters|miles|yards|feet|foot|inches|inch|kilograms|grams|pounds|"
    "ounces|tons|liters|litres|gallons|hours|hour|minutes|minute|seconds|second|days|day|weeks|week|months|month|years|year|"
    "degrees|percent|dollars|euros|cents|km|cm|mm|kg|mg|lb|lbs|oz|ml|mph|kmh|m|g|l|h|s|ft|in|%|€|£|°"
)


def marked(text: Column) -> Column:
    """The words of a text in lower case, one blank apart; a mark stands before each number, name, opener and unit.

    A number is a run of digits with points or commas inside; a name is a capitalised word, not
    one in capitals, that does not open a sentence (a letter or comma and a blank stand before it), an opener is any
    other capitalised word; a unit follows a number.
    """
    text = F.regexp_replace(text, r"\p{N}+(?:[.,]\p{N}+)*", f" {NUMBER}$0 ")
    text = F.regexp_replace(text, rf"\p{{Lu}}(?<=[\p{{L}}\p{{M}},;:] .)\p{{Ll}}[\p{{L}}\p{{M}}]*", f"{NAME}$0")
    # A glance at the next character alone turns most places down; what stands before it is looked at after that.
    text = F.regexp_replace(text, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{M}}{NAME}])\p{{Lu}}\p{{Ll}}[\p{{L}}\p{{M}}]*", f"{OPENER}$0")
    text = F.regexp_replace(text, rf"({NUMBER}[\p{{N}}.,]+ {{1,2}})((?:{UNITS})(?!\p{{L}}))", f"$1{UNIT}$2 ")
    word = rf"a-z\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{OPENER}"
    kept = rf"{word}%€£°"
    # A blank right before a word is what would be written for it.
    left = rf"(?![a-z])(?! [{word}])"
    text = F.regexp_replace(F.lower(text), rf"{left}(?:[^{kept}.,]|(?<!\p{{N}})[.,]|[.,](?!\p{{N}})|(?<!{UNIT})[%€£°])+", " ")
    return F.trim(text)


def template(words: Column) -> Column:
    """Marked words with every value left out; openers are plain words."""
    return _without(F.regexp_replace(words, rf"({MARKS})[^ ]+", "$1"), OPENER)


def template_of_names(words: Column) -> Column:
    """Marked words with every value left out; openers are names."""
    return F.regexp_replace(F.replace(words, F.lit(OPENER), F.lit(NAME)), rf"({MARKS})[^ ]+", "$1")


def _without(words: Column, marks: str) -> Column:
    for mark in marks:
        words = F.replace(words, F.lit(mark), F.lit(""))
    return words


def _window(words: Column, start: Column, size: int) -> Column:
    """Hash of the window that begins at ``start`` (1 for the first): that of an array of its words.

    Words are picked one by one: ``slice`` would copy the whole array for each window. Places behind the last word are null and
    count for nothing.
    """
    return F.xxhash64(*[F.get(words, start + (k - 1)) for k in range(size)])


def windows(words: Column, size: int) -> Column:
    """Hashes of all windows of an array of template words, in order; fewer words make one window."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1)))
    return F.transform(starts, lambda i: _window(words, i, size))


def other_windows(words: Column, base: Column, size: int) -> Column:
    """Hashes of the windows that hold a word unlike the one at its place in ``base``, an array of equal length."""
    unlike = F.array_compact(F.transform(words, lambda w, i: F.when(w != F.get(base, i), i + 1)))
    last = F.greatest(F.size(words) - size + 1, F.lit(1))
    starts = F.transform(unlike, lambda i: F.sequence(F.greatest(i - size + 1, F.lit(1)), F.least(i, last)))
    return F.transform(F.array_distinct(F.flatten(starts)), lambda i: _window(words, i, size))


def literal(words: Column) -> Column:
    """Marked words without marks, in one case."""
    return F.lower(F.upper(_without(words, f"{NUMBER}{NAME}{UNIT}{OPENER}")))


def _forms(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, and arrays ``plain`` and ``names`` (templates by what openers count as) and ``literal`` of all texts' words.

    A text without a word has a single empty word.
    """
    rows = df.select(*keys, marked(F.coalesce(F.col(text), F.lit(""))).alias("marked"))
    made = {"plain": template, "names": template_of_names, "literal": literal}
    return rows.select(*keys, *[F.split(f(F.col("marked")), " ").alias(n) for n, f in made.items()])


def _items(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Rows (item, exact, at, hash, words, n): every window an item is searched by, ``n`` of them by template or exactly.

    A window with openers has a template for each choice of what they count as. The literal windows of an item of
    fewer than ``size`` words have all its words.
    """
    texts = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("t")).dropna().distinct()
    forms = _forms(texts, ["item"], "t").filter(F.col("plain")[0] != "")
    choices = F.transform(F.arrays_zip("plain", "names"), lambda z: F.array_distinct(F.array(z["plain"], z["names"])))
    starts = F.sequence(F.lit(0), F.greatest(F.size("choices") - size, F.lit(0)))
    spots = forms.select("item", choices.alias("choices")).select("item", "choices", F.explode(starts).alias("at"))

    def longer(made: Column, choice: Column) -> Column:
        return F.flatten(F.transform(made, lambda m: F.transform(choice, lambda c: F.concat(m, F.array(c)))))

    made = F.aggregate(F.slice("choices", F.col("at") + 1, size), F.array(F.array().cast("array<string>")), longer)
    found = spots.select("item", "at", F.size("choices").alias("words"), F.explode(made).alias("form"))
    plain = F.size(F.filter("form", lambda w: ~w.rlike(f"^{MARKS}$")))
    found = found.filter((plain >= PLAIN) | (F.col("words") < size))
    by_template = found.select("item", F.lit(False).alias("exact"), "at", F.xxhash64("form").alias("hash"), "words")
    exactly = forms.select("item", F.posexplode(windows(F.col("literal"), size)).alias("at", "hash"), F.size("literal").alias("words"))
    both = by_template.union(exactly.select("item", F.lit(True), "at", "hash", "words")).distinct()
    counted = both.groupBy("item", "exact").agg(F.countDistinct("at").alias("n"))
    return cut_lineage(both.join(counted, ["item", "exact"]))


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WORDS,
    share: float = SHARE,
) -> DataFrame:
    """Rows (keys, item, n_windows, n_found, n_slots): documents that hold a benchmark item, as it is or re-parameterised.

    A document holds an item if at least ``share`` of the item's windows occur in it, either literally in any case, or
    by their templates, counted where placeholders map one to one: of each alignment the windows stay that agree with
    its commonest mapping. Template windows without two plain words are left out; an item of fewer words than a window is
    found by its template only as a whole text, and literally anywhere. In a document's window all openers
    count as plain words or all as names. ``keys`` tell documents apart; rows with equal keys
    and texts are one document. A null key counts as a value. Null and empty texts hold nothing, null items and items
    without a word are not searched, and repeated items are searched once. Empty tables give no rows. Whole texts are read.
    Counts are those by template where these suffice. Other columns of ``df`` are not read; keys named like a column of the
    result make that column end in an underscore. An item of one or two words counts as held wherever these words stand, so
    a benchmark should not list such items, or apart.
    """
    items = _items(benchmark, item_id, item_text, size)
    n_items = items.count()
    shorts = [r.words for r in items.filter(F.col("exact") & (F.col("words") < size)).select("words").distinct().collect()]
    # Of an item with n windows, any n - ceil(share n) + 1 contain one that a holder has: its rarest.
    rare = Window.partitionBy("item", "exact").orderBy("used", "at", "hash")
    used = items.join(items.groupBy("hash").agg(F.count(F.lit(1)).alias("used")), "hash")
    opening = used.groupBy("item", "exact", "at", "n").agg(F.min("used").alias("used"), F.min("hash").alias("hash"))
    needed = F.col("n") - F.ceil(F.col("n") * F.lit(share)) + 1
    opening = opening.withColumn("rank", F.row_number().over(rare)).filter(F.col("rank") <= needed)
    signs = items.join(opening.select("item", "exact", "at"), ["item", "exact", "at"]).select("hash", "item").distinct()
    codes = [f"k{i}_" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(c) for k, c in zip(keys, codes, strict=True)], F.col(text).alias("t"))
    rows = rows.withColumn("doc", F.xxhash64(*codes, "t"))
    hashes = [windows(F.col("plain"), size), *[other_windows(F.col(form), F.col("plain"), size) for form in ("names", "literal")]]
    hashes += [windows(F.col("literal"), n) for n in shorts]
    found = _forms(rows, ["doc"], "t").select("doc", F.explode(F.concat(*hashes)).alias("hash"))
    pairs = cut_lineage(found.join(small(signs, n_items), "hash").select("doc", "item").distinct())
    wanted = pairs.select("doc").distinct()
    chosen = rows.join(small(wanted, pairs.count()), "doc", "left_semi").dropDuplicates(["doc"])
    chosen = cut_lineage(chosen.select("doc", *codes, marked(F.col("t")).alias("marked")))
    hits = _aligned(chosen, pairs, items, benchmark, item_id, item_text, n_items, size)
    hits = hits.union(_literal_hits(chosen, pairs, items, n_items, size, shorts))
    whole = hits.groupBy("doc", "item", "exact").agg(
        F.countDistinct("at").alias("n_found"), F.max("n").alias("n_windows"), F.max("slots").alias("n_slots")
    )
    whole = whole.filter(F.col("n_found") >= F.ceil(F.col("n_windows") * F.lit(share)))
    counts = [F.min_by(c, "exact").alias(c) for c in ("n_found", "n_windows", "n_slots")]
    whole = whole.groupBy("doc", "item").agg(*counts)
    named = whole.join(chosen.select("doc", *codes), "doc")
    out = [F.col(c).alias(k) for k, c in zip(keys, codes, strict=True)]
    item_name, windows_name, found_name, slots_name = fresh(df.select(*keys), "item_id", "n_windows", "n_found", "n_slots")
    return named.select(
        *out,
        F.col("item").alias(item_name),
        F.col("n_windows").cast("long").alias(windows_name),
        F.col("n_found").cast("long").alias(found_name),
        F.col("n_slots").cast("long").alias(slots_name),
    )


def _literal_hits(chosen, pairs, items, n_items, size, shorts) -> DataFrame:
    """Rows (doc, item, exact, at, n, slots): literal windows of items in candidate pairs."""
    words = chosen.select("doc", F.split(literal(F.col("marked")), " ").alias("words"))
    hashes = F.concat(*[windows(F.col("words"), n) for n in (size, *shorts)])
    spots = words.select("doc", F.explode(F.array_distinct(hashes)).alias("hash")).join(pairs, "doc")
    hits = spots.join(small(items.filter("exact"), n_items), ["item", "hash"])
    return hits.select("doc", "item", "exact", "at", "n", F.lit(0).cast("long").alias("slots"))


def _aligned(chosen, pairs, items, benchmark, item_id, item_text, n_items, size) -> DataFrame:
    """Rows (doc, item, exact, at, n, slots): template windows of candidate pairs whose placeholders agree with their alignment's."""
    words = chosen.select("doc", *[F.split(f(F.col("marked")), " ").alias(n) for n, f in (("plain", template), ("names", template_of_names))])
    forms = F.arrays_zip(windows(F.col("plain"), size).alias("p"), windows(F.col("names"), size).alias("n"))
    spots = words.select("doc", F.posexplode(forms).alias("pos", "form"))
    spots = spots.select("doc", "pos", F.explode(F.array_distinct(F.array("form.p", "form.n"))).alias("hash"))
    hits = spots.join(pairs, "doc").join(small(items.filter("not exact"), n_items), ["item", "hash"])
    hits = hits.select("doc", "item", "exact", "at", "n", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    hits = cut_lineage(hits)

    def values(df: DataFrame, key: str, words: Column) -> DataFrame:
        each = df.select(key, F.posexplode_outer(words).alias("word_at", "word"))
        return each.filter(F.col("word").rlike(f"^[{NUMBER}-{OPENER}]")).withColumn("word", F.replace("word", F.lit(OPENER), F.lit(NAME)))

    inside = F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    covered = hits.select("doc", "item", "shift", "at", inside.alias("k"))
    covered = covered.select("doc", "item", "shift", (F.col("at") + F.col("k")).alias("word_at")).distinct()
    texts = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("t")).dropna().distinct()
    own = values(texts, "item", F.split(marked(F.col("t")), " ")).withColumnRenamed("word", "own").distinct()
    seen = values(chosen, "doc", F.split("marked", " ")).withColumnRenamed("word", "seen")
    slots = covered.join(own, ["item", "word_at"]).withColumn("seen_at", F.col("word_at") + F.col("shift"))
    slots = slots.join(seen.withColumnRenamed("word_at", "seen_at"), ["doc", "seen_at"])
    alignment = ["doc", "item", "shift"]
    mapped = slots.groupBy(*alignment, "own", "seen").agg(F.collect_set("word_at").alias("places"))
    # Of ties the value that stays the same stands, then the one that comes first.
    rank = [F.size("places").desc(), (F.col("own") == F.col("seen")).desc(), F.array_min("places")]
    for side in ("own", "seen"):
        mapped = mapped.withColumn(f"{side}_rank", F.row_number().over(Window.partitionBy(*alignment, side).orderBy(*rank)))
    agrees = (F.col("own_rank") == 1) & (F.col("seen_rank") == 1)
    mapped = mapped.select(*alignment, "places", agrees.alias("agrees"))
    counted = mapped.groupBy(*alignment).agg(F.count_if("agrees").alias("slots"))
    bad = mapped.filter("not agrees").select(*alignment, F.explode("places").alias("word_at"))
    bad = bad.select(*alignment, F.explode(F.sequence(F.col("word_at") - size + 1, F.col("word_at"))).alias("at")).distinct()
    found = hits.join(bad, [*alignment, "at"], "left_anti").join(counted, alignment, "left").fillna(0, ["slots"])
    return found.select("doc", "item", "exact", "at", "n", "slots")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that hold no benchmark item."""
    own, bad_id, bad_hash = fresh(df, "text_hash", "bad_id", "bad_hash")
    rows = df.withColumn(own, F.xxhash64(F.col(text)))
    bad = contaminated(rows, benchmark, [doc_id, own], text).select(F.col(doc_id).alias(bad_id), F.col(own).alias(bad_hash))
    bad = cut_lineage(bad.distinct())
    same = F.col(doc_id).eqNullSafe(F.col(bad_id)) & (F.col(own) == F.col(bad_hash))
    return rows.join(small(bad, bad.count()), same, "left_anti").drop(own)


def op3_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(documents, benchmark, ["doc_id"])

