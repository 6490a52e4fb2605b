import math
import re

import pytest

from millrace.llm import batches
from millrace.llm.decontaminate import NAME, NUMBER, UNIT, contaminated, drop_contaminated, marked, op3_decontaminate, template
from pyspark.sql import functions as F

ITEM = "Yesterday Alice bought 12 apples and Bob ate 3.5 kg of pears, then Alice sold 12 oranges for 40 euros at the market."
OTHER = "while the river was running slowly towards the distant hills nobody in the valley noticed that winter had come"
BENCHMARK = [(1, ITEM), (2, OTHER)]


def windows_needed(n):
    return math.ceil(n * 0.8)


def run(sp, texts, benchmark=BENCHMARK):
    docs = sp.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = sp.createDataFrame(benchmark, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in op3_decontaminate(docs, items).collect()}


def words(sp, text):
    return sp.createDataFrame([(text,)], "t string").select(template(marked(F.col("t")))).first()[0].split(" ")


def test_template(sp):
    assert words(sp, "We met Anna Lee. She ran 3.5 km, and 1,000 more!") == [
        "we", "met", NAME, NAME, "she", "ran", NUMBER, UNIT, "and", NUMBER, "more"
    ]


def test_verbatim_reparameterised_and_chance(sp):
    new = ITEM.replace("Alice", "Zoe").replace("Bob", "Max").replace("12", "77").replace("3.5 kg", "9 lb").replace("40", "41")
    mixed = ITEM.replace("Alice", "Zoe", 1).replace("12", "77", 1)
    wrapped = f"intro words here, {ITEM} and an outro"
    texts = [ITEM, new, mixed, wrapped, "nothing of this kind", OTHER.upper(), f"x {OTHER} y {new}", ITEM[: len(ITEM) // 2]]
    assert run(sp, texts) == {(0, 1), (1, 1), (3, 1), (5, 2), (6, 2), (6, 1)}


def test_share_of_windows(sp):
    tokens = OTHER.split()
    n = len(tokens) - 4
    keep = windows_needed(n) + 4
    assert run(sp, [" ".join(tokens[:keep]), " ".join(tokens[: keep - 1])]) == {(0, 2)}


def test_shuffled_join_gives_the_same(sp, monkeypatch):
    texts = [ITEM, f"and so, {OTHER}", "none"]
    broadcast = run(sp, texts)
    monkeypatch.setattr(batches, "BROADCAST_ROWS", 0)
    assert run(sp, texts) == broadcast == {(0, 1), (1, 2)}


def test_boilerplate_is_no_leak(sp):
    items = [(i, f"choose the right answer from the list below {'abcdefghij'[i] * 4} {'klmnopqrst'[i] * 5} {'uvwxyzabcd'[i] * 6} done now") for i in range(10)]
    texts = ["choose the right answer from the list below nothing else here at all", items[3][1]]
    assert run(sp, texts, items) == {(1, 3)}


def test_planted_passages(sp, sample):
    documents, benchmark = sample("documents"), sample("benchmark")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    want = {(d.doc_id, i) for d in documents.collect() for i, t in items if t in d.text}
    assert {(r.doc_id, r.item_id) for r in op3_decontaminate(documents, benchmark).collect()} == want


def brute(text, item):
    """Windows of plain words, for texts without placeholders."""
    cut = lambda t: [w for w in re.findall(r"[^\W\d_]+", t.lower())]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]
    own, seen = grams(cut(item)), set(grams(cut(text)))
    return sum(g in seen for g in own) >= windows_needed(len(own))


def test_against_brute_force(sp):
    import random

    random.seed(3)
    vocabulary = "ash birch cedar dogwood elm fir gum hazel".split()
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(6, 14)))) for i in range(12)]
    texts = [" ".join(random.choices(vocabulary, k=8) + random.choice(items)[1].split()[: random.randint(5, 14)]) for _ in range(60)]
    assert run(sp, texts, items) == {(d, i) for d, t in enumerate(texts) for i, item in items if brute(t, item)}


@pytest.mark.parametrize("text_name", ["text"])
def test_edges(sp, docs, no_docs, text_name):
    items = sp.createDataFrame([(1, None), (None, "a b c d e f"), (2, ""), (3, "one id"), (4, "1 2 3 4 5 6 7"), (3, "one id")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in op3_decontaminate(docs, items).collect()} == {(7, 3)}
    kept = drop_contaminated(docs.withColumnRenamed("source", "text_hash"), items)
    assert kept.count() == 11 and kept.columns[3] == "text_hash"
    assert op3_decontaminate(no_docs, items).collect() == [] and op3_decontaminate(docs, items.filter("false")).collect() == []
    both = docs.withColumnRenamed("source", "n_found")
    assert contaminated(both, items, ["doc_id", "n_found"]).columns == ["doc_id", "n_found", "item_id", "n_windows", "n_found_", "n_slots"]


FRUIT = "Tom has 5 apples. Sara has 3 pears. How many fruits do they have?"
TRAIN = "The train left Boston at 9 and Alice met Peter in Denver after 12 hours on the road."


def test_openers_are_names_too(sp):
    texts = ["Bob has 7 apples. Mary has 4 pears. How many fruits do they have?", "Now: Bob has 7 apples, Mary has 4 pears, how many fruits do they have", "Bob has 7 apples."]
    assert run(sp, texts, [(1, FRUIT)]) == {(0, 1), (1, 1)}


def test_verbatim_in_any_case(sp):
    assert run(sp, [TRAIN.lower(), f"so {TRAIN.upper()} end", TRAIN[:30].upper()], [(1, TRAIN)]) == {(0, 1), (1, 1)}


def test_numbers_and_few_words_are_found_literally(sp):
    items = [(1, "Compute 17 + 25 * 3 - 4 / 2 = 90"), (2, "What is 7 + 8?"), (3, "12")]
    texts = [f"asked to {items[0][1]} today", "and then: what is 7 + 8? he said", "and then: what is 7 + 9? he said", "WHAT IS 6 + 1?"]
    assert run(sp, texts, items) == {(0, 1), (1, 2), (3, 2)}


def test_a_clash_costs_its_own_windows(sp):
    plain = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    item = f"first 12 {plain} then 40 apples and 12 pears in the end of 12 days"
    clash = item.replace("40", "9").replace("12", "9")
    altered = item.replace("12", "77", 1)
    apart = item.replace("12 pears", "5 pears").replace("12 days", "6 days")
    assert run(sp, [item, clash, altered, apart], [(1, item)]) == {(0, 1), (1, 1), (2, 1), (3, 1)}


def test_windows_hash_like_arrays(sp):
    """A window's hash is that of the array of its words, also where a text has fewer words than a window."""
    from pyspark.sql import functions as F

    from millrace.llm.decontaminate import windows

    texts = ["", "a", "a b c", "a b c d e", "one two three four five six seven"]
    df = sp.createDataFrame([(t.split(" "),) for t in texts], "w array<string>")
    for r in df.select("w", windows(F.col("w"), 5).alias("h")).collect():
        parts = [r.w[i : i + 5] for i in range(max(1, len(r.w) - 4))]
        want = sp.createDataFrame([(i, p) for i, p in enumerate(parts)], "i int, p array<string>").orderBy("i").select(F.xxhash64("p").alias("h")).collect()
        assert r.h == [x.h for x in want]


def test_marks_of_odd_texts(spark):
    texts = {
        "One  two.  Three": "one two three", "a Bob, c Eve": "a bob c eve", " 5 km % 7% x": "5 km 7 % x",
        "a , b . 1.5,c": "a b 1.5 c", "a\nb\tc - d": "a b c d", "aB Cd €9 é Éa": "ab cd 9 é éa",
    }
    data = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in data.select(marked(F.col("t"))).collect()] == list(texts.values())
    # Most places of a text are turned down by the next character, before what precedes them is looked at.
    plan = data.select(marked(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "(?![a-z])" in plan
