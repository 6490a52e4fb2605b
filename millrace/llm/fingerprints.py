"""Document fingerprints that tell how far two texts differ: invertible Bloom lookup sketches of their paragraphs.

A sketch has three rows of cells. Every paragraph digest is added to one cell of each row: cells count digests and
hold the exclusive or of the digests and of their check hashes. Subtracting the sketches of two versions cancels
what they share, and peeling (a cell with a single digest gives it away, it is taken out of its other cells,
and so on) recovers the digests that differ. Where peeling fails, the digests are dealt to sixteen sketches by further
bits of the digest, and so on: a sketch sixteen times as large each time, of which only parts that fail are made.

Everything is column expressions: a fingerprint and a comparison are projections of a row. The only shuffle brings
each document next to the one after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import fresh

#: Where a paragraph ends: at line feeds, and behind a sentence inside a line.
BREAK = r"\n+|(?<=[.!?])\s+"
#: Rows of a sketch, and bits that choose a cell of a row: in a fingerprint, and in the smaller sketches parts are retried with.
ROWS, CELL_BITS, PART_BITS = 3, 3, 3
#: Parts that digests are dealt to at once, at most; digests of both versions a part should have; rounds of that, after which what
#: is left, if anything, is compared itself. A part gets its digests by DEAL_BITS bits of its own in each round.
DEAL_BITS, PART, RETRIES = 4, 16, 5
#: Rounds of peeling at most; in each, all cells with a single digest give it away.
ROUNDS = 8
#: Keys a bucket's border is drawn from, and buckets per shuffle partition.
DRAWN, BUCKETS = 32, 8
#: What the check hash is seeded with.
CHECK = 13


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(CHECK), digest)


def digests(text: str | Column) -> Column:
    """The different paragraph digests of a text, each with its check hash; blank paragraphs and a null text have none."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    parts = F.filter(F.split(text, BREAK), lambda p: F.trim(p) != "")
    each = F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))
    return F.transform(each, lambda d: F.struct(d.alias("k"), _check(d).alias("h")))


def _bits(level: int) -> int:
    return CELL_BITS if level == 0 else PART_BITS


def _cells_of(check: Column, level: int) -> Column:
    """The cells a digest falls in, one of each row, as a bit each; by bits of its check hash that no other level uses."""
    bits = _bits(level)
    used = ROWS * (CELL_BITS + PART_BITS * (level - 1)) if level else 0
    each = [F.shiftright(check, used + bits * r).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(r << bits) for r in range(ROWS)]
    first, second, third = (F.call_function("shiftleft", F.lit(1), c.cast("int")) for c in each)
    return first.bitwiseOR(second).bitwiseOR(third)


def _cell(n: Column, k: Column, h: Column, m: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), h.alias("h"), m.alias("m"))


def _placed(n: int, digest: Column, level: int) -> Column:
    """A cell's content with nothing but a digest in it: count, digest, check and cells."""
    return _cell(F.lit(n), digest["k"], digest["h"], _cells_of(digest["h"], level))


def _add(cell: Column, other: Column, sign: int) -> Column:
    """A cell with the digests of another added or taken out."""
    count = cell["n"] + other["n"] if sign > 0 else cell["n"] - other["n"]
    return _cell(count, *[cell[f].bitwiseXOR(other[f]) for f in "khm"])


def _sketched(placed: Column, level: int) -> Column:
    """The cells of digests with their counts: one array, row after row."""
    empty = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0))
    bits = F.array(*[F.lit(1 << j) for j in range(ROWS << _bits(level))])

    def cell(placed: Column, bit: Column) -> Column:
        return F.aggregate(F.filter(placed, lambda d: d["m"].bitwiseAND(bit) > 0), empty, lambda c, d: _add(c, d, 1))

    return let(placed, lambda p: F.transform(bits, lambda bit: cell(p, bit)))


def sketch(found: Column, level: int = 0) -> Column:
    """The cells of an array of digests: how many fall in each, and the exclusive or of them, of their checks and of their cells."""
    return _sketched(F.transform(found, lambda d: _placed(1, d, level)), level)


def subtract(left: Column, right: Column) -> Column:
    """What the first sketch holds beyond the second (counted up) and lacks of it (counted down)."""
    return F.zip_with(left, right, lambda a, b: _add(a, b, -1))


def _sketched_apart(left: Column, right: Column, level: int) -> Column:
    """The sketch of one array of digests less that of another, in one go."""
    return _sketched(F.concat(F.transform(left, lambda d: _placed(1, d, level)), F.transform(right, lambda d: _placed(-1, d, level))), level)


def _pure(cells: Column) -> Column:
    """Cells with a single digest, each digest once."""
    return F.array_distinct(F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"]))))


def peel(cells: Column) -> Column:
    """``done`` (whether the cells were emptied) and ``found``: the digests with 1 or -1 for the side that has them."""

    def state(cells: Column, found: Column) -> Column:
        return F.struct(cells.alias("cells"), _pure(cells).alias("pure"), found.alias("found"))

    def step(s: Column, _round: Column) -> Column:
        touched = F.aggregate(s["pure"], F.lit(0), lambda u, d: u.bitwiseOR(d["m"]))

        def less(c: Column, bit: Column) -> Column:
            return F.aggregate(F.filter(s["pure"], lambda d: d["m"].bitwiseAND(bit) > 0), c, lambda a, d: _add(a, d, -1))

        def without(touched: Column) -> Column:
            bit = lambda i: F.call_function("shiftleft", F.lit(1), i)
            return F.transform(s["cells"], lambda c, i: F.when(touched.bitwiseAND(bit(i)) > 0, let(bit(i), lambda b: less(c, b))).otherwise(c))

        return F.when(F.size(s["pure"]) == 0, s).otherwise(
            let(let(touched, without), lambda cells: state(cells, F.concat(s["found"], s["pure"])))
        )

    first = let(cells, lambda c: state(c, F.filter(c, lambda _: F.lit(False))))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), first, step,
        lambda s: F.struct(
            (~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0))).alias("done"),
            F.transform(s["found"], lambda c: F.struct(c["n"].alias("n"), c["k"].alias("k"))).alias("found"),
        ),
    )


def _no_digests() -> Column:
    return F.array().cast("array<struct<n:int,k:bigint>>")


def _compared(left: Column, right: Column) -> Column:
    """The differing digests from the digests themselves."""

    def signed(a: Column, b: Column, n: int) -> Column:
        return F.transform(F.array_except(a, b), lambda d: F.struct(F.lit(n).alias("n"), d["k"].alias("k")))

    return F.concat(signed(left, right, 1), signed(right, left, -1))


def _parts(pair: Column, level: int) -> Column:
    """The digests of two versions dealt out by bits that no other level uses; parts without any are left out.

    There are as many parts, a power of two, as their number asks for.
    """
    wanted = F.greatest(F.lit(2), F.ceil((F.size(pair["a"]) + F.size(pair["b"])) / F.lit(PART)))
    steps = [1 << b for b in range(1, DEAL_BITS + 1)]
    count = F.coalesce(*[F.when(wanted <= n, F.lit(n)) for n in steps[:-1]], F.lit(steps[-1])).cast("long")

    def part(of: Column, s: Column) -> Column:
        return F.transform(F.filter(of, lambda d: d["p"] == s), lambda d: d["d"])

    def dealt(of: Column, last: Column) -> Column:
        return F.transform(of, lambda d: F.struct(F.shiftright(d["k"], DEAL_BITS * level).bitwiseAND(last).alias("p"), d.alias("d")))

    def parts(x: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), x["last"]), lambda s: F.struct(part(x["a"], s).alias("a"), part(x["b"], s).alias("b"))
        )

    every = let(
        let(count - 1, lambda last: F.struct(last.alias("last"), dealt(pair["a"], last).alias("a"), dealt(pair["b"], last).alias("b"))), parts
    )
    return F.filter(every, lambda p: (F.size(p["a"]) > 0) | (F.size(p["b"]) > 0))


def _first(left: Column, right: Column, left_cells: Column, right_cells: Column) -> Column:
    """What peeling the difference of two sketches found, and the digests that are open if it failed."""
    both = F.array(F.struct(left.alias("a"), right.alias("b")))

    def result(p: Column) -> Column:
        found = F.when(p["done"], p["found"]).otherwise(_no_digests())
        return F.struct(found.alias("found"), F.filter(both, lambda _: ~p["done"]).alias("open"))

    return let(peel(subtract(left_cells, right_cells)), result)


def _retried(state: Column, level: int) -> Column:
    """The state after larger sketches of what is open: one for each part the digests are dealt to."""

    def tried(pair: Column) -> Column:
        apart = peel(_sketched_apart(pair["a"], pair["b"], level))
        return F.struct(apart.alias("p"), pair.alias("pair"))

    def result(each: Column) -> Column:
        found = F.flatten(F.transform(F.filter(each, lambda t: t["p"]["done"]), lambda t: t["p"]["found"]))
        still = F.transform(F.filter(each, lambda t: ~t["p"]["done"]), lambda t: t["pair"])
        return F.struct(F.concat(state["found"], found).alias("found"), still.alias("open"))

    each = F.transform(F.flatten(F.transform(state["open"], lambda pair: _parts(pair, level))), tried)
    return F.when(F.size(state["open"]) == 0, state).otherwise(let(each, result))


def with_differences(df: DataFrame, pairs: dict[str, tuple[str, str, str, str]]) -> DataFrame:
    """``df`` with the paragraph digests that only one of two versions has, as (n, k): n is 1 for the first one's, -1 for the second's.

    ``pairs`` gives the new column's name and the columns of both digests and both sketches. The sketches are subtracted and
    peeled; the digests are only looked at where a larger sketch must be made of them. What RETRIES sketches leave
    open, if any, is compared as it is, so that the result is always whole.
    """
    df = df.withColumns({out: _first(*map(F.col, names)) for out, names in pairs.items()})
    for level in range(1, RETRIES + 1):
        df = df.withColumns({out: _retried(F.col(out), level) for out in pairs})
    return df.withColumns({
        out: F.concat(F.col(out)["found"], F.flatten(F.transform(F.col(out)["open"], lambda p: _compared(p["a"], p["b"]))))
        for out in pairs
    })


def likeness(differing: Column, left: Column, right: Column) -> Column:
    """Twice the shared paragraphs over those of both: 1 for equal sets (two empty ones, too), 0 for disjoint ones."""
    both = F.size(left) + F.size(right)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - F.size(differing)).cast("double") / both)


def written(cells: Column) -> Column:
    """A sketch as text: cell, count, digests and checks of every cell in use, in hex."""
    line = F.transform(cells, lambda c, i: F.struct(i.alias("i"), c["n"].alias("n"), c["k"].alias("k"), c["h"].alias("h")))
    used = F.filter(line, lambda c: c["n"] != 0)
    return F.array_join(F.transform(used, lambda c: F.concat_ws(":", F.hex(c["i"]), F.hex(c["n"]), F.hex(c["k"]), F.hex(c["h"]))), ",")


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``fingerprint``, the sketch of its paragraphs, and ``digests`` to compare it by.

    Whole texts are read. A null text counts as empty; an empty or blank text has an empty fingerprint. Repeated paragraphs
    count once and their order does not matter. Repeated rows get equal results, an empty table gives no rows, and
    taken column names make the new ones end in an underscore.
    """
    print_name, digests_name = fresh(df, "fingerprint", "digests")
    return df.withColumn(digests_name, digests(text)).withColumn(print_name, written(sketch(F.col(digests_name))))


def _borders(keyed: DataFrame, key: str, buckets: int) -> list:
    """Keys of rows at which buckets begin, the least key first: about as many rows in each.

    A bounded sample of the keys, drawn by their hash, is sorted on the driver: DRAWN a bucket, about.
    """
    least, n = keyed.agg(F.min(key), F.count(F.lit(1))).first()
    if not n:
        return []
    share = min(1.0, DRAWN * buckets / n)
    drawn = F.pmod(F.xxhash64(F.lit(CHECK), key), F.lit(1 << 30)) < int(share * (1 << 30))
    keys = sorted({tuple(r[0]) for r in keyed.filter(drawn).select(key).collect()} | {tuple(least)}, key=_ordered)
    first = tuple(least)
    return [first, *[k for k in keys[:: max(1, len(keys) // buckets)] if k != first]]


def _ordered(key: tuple) -> tuple:
    """Nulls first, as Spark sorts."""
    return (key[0] is not None, key[0] or 0, *key[1:])


def _bucket(key: Column, borders: Column, count: int) -> Column:
    """How many borders stand at or before a key, less one: the place is found bit by bit."""
    steps = [1 << b for b in range(max(1, count.bit_length()) - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(at + s < count, F.when(F.get(borders, at + s) <= key, at + s).otherwise(at)).otherwise(at),
    )


def beside_next(df: DataFrame, key: str, carried: dict[str, Column], text: str = "text", buckets: int | None = None) -> DataFrame:
    """``df`` with columns of the row itself and, under ``next_`` and their name, of the row after it by ``key``; the last one's is the first.

    ``carried`` maps names to expressions over ``df`` and the names before. A null key comes first; rows with equal keys follow one another by
    the hash of their text and then in the order of the input, which must read the same each time (as files do). Rows are dealt
    to buckets of neighbours in a single shuffle: borders are keys of rows drawn from the whole table, equal
    keys are parted, and the first row of each bucket is sent to the bucket before it too. Taken column names
    are the caller's to avoid.
    """
    at, bucket, tail = fresh(df, "_key", "_bucket", "_tail")
    order = F.struct(F.col(key).alias("i"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.monotonically_increasing_id().alias("m"))
    keyed = df.withColumn(at, order)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = _borders(keyed, at, buckets or BUCKETS * parts)
    kind = keyed.schema[at].dataType.simpleString()
    listed = F.array(*[F.struct(*[F.lit(v) for v in b]) for b in borders]).cast(f"array<{kind}>")
    count = max(1, len(borders))
    placed = keyed.withColumn(bucket, _bucket(F.col(at), listed, count))
    own = F.struct(F.col(bucket).alias("b"), F.lit(False).alias("t"))
    before = F.struct(F.pmod(F.col(bucket) - 1, F.lit(count)).alias("b"), F.lit(True).alias("t"))
    sent = F.when(F.get(listed, F.col(bucket)) == F.col(at), F.array(own, before)).otherwise(F.array(own))
    dealt = placed.withColumn(bucket, F.explode(sent)).withColumns({tail: F.col(f"{bucket}.t"), bucket: F.col(f"{bucket}.b")})
    made = dealt.repartition(F.col(bucket))
    for name, value in carried.items():
        made = made.withColumn(name, value)
    w = Window.partitionBy(bucket).orderBy(tail, at)
    after = made.withColumns({f"next_{name}": F.lead(name).over(w) for name in carried})
    return after.filter(~F.col(tail)).drop(at, bucket, tail)


def with_edits(df: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """``df`` with the fingerprints of its text, of the text edited, and their likeness to it and to the next document.

    The edited text has its last half (rounded down) replaced by the first as many code points, or all, of the next document.
    New columns: ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``;
    taken names make them end in an underscore. A null text counts as empty, a single document follows itself; for the order
    of null and repeated keys see ``beside_next``. An empty table gives no rows.
    """
    names = fresh(df, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    n, edited, print_, edited_print, near_edited, near_next = names
    body, own, cells, own_edited, edited_cells = fresh(df, "_text", "_digests", "_cells", "_edited", "_edited_cells")
    carried = {body: F.coalesce(F.col(text), F.lit("")), own: digests(text), cells: sketch(F.col(own))}
    rows = beside_next(df, key, carried, text, buckets).withColumn(n, F.length(body).cast("long"))
    half = F.floor(F.col(n) / 2).cast("int")
    rows = rows.withColumn(
        edited, F.concat(F.substring(body, F.lit(1), F.col(n).cast("int") - half), F.substring(f"next_{body}", F.lit(1), half))
    )
    rows = rows.withColumn(own_edited, digests(F.col(edited))).withColumn(edited_cells, sketch(F.col(own_edited)))
    pairs = {
        near_edited: (own, own_edited, cells, edited_cells),
        near_next: (own, f"next_{own}", cells, f"next_{cells}"),
    }
    rows = with_differences(rows, pairs)
    rows = rows.withColumns({out: likeness(F.col(out), F.col(names[0]), F.col(names[1])) for out, names in pairs.items()})
    rows = rows.withColumns({print_: written(F.col(cells)), edited_print: written(F.col(edited_cells))})
    return rows.select(*df.columns, *names)


def op13_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    rows = with_edits(documents.select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
