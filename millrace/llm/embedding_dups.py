"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are turned into the principal axes of a sample, longest first. Vectors whose cosine
reaches the threshold lie close in every coordinate, so cells of the leading axes as wide as
that distance leave only neighbouring cells to compare. Cells are cut into tiles, and pairs of tiles
are compared as blocks: the products of the leading coordinates are summed first, the rest is
bounded by the product of the suffix norms, and a pair is dropped as soon as it cannot reach the
threshold. A pair of tiles reports how many links each vector has and a forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, over_batches, small, with_columns
from millrace.llm.components import components, forest
from millrace.session import cut_lineage

#: Vectors the axes are fitted on, at most; they change what is skipped, never what is found.
SAMPLE = 4096
#: Vectors per tile, about; leading axes that make cells.
TILE, AXES = 2048, 2
AXIS = tuple(f"c{k}" for k in range(AXES))
#: Coordinates after which a pair may be dropped, and rows of a tile compared at once.
STAGES, ROWS = (8, 16, 32), 512
#: Cosines this near the threshold are computed anew from the vectors as given.
MARGIN = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _axes(rows: list[list[float]]) -> dict[int, np.ndarray]:
    """Principal axes (columns, longest first) by number of components."""
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r), []).append(r)
    found = {}
    for size, own in by_size.items():
        u = unit(np.array(own, np.float64))
        found[size] = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
    return found


def _turned(vectors: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    known = axes.get(vectors.shape[1])
    return unit(vectors) if known is None else unit(vectors) @ known


def links(a: np.ndarray, b: np.ndarray | None, axes: dict[int, np.ndarray], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i of a, j of b) whose cosine is at least ``least``; without b those of a, i < j. In blocks of rows."""
    x = _turned(a, axes)
    y = x if b is None else _turned(b, axes)
    d = x.shape[1]
    stops = [s for s in STAGES if s < d] + [d]
    norms = [(np.sqrt((x[:, s:] ** 2).sum(axis=1)), np.sqrt((y[:, s:] ** 2).sum(axis=1))) for s in stops]
    for first in range(0, len(x), ROWS):
        rows = slice(first, min(len(x), first + ROWS))
        total = x[rows, : stops[0]] @ y[:, : stops[0]].T
        possible = total + np.outer(norms[0][0][rows], norms[0][1]) >= least - MARGIN
        if b is None:
            possible &= np.arange(len(y))[None, :] > np.arange(rows.start, rows.stop)[:, None]
        at, done = None, stops[0]
        for stop, (left, right) in zip(stops[1:], norms[1:], strict=True):
            if at is None and np.count_nonzero(possible) * 8 < possible.size:
                at = np.nonzero(possible)
                values = total[at]
            if at is None:
                total += x[rows, done:stop] @ y[:, done:stop].T
                possible &= total + np.outer(left[rows], right) >= least - MARGIN
            else:
                i, j = at
                for k in range(0, len(i), 1 << 15):
                    part = slice(k, k + (1 << 15))
                    values[part] += np.einsum("nd,nd->n", x[i[part] + first, done:stop], y[j[part], done:stop])
                stay = values + left[i + first] * right[j] >= least - MARGIN
                at, values = (i[stay], j[stay]), values[stay]
            done = stop
        if at is None:
            at = np.nonzero(possible)
            values = total[at]
        i, j = at
        near = np.flatnonzero(np.abs(values - least) <= MARGIN)
        sure = values >= least
        if len(near):
            sure[near] = _cosine(a[i[near] + first], (a if b is None else b)[j[near]]) >= least
        yield i[sure] + first, j[sure]


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _compared(axes, least: float):
    """Link counts and forests of pairs of tiles, from rows in order of pair."""

    def result(nodes, keys, copies, sides, vectors):
        one, two = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        count = np.zeros(len(nodes), np.int64)
        kept = [np.zeros((0, 2), np.int64)]
        a = vectors[one]
        for i, j in links(a, vectors[two] if len(two) else None, axes.value, least):
            i, j = one[i], (two if len(two) else one)[j]
            count += np.bincount(i, copies[j], len(nodes)).astype(np.int64) + np.bincount(j, copies[i], len(nodes)).astype(np.int64)
            root = forest(i, j, len(nodes))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            kept.append(np.stack([moved, root[moved]], axis=1))
        pairs = np.concatenate(kept)
        root = forest(pairs[:, 0], pairs[:, 1], len(nodes))
        seen = np.flatnonzero(count)
        return keys[seen], count[seen], nodes[seen], nodes[root[seen]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finished(table: pa.Table):
            pairs = table["pair"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1], [True]]))
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = table.slice(a, b - a)
                nodes = own["node"].to_numpy()
                order = np.argsort(nodes, kind="stable")
                flat = own["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                vectors = flat.astype(np.float64).reshape(len(nodes), -1)[order]
                columns = [own[c].to_numpy()[order] for c in ("key", "copies", "side")]
                found.append(result(nodes[order], *columns, vectors))
            keys, count, nodes, roots = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (keys, count, nodes, roots)], names=["key", "links", "node", "root"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            pairs = batch.column(0)
            if sum(b.num_rows for b in held) < 2 * TILE or held[0].column(0)[0] == pairs[-1]:
                continue
            table = pa.Table.from_batches(held)
            whole = int(np.searchsorted(table["pair"].to_numpy(), pairs[-1].as_py()))
            yield finished(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held:
            yield finished(pa.Table.from_batches(held))

    return compare


def _valid(vector: Column) -> Column:
    """Whether a vector has a direction: no null, no non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _cells(once: DataFrame, axes, width: float) -> DataFrame:
    """``once`` with the cell of every vector on the leading axes, cells as wide as links reach."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, AXES), np.int32)
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                turned = _turned(own.reshape(len(at), -1), axes.value)[:, :AXES]
                found[at, : turned.shape[1]] = np.floor(turned / width).astype(np.int32)
            yield appended(batch, **{c: pa.array(found[:, k]) for k, c in enumerate(AXIS)})

    placed = over_batches(once, cells, with_columns(once, **dict.fromkeys(AXIS, "int")))
    placed = cut_lineage(placed.withColumn("size", F.size("embedding")))
    # A group that fits a tile needs no cells.
    groups = placed.groupBy("label", "size").agg((F.count(F.lit(1)) > TILE).alias("many"))
    placed = placed.join(small(cut_lineage(groups)), ["label", "size"])
    return placed.withColumns({c: F.when(F.col("many"), F.col(c)).otherwise(F.lit(0)) for c in AXIS})


def _tile_pairs(counted: DataFrame) -> DataFrame:
    """Rows (pair, tile, side): which tiles meet. One row per side; a tile that meets itself has one side.

    ``counted`` has one row per cell with its number of tiles (``parts``); tiles of a cell meet those of the same
    and of neighbouring cells.
    """
    where = ["label", "size", *AXIS]
    tiles = counted.select(*where, "many", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    steps = [F.struct(*[F.lit(d).alias(c) for d, c in zip(step, AXIS, strict=True)]) for step in np.ndindex(*[3] * AXES)]
    around = F.when(F.col("many"), F.array(*steps)).otherwise(F.array(steps[len(steps) // 2]))
    near = tiles.select("label", "size", F.struct(*AXIS, "part").alias("other"), F.explode(around).alias("step"))
    near = near.select("label", "size", "other", *[(F.col(f"other.{c}") + F.col(f"step.{c}") - 1).alias(c) for c in AXIS])
    both = near.join(tiles.drop("many"), where).withColumn("one", F.struct(*AXIS, "part"))
    both = both.withColumn("pair", F.xxhash64("label", "size", "one", "other"))

    def side(pairs: DataFrame, tile: str, number: int) -> DataFrame:
        columns = [F.col(f"{tile}.{c}").alias(c) for c in (*AXIS, "part")]
        return pairs.select("pair", "label", "size", *columns, F.lit(number).cast("byte").alias("side"))

    return side(both.filter("one <= other"), "one", 0).union(side(both.filter("one < other"), "other", 1))


def near_vectors(
    df: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``df``.

    Vectors of equal label and length are linked if their cosine is at least ``least``. A vector
    that is null, zero, or holds null or non-finite components, and one without label or id, has no links and
    is its own component. Equal vectors are compared once and count as often as they occur; repeated
    ids are rows of their own in ``n_links`` and one node in ``component_id``. Other columns are not
    read; an empty table gives no rows.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    usable = _valid(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Two hashes tell a vector of a label apart from any other.
    key2 = F.xxhash64(F.lit(1), "embedding", "label")
    rows = rows.withColumn("key", F.when(usable, F.xxhash64("label", "embedding")))
    once = rows.filter(F.col("key").isNotNull()).groupBy("label", "embedding", "key")
    once = cut_lineage(once.agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("key2", key2))

    sample = once.orderBy("key", "key2").limit(SAMPLE).select("embedding").collect()
    axes = df.sparkSession.sparkContext.broadcast(_axes([r.embedding for r in sample]))
    reach = max(1e-6, float(np.sqrt(max(0.0, 2 - 2 * least))) * (1 + 1e-6))
    placed = _cells(once, axes, reach)
    where = ["label", "size", *AXIS]
    counted = placed.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.first("many").alias("many"))
    counted = cut_lineage(counted.withColumn("parts", F.ceil(F.col("n") / TILE).cast("int")))
    member = cut_lineage(_tile_pairs(counted))
    vectors = placed.join(small(counted.select(*where, "parts")), where)
    vectors = vectors.withColumn("part", F.pmod(F.col("key2"), F.col("parts")).cast("int"))
    dealt = vectors.join(small(member), [*where, "part"]).select("pair", "side", "node", "key", "copies", "embedding")
    dealt = dealt.repartition("pair").sortWithinPartitions("pair")
    found = cut_lineage(over_batches(dealt, _compared(axes, least), "key long, links long, node long, root long"))

    counts = found.groupBy("key", "node").agg(F.sum("links").alias("links"))
    named = once.select("key", "key2", "node", "copies").join(counts, ["key", "node"], "left")
    named = named.join(components(found.select("node", "root")), "node", "left")
    links_of = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    named = cut_lineage(named.select("key", "key2", links_of.alias("n"), F.coalesce("component", "node").alias("c")))
    out = rows.select("vec_id", "key", key2.alias("key2")).join(named, ["key", "key2"], "left")
    component = F.coalesce("c", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op2_embeddings(embeddings: DataFrame) -> DataFrame:
    return near_vectors(embeddings)
