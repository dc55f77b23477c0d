"""Near-duplicate embeddings by collision-counting projections.

Unit vectors of cosine at least ``min_cosine`` are at most ``d`` apart, and their projections on a
random line differ by a normal deviate of deviation ``d`` or less.  Every vector is projected on
many lines; a pair collides on a line if its projections are within ``w = 2 d``: the window is
centred on each vector, not on a fixed grid.  Pairs that collide on at least ``threshold`` lines,
the largest number that still recalls the wanted share of true pairs, are verified by exact cosine.

Comparing the windows of whole lines would meet a fixed share of all pairs, so lines are grouped
into routes.  A route deals the vectors of a label into cells by the coarse grid of some of its
lines and sorts each cell by its last line into slabs, where a slab meets itself and the next one
within the window.  The number of grid lines follows the logarithm of the largest label, and the
number of routes the recall, so cells stay of one size as the table grows (:func:`calibrate`).
A pair that several routes bring together counts in the first of them only, which both vectors'
projections tell, so no pair ever leaves a task: tasks return link counts and star edges.

Equal vectors are one class from the start.  Slabs of many vectors (a dense group of different
ones) are cut into blocks that meet in tasks of their own.

Null, zero and non-finite vectors, vectors with null components and rows with a null label link
with nothing: no links, their own id, kept.  Vectors of different lengths never link.  Repeated
rows are vectors of their own, each counting the others; rows of one id are one node.  A row with
a null id counts and is counted; its ``component_id`` is the smallest id reached, null if there is
none, and it is kept only then.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common

#: Vectors of a slab beyond which it is cut into blocks of about this size.
BLOCK = 1024
#: Width of a grid cell and of a slab, in ``d``; half-width of the window, in ``d``.
GRID, SLAB, WINDOW = 6.0, 4.0, 2.0
MIN_COSINE, RECALL, SEED = 0.98, 0.995, 20


def _normal(x: float) -> float:
    return math.erf(x / math.sqrt(2))


@dataclass(frozen=True)
class Routes:
    """``n`` routes of ``grid`` lines and one sorted line each; links at ``threshold`` collisions."""

    d: float
    grid: int
    n: int
    threshold: int

    @property
    def lines(self) -> int:
        return self.n * (self.grid + 1)


def calibrate(largest: int, min_cosine: float = MIN_COSINE, recall: float = RECALL, block: int = BLOCK) -> Routes:
    """Routes for a label of ``largest`` vectors that miss at most ``1 - recall`` of the pairs right at
    ``min_cosine`` by route, and as many by count."""
    d = math.sqrt(2 - 2 * min_cosine)
    apart = min(0.9, GRID * d / (2 * math.sqrt(math.pi)))  # two unrelated unit vectors in one grid cell of a line
    grid = max(1, math.ceil(math.log(max(2, largest / (4 * block))) / -math.log(apart)))
    one = (1 - math.sqrt(2 / math.pi) / GRID) ** grid * _normal(WINDOW)
    n = max(3, math.ceil(math.log(1 - recall) / math.log(1 - one)))
    m, p = n * (grid + 1), _normal(WINDOW)
    tail, threshold = 0.0, m
    while True:
        tail += math.comb(m, threshold) * p ** threshold * (1 - p) ** (m - threshold)
        if tail >= recall or threshold == 1:
            return Routes(d, grid, n, threshold)
        threshold -= 1


def _lines(routes: Routes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, routes.lines)), rng.random(routes.lines)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


def _route(routes: Routes, with_vectors: bool):
    """Rows (unit, route, next, node, weight, lab, v): each class in its slab of each route, and as a
    ``next`` row in the slab below if that one's window reaches it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                a, shift = _lines(routes, int(dim))
                places = _unit(_matrix(own.column(4), int(dim))) @ a
                lab = own.column(2).to_numpy().view(np.uint64)
                for t in range(routes.n):
                    k = t * (routes.grid + 1)
                    cell = _mix(lab + np.uint64(1000003 * int(dim) + t))
                    for j in range(k, k + routes.grid):
                        grid = np.floor(places[:, j] / (GRID * routes.d) + shift[j]).astype(np.int64)
                        cell = _mix(cell * np.uint64(3) + grid.view(np.uint64))
                    line = places[:, k + routes.grid] / (SLAB * routes.d)
                    slab = np.floor(line).astype(np.int64)
                    near = (line - slab) * SLAB <= WINDOW * (1 + 1e-9)
                    for is_next, rows in ((False, np.arange(len(slab))), (True, np.flatnonzero(near))):
                        unit = _mix(cell[rows] * np.uint64(5) + (slab[rows] - is_next).view(np.uint64)).view(np.int64)
                        if not with_vectors:
                            yield pa.RecordBatch.from_arrays([pa.array(unit)], names=["unit"])
                            continue
                        part = own.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(unit), pa.array(np.full(len(rows), t, dtype=np.int32)),
                             pa.array(np.full(len(rows), is_next)), *(part.column(i) for i in (0, 1, 2, 3, 4))],
                            names=["unit", "route", "next", "node", "weight", "lab", "dim", "v"])

    return run


def _cells(rows: DataFrame, hot: DataFrame, block: int) -> DataFrame:
    """Adds (cell, diagonal, side): which pair of blocks a row takes part in.  Side 0 is the left one,
    1 the right one, 2 the right one of the next slab; on the diagonal the left side meets itself."""
    cut = rows.join(common.small_side(hot), "unit", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    cut = cut.withColumn("b", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    each = F.sequence(F.lit(0), F.col("n") - 1)
    row = lambda i, j, side: F.struct((i * F.col("n") + j).cast("int").alias("cell"), (i == j).alias("diagonal"),
                                      F.lit(side).alias("side"))
    left = F.transform(each, lambda j: row(F.col("b"), j, 0))
    right = F.transform(F.filter(each, lambda i: i < F.col("b")), lambda i: row(i, F.col("b"), 1))
    beyond = F.transform(each, lambda i: row(i, F.col("b"), 2))
    return cut.withColumn("s", F.explode(F.when(F.col("next"), beyond).otherwise(F.concat(left, right)))).select(
        "unit", "s.cell", "route", "s.diagonal", "s.side", "node", "weight", "lab", "dim", "v")


def _pairs(routes: Routes, min_cosine: float):
    """(a, b, links) of sorted cells: star edges a-b, and with b null the number of a's links found."""
    w, grid = WINDOW * routes.d, routes.grid

    def meets(t: int, x: np.ndarray, y: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Which pairs of projections route ``t`` brings together."""
        k = t * (grid + 1)
        ok = np.abs(x[:, k + grid] - y[:, k + grid]) <= w
        for j in range(k, k + grid):
            ok &= np.floor(x[:, j] / (GRID * routes.d) + shift[j]) == np.floor(y[:, j] / (GRID * routes.d) + shift[j])
        return ok

    def cell(route, diagonal, side, node, weight, lab, dim, v) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        t, (a, shift) = int(route[0]), _lines(routes, int(dim[0]))
        x = _unit(v)
        p = x @ a
        lefts, rights = np.flatnonzero(side == 0), np.flatnonzero(side > 0)
        if diagonal[0]:
            rights = np.r_[lefts, rights]
        found_a, found_b = [], []
        step = max(1, (1 << 20) // max(1, len(rights)))
        for lo in range(0, len(lefts), step):
            l = lefts[lo: lo + step]
            hits = np.zeros((len(l), len(rights)), dtype=np.uint16)
            for k in range(routes.lines):
                hits += np.abs(p[l, k][:, None] - p[rights, k][None, :]) <= w
            ok = hits >= routes.threshold
            if diagonal[0]:
                ok[:, : len(lefts)] &= np.arange(lo, lo + len(l))[:, None] < np.arange(len(lefts))[None, :]
            i, j = np.nonzero(ok)
            i, j = l[i], rights[j]
            for c in range(0, len(i), 1 << 17):
                ci, cj = i[c: c + (1 << 17)], j[c: c + (1 << 17)]
                good = (np.einsum("ij,ij->i", x[ci], x[cj]) >= min_cosine) & (lab[ci] == lab[cj])
                ci, cj = ci[good], cj[good]
                mine = meets(t, p[ci], p[cj], shift)
                for s in range(t):
                    mine &= ~meets(s, p[ci], p[cj], shift)
                found_a.append(ci[mine])
                found_b.append(cj[mine])
        i, j = (np.concatenate(f) if f else np.zeros(0, dtype=np.int64) for f in (found_a, found_b))
        links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        some = np.flatnonzero(links)
        a, b = common.stars(node[i], node[j]) if len(i) else (i, j)
        return node[some], links[some].astype(np.int64), a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.sorted_groups(batches, 2):
            if group.num_rows < 2:
                continue
            cols = [group.column(i).to_numpy() for i in range(2, 9)]
            dim = int(cols[6][0])
            if (cols[6] != dim).any():  # two cells by one hash
                group = group.filter(pa.array(cols[6] == dim))
                cols = [group.column(i).to_numpy() for i in range(2, 9)]
            node, links, a, b = cell(*cols, _matrix(group.column(9).combine_chunks(), dim))
            if len(node):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[node, a]), pa.array(np.r_[np.zeros_like(node), b], mask=np.arange(len(node) + len(a)) < len(node)),
                     pa.array(np.r_[links, np.zeros_like(a)])], names=["a", "b", "links"])

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    min_cosine: float = MIN_COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(id, n_links long, component_id, kept boolean), one row for each row of ``vectors``."""
    v = F.col(embedding)
    valid = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(v, lambda x: x != 0) & F.col(label).isNotNull(), F.lit(False))
    name = F.col(label).cast("string")
    rows = vectors.select(F.col(vec_id).alias("id"), valid.alias("valid"), F.when(valid, v).alias("v"),
                          F.xxhash64(name, F.lit(1)).alias("lab"), F.size(v).alias("dim"))
    rows = common.stored(rows.withColumns({"h1": F.xxhash64("lab", "v"), "h2": F.xxhash64("v", "lab", F.lit(2))}), "vectors")
    # a class of equal vectors; classes without an id are told apart by their hash
    node = F.coalesce(F.min("id"), F.lit(-(1 << 62)) - F.shiftrightunsigned("h1", 3))
    classes = common.stored(rows.filter("valid").groupBy("h1", "h2").agg(
        node.alias("node"), F.count("*").alias("weight"), F.first("lab").alias("lab"), F.first("dim").alias("dim"),
        F.first("v").alias("v")), "vector-classes")
    largest = classes.groupBy("lab", "dim").count().agg(F.max("count")).first()[0] or 0
    routes = calibrate(largest, min_cosine, recall, block)
    kind = classes.schema["v"].dataType.simpleString()
    narrow = classes.select("node", "weight", "lab", "dim", "v")
    hot = common.stored(narrow.mapInArrow(_route(routes, False), "unit long").groupBy("unit").count().filter(
        F.col("count") > block).select("unit", F.ceil(F.col("count") / block).cast("int").alias("n")), "vector-slabs")
    routed = narrow.mapInArrow(
        _route(routes, True), "unit long, route int, next boolean, node long, weight long, lab long, dim int, v " + kind)
    found = common.stored(_cells(routed, hot, block).repartition("unit", "cell").sortWithinPartitions("unit", "cell")
                          .mapInArrow(_pairs(routes, min_cosine), "a long, b long, links long"), "vector-links")
    links = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    reach = common.components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "reached")
    linked = classes.select("h1", "h2", "node", "weight").join(links, "node", "left").join(
        reach, F.col("node") == F.col("reached"), "left")
    linked = common.stored(linked.select("h1", "h2", F.coalesce("component", "node").alias("group"),
                                         (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector-nodes")
    member = rows.join(linked, ["h1", "h2"], "left")
    # the least id of a group: a node that is no id (of a class without any) gives way to those that are
    least = linked.join(classes.select("h1", "h2", "node"), ["h1", "h2"]).groupBy("group").agg(
        F.min(F.when(F.col("node") > F.lit(-(1 << 62)), F.col("node"))).alias("least"))
    out = member.join(least, "group", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                     F.when(F.col("valid"), F.col("least")).otherwise(F.col("id")).alias("component_id"))
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
