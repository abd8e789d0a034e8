"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged.

Rows are dealt to shards of a bounded size by the range of their length and a hash of their
id. Each shard becomes a hierarchical navigable small-world graph, kept as flat arrays of
neighbours, one per layer. The queries, in blocks, go to every shard; each shard returns its
nearest, scored in double precision on the original vectors, and the best of all shards remain.

For the largest inner product every vector gets one more component that brings all to the same
length (and 0 in a query); the nearest of equal length are those of the largest inner product.
A vector much longer than the others would drown their differences in that component, so a
graph only holds vectors whose lengths differ by less than ``RANGE``, scaled in double precision
to a longest of 1 before anything is single precision.
Equal vectors of a shard are one point of its graph, so that copies do not fill each other's
neighbour lists.

Points enter the graph in batches, which grow with the graph: a batch is searched in
the graph as it stands and in itself, all its points at once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.sources.shelf import pin

#: Rows of a shard; queries of a block; blocks that meet one copy of a shard's graph.
SHARD_ROWS = 32_768
BLOCK_ROWS = 2048
BLOCKS_AT_ONCE = 16
#: The longest vector of a graph is less than this many times as long as the shortest.
RANGE = 4
#: Neighbours in upper layers (twice as many in the lowest), breadth of building and search.
LINKS = 16
BUILD_BREADTH = 40
SEARCH_BREADTH = 96
BATCH = 256


class Graph:
    """Neighbours by layer: an array (points of the layer, links), -1 where there is none."""

    def __init__(self, points: np.ndarray, links: int = LINKS, breadth: int = BUILD_BREADTH):
        self.points = np.ascontiguousarray(points, np.float32)
        n = len(points)
        rng = np.random.default_rng(n)
        draw = 1.0 - rng.random(n)
        level = (-np.log(draw) / math.log(links)).astype(int)
        # the highest come first, so that the first point is the entry to all layers
        order = np.argsort(-level, kind="stable")
        self.points, level = self.points[order], level[order]
        self.order = order
        self.layers = [
            np.full(((level >= h).sum(), links * (1 if h else 2)), -1, np.int32)
            for h in range(level[0] + 1 if n else 1)
        ]
        done = 1
        while done < n:
            end = min(n, done + min(BATCH, done))
            self._insert(np.arange(done, end), done, breadth)
            done = end

    @classmethod
    def load(cls, points: np.ndarray, layers: list[np.ndarray]) -> Graph:
        graph = cls.__new__(cls)
        graph.points, graph.layers = points, layers
        return graph

    def _insert(self, new: np.ndarray, done: int, breadth: int) -> None:
        vectors = self.points[new]
        seeds = np.zeros((len(new), 1), np.int32)
        within = vectors @ vectors.T
        np.fill_diagonal(within, -np.inf)
        for h in range(len(self.layers) - 1, -1, -1):
            layer = self.layers[h]
            there = min(done, len(layer))  # points of the layer already in the graph
            mine = new < len(layer)
            wide = breadth if mine.any() else 1
            found, sims = self._beam(vectors, seeds, layer, there, wide)
            seeds = found
            if not mine.any():
                continue
            # the batch's own points of this layer are candidates too
            own = np.flatnonzero(mine)
            near = within[np.ix_(own, own)]
            k = min(breadth, len(own))
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            ids = np.concatenate([found[own], new[own][top]], axis=1)
            near = np.concatenate([sims[own], np.take_along_axis(near, top, axis=1)], axis=1)
            ids = np.where(np.isfinite(near), ids, -1)
            width = layer.shape[1]
            chosen = self._choose(ids, near, max(width // 2, LINKS // 2) if h == 0 else width)
            layer[new[own], : chosen.shape[1]] = chosen
            self._link_back(layer, new[own], chosen)

    def _choose(self, ids: np.ndarray, sims: np.ndarray, limit: int) -> np.ndarray:
        """Up to ``limit`` candidates a row: near ones that no chosen one is nearer to."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids = np.take_along_axis(ids, order, axis=1)
        sims = np.take_along_axis(sims, order, axis=1)
        open_ = ids >= 0
        vectors = self.points[np.maximum(ids, 0)]
        among = np.einsum("bid,bjd->bij", vectors, vectors, optimize=True)
        covered = np.full(ids.shape, -np.inf, np.float32)  # nearness to any chosen one
        taken = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), int)
        for j in range(ids.shape[1]):
            take = open_[:, j] & (count < limit) & (sims[:, j] > covered[:, j])
            taken[:, j] = take
            count += take
            covered[take] = np.maximum(covered[take], among[take, j])
        # fill up with the nearest that were passed over
        for j in range(ids.shape[1]):
            take = open_[:, j] & ~taken[:, j] & (count < limit)
            taken[:, j] |= take
            count += take
        first = np.argsort(~taken, axis=1, kind="stable")[:, :limit]
        out = np.take_along_axis(ids, first, axis=1)
        return np.where(np.take_along_axis(taken, first, axis=1), out, -1).astype(np.int32)

    def _link_back(self, layer: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
        source = np.repeat(new, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, begin, size = np.unique(target, return_index=True, return_counts=True)
        most = int(size.max()) if len(size) else 0
        if not most:
            return
        more = np.full((len(nodes), most), -1, np.int32)
        rank = np.arange(len(target)) - np.repeat(begin, size)
        more[np.repeat(np.arange(len(nodes)), size), rank] = source
        # a new point may have chosen the other already
        both = (more[:, :, None] == layer[nodes][:, None, :]).any(axis=2)
        more[both] = -1
        all_ = np.concatenate([layer[nodes], more], axis=1)
        width = layer.shape[1]
        full = (all_ >= 0).sum(axis=1) > width
        fits = np.flatnonzero(~full)
        packed = np.take_along_axis(
            all_[fits], np.argsort(all_[fits] < 0, axis=1, kind="stable"), axis=1
        )
        layer[nodes[fits]] = packed[:, :width]
        for part in np.array_split(np.flatnonzero(full), max(1, full.sum() // BATCH)):
            if len(part):
                ids = all_[part]
                sims = np.einsum(
                    "bd,bkd->bk", self.points[nodes[part]], self.points[np.maximum(ids, 0)]
                )
                sims = np.where(ids >= 0, sims, -np.inf)
                layer[nodes[part]] = self._choose(ids, sims, width)

    def _beam(self, queries, seeds, layer, there: int, breadth: int):
        """The ``breadth`` nearest that a best-first walk finds, by row: ids and nearness."""
        rows = np.arange(len(queries))
        seen = np.zeros((len(queries), there), bool)
        ids = np.full((len(queries), breadth), -1, np.int32)
        sims = np.full((len(queries), breadth), -np.inf, np.float32)
        spent = np.ones((len(queries), breadth), bool)
        k = min(breadth, seeds.shape[1])
        start = seeds[:, :k]
        ids[:, :k] = start
        ok = start >= 0
        sims[:, :k] = np.where(
            ok, np.einsum("bd,bkd->bk", queries, self.points[np.maximum(start, 0)]), -np.inf
        )
        spent[:, :k] = ~ok
        r, c = np.nonzero(ok)
        seen[r, start[r, c]] = True
        at_once = 2 if breadth > 8 else 1
        active = rows
        while len(active):
            open_ = np.where(spent[active], -np.inf, sims[active])
            best = np.argpartition(-open_, at_once - 1, axis=1)[:, :at_once]
            live = np.isfinite(np.take_along_axis(open_, best, axis=1))
            some = live.any(axis=1)
            active, best, live = active[some], best[some], live[some]
            if not len(active):
                break
            spent[active[:, None], best] = True
            steps = layer[np.maximum(ids[active[:, None], best], 0)]
            steps = np.where(live[:, :, None], steps, -1).reshape(len(active), -1)
            steps = np.where(steps < there, steps, -1)
            fresh = (steps >= 0) & ~seen[active[:, None], np.maximum(steps, 0)]
            r, c = np.nonzero(fresh)
            seen[active[r], steps[r, c]] = True
            near = np.full(steps.shape, -np.inf, np.float32)
            near[r, c] = np.einsum("nd,nd->n", queries[active[r]], self.points[steps[r, c]])
            # two of the steps may be one point
            order = np.argsort(steps, axis=1, kind="stable")
            sorted_ = np.take_along_axis(steps, order, axis=1)
            twice = np.zeros(steps.shape, bool)
            twice[:, 1:] = sorted_[:, 1:] == sorted_[:, :-1]
            back = np.empty_like(order)
            np.put_along_axis(back, order, np.arange(steps.shape[1])[None, :], axis=1)
            near[np.take_along_axis(twice, back, axis=1)] = -np.inf
            all_ids = np.concatenate([ids[active], steps], axis=1)
            all_sims = np.concatenate([sims[active], near], axis=1)
            all_spent = np.concatenate([spent[active], ~np.isfinite(near)], axis=1)
            keep = np.argpartition(-all_sims, breadth - 1, axis=1)[:, :breadth]
            ids[active] = np.take_along_axis(all_ids, keep, axis=1)
            sims[active] = np.take_along_axis(all_sims, keep, axis=1)
            spent[active] = np.take_along_axis(all_spent, keep, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        sims = np.take_along_axis(sims, order, axis=1)
        ids = np.where(np.isfinite(sims), np.take_along_axis(ids, order, axis=1), -1)
        return ids, sims

    def search(self, queries: np.ndarray, breadth: int) -> np.ndarray:
        """Places in ``points`` of up to ``breadth`` near points per query, -1 where none."""
        if not len(self.points):
            return np.full((len(queries), 0), -1, np.int32)
        seeds = np.zeros((len(queries), 1), np.int32)
        for h in range(len(self.layers) - 1, 0, -1):
            seeds, _ = self._beam(queries, seeds, self.layers[h], len(self.layers[h]), 4)
        return self._beam(queries, seeds, self.layers[0], len(self.points), breadth)[0]


def _matrix(column, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


_INDEX = "shard bigint, ids binary, place binary, vectors binary, graph binary, layers binary"


def _build(width: int, links: int, breadth: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("vector"), width)
        points, place = np.unique(vectors, axis=0, return_inverse=True)
        place = place.ravel()
        scaled = _scaled(points)
        extra = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
        graph = Graph(np.column_stack([scaled, extra]), links, breadth)
        # places in the graph's order
        where = np.empty(len(points), np.int64)
        where[graph.order] = np.arange(len(points))
        place = where[place]
        by_place = np.lexsort((ids, place))
        sizes = np.array([layer.shape for layer in graph.layers], np.int64)
        return pa.table(
            {
                "shard": [table.column("shard")[0].as_py()],
                "ids": [ids[by_place].tobytes()],
                "place": [place[by_place].tobytes()],
                "vectors": [points[graph.order].tobytes()],
                "graph": [b"".join(layer.tobytes() for layer in graph.layers)],
                "layers": [sizes.tobytes()],
            }
        )

    return run


def _scaled(points: np.ndarray) -> np.ndarray:
    """``points``, none of them zero, by one factor to a longest of 1; no square can overflow."""
    points = points / np.abs(points).max()
    return points / np.sqrt((points**2).sum(axis=1).max())


def length_range(vector: Column) -> Column:
    """The power of RANGE that a vector's length begins, from logarithms."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(x / largest, 2.0))
    return F.floor((F.log2(largest) + F.log2(squares) / 2) / math.log2(RANGE)).cast("int")


def _dealt(vectors: DataFrame, shard_rows: int) -> tuple[DataFrame, int]:
    """``vectors`` with their shard, and the number of shards."""
    ranged = vectors.withColumn("range", length_range(F.col("vector")))
    # doubles have about 2100 binary exponents, so this has about 1050 rows at most
    counts = {r.range: r["count"] for r in ranged.groupBy("range").count().collect()}
    deal, shards = [], 0
    for k in sorted(counts):
        parts = math.ceil(counts[k] / shard_rows)
        deal.append((k, shards, parts))
        shards += parts
    table = vectors.sparkSession.createDataFrame(deal, "range int, first bigint, parts bigint")
    shard = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return ranged.join(F.broadcast(table), "range").withColumn("shard", shard), shards


def build_index(
    dealt: DataFrame, width: int, links: int = LINKS, breadth: int = BUILD_BREADTH
) -> DataFrame:
    """One row per shard of ``dealt`` (shard, vec_id, vector of doubles) with its graph."""
    dealt = dealt.select("shard", "vec_id", "vector")
    return dealt.groupBy("shard").applyInArrow(_build(width, links, breadth), _INDEX)


def _search(width: int, k: int, breadth: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        for row in left.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            place = np.frombuffer(row["place"], np.int64)
            exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, width)
            flat, layers, at = np.frombuffer(row["graph"], np.int32), [], 0
            for n, m in np.frombuffer(row["layers"], np.int64).reshape(-1, 2).tolist():
                layers.append(flat[at : at + n * m].reshape(n, m))
                at += n * m
            graph = Graph.load(_scaled(exact).astype(np.float32), layers)
            first = np.searchsorted(place, np.arange(len(exact)))
            last = np.searchsorted(place, np.arange(len(exact)), side="right")
            for block in right.column("block").to_pylist():
                queries = np.array([q["vector"] for q in block], np.float64)
                names = [q["vec_id"] for q in block]
                for i in range(0, len(block), BATCH):
                    part = queries[i : i + BATCH]
                    # only the order of a query's scores matters to the walk
                    unit = np.concatenate([_scaled(q[None, :]) for q in part])
                    found = graph.search(unit.astype(np.float32), max(breadth, k + 1))
                    for j, points in enumerate(found):
                        points = points[points >= 0]
                        scores = exact[points] @ part[j]
                        mine = names[i + j]
                        order = np.argsort(-scores, kind="stable")
                        got: list[tuple[float, int]] = []
                        for at in order.tolist():
                            if len(got) >= k and -scores[at] > got[k - 1][0]:
                                break
                            p = points[at]
                            copies = ids[first[p] : min(last[p], first[p] + k + 1)].tolist()
                            got += [(-scores[at], v) for v in copies if v != mine]
                            got.sort()
                        for s, v in got[:k]:
                            out_q.append(mine)
                            out_v.append(v)
                            out_s.append(-s)
        return pa.table(
            {
                "query_id": pa.array(out_q, pa.int64()),
                "vec_id": pa.array(out_v, pa.int64()),
                "score": pa.array(out_s, pa.float64()),
            }
        )

    return run


def nearest(
    table: DataFrame,
    queries: DataFrame,
    k: int = 20,
    shard_rows: int = SHARD_ROWS,
    links: int = LINKS,
    build_breadth: int = BUILD_BREADTH,
    search_breadth: int = SEARCH_BREADTH,
) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``table`` of the largest inner product.

    Both have vec_id and embedding. Gives query_id, rank from 1, vec_id and score, nearest
    first, ties by the smaller vec_id; all others, if there are fewer than ``k``. A query's own
    row, that is its id, is no candidate. Rows with a null id, or whose vector is null, zero,
    of another width than most, or holds a null or non-finite component take no part. Rows
    repeated under one id count once, of different vectors the least. Empty tables give an
    empty result. Equal vectors are found together.
    """
    usable = pin(_usable(table), "vectors")
    widths = usable.groupBy(F.size("vector").alias("width")).count()
    most = widths.orderBy(F.desc("count"), "width").first()
    width = most.width if most else 1
    usable = usable.where(F.size("vector") == width)
    usable = usable.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    dealt, shards = _dealt(usable, shard_rows)
    index = pin(build_index(dealt, width, links, build_breadth), "graphs")

    asked = _usable(queries).where(F.size("vector") == width)
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = pin(asked, "queries")
    n_blocks = max(1, math.ceil(asked.count() / BLOCK_ROWS))
    n_sets = max(1, math.ceil(n_blocks / BLOCKS_AT_ONCE))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(n_blocks))
    blocks = (
        asked.groupBy(block.alias("number"))
        .agg(F.collect_list(F.struct("vec_id", "vector")).alias("block"))
        .select(F.pmod("number", F.lit(n_sets)).alias("set"), "block")
    )
    every_shard = blocks.withColumn("shard", F.explode(_numbers(max(shards, 1))))
    every_set = index.withColumn("set", F.explode(_numbers(n_sets)))
    found = (
        every_set.groupBy("shard", "set")
        .cogroup(every_shard.groupBy("shard", "set"))
        .applyInArrow(
            _search(width, k, search_breadth), "query_id bigint, vec_id bigint, score double"
        )
    )
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _numbers(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _usable(table: DataFrame) -> DataFrame:
    rows = pick(table, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return rows.where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("vector", lambda x: x != 0)
    )
