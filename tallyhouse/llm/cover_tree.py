"""Operator 11: exact top-k inner products by dual-tree search over cover trees.

Equal vectors are one node that knows its smallest ids (as many as a result can show), so a very common vector is compared
once.  Nodes are dealt to shards by a hash, and each shard's cover tree is built in one task.  The farthest-first order of a
shard's nodes gives the nets: the nodes that were at least r away from all before them are r apart and reach every node
within r.  Nets of halved r are the tree's levels, each node's parent the nearest of the level above; its covering radius is
measured over all it holds.  Nodes of the last level hold a few vectors each.

The stated queries are packed the same way, into blocks with a tree each.  Every shard's tree is shipped once and meets the
blocks one after another.  Both trees are descended together: for a query node with centre p and radius a, and a candidate
node with centre c and radius b, no product exceeds p.c + a|c| + b|p| + ab, and a pair of nodes is left where that is below
the worst k-th score of all queries in the node; between two last-level nodes each query has its own bound, p.c + b|p|.  Candidates are looked into from the largest bound down.  Scores are exact
integers; bounds are in doubles with a margin above their rounding, and a bound equal to the worst score is not left, since
an equal score may have a smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.workdir import settle

NEAREST = 10
#: Steps of a component's unit.
SCALE = 1024
#: Mean nodes of a shard and query vectors of a block; vectors that a last-level node holds in the mean.
SHARD_NODES, BLOCK_QUERIES, LEAF = 8192, 1024, 24
#: Candidates scored together.
TOGETHER = 512
#: Sums up to which doubles add integers exactly.
EXACT = 2.0**53

TREE = "shard int, dim int, n int, vectors binary, ids binary, id_ends binary, levels array<struct<centres: binary, radii: binary, ends: binary>>"


class CoverTree:
    """A cover tree over integer vectors.

    ``levels`` go from the root down: the nodes' centres (numbers of vectors), their covering radii, and the bounds of their
    children in the level below, of the last level in the vectors, which are stored in that order.
    """

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.integers, self.levels = vectors, levels
        self.vectors = vectors.astype(np.float64)
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))

    @staticmethod
    def _farthest_first(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers in farthest-first order and the distance of each to those before it."""
        chosen, away = [0], [np.inf]
        nearest = ((x - x[0]) ** 2).sum(axis=1)
        while len(chosen) < most:
            k = int(nearest.argmax())
            if nearest[k] == 0:
                break
            chosen.append(k)
            away.append(float(np.sqrt(nearest[k])))
            np.minimum(nearest, ((x - x[k]) ** 2).sum(axis=1), out=nearest)
        return np.array(chosen), np.array(away)

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """The number of each vector's nearest centre."""
        squares = (centres**2).sum(axis=1)
        return np.concatenate([(squares - 2 * (x[k : k + 4096] @ centres.T)).argmin(axis=1) for k in range(0, len(x), 4096)])

    @classmethod
    def build(cls, vectors: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree over the vectors, and the order in which it stores them."""
        x = vectors.astype(np.float64)
        order, away = cls._farthest_first(x, max(1, -(-len(x) // LEAF)))
        sizes, r = [1], float(away[1]) if len(away) > 1 else 0.0
        while sizes[-1] < len(order):
            r /= 2
            size = int((away > r).sum())
            if size > sizes[-1]:
                sizes.append(size)
        # each vector's way up: the nearest centre of the last net, then the nearest of the net above
        way = [cls._nearest(x, x[order[: sizes[-1]]])]
        way[0][order[: sizes[-1]]] = np.arange(sizes[-1])
        for size, below in zip(sizes[-2::-1], sizes[:0:-1], strict=True):
            up = cls._nearest(x[order[:below]], x[order[:size]])
            up[:size] = np.arange(size)  # a centre is its own child
            way.append(up[way[-1]])
        way = way[::-1]
        stored = np.lexsort(way[::-1])
        place = np.empty(len(x), np.int64)
        place[stored] = np.arange(len(x))
        levels, below = [], np.arange(len(x) + 1)
        for size, own in list(zip(sizes, way, strict=True))[::-1]:
            own = own[stored]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            centre = order[own[starts]]
            reach = np.sqrt(((x[stored] - x[order[own]]) ** 2).sum(axis=1))
            radii = np.maximum.reduceat(reach, starts) * (1 + 1e-9)
            ends = np.searchsorted(below, np.r_[starts, len(x)])
            levels.append((place[centre], radii, ends))
            below = np.r_[starts, len(x)]
        return cls(vectors[stored], levels[::-1]), stored

    def packed(self) -> list[dict[str, bytes]]:
        return [{"centres": c.astype("<i8").tobytes(), "radii": r.astype("<f8").tobytes(), "ends": e.astype("<i8").tobytes()} for c, r, e in self.levels]

    @classmethod
    def unpacked(cls, vectors: np.ndarray, levels: list[dict[str, bytes]]) -> CoverTree:
        return cls(vectors, [(np.frombuffer(v["centres"], "<i8"), np.frombuffer(v["radii"], "<f8"), np.frombuffer(v["ends"], "<i8")) for v in levels])

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Numbers in the level below, or of vectors, under some nodes."""
        ends = self.levels[level][2]
        n = ends[nodes + 1] - ends[nodes]
        return np.repeat(ends[nodes] - (np.cumsum(n) - n), n) + np.arange(n.sum())


class DualSearch:
    """The best candidates of every query vector of one tree among those of another."""

    def __init__(self, queries: CoverTree, candidates: CoverTree, first_ids: np.ndarray, k: int):
        self.q, self.c, self.first_ids, self.k = queries, candidates, first_ids, k
        n, least = len(queries.integers), -np.iinfo(np.int64).max  # its negative is a long too
        self.scores = np.full((n, k), least)
        self.found = np.full((n, k), -1)
        largest = max(np.abs(t.vectors).max(initial=0) for t in (queries, candidates))
        self.in_doubles = largest**2 * queries.integers.shape[1] < EXACT
        self.margin = 1e-9 * float(queries.norms.max() * candidates.norms.max()) + 1e-6

    def run(self) -> DualSearch:
        self._visit(0, 0, 0, np.zeros(1, np.int64))
        return self

    def _vectors(self, level: int, node: int) -> slice:
        """The query vectors of a node."""
        lo, hi = node, node + 1
        for _, _, ends in self.q.levels[level:]:
            lo, hi = int(ends[lo]), int(ends[hi])
        return slice(lo, hi)

    def _bounds(self, level: int, node: int, below: int, nodes: np.ndarray) -> np.ndarray:
        centre, radius = self.q.levels[level][0][node], self.q.levels[level][1][node]
        centres, radii = self.c.levels[below][0][nodes], self.c.levels[below][1][nodes]
        products = self.c.vectors[centres] @ self.q.vectors[centre]
        return products + radius * self.c.norms[centres] + radii * self.q.norms[centre] + radius * radii + self.margin

    def _visit(self, level: int, node: int, below: int, nodes: np.ndarray) -> None:
        own = self._vectors(level, node)
        bounds = self._bounds(level, node, below, nodes)
        stays = bounds >= self.scores[own, -1].min()
        nodes, bounds = nodes[stays], bounds[stays]
        order = np.argsort(-bounds, kind="stable")
        nodes, bounds = nodes[order], bounds[order]
        if not len(nodes):
            return
        last_query, last_candidate = level == len(self.q.levels) - 1, below == len(self.c.levels) - 1
        if not last_query:
            for child in self.q.children(level, np.array([node])):
                self._visit(level + 1, int(child), *((below, nodes) if last_candidate else (below + 1, self.c.children(below, nodes))))
        elif not last_candidate:
            self._visit(level, node, below + 1, self.c.children(below, nodes))
        else:
            # single queries now, whose own radius is nothing
            centres, radii, ends = self.c.levels[below]
            bounds = self.q.vectors[own] @ self.c.vectors[centres[nodes]].T + self.q.norms[own, None] * radii[nodes] + self.margin
            order = np.argsort(-bounds.max(axis=0), kind="stable")
            nodes, bounds = nodes[order], bounds[:, order]
            sizes = np.cumsum(ends[nodes + 1] - ends[nodes])
            at = 0
            while at < len(nodes):
                upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER)) + 1
                some = nodes[at:upto][(bounds[:, at:upto] >= self.scores[own, -1:]).any(axis=0)]
                if len(some):
                    self._score(own, self.c.children(below, some))
                at = upto

    def _score(self, own: slice, candidates: np.ndarray) -> None:
        if self.in_doubles:
            scores = (self.q.vectors[own] @ self.c.vectors[candidates].T).astype(np.int64)
        else:
            scores = self.q.integers[own] @ self.c.integers[candidates].T
        reach = (scores >= self.scores[own, -1:]).any(axis=0)
        scores, candidates = scores[:, reach], candidates[reach]
        scores = np.concatenate([self.scores[own], scores], axis=1)
        found = np.concatenate([self.found[own], np.broadcast_to(candidates, (len(scores), len(candidates)))], axis=1)
        ids = np.where(found >= 0, self.first_ids[found], np.iinfo(np.int64).max)
        top = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[own] = np.take_along_axis(scores, top, axis=1)
        self.found[own] = np.take_along_axis(found, top, axis=1)


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of vectors that take part, in whole steps: an id, a component, all finite; repeated rows once."""
    values = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v")).filter("vec_id is not null and size(v) > 0")
    rows = rows.filter("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return rows.selectExpr("vec_id", f"transform(v, x -> cast(floor({scale} * x) as long)) as vector").distinct()


def build_trees(vectors: DataFrame, members: int, mean_nodes: int) -> DataFrame:
    """One row per shard and dimension with its cover tree.  Every vector is in one; equal ones keep their smallest ids."""
    in_order = Window.partitionBy("vector").orderBy("vec_id")
    nodes = vectors.withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= members)
    nodes = settle(nodes.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "tree-nodes")  # at most ``members`` ids
    shards = max(1, -(-nodes.count() // mean_nodes))
    nodes = nodes.withColumn("dim", F.size("vector")).withColumn("shard", F.expr(f"cast(pmod(xxhash64(vector), {shards}) as int)"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(first=[v[0] for v in rows["ids"]]).sort_values("first", kind="stable")
        tree, stored = CoverTree.build(np.stack(rows["vector"].to_list()))
        kept = [rows["ids"].iat[i] for i in stored]
        ends = np.cumsum([len(v) for v in kept]).astype("<i8")
        row = (int(rows["shard"].iat[0]), tree.integers.shape[1], len(kept), tree.integers.astype("<i8").tobytes(), np.concatenate(kept).astype("<i8").tobytes(), ends.tobytes(), tree.packed())
        return pd.DataFrame([row], columns=["shard", "dim", "n", "vectors", "ids", "id_ends", "levels"])

    return settle(nodes.groupBy("shard", "dim").applyInPandas(build, TREE), "cover-trees")


def _read(row: dict) -> tuple[CoverTree, np.ndarray, np.ndarray]:
    tree = CoverTree.unpacked(np.frombuffer(row["vectors"], "<i8").reshape(row["n"], row["dim"]), row["levels"])
    return tree, np.frombuffer(row["ids"], "<i8"), np.r_[0, np.frombuffer(row["id_ends"], "<i8")]


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's best of all shards of its dimension but itself; ties to the smaller id.

    ``queries`` are rows of ``whole_vectors``.  Equal query vectors are searched once, with one result more than asked for,
    and told apart by a 64-bit hash.
    """
    queries = settle(queries.withColumn("query_key", F.xxhash64("vector")), "tree-queries")
    trees = build_trees(queries.select(F.col("query_key").alias("vec_id"), "vector").distinct(), 1, BLOCK_QUERIES)
    last = index.agg(F.max("shard")).first()[0] or 0  # shards are numbered from 0
    fields = ["n", "vectors", "ids", "id_ends", "levels"]
    spread = trees.selectExpr(f"explode(sequence(0, {last})) as part", "dim", "1 as kind", "shard as place", *fields)
    shards = index.selectExpr("shard as part", "dim", "0 as kind", "0 as place", *fields)
    both = shards.unionByName(spread).repartition(last + 1, "part", "dim").sortWithinPartitions("part", "dim", "kind", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, candidates = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["kind"] == 0:
                    here, candidates = (row["part"], row["dim"]), _read(row)
                elif here == (row["part"], row["dim"]):
                    tree, ids, ends = candidates
                    asked, keys, _ = _read(row)
                    best = DualSearch(asked, tree, ids[ends[:-1]], k + 1).run()
                    own, node = np.nonzero(best.found >= 0)
                    node, score = best.found[own, node], best.scores[own, node]
                    n = ends[node + 1] - ends[node]
                    at = np.repeat(ends[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    columns = (np.repeat(keys[own], n), ids[at], np.repeat(score, n))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_key", "vec_id", "score"])

    found = both.mapInArrow(run, "query_key long, vec_id long, score long")
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).select("query_key", "vec_id", "score")
    asked = queries.select(F.col("vec_id").alias("query_id"), "query_key")
    found = asked.join(found, "query_key").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def inner_product_search(embeddings: DataFrame, every: int = 100, k: int = NEAREST) -> DataFrame:
    """The stated queries, rows whose id is divisible by ``every``, against all other rows.

    Vectors that are null, empty or hold a null or non-finite component, and rows without an id, take no part; zero vectors
    do.  Repeated rows count once; rows that share an id and not the vector are candidates of their own, and none of them is
    returned for that id.  A vector meets those of its own dimension only.  Fewer than k candidates are all returned; an
    empty table gives an empty result.
    """
    queries = whole_vectors(embeddings.filter(F.col("vec_id") % every == 0))
    return search(build_trees(whole_vectors(embeddings), k + 1, SHARD_NODES), queries, k)
