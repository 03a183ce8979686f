"""Operator 7: approximate nearest neighbours by one hierarchical navigable small-world graph per shard.

Equal vectors are one node that knows its smallest ids (as many as a result can show), so a very common vector does not fill a
neighbourhood.  Nodes are dealt to shards of bounded size by a hash; each shard's graph is built in one task and stored as flat
arrays: vectors, member ids, and per layer the nodes and a rectangle of neighbour numbers.  The stated queries are packed into
blocks; every block meets every shard of its dimension, the shard's best are scored in double precision, and the shards'
results are merged per query.  A task holds a group of shards and the blocks stream past them, so a block is sent to each group
and not to each shard, nothing is joined or broadcast, and a group answers with one merged list per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.workdir import settle

NEAREST = 10
#: Mean nodes of a shard and queries of a block.
SHARD_NODES, BLOCK_QUERIES = 4096, 1024
#: Shards that a task of a search may hold (some 3 MB each for 64 dimensions), and tasks of a search for each core, where there are shards and blocks for them.
SHARDS_TOGETHER, TASKS_PER_CORE = 32, 3
#: Links of a node (twice as many on the ground layer), candidates kept while building and while searching.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 80, 120
SEED = 20

INDEX = "shard int, dim int, n int, vectors binary, ids binary, id_ends binary, layers array<struct<nodes: binary, neighbours: binary>>"


class SmallWorld:
    """The graph of one shard."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float32)
        self.squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.nodes: list[np.ndarray] = []  # per layer, ascending
        self.neighbours: list[np.ndarray] = []  # per layer, one row per node of it, filled up with -1
        self.rows: list[np.ndarray] = []  # per layer, the row of each node

    def _distances(self, query: np.ndarray, some: np.ndarray) -> np.ndarray:
        return self.squares[some] - 2 * (self.vectors[some] @ query)

    def _look(self, query: np.ndarray, entry: int, width: int, layer: int) -> list[tuple[float, int]]:
        """The nearest nodes of a layer, ascending, reached greedily from the entry."""
        links, rows = self.neighbours[layer], self.rows[layer]
        seen = np.zeros(len(self.vectors) + 1, bool)
        seen[[entry, -1]] = True  # the filling counts as seen
        start = float(self._distances(query, np.array([entry]))[0])
        ahead, found = [(start, entry)], [(-start, entry)]
        while ahead:
            distance, node = heapq.heappop(ahead)
            if distance > -found[0][0] and len(found) >= width:
                break
            fresh = links[rows[node]]
            fresh = fresh[~seen[fresh]]
            if not len(fresh):
                continue
            seen[fresh] = True
            distances = self._distances(query, fresh)
            if len(found) >= width:
                near = distances < -found[0][0]
                fresh, distances = fresh[near], distances[near]
            for d, other in zip(distances.tolist(), fresh.tolist(), strict=True):
                if len(found) < width:
                    heapq.heappush(found, (-d, other))
                elif d < -found[0][0]:
                    heapq.heapreplace(found, (-d, other))
                else:
                    continue
                heapq.heappush(ahead, (d, other))
        return sorted((-d, node) for d, node in found)

    def _choose(self, query: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
        """Neighbours nearer to the node than to those chosen before, filled up with the nearest left."""
        points = self.vectors[candidates]
        to_query = self.squares[candidates] - 2 * (points @ query) + query @ query
        order = np.argsort(to_query, kind="stable")
        candidates, points, to_query = candidates[order], points[order], to_query[order]
        if len(candidates) <= most:
            return candidates
        squares = self.squares[candidates]
        between = squares[:, None] + squares[None] - 2 * (points @ points.T)
        chosen: list[int] = []
        nearest_chosen = np.full(len(candidates), np.inf)
        for k in range(len(candidates)):
            if to_query[k] < nearest_chosen[k]:
                chosen.append(k)
                np.minimum(nearest_chosen, between[k], out=nearest_chosen)
                if len(chosen) == most:
                    break
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [k for k in range(len(candidates)) if k not in taken][: most - len(chosen)]
        return candidates[chosen]

    def _link(self, layer: int, node: int, to: np.ndarray) -> None:
        """Links a new node both ways; a full neighbour chooses anew."""
        links, rows = self.neighbours[layer], self.rows[layer]
        links[rows[node], : len(to)] = to
        for other in to.tolist():
            mine = links[rows[other]]
            held = mine[mine >= 0]
            if len(held) < len(mine):
                mine[len(held)] = node
            else:
                mine[:] = self._choose(self.vectors[other], np.append(held, node), len(mine))

    def build(self) -> SmallWorld:
        n = len(self.vectors)
        rng = np.random.default_rng(SEED)
        tops = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 8)
        for layer in range(int(tops.max(initial=0)) + 1):
            nodes = np.flatnonzero(tops >= layer)
            rows = np.full(n, -1)
            rows[nodes] = np.arange(len(nodes))
            self.nodes.append(nodes)
            self.rows.append(rows)
            self.neighbours.append(np.full((len(nodes), LINKS * (2 if layer == 0 else 1)), -1, np.int32))
        entry, height = -1, -1
        for node in range(n):
            query, top = self.vectors[node], int(tops[node])
            at = entry
            for layer in range(height, top, -1):
                at = self._look(query, at, 1, layer)[0][1]
            for layer in range(min(top, height), -1, -1):
                near = self._look(query, at, BUILD_WIDTH, layer)
                at = near[0][1]
                self._link(layer, node, self._choose(query, np.array([k for _, k in near]), LINKS))
            if top > height:
                entry, height = node, top
        return self

    def search(self, query: np.ndarray, k: int) -> np.ndarray:
        """Numbers of about the k nearest nodes, nearest first."""
        query = query.astype(np.float32)
        at = int(self.nodes[-1][0])
        for layer in range(len(self.nodes) - 1, 0, -1):
            at = self._look(query, at, 1, layer)[0][1]
        return np.array([node for _, node in self._look(query, at, max(SEARCH_WIDTH, k), 0)[:k]], int)

    def layers(self) -> list[dict[str, bytes]]:
        return [{"nodes": a.astype("<i4").tobytes(), "neighbours": b.astype("<i4").tobytes()} for a, b in zip(self.nodes, self.neighbours, strict=True)]

    @classmethod
    def from_layers(cls, vectors: np.ndarray, layers: list[dict[str, bytes]]) -> SmallWorld:
        world = cls(vectors)
        for k, layer in enumerate(layers):
            nodes = np.frombuffer(layer["nodes"], "<i4")
            rows = np.full(len(vectors), -1)
            rows[nodes] = np.arange(len(nodes))
            world.nodes.append(nodes)
            world.rows.append(rows)
            world.neighbours.append(np.frombuffer(layer["neighbours"], "<i4").reshape(len(nodes), LINKS * (2 if k == 0 else 1)))
        return world


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of vectors that take part: an id, some component, all finite, not all zero; repeated rows once."""
    values = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding")).filter("vec_id is not null and size(embedding) > 0")
    whole = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    return rows.filter(whole).distinct()


def build_index(embeddings: DataFrame, members: int = NEAREST + 1) -> DataFrame:
    """One row per shard and dimension with its graph.  Every vector is indexed; equal ones keep their smallest ids."""
    in_order = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = usable(embeddings).withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= members)
    nodes = nodes.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))  # at most ``members`` ids
    nodes = settle(nodes, "vector-nodes")
    shards = max(1, -(-nodes.count() // SHARD_NODES))
    nodes = nodes.withColumn("dim", F.size("embedding")).withColumn("shard", F.expr(f"cast(pmod(xxhash64(embedding), {shards}) as int)"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(first=[v[0] for v in rows["ids"]]).sort_values("first", kind="stable")
        vectors = np.stack(rows["embedding"].to_list())
        ids = np.concatenate(rows["ids"].to_list()).astype("<i8")
        ends = np.cumsum([len(v) for v in rows["ids"]]).astype("<i8")
        row = (int(rows["shard"].iat[0]), vectors.shape[1], len(vectors), vectors.astype("<f8").tobytes(), ids.tobytes(), ends.tobytes(), SmallWorld(vectors).build().layers())
        return pd.DataFrame([row], columns=["shard", "dim", "n", "vectors", "ids", "id_ends", "layers"])

    # a task per shard: few bytes are much work here, so they are not to be merged by their size
    return settle(nodes.repartitionById(shards, F.col("shard")).groupBy("shard", "dim").applyInPandas(build, INDEX), "vector-index")


class Shard:
    """A row of the index, read once for all blocks of queries."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], row["dim"])
        self.world = SmallWorld.from_layers(self.vectors, row["layers"])
        self.ids, self.ends = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["id_ends"], "<i8")

    def nearest(self, vec_id: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(score, id) of about the k nearest rows but the query's own, ascending."""
        nodes = self.world.search(query, k + 1)
        scores = np.sqrt(((self.vectors[nodes] - query) ** 2).sum(axis=1))
        found = [(float(s), int(i)) for s, node in zip(scores, nodes, strict=True) for i in self.ids[self.ends[node - 1] if node else 0 : self.ends[node]] if i != vec_id]
        return sorted(found)[:k]


def _nearest_of_group(shards: list[Shard], queries: list[dict], k: int) -> Iterator[tuple[int, int, int, float]]:
    """The nearest of all shards that a task holds, for every query of a block."""
    for q in queries:
        query = np.array(q["embedding"])
        found = {pair for shard in shards for pair in shard.nearest(q["vec_id"], query, k)}
        for s, i in sorted(found)[:k]:
            yield q["vec_id"], q["query_key"], i, s


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest of all shards of its dimension; ties go to the smaller id.

    Queries are dealt to blocks by id and vector, so many queries of one vector are several blocks.  Shards are dealt to groups
    and blocks to slices; a task takes a group and a slice.  Slices are more than one only where shards are too few to keep the
    cores busy, so the index is copied a bounded number of times.
    """
    spark = queries.sparkSession
    rows = settle(usable(queries), "vector-queries")
    blocks = max(1, -(-rows.count() // BLOCK_QUERIES))
    rows = rows.withColumn("query_key", F.xxhash64("embedding")).withColumn("block", F.expr(f"cast(pmod(xxhash64(vec_id, query_key), {blocks}) as int)"))
    packed = rows.groupBy(F.size("embedding").alias("dim"), "block").agg(F.collect_list(F.struct("vec_id", "query_key", "embedding")).alias("queries"))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1  # numbered from 0
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    groups = min(shards, max(-(-shards // SHARDS_TOGETHER), tasks))
    slices = max(1, min(blocks, -(-tasks // groups)))
    held = index.selectExpr(f"explode(transform(sequence(0, {slices - 1}), s -> int(shard % {groups} * {slices} + s))) as part", "0 as kind", "*")
    asked = packed.selectExpr(f"explode(transform(sequence(0, {groups - 1}), g -> int(g * {slices} + block % {slices}))) as part", "1 as kind", "dim", "queries")
    both = held.unionByName(asked, allowMissingColumns=True).repartitionById(groups * slices, F.col("part")).sortWithinPartitions("kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        here: list[Shard] = []
        for batch in batches:
            for k_row in range(batch.num_rows):
                row = {name: batch.column(name)[k_row].as_py() for name in batch.schema.names}
                if row["kind"] == 0:
                    here.append(Shard(row))
                    continue
                found = _nearest_of_group([s for s in here if s.dim == row["dim"]], row["queries"], k)
                columns = list(zip(*found, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "query_key", "vec_id", "score"])

    found = both.mapInArrow(run, "query_id long, query_key long, vec_id long, score double").distinct()
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """The stated queries, rows whose id is divisible by ``every``, against all other rows.

    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without an id, take no part; repeated
    rows count once; a vector meets those of its own dimension only.  Fewer than k candidates are all returned; an empty
    table gives an empty result.
    """
    return search(build_index(embeddings), embeddings.filter(F.col("vec_id") % every == 0))
