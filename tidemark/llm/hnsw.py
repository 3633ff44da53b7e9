"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Rows are dealt to shards of bounded size by a hash of their id. In a shard, equal vectors are one node that carries
all its ids. Nodes are inserted in a fixed order: each is linked with a spread-out choice of its nearest
predecessors, links are returned, and full lists are thinned by the same choice. Every layer is stored as one flat
array of neighbours. Queries go to all shards in blocks, descend the layers together and search the lowest one with
a beam; the shards' results are merged by exact distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import mixed
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import stored

shipped(__name__)

SHARD = 2048  # rows of a shard, about
LINKS = 12  # links of a node in the upper layers, twice as many in the lowest
CHOICE = 64  # nearest predecessors that links are chosen from
BEAM = 64  # nodes kept while searching
BLOCK = 256  # queries that walk together
QUERIES = 16_384  # queries that go to a shard in one task


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0)


def spread(vectors: np.ndarray, nodes: np.ndarray, choices: np.ndarray, distances: np.ndarray, links: int) -> np.ndarray:
    """Of each node's choices (ascending by distance, -1: none), those nearer to it than to any chosen one; the rest
    is filled up with the nearest that are left."""
    out = np.full((len(nodes), links), -1, np.int32)
    for at in range(0, len(nodes), 256):
        own, far = choices[at : at + 256], distances[at : at + 256]
        points = vectors[np.maximum(own, 0)]
        norms = (points * points).sum(2)
        between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        taken = np.zeros(own.shape, bool)
        for r in range(own.shape[1]):
            blocked = (taken & (between[:, r, :] < far[:, r : r + 1])).any(1)
            taken[:, r] = (own[:, r] >= 0) & ~blocked & (taken.sum(1) < links)
        # Taken ones first, then the others, each in the order of their distance.
        order = np.argsort(np.where(own < 0, 2, np.where(taken, 0, 1)), axis=1, kind="stable")[:, :links]
        best = np.take_along_axis(own, order, 1)
        out[at : at + len(own), : best.shape[1]] = best
    return out


def layer(vectors: np.ndarray, links: int) -> np.ndarray:
    """Flat neighbour array of one layer; rows in the order of insertion."""
    n = len(vectors)
    width = min(CHOICE, max(n - 1, 1))
    choices, distances = np.full((n, width), -1, np.int64), np.full((n, width), np.inf)
    for at in range(0, n, 512):
        rows = np.arange(at, min(at + 512, n))
        far = squares(vectors[rows], vectors[: rows[-1] + 1])
        far[np.arange(far.shape[1])[None, :] >= rows[:, None]] = np.inf
        if far.shape[1] > width:
            near = np.argpartition(far, width - 1, axis=1)[:, :width]
        else:
            near = np.broadcast_to(np.arange(far.shape[1]), far.shape)
        own = np.take_along_axis(far, near, 1)
        order = np.argsort(own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        choices[rows, : near.shape[1]] = np.where(np.isfinite(own), near, -1)
        distances[rows, : near.shape[1]] = own
    forward = spread(vectors, np.arange(n), choices, distances, links)
    source = np.repeat(np.arange(n), links)[forward.ravel() >= 0]
    target = forward.ravel()[forward.ravel() >= 0].astype(np.int64)
    both = np.unique(np.concatenate([source * n + target, target * n + source]))
    source, target = both // n, both % n
    gap = vectors[source] - vectors[target]
    far = (gap * gap).sum(1)
    order = np.lexsort((far, source))
    source, target, far = source[order], target[order], far[order]
    sizes = np.bincount(source, minlength=n)
    starts = np.cumsum(sizes) - sizes
    out = np.full((n, links), -1, np.int32)
    place = np.arange(len(source)) - starts[source]
    few = sizes[source] <= links
    out[source[few], place[few]] = target[few]
    full = np.flatnonzero(sizes > links)
    if len(full):
        width = int(sizes[full].max())
        rank = np.full(n, -1)
        rank[full] = np.arange(len(full))
        wide = np.full((len(full), width), -1, np.int64)
        distances = np.full((len(full), width), np.inf)
        own = ~few
        wide[rank[source[own]], place[own]] = target[own]
        distances[rank[source[own]], place[own]] = far[own]
        width = min(width, 4 * CHOICE)
        out[full] = spread(vectors, full, wide[:, :width], distances[:, :width], links)
    return out


class Graph:
    """Layers of one shard: nodes of each layer (a prefix of the insertion order) and their flat neighbours."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def build(vectors: np.ndarray) -> Graph:
        """vectors: distinct, in an order that is random with respect to their places."""
        layers, n, links = [], len(vectors), 2 * LINKS
        while True:
            layers.append(layer(vectors[:n], links))
            if n <= LINKS:
                break
            n, links = max(1, n // LINKS), LINKS  # as many nodes reach the next layer as a geometric draw gives
        return Graph(vectors, layers)

    def search(self, queries: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances) of up to k near nodes for each query; -1 and infinity where there are fewer."""
        n = len(queries)
        best = np.zeros((n, 1), np.int64)
        far = ((queries - self.vectors[0]) ** 2).sum(1)[:, None]
        for depth in range(len(self.layers) - 1, -1, -1):
            width = max(beam, k) if depth == 0 else max(4, LINKS // 2)
            best, far = self.walk(queries, best, far, self.layers[depth], width)
        return best[:, :k], far[:, :k]

    def walk(self, queries: np.ndarray, best: np.ndarray, far: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(queries)
        seen = np.zeros((n, len(links) + 1), bool)
        np.put_along_axis(seen, np.where(best < 0, len(links), best), True, 1)
        nodes, costs = np.full((n, width), -1, np.int64), np.full((n, width), np.inf)
        size = min(width, best.shape[1])
        nodes[:, :size], costs[:, :size] = best[:, :size], far[:, :size]
        done = nodes < 0
        active = np.arange(n)
        while len(active):
            open_cost = np.where(done[active], np.inf, costs[active])
            pick = np.argmin(open_cost, axis=1)
            going = np.isfinite(open_cost[np.arange(len(active)), pick])
            active, pick = active[going], pick[going]
            if not len(active):
                break
            done[active, pick] = True
            near = links[nodes[active, pick]].astype(np.int64)
            near = np.where(near < 0, len(links), near)
            fresh = ~seen[active[:, None], near]
            fresh[near == len(links)] = False
            seen[active[:, None], near] = True
            gap = self.vectors[np.minimum(near, len(links) - 1)] - queries[active][:, None, :]
            cost = np.where(fresh, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
            all_nodes = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)
            all_costs = np.concatenate([costs[active], cost], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            order = np.argsort(all_costs, axis=1, kind="stable")[:, :width]
            nodes[active] = np.take_along_axis(all_nodes, order, 1)
            costs[active] = np.take_along_axis(all_costs, order, 1)
            done[active] = np.take_along_axis(all_done, order, 1)
        return nodes, costs


def built(key: tuple, table: pa.Table) -> pa.Table:
    """One row for a shard: its graph and the ids of its nodes as flat arrays."""
    ids = table.column("id").to_numpy()
    width = key[1].as_py()
    vectors = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, width)
    order = np.argsort(mixed(ids.astype(np.uint64)) ^ np.uint64(0x5DEECE66D), kind="stable")
    ids, vectors = ids[order], vectors[order] + 0.0  # minus zero is zero
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, 8 * width))).ravel()
    _, first, node = np.unique(rows, return_index=True, return_inverse=True)
    place = np.argsort(np.argsort(first, kind="stable"), kind="stable")  # nodes keep the order of their first id
    node, first = place[node], np.sort(first)
    graph = Graph.build(vectors[first])
    order = np.lexsort((ids, node))
    starts = np.searchsorted(node[order], np.arange(len(first) + 1))
    arrays = {
        "vectors": graph.vectors, "ids": ids[order], "starts": starts,
        "links": np.concatenate([x.ravel() for x in graph.layers]), "sizes": np.array([x.shape for x in graph.layers]).ravel(),
    }
    columns = [pa.array([x.astype("<i4" if k == "links" else "<f8" if k == "vectors" else "<i8").tobytes()], pa.binary()) for k, x in arrays.items()]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([width], pa.int32()), *columns], ["shard", "width", *arrays])


SHARD_SQL = "shard int, width int, vectors binary, ids binary, starts binary, links binary, sizes binary"


def found(k: int, beam: int):
    """Searches one shard for a block of queries: (query, id, score) of the k nearest others."""

    def run(key: tuple, shard: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if shard.num_rows and queries.num_rows:
            row = shard.to_pylist()[0]
            width = row["width"]
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, width)
            ids, starts, links = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["links"], "<i4")
            layers, at = [], 0
            for n, m in np.frombuffer(row["sizes"], "<i8").reshape(-1, 2):
                layers.append(links[at : at + n * m].reshape(n, m))
                at += n * m
            graph = Graph(vectors, layers)
            names = queries.column("id").to_numpy()
            points = queries.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, width)
            for first in range(0, len(names), BLOCK):
                own = points[first : first + BLOCK]
                nodes, _ = graph.search(own, k + 1, beam)
                for name, point, line in zip(names[first : first + BLOCK], own, nodes):
                    line = line[line >= 0]
                    gap = vectors[line] - point
                    scores = np.sqrt((gap * gap).sum(1))
                    # Of a node's ids, only the k + 1 smallest can be among the k nearest others.
                    lists = [ids[starts[x] : starts[x + 1]][: k + 1] for x in line]
                    every = np.concatenate(lists)
                    score = np.repeat(scores, [len(x) for x in lists])
                    score, every = score[every != name], every[every != name]
                    best = np.lexsort((every, score))[:k]
                    out[0].append(np.full(len(best), name))
                    out[1].append(every[best])
                    out[2].append(score[best])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
        return pa.table([join(out[0], pa.int64()), join(out[1], pa.int64()), join(out[2], pa.float64())], ["query_id", "id", "score"])

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, width) of rows with an id and a vector without nulls, NaN or infinities that is not all zero."""
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = given.where(F.col("id").isNotNull() & whole & F.exists("vector", lambda x: x != 0))
    return given.withColumn("width", F.size("vector"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD, beam: int = BEAM,
) -> DataFrame:
    """(query_id, rank, id, score): for each query the k nearest rows found, its own id left out, nearest first.

    score: Euclidean distance in double precision between the given vectors; ties go to the smaller id; fewer than k
    rows where fewer others were found. Vectors that are null, empty, zero, or hold null, NaN or infinity take no
    part, neither do null ids; vectors of different widths are not compared. Rows that share an id are each a
    candidate, and a query that comes twice counts once. Every row is indexed. Other columns are not returned.
    """
    points = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"])
    count = points.count()
    shards = max(1, -(-count // shard))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    index = stored(dealt.groupBy("shard", "width").applyInArrow(built, SHARD_SQL), "graphs")
    slices = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    keys = ["shard", "width", "slice"]
    hits = copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(found(k, beam), "query_id long, id long, score double")
    # k rows from each shard for a query: pre-sorted lists are merged, k are kept.
    merged = hits.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "id"))), 1, k).alias("best"))
    ranked = merged.select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score"))
