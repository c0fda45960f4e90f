"""Nearest vectors by Euclidean distance, with a vantage-point tree per shard.

Vectors are dealt to shards of bounded size; the queries go to every shard as a
stream behind its vectors. A task builds the tree of a shard when the first
query arrives, answers the queries in batches, and the best of all shards are
merged in Spark. Nothing but one shard and one batch is in memory.

A tree node holds a vantage point and the median distance ``mu`` of its points to
it; the nearer half of the points is one side, whatever ties there are, so that the depth
is the logarithm of the number of points. By the triangle inequality a query at distance ``d`` from the vantage point
finds nothing closer than ``|d - mu|`` on the other side, so that side is left out
if ``factor * |d - mu|`` is more than the distance of the k-th best so far. With
``factor`` 1 the search is exact, larger factors leave out more.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows without an id. Vectors are compared with those of the same
dimension. Rows with the query's id are its own and no candidates; a query
id that is repeated is searched once, with its smallest vector. Repeated candidates
each have a rank. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
FACTOR = 1.0
SHARD_ROWS = 100_000
LEAST_SHARD_ROWS = 2_000
LEAF = 128
BATCH = 256
_CELLS = 1 << 21  # differences held at once
_EPS = float(np.finfo(np.float64).eps)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two sets of vectors, in double precision, from the differences themselves."""
    out = np.empty((len(a), len(b)))
    step = max(1, _CELLS // max(1, len(b) * a.shape[1]))
    for k in range(0, len(a), step):
        gap = a[k : k + step, None, :] - b[None, :, :]
        out[k : k + step] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


@dataclass
class Node:
    """Points of a leaf, or a vantage point with the two sides of its median distance."""

    points: np.ndarray | None = None
    vantage: np.ndarray | None = None
    mu: float = 0.0
    inside: Node | None = None
    outside: Node | None = None


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.leaf = ids[order], vectors[order], leaf
        self.squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.root = self._build(np.arange(len(ids)))

    def _build(self, points: np.ndarray) -> Node:
        if len(points) <= self.leaf:
            return Node(points)
        # The point farthest from an arbitrary one lies at the rim, where distances spread most.
        start = _distances(self.vectors[points[:1]], self.vectors[points])[0]
        vantage = self.vectors[points[int(start.argmax())]]
        d = _distances(vantage[None], self.vectors[points])[0]
        half = len(points) // 2
        order = np.argpartition(d, half)
        # Points at distance mu may be on both sides: inside none is farther, outside none is nearer.
        return Node(None, vantage, float(d[order[half]]), self._build(points[order[:half]]), self._build(points[order[half:]]))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distance, place in ``ids``) of the k best per query, nearest first; place -1: none."""
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), len(self.ids))
        self._visit(self.root, np.arange(len(queries)), query_ids, queries, best, found, factor)
        return best, np.where(np.isinf(best), -1, found)

    def _visit(self, node: Node, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: np.ndarray, found: np.ndarray, factor: float) -> None:
        if not len(rows):
            return
        if node.points is not None:
            self._leaf(node.points, rows, query_ids, queries, best, found)
            return
        d = _distances(queries[rows], node.vantage[None])[:, 0]
        near = d <= node.mu
        for first, other, mine in ((node.inside, node.outside, near), (node.outside, node.inside, ~near)):
            own = rows[mine]
            self._visit(first, own, query_ids, queries, best, found, factor)
            bound = factor * np.abs(d[mine] - node.mu)
            # Rounding must not cut off a tie.
            open_ = bound <= best[own, -1] * (1 + 1e-12) + 1e-12
            self._visit(other, own[open_], query_ids, queries, best, found, factor)

    def _leaf(self, points: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        k, vectors = best.shape[1], self.vectors[points]
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            own = queries[part]
            scale = np.einsum("ij,ij->i", own, own)[:, None] + self.squares[None, points]
            # A matrix product tells, but for rounding, which points may be among the best; their distances come from the differences.
            rounding = 8 * (own.shape[1] + 4) * _EPS * scale
            far = scale - 2 * (own @ vectors.T) - rounding > best[part, -1:] ** 2 * (1 + 1e-12)
            far |= query_ids[part, None] == self.ids[None, points]
            some = ~far.all(1)
            part = part[some]
            if not len(part):
                continue
            d = np.full((len(part), len(points)), np.inf)
            i, j = np.nonzero(~far[some])
            step = max(1, _CELLS // own.shape[1])
            for low in range(0, len(i), step):
                a, b = i[low : low + step], j[low : low + step]
                gap = queries[part[a]] - vectors[b]
                d[a, b] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            every = np.concatenate([best[part], d], axis=1)
            place = np.concatenate([found[part], np.broadcast_to(points, d.shape)], axis=1)
            # Places are in the order of ids, so equal distances go to the smaller id.
            order = np.lexsort((place, every), axis=1)[:, :k]
            best[part] = np.take_along_axis(every, order, 1)
            found[part] = np.take_along_axis(place, order, 1)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


FOUND = "query_id long, vec_id long, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _search_shards(rows: DataFrame, k: int, factor: float, leaf: int) -> DataFrame:
    """Rows (shard, dim, is_query, vec_id, vector) come with each shard's vectors before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, tree = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "shard", "is_query")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                part, (dim, shard, is_query) = batch.slice(low, high - low), keys[low].tolist()
                if current != (dim, shard):
                    current, ids, vectors, tree = (dim, shard), [], [], None
                own = part.column("vec_id").to_numpy()
                if not is_query:
                    ids.append(own)
                    vectors.append(_matrix(part.column("vector")))
                    continue
                if not ids:
                    continue  # a shard without vectors
                tree = tree or Tree(np.concatenate(ids), np.concatenate(vectors), leaf)
                best, place = tree.search(own, _matrix(part.column("vector")), k, factor)
                hit = place >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, k)[hit.ravel()]), pa.array(tree.ids[place[hit]]), pa.array(best[hit])], ["query_id", "vec_id", "score"]
                )

    return rows.mapInArrow(run, FOUND)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    leaf: int = LEAF,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors of each query, nearest first."""
    if factor < 1:
        raise ValueError("a factor below 1 only costs time")
    shape = [F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")]
    prepare = lambda df: df.select(*shape).where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    index, asked = prepare(vectors), prepare(queries)
    spark, n = vectors.sparkSession, index.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // shard_rows), min(partitions, -(-n // LEAST_SHARD_ROWS)))
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    columns = ["dim", "shard", "is_query", "vec_id", "vector"]
    dealt = index.withColumns({"shard": F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"), "is_query": F.lit(0)}).select(*columns)
    sent = asked.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "is_query": F.lit(1)}).select(*columns)
    rows = dealt.unionByName(sent).repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "is_query", "vec_id")
    found = _search_shards(rows, k, factor, leaf)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
