"""Exact top-k by inner product: ball trees with branch and bound per shard.

Rows are dealt over shards of bounded size and alike rows: a shard is a part of
the rows nearest to one of some pivots. A task builds a shard's ball tree once;
its queries then stream past. For a node of centre c and radius r no member
scores over <q, c> + |q| r, so nodes are taken in the order of that bound, best
first, and the search ends when the next bound is under the current k-th score;
whole subtrees go at once. The k-th score is shared: a first turn searches each
query's home shard (that of the highest bound), and what it finds is the floor
for all others. A shard's own ball says before anything moves which of the
other queries can find nothing in it."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

LEAF = 256
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x``: floor(256 * x) of every vector without null or
    non-finite components; others take no part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vec_col).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return v.filter(F.col("x").isNotNull() & ~bad).select(
        "vec_id", F.transform("x", lambda e: F.floor(e * 256.0).cast("double")).alias("x"))


class BallTree:
    """Nodes in arrays: range of the ordered rows, centre, radius and children
    (0: a leaf); node 0 is the root."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order, ranges, children = np.arange(len(ids)), [(0, len(ids))], []
        for a, b in ranges:                        # grows while it is read
            if b - a <= LEAF:
                children.append(0)
                continue
            pts = x[order[a:b]]
            far = pts[np.argmax(((pts - pts[0]) ** 2).sum(1))]
            other = pts[np.argmax(((pts - far) ** 2).sum(1))]
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(pts @ (far - other), half)]
            children.append(len(ranges))
            ranges += [(a, a + half), (a + half, b)]
        self.ranges, self.children, self.ids, self.x = ranges, children, ids[order], x[order]
        self.centres = np.array([self.x[a:b].mean(0) for a, b in ranges])
        self.radii = np.array([_radius(self.x[a:b], c) for (a, b), c in zip(ranges, self.centres)])
        self.visited = 0

    def search(self, q: np.ndarray, own: int, k: int, floor: float):
        """The k best (score, vec_id) of the shard that reach ``floor``."""
        length = np.sqrt(q @ q)
        best_s, best_i = np.array([]), np.array([], np.int64)
        todo = [(-_bound(self.centres[0] @ q, length, self.radii[0]), 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < floor:
                break
            self.visited += 1
            child = self.children[node]
            if child:
                for i in (child, child + 1):
                    bound = _bound(self.centres[i] @ q, length, self.radii[i])
                    if bound >= floor:
                        heapq.heappush(todo, (-bound, i))
                continue
            a, b = self.ranges[node]
            rows = slice(a, b) if own is None else np.arange(a, b)[self.ids[a:b] != own]
            s, i = np.concatenate([best_s, self.x[rows] @ q]), np.concatenate([best_i, self.ids[rows]])
            top = np.lexsort((i, -s))[:k]
            best_s, best_i = s[top], i[top]
            if len(top) == k:
                floor = max(floor, best_s[-1])
        keep = best_s >= floor
        return best_s[keep], best_i[keep]


def _radius(x: np.ndarray, centre: np.ndarray) -> float:
    return float(np.sqrt(((x - centre) ** 2).sum(1).max()))


def _bound(inner, length, radius):
    """No member of a ball scores more; the rounding of the bound itself is far
    under one unit of score, and one is added."""
    bound = inner + length * radius
    return bound + 1.0 + 1e-9 * abs(bound)


def _dense(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _by_shard(batches):
    """(shard, kind, batch) of sorted batches (shard, kind, ...), cut where
    either changes."""
    for batch in batches:
        shard, kind = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
        cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(shard)]):
            if b > a:
                yield shard[a], kind[a], batch.slice(a, b - a)


def _dealt(rows: DataFrame, shard_rows: int, pivots: int) -> DataFrame:
    """``rows`` (vec_id, x, dim) with their ``shard``: by the nearest of at most
    ``pivots`` rows of the same number of components, those of lowest hash (a
    choice that only says how well shards keep alike rows together); a cell of
    more than ``shard_rows`` rows is divided by hash."""
    lot = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("x", "vec_id")))
    some = rows.withColumn("_lot", lot).filter(F.col("_lot") <= pivots).select("dim", "x").collect()
    chosen: dict = {}
    for r in some:
        chosen.setdefault(r["dim"], []).append(r["x"])
    shared = rows.sparkSession.sparkContext.broadcast({d: np.array(x) for d, x in chosen.items()})

    def cells(batches):
        for batch in C.slices(batches, 4096):
            dims, out = batch.column(2).to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x, p = _dense(batch.take(pa.array(at)).column(1)), shared.value[int(dim)]
                out[at] = np.argmax(2 * x @ p.T - (p * p).sum(1), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], ["vec_id", "x", "dim", "cell"])

    celled = C.saved(rows.mapInArrow(cells, "vec_id long, x array<double>, dim int, cell long"), "cells")
    parts = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard_rows).alias("parts"))
    # rows of one id are spread as well: the part comes from the vector too
    return C.saved(celled.join(parts, ["dim", "cell"]).select(
        "vec_id", "x", "dim", F.concat_ws("-", "dim", "cell", F.pmod(
            F.xxhash64("vec_id", "x", F.monotonically_increasing_id()), "parts")).alias("shard")), "shards")


def _balls(rows: DataFrame) -> DataFrame:
    """``shard, dim, centre, radius``: the ball around each shard's rows."""
    def run(batches):
        at, parts = None, []

        def ball():
            x = np.concatenate(parts)
            centre = x.mean(0)
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.string()), pa.array([x.shape[1]], pa.int32()),
                 pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([_radius(x, centre)])],
                ["shard", "dim", "centre", "radius"])

        for shard, _, batch in _by_shard(batches):
            if shard != at and parts:
                yield ball()
                parts = []
            at = shard
            parts.append(_dense(batch.column(2)))
        if parts:
            yield ball()

    return rows.select("shard", F.lit(0).alias("kind"), "x").repartition("shard").sortWithinPartitions("shard") \
        .mapInArrow(run, "shard string, dim int, centre array<double>, radius double")


def _searched(rows: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """The k best of each ask (shard, vec_id, x, floor) in its shard. A shard's
    rows come first, so its tree is there when its asks stream past."""
    def run(batches):
        at, parts, tree = None, [], None
        for shard, kind, batch in _by_shard(batches):
            if shard != at:
                at, parts, tree = shard, [], None
            if kind == 0:
                parts.append(batch)
                continue
            if tree is None:
                tree = BallTree(np.concatenate([p.column(2).to_numpy() for p in parts]),
                                np.concatenate([_dense(p.column(3)) for p in parts]))
                parts = []
            asked, ids, scores = [], [], []
            for q, x, floor in zip(batch.column(2).to_pylist(), _dense(batch.column(3)), batch.column(4).to_pylist()):
                s, i = tree.search(x, q, k, floor)
                asked.append(np.full(len(i), q, np.int64))
                ids.append(i)
                scores.append(s.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (asked, ids, scores)],
                                             ["query_id", "vec_id", "score"])

    both = rows.select("shard", F.lit(0).alias("kind"), "vec_id", "x", F.lit(0.0).alias("floor")).unionByName(
        asks.select("shard", F.lit(1).alias("kind"), "vec_id", "x", "floor"))
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, pivots: int = 32,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best other rows.

    Components become floor(256 * x) (exact up to sums of 2^53); ties go to
    the smaller vec_id. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; vectors meet those of
    their own length. Repeated rows are candidates each; a query id that is
    repeated is asked once, with its smallest vector; rows of the query's own
    id are never its candidates. An empty table gives an empty result; other
    columns are ignored."""
    def ready(rows):
        return quantised(rows, id_col, vec_col).filter("vec_id is not null") \
            .withColumn("dim", F.size("x")).filter("dim > 0")

    rows = _dealt(C.saved(ready(vectors), "vectors"), shard_rows, pivots)
    ask = ready(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "x")).alias("m")).select("vec_id", "m.*")
    inner = F.aggregate(F.zip_with("x", "centre", lambda a, b: a * b), F.lit(0.0), lambda a, e: a + e)
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e))
    over = inner + length * F.col("radius")
    met = C.saved(ask.join(_balls(rows), "dim").select(
        "vec_id", "x", "shard", (over + 1.0 + 1e-9 * F.abs(over)).alias("bound")), "met")
    home = met.groupBy("vec_id").agg(F.max(F.struct("bound", "shard")).alias("home")) \
        .select("vec_id", F.col("home.shard").alias("home"))
    met = met.join(home, "vec_id")
    own = C.saved(_searched(rows, met.filter("shard = home").withColumn("floor", F.lit(float("-inf"))), k), "own")

    def placed(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(
            Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)

    kth = placed(own).filter(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    others = met.filter("shard <> home").join(kth, "vec_id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(float("-inf")))).filter("bound >= floor")
    return placed(own.unionByName(_searched(rows, others, k))).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.x, c.x)::BIGINT AS score
      FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
