"""Hard-negative mining with LEMP-style coordinate pruning.

Rows are dealt over buckets of similar length (norm) and bounded size. A task
builds a bucket's index once: the unit vectors' coordinates, each coordinate a
sorted list. An anchor q that needs scores of at least t needs, in a bucket of
longest length l, a cosine of at least c = t / (|q| l). A unit vector p that
qualifies is within the angle a = acos(c) of q, whose angle to the axis of
coordinate f is b = acos(q_f / |q|), so

    cos(min(pi, b + a)) <= p_f <= cos(max(0, b - a)).

The ranges of the anchor's focus coordinates (its largest) are cut out of the
sorted lists and intersected; what is left is scored exactly. Buckets whose
length cannot reach t are not visited at all.

Three turns share what they find: an anchor's positives in its own bucket give
the floor for the other buckets, and the lowest positive score gives the floor
for the negatives. Anchors stream through a bucket, so a task holds one index
and one batch of anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

FOUND = "anchor_id long, place int, other_id long, score long"


class CoordinateIndex:
    """One length bucket: exact vectors, unit vectors and, per coordinate, the
    rows in the order of its values."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        norms = np.sqrt((x * x).sum(axis=1))
        self.longest = float(norms.max())
        self.unit = x / np.where(norms > 0, norms, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(self.unit.T, self.order.astype(np.int64), axis=1)

    def feasible(self, q: np.ndarray, floor: float, focus: int) -> np.ndarray:
        """Rows that may reach ``floor``: all that do are among them. Rounding
        is far under the slack of 1e-9 that is given to every bound."""
        length = float(np.sqrt(q @ q))
        if floor <= 0 or length == 0 or self.longest == 0:
            return np.arange(len(self.ids)) if floor <= 0 else np.empty(0, np.int64)
        cosine = floor / (length * self.longest) - 1e-9
        if cosine > 1:
            return np.empty(0, np.int64)
        u = q / length
        of = np.argsort(-np.abs(u), kind="stable")[:focus]
        a, b = np.arccos(max(-1.0, cosine)), np.arccos(np.clip(u[of], -1, 1))
        low, high = np.cos(np.minimum(np.pi, b + a)) - 1e-9, np.cos(np.maximum(0, b - a)) + 1e-9
        ranges = [(int(np.searchsorted(self.sorted[f], a, "left")), int(np.searchsorted(self.sorted[f], b, "right")))
                  for f, a, b in zip(of, low, high)]
        best = min(range(len(of)), key=lambda i: ranges[i][1] - ranges[i][0])
        rows = self.order[of[best]][slice(*ranges[best])]
        for i, f in enumerate(of):
            if i != best:
                value = self.unit[rows, f]
                rows = rows[(value >= low[i]) & (value <= high[i])]
        return rows


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _positives(index: CoordinateIndex, q, k: int, focus: int) -> list:
    rows = index.feasible(q["x"], q["floor"], focus)
    rows = rows[(index.labels[rows] == q["label"]) & (index.ids[rows] != q["id"])]
    s = index.x[rows] @ q["x"]
    top = _best(index.ids[rows], s, k)
    return [(q["id"], 0, int(index.ids[rows[i]]), int(s[i])) for i in top if s[i] >= q["floor"]]


def _negatives(index: CoordinateIndex, q, k: int, focus: int, low: int, high: int) -> list:
    rows = index.feasible(q["x"], q["floor"], focus)
    rows = rows[(index.labels[rows] != q["label"]) & (index.ids[rows] != q["id"])]
    s, out = index.x[rows] @ q["x"], []
    for place, score in enumerate(q["scores"], 1):
        fits = np.flatnonzero((100 * s >= low * score) & (100 * s <= high * score))
        top = fits[_best(index.ids[rows[fits]], s[fits], k)]
        out += [(q["id"], place, int(index.ids[rows[i]]), int(s[i])) for i in top]
    return out


def _turn(rows: DataFrame, asks: DataFrame, search) -> DataFrame:
    """``search(index, ask)`` for every ask (bucket, id, label, x, floor,
    scores) in its bucket. A bucket's rows come first, so its index is there
    when its asks stream past."""
    def run(batches):
        at, parts, index, found = None, [], None, []
        for batch in batches:
            bucket = batch.column(0).to_numpy(zero_copy_only=False)
            kind = batch.column(1).to_numpy()
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(bucket)]):
                if bucket[a] != at:
                    at, parts, index = bucket[a], [], None
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    parts.append(part)
                    continue
                if index is None and parts:
                    ids, labels, x = (np.concatenate([f(p) for p in parts]) for f in (
                        lambda p: p.column(2).to_numpy(), lambda p: np.array(p.column(3).to_pylist()),
                        lambda p: p.column(4).flatten().to_numpy().reshape(p.num_rows, -1)))
                    index, parts = CoordinateIndex(ids, labels, x), []
                if index is not None:
                    for i, label, x, floor, scores in zip(*[part.column(k).to_pylist() for k in range(2, 7)]):
                        found += search(index, {"id": i, "label": label, "x": np.array(x), "floor": floor,
                                                "scores": scores})
            if found:
                yield _found(found)
                found = []

    blank = [F.lit(0.0).alias("floor"), F.array().cast("array<long>").alias("scores")]
    both = rows.select("bucket", F.lit(0).alias("kind"), "id", "label", "x", *blank).unionByName(
        asks.select("bucket", F.lit(1).alias("kind"), "id", "label", "x", "floor", "scores"))
    return both.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, FOUND)


def _found(rows: list) -> pa.RecordBatch:
    kinds = [("anchor_id", pa.int64()), ("place", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)],
                                      [n for n, _ in kinds])


def _quantised(vectors: DataFrame, is_anchor: Column, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """``id, label, anchor, x, dim, norm2`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    rows = rows.filter("id is not null and label is not null and size(v) > 0").filter(~bad)
    return rows.select("id", "label", "anchor", F.transform("v", lambda e: F.floor(e * 256.0).cast("double"))
                       .alias("x"), F.size("v").alias("dim")) \
        .withColumn("norm2", F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, bucket_rows: int = 8192, focus: int = 4,
                   id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: per anchor its ``positives`` best other rows of the same
    label, and for each the best ``negatives`` rows of another label whose score
    is between ``low`` and ``high`` per cent of the positive's.

    ``is_anchor`` is a condition on the rows' own columns. Components become
    floor(256 * x) (exact up to sums of 2^53); ties go to the smaller id. Rows
    without id, label or vector, with an empty vector, or with null or
    non-finite components take no part; vectors meet those of their own number
    of components. Repeated rows are candidates each (a repeated positive has a
    list of its own); an anchor's id that is repeated is asked once, with the
    smallest label and vector; rows of the anchor's id are never its
    candidates. Positives of a negative score have no feasible negatives. An
    empty table gives an empty result; other columns are ignored."""
    rows = C.saved(_quantised(vectors, is_anchor, id_col, label_col, vec_col), "rows")
    buckets = max(1, -(-rows.count() // bucket_rows))
    # a bucket holds one number of components; the last column parts rows that are alike
    rows = C.saved(rows.repartitionByRange(buckets, "dim", "norm2", "id", F.monotonically_increasing_id())
                   .withColumn("range", F.spark_partition_id())
                   .withColumn("bucket", F.concat_ws("-", "range", "dim")), "buckets")
    reach = rows.groupBy("bucket", "dim").agg(F.sqrt(F.max("norm2")).alias("longest"))
    anchors = C.saved(rows.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "x", "dim", "bucket", "norm2"))
                                                             .alias("a")).select("id", "a.*"), "anchors")
    no_scores = F.array().cast("array<long>").alias("scores")

    def positive(index, q):
        return _positives(index, q, positives, focus)

    def negative(index, q):
        return _negatives(index, q, negatives, focus, low, high)

    def placed(found: DataFrame, *by: str) -> DataFrame:
        return found.withColumn("r", F.row_number().over(
            Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")))

    def visits(asks: DataFrame) -> DataFrame:
        """The buckets of the anchor's number of components that are long
        enough for its floor."""
        return asks.drop("bucket").join(reach, "dim").filter(
            (F.col("floor") <= 0) | (F.sqrt("norm2") * F.col("longest") * (1 + 1e-9) >= F.col("floor")))

    home = anchors.select("bucket", "id", "label", "x", F.lit(float("-inf")).alias("floor"), no_scores)
    own = C.saved(_turn(rows, home, positive), "own")
    kth = placed(own, "anchor_id").filter(F.col("r") == positives).select(
        F.col("anchor_id").alias("id"), F.col("score").cast("double").alias("floor"))
    floors = anchors.join(kth, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))) \
        .withColumn("home", F.col("bucket"))
    others = visits(floors).filter("bucket <> home").select("bucket", "id", "label", "x", "floor", no_scores)
    best = C.saved(placed(own.unionByName(_turn(rows, others, positive)), "anchor_id")
                   .filter(F.col("r") <= positives).select(
                       "anchor_id", F.col("r").alias("place"), F.col("other_id").alias("positive_id"),
                       F.col("score").alias("positive_score")), "positives")
    scores = best.groupBy("anchor_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
        .alias("scores"))          # at most ``positives`` of them
    asks = anchors.join(scores, F.col("id") == F.col("anchor_id")).withColumn(
        "least", F.array_min(F.filter("scores", lambda s: s >= 0))).filter("least is not null") \
        .withColumn("floor", F.col("least") * float(low) / 100 - 1e-6)
    found = placed(_turn(rows, visits(asks).select("bucket", "id", "label", "x", "floor", "scores"), negative),
                   "anchor_id", "place").filter(F.col("r") <= negatives)
    return found.join(best, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("r").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_inner_product(a.x, c.x)::BIGINT AS score
      FROM e a JOIN e c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.r ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      WHERE p.r <= 5 AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
