"""MinHash near-dedup by min-max hashing.

Every hash function (a "permutation") gives two signature values: the smallest
and the largest value over a document's shingles. Both agree between two
documents with probability J, their Jaccard similarity, and for one function
the two are not positively correlated, so half the hash evaluations give an
estimate of no more variance. Signatures are cut into bands of ``rows`` values,
minima of ``rows`` functions in one band and their maxima in another; documents
that agree on a whole band meet in a bucket. With 40 x 8 functions a pair of
J = 0.8 misses all 80 bands with probability (1 - 0.8^8)^80 < 5e-7.

Buckets only say who may be alike. A bucket becomes a star, its part of each
task before anything is shuffled, and the stars' components say which whole
sets have to meet. Equal sets are merged (a group of copies is one node), each
set is sent there once and links are confirmed on full sets by growing trees,
which span all links without a pair list. A component of more shingles than a task should hold is dealt over
blocks: trees in each block, then between the trees' heads, and what is still
apart after that is compared block against block, so no link is lost."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .simhash import components

#: Odd 64-bit numbers of the published MurmurHash3 finaliser (fixed values).
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
SETS = ("doc_id long, key long, a long, b long, n long, bands array<long>")


# ------------------------------------------------------------ sets, bands
def _mixed(h: np.ndarray) -> np.ndarray:
    for m in MIX:
        h = (h ^ (h >> np.uint64(33))) * np.uint64(m)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, shingle: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (ASCII case and
    white space); with fewer words, of the whole sequence; none: empty."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(shingle, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = _mixed(out ^ h[j:len(h) - width + 1 + j])
    return np.unique(out)


class Bands:
    """Band keys of shingle sets: ``2 * groups`` of ``rows`` values each."""

    def __init__(self, groups: int = 40, rows: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.groups, self.rows = groups, rows
        self.factors = rng.integers(0, 1 << 31, groups * rows, np.uint32) * np.uint32(2) + np.uint32(1)
        self.salt = _mixed(np.arange(1, 2 * groups + 1, dtype=np.uint64))

    def signature(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(minima, maxima) of a non-empty set under every function."""
        low, high = s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), 0xFFFFFFFF, np.uint32)
        most = np.zeros(len(self.factors), np.uint32)
        for i in range(0, len(s), 256):       # a piece of the value table fits in a core's cache
            v = low[i:i + 256, None] * self.factors
            v += high[i:i + 256, None]
            np.minimum(least, v.min(axis=0), out=least)
            np.maximum(most, v.max(axis=0), out=most)
        return least, most

    def keys(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.empty(0, np.int64)
        values = np.concatenate(self.signature(s)).reshape(2 * self.groups, self.rows).astype(np.uint64)
        out = self.salt.copy()
        for j in range(self.rows):
            out = _mixed(out ^ values[:, j])
        return out.view(np.int64)


def shingle_sets(docs: DataFrame, shingle: int, bands: Bands, id_col: str, text_col: str) -> DataFrame:
    """Per row: the XXH64 of its text, 128 bits of its set, the set's size and
    its band keys."""
    def run(batches):
        for batch in C.slices(batches):
            a, b, n, keys, ends = [], [], [], [], [0]
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, shingle)
                ab = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                a.append(int(ab[0]))
                b.append(int(ab[1]))
                n.append(len(s))
                keys.append(bands.keys(s))
                ends.append(ends[-1] + len(keys[-1]))
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "key", "a", "b", "n", "bands"])

    return C.id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("key"), "text") \
        .mapInArrow(run, SETS)


# ------------------------------------------------------------ confirmation
class Block:
    """Shingle sets that one task holds, as runs of small integers."""

    def __init__(self, sets: list):
        self.n = np.array([len(s) for s in sets], np.int64)
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat = flat.astype(np.int32).ravel()
        self.start = np.concatenate([[0], np.cumsum(self.n)])
        self.mark = np.zeros(int(self.flat.max()) + 1 if len(self.flat) else 0, bool)

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.start[i]:self.start[i + 1]]

    def near(self, x: int, rows: "Rows", percent: int) -> np.ndarray:
        """Which of ``rows`` have 100 * intersection >= percent * union with x."""
        own = self.of(x)
        self.mark[own] = True
        both = np.add.reduceat(self.mark[rows.flat].astype(np.int64), rows.start)
        self.mark[own] = False
        return 100 * both >= percent * (self.n[x] + rows.n - both)


class Rows:
    """Some sets of a block, one after the other."""

    def __init__(self, block: Block, ids: np.ndarray):
        self.ids, self.n = ids, block.n[ids]
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]])
        self.flat = block.flat[np.repeat(block.start[ids] - self.start, self.n) + np.arange(int(self.n.sum()))]

    def without(self, gone: np.ndarray) -> "Rows":
        out = object.__new__(Rows)
        out.ids, out.n = self.ids[~gone], self.n[~gone]
        out.start = np.concatenate([[0], np.cumsum(out.n)[:-1]])
        out.flat = self.flat[np.repeat(~gone, self.n)]
        return out


def forest(sets: list, percent: int) -> list[tuple[int, int]]:
    """Links (positions) that span every group of linked sets: each set, once
    reached, is compared with the sets not reached yet."""
    if len(sets) < 2:
        return []
    block, out = Block(sets), []
    todo = Rows(block, np.arange(1, len(sets)))
    front = [0]
    while len(todo.ids):
        if not front:
            first = np.zeros(len(todo.ids), bool)
            first[0] = True
            front, todo = [int(todo.ids[0])], todo.without(first)
            continue
        x = front.pop()
        found = block.near(x, todo, percent)
        if found.any():
            new = todo.ids[found].tolist()
            out += [(x, y) for y in new]
            front += new
            todo = todo.without(found)
    return out


def bridges(left: list, right: list, left_label: list, right_label: list, percent: int) -> list:
    """Links (left position, right position) between two lists of sets, as
    many as it takes to join the labels that are linked."""
    root: dict = {}

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    block = Block(left + right)
    rows, out = Rows(block, np.arange(len(left), len(left) + len(right))), []
    for i in range(len(left)):
        for j in np.flatnonzero(block.near(i, rows, percent)).tolist():
            u, v = find(left_label[i]), find(right_label[j])
            if u != v:
                root[u] = v
                out.append((i, j))
    return out


def _grouped(batches, keys: int):
    """Rows of sorted Arrow batches by their first ``keys`` columns; equal rows
    in a row come once."""
    at, held, last = None, [], None
    for batch in C.slices(batches):
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:keys] != at:
                if held:
                    yield at, held
                at, held, last = row[:keys], [], None
            if row[keys:keys + 2] != last:
                last = row[keys:keys + 2]
                held.append(row[keys:])
    if held:
        yield at, held


def _pairs(found) -> pa.RecordBatch:
    u, v = [max(p) for p in found], [min(p) for p in found]
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _trees(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``u, v`` inside each ``(root, block)`` of ``rows`` (root, block, node, text)."""
    def run(batches):
        for _, held in _grouped(batches, 2):
            links = forest([shingle_set(text, shingle) for _, text in held], percent)
            if links:
                yield _pairs([(held[i][0], held[j][0]) for i, j in links])

    return (rows.select("root", "block", "node", "text").repartition("root", "block")
            .sortWithinPartitions("root", "block", "node").mapInArrow(run, "u long, v long"))


def _across(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``u, v`` between the two sides of each ``(root, block, other)``."""
    def run(batches):
        for _, held in _grouped(batches, 3):
            side = [[r for r in held if r[0] == s] for s in (0, 1)]
            if all(side):
                sets = [[shingle_set(r[3], shingle) for r in s] for s in side]
                links = bridges(*sets, *[[r[2] for r in s] for s in side], percent)
                if links:
                    yield _pairs([(side[0][i][1], side[1][j][1]) for i, j in links])

    return (rows.select("root", "block", "other", "side", "node", "label", "text")
            .repartition("root", "block", "other")
            .sortWithinPartitions("root", "block", "other", "side", "node").mapInArrow(run, "u long, v long"))


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``label``: the smallest node that their links reach."""
    if links.isEmpty():
        return nodes.withColumn("label", F.col("node"))
    return nodes.join(components(links).withColumnRenamed("root", "label"), "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))


# -------------------------------------------------------------- candidates
def _runs(band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted bands: which rows begin one, and where each row's begins."""
    first = np.concatenate([[True], band[1:] != band[:-1]]) if len(band) else np.zeros(0, bool)
    return first, np.maximum.accumulate(np.where(first, np.arange(len(band)), 0)) if len(band) else first


def _local_stars(batches, held: int = 1_000_000):
    """Band keys (``band, u``) of rows (row, bands), a band of several rows of
    the task as one, and the links to it (``u, v``): the map side's part of a
    bucket, so that a bucket of very many rows is one row per task."""
    def out(rows, bands):
        u, band = np.concatenate(rows), np.concatenate(bands)
        order = np.lexsort((u, band))
        u, band = u[order], band[order]
        first, begin = _runs(band)
        more = ~first & (u != u[begin])
        pairs = np.unique(np.stack([u[more], u[begin][more]], axis=1).view("i8,i8").ravel())
        n, m = len(pairs), int(first.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([pairs["f0"], band[first]])), pa.array(np.concatenate([pairs["f0"], u[first]])),
             pa.array(np.concatenate([pairs["f1"], np.zeros(m, np.int64)]), mask=np.arange(n + m) >= n)],
            ["band", "u", "v"])

    rows, bands, size = [], [], 0
    for batch in batches:
        if batch.num_rows:
            keys = batch.column(1)
            flat = keys.flatten().to_numpy()
            rows.append(np.repeat(batch.column(0).to_numpy(), np.diff(keys.offsets.to_numpy())))
            bands.append(flat)
            size += len(flat)
        if size >= held:
            yield out(rows, bands)
            rows, bands, size = [], [], 0
    if size:
        yield out(rows, bands)


def _stars(batches):
    """Links of every row of a band to the band's first row; links pass."""
    last, centre = None, 0
    for batch in batches:
        passed = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        band, u = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        pu, pv = u[passed], batch.column(2).drop_null().to_numpy()
        band, u = band[~passed], u[~passed]
        first, begin = _runs(band)
        v = u[begin]
        if len(band) and band[0] == last:             # the band goes on from the batch before
            v[begin == 0] = centre
        if len(band):
            last, centre = band[-1], v[-1]
        more = u != v
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([pu, u[more]])),
                                          pa.array(np.concatenate([pv, v[more]]))], ["u", "v"])


def candidate_groups(sets: DataFrame) -> DataFrame:
    """``row, root``: rows (row, bands) that share a band with others, by the
    components of the bands' stars."""
    keys = sets.select("row", "bands").mapInArrow(_local_stars, "band long, u long, v long")
    stars = C.saved(keys.repartition("band").sortWithinPartitions("band", "u")
                    .mapInArrow(_stars, "u long, v long").distinct(), "stars")
    found = components(stars).select(F.col("node").alias("row"), "root")       # without the roots themselves
    return C.saved(found.unionByName(found.select(F.col("root").alias("row"), "root").distinct()), "candidates")


# ------------------------------------------------------------ the operator
def near_links(sets: DataFrame, distinct: DataFrame, docs: DataFrame, shingle: int, percent: int,
               block_shingles: int, id_col: str, text_col: str) -> DataFrame:
    """``u, v``: confirmed links that span every group of linked nodes.
    ``sets``: row, doc_id, key, n, bands; ``distinct``: node, the row that
    stands for rows of one set."""
    groups = distinct.select(F.col("node").alias("row")).join(candidate_groups(sets), "row")
    member = C.saved(sets.select("row", "doc_id", "key", "n").join(groups, "row")
                     .withColumnRenamed("row", "node"), "members")
    size = member.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"),
                                      F.count("*").alias("nodes")).filter("nodes > 1").drop("nodes")
    place = C.saved(member.join(size, "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "places")
    texts = C.id_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(C.NO_ID)).alias("_id"), F.xxhash64("text").alias("_key"), "text")
    texts = C.likely(texts, "_key", place.select("key"))

    def with_text(some: DataFrame) -> DataFrame:
        some = some.withColumn("doc_id", F.coalesce("doc_id", F.lit(C.NO_ID)))
        return texts.join(some, (F.col("_id") == some["doc_id"]) & (F.col("_key") == some["key"])) \
            .drop("_id", "_key")

    links = C.saved(_trees(with_text(place), shingle, percent), "trees")
    split = place.filter("blocks > 1")
    if split.isEmpty():
        return links
    # groups of several blocks: heads of the blocks' trees meet
    split = C.saved(_labelled(split, links), "split")
    heads = split.groupBy("root", "block", "label").agg(F.min("node").alias("node")).select("node")
    heads = split.join(heads, "node", "left_semi")
    parts = heads.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"))
    heads = heads.drop("blocks", "block").join(parts, "root").withColumn(
        "block", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")))
    links = C.saved(links.unionByName(_trees(with_text(heads), shingle, percent)), "trees")
    # what is apart from a group's largest label now meets all of the group
    split = C.saved(_labelled(split.drop("label"), links), "split")
    counts = split.groupBy("root", "label").agg(F.count("*").alias("m"))
    main = counts.groupBy("root").agg(F.max(F.struct("m", "label")).alias("main"), F.count("*").alias("labels")) \
        .filter("labels > 1").select("root", F.col("main.label").alias("main"))
    apart = C.saved(split.join(main, "root"), "apart")
    if apart.isEmpty():
        return links
    rest = apart.filter("label <> main")
    parts = rest.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).alias("others"))
    rest = rest.join(parts, "root").select(
        "root", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("others")).alias("other"), F.lit(0).alias("side"),
        "node", "label", "doc_id", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    every = apart.join(parts, "root").select(
        "root", "block", F.lit(1).alias("side"), "node", "label", "doc_id", "key",
        F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
    return links.unionByName(C.saved(_across(with_text(rest.unionByName(every)), shingle, percent), "across"))


def minhash_components(docs: DataFrame, shingle: int = 2, percent: int = 80, groups: int = 40, rows: int = 8,
                       block_shingles: int = 1_000_000, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Rows link if 100 * intersection >= percent * union of their sets of word
    shingles (64-bit hashes). Null, empty and blank texts have an empty set and
    are linked with nothing; a text of fewer words than a shingle has one
    element. ``component_id`` is the smallest doc_id reachable. Rows without an
    id take part, never give a component its id (null if it has no other), and
    are kept only then. Repeated rows and copies share a component; of rows with
    one id and one component each is kept. An empty table gives an empty
    result; texts of any length are read whole; other columns are ignored."""
    sets = C.saved(shingle_sets(docs, shingle, Bands(groups, rows), id_col, text_col)
                   .withColumn("row", F.monotonically_increasing_id()), "sets")
    distinct = C.saved(sets.filter("n > 0").groupBy("a", "b").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least")), "distinct")
    links = near_links(sets.filter("n > 0"), distinct, docs, shingle, percent, block_shingles, id_col, text_col)
    named = _labelled(distinct, C.saved(links, "links"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = C.saved(named.join(least, "label").select("a", "b", "component_id"), "named")
    found = sets.select("doc_id", "n", "a", "b").join(named, ["a", "b"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                       F.col("component_id").isNull()))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle
      FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS k
      FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
      WHERE 100 * k >= 80 * (a.n + b.n - k)),
r AS (SELECT doc_id AS u, doc_id AS v FROM n UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v),
c AS (SELECT u AS doc_id, min(v) AS component_id FROM r GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
