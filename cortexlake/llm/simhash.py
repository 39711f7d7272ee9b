"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints are 64-bit SimHashes of word shingles. A covering family of
2**(r+1) - 1 bit masks guarantees that any two fingerprints at most r bits
apart agree on all bits of some mask: bit i gets a non-zero vector phi(i) over
GF(2) of r+1 digits, mask v keeps the bits with <v, phi(i)> = 1, and for any r
bits some v != 0 is orthogonal to all their vectors. So every linked pair
meets in a bucket; there is no probability of a miss.

Equal fingerprints are merged before (a group of copies is one row), buckets
are searched by growing trees, which give a spanning forest of the links
instead of all pairs, and buckets over ``bucket_limit`` are divided by further
covering families, until the bits left free bound their size. The links'
components come from alternating star contraction."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SEED = 42
#: Dealings of the vectors (``step`` of covering_masks), one after the other
#: where buckets are too full.
FAMILIES = (1, 14, 21, 27, 18, 2)
#: Rows of the masks' tables that a task makes and counts, about.
TABLE_ROWS = 1 << 18


# ------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a whole text: a bit is 1 if set in over half the
    XXH64 values of the shingles, repeats included. No word: zero."""
    words = (text or "").encode().lower().split()     # bytes: ASCII case, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, k, 65536):
        part = [digest(joined[a:b], SEED) for a, b in
                zip(starts[i:min(k, i + 65536)].tolist(), last[i:i + 65536].tolist())]
        h = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > k, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, key, print``: the XXH64 of the text, which tells rows alike
    apart from others, and the fingerprint as a signed long."""
    def run(batches):
        for b in C.slices(batches):
            prints = [fingerprint(x, shingle) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(prints, np.uint64).view(np.int64))],
                ["doc_id", "key", "print"])

    return C.id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("key"), "text") \
        .mapInArrow(run, "doc_id long, key long, print long")


# ---------------------------------------------------------- covering masks
def covering_masks(radius: int, step: int = 1) -> list[int]:
    """Masks of 64 bits such that any ``radius`` bits are left out by one.
    ``step`` (coprime to their number) deals the vectors differently."""
    n = (1 << (radius + 1)) - 1
    phi = [(i * step) % n + 1 for i in range(64)]
    return [sum(1 << i for i in range(64) if (v & phi[i]).bit_count() & 1)
            for v in range(1, n + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(rows: DataFrame, masks: int) -> DataFrame:
    """``rows`` over so many tasks that each makes about ``TABLE_ROWS`` rows of
    the tables, whatever their number: by bytes a few tasks would get them all,
    and each row becomes one per mask only there."""
    parts = max(1, math.ceil(rows.count() * masks / TABLE_ROWS))
    return rows.repartition(parts, "print", "bits")


def _tables(rows: DataFrame, masks: list[int]) -> DataFrame:
    """``bits, key, print``: a row for every set of kept bits that a mask adds
    to the row's own ``bits``."""
    more = F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("_mask")
    return rows.select("print", "bits", more).select(
        "print", F.col("bits").bitwiseOR(F.col("_mask")).alias("bits")).select(
        "bits", F.col("print").bitwiseAND(F.col("bits")).alias("key"), "print")


def bucket_forest(prints: np.ndarray, radius: int) -> tuple[list, list]:
    """Links of a spanning forest of the fingerprints at most ``radius`` apart:
    every fingerprint is compared once with those not reached yet."""
    a, b, todo = [], [], prints
    while len(todo):
        front, todo = [todo[0]], todo[1:]
        while front and len(todo):
            x = front.pop()
            near = np.bitwise_count(todo ^ x) <= radius
            if near.any():
                found = todo[near]
                todo = todo[~near]
                a.extend([x] * len(found))
                b.extend(found)
                front.extend(found)
    return a, b


def _links(radius: int, keys: list[str]):
    """Over rows sorted by bucket: the forest links of every bucket. Only the
    bucket at hand is held; its size is bounded before."""
    def run(frames):
        held = None
        for pdf in frames:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            k = pdf[keys].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            done = cuts[-1] if len(cuts) else 0
            held = pdf.iloc[done:]
            yield from emit(pdf["print"].to_numpy()[:done], cuts[:-1])
        if held is not None:
            yield from emit(held["print"].to_numpy(), np.array([], np.int64))

    def emit(prints, cuts):
        a, b = [], []
        for x in np.split(prints.view(np.uint64), cuts) if len(prints) else []:
            if len(x) == 2:
                if int(x[0] ^ x[1]).bit_count() <= radius:
                    a.append(x[0])
                    b.append(x[1])
            elif len(x) > 2:
                p, q = bucket_forest(x, radius)
                a += p
                b += q
        if a:
            yield pd.DataFrame({"u": np.array(a, np.uint64).view(np.int64),
                                "v": np.array(b, np.uint64).view(np.int64)})
    return run


def _meet(tables: DataFrame, keys: list[str], radius: int, limit: int | None):
    """Links inside the buckets of two rows and more, and the rows of buckets
    over ``limit``, which are not searched."""
    sizes = tables.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    rows = tables.join(sizes, keys)
    small = rows if limit is None else rows.filter(F.col("n") <= limit)
    links = (small.drop("n").repartition(*keys).sortWithinPartitions(*keys)
             .mapInPandas(_links(radius, keys), "u long, v long"))
    return links, None if limit is None else rows.filter(F.col("n") > limit)


def near_links(prints: DataFrame, radius: int = 4, bucket_limit: int = 16_384) -> DataFrame:
    """``u, v``: links between distinct fingerprints (column ``print``) that
    span every group of fingerprints at most ``radius`` bits apart.

    A pair that meets under the bits kept so far meets under some mask of the
    next family too, so buckets over ``bucket_limit`` are not searched but
    divided by it. For radius 4 the families leave at most 14 bits free under
    all masks together: no bucket of over 16,384 fingerprints is ever searched."""
    families = [step for step in FAMILIES if math.gcd(step, (1 << (radius + 1)) - 1) == 1]
    rows, links = prints.select("print", F.lit(0).cast("long").alias("bits")), None
    for i, step in enumerate(families):
        masks = covering_masks(radius, step)
        tables = _tables(_dealt(rows, len(masks)), masks)
        if i:
            tables = tables.distinct()                       # masks that keep the same bits
        found, heavy = _meet(tables, ["bits", "key"], radius,
                             bucket_limit if step != families[-1] else None)
        links = found if links is None else links.unionByName(found)
        if heavy is None:
            break
        rows = C.saved(heavy.select("print", "bits").distinct(), "heavy")
        if rows.isEmpty():
            break
    return C.saved(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")


# -------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """``node, root``: connected components of undirected links ``u, v`` by
    alternating large and small stars; roots are the smallest nodes. Minima
    are pre-aggregated, so a hub costs one row per task in each round. Rounds
    (about the logarithm of the longest chain) go on until nothing changes."""
    edges, state, stars = links, None, C.Rounds("stars")
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                               F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").filter("u <> v").distinct()
        edges = stars.next(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def roots(prints: DataFrame, radius: int = 4, bucket_limit: int = 16_384) -> DataFrame:
    """``print, root``: every distinct fingerprint and its component's root."""
    distinct = C.saved(prints.select("print").distinct(), "distinct")
    links = near_links(distinct, radius, bucket_limit)
    if links.isEmpty():
        return distinct.withColumn("root", F.col("print"))
    found = components(links)
    return distinct.join(found, distinct["print"] == found["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4,
                       bucket_limit: int = 16_384, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id``: smallest
    doc_id reachable over links of at most ``radius`` differing bits.

    Null and empty texts have fingerprint zero and are linked like any other;
    a document of fewer words than a shingle has one shingle. Null ids take
    part but are never a component's id (null if it has no other); repeated
    rows share their component; texts of any length are read whole; an empty
    table gives an empty result; other columns are ignored."""
    prints = C.saved(fingerprints(docs, shingle, id_col, text_col), "prints")
    by_print = C.saved(prints.groupBy("print").agg(F.min("doc_id").alias("least"))
                       .join(roots(prints, radius, bucket_limit), "print"), "roots")
    least = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = C.saved(by_print.join(least, "root").select("print", "component_id"), "named")
    return prints.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket_limit: int = 16_384,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of every component one row,
    that of its smallest doc_id (rows without an id come last; where an id is
    repeated in a component, the text of the smaller XXH64; of rows alike in id
    and text any one)."""
    prints = C.saved(fingerprints(docs, shingle, id_col, text_col), "prints")
    alike = prints.groupBy("print", F.coalesce("doc_id", F.lit(C.NO_ID)).alias("id"), "key") \
        .agg(F.count("*").alias("n"))
    by_print = alike.groupBy("print").agg(F.min(F.struct("id", "key", "n")).alias("head"))
    stay = C.saved(by_print.join(roots(prints, radius, bucket_limit), "print").groupBy("root")
                   .agg(F.min("head").alias("head")).select(
                       F.col("head.id").alias("_id"), F.col("head.key").alias("_key"),
                       F.col("head.n").alias("_n")), "stay")
    repeated = C.saved(stay.filter("_n > 1"), "repeated")         # rows alike are few: a table of its own

    def of(heads: DataFrame) -> DataFrame:
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        return rows.join(heads, (F.coalesce(F.col("row")[id_col].cast("long"), F.lit(C.NO_ID)) == F.col("_id"))
                         & (F.xxhash64(F.col("row")[text_col].cast("string")) == F.col("_key")))

    one = of(stay.filter("_n = 1")).select("row")
    many = of(repeated).groupBy("_id", "_key").agg(F.first("row").alias("row")).select("row")
    return one.unionByName(many).select("row.*")
