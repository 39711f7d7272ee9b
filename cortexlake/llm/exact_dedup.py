"""Exact dedup by Golomb-coded fingerprint exchange.

1. Every partition turns its documents into blocks: doc_id, 64-bit
   fingerprint, SHA-256 and size of the normalised text. Blocks are written
   once and are small against the texts.
2. A block sends its distinct fingerprints, sorted and Rice-coded, to the
   owners of their ranges, with a bitmap of those that it holds twice itself.
   A group of copies costs one code word per block, however large it is.
3. An owner merges the sorted runs it received and answers every block with a
   bitmap: which of its fingerprints occur elsewhere too.
4. Blocks apply the bitmaps; documents with a marked fingerprint are suspects.
5. Only texts of suspects move: a table of fingerprint bits, 8 or more for
   each different suspect and 64 MB at most, filters the scan (it may let others
   pass, never hold a suspect back), then texts are grouped by their bytes,
   which verifies them. Copies meet in the map side's partial aggregation
   first."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK = f"block string, doc_ids {C.BYTES}, prints {C.BYTES}, shas {C.BYTES}, sizes {C.BYTES}, no_id {C.BYTES}"
#: Least and most bits of the suspect table: 1 MB, and 64 MB whatever the input's size.
LEAST_BITS, MOST_BITS = 1 << 23, 1 << 29


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.SPACE, "")


# ------------------------------------------------------------ Rice coding
def rice_encode(values: np.ndarray, bits: int) -> tuple[bytes, int]:
    """Golomb code of parameter 2**bits of the gaps of sorted distinct values:
    quotient in unary, remainder in ``bits`` bits."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    q = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(q + 1 + bits)
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total, np.uint8)
    stop = ends - bits - 1                      # the one that ends the unary part
    out[stop] = 1
    for i in range(bits):
        out[stop + 1 + i] = (gaps >> np.uint64(bits - 1 - i)).astype(np.uint8) & 1
    return np.packbits(out).tobytes(), total


def rice_decode(code: bytes, n: int, bits: int) -> np.ndarray:
    stream = np.unpackbits(np.frombuffer(code, np.uint8))
    ones = np.flatnonzero(stream)
    gaps = np.zeros(n, np.uint64)
    at, k, ones_l = 0, 0, ones.tolist()
    stops = np.zeros(n, np.int64)
    for i in range(n):                          # next one at or after `at` ends the unary part
        while ones_l[k] < at:
            k += 1
        stops[i] = ones_l[k]
        gaps[i] = ones_l[k] - at
        at = ones_l[k] + 1 + bits
    gaps <<= np.uint64(bits)
    for i in range(bits):
        gaps |= stream[stops + 1 + i].astype(np.uint64) << np.uint64(bits - 1 - i)
    return np.cumsum(gaps, dtype=np.uint64)


def _rice_bits(span: int, n: int) -> int:
    return max(0, int(np.log2(max(1.0, span / max(n, 1) * 0.69))))


def table_bits(different: int) -> int:
    """Bits of the suspect table: 8 to 16 for each different suspect, so that
    about one other text in ten passes, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (8 * different - 1).bit_length()))


# ----------------------------------------------------------------- blocks
def _blocks(rows: int):
    def run(frames):
        from pyspark import TaskContext
        part, k = TaskContext.get().partitionId(), 0
        for pdf in frames:
            for i in range(0, len(pdf), rows):
                x = pdf.iloc[i:i + rows]
                yield pd.DataFrame({
                    "block": [f"{part}-{k}"],
                    "doc_ids": [x["doc_id"].fillna(0).to_numpy(np.int64).tobytes()],
                    "prints": [x["print"].to_numpy(np.int64).tobytes()],
                    "shas": [b"".join(map(bytes.fromhex, x["sha"]))],
                    "sizes": [x["size"].to_numpy(np.int64).tobytes()],
                    "no_id": [x["doc_id"].isna().to_numpy(np.uint8).tobytes()]})
                k += 1
    return run


def _send(owners: int):
    span = (1 << 64) // owners

    def run(frames):
        for pdf in frames:
            for block, raw in zip(pdf["block"], pdf["prints"]):
                prints, count = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
                owner = np.minimum((prints // np.uint64(span)).astype(np.int64), owners - 1)
                cuts = np.searchsorted(owner, np.arange(owners + 1))
                rows = []
                for o in np.unique(owner).tolist():
                    a, b = cuts[o], cuts[o + 1]
                    bits = _rice_bits(span, b - a)
                    code, _ = rice_encode(prints[a:b] - np.uint64(o * span), bits)
                    rows.append((o, block, int(b - a), bits, code,
                                 np.packbits(count[a:b] > 1).tobytes()))
                yield pd.DataFrame(rows, columns=["owner", "block", "n", "bits", "code", "twice"])
    return run


SENT = f"owner long, block string, n long, bits int, code {C.BYTES}, twice {C.BYTES}"
ANSWER = f"owner long, block string, n long, seen {C.BYTES}"


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = [rice_decode(c, n, b) for c, n, b in zip(pdf["code"], pdf["n"], pdf["bits"])]
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool)
                            for t, n in zip(pdf["twice"], pdf["n"])])
    _, inverse, count = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
    seen = (count[inverse] > 1) | twice
    cuts = np.cumsum(pdf["n"])[:-1]
    return pd.DataFrame({"owner": pdf["owner"], "block": pdf["block"], "n": pdf["n"],
                         "seen": [np.packbits(x).tobytes() for x in np.split(seen, cuts)]})


def _apply(frames):
    """Blocks with their answers, to one row per document."""
    for pdf in frames:
        for r in pdf.itertuples(index=False):
            prints = np.frombuffer(r.prints, np.uint64)
            distinct = np.unique(prints)
            marks = np.concatenate([
                np.unpackbits(np.frombuffer(a["seen"], np.uint8), count=a["n"])
                for a in sorted(r.answers, key=lambda a: a["owner"])]).astype(bool)
            ids = pd.array(np.frombuffer(r.doc_ids, np.int64), "Int64")
            ids[np.frombuffer(r.no_id, np.uint8).astype(bool)] = pd.NA
            yield pd.DataFrame({
                "doc_id": ids, "print": prints.view(np.int64),
                "sha": [r.shas[i:i + 32].hex() for i in range(0, len(r.shas), 32)],
                "size": np.frombuffer(r.sizes, np.int64),
                "suspect": marks[np.searchsorted(distinct, prints)]})


def exact_dedup(docs: DataFrame, block_rows: int = 10_000, owner_rows: int = 500_000,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. Texts are equal when identical without white space.

    Of equal texts the longest original, then the smallest doc_id stays (a
    missing id comes last; where the same doc_id is repeated with the same
    text and length one of these rows, chosen at random, is ``kept``). Null
    text is an empty text; empty texts equal each other. Other columns are
    ignored; an empty table gives an empty result."""
    text = C.id_text(docs, id_col, text_col)
    prints = text.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"),
                         normalised(F.col("text")).alias("t")).select(
        "doc_id", "size", F.xxhash64("t").alias("print"), F.sha2("t", 256).alias("sha"))
    blocks = C.saved(prints.mapInPandas(_blocks(block_rows), BLOCK), "blocks")
    total = blocks.select(F.sum(F.length("prints") / 8)).first()[0] or 0
    owners = max(2, int(-(-total // owner_rows)))
    answers = (blocks.select("block", "prints").mapInPandas(_send(owners), SENT)
               .groupBy("owner").applyInPandas(_answer, ANSWER))
    per_block = answers.groupBy("block").agg(
        F.collect_list(F.struct("owner", "n", "seen")).alias("answers"))
    marked = C.saved(blocks.join(per_block, "block").drop("block").mapInPandas(
        _apply, "doc_id long, print long, sha string, size long, suspect boolean"), "marked")

    # bits of the suspects' fingerprints, for the second scan
    suspects = marked.filter("suspect").select("print")
    different = suspects.agg(F.approx_count_distinct("print")).first()[0]
    best = F.min(F.struct((-F.col("size")).alias("size"),
                          F.coalesce("doc_id", F.lit(C.NO_ID)).alias("keep_id")))
    groups = C.saved(
        C.likely(text.select(F.coalesce("doc_id", F.lit(C.NO_ID)).alias("doc_id"),
                             F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"),
                             normalised(F.col("text")).alias("t"))
                 .withColumn("print", F.xxhash64("t")), "print", suspects, table_bits(different))
        .groupBy("print", "t").agg(best.alias("best"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .select(F.sha2("t", 256).alias("sha"), "group_size", "best.*")
        .withColumnRenamed("size", "keep_size"), "groups")
    none = F.col("keep_id") == C.NO_ID
    own = (F.coalesce("doc_id", F.lit(C.NO_ID)) == F.col("keep_id")) & (
        F.col("size") == -F.col("keep_size"))
    joined = marked.filter("suspect").join(groups, "sha", "left")
    # a repeated row (same id, text and size as the one that stays) stays once
    twins = F.row_number().over(Window.partitionBy("sha", "doc_id", "size").orderBy("print"))
    single = joined.filter(F.col("keep_id").isNull() | ~own).withColumn("first", F.lit(False))
    heads = joined.filter(own).withColumn("first", twins == 1)
    dup = single.unionByName(heads).select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).when(~none, F.col("keep_id"))
        .alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("first") | F.col("group_size").isNull()).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = marked.filter("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(dup)
