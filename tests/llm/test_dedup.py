"""Exact, line, substring and near dedup against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cortexlake.llm import common, exact_dedup, line_dedup, simhash, substring_dedup
from cortexlake.llm.common import saved


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n))


# ---------------------------------------------------------------- exact
def test_rice_round_trip():
    for n, seed in ((0, 0), (1, 1), (3000, 2)):
        v = np.unique(np.random.default_rng(seed).integers(0, 1 << 62, n, np.uint64))
        bits = exact_dedup._rice_bits(1 << 62, max(len(v), 1))
        code, _ = exact_dedup.rice_encode(v, bits)
        assert (exact_dedup.rice_decode(code, len(v), bits) == v).all()


def test_exact(docs_of, odd_texts):
    rows = list(enumerate(odd_texts)) + [(50 + i, "copy of  all") for i in range(40)]
    rows += [(99, "copy\nof all "), (100, "copyofall"), (None, "copyofall"), (None, "alone"), (7, "x " * 5000)]
    docs = docs_of(rows).withColumn("print", F.lit(0)).withColumn("sha", F.lit(0))
    got = exact_dedup.exact_dedup(docs, block_rows=5, owner_rows=10).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    assert len(got) == len(rows)
    for r in got:
        t = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.keep_id == min(groups[t])[2] and r.group_size == len(groups[t])
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0


def test_suspect_table_grows_within_bounds():
    bits = exact_dedup.table_bits
    assert bits(0) == bits(1 << 20) == exact_dedup.LEAST_BITS
    assert bits((1 << 20) + 1) == 2 * exact_dedup.LEAST_BITS
    assert bits(1 << 40) == exact_dedup.MOST_BITS


def test_replaced_tables_are_deleted(spark):
    rounds = common.Rounds("t")
    a = rounds.next(spark.range(3))
    first = rounds.path
    b = rounds.next(a.filter("id > 0"))
    assert b.count() == 2 and first != rounds.path
    at = spark._jvm.org.apache.hadoop.fs.Path(first)
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


# ----------------------------------------------------------------- line
def test_lines(docs_of):
    rows = [(i, f"menu here\n{prose(i, 5)}\r\n\nfooter {i % 2}", "en", "a") for i in range(40)]
    rows += [(100 + i, f"menu here\n{prose(100 + i, 5)}", "en", None) for i in range(12)]
    rows += [(200, "menu here\nonly", "en", "b"), (201, None, "en", "a"), (202, "", "en", "a"),
             (202, "", "en", "a"), (None, " menu here \nx", None, "a")]
    docs = docs_of(rows).withColumn("kept", F.lit("clash"))
    got = line_dedup.line_dedup(docs, max_ratio=0.3, min_pages=10).collect()
    assert len(got) == len(rows)
    for r in got:
        t, site = r.row["text"], r.row["source"]
        if t is None:
            assert r.kept is None and r.n_lines == r.n_removed == 0
            continue
        cut = {"a": ("menu here", "footer 0", "footer 1"), None: ("menu here",), "b": ()}[site]
        stay = [x for x in t.split("\n") if x.strip(" \t\r") not in cut]
        assert r.kept == "\n".join(stay) and r.n_removed == len(t.split("\n")) - len(stay)
    assert line_dedup.line_dedup(docs_of([])).count() == 0


def test_copies_are_one_page_in_the_pipeline(spark, docs_of):
    import corpus_pipeline as P
    copy = prose(9999, 5) + "\n" + prose(9998, 5)
    rows = [(i, f"menu here\n{prose(i, 5)}", "en", "a") for i in range(40)]
    rows += [(100 + i, copy + " \n" * (i % 2), "en", "a") for i in range(30)]      # the same lines
    rows += [(200 + i, None if i % 2 else "", "en", "a") for i in range(20)]
    rows += [(300 + i, copy, "en", "b") for i in range(30)]
    got = {r.doc_id: r.text for r in P.stage_lines(spark, docs_of(rows), "").collect()}
    assert len(got) == len(rows)
    for i, t, _, _ in rows:
        assert got[i] == (t.split("\n")[1] if i < 40 else t)


def test_copies_are_one_page(docs_of):
    copy = prose(9999, 5) + "\n" + prose(9998, 5)
    rows = [(i, f"menu here\n{prose(i, 5)}", "en", "a") for i in range(40)]
    rows += [(100 + i, copy + " \n" * (i % 2), "en", "a") for i in range(60)] + [(300, None, "en", "a")]
    for r in line_dedup.line_dedup(docs_of(rows)).collect():
        t = r.row["text"]
        assert r.kept == (t.split("\n")[1] if r.row["doc_id"] < 40 else t)


def test_near_copies_keep_their_lines_in_the_pipeline(spark, docs_of):
    """A tenth, and a third, of a source are near copies that differ in their
    first line: the boilerplate goes, the kept document's own lines stay."""
    import corpus_pipeline as P
    for n, others in ((12, 110), (40, 80)):
        body = "\n".join(prose(7000 + k, 12) for k in range(40))
        rows = [(i, f"menu here\n{prose(i, 30)}", "en", "a") for i in range(others)]
        rows += [(1000 + i, f"{prose(5000 + i, 3)}\n{body}\nmenu here", "en", "a") for i in range(n)]
        docs = saved(docs_of(rows), "near-lines")
        lines = saved(P.stage_lines(spark, docs, ""), "near-lines")
        got = {r.doc_id: r.text for r in lines.collect()}
        for i, t, _, _ in rows:
            assert got[i] == "\n".join(x for x in t.split("\n") if x != "menu here")
        kept = [r.doc_id for r in P.stage_near(spark, lines, "").collect()]
        assert [i for i in kept if i >= 1000] == [1000] and len(kept) == others + 1


# ------------------------------------------------------------ substring
def brute_substring(rows, k=13):
    first: dict = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - k + 1):
            key = tuple(w[j:j + k])
            first[key] = min(first.get(key, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j:j + k])] < ((1 << 63) - 1 if i is None else i):
                gone.update(range(j, j + k))
        out.append((i or -1, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


def test_substring_tasks_hold_few_objects(monkeypatch):
    """Over blocks of 1 MB, a task's memory over its input is a small multiple
    of a block: words are objects for a few texts at a time, nothing of a block
    is held while the next is made, and no word is remembered."""
    r = random.Random(3)
    vocabulary = [f"{r.getrandbits(40):x}"[:r.randint(2, 9)] for _ in range(200_000)]
    texts = [" ".join(r.choices(vocabulary, k=400)) for _ in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(range(1200)), pa.array(texts)],
                                       ["doc_id", "key", "text"])
    monkeypatch.setattr(substring_dedup, "TaskContext", type("T", (), {
        "get": classmethod(lambda c: c()), "partitionId": lambda self: 0}))
    buckets = substring_dedup.Buckets(np.full(substring_dedup.SLOTS, 60), 400_000)

    def peak(run):
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / 1e6

    assert peak(substring_dedup._load(13, 1_000_000, substring_dedup.SLOTS)) < 25     # 47 before, 13 now
    assert peak(substring_dedup._send(13, 1_000_000, buckets)) < 35                   # 56 before, 19 now


@pytest.mark.parametrize("bucket_words, group_blocks", [(200, 4096), (1_000_000, 4096), (200, 2), (20, 1)])
def test_substrings(docs_of, odd_texts, bucket_words, group_blocks, monkeypatch):
    shared = [prose(900 + i, 40) for i in range(4)]
    rows = list(enumerate(odd_texts))
    rows += [(100 + i, f"{prose(i, i % 30)} {shared[i % 4]}\n{prose(500 + i, 9)}") for i in range(60)]
    rows += [(200 + i, f"{prose(700 + i, 6)} common phrase that is everywhere {prose(800 + i, 20)}")
             for i in range(60)]
    rows += [(5, shared[0]), (5, shared[0]), (None, shared[1]), (None, shared[1] + " end"), (300, shared[0])]
    docs = saved(docs_of(rows).withColumn("ranges", F.lit("clash")), "t")
    monkeypatch.setattr(substring_dedup.duplicate_ranges, "__defaults__", (13, 2000, bucket_words, group_blocks))
    got = substring_dedup.substring_dedup(docs).collect()
    assert sorted((r.row["doc_id"] or -1, r.n_words, r.n_removed, r.kept) for r in got) == brute_substring(rows)
    assert substring_dedup.substring_dedup(docs_of([])).count() == 0


def test_buckets_stay_even_at_any_size():
    """Slots over a bucket are divided: by minimisers, or by second keys if far over the mean."""
    load = np.full(substring_dedup.SLOTS, 5_000)
    load[7] = 400_000
    b = substring_dedup.Buckets(load, 1_000)
    assert b.parts[0] == 5 and b.parts[7] == 400 and b.count == 1 + 5 * (len(load) - 1) + 400
    assert b.first_hot == b.count - 400
    rng = np.random.default_rng(5)
    first, second = rng.integers(0, 1 << 64, (2, 200_000), np.uint64)
    alike = first.copy()
    alike[:50_000] = np.uint64(7 << 51)                               # one minimiser, in slot 7
    got = b.of(alike, second)
    assert (got[:50_000] >= b.first_hot).all() and np.bincount(got[:50_000] - b.first_hot).max() < 250
    calm = got[50_000:][substring_dedup.slots_of(alike[50_000:], len(load)) != 7]
    assert calm.max() < b.first_hot and len(np.unique(calm)) > 38_000
    same = b.of(first, second[::-1])                                  # only minimisers count there
    far = substring_dedup.slots_of(first, len(load)) != 7
    assert (same[far] == b.of(first, second)[far]).all()


def test_a_window_in_every_block():
    """A merged packet holds a window common to its blocks once; the answer to
    it comes back as an answer to each block."""
    import pandas as pd
    one = lambda *x: [np.array([v], k) for v, k in zip(x, (np.int32, np.int32, np.int64, np.int64))]
    common_words = prose(77, 13)
    packets = pd.DataFrame([(5, f"{i}-0", substring_dedup._pack(
        f"{prose(1000 + i, 6)} {common_words} {prose(3000 + i, 6)}".encode(), *one(3, 13, i, i)))
        for i in range(20)], columns=["bucket", "block", "payload"])
    got = substring_dedup._merge(13)((5, 0), packets)
    packet = got[got["kind"] == 1]
    strings, _, wide, low, high = substring_dedup._unpack(
        packet["payload"].iloc[0], None, *[np.int32] * 2, *[np.int64] * 2)
    assert strings.decode().count(common_words) == 1 and wide.sum() == 20 * 12 + 1
    assert (low.min(), high.max()) == (0, 19)
    answer = substring_dedup._count(13)((5,), packet.drop(columns="kind"))
    back = substring_dedup._pass_on(pd.concat([got[got["kind"] == 2], answer.assign(kind=1)]))
    assert sorted(back["block"]) == sorted(f"{i}-0" for i in range(20))
    for p in back["payload"]:                    # blocks leave out what starts in their own document
        assert [x.tolist() for x in substring_dedup._unpack(p, *[np.int32] * 3, np.int64)] == [[3], [6], [1], [0]]


def test_hash_collisions_are_sorted_out(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_MIX", np.uint64(0))       # every hash alike
    ids = np.array([1, 2, 3, 9, 1, 2, 3, 8, 2, 3, 9], np.int32)
    at = np.array([0, 4, 8, 5])
    low = np.array([30, 20, 10, 40])
    assert substring_dedup.smallest_start(ids, at, low, 3).tolist() == [20, 20, 10, 40]


# --------------------------------------------------------------- SimHash
def brute_print(text, k=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint(odd_texts):
    for t in [*odd_texts, "Ünder THE Same", prose(1, 300)]:
        assert simhash.fingerprint(t) == brute_print(t)


def test_masks_cover():
    rng = random.Random(3)
    for step in (1, 7):
        masks = simhash.covering_masks(4, step)
        assert len(masks) == 31
        for _ in range(4000):
            bits = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not m & bits for m in masks)


def test_families_bound_every_bucket():
    kept = np.zeros(1, np.uint64)
    for step in simhash.FAMILIES:
        masks = np.array(simhash.covering_masks(4, step), np.uint64)
        rng = random.Random(step)
        for _ in range(500):
            bits = np.uint64(sum(1 << b for b in rng.sample(range(64), 4)))
            assert (masks & bits == 0).any()
        kept = np.unique((kept[:, None] | masks).ravel())
        kept = kept[64 - np.bitwise_count(kept).astype(int) > 14]
    assert not len(kept)                                      # 2^14 fingerprints at most


def test_crowded_bucket(spark):
    """Tens of thousands of fingerprints under one mask."""
    mask = simhash.covering_masks(4)[0]
    free = [b for b in range(64) if not mask >> b & 1][:16]
    rows = [(simhash._signed(sum(1 << b for i, b in enumerate(free) if x >> i & 1)),) for x in range(0, 1 << 16, 3)]
    rows.append((simhash._signed(sum(1 << b for b in range(64) if mask >> b & 1)),))
    roots = simhash.roots(spark.createDataFrame(rows, "print long"), bucket_limit=2_000)
    assert sorted(n for n, in roots.groupBy("root").count().select("count").collect()) == [1, len(rows) - 1]


def components_of(prints, radius=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("limit", [3, 16_384])
def test_components(spark, limit):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):                                   # a chain and a cluster
            prints.append(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    prints = sorted(set(prints))
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    links = simhash.near_links(df, 4, limit)
    for r in links.collect():
        assert bin((r.u ^ r.v) & (1 << 64) - 1).count("1") <= 4
    root = {r.node: r.root for r in simhash.components(links).collect()}
    brute, seen = components_of(prints), defaultdict(set)
    for p, c in zip(prints, brute):
        seen[c].add(root.get(simhash._signed(p), simhash._signed(p)))
    assert all(len(s) == 1 for s in seen.values()) and len({min(s) for s in seen.values()}) == len(seen)


def test_mask_tables_are_dealt_by_their_rows(spark, monkeypatch):
    """Few bytes of fingerprints lie in one task; the tables' rows may not."""
    most, tables = [], simhash._tables

    def counted(rows, masks):
        made = tables(rows, masks)
        most.append(made.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return made

    monkeypatch.setattr(simhash, "TABLE_ROWS", 4096, raising=False)
    monkeypatch.setattr(simhash, "_tables", counted)
    r = random.Random(5)
    prints = [r.getrandbits(64) for _ in range(3000)]
    prints += [p ^ (1 << 7 | 1 << 40) for p in prints[:50]]
    links = simhash.near_links(spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long").coalesce(1), 4)
    want = {tuple(sorted(map(simhash._signed, (p, p ^ (1 << 7 | 1 << 40))))) for p in prints[:50]}
    assert {(x.v, x.u) for x in links.collect()} == want
    assert most and max(most) <= 2 * 4096


def test_near_dedup(docs_of, odd_texts):
    base = prose(1, 400).split()
    rows = list(enumerate(odd_texts))
    for i in range(30):
        w = list(base)
        w[i * 7] = f"edit{i}"
        rows.append((100 + i, " ".join(w)))
    rows += [(None, ""), (400, prose(2, 80)), (400, prose(2, 80))]
    docs = docs_of(rows).withColumn("print", F.lit("clash"))
    got = simhash.simhash_components(docs).collect()
    prints = [brute_print(t) for _, t in rows]
    comp, least = components_of(prints), {}
    for c, (i, _) in zip(comp, rows):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((i or -1, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, comp))
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))
    assert set(kept[0].asDict()) == set(docs.columns)
    assert simhash.simhash_components(docs_of([])).count() == 0


def test_near_dedup_without_ids(docs_of):
    rows = [(None, prose(i, 60)) for i in range(3) for _ in range(1 + 20 * (i == 0))]   # no id in reach
    rows += [(None, None)] * 5 + [(None, prose(9, 60)), (9, prose(9, 60)), (9, prose(10, 60))]
    kept = simhash.keep_one(docs_of(rows)).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == sorted(
        [(-1, prose(i, 60)) for i in range(3)] + [(-1, ""), (9, prose(9, 60)), (9, prose(10, 60))])
    assert simhash.keep_one(docs_of([])).count() == 0
