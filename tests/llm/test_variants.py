"""Spelling variants, MinHash near-dedup and hard negatives against brute force."""
from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cortexlake.llm import hard_negatives as H
from cortexlake.llm import minhash as M
from cortexlake.llm import spelling as S


# ------------------------------------------------------------ spelling
def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_variants(rows, modulus=199, min_n=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % modulus == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= min_n}
    form = {}
    found = {w: [x for x in n if near(w, x)] for w in n}
    for w, others in found.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(found[w]), n.get(form.get(w))))
    return sorted(out)


def test_trie_numbers_hold_over_any_ranges():
    r = random.Random(3)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(300)} | {"a" * 40})
    for size in (1, 2, 7, 1000):
        ranges = [words[i:i + size] for i in range(0, len(words), size)]
        ends = S.Ends([(10 * j, part[0], part[-1]) for j, part in enumerate(ranges)])
        number, of = {}, {}
        for j, part in enumerate(ranges):
            for w, nodes in S.numbered_nodes(iter(part), j, ends):
                assert len(nodes) == len(w) + 1
                for d, x in enumerate(nodes):
                    assert number.setdefault(w[:d], x) == x and of.setdefault(x, w[:d]) == w[:d]


@pytest.mark.parametrize("modulus", [199, 3])
def test_spelling(docs_of, odd_texts, modulus):
    r = random.Random(5)
    base = ["".join(r.choice("abÀÿ×") for _ in range(r.randint(6, 8))) for _ in range(25)]
    pool = [*base]
    for w in base:
        for _ in range(4):
            i, c = r.randrange(len(w)), r.choice("ab×")
            pool.append(r.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]]))
    pool += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaab", "baaaaaa", "z" * 700, "z" * 701]
    weight = [r.choice([1, 2, 8, 40]) for _ in pool]
    rows = [(i, " ".join(x.upper() if i % 3 else x for x in r.choices(pool, weight, k=60))) for i in range(120)]
    rows = [(i, t.replace("ÀŸ", "Àÿ")) for i, t in rows]
    rows += list(enumerate(odd_texts)) + [(None, "aaaaaa aaaaaa")] * 4 + [rows[0]] * 3
    docs = docs_of(rows, 5).withColumn("word", F.lit(1)).withColumn("n", F.lit("clash"))
    got = sorted(tuple(x) for x in S.spelling_variants(docs, modulus=modulus).select(
        "word", "form", "root", "n", "n_near", "form_n").collect())
    want = brute_variants(rows, modulus)
    assert got == want and any(x[1] for x in want) and any(x[4] > 3 for x in want)
    assert S.spelling_variants(docs_of([])).count() == 0


def test_chain_of_forms(docs_of):
    rows = [(i, w) for i, (w, n) in enumerate([("abcdefgh", 5), ("abcdefg", 25), ("abcdef", 125)])
            for _ in range(n)]
    got = {r.word: r for r in S.spelling_variants(docs_of(rows), modulus=10**12).collect()}
    assert got["abcdefgh"].form == "abcdefg" and got["abcdefgh"].root == "abcdef"
    assert got["abcdef"].form is None and got["abcdef"].root == "abcdef" and got["abcdef"].n_near == 1


# ------------------------------------------------------------- minhash
def brute_components(rows, shingle=2, percent=80):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))),
                  key=str)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return words


def near_rows(seed, groups, copies):
    """Chains and bushes of near copies, some just over and some just under."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        words = [f"{r.choice('abcdef')}{r.randrange(400)}" for _ in range(r.choice([3, 8, 20, 60]))]
        for _ in range(copies):
            rows.append(" ".join(words))
            nxt = edited(r, words, r.choice([0, 1, 1, 2, 4]))
            words = nxt if r.random() < 0.6 else words
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_minhash(docs_of, odd_texts, block):
    rows = near_rows(1, 25, 9) + [(1000 + i, t) for i, t in enumerate(odd_texts)]
    rows += [(None, rows[0][1]), (None, "only here without id"), (None, "Only HERE without id"), rows[1], rows[1]]
    docs = docs_of(rows, 5).withColumn("node", F.lit(1)).withColumn("root", F.lit("clash"))
    got = M.minhash_components(docs, block_shingles=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)
    assert all(r.kept == (r.component_id is None if r.doc_id is None else r.doc_id == r.component_id) for r in got)
    assert M.minhash_components(docs_of([])).count() == 0


def test_one_large_group_over_many_blocks(docs_of):
    r = random.Random(9)
    base = [f"x{i}" for i in range(60)]
    rows = [(i, " ".join(edited(r, base, 1))) for i in range(150)]
    far = edited(r, base, 8)                       # apart from the group, but reached through a chain
    for step in range(9):
        rows.append((500 + step, " ".join(far[:7 * step] + base[7 * step:])))
    docs = docs_of(rows, 4)
    got = M.minhash_components(docs, block_shingles=400).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute_components(rows)


def test_blocks_against_blocks():
    r = random.Random(2)
    texts = [t for _, t in near_rows(3, 6, 8)]
    sets = [M.shingle_set(t) for t in texts]
    r.shuffle(sets)
    linked = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    for i, j in M.forest(sets, 80):
        assert linked(sets[i], sets[j])
    left, right = sets[:20], sets[20:]
    labels = [list(range(20)), list(range(20, len(sets)))]
    found = M.bridges(left, right, *labels, 80)
    at = list(range(len(sets)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in found:
        assert linked(left[i], right[j])
        at[find(i)] = find(20 + j)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            assert not linked(a, b) or find(i) == find(20 + j)


def test_min_max_estimates_jaccard():
    bands, r = M.Bands(), np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 400, np.uint64)
    a, b = pool[:300], pool[60:360]                # J = 240 / 360
    same = [x == y for x, y in zip(bands.signature(a), bands.signature(b))]
    assert abs(np.mean(same[0]) - 2 / 3) < 0.1 and abs(np.mean(same[1]) - 2 / 3) < 0.1
    assert len(bands.keys(a)) == 80 and len(bands.keys(pool[:0])) == 0


# ------------------------------------------------------ hard negatives
def brute_negatives(rows, k=5, m=5):
    ok = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
          if i is not None and label is not None and v
          and all(x is not None and math.isfinite(x) for x in v)]
    asks, out = {}, []
    for i, label, v in ok:
        if i % 10 == 0:
            asks[i] = min(asks.get(i, (str(label), v)), (str(label), v))
    for q, (label, x) in asks.items():
        scored = [(-sum(a * b for a, b in zip(x, y)), i, str(other)) for i, other, y in ok
                  if i != q and len(x) == len(y)]
        pos = sorted((s, i) for s, i, other in scored if other == label)[:k]
        for s, p in pos:
            neg = sorted((t, i) for t, i, other in scored
                         if other != label and 80 * -s <= 100 * -t <= 100 * -s)[:m]
            out += [(q, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(neg)]
    return sorted(out)


@pytest.mark.parametrize("bucket_rows,scale", [(25, 1.0), (8192, 0.3)])
def test_hard_negatives(spark, bucket_rows, scale):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(300):
        v = centres[i % 6] + scale * rng.normal(size=8)
        rows.append((i, int(rng.integers(3)), [float(x) for x in v * (0.2 if i % 9 == 0 else 1.0)]))
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(20)]                       # ties
    rows += [(2000, 1, None), (2010, 1, [float("nan")] * 8), (2020, 1, [None] * 8), (2030, 1, []),
             (2040, None, rows[1][2]), (2050, 1, [1.0, 2.0]), (2051, 1, [1.0, 2.5]), (2052, 2, [1.0, 2.25]),
             (None, 1, rows[1][2]), (2060, 1, [0.0] * 8), (2070, 0, [-float(x) for x in rows[0][2]])]
    rows += [rows[10], rows[20], rows[21], (30, 2, rows[33][2])]                     # repeated rows and ids
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>") \
        .withColumn("rank", F.lit("x")).withColumn("bucket", F.lit(0)).repartition(4)
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0, bucket_rows=bucket_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_coordinate_ranges_lose_nothing_and_prune():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(10, 16))[rng.integers(0, 10, 600)] + 0.2 * rng.normal(size=(600, 16))
    x = np.floor(256 * x / np.sqrt((x * x).sum(1))[:, None])              # a bucket holds one length
    index = H.CoordinateIndex(np.arange(600), np.zeros(600), x)
    left = 0
    for q in x[:40]:
        s = x @ q
        for floor in (np.sort(s)[-5], 0.5 * s.max(), 1.0):
            rows = index.feasible(q, float(floor), 4)
            assert set(np.flatnonzero(s >= floor)) <= set(rows.tolist())
        left += len(index.feasible(q, float(np.sort(s)[-5]), 4))
    assert left < 0.5 * 40 * 600
