"""Spelling variant grouping by a dictionary of trie-node pairs.

The words form two tries, one of the words and one of the reversed words, and
every node has a number. A word without its character i is the pair (node of
the i characters before it, reversed node of those after it); a word with a
place for one more character at i is the pair of the nodes on both sides. So

* two words differ in one replaced character iff they share a skip pair, and
* one word is the other with a character inserted iff a gap pair of the shorter
  is a skip pair of the longer. An insertion into a run of equal characters
  has several places; only the run's first character counts.

Integers stand for whole prefixes and suffixes, so keys have one size and the
neighbours are exact. The tries are numbered in sorted order: words are dealt
over ranges, a range numbers the nodes that a word does not share with the one
before it, and nodes that reach over the ends of ranges are named by the ends
(two words per range, the only thing the driver sees). A skip pair holds at
most one word per letter of the alphabet and a gap pair one word, so groups are
bounded, and counts and best neighbours need no list of pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import groupby
from operator import itemgetter
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

RUN = re.compile("[a-zÀ-ÿ]+")
ROOT, SPANNING = 1 << 61, 1 << 62


# ------------------------------------------------------------------ words
def word_counts(docs: DataFrame, min_chars: int = 6, min_n: int = 5, modulus: int = 199,
                held: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: occurrences are added up per task (at most ``held`` words
    in memory) before they are shuffled."""
    def out(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches):
        counts: dict = {}
        for batch in C.slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    size = len(w)
                    if size < min_chars:
                        continue
                    h = zlib.crc32(w.encode(), start)
                    if h % modulus == 0:
                        if size == min_chars:
                            continue
                        i = h % size
                        w = w[:i] + w[i + 1:]
                    counts[w] = counts.get(w, 0) + n
                if len(counts) >= held:
                    yield out(counts)
                    counts = {}
        if counts:
            yield out(counts)

    return C.id_text(docs, id_col, text_col).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


# ------------------------------------------------------------------ tries
def _shared(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


class Ends:
    """First and last word of every range, in order, and the numbers of the
    trie nodes that words of several ranges share."""

    def __init__(self, ends: list):
        self.place = {part: j for j, (part, _, _) in enumerate(ends)}
        self.first, self.last = [e[1] for e in ends], [e[2] for e in ends]
        # number of leading characters that the words at the end before range j share
        self.over = [_shared(self.last[j - 1], self.first[j]) if j else 0 for j in range(len(ends))] + [0]

    def left(self, j: int) -> list:
        """Numbers of the nodes of depth 1.. that range j shares with the one
        before it: a node is named by the first range end that it reaches over."""
        names = []
        for d in range(1, self.over[j] + 1):
            q = j
            while q > 1 and self.over[q - 1] >= d and self.first[q - 1][:d] == self.first[j][:d]:
                q -= 1
            names.append(SPANNING + (q << 40) + d)
        return names

    def right(self, j: int) -> list:
        """The same of the nodes shared with the range after it."""
        left, own = self.left(j), _shared(self.first[j], self.last[j])
        return [left[d - 1] if d <= min(len(left), own) else SPANNING + ((j + 1) << 40) + d
                for d in range(1, self.over[j + 1] + 1)]


def numbered_nodes(words: list, j: int, ends: Ends):
    """The sorted words of range j, each with the numbers of its prefixes, the
    empty one first."""
    left, right, first, last = ends.left(j), ends.right(j), ends.first[j], ends.last[j]
    before, nodes, count = "", [ROOT], 0
    for w in words:
        shared = _shared(before, w)
        nodes = nodes[:shared + 1]
        for d in range(shared + 1, len(w) + 1):
            if d <= len(left) and w[:d] == first[:d]:
                nodes.append(left[d - 1])
            elif d <= len(right) and w[:d] == last[:d]:
                nodes.append(right[d - 1])
            else:
                nodes.append((j << 40) + count)
                count += 1
        before = w
        yield w, nodes


def trie(words: DataFrame, name: str) -> DataFrame:
    """``word, place, nodes``: the words' places in code-point order and the
    numbers of the nodes on their ways through the trie."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = C.saved(words.select("word").repartitionByRange(parts, "word")
                     .withColumn("part", F.spark_partition_id()), name)
    ends = Ends([(r["part"], r["first"], r["last"]) for r in ranged.groupBy("part").agg(
        F.min("word").alias("first"), F.max("word").alias("last")).orderBy("part").collect()])

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        held, size = [], 0
        for part, group in groupby(rows(), itemgetter(0)):
            j = ends.place[part]
            for n, (word, nodes) in enumerate(numbered_nodes((w for _, w in group), j, ends)):
                held.append((word, (j << 40) + n, nodes))
                size += len(nodes)
                if size >= 100_000:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    def batch_of(held):
        words, places, nodes = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(places, pa.int64()),
                                           pa.array(nodes, pa.list_(pa.int64()))], ["word", "place", "nodes"])

    return ranged.select("part", "word").repartition("part").sortWithinPartitions("part", "word") \
        .mapInArrow(run, "word string, place long, nodes array<long>")


# ------------------------------------------------------------- neighbours
def node_pairs(words: DataFrame) -> DataFrame:
    """``p, s, n, place, kind``: the skip pairs (kind 1: the character is the
    first of its run, else 0) and gap pairs (kind 2) of every word of ``words``
    (word, n, place, nodes)."""
    back = trie(words.select(F.reverse("word").alias("word")), "reversed").select(
        F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    rows = words.withColumnRenamed("nodes", "ahead").join(back, "word") \
        .withColumn("size", F.size("ahead") - 1).withColumn("letters", F.split("word", ""))

    def pair(i, after, kind):
        return F.struct(F.get("ahead", i).alias("p"), F.get("back", after).alias("s"), kind.alias("kind"))

    def begins(i):
        return F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), 0).otherwise(1)

    places = F.sequence(F.lit(0), F.col("size") - 1)
    skips = F.transform(places, lambda i: pair(i, F.col("size") - 1 - i, begins(i)))
    gaps = F.transform(F.sequence(F.lit(0), F.col("size")), lambda i: pair(i, F.col("size") - i, F.lit(2)))
    return rows.select("n", "place", F.inline(F.concat(skips, gaps)))


def neighbours(pairs: DataFrame) -> DataFrame:
    """``place, n_near, best``: number of near words and the one of largest n
    (ties: first place) of every word that has any. A pair's words are at most
    one per letter and one for the gap."""
    me = F.struct("n", (-F.col("place")).alias("back"), "kind")       # ordered by n, then first place
    groups = pairs.groupBy("p", "s").agg(F.collect_list(me).alias("all")).filter(F.size("all") > 1)
    groups = groups.select(
        F.sort_array(F.filter("all", lambda x: x["kind"] < 2), asc=False).alias("skips"),
        F.sort_array(F.filter("all", lambda x: x["kind"] == 1), asc=False).alias("begins"),
        F.get(F.filter("all", lambda x: x["kind"] == 2), 0).alias("gap"))

    def found(x, count, best):
        return F.struct((-x["back"]).alias("place"), count.cast("long").alias("near"),
                        F.struct(best["n"].alias("n"), best["back"].alias("back")).alias("best"))

    first, second = F.get("skips", 0), F.get("skips", 1)
    replaced = F.when(F.size("skips") > 1, F.transform("skips", lambda x: found(
        x, F.size("skips") - 1, F.when(x["back"] == first["back"], second).otherwise(first))))
    shorter = F.when(F.col("gap").isNotNull(), F.transform("begins", lambda x: found(x, F.lit(1), F.col("gap"))))
    longer = F.when(F.col("gap").isNotNull() & (F.size("begins") > 0), F.array(
        found(F.col("gap"), F.size("begins"), F.get("begins", 0))))
    none = F.array().cast("array<struct<place:bigint,near:bigint,best:struct<n:bigint,back:bigint>>>")
    rows = groups.select(F.inline(F.concat(*[F.coalesce(x, none) for x in (replaced, shorter, longer)])))
    return rows.groupBy("place").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``place, root``: the end of the way from ``place`` over ``to``. Ways
    have no circles (n grows along them) and are halved in each round."""
    rounds = C.Rounds("ways")
    ways = rounds.next(links.select("place", F.col("to").alias("root")))
    while True:
        ahead = ways.select(F.col("place").alias("root"), F.col("root").alias("next"))
        longer = rounds.next(ways.join(ahead, "root", "left").select(
            "place", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if longer.filter("moved").isEmpty():
            return longer.select("place", "root")
        ways = longer.drop("moved")


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_n: int = 5, ratio: int = 5,
                      modulus: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of whole texts,
    A-Z lower-cased, one code point taken out where ``modulus`` divides the CRC
    of ``doc_id:run``, of at least ``min_chars`` code points and ``min_n``
    occurrences. A word's form is its near word (one inserted, deleted or
    replaced code point) of largest n, ties to the first in code-point order,
    if that n is at least ``ratio`` times its own. Null and empty texts have no
    words; a null doc_id stands as an empty text before the colon; repeated
    rows count as often as they come; runs of any length are taken whole; an
    empty table gives an empty result; other columns are ignored."""
    words = C.saved(word_counts(docs, min_chars, min_n, modulus, id_col=id_col, text_col=text_col), "counts")
    ahead = C.saved(trie(words, "words").join(words, "word"), "ahead")
    near = C.saved(neighbours(node_pairs(ahead)), "near")
    places = ahead.select("place", "word", "n")
    rows = C.saved(places.join(near, "place", "left").select(
        "place", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.back")).alias("to")), "variants")
    ends = roots(rows.filter("to is not null").select("place", "to"))
    form = places.select(F.col("place").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = ends.join(places.select(F.col("place").alias("root"), F.col("word").alias("end")), "root") \
        .select("place", "end")
    return rows.join(form, "to", "left").join(root, "place", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::BIGINT, range(0, 8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
o AS (SELECT doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[a-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM o WHERE length(run) >= 6 GROUP BY doc_id, run),
b AS (SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''),
               lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                              ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS bytes
      FROM c),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
               lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                  ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1
      HAVING sum(n) >= 5 AND length(word) >= 6),
k AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM w),
s AS (SELECT word, n, left(word, i) || '*' || substr(word, i + 2) AS hole,
             left(word, i) || substr(word, i + 2) AS short FROM k),
e AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM s a JOIN s b ON a.hole = b.hole AND a.word <> b.word
      UNION SELECT s.word, s.n, w.word, w.n FROM s JOIN w ON s.short = w.word
      UNION SELECT w.word, w.n, s.word, s.n FROM s JOIN w ON s.short = w.word),
f AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r,
             count(*) OVER (PARTITION BY word) AS n_near FROM e),
g AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
             CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
      FROM w LEFT JOIN f ON f.word = w.word AND r = 1),
x AS (SELECT word, word AS root, form FROM g
      UNION ALL SELECT x.word, g.word, g.form FROM x JOIN g ON g.word = x.form)
SELECT g.word, g.form, x.root, g.n, g.n_near, g.form_n FROM g JOIN x ON x.word = g.word AND x.form IS NULL
"""
