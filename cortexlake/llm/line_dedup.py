"""Line dedup by site-relative frequency.

Per site (host), the share of its pages that contain a line tells boilerplate
from content: lines on more than ``max_ratio`` of the site's pages, and on at
least ``min_pages`` of them, are dropped from every page of the site. Built-in
functions only. A page adds a line at most once, and rows with the same set of
lines are one page; counts are pre-aggregated in the map side, so a hot line or
site costs one row per task. The boilerplate
lists are short by construction: a site has at most (lines per page) /
max_ratio of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C


def _key(line: Column) -> Column:
    """128 bits that stand for a line (outer blanks, tabs, returns off)."""
    t = F.btrim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))


def line_sets(docs: DataFrame, site_col: str, text_col: str = "text", *others: str) -> DataFrame:
    """``site, keys`` (the different lines of a row) and the columns ``others``."""
    lines = F.split(F.col(text_col).cast("string"), "\n")
    keys = F.array_distinct(F.transform(
        F.filter(lines, lambda x: F.btrim(x, F.lit(" \t\r")) != ""), _key))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    return docs.select(F.col(site_col).cast("string").alias("site"), F.coalesce(keys, none).alias("keys"), *others)


def boilerplate(sets: DataFrame, max_ratio: float = 0.05, min_pages: int = 10) -> DataFrame:
    """``site, lines``: per site the keys of its boilerplate lines. Rows of
    ``sets`` (``site, keys``) that have a site and its set of lines in common
    are one page: copies say nothing about a line."""
    pages = C.saved(sets.select("site", "keys", F.xxhash64(F.array_sort("keys")).alias("a"),
                                F.xxhash64(F.lit(1), F.array_sort("keys")).alias("b"))
                    .groupBy("site", "a", "b").agg(F.first("keys").alias("keys"))
                    .select("site", "keys"), "pages")
    totals = pages.groupBy("site").agg(F.count("*").alias("pages"))
    lines = (pages.select("site", F.explode("keys").alias("k"))
             .groupBy("site", "k").agg(F.count("*").alias("n"))
             .filter(F.col("n") >= min_pages))
    return (lines.join(totals, lines["site"].eqNullSafe(totals["site"]))
            .filter(F.col("n") > F.col("pages") * F.lit(float(max_ratio)))
            .groupBy(lines["site"]).agg(F.collect_list("k").alias("lines")))


def line_dedup(docs: DataFrame, site_col: str = "source", text_col: str = "text", max_ratio: float = 0.05,
               min_pages: int = 10, pages: DataFrame | None = None) -> DataFrame:
    """Every input row with all its columns in the struct ``row``, the text
    that stays (``kept``) and ``n_lines``, ``n_removed``.

    Lines end at line feeds; a line is compared without outer blanks, tabs and
    carriage returns; lines that are empty so are never counted or dropped;
    kept lines are unchanged. Rows of a site with the same set of lines count
    as one page, so groups of copies do not make their own text boilerplate;
    ``pages`` (from ``line_sets``) names the rows that count, all by default:
    where near copies are known, one of each group. Null text stays null (no
    lines; it counts like a text without lines); an empty text stays empty; a
    null site is a site of its own; repeated rows are kept as they are; texts
    of any length are split whole; a site with under ``min_pages`` pages keeps
    all; an empty table gives an empty result; columns of any name go along
    inside ``row``."""
    sets = line_sets(docs, site_col, text_col) if pages is None else pages
    drop = C.saved(boilerplate(sets, max_ratio, min_pages), "boilerplate") \
        .select(F.col("site").alias("_site"), F.col("lines").alias("_lines"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col].cast("string")
    split = F.split(text, "\n")
    stays = F.when(F.col("_lines").isNull(), split).otherwise(F.filter(
        split, lambda x: ~F.array_contains(F.col("_lines"), _key(x))))
    return (rows.join(drop, F.col("row")[site_col].cast("string").eqNullSafe(F.col("_site")), "left")
            .withColumn("_stays", stays)
            .select("row", F.array_join("_stays", "\n").alias("kept"),
                    F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size(split) - F.size("_stays"), F.lit(0)).cast("long")
                    .alias("n_removed")))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
s AS (SELECT DISTINCT source, coalesce(list_sort(list_distinct(list_filter(list_transform(
        string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> ''))),
        []) AS page FROM documents),
n AS (SELECT source, key, count(*) AS n FROM (SELECT source, unnest(page) AS key FROM s) u GROUP BY source, key),
p AS (SELECT source, count(*) AS pages FROM s GROUP BY source),
b AS (SELECT n.source, key FROM n JOIN p ON n.source IS NOT DISTINCT FROM p.source
      WHERE n >= 10 AND n > pages * 0.05),
f AS (SELECT r, i, line, b.key IS NOT NULL AS cut FROM k
      LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.key = b.key),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (cut) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '') AS kept
      FROM f GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE sha256(kept) END AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
