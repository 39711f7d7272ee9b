"""Golden values for the text and link helpers (FIXTURES.md part A)."""

from __future__ import annotations

import re
import urllib.parse

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cortexlake.functions import links as L
from cortexlake.functions import text as T

GOLDEN = [
    ("Ax T1 (post) +C", "AX_T1_POST_C", "AX_T1_POST_C"),
    ("A ( B", "A_B", "A__B"),
    ("x?(/y", "XoverY", "X?overY"),
    (" t2?/t1 ?", "T2overT1", "T2overT1"),
    ("__a__", "_A_", "_A_"),
    ("a ?_", "A_?", "A_?"),
    (" ? ", "?", "?"),
    ("ep2d_diff*", "EP2D_DIFF", "EP2D_DIFF"),
    (None, "NULL", "NULL"),
]


def _python_onepass(s):
    """The one-pass cleaner written with Python's re, for comparison."""
    if s is None:
        return "NULL"
    s = s.upper()
    for p, r in [(r"[*]", ""), (r"[+]", ""), (r"\s+", "_"), (r"[?]*[/]", "over"),
                 (r"[/]{1}", "-"), (r"[(]", ""), (r"[)]", ""), (r"[?]$", ""),
                 (r"^[_]", ""), (r"[_]$", "")]:
        s = re.sub(p, r, s)
    return s


def test_clean_description_golden(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in GOLDEN], "d string")
    got = df.select(T.clean_description("d", "twopass").alias("a"),
                    T.clean_description("d", "onepass").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(a, b) for _, a, b in GOLDEN]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB (?)/*+_ \t  x1")), max_size=12),
                min_size=1, max_size=20))
def test_onepass_matches_python_re(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r.b for r in df.select(T.clean_description("d", "onepass").alias("b")).collect()]
    assert got == [_python_onepass(t) for t in texts]
    for g in got:
        assert not set(g) & set("()*+/")


def test_uid_suffixes(spark):
    uid = "1.3.6.1.4.1.14519.5.2.1." + "7" * 35 + "12345"
    df = spark.createDataFrame([(uid,), ("short",), ("abc",)], "u string")
    r = df.select(T.uid_suffix_fixed("u").alias("f"), T.uid_suffix_last5("u").alias("l")).collect()
    assert (r[0].f, r[0].l) == ("12345", "12345")
    assert (r[1].f, r[1].l) == ("", "short")
    assert r[2].f == ""


def test_object_tag_and_job_tag(spark):
    key = "data/TCIAData_p3/COLL-X/P-1/2001-01-01-12345/3-AX_T1-54321/blob.zip"
    df = spark.createDataFrame([(key,), ("a/b",)], "k string")
    r = df.select(T.object_tag("k").alias("t"), T.job_tag("k").alias("j")).collect()
    assert r[0].t == "P-1@2001-01-01-12345@3-AX_T1-54321"
    assert r[0].j == "data-TCIAData_p3-COLL-X-P-1-2001-01-01-12345-3-AX_T1-54321"
    assert r[1].t == ""


QUOTE_GOLDEN = [
    ("data/T v2/A@B/x (1)_0.jpg", "data/T%20v2/A%40B/x%20%281%29_0.jpg"),
    ("a+b*c~d", "a%2Bb%2Ac~d"),
    ("é/ü%41", "%C3%A9/%C3%BC%2541"),
]


def test_url_quote_golden(spark):
    df = spark.createDataFrame([(a,) for a, _ in QUOTE_GOLDEN], "s string")
    got = [r.q for r in df.select(L.url_quote("s").alias("q")).collect()]
    assert got == [b for _, b in QUOTE_GOLDEN]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=15), min_size=1, max_size=15))
def test_quote_unquote_match_python(spark, texts):
    texts = [t for t in texts if "\x00" not in t and not any(0xD800 <= ord(c) <= 0xDFFF for c in t)]
    if not texts:
        return
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(L.url_quote("s").alias("q"), L.url_unquote(L.url_quote("s")).alias("rt"),
                     L.url_unquote("s").alias("u")).collect()
    for t, r in zip(texts, rows):
        assert r.q == urllib.parse.quote(t)
        assert r.rt == t
        assert r.u == urllib.parse.unquote(t)


def test_enumerate_links_empty_and_order(spark):
    df = spark.createDataFrame([(0,), (3,)], "n int")
    r = df.select(L.enumerate_links(F.lit("out/x y"), F.lit("t"), "n", "bkt").alias("l")).collect()
    assert r[0].l == []
    assert r[1].l == [f"https://bkt.s3.amazonaws.com/out/x%20y/t_{i}.jpg" for i in range(3)]
