"""Catalog operators: series catalog -> object-key manifest, ROI selection and
scan-axis classification. All narrow projections and filters (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import CATALOG_FIELDS

# Orientation markers searched in object keys, in precedence
# order sagittal > coronal > axial.
SAG_MARK, COR_MARK, AX_MARKS = "SAG", "COR", ("AXIAL", "AX_")
AXIS_NAMES = ("sag", "cor", "ax")          # axis index 0, 1, 2


def with_catalog_columns(catalog: DataFrame, mode: str = "twopass") -> DataFrame:
    """P1 + P3: the derived columns of the landing jobs in one projection:
    null-filled components, cleaned description, UID suffixes and the key."""
    if mode == "twopass":
        # the two-pass job fills every (text) column first, then derives
        filled = {f: T.null_fill(f) for f in CATALOG_FIELDS}
        study_sfx = T.uid_suffix_fixed(filled["StudyInstanceUID"])
        inst_sfx = T.uid_suffix_fixed(filled["SeriesInstanceUID"])
        descr = T.clean_description("SeriesDescription", "twopass")
        prefix, uid = T.TWO_PASS_PREFIX, filled["SeriesInstanceUID"]
    elif mode == "onepass":
        # the one-pass job derives first and renders a missing part as NULL
        filled = {f: T.null_fill(f) for f in CATALOG_FIELDS}
        study_sfx = T.null_fill(T.uid_suffix_last5("StudyInstanceUID"))
        inst_sfx = T.null_fill(T.uid_suffix_last5("SeriesInstanceUID"))
        descr = T.clean_description("SeriesDescription", "onepass")
        prefix, uid = T.ONE_PASS_PREFIX, F.col("SeriesInstanceUID")
    else:
        raise ValueError(f"unknown catalog mode {mode!r}")
    key = T.build_object_key(prefix, filled["Collection"], filled["PatientID"],
                             filled["SeriesDate"], study_sfx, filled["SeriesNumber"],
                             descr, inst_sfx)
    return catalog.withColumns({
        "series_uid": uid,
        "study_sfx": study_sfx,
        "instance_sfx": inst_sfx,
        "clean_description": descr,
        "object_key": key,
    })


def build_manifest(catalog: DataFrame, mode: str = "twopass") -> DataFrame:
    """E1/E2 core (P2): ``(series_uid, object_key)`` for every catalog row."""
    return with_catalog_columns(catalog, mode).select("series_uid", "object_key")


def roi_predicate(key: T.ColumnOrName) -> Column:
    """Case-sensitive search of the whole key for an orientation marker."""
    k = T._c(key)
    cond = k.contains(SAG_MARK) | k.contains(COR_MARK)
    for m in AX_MARKS:
        cond = cond | k.contains(m)
    return cond


def select_roi(df: DataFrame, key: str = "object_key", description_only: bool = False) -> DataFrame:
    """P4 as a filter (null keys are dropped, never raised on). With
    ``description_only`` the markers are looked for in the key's description
    part (the last folder) instead of the whole key."""
    where = F.try_element_at(F.split(F.col(key), "/", -1), F.lit(-2)) if description_only else key
    return df.filter(F.coalesce(roi_predicate(where), F.lit(False)))


def other_axis_tag(key: T.ColumnOrName) -> Column:
    """The key's object tag with every character that Python's ``\\w``
    does not hold (letters and numerals of any script, ``_``) -> ``_``.
    (The landing job's later literal replace of a hyphenated collection
    prefix can never match once hyphens are gone, so it is not emulated.)"""
    return F.regexp_replace(T.object_tag(key), r"[^\p{L}\p{N}_]", "_")


def axis_of_key(key: T.ColumnOrName) -> Column:
    """P5: sag > cor > ax on the upper-cased key, else ``other_<tag>``."""
    u = F.upper(T._c(key))
    ax = u.contains(AX_MARKS[0])
    for m in AX_MARKS[1:]:
        ax = ax | u.contains(m)
    return (F.when(u.contains(SAG_MARK), F.lit(AXIS_NAMES[0]))
            .when(u.contains(COR_MARK), F.lit(AXIS_NAMES[1]))
            .when(ax, F.lit(AXIS_NAMES[2]))
            .otherwise(F.concat(F.lit("other_"), other_axis_tag(key))))


def classify_axis(df: DataFrame, key: str = "object_key", out: str = "scan_axis") -> DataFrame:
    return df.withColumn(out, axis_of_key(key))


def axis_family(axis: T.ColumnOrName) -> Column:
    """``sag``/``cor``/``ax``/``other`` (the per-series tag dropped)."""
    a = T._c(axis)
    return F.when(a.startswith("other_"), F.lit("other")).otherwise(a)


def axis_counts(manifest: DataFrame, key: str = "object_key") -> DataFrame:
    """Flagship: series per orientation family. Partial aggregation runs
    map-side, so only one row per family per task is shuffled."""
    return (manifest.select(axis_family(axis_of_key(key)).alias("axis"))
            .groupBy("axis").agg(F.count(F.lit(1)).alias("n_series")))
