"""Product metadata rows (D7): one row per (series, axis) volume with the
scanner fields, in-plane spacing as text and the array of slice links.

Metadata rows are built from per-series / per-volume header tables only;
slice pixels are never touched here (the link count comes from the slice
bounds, not from counting slice rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import links as L
from ..functions import text as T
from ..schemas import SINK_COLUMN_NAMES
from . import catalog as C

# Constants written for the open connectome subjects (P10).
SUBJECT_SERIES_DATE = "NORECORD"
SUBJECT_MANUFACTURER = "SIEMENS"
SUBJECT_MODEL = "SKYRA"

FILE_FIELDS = ["SeriesInstanceUID", "SeriesDate", "Manufacturer", "ManufacturerModelName",
               "spacing_x", "spacing_y"]


def first_file_metadata(files: DataFrame, series: str = "series_key",
                        file_name: str = "file_name") -> DataFrame:
    """S7 + L3: per series, the fields of its first file by name. ``min`` of
    a struct led by the file name is a partial aggregate (one row per series
    per task crosses the shuffle, so a series with very many files is cheap)
    and the other fields break ties, so the pick is deterministic."""
    first = F.min(F.struct(F.col(file_name).alias("_f"), *[F.col(c) for c in FILE_FIELDS]))
    return (files.groupBy(series).agg(first.alias("_m"))
            .select(series, *[F.col("_m." + c).alias(c) for c in FILE_FIELDS]))


def _printed(c: str):
    """A scanner field as the landing job prints it: a missing one is Python's
    ``None`` (the null fill is the catalog's alone)."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def series_metadata_rows(volumes: DataFrame, meta: DataFrame, bucket: str,
                         out_dir: str, series: str = "series_key") -> DataFrame:
    """D7 rows of archive series (J2 + P5 + A10): each volume of a
    series gets that series' first-file metadata (equi-join on the series
    key; AQE broadcasts the metadata side when it is small at run time).
    Scanner spacing is decimal text and stays the text it was.

    ``volumes``: ``series_key, object_key, volume_file, n_slices``.
    """
    j = volumes.join(meta, series, "inner")
    j = j.withColumns({
        "scan_axis": C.axis_of_key("object_key"),
        "_prefix": T.output_prefix(out_dir, T.object_tag("object_key")),
        "_tag": T.output_tag_from_file("volume_file"),
    })
    return j.select(
        _printed("SeriesInstanceUID").alias("series_uid"),
        _printed("SeriesDate").alias("series_date"),
        "scan_axis",
        _printed("Manufacturer").alias("manufacturer"),
        _printed("ManufacturerModelName").alias("model_name"),
        _printed("spacing_x").alias("pixel_spacing_x"),
        _printed("spacing_y").alias("pixel_spacing_y"),
        L.enumerate_links("_prefix", "_tag", "n_slices", bucket).alias("jpgfiles"),
        "object_key", "_tag",
    ).withColumnRenamed("_tag", "output_tag")


def subject_metadata_rows(headers: DataFrame, bucket: str, out_dir: str,
                          n: int = 50) -> DataFrame:
    """D7 rows of subject volumes (P10 + A3 + A11 + A10): one per subject and
    axis, from the decoded header rows alone (``subject, axis, axis_name,
    shape, pixdim_text``); link count = slices kept by the bounds rule. The
    spacing text (F16) was written where the header was read."""
    dim = F.element_at("shape", F.col("axis") + 1)
    b, e = G.central_bounds(dim, n)
    rx, ry = G.inplane_resolution("axis", "pixdim_text")
    h = headers.withColumns({"_n": F.greatest(e - b, F.lit(0)), "pixel_spacing_x": rx, "pixel_spacing_y": ry})
    s = F.col("subject")
    return h.select(
        s.cast("string").alias("series_uid"),
        F.lit(SUBJECT_SERIES_DATE).alias("series_date"),
        F.col("axis_name").alias("scan_axis"),
        F.lit(SUBJECT_MANUFACTURER).alias("manufacturer"),
        F.lit(SUBJECT_MODEL).alias("model_name"),
        "pixel_spacing_x", "pixel_spacing_y",
        L.enumerate_links(T.output_prefix(out_dir, T.subject_tag(s)),
                          T.output_tag_for_subject(s, F.col("axis_name")), "_n", bucket)
        .alias("jpgfiles"),
        T.output_tag_for_subject(s, F.col("axis_name")).alias("output_tag"),
    )


def rename_for_sink(rows: DataFrame) -> DataFrame:
    """The product columns under the names consumers expect (blanks and
    hyphens), applied at the sink only."""
    cols = ["series_uid", "series_date", "scan_axis", "manufacturer", "model_name",
            "pixel_spacing_x", "pixel_spacing_y", "jpgfiles"]
    return rows.select(*[F.col(c).alias(n) for c, n in zip(cols, SINK_COLUMN_NAMES)])
