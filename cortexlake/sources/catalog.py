"""The series catalog, the object-key manifest and the subject list.

All three are read with declared schemas (no inference pass over the data)
and stay distributed: nothing is collected to the driver.
"""

from __future__ import annotations

import json
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MANIFEST_FILE, SERIES_CATALOG
from ..session import cut_lineage


def read_series_catalog(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The archive's series listing (a JSON array of objects, or JSON
    lines with ``multiline=False``); every field read as text."""
    return spark.read.schema(SERIES_CATALOG).option("multiLine", multiline).json(path)


def _cut_records(text: str, begun: bool) -> tuple[list[str], int]:
    """The whole JSON objects at the start of ``text`` (between commas, blanks
    and brackets of the array) and where they end. If not ``begun`` a filled
    object must stand at the very start: text out of the middle of a record
    cannot look like one, as quotes inside a string are escaped."""
    found, at, read = [], 0, json.JSONDecoder().raw_decode
    while True:
        start = at
        while start < len(text) and text[start] in " \t\r\n,[]}\ufeff":
            start += 1
        if start == len(text):
            return found, start if begun or found else at
        try:
            value, end = read(text, start)
        except ValueError:
            return found, at
        if not isinstance(value, dict) or not (begun or found or value):
            return found, at
        found.append(text[start:end])
        at = end


def _cut_split(pieces, begun: bool):
    """Records of one split's pieces; then its head (what belongs to a record
    that the split before began) and its tail (a record that goes on)."""
    head, held = [], ""
    for piece in pieces:
        text = piece + "},"
        if not begun:
            found, end = _cut_records(text, False)
            if not found:
                head.append(text)
                continue
            begun = True
        else:
            text = held + text
            found, end = _cut_records(text, True)
        yield from ((record, None, None) for record in found)
        held = text[end:]
    yield None, "".join(head), held


def read_large_catalog(spark: SparkSession, path: str) -> DataFrame:
    """S1 of catalogs whose array is one very large file, on one line or many:
    the same rows as ``read_series_catalog`` in as many tasks as the file has
    splits. Lines end at ``},``; a task puts records together that hold one
    themselves (in a text, or after an inner object), and the two ends of each
    split, a record at most as a rule, meet those of the splits next to it."""
    lines = spark.read.option("lineSep", "},").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def cut(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for (file, start), group in groupby(rows(), lambda r: r[1:]):
            held = []
            for record, head, tail in _cut_split((r[0] for r in group), start == 0):
                held.append((record, file, start, head, tail))
                if len(held) >= 1000:
                    yield batch_of(held)
                    held = []
            yield batch_of(held)

    def batch_of(rows):
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          ["record", "file", "start", "head", "tail"])

    def joined(_file, ends):
        text = "".join(h + t for h, t in ends.sort_values("start")[["head", "tail"]].itertuples(index=False))
        return pd.DataFrame({"record": _cut_records(text, True)[0]}, dtype=object)

    found = cut_lineage(lines.mapInArrow(cut, "record string, file string, start long, head string, tail string"))
    ends = found.filter("record is null").groupBy("file").applyInPandas(joined, "record string")
    return found.filter("record is not null").select("record").unionByName(ends).select(
        F.from_json("record", SERIES_CATALOG).alias("r")).select("r.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The landed manifest (JSON lines), renamed to library names."""
    return (spark.read.schema(MANIFEST_FILE).json(path)
            .select(F.col("SeriesInstanceUID").alias("series_uid"),
                    F.col("S3objkey").alias("object_key")))


def read_subject_list(spark: SparkSession, path: str) -> DataFrame:
    """S3: one subject number per line; surrounding blanks and leading zeros
    are dropped (``int(line)``); blank lines are skipped."""
    t = spark.read.text(path).select(F.trim("value").alias("v")).filter(F.col("v") != "")
    return t.select(F.col("v").cast("long").alias("subject"))
