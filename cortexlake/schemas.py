"""Explicit schemas for every table the jobs read or write (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# D1 series catalog: the archive's series listing. Every field is read as text
# so that a null never turns a whole derived key into NULL.
CATALOG_FIELDS = [
    "Collection", "PatientID", "SeriesDate", "SeriesNumber",
    "SeriesDescription", "StudyInstanceUID", "SeriesInstanceUID",
]
SERIES_CATALOG = T.StructType([T.StructField(f, S, True) for f in CATALOG_FIELDS])

# D2 object-key manifest as landed on disk (field names of the landing job)
MANIFEST_FILE = T.StructType([
    T.StructField("SeriesInstanceUID", S, True),
    T.StructField("S3objkey", S, True),
])
# ... and as used inside the library
MANIFEST = T.StructType([
    T.StructField("series_uid", S, True),
    T.StructField("object_key", S, True),
])

# D6 slice table: one row per 2-D slice, pixels row-major
SLICES = T.StructType([
    T.StructField("volume_id", S, False),
    T.StructField("axis", T.IntegerType(), False),
    T.StructField("slice_no", T.IntegerType(), False),
    T.StructField("height", T.IntegerType(), False),
    T.StructField("width", T.IntegerType(), False),
    T.StructField("pixels", T.ArrayType(T.DoubleType(), False), False),
])

# D5 per-volume header row written next to the slices
VOLUME_HEADERS = T.StructType([
    T.StructField("volume_id", S, False),
    T.StructField("shape", T.ArrayType(T.IntegerType(), False), True),
    T.StructField("pixdim", T.ArrayType(T.FloatType(), False), True),
    T.StructField("status", S, False),
    T.StructField("message", S, True),
])

# S5 archive members
ARCHIVE_MEMBERS = T.StructType([
    T.StructField("object_key", S, False),
    T.StructField("member", S, True),
    T.StructField("content", T.BinaryType(), True),
    T.StructField("status", S, False),
])

# D7 product row; D8 routes it by axis. Internal (snake_case) names; the
# names with blanks and hyphens are applied at the sink only.
SERIES_METADATA = T.StructType([
    T.StructField("series_uid", S, True),
    T.StructField("series_date", S, True),
    T.StructField("scan_axis", S, True),
    T.StructField("manufacturer", S, True),
    T.StructField("model_name", S, True),
    T.StructField("pixel_spacing_x", S, True),
    T.StructField("pixel_spacing_y", S, True),
    T.StructField("jpgfiles", T.ArrayType(S, True), True),
])

# ... and as stored: the keys of its volume, and the folders it lies in
PRODUCTS = T.StructType(SERIES_METADATA.fields + [T.StructField(c, S, True) for c in (
    "object_key", "output_tag", "source", "axis_family")])

# K5 slice table as stored: decoded rows with the keys of their volume, the
# slice's target key, and the folders; D5 header rows have no axis
LANDED = T.StructType([
    T.StructField("volume_id", S, True), T.StructField("slice_no", T.IntegerType(), True),
    T.StructField("height", T.IntegerType(), True), T.StructField("width", T.IntegerType(), True),
    T.StructField("dim", T.IntegerType(), True), T.StructField("pixels", T.ArrayType(T.DoubleType()), True),
    T.StructField("shape", T.ArrayType(T.IntegerType()), True),
    T.StructField("pixdim", T.ArrayType(T.FloatType()), True),
    T.StructField("pixdim_text", T.ArrayType(S), True),
    T.StructField("status", S, True), T.StructField("message", S, True),
    T.StructField("subject", S, True), T.StructField("object_key", S, True),
    T.StructField("output_prefix", S, True), T.StructField("output_tag", S, True),
    T.StructField("target_key", S, True),
    T.StructField("source", S, True), T.StructField("run", S, True), T.StructField("axis", T.IntegerType(), True),
])

# K2 table of published versions
PUBLISHED = T.StructType([
    T.StructField("number", T.LongType(), True), T.StructField("version", S, True),
    T.StructField("files", T.LongType(), True), T.StructField("rows", T.LongType(), True),
])

# J4 ledger: one row per attempt at a volume
LEDGER = T.StructType([
    T.StructField("volume_file", S, True), T.StructField("object_key", S, True),
    T.StructField("attempt", T.IntegerType(), True), T.StructField("run", S, True),
    T.StructField("length", T.LongType(), True), T.StructField("modified", T.TimestampType(), True),
    T.StructField("status", S, True), T.StructField("message", S, True),
    T.StructField("shape", T.ArrayType(T.IntegerType()), True),
    T.StructField("pixdim", T.ArrayType(T.FloatType()), True),
    T.StructField("pixdim_text", T.ArrayType(S), True),
    T.StructField("subject", S, True), T.StructField("source", S, True),
])

# The product table's column names as the archive's consumers
# expect them (P12), in the order of SERIES_METADATA.
SINK_COLUMN_NAMES = [
    "series instance uid", "series date", "scan axis", "manufacturer",
    "manufacturer model name", "pixel spacing-x", "pixel spacing-y", "jpgfiles",
]

# D9 image set (cohort) and D10 store
IMAGE_SET = T.StructType([
    T.StructField("uid", T.LongType(), False),
    T.StructField("name", S, True),
    T.StructField("images", T.ArrayType(S, True), True),
    T.StructField("store_id", T.IntegerType(), True),
])
STORE = T.StructType([
    T.StructField("uid", T.LongType(), False),
    T.StructField("name", S, True),
])
