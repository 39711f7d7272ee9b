"""Sinks (K1-K7): manifest JSON, per-axis product tables, slice tables and
cohort export manifests. Every writer publishes a directory of part files
(never "the first part file"), and the product append is idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import links as L
from ..operators.catalog import axis_family
from ..schemas import LANDED, LEDGER, PRODUCTS, PUBLISHED
from ..session import cut_lineage

PRODUCT_KEY = ("source", "series_uid", "scan_axis", "output_tag")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """K1 + K2: the manifest as JSON lines under the landing job's field
    names, mode overwrite; the whole directory is the published artefact."""
    (manifest.select(F.col("series_uid").alias("SeriesInstanceUID"),
                     F.col("object_key").alias("S3objkey"))
     .write.mode("overwrite").json(path))


# ------------------------------------------------------------- K1 / K2
def publish(rows: DataFrame, path: str) -> str:
    """K2: a new version of the dataset at ``path``, seen by readers at once or
    not at all. The rows go to a folder of their own, then a list of its part
    files with their row counts, and last one row in the table of published
    versions that points there. A run that dies before leaves what was
    published as it was. Returns the version's name."""
    spark, version = rows.sparkSession, "v-" + uuid.uuid4().hex
    rows.write.parquet(f"{path}/{version}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{version}")
    files = written.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        F.count("*").alias("rows"))
    files.write.parquet(f"{path}/parts/{version}")
    last = published(spark, path)
    number = 1 + (0 if last is None else last["number"])
    spark.read.parquet(f"{path}/parts/{version}").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(
        F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"), "files", "rows") \
        .coalesce(1).write.mode("append").parquet(f"{path}/published")
    return version


def published(spark, path: str) -> dict | None:
    """The latest published version: its number, name, files and rows."""
    rows = read_existing(spark, f"{path}/published", PUBLISHED)
    last = None if rows is None else rows.agg(F.max(F.struct(*PUBLISHED.names)).alias("m")).first()["m"]
    return None if last is None else last.asDict()


def read_published(spark, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the latest published version; an error if there is none."""
    last = published(spark, path)
    if last is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.schema(schema).parquet(f"{path}/{last['version']}")


def read_existing(spark, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none yet. Any
    other fault is raised: it must not pass for an empty table. With a declared
    ``schema`` a folder without any file is an empty table."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_products(rows: DataFrame, path: str, key=PRODUCT_KEY) -> DataFrame:
    """K3 + K4: append product rows to the table at ``path``, partitioned by
    ``source`` and ``axis_family`` (sag, cor, ax, other: one directory per axis
    table; the full axis stays a column). Rows whose natural key is already present are skipped (``left_anti``), so a re-run
    or a retried job adds nothing twice. Returns the rows that were new."""
    spark = rows.sparkSession
    # series without a uid share its fill text: their object key tells them apart
    key = [*key, *(["object_key"] if "object_key" in rows.columns and "object_key" not in key else [])]
    incoming = rows.dropDuplicates(key)
    existing = read_existing(spark, path, PRODUCTS)
    if existing is not None:
        incoming = incoming.join(existing.select(*key).distinct(), key, "left_anti")
    # materialise the new rows first: the anti join reads the table we append to
    incoming = cut_lineage(incoming)
    if incoming.isEmpty():
        return incoming
    incoming.withColumn("axis_family", axis_family("scan_axis")) \
        .write.mode("append").partitionBy("source", "axis_family").parquet(path)
    return incoming


# ------------------------------------------------------------- K5 / J4
def append_slices(decoded: DataFrame, path: str, run: str) -> None:
    """K5: append decoded rows (slices and one header row per volume) with each
    slice's target object key, partitioned by source, run and axis. The rows of
    a run count once the run is in the ledger (``commit_run``)."""
    key = L.slice_object_key("output_prefix", "output_tag", "slice_no")
    (decoded.withColumn("target_key", F.when(F.col("slice_no").isNotNull(), key))
     .withColumn("run", F.lit(run))
     .write.mode("append").partitionBy("source", "run", "axis").parquet(path))


def ledger_path(slices_path: str) -> str:
    return slices_path.rstrip("/") + "_ledger"


def commit_run(todo: DataFrame, slices_path: str, source: str, run: str) -> None:
    """Add the run's attempts to the ledger: a row per volume of ``todo``
    (``volume_file, object_key, attempt, length, modified``) out of its header
    row. Written after the slices, in one go: a run that died before has no row
    there, so its slices do not count and its volumes are tried again."""
    heads = read_existing(todo.sparkSession, slices_path, LANDED).filter(
        (F.col("source") == source) & (F.col("run") == run) & F.col("axis").isNull()).select(
        F.col("volume_id").alias("volume_file"), "object_key", "status", "message", "shape", "pixdim", "pixdim_text", "subject")
    rows = todo.select("volume_file", "object_key", "attempt", "length", "modified").join(
        heads, ["volume_file", "object_key"]).withColumns({"run": F.lit(run), "source": F.lit(source)})
    rows.select(*LEDGER.names).write.mode("append").partitionBy("source").parquet(ledger_path(slices_path))


def attempts(spark, slices_path: str, source: str) -> DataFrame:
    """Every volume's latest attempt (a pre-aggregated maximum): ``volume_file,
    object_key`` and the ledger's other columns."""
    rows = read_existing(spark, ledger_path(slices_path), LEDGER)
    rows = spark.createDataFrame([], LEDGER) if rows is None else rows
    others = [c for c in LEDGER.names if c not in ("volume_file", "object_key", "source")]
    return rows.filter(F.col("source") == source).groupBy("volume_file", "object_key").agg(
        F.max(F.struct(*others)).alias("m")).select("volume_file", "object_key", "m.*")


def landed_slices(spark, slices_path: str) -> DataFrame:
    """The slices that count: of runs in the ledger. The runs are few and
    prune the slice table's folders; no pixels are shuffled."""
    runs = read_existing(spark, ledger_path(slices_path), LEDGER)
    rows = read_existing(spark, slices_path, LANDED)
    if runs is None or rows is None:
        return spark.createDataFrame([], LANDED)
    return rows.filter("axis is not null").join(runs.select("source", "run").distinct(), ["source", "run"], "left_semi")


def write_stores(stores: DataFrame, images: DataFrame, path: str) -> None:
    """The store and image-set tables after changes, in a folder of their
    own: the ones they were computed from stay readable."""
    stores.write.mode("errorifexists").parquet(f"{path}/stores")
    images.write.mode("errorifexists").parquet(f"{path}/images")


def write_export(export_rows: DataFrame, path: str) -> None:
    """K7: the export manifest of cohort bundles, one folder per bundle."""
    export_rows.write.mode("overwrite").partitionBy("name").parquet(path)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict) -> None:
    """K3 towards a database table (optional; needs the driver's JDBC jar).
    The product columns are renamed for the sink (P12) and appended."""
    from ..operators.metadata import rename_for_sink
    rename_for_sink(rows).write.jdbc(url=url, table=table, mode="append", properties=properties)
