"""Incremental landing with Structured Streaming.

The original runners walk a manifest and submit one application per object,
pacing themselves with sleeps and restarting from hand-edited index cut-offs.
Here the same work runs as file streams: new catalog files or new volume
files are picked up as they land, ``maxFilesPerTrigger`` bounds the work of
each micro-batch (the pacing), and the stream checkpoint records what was
done (the resume point). Each micro-batch goes through the same batch
functions, and their sinks skip rows already present, so a replayed batch
adds nothing twice. The stream checkpoint is a folder that the caller names
and keeps: it must be the same one when the stream is started again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import catalog as C
from ..schemas import SERIES_CATALOG
from ..sinks.writers import read_existing


# the fixed row layout of Spark's whole-file source (streams need it declared)
FILE_ROWS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def append_manifest_batch(batch: DataFrame, path: str, mode: str = "twopass") -> None:
    """One micro-batch of catalog rows -> manifest rows not yet in ``path``.
    Series without a uid share its fill text, so the object key is part of the
    natural key."""
    key = ["series_uid", "object_key"]
    m = C.build_manifest(batch, mode).dropDuplicates(key)
    have = read_existing(batch.sparkSession, path)
    if have is not None:
        m = m.join(have.select(*key), key, "left_anti")
    m.write.mode("append").parquet(path)


def manifest_stream(spark: SparkSession, catalog_dir: str, manifest_path: str,
                    checkpoint: str, files_per_trigger: int = 100,
                    mode: str = "twopass", available_now: bool = True) -> StreamingQuery:
    """E1 as a stream over a folder of catalog files (JSON arrays)."""
    src = (spark.readStream.schema(SERIES_CATALOG).option("multiLine", True)
           .option("maxFilesPerTrigger", files_per_trigger).json(catalog_dir))
    w = (src.writeStream.foreachBatch(lambda df, _id: append_manifest_batch(df, manifest_path, mode))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def subject_volume_stream(spark: SparkSession, volume_dir: str, subjects: DataFrame,
                          slices_path: str, products_path: str, out_dir: str, bucket: str,
                          checkpoint: str, n: int = 50,
                          files_per_trigger: int = 20, available_now: bool = True) -> StreamingQuery:
    """E4 as a stream: each micro-batch of newly listed volume files is
    decoded (a task opens its own files) and appended (slices, ledger, then
    product rows). A file that cannot be read is tried again when it is listed
    again, or by ``process_subjects`` over the folder."""
    from ..plans.jobs import process_subjects
    src = (spark.readStream.format("binaryFile").schema(FILE_ROWS)
           .option("pathGlobFilter", "*.nii.gz")
           .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger)
           .load(volume_dir).select(F.col("path").alias("volume_file"), "path", "length",
                                    F.col("modificationTime").alias("modified")))

    def run(batch: DataFrame, batch_id: int) -> None:
        # volumes and product rows that are landed already are left out, so a
        # replayed batch, or another stream over the same files, adds nothing
        process_subjects(subjects, batch, slices_path, products_path, out_dir, bucket, n)
    w = (src.writeStream.foreachBatch(run)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
