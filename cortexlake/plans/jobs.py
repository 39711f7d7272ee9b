"""Whole-job functions (E1-E8): the landing, volume and cohort jobs as one
distributed Spark job per dataset instead of one application per object."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C


def axis_fanout(subjects: DataFrame, out_dir: str, subject: str = "subject") -> DataFrame:
    """Each subject volume x the three axes (sag, cor, ax = 0, 1, 2),
    with the keys and tags of the subject path. A narrow ``explode`` of a
    literal array: no join, no shuffle; the volume is decoded once."""
    axes = F.array(*[F.struct(F.lit(i).alias("axis"), F.lit(n).alias("axis_name"))
                     for i, n in enumerate(C.AXIS_NAMES)])
    s = F.col(subject)
    return subjects.select("*", F.inline(axes)).withColumns({
        "volume_key": T.volume_key_from_subject(s),
        "object_tag": T.subject_tag(s),
        "output_prefix": T.output_prefix(out_dir, T.subject_tag(s)),
        "output_tag": T.output_tag_for_subject(s, F.col("axis_name")),
    })


# ------------------------------------------------------------ E1 / E2
def manifest_job(spark, catalog_path: str, out_path: str, mode: str = "twopass") -> DataFrame:
    """E1 (two-pass) / E2 (one-pass keys): catalog JSON -> manifest JSON."""
    from ..sinks.writers import write_manifest
    from ..sources.catalog import read_series_catalog
    m = C.build_manifest(read_series_catalog(spark, catalog_path), mode)
    write_manifest(m, out_path)
    return m


def publish_manifest_job(spark, catalog_path: str, path: str, mode: str = "twopass") -> str:
    """E1 / E2 with the manifest published as a new version at ``path`` (K2):
    readers follow ``read_published``, a run that dies changes nothing."""
    from ..sinks.writers import publish
    from ..sources.catalog import read_series_catalog
    return publish(C.build_manifest(read_series_catalog(spark, catalog_path), mode), path)


# ------------------------------------------------------------------ E3
def _listed(files: DataFrame) -> DataFrame:
    """The listing's columns; of rows that bring their bytes, what is known."""
    absent = [F.lit(None).cast(kind).alias(c) for c, kind in (
        ("path", "string"), ("length", "long"), ("modified", "timestamp")) if c not in files.columns]
    return files.select("*", *absent)


def series_volumes(manifest: DataFrame, files: DataFrame, out_dir: str) -> DataFrame:
    """Volume files of the selected series (P4) with the keys their slices
    land under. Works on the listing alone: no bytes are read or moved."""
    roi = C.select_roi(manifest).select("object_key").distinct()
    return _listed(files).select("object_key", "volume_file", "path", "length", "modified") \
        .join(roi, "object_key").dropDuplicates(["object_key", "volume_file"]).withColumns({
            "output_prefix": T.output_prefix(out_dir, T.object_tag("object_key")),
            "output_tag": T.output_tag_from_file("volume_file")})


def subject_volumes(subjects: DataFrame, files: DataFrame, out_dir: str) -> DataFrame:
    """J3 of the subject path: volume files whose key (F7) is a subject's."""
    s = subjects.select(F.col("subject").cast("string").alias("subject"),
                        T.volume_key_from_subject("subject").alias("object_key")).distinct()
    key = F.regexp_extract("volume_file", r"(HCP_1200/.*)$", 1)
    return _listed(files).select("volume_file", "path", "length", "modified", key.alias("object_key")) \
        .join(s, "object_key").dropDuplicates(["object_key", "volume_file"]) \
        .withColumn("output_prefix", T.output_prefix(out_dir, T.subject_tag("subject")))


def _pending(volumes: DataFrame, slices_path: str, source: str) -> DataFrame:
    """The volumes that are still to be read (J4), with the number of this
    attempt: those without one in the ledger, and those whose latest attempt
    failed (a mended file, or a store that was out of reach). A volume that is
    landed or skipped stays as it is. Cut off from the tables written next."""
    from ..session import cut_lineage
    from ..sinks.writers import attempts
    last = attempts(volumes.sparkSession, slices_path, source).select(
        "volume_file", "object_key", F.col("attempt").alias("_last"), F.col("status").alias("_status"))
    return cut_lineage(volumes.join(last, ["volume_file", "object_key"], "left")
                       .filter(F.col("_status").isNull() | (F.col("_status") == "error"))
                       .withColumn("attempt", (F.coalesce("_last", F.lit(0)) + 1).cast("int"))
                       .drop("_last", "_status"))


def _decoded(todo: DataFrame, files: DataFrame, carry: tuple[str, ...], **how) -> DataFrame:
    """Decode ``todo``: files of a listing are opened by the tasks that decode
    them; only rows that bring their bytes meet their keys by a join."""
    from ..sources.volumes import decode_volumes, packed
    if "content" not in files.columns:
        return decode_volumes(packed(todo), id_col="volume_file", path_col="path", carry=carry, **how)
    keys = [c for c in ("object_key", "volume_file") if c in files.columns]
    return decode_volumes(files.select(*keys, "content").join(todo, keys), id_col="volume_file", carry=carry, **how)


def _land(todo: DataFrame, decoded, slices_path: str, source: str) -> None:
    """Slices, then the ledger's rows of the run. Nothing to do writes nothing."""
    from ..sinks.writers import append_slices, commit_run
    if todo.isEmpty():
        return
    run = "run-" + uuid.uuid4().hex
    append_slices(decoded().withColumn("source", F.lit(source)), slices_path, run)
    commit_run(todo, slices_path, source, run)


def _sound(spark, slices_path: str, source: str) -> DataFrame:
    from ..sinks.writers import attempts
    return attempts(spark, slices_path, source).filter("status = 'ok'")


def process_series(manifest: DataFrame, volume_files: DataFrame, file_meta: DataFrame,
                   slices_path: str, products_path: str, out_dir: str,
                   bucket: str, source: str = "tcia") -> DataFrame:
    """E3 for all series at once: ROI filter (P4) -> keys of the listed volume
    files (J3) -> those not landed yet (J4) -> decode, thinnest-axis slices,
    per-stack normalisation (S4/A5/A6/A7) -> append to the slice table (K5)
    and the ledger -> product rows with first-file metadata (S7/J2/D7) ->
    idempotent append (K3).

    ``volume_files``: ``object_key, volume_file`` with ``path, length,
    modified`` of a listing (or, for files that are rows already, ``content``);
    ``file_meta``: per-file scanner fields keyed by ``series_key``.
    Keys are resolved on the listing and travel with the paths through the
    decoder: no bytes of files and no pixels are shuffled or joined. Slices are
    committed before metadata rows, so no row links to slices that were never
    written. A file that cannot be read is an ``error`` in the ledger, stops
    nothing and is tried again in the next run."""
    from ..operators.metadata import first_file_metadata, series_metadata_rows
    from ..sinks.writers import append_products
    todo = _pending(series_volumes(manifest, volume_files, out_dir), slices_path, source)
    _land(todo, lambda: _decoded(todo, volume_files, ("object_key", "output_prefix", "output_tag"),
                                 mode="thinnest", normalise=True), slices_path, source)
    series = C.select_roi(manifest).select(F.col("series_uid").alias("series_key"), "object_key")
    vols = _sound(manifest.sparkSession, slices_path, source).select(
        "object_key", "volume_file",
        F.element_at("shape", (F.array_position("shape", F.array_min("shape"))).cast("int"))
        .alias("n_slices")).join(series, "object_key")
    rows = series_metadata_rows(vols, first_file_metadata(file_meta), bucket, out_dir)
    return append_products(rows.withColumn("source", F.lit(source)), products_path)


# ------------------------------------------------------------------ E4
def process_subjects(subjects: DataFrame, volume_files: DataFrame, slices_path: str,
                     products_path: str, out_dir: str, bucket: str, n: int = 50,
                     source: str = "hcp") -> DataFrame:
    """E4 for all subjects at once: subject -> volume key (F7) -> its file in
    the listing, if not landed yet -> one decode per volume giving the ``n``
    central slices of all three axes (A2/A11/A7) -> append to the slice table
    and the ledger -> per-axis product rows (P10/A3) -> idempotent append.
    ``volume_files`` as in ``process_series``, without ``object_key``."""
    from ..operators.metadata import subject_metadata_rows
    from ..sinks.writers import append_products
    todo = _pending(subject_volumes(subjects, volume_files, out_dir), slices_path, source)
    names = F.element_at(F.array(*[F.lit(a) for a in C.AXIS_NAMES]), F.col("axis") + 1)
    _land(todo, lambda: _decoded(todo, volume_files, ("subject", "object_key", "output_prefix"), mode="central",
                                 n=n, axes=(0, 1, 2), rot=0, normalise=True).withColumn(
        "output_tag", F.when(F.col("axis").isNotNull(), T.output_tag_for_subject("subject", names))),
        slices_path, source)
    headers = _sound(subjects.sparkSession, slices_path, source)
    fan = axis_fanout(headers.select("subject", "shape", "pixdim_text"), out_dir)
    rows = subject_metadata_rows(fan, bucket, out_dir, n)
    return append_products(rows.withColumn("source", F.lit(source)), products_path)


def volume_outcomes(wanted: DataFrame, slices_path: str, source: str) -> DataFrame:
    """What became of every wanted object at its latest attempt:
    ``object_key, outcome, message`` with outcome ``ok``, ``skipped``, ``error``
    or ``no file``. ``wanted`` has ``object_key``."""
    from ..sinks.writers import attempts
    return object_outcomes(wanted, attempts(wanted.sparkSession, slices_path, source))


def object_outcomes(wanted: DataFrame, headers: DataFrame, described: DataFrame | None = None,
                    keys: tuple[str, ...] = ("object_key",)) -> DataFrame:
    """The same from header rows (``keys, status, message``). With ``described``
    (column ``series_uid``: the series that have scanner metadata) ``wanted``
    has ``series_uid`` too, and a decoded object without it is ``no metadata``."""
    names = [*keys, *(["series_uid"] if described is not None and "series_uid" not in keys else [])]
    out = wanted.select(*names).distinct().join(
        headers.select(*keys, "status", "message"), list(keys), "left")
    outcome = F.coalesce("status", F.lit("no file"))
    if described is not None:
        out = out.join(described.select("series_uid", F.lit(True).alias("_has")).distinct(),
                       "series_uid", "left")
        outcome = F.when((outcome == "ok") & F.col("_has").isNull(), F.lit("no metadata")).otherwise(outcome)
    return out.select(*names, outcome.alias("outcome"), "message")


# ------------------------------------------------------------ E5 - E8
def export_cohort_job(images: DataFrame, name: str, out_path: str, bucket: str) -> DataFrame:
    """E5: ``GET /Images/<name>`` as a job: the export manifest of that
    cohort's bundle (P8 -> A12 -> F12 -> K7)."""
    from ..operators.cohorts import export_manifest
    from ..sinks.writers import write_export
    rows = export_manifest(images, name, bucket)
    write_export(rows, out_path)
    return rows


def image_list_job(images: DataFrame, bucket: str) -> DataFrame:
    """``GET /ImageList`` records."""
    from ..operators.cohorts import image_list_json
    return image_list_json(images, bucket)


def store_job(stores: DataFrame, images: DataFrame, bucket: str,
              name: str | None = None) -> DataFrame:
    """``GET /Store/<name>`` (first store of that name) or ``GET /Stores``."""
    from ..operators.cohorts import first_by_name, stores_json
    s = stores if name is None else first_by_name(stores, name)
    return stores_json(s, images, bucket)


def land_store_changes(stores: DataFrame, images: DataFrame, inserts: DataFrame,
                       deletes: DataFrame, path: str) -> None:
    """E8 with its result landed as a new version of both tables at ``path``."""
    from ..operators.cohorts import stores_after_changes
    from ..sinks.writers import write_stores
    write_stores(*stores_after_changes(stores, images, inserts, deletes), path)


def replay_store_requests(stores: DataFrame, images: DataFrame, requests: DataFrame, path: str) -> None:
    """E8 for a log of requests in order, its result landed at ``path``: the
    snapshot that later requests start from."""
    from ..operators.cohorts import stores_replayed
    from ..sinks.writers import write_stores
    write_stores(*stores_replayed(stores, images, requests), path)


def store_changes_job(stores: DataFrame, images: DataFrame, inserts: DataFrame | None = None,
                      deletes: DataFrame | None = None):
    """``POST``/``DELETE /Store/<name>`` for batches of names. Returns
    (insert outcome, stores after deletes, images after deletes)."""
    from ..operators.cohorts import delete_by_name, insert_if_absent
    ins = insert_if_absent(stores, inserts) if inserts is not None else None
    kept, imgs = (delete_by_name(stores, images, deletes) if deletes is not None
                  else (stores, images))
    return ins, kept, imgs
