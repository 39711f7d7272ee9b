"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's tables (via fixtures).

Outputs are flat and explicitly typed so that they compare cell by cell with
the DuckDB oracle; array results are also given as joined text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import links as L
from ..functions import text as T
from ..operators import catalog as C
from ..operators import cohorts as K
from ..operators import metadata as M
from ..operators import slices as S
from ..plans import jobs as J
from ..sources import archives as A
from ..sources import volumes as V
from ..schemas import PRODUCTS
from ..session import cut_lineage, read_table, scratch_path, written
from ..sinks.writers import landed_slices, publish, read_published

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Output folders and the archive download endpoint used as
# parameters by the per-series jobs.
TCIA_OUT_DIR = "data/TCIA_output_v2"
HCP_OUT_DIR = "data/HCP_output_v1"
DOWNLOAD_BASE = "https://services.cancerimagingarchive.net/services/v4/TCIA/query/getImage?SeriesInstanceUID="


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _catalog(spark, sf_dir, mode="twopass"):
    return C.with_catalog_columns(fx.series_catalog(spark, sf_dir), mode)


# ----------------------------------------------------------------- catalog
@query("null_fill")
def q_null_fill(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.null_fill("Collection").alias("collection"),
                      T.null_fill("SeriesNumber").alias("series_number"),
                      T.null_fill("SeriesDescription").alias("series_description"))


@query("clean_description_twopass")
def q_clean_twopass(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.clean_description("SeriesDescription", "twopass").alias("clean_description"))


@query("clean_description_onepass")
def q_clean_onepass(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.clean_description("SeriesDescription", "onepass").alias("clean_description"))


@query("uid_suffix_fixed")
def q_uid_suffix_fixed(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.uid_suffix_fixed("StudyInstanceUID").alias("study_sfx"),
                      T.uid_suffix_fixed("SeriesInstanceUID").alias("instance_sfx"))


@query("uid_suffix_last5")
def q_uid_suffix_last5(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.uid_suffix_last5("StudyInstanceUID").alias("study_sfx"),
                      T.uid_suffix_last5("SeriesInstanceUID").alias("instance_sfx"))


@query("object_key")
def q_object_key(spark, sf_dir):
    return C.build_manifest(fx.series_catalog(spark, sf_dir), "twopass")


@query("published_manifest")
def q_published_manifest(spark, sf_dir):
    """K1, K2: the manifest as readers find it once it is published."""
    rows, path = C.build_manifest(fx.series_catalog(spark, sf_dir)), scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    publish(rows.limit(0), path)
    publish(rows, path)
    return read_published(spark, path, rows.schema)


@query("object_key_onepass")
def q_object_key_onepass(spark, sf_dir):
    return C.build_manifest(fx.series_catalog(spark, sf_dir), "onepass")


@query("select_roi")
def q_select_roi(spark, sf_dir):
    return C.select_roi(C.build_manifest(fx.series_catalog(spark, sf_dir)))


@query("select_roi_description")
def q_select_roi_description(spark, sf_dir):
    return C.select_roi(C.build_manifest(fx.series_catalog(spark, sf_dir)), description_only=True)


@query("classify_axis")
def q_classify_axis(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return C.classify_axis(m).select("series_uid", "scan_axis")


@query("axis_counts")
def q_axis_counts(spark, sf_dir):
    return C.axis_counts(C.build_manifest(fx.series_catalog(spark, sf_dir)))


@query("object_tag")
def q_object_tag(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return m.select("series_uid", T.object_tag("object_key").alias("object_tag"))


@query("output_prefix")
def q_output_prefix(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return m.select("series_uid",
                    T.output_prefix(TCIA_OUT_DIR, T.object_tag("object_key")).alias("output_prefix"))


@query("job_tag")
def q_job_tag(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return m.select("series_uid", T.job_tag("object_key").alias("job_tag"))


@query("source_request_url")
def q_source_request_url(spark, sf_dir):
    cat = fx.series_catalog(spark, sf_dir)
    return cat.select(F.col("SeriesInstanceUID").alias("series_uid"),
                      T.source_request_url("SeriesInstanceUID", DOWNLOAD_BASE).alias("request_url"))


@query("output_tag")
def q_output_tag(spark, sf_dir):
    # volume files are named <patient>_3T_<description>.nii.gz by the converter
    cat = _catalog(spark, sf_dir)
    path = F.concat(F.lit("/work/"), T.object_tag("object_key"), F.lit("/"),
                    F.col("PatientID"), F.lit("_3T_"),
                    F.coalesce(F.col("SeriesDescription"), F.lit("")), F.lit(".nii.gz"))
    return cat.select("series_uid", T.output_tag_from_file(path).alias("output_tag"))


@query("volume_key_from_subject")
def q_volume_key(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    s = F.col("c_custkey")
    return c.select(s.alias("subject"),
                    T.volume_key_from_subject(s).alias("volume_key"),
                    T.subject_tag(s).alias("object_tag"),
                    T.output_tag_for_subject(s, F.lit("cor")).alias("output_tag"))


# ------------------------------------------------------------------- links
@query("url_quote")
def q_url_quote(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", L.url_quote("url").alias("quoted"))


@query("url_quote_keys")
def q_url_quote_keys(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return m.select("series_uid", L.url_quote("object_key").alias("quoted"))


@query("url_unquote")
def q_url_unquote(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", L.url_unquote(L.url_quote("url")).alias("round_trip"),
                    L.url_unquote("url").alias("unquoted"))


@query("public_url")
def q_public_url(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    return m.select("series_uid",
                    L.public_url("object_key").alias("landing_url"),
                    L.public_url(F.concat(F.lit("/"), "object_key"), quote=False, slash=False)
                    .alias("api_url"))


@query("enumerate_links")
def q_enumerate_links(spark, sf_dir):
    cat = _catalog(spark, sf_dir)
    links = L.enumerate_links(T.output_prefix(TCIA_OUT_DIR, T.object_tag("object_key")),
                              F.col("clean_description"), F.col("n_slices"))
    return cat.select("series_uid", F.col("n_slices"),
                      F.size(links).cast("int").alias("n_links"),
                      F.array_join(links, "|").alias("links"))


# ------------------------------------------------------------------ slices
def _pixels_long(df: DataFrame, keys, col: str = "pixels") -> DataFrame:
    """One row per pixel (position, value) for cell-by-cell comparison."""
    return df.select(*keys, F.posexplode(col).alias("pixel", "value")) \
             .withColumn("pixel", F.col("pixel").cast("int"))


@query("slice_central")
def q_slice_central(spark, sf_dir):
    st = fx.slice_stack(spark, sf_dir)
    return S.slice_central(st, 50).select("volume_id", "slice_no", "dim")


@query("slice_range")
def q_slice_range(spark, sf_dir):
    st = fx.slice_stack(spark, sf_dir)
    return S.slice_range(st, 5, -5).select("volume_id", "slice_no", "dim")


for _a, _name in enumerate(C.AXIS_NAMES):
    def _mk(a):
        def q(spark, sf_dir):
            sl = S.slice_all(fx.volumes3d(spark, sf_dir), axis=a)
            return _pixels_long(sl, ["volume_id", "axis", "slice_no"])
        return q
    QUERIES[f"slice_all_{_name}"] = _mk(_a)


@query("slice_all_thinnest")
def q_slice_all_thinnest(spark, sf_dir):
    sl = S.slice_all(fx.volumes3d(spark, sf_dir))
    return _pixels_long(sl, ["volume_id", "axis", "slice_no"])


for _k in (1, 2, 3):
    def _mk_rot(k):
        def q(spark, sf_dir):
            sl = S.slice_all(fx.volumes3d(spark, sf_dir), axis=2)
            r = S.rotate(sl, k)
            return _pixels_long(r, ["volume_id", "slice_no", "height", "width"])
        return q
    QUERIES[f"rot90_{_k}"] = _mk_rot(_k)


@query("detect_slice_axis")
def q_detect_slice_axis(spark, sf_dir):
    v = S.skip_non_3d(fx.volume_shapes(spark, sf_dir))
    return S.with_slice_axis(v).select("volume_id", "slice_axis")


@query("skip_non_3d")
def q_skip_non_3d(spark, sf_dir):
    v = S.skip_non_3d(fx.volume_shapes(spark, sf_dir))
    return v.select("volume_id", F.size("shape").cast("int").alias("n_dims"))


@query("inplane_resolution")
def q_inplane_resolution(spark, sf_dir):
    v = S.with_slice_axis(S.skip_non_3d(fx.volume_shapes(spark, sf_dir)))
    r = S.with_inplane_resolution(v, "slice_axis", "pixdim")
    return r.select("volume_id", "slice_axis", F.col("res_x").cast("double").alias("res_x"),
                    F.col("res_y").cast("double").alias("res_y"))


@query("minmax_normalise")
def q_minmax_normalise(spark, sf_dir):
    st = S.slice_central(fx.slices_table(spark, sf_dir), 50)
    nm = S.minmax_normalise(st)
    return _pixels_long(nm, ["volume_id", "slice_no"])


@query("minmax_normalise_stored")
def q_minmax_normalise_stored(spark, sf_dir):
    table = f"stacks_{uuid.uuid4().hex}"
    S.write_stacks(S.slice_central(fx.slices_table(spark, sf_dir), 50), table, 8)
    return _pixels_long(S.minmax_normalise_stored(spark.table(table)), ["volume_id", "slice_no"])


@query("scale_range_check")
def q_scale_range_check(spark, sf_dir):
    st = S.slice_central(fx.slices_table(spark, sf_dir), 50)
    return S.scale_range(S.minmax_normalise(st)).select(
        "volume_id", "scale_min", "scale_max", "in_unit_range")


@query("display_scale")
def q_display_scale(spark, sf_dir):
    ds = S.display_scale(fx.slices_table(spark, sf_dir))
    return _pixels_long(ds, ["volume_id", "slice_no"], "grey")


@query("axis_fanout")
def q_axis_fanout(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject"))
    return J.axis_fanout(c, HCP_OUT_DIR).select(
        "subject", "axis", "axis_name", "volume_key", "output_prefix", "output_tag")


# ------------------------------------------------------------------ decode
@query("decode_volumes")
def q_decode_volumes(spark, sf_dir):
    dec = V.decode_volumes(fx.volume_files(spark, sf_dir), mode="thinnest", normalise=False)
    sl = V.slices_of(dec)
    return _pixels_long(sl, ["volume_id", "axis", "slice_no"])


@query("decode_normalised")
def q_decode_normalised(spark, sf_dir):
    dec = V.decode_volumes(fx.volume_files(spark, sf_dir), mode="central", n=2, axes=(2,),
                           rot=1, normalise=True)
    sl = V.slices_of(dec)
    return _pixels_long(sl, ["volume_id", "axis", "slice_no", "height", "width"])


@query("decode_headers")
def q_decode_headers(spark, sf_dir):
    h = V.headers_of(V.decode_volumes(fx.volume_files(spark, sf_dir)))
    return h.select("volume_id", "status", F.array_join(F.col("shape").cast("array<string>"), "x")
                    .alias("shape"), F.element_at("pixdim", 2).cast("double").alias("spacing_x"))


# ---------------------------------------------------------------- metadata
BUCKET = L.DEFAULT_BUCKET


@query("first_file_metadata")
def q_first_file_metadata(spark, sf_dir):
    m = M.first_file_metadata(fx.dicom_files(spark, sf_dir))
    return m.select("series_key", "SeriesDate", "Manufacturer", "ManufacturerModelName",
                    F.col("spacing_x").cast("double").alias("spacing_x"),
                    F.col("spacing_y").cast("double").alias("spacing_y"))


def _series_volumes(spark, sf_dir):
    """One volume file per catalog series, named as the converter names it."""
    cat = _catalog(spark, sf_dir)
    path = F.concat(F.lit("/work/"), T.object_tag("object_key"), F.lit("/"),
                    F.col("PatientID"), F.lit("_3T_"),
                    F.coalesce(F.col("SeriesDescription"), F.lit("")), F.lit(".nii.gz"))
    return cat.select(F.col("series_uid").alias("series_key"), "object_key",
                      path.alias("volume_file"), "n_slices")


@query("series_metadata")
def q_series_metadata(spark, sf_dir):
    meta = M.first_file_metadata(fx.dicom_files(spark, sf_dir))
    rows = M.series_metadata_rows(_series_volumes(spark, sf_dir), meta, BUCKET, TCIA_OUT_DIR)
    return rows.select("series_uid", "series_date", "scan_axis", "manufacturer", "model_name",
                       "pixel_spacing_x", "pixel_spacing_y",
                       F.size("jpgfiles").cast("int").alias("n_links"),
                       F.array_join("jpgfiles", "|").alias("jpgfiles"))


@query("product_sink_columns")
def q_product_sink_columns(spark, sf_dir):
    meta = M.first_file_metadata(fx.dicom_files(spark, sf_dir))
    rows = M.series_metadata_rows(_series_volumes(spark, sf_dir), meta, BUCKET, TCIA_OUT_DIR)
    return M.rename_for_sink(rows).withColumn("jpgfiles", F.array_join("jpgfiles", "|"))


@query("job_outcomes")
def q_job_outcomes(spark, sf_dir):
    wanted = C.select_roi(C.build_manifest(fx.series_catalog(spark, sf_dir)))
    return J.object_outcomes(wanted, fx.landed_headers(spark, sf_dir),
                             fx.dicom_files(spark, sf_dir).select(F.col("series_key").alias("series_uid")),
                             keys=("series_uid", "object_key"))


@query("subject_metadata")
def q_subject_metadata(spark, sf_dir):
    # subject volumes: a part row is a subject whose volume shape/spacing
    # come from the volume_shapes view (3-D ones only)
    v = S.skip_non_3d(fx.volume_shapes(spark, sf_dir)).withColumnRenamed("volume_id", "subject")
    fan = J.axis_fanout(v, HCP_OUT_DIR)
    rows = M.subject_metadata_rows(fan, BUCKET, HCP_OUT_DIR, n=50)
    return rows.select("series_uid", "series_date", "scan_axis", "manufacturer", "model_name",
                       "pixel_spacing_x", "pixel_spacing_y",
                       F.size("jpgfiles").cast("int").alias("n_links"),
                       F.array_join("jpgfiles", "|").alias("jpgfiles"))


# ------------------------------------------------------ whole volume jobs
@query("series_products")
def q_series_products(spark, sf_dir):
    """The volume of vec_id belongs to the series of the order of that number."""
    cat = _catalog(spark, sf_dir).select(
        F.col("series_uid").alias("_uid"), "object_key",
        F.concat(F.lit("/"), F.col("PatientID"), F.lit("_3T("), F.col("SeriesDate"), F.lit(").nii.gz")).alias("_name"))
    uid = F.concat(F.lit(fx.SERIES_ROOT), F.lpad("volume_id", 40, "7"))
    files = fx.stored_volumes(spark, sf_dir).join(cat, uid == F.col("_uid")).withColumn(
        "volume_file", F.concat(F.lit("/work/"), "volume_id", "_name"))
    place = scratch_path(spark, f"series-{uuid.uuid4().hex}")
    J.process_series(C.build_manifest(fx.series_catalog(spark, sf_dir)), files, fx.dicom_files(spark, sf_dir),
                     f"{place}/slices", f"{place}/products", TCIA_OUT_DIR, BUCKET)
    rows = spark.read.schema(PRODUCTS).parquet(f"{place}/products")
    return rows.select("series_uid", "series_date", "scan_axis", "axis_family", "manufacturer", "model_name",
                       "pixel_spacing_x", "pixel_spacing_y", "output_tag",
                       F.array_join("jpgfiles", "|").alias("jpgfiles"))


def _landed_subjects(spark, sf_dir):
    """The volume of vec_id is that of the customer of that number."""
    place = scratch_path(spark, f"subjects-{uuid.uuid4().hex}")
    files = fx.stored_volumes(spark, sf_dir).withColumn(
        "volume_file", F.concat(F.lit("/store/"), T.volume_key_from_subject("volume_id")))
    subjects = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject"))
    J.process_subjects(subjects, files, f"{place}/slices", f"{place}/products", HCP_OUT_DIR, BUCKET)
    return place


@query("subject_products")
def q_subject_products(spark, sf_dir):
    rows = spark.read.schema(PRODUCTS).parquet(f"{_landed_subjects(spark, sf_dir)}/products")
    return rows.select("series_uid", "series_date", "scan_axis", "manufacturer", "model_name",
                       "pixel_spacing_x", "pixel_spacing_y", "output_tag",
                       F.array_join("jpgfiles", "|").alias("jpgfiles"))


@query("slice_targets")
def q_slice_targets(spark, sf_dir):
    rows = landed_slices(spark, f"{_landed_subjects(spark, sf_dir)}/slices")
    return rows.select("subject", F.col("axis").cast("int").alias("axis"), "slice_no", "height", "width",
                       F.size("pixels").alias("n_pixels"), "target_key")


# ----------------------------------------------------------------- cohorts
def _products(spark, sf_dir):
    """Product rows of the catalog: axis, links, tag and source."""
    cat = _catalog(spark, sf_dir)
    prefix = T.output_prefix(TCIA_OUT_DIR, T.object_tag("object_key"))
    return cat.select("series_uid", C.axis_of_key("object_key").alias("scan_axis"),
                      L.enumerate_links(prefix, F.col("clean_description"), F.col("n_slices"), BUCKET)
                      .alias("jpgfiles"),
                      F.col("clean_description").alias("output_tag"), "source")


def _cohorts(spark, sf_dir):
    return K.build_cohorts(_products(spark, sf_dir), bucket=BUCKET)


@query("cohort_union")
def q_cohort_union(spark, sf_dir):
    p = _products(spark, sf_dir)
    u = K.union_sources(hcp=p.filter(F.col("source") == "hcp").drop("source"),
                        tcia=p.filter(F.col("source") == "tcia").drop("source"))
    return u.select("series_uid", "source", "scan_axis", F.size("jpgfiles").cast("int").alias("n_links"))


@query("build_cohorts")
def q_build_cohorts(spark, sf_dir):
    c = _cohorts(spark, sf_dir)
    return c.select("name", "series_uid", F.size("images").cast("int").alias("n_images"),
                    F.array_join("images", "|").alias("images"))


@query("count_cases")
def q_count_cases(spark, sf_dir):
    return K.count_cases(_cohorts(spark, sf_dir)).select(
        "name", "n_sets", "n_cases", F.col("n_images").cast("long").alias("n_images"))


@query("count_cases_merged")
def q_count_cases_merged(spark, sf_dir):
    """G4 kept up over two deliveries, the second with cases of the first. The
    cohorts are built once: what is counted of them is written, by delivery."""
    late = F.pmod(F.xxhash64("series_uid", "scan_axis", "source", F.size("images")), F.lit(3)) == 0
    c = written(_cohorts(spark, sf_dir).select(
        "name", "series_uid", F.size("images").alias("n_images"), late.alias("late")), "deliveries")
    first, second, n_images = c.filter("not late"), c.filter("late"), F.col("n_images")
    numbers = cut_lineage(K.case_numbers(first))
    state = cut_lineage(K.case_state(first, numbers, n_images))
    numbers = cut_lineage(numbers.unionByName(K.case_numbers(second, numbers)))
    return K.cases_of(K.merged_cases(state, K.case_state(second, numbers, n_images)))


@query("images_by_name")
def q_images_by_name(spark, sf_dir):
    c = K.images_by_name(_cohorts(spark, sf_dir), "notumor_sag")
    return c.select("name", "series_uid", F.size("images").cast("int").alias("n_images"))


@query("first_store_by_name")
def q_first_store_by_name(spark, sf_dir):
    c = _cohorts(spark, sf_dir).select("series_uid", "name", "scan_axis")
    return K.first_per_name(c, order="series_uid").select("name", "series_uid", "scan_axis")


@query("export_cohort")
def q_export_cohort(spark, sf_dir):
    c = _cohorts(spark, sf_dir)
    e = K.export_manifest(c, bucket=BUCKET)
    return e.select("name", "bundle", F.col("image_no").cast("int").alias("image_no"),
                    "entry", "url")


@query("export_parts")
def q_export_parts(spark, sf_dir):
    c = _cohorts(spark, sf_dir).withColumn("uid", F.col("series_uid"))
    e = K.export_manifest(c, bucket=BUCKET).withColumn(
        "bytes", (F.lit(1000) + F.lit(37) * F.length("entry") % 4096).cast("long"))
    order = ("uid", "image_no", "entry")
    parts = K.export_parts(e, 65536, order=order)
    no = F.row_number().over(Window.partitionBy("name", "part").orderBy(*order))
    return parts.select("name", "part", no.alias("entry_no"), "entry", "bytes", "part_offset")


@query("stores_replayed")
def q_stores_replayed(spark, sf_dir):
    return K.stores_replayed(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir),
                             fx.store_requests(spark, sf_dir))[0]


@query("store_images")
def q_store_images(spark, sf_dir):
    si = K.store_images(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir))
    return si.select(F.col("store_uid").cast("int").alias("store_uid"), "store_name",
                     F.col("image_uid").cast("long").alias("image_uid"), "image_name",
                     F.when(F.col("images").isNotNull(), F.size("images")).cast("int")
                     .alias("n_images"))


@query("image_json")
def q_image_json(spark, sf_dir):
    j = K.image_json(fx.image_set(spark, sf_dir), BUCKET)
    return j.select(F.col("uid").cast("long").alias("uid"), "json")


@query("image_list_json")
def q_image_list_json(spark, sf_dir):
    j = K.image_list_json(_cohorts(spark, sf_dir), BUCKET)
    return j.select("name", "json")


@query("stores_json")
def q_stores_json(spark, sf_dir):
    j = K.stores_json(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir), BUCKET)
    return j.select(F.col("store_uid").cast("int").alias("store_uid"), "page",
                    F.col("n_images").cast("int").alias("n_images"), "json")


def _inserted_names(spark, sf_dir):
    """Names to insert: some are stores already, most are repeated."""
    return (read_table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
            .unionByName(read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))
            .unionByName(read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"))))


@query("store_by_name")
def q_store_by_name(spark, sf_dir):
    s = K.first_by_name(fx.store(spark, sf_dir), "NATION_7")
    return s.select(F.col("uid").cast("int").alias("uid"), "name")


@query("stores_after_changes")
def q_stores_after_changes(spark, sf_dir):
    stores, _ = K.stores_after_changes(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir),
                                       _inserted_names(spark, sf_dir), _deleted_names(spark, sf_dir))
    return stores


@query("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    r = K.insert_if_absent(fx.store(spark, sf_dir), _inserted_names(spark, sf_dir))
    return r.select("name", "uid", "status", F.when(F.col("status") == "exists", F.col("uid"))
                    .cast("long").alias("existing_uid"))


def _deleted_names(spark, sf_dir):
    """Names to delete: the stores named after European nations."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region").filter(F.col("r_name") == "EUROPE")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left_semi").select(F.col("n_name").alias("name"))


@query("delete_by_name")
def q_delete_by_name(spark, sf_dir):
    kept, _ = K.delete_by_name(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir),
                               _deleted_names(spark, sf_dir))
    return kept.select(F.col("uid").cast("int").alias("uid"), "name")


@query("delete_by_name_images")
def q_delete_by_name_images(spark, sf_dir):
    _, imgs = K.delete_by_name(fx.store(spark, sf_dir), fx.image_set(spark, sf_dir),
                               _deleted_names(spark, sf_dir))
    return imgs.select(F.col("uid").cast("long").alias("uid"), "name",
                       F.col("store_id").cast("int").alias("store_id"))


@query("pending_manifest")
def q_pending_manifest(spark, sf_dir):
    m = C.build_manifest(fx.series_catalog(spark, sf_dir))
    landed = fx.dicom_files(spark, sf_dir).select(F.col("series_key").alias("series_uid"))
    return K.pending(m, landed, key="series_uid")


@query("count_completed")
def q_count_completed(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return K.count_completed(ev, F.col("event_type") != "error")


@query("explode_archives")
def q_explode_archives(spark, sf_dir):
    m = A.explode_archives(fx.page_archives(spark, sf_dir))
    return m.select("object_key", "member", F.length("content").cast("long").alias("n_bytes"), "status")
