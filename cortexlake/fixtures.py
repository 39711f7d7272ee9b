"""Test views derived from the driver's tables (see FIXTURES.md part B).

Each view exists twice: as a Spark DataFrame builder (what ``queries()`` reads)
and as DuckDB SQL text (inlined as a CTE by the oracle). Both derive every
row from the given tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import read_table


def file_rows(key: str) -> T.StructType:
    """Rows of (key, file content)."""
    return T.StructType([T.StructField(key, T.StringType()), T.StructField("content", T.BinaryType())])


# UID roots and the description samples of the catalog view.
SERIES_ROOT = "1.3.6.1.4.1.14519.5.2.1."
DESCRIPTIONS = {
    1: "Ax T1 (post) +C",
    2: "SAG FSPGR 3D*",
    3: "Cor T2?/FLAIR ?",
    4: " AXIAL  DWI ",
    5: "a ( b",
    6: "x?(/y sag",
}


# ------------------------------------------------------------ series catalog
def series_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog row per order (D1 column names) plus ``n_slices`` 0..4."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    descr = F.when(k % 12 == 0, F.lit(None).cast("string"))
    for i, text in DESCRIPTIONS.items():
        descr = descr.when(k % 12 == i, F.lit(text))
    descr = descr.otherwise(F.col("o_orderpriority"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.lit(SERIES_ROOT), F.lpad(k.cast("string"), 40, "7")).alias("SeriesInstanceUID"),
        F.concat(F.lit(SERIES_ROOT), F.lpad(F.col("o_custkey").cast("string"), 40, "3"))
         .alias("StudyInstanceUID"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
         .alias("Collection"),
        F.concat(F.lit("P-"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("PatientID"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("SeriesDate"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise((k % 9).cast("string"))
         .alias("SeriesNumber"),
        descr.alias("SeriesDescription"),
        (k % 5).cast("int").alias("n_slices"),
        # finished orders play the healthy (subject) archive, others the tumour one
        F.when(F.col("o_orderstatus") == "F", F.lit("hcp")).otherwise(F.lit("tcia")).alias("source"),
    )


SERIES_CATALOG_SQL = """series_catalog as (
  select concat('1.3.6.1.4.1.14519.5.2.1.', lpad(cast(o_orderkey as varchar), 40, '7')) as SeriesInstanceUID,
         concat('1.3.6.1.4.1.14519.5.2.1.', lpad(cast(o_custkey as varchar), 40, '3')) as StudyInstanceUID,
         case when o_orderkey % 17 = 0 then null else c_mktsegment end as Collection,
         concat('P-', lpad(cast(c_custkey as varchar), 6, '0')) as PatientID,
         substr(cast(o_orderdate as varchar), 1, 10) as SeriesDate,
         case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 9 as varchar) end as SeriesNumber,
         case cast(o_orderkey % 12 as int)
              when 0 then null when 1 then 'Ax T1 (post) +C' when 2 then 'SAG FSPGR 3D*'
              when 3 then 'Cor T2?/FLAIR ?' when 4 then ' AXIAL  DWI ' when 5 then 'a ( b'
              when 6 then 'x?(/y sag' else o_orderpriority end as SeriesDescription,
         cast(o_orderkey % 5 as int) as n_slices,
         case when o_orderstatus = 'F' then 'hcp' else 'tcia' end as source
  from orders join customer on o_custkey = c_custkey)"""


# ------------------------------------------------------------- slice stacks
# A vector is one 8x8 slice; consecutive vectors form volumes
# whose slice counts repeat 40, 49, 50, 51, 60 (period 250), so a central
# range of 50 meets every branch of the bounds rule. Volumes are bounded in
# size however large the table grows.
VOLUME_SIZES = [40, 49, 50, 51, 60]


def _volume_of(vec_id):
    """(volume index inside the 250-period, start of that volume)."""
    r = vec_id % 250
    idx, start, acc = None, None, 0
    for i, size in enumerate(VOLUME_SIZES):
        idx = F.when(r < acc + size, F.lit(i)) if idx is None else idx.when(r < acc + size, F.lit(i))
        start = F.when(r < acc + size, F.lit(acc)) if start is None else start.when(r < acc + size, F.lit(acc))
        acc += size
    return idx, start


def slice_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices numbered per volume in vec_id order; ``dim`` is the count of
    slices in the volume (a bounded group: at most 60 rows)."""
    from pyspark.sql import Window as W
    e = read_table(spark, sf_dir, "embeddings")
    v = F.col("vec_id")
    idx, _ = _volume_of(v)
    e = e.withColumn("volume_id", ((v / 250).cast("long") * 5 + idx).cast("long"))
    w = W.partitionBy("volume_id")
    return e.select(
        "volume_id",
        (F.row_number().over(w.orderBy("vec_id")) - 1).cast("int").alias("slice_no"),
        F.count(F.lit(1)).over(w).cast("int").alias("dim"),
        F.transform("embedding", lambda x: x.cast("double")).alias("pixels"),
    )


SLICE_STACK_SQL = """slice_stack as (
  select volume_id,
         cast(row_number() over (partition by volume_id order by vec_id) - 1 as int) as slice_no,
         cast(count(*) over (partition by volume_id) as int) as dim,
         list_transform(embedding, lambda x: cast(x as double)) as pixels
  from (select *, cast((vec_id // 250) * 5 +
                       case when vec_id % 250 < 40 then 0 when vec_id % 250 < 89 then 1
                            when vec_id % 250 < 139 then 2 when vec_id % 250 < 190 then 3 else 4 end as bigint) as volume_id
        from embeddings) e)"""


def slices_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice stack in the D6 layout (8x8 slices along axis 0)."""
    return slice_stack(spark, sf_dir).select(
        F.col("volume_id").cast("string").alias("volume_id"), F.lit(0).alias("axis"),
        "slice_no", F.lit(8).alias("height"), F.lit(8).alias("width"), "pixels", "dim")


# A vector of 64 numbers is a volume of one of these shapes, by
# vec_id modulo 3: no two extents are equal, and every axis is the thinnest once.
VOLUME_SHAPES = [(2, 4, 8), (4, 8, 2), (8, 2, 4)]


def volumes3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector is a small volume, x fastest (flat = x + nx*y + nx*ny*z)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("volume_id"),
                    F.element_at(F.array(*[F.array(*map(F.lit, s)) for s in VOLUME_SHAPES]),
                                 (F.col("vec_id") % 3 + 1).cast("int")).alias("shape"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("voxels"))


VOLUMES3D_SQL = """volumes3d as (
  select vec_id as volume_id, case vec_id % 3 when 0 then 2 when 1 then 4 else 8 end as nx,
         case vec_id % 3 when 0 then 4 when 1 then 8 else 2 end as ny,
         case vec_id % 3 when 0 then 8 when 1 then 2 else 4 end as nz,
         list_transform(embedding, lambda x: cast(x as double)) as voxels
  from embeddings)"""


def volume_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume shapes from ``part``; one in ten is 4-D (to be skipped)."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("volume_id"),
        F.when(k % 10 == 0, F.array(F.col("p_size"), F.lit(4), F.lit(4), F.lit(7)))
         .otherwise(F.array(F.col("p_size").cast("int"), (k % 6 + 1).cast("int"),
                            (k % 4 + 1).cast("int"))).alias("shape"),
        # header spacing vector pixdim[0..7]; slot 0 is not a spacing
        F.array(F.lit(1.0), (F.col("p_retailprice") / 1000).cast("float"),
                (F.col("p_size") / 8).cast("float"), ((k % 7 + 1) * 0.25).cast("float"),
                F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).cast("array<float>").alias("pixdim"),
    ).withColumn("pixdim_text", F.transform("pixdim", lambda x: x.cast("double").cast("string")))


VOLUME_SHAPES_SQL = """volume_shapes as (
  select p_partkey as volume_id,
         case when p_partkey % 10 = 0 then list_value(p_size, 4, 4, 7)
              else list_value(cast(p_size as int), cast(p_partkey % 6 + 1 as int), cast(p_partkey % 4 + 1 as int)) end as shape,
         list_value(cast(1.0 as float), cast(p_retailprice / 1000 as float), cast(p_size / 8 as float),
                    cast((p_partkey % 7 + 1) * 0.25 as float), cast(1.0 as float), cast(0.0 as float),
                    cast(0.0 as float), cast(0.0 as float)) as pixdim
  from part)"""


# ------------------------------------------------------- stores and cohorts
def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("int").alias("uid"), F.col("n_name").alias("name"))


STORE_SQL = """store as (select cast(n_nationkey as int) as uid, n_name as name from nation)"""


def image_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image sets from ``supplier``: ``s_suppkey % 4`` links (0 included),
    some without a store, stored paths quoted (``%20``)."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    links = F.transform(F.sequence(F.lit(0), (k % 4 - 1).cast("int")),
                        lambda i: F.concat(F.lit("/data/set%20"), k.cast("string"),
                                           F.lit("/img_"), i.cast("string"), F.lit(".jpg")))
    return s.select(
        k.alias("uid"), F.col("s_name").alias("name"),
        F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(links).alias("images"),
        F.when(k % 7 == 0, F.lit(None).cast("int")).otherwise(F.col("s_nationkey").cast("int"))
         .alias("store_id"),
    )


IMAGE_SET_SQL = """image_set as (
  select s_suppkey as uid, s_name as name,
         list_transform(range(0, s_suppkey % 4), lambda i: concat('/data/set%20', s_suppkey, '/img_', i, '.jpg')) as images,
         case when s_suppkey % 7 = 0 then null else cast(s_nationkey as int) end as store_id
  from supplier)"""


def store_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in order (``seq, op, name``): an event asks to insert or to
    delete the store of a nation, or one of a few names that have none."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("user_id") % 31
    return e.join(n, k == F.col("n_nationkey"), "left").select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") * 7919 % 5 < 3, F.lit("insert")).otherwise(F.lit("delete")).alias("op"),
        F.coalesce("n_name", F.concat(F.lit("EXTRA_"), k.cast("string"))).alias("name"))


STORE_REQUESTS_SQL = """store_requests as (
  select event_id as seq, case when event_id * 7919 % 5 < 3 then 'insert' else 'delete' end as op,
         coalesce(n_name, 'EXTRA_' || cast(user_id % 31 as varchar)) as name
  from events left join nation on user_id % 31 = n_nationkey)"""


# ------------------------------------------------------------ volume files
def _packed_volume(vec_id: int, values) -> bytes:
    """File bytes written field by field from the published header layout, on
    their own: nothing of the decoder is used."""
    import gzip
    import struct

    shape = (2, 4, 4, 2) if vec_id % 10 == 9 else VOLUME_SHAPES[vec_id % 3]
    order = "<>"[vec_id // 3 % 2]
    code, letter, slope = [(16, "f", 0.0), (64, "d", 0.0), (16, "f", 0.5)][vec_id // 6 % 3]
    header = bytearray(352)
    struct.pack_into(order + "i", header, 0, 348)
    struct.pack_into(order + "8h", header, 40, len(shape), *shape, *[1] * (7 - len(shape)))
    struct.pack_into(order + "2h", header, 70, code, 8 * struct.calcsize(letter))
    struct.pack_into(order + "8f", header, 76, 1.0, 0.5, 0.75, 1.25, 1.0, 0.0, 0.0, 0.0)
    struct.pack_into(order + "3f", header, 108, 352.0, slope, 0.0)
    header[344:348] = b"n+1\0"
    scaled = [float(v) / (slope or 1.0) for v in values]
    file = gzip.compress(bytes(header) + struct.pack(f"{order}{len(scaled)}{letter}", *scaled), 1, mtime=0)
    return file[:len(file) // 2] if vec_id % 25 == 3 else file


def volume_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding vector packed as a gzip NIfTI-1 file of the shape above:
    file bytes for the decode job that Spark derives from the given table.
    Byte order, number type and scaling vary with vec_id; one in ten is 4-D (to
    be skipped), one in 25 ends in the middle (to be reported)."""
    import pandas as pd

    def enc(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "volume_id": pdf["vec_id"].astype(str),
                "content": [_packed_volume(int(i), v) for i, v in zip(pdf["vec_id"], pdf["embedding"])],
            })
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.mapInPandas(enc, file_rows("volume_id"))


def stored_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume files above as files of the shared scratch folder, written by
    the tasks that make them (again by a task that is repeated), and their
    listing: ``volume_id, path, length, modified``."""
    import uuid

    import pyarrow as pa

    from .session import scratch_path
    from .sources.volumes import list_volume_files, open_path

    folder = scratch_path(spark, f"volumes-{uuid.uuid4().hex}")

    def store(batches):
        for batch in batches:
            for name, content in zip(*[c.to_pylist() for c in batch.columns]):
                with open_path(f"{folder}/{name}.nii.gz", write=True) as f:
                    f.write(content)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["volume_id"])

    volume_files(spark, sf_dir).mapInArrow(store, "volume_id string").write.parquet(f"{folder}-names")
    return list_volume_files(spark, folder).withColumn(
        "volume_id", F.regexp_extract("path", r"([^/]*)\.nii\.gz$", 1))


# ---------------------------------------------------------- file metadata
def dicom_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file scanner metadata: a lineitem row is one slice file of the
    series of its order (several files per series)."""
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        F.concat(F.lit(SERIES_ROOT), F.lpad(k.cast("string"), 40, "7")).alias("series_key"),
        F.concat(F.lit("IM-"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0"), F.lit("-"),
                 F.col("l_partkey").cast("string"), F.lit(".dcm")).alias("file_name"),
        F.concat(F.lit(SERIES_ROOT), F.lpad(k.cast("string"), 40, "7")).alias("SeriesInstanceUID"),
        F.substring(F.col("l_shipdate").cast("string"), 1, 10).alias("SeriesDate"),
        F.when(F.col("l_suppkey") % 11 == 0, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "A", F.lit("SIEMENS"))
         .when(F.col("l_returnflag") == "N", F.lit("GE MEDICAL SYSTEMS"))
         .otherwise(F.lit("Philips")).alias("Manufacturer"),
        F.concat(F.lit("MODEL-"), F.col("l_linestatus"), (F.col("l_suppkey") % 10).cast("string"))
         .alias("ManufacturerModelName"),
        # spacing is decimal text in such files
        (F.col("l_discount") * 10 + 0.5).cast("decimal(8,4)").cast("string").alias("spacing_x"),
        (F.col("l_tax") * 10 + 0.5).cast("decimal(8,4)").cast("string").alias("spacing_y"),
    )


def landed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows of catalog series: one without slices has no file, one of a
    single slice was skipped, one without a series number could not be read."""
    from .operators.catalog import with_catalog_columns
    cat = with_catalog_columns(series_catalog(spark, sf_dir)).filter("n_slices > 0")
    status = F.when(F.col("n_slices") == 1, F.lit("skipped")).when(
        F.col("SeriesNumber").isNull(), F.lit("error")).otherwise(F.lit("ok"))
    return cat.select("series_uid", "object_key", status.alias("status"),
                      F.when(status != "ok", F.concat(F.lit("header: "), status)).alias("message"))


DICOM_FILES_SQL = """dicom_files as (
  select concat('1.3.6.1.4.1.14519.5.2.1.', lpad(cast(l_orderkey as varchar), 40, '7')) as series_key,
         concat('IM-', lpad(cast(l_linenumber as varchar), 4, '0'), '-', cast(l_partkey as varchar), '.dcm') as file_name,
         concat('1.3.6.1.4.1.14519.5.2.1.', lpad(cast(l_orderkey as varchar), 40, '7')) as SeriesInstanceUID,
         substr(cast(l_shipdate as varchar), 1, 10) as SeriesDate,
         case when l_suppkey % 11 = 0 then null when l_returnflag = 'A' then 'SIEMENS' when l_returnflag = 'N' then 'GE MEDICAL SYSTEMS'
              else 'Philips' end as Manufacturer,
         concat('MODEL-', l_linestatus, cast(l_suppkey % 10 as varchar)) as ManufacturerModelName,
         cast(cast(l_discount * 10 + 0.5 as decimal(8,4)) as varchar) as spacing_x,
         cast(cast(l_tax * 10 + 0.5 as decimal(8,4)) as varchar) as spacing_y
  from lineitem)"""


# ---------------------------------------------------------- archive files
def page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each web page packed as a zip archive with two members (the page and,
    under a nested path, its URL): file bytes for the archive explode job
    that Spark derives from the ``pages`` table."""
    import io
    import zipfile

    import pandas as pd

    def enc(batches):
        for pdf in batches:
            blobs = []
            for html, url in zip(pdf["html"], pdf["url"]):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("index.html", (html or "").encode("utf-8"))
                    z.writestr("meta/url.txt", (url or "").encode("utf-8"))
                blobs.append(buf.getvalue())
            yield pd.DataFrame({"object_key": pdf["page_id"].astype(str), "content": blobs})
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.mapInPandas(enc, file_rows("object_key"))
