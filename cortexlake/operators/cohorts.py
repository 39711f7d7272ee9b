"""Cohorts (named image sets) and stores: union of sources, cohort building,
case counts, store -> images nesting, JSON shapes, lookups, insert/delete.

Scale rules kept here: no operator collects an unbounded group. Nested JSON
is one document per store up to ``PAGE_SIZE`` image sets; a larger store's
sets are dealt over ceil(n / ``PAGE_SIZE``) documents, so a store that owns a
third of all image sets becomes many documents instead of one huge row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions import text as T
from .running import with_running_sum

# Cohort families of the two sources and the axes offered.
FAMILY_OF_SOURCE = {"hcp": "notumor", "tcia": "withtumor"}
COHORT_AXES = ("sag", "cor", "ax")
PAGE_SIZE = 256


# ------------------------------------------------------------- U1 / U2 / G4
def union_sources(**by_source: DataFrame) -> DataFrame:
    """Product rows of several sources in one table with a ``source``
    column (same row layout; columns matched by name)."""
    out = None
    for src, df in by_source.items():
        d = df.withColumn("source", F.lit(src))
        out = d if out is None else out.unionByName(d)
    return out


def cohort_name(source: T.ColumnOrName, axis: T.ColumnOrName) -> Column:
    fam = None
    for src, f in FAMILY_OF_SOURCE.items():
        fam = (F.when(T._c(source) == src, F.lit(f)) if fam is None
               else fam.when(T._c(source) == src, F.lit(f)))
    return F.concat(fam, F.lit("_"), T._c(axis))


def stored_path(url: T.ColumnOrName, bucket: str = L.DEFAULT_BUCKET) -> Column:
    """The path part of a public slice URL, as cohort rows store it (the API
    prepends the host again without a slash)."""
    host = L.PUBLIC_HOST.format(bucket=bucket)
    u = T._c(url)
    return F.when(u.startswith(host), u.substr(F.lit(len(host) + 1), F.length(u))).otherwise(u)


def build_cohorts(products: DataFrame, store_id: T.ColumnOrName | None = None,
                  bucket: str = L.DEFAULT_BUCKET) -> DataFrame:
    """One image-set row per (source, series, axis) volume, named
    ``{notumor|withtumor}_{sag|cor|ax}``, images = stored slice paths, uid =
    64-bit hash of the natural key (stable across re-runs, no global
    numbering pass). ``other_*`` axes belong to no cohort.

    On the product table the axis is a partition (``axis_family``): a plain
    filter, and a later filter on ``name``, prune its folders. Products
    computed on the fly have no such column; there rows come out of ``inline``
    of a 0-or-1 element array, as a filter on ``scan_axis`` would be pushed
    below the projection and the whole key derivation evaluated twice."""
    stored = "axis_family" in products.columns
    sid = F.lit(None).cast("int") if store_id is None else T._c(store_id).cast("int")
    row = F.struct(
        F.xxhash64("source", "series_uid", "scan_axis", "output_tag").alias("uid"),
        cohort_name("source", "axis_family" if stored else "scan_axis").alias("name"),
        F.transform("jpgfiles", lambda u: stored_path(u, bucket)).alias("images"),
        sid.alias("store_id"),
        F.col("source").alias("source"), F.col("series_uid").alias("series_uid"),
        F.col("scan_axis").alias("scan_axis"))
    if stored:
        return products.filter(F.col("axis_family").isin(*COHORT_AXES)) \
            .select(row.alias("r")).select("r.*")
    keep = F.col("scan_axis").isin(*COHORT_AXES)
    return products.select(F.inline(F.filter(F.array(row), lambda _r: keep)))


def count_cases(cohorts: DataFrame) -> DataFrame:
    """Per cohort, image sets and distinct cases (series)."""
    return cohorts.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_sets"),
        F.countDistinct("series_uid").alias("n_cases"),
        F.sum(F.size("images")).alias("n_images"))


def case_numbers(cohorts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``series_uid, number`` of the cases of ``cohorts`` that ``known`` (the
    same columns) has not, numbered on from its largest: dense, without a
    window over all of them."""
    new, first = cohorts.select("series_uid").filter("series_uid is not null").distinct(), 0
    if known is not None:
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        new = new.join(known, "series_uid", "left_anti")
    return with_running_sum(new, F.lit(1), ["series_uid"], name="_n").select(
        "series_uid", (F.col("_n") + first).cast("long").alias("number"))


def case_state(cohorts: DataFrame, numbers: DataFrame, n_images: Column | None = None) -> DataFrame:
    """G4 of one delivery, to be kept and merged: per cohort and page of 32,768
    numbers a bitmap of its cases, and with page -1 its sets and images
    (``n_images`` of a row: the size of its ``images``)."""
    n_images = F.size("images") if n_images is None else n_images
    page, bit = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    bits = cohorts.select("name", "series_uid").join(numbers, "series_uid").groupBy("name", page.alias("page")).agg(
        F.bitmap_construct_agg(bit).alias("bits"), F.lit(0).cast("long").alias("n_sets"),
        F.lit(0).cast("long").alias("n_images"))
    sums = cohorts.groupBy("name").agg(F.count("*").alias("n_sets"),
                                       F.sum(n_images).cast("long").alias("n_images"))
    return bits.unionByName(sums.select("name", F.lit(-1).cast("long").alias("page"),
                                        F.lit(None).cast(bits.schema["bits"].dataType).alias("bits"),
                                        "n_sets", "n_images"))


def merged_cases(*states: DataFrame) -> DataFrame:
    """The state of several deliveries: bitmaps are joined bit by bit, so a case
    that comes again counts once; earlier deliveries are not read again."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy("name", "page").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n_sets").alias("n_sets"),
                                           F.sum("n_images").alias("n_images"))


def cases_of(state: DataFrame) -> DataFrame:
    """``count_cases`` out of a (merged) state."""
    return state.groupBy("name").agg(
        F.sum("n_sets").cast("long").alias("n_sets"),
        F.sum(F.when(F.col("page") >= 0, F.bitmap_count("bits")).otherwise(0)).cast("long").alias("n_cases"),
        F.sum("n_images").cast("long").alias("n_images"))


# --------------------------------------------------------- lookups
def images_by_name(images: DataFrame, name: str) -> DataFrame:
    """Every image set of that name (an empty result is "not found")."""
    return images.filter(F.col("name") == F.lit(name))


def first_by_name(df: DataFrame, name: str, order: str = "uid") -> DataFrame:
    """P9 + L1: the first row of that name (ordered by ``order``)."""
    return df.filter(F.col("name") == F.lit(name)).orderBy(order).limit(1)


def first_per_name(df: DataFrame, order: str = "uid") -> DataFrame:
    """P9 for every name at once: the row with the smallest ``order`` value
    per name, as a partial aggregate (``min`` of a struct led by the key)."""
    others = [c for c in df.columns if c not in ("name", order)]
    m = F.min(F.struct(F.col(order), *[F.col(c) for c in others])).alias("_m")
    return df.groupBy("name").agg(m).select(
        F.col(f"_m.{order}").alias(order), "name", *[F.col(f"_m.{c}").alias(c) for c in others])


# ------------------------------------------------------------ J1 / G1 / A12
def explode_images(images: DataFrame) -> DataFrame:
    """One row per stored image path (position kept)."""
    return images.select("uid", "name", "store_id",
                         F.posexplode("images").alias("image_no", "image"))


def store_images(stores: DataFrame, images: DataFrame) -> DataFrame:
    """J1 (flat): every store with each of its image sets; a store with no
    images keeps one row with null image fields; image sets without a store
    appear in no store. Written as an inner join (images streamed, so AQE
    can split a store that owns a large share of the image sets) plus the
    stores without any image set (anti join on distinct store ids);
    no nesting, no collect."""
    i = images.select(F.col("uid").alias("image_uid"), F.col("name").alias("image_name"),
                      "images", "store_id")
    s = stores.select(F.col("uid").alias("store_uid"), F.col("name").alias("store_name"))
    inner = i.join(s, i["store_id"] == s["store_uid"], "inner").select(
        "store_uid", "store_name", "image_uid", "image_name", "images")
    used = i.select(F.col("store_id").alias("store_uid")).filter(F.col("store_uid").isNotNull()).distinct()
    empty = s.join(used, "store_uid", "left_anti").select(
        "store_uid", "store_name", F.lit(None).cast("long").alias("image_uid"),
        F.lit(None).cast("string").alias("image_name"),
        F.lit(None).cast("array<string>").alias("images"))
    return inner.unionByName(empty)


def image_json(images: DataFrame, bucket: str = L.DEFAULT_BUCKET) -> DataFrame:
    """``{"name": ..., "images": [url, ...]}`` per image set; the host is
    prepended to each stored path without a separator."""
    host = L.PUBLIC_HOST.format(bucket=bucket)
    doc = F.struct(F.col("name").alias("name"),
                   F.transform("images", lambda p: F.concat(F.lit(host), p)).alias("images"))
    return images.select("uid", "name", "store_id", F.to_json(doc).alias("json"))


def stores_json(stores: DataFrame, images: DataFrame, bucket: str = L.DEFAULT_BUCKET,
                page_size: int = PAGE_SIZE) -> DataFrame:
    """X2 + G1: ``{"name": store, "images": [image_json, ...]}`` per store: one
    document for a store of at most ``page_size`` image sets, whatever their
    uids. A store of n sets beyond that has ceil(n / page_size) pages, and a
    set goes to page uid modulo their number (about ``page_size`` sets each).
    The number of pages comes from the store's own count. A store without
    images gives one document with an empty list (the ``when`` keeps a null
    struct out of the list)."""
    host = L.PUBLIC_HOST.format(bucket=bucket)
    n = images.filter("store_id is not null").groupBy("store_id").agg(
        F.ceil(F.count(F.lit(1)) / page_size).alias("_pages"))
    si = store_images(stores, images).join(n, F.col("store_uid") == F.col("store_id"), "left") \
        .withColumn("page", F.coalesce(F.pmod("image_uid", "_pages"), F.lit(0)).cast("long"))
    item = F.when(F.col("image_uid").isNotNull(), F.struct(
        F.col("image_uid").alias("uid"), F.col("image_name").alias("name"),
        F.transform("images", lambda p: F.concat(F.lit(host), p)).alias("images")))
    g = si.groupBy("store_uid", "store_name", "page").agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    doc = F.struct(F.col("store_name").alias("name"),
                   F.transform("items", lambda x: F.struct(x["name"].alias("name"),
                                                           x["images"].alias("images")))
                   .alias("images"))
    return g.select("store_uid", "store_name", "page", F.size("items").alias("n_images"),
                    F.to_json(doc).alias("json"))


def image_list_json(images: DataFrame, bucket: str = L.DEFAULT_BUCKET) -> DataFrame:
    """The ``records`` of the image list, one JSON record per row (the
    full list is the concatenation; it is never gathered into one cell)."""
    return image_json(images, bucket)


# ------------------------------------------------------------ J4 / J5 / J6
def pending(manifest: DataFrame, landed: DataFrame, key: str = "object_key") -> DataFrame:
    """Manifest rows not yet landed (resume after a partial run)."""
    return manifest.join(landed.select(key).distinct(), key, "left_anti")


def new_uid(name: T.ColumnOrName) -> Column:
    """The uid of a store made under ``name``: the first 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(T._c(name)), 1, 15), 16, 10).cast("long")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str = "name") -> DataFrame:
    """Incoming names, de-duplicated; a name no existing row has is
    ``inserted`` with the first 60 bits of the name's MD5 as its uid (LONG; the
    same on every run, without a numbering pass), otherwise it is rejected as
    ``exists`` with the uid it already has. Returns ``name, uid, status``."""
    inc = incoming.select(key).filter(F.col(key).isNotNull()).distinct()
    have = first_per_name(existing.select("uid", key)).select(key, F.col("uid").alias("_uid"))
    j = inc.join(have, key, "left")
    new = j.filter(F.col("_uid").isNull()).select(
        key, new_uid(key).alias("uid"), F.lit("inserted").alias("status"))
    old = j.filter(F.col("_uid").isNotNull()).select(
        key, F.col("_uid").cast("long").alias("uid"), F.lit("exists").alias("status"))
    return new.unionByName(old)


def delete_by_name(stores: DataFrame, images: DataFrame, names: DataFrame):
    """For each name to delete, remove the first store of that name (by
    uid; nothing happens for an absent name); image sets of a removed store
    keep their rows with ``store_id`` set to null. Returns (stores, images)."""
    n = names.select("name").distinct()
    victims = first_per_name(stores.join(n, "name", "left_semi")).select(F.col("uid").alias("_gone"))
    kept = stores.join(victims, stores["uid"] == victims["_gone"], "left_anti")
    imgs = images.join(victims, images["store_id"] == victims["_gone"], "left") \
                 .withColumn("store_id", F.when(F.col("_gone").isNull(), F.col("store_id"))
                             .otherwise(F.lit(None).cast("int"))).drop("_gone")
    return kept, imgs


def stores_after_changes(stores: DataFrame, images: DataFrame, inserts: DataFrame,
                         deletes: DataFrame):
    """J5 + J6 together: (stores, images) after a batch of names to insert and
    one to delete, both judged on the stores as they were: a name in both lists
    loses its store if it had one and gets one if it had none."""
    new = insert_if_absent(stores, inserts).filter(F.col("status") == "inserted")
    kept, imgs = delete_by_name(stores, images, deletes)
    return kept.select(F.col("uid").cast("long").alias("uid"), "name").unionByName(
        new.select("uid", "name")), imgs


def stores_replayed(stores: DataFrame, images: DataFrame, requests: DataFrame):
    """(stores, images) after requests ``seq, op, name`` (op ``insert`` or
    ``delete``) served one after the other, each judged on what the ones before
    it left (J5, J6).

    While a name has stores, inserts change nothing and every delete takes the
    store of the smallest uid; after that an insert makes one and a delete takes
    it. So of k stores the first min(k, deletes) go, and a new one stands at the
    end iff there are k deletes at least and the last request is an insert. A
    name's requests are two maxima and a count, pre-aggregated: a name with a
    third of all requests is one row per task."""
    log = requests.filter("name is not null").groupBy("name").agg(
        F.count_if(F.col("op") == "delete").alias("_deletes"),
        F.max(F.when(F.col("op") == "insert", F.col("seq"))).alias("_insert"),
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("_delete"))
    place = with_running_sum(stores.select(F.col("uid").cast("long").alias("uid"), "name"), F.lit(1),
                             ["uid"], ("name",), "_place")
    met = place.join(log.select("name", "_deletes"), "name", "left")
    gone = met.filter(F.col("_place") < F.col("_deletes")).select(F.col("uid").alias("_gone"))
    kept = met.filter(F.coalesce(F.col("_place") >= F.col("_deletes"), F.lit(True))).select("uid", "name")
    had = stores.filter("name is not null").groupBy("name").agg(F.count("*").alias("_had"))
    new = log.join(had, "name", "left").filter(
        (F.col("_deletes") >= F.coalesce("_had", F.lit(0))) & F.col("_insert").isNotNull()
        & (F.col("_delete").isNull() | (F.col("_insert") > F.col("_delete"))))
    stores = kept.unionByName(new.select(new_uid("name").alias("uid"), "name"))
    imgs = images.join(gone, images["store_id"] == gone["_gone"], "left").withColumn(
        "store_id", F.when(F.col("_gone").isNull(), F.col("store_id"))).drop("_gone")
    return stores, imgs


# -------------------------------------------------------------- G2 / K7 pre
def count_completed(status: DataFrame, ok: Column) -> DataFrame:
    """Successes and total (one row; partial counts per task)."""
    return status.agg(F.count_if(ok).alias("n_ok"), F.count(F.lit(1)).alias("n_total"))


def export_manifest(images: DataFrame, name: str | None = None,
                    bucket: str = L.DEFAULT_BUCKET) -> DataFrame:
    """K7 rows: for a cohort name (or all), one row per image: the bundle it
    goes to (``<name>.zip``), the entry path (the stored path unquoted) and
    the object to copy from."""
    src = images if name is None else images_by_name(images, name)
    e = explode_images(src)
    host = L.PUBLIC_HOST.format(bucket=bucket)
    return e.select("name", F.concat(F.col("name"), F.lit(".zip")).alias("bundle"),
                    "uid", "image_no", L.url_unquote("image").alias("entry"),
                    F.concat(F.lit(host), F.col("image")).alias("url"))


def export_parts(entries: DataFrame, part_bytes: int, size: str = "bytes",
                 order: tuple[str, ...] = ("uid", "image_no")) -> DataFrame:
    """K7: bundle entries (``name``, ``order``, their ``size``) with the ``part``
    of the bundle they go to and their ``part_offset`` in bytes. A part takes the
    entries that begin within its ``part_bytes`` of the bundle's running size, in
    ``order``: it ends with the entry that reaches over them, and an entry larger
    than a part leaves the numbers between unused. No bundle passes through one
    task: the running sizes are summed over ranges, also for a cohort that
    holds a third of all images."""
    rows = with_running_sum(entries, F.coalesce(size, F.lit(0)), list(order), ("name",), "_before").withColumn(
        "part", F.floor(F.col("_before") / part_bytes).cast("long"))
    starts = rows.groupBy("name", "part").agg(F.min("_before").alias("_start")) \
        .select(F.col("name").alias("_name"), F.col("part").alias("_part"), "_start")
    return rows.join(starts, F.col("name").eqNullSafe(F.col("_name")) & (F.col("part") == F.col("_part"))) \
        .withColumn("part_offset", F.col("_before") - F.col("_start")).drop("_before", "_name", "_part", "_start")
