"""Readers, sinks and whole jobs end to end, including the re-run test."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cortexlake.operators import catalog as C
from cortexlake.operators import cohorts as K
from cortexlake.plans import jobs as J
from cortexlake.sources import catalog as SC
from cortexlake.sources import volumes as V

VOLUME_FILES = T.StructType([T.StructField("object_key", T.StringType()),
                             T.StructField("volume_file", T.StringType()),
                             T.StructField("content", T.BinaryType())])

CATALOG = [
    {"Collection": "COLL-A", "PatientID": "P-01", "SeriesDate": "2001-01-01",
     "SeriesNumber": "3", "SeriesDescription": "Ax T1 (post) +C",
     "StudyInstanceUID": "1.2.3." + "4" * 53 + "11111",
     "SeriesInstanceUID": "1.2.3." + "5" * 53 + "22222"},
    {"Collection": None, "PatientID": "P-02", "SeriesDate": "2002-02-02",
     "SeriesNumber": None, "SeriesDescription": "SAG FSPGR 3D*",
     "StudyInstanceUID": "1.2.3." + "4" * 53 + "33333",
     "SeriesInstanceUID": "1.2.3." + "5" * 53 + "44444"},
    {"Collection": "COLL-A", "PatientID": "P-03", "SeriesDate": "2003-03-03",
     "SeriesNumber": "1", "SeriesDescription": "localizer",
     "StudyInstanceUID": "short", "SeriesInstanceUID": "1.2.3.9"},
]


def test_manifest_job_and_reader(spark, tmpdir_path):
    cat = os.path.join(tmpdir_path, "catalog.json")
    with open(cat, "w") as f:
        json.dump(CATALOG, f)        # one JSON array, as the archive returns it
    out = os.path.join(tmpdir_path, "manifest")
    J.manifest_job(spark, cat, out)
    m = {r.series_uid: r.object_key for r in SC.read_manifest(spark, out).collect()}
    assert len(m) == 3
    assert m[CATALOG[0]["SeriesInstanceUID"]] == \
        "data/TCIAData_p3/COLL-A/P-01/2001-01-01-11111/3-AX_T1_POST_C-22222/blob.zip"
    assert m[CATALOG[1]["SeriesInstanceUID"]] == \
        "data/TCIAData_p3/NULL/P-02/2002-02-02-33333/NULL-SAG_FSPGR_3D-44444/blob.zip"
    # short UIDs give empty fixed suffixes (characters 60..64 do not exist)
    assert m["1.2.3.9"] == "data/TCIAData_p3/COLL-A/P-03/2003-03-03-/1-LOCALIZER-/blob.zip"
    # every part file is part of the published manifest
    assert len([p for p in os.listdir(out) if p.startswith("part-")]) >= 1
    roi = C.select_roi(SC.read_manifest(spark, out))
    assert roi.count() == 2


def test_subject_list(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "subjects.txt")
    with open(p, "w") as f:
        f.write("100206\n 0100307 \n\n100408\n")
    got = [r.subject for r in SC.read_subject_list(spark, p).collect()]
    assert got == [100206, 100307, 100408]


def _nifti_dir(tmpdir_path, subjects, shape=(8, 10, 6)):
    rng = np.random.default_rng(11)
    for s in subjects:
        d = os.path.join(tmpdir_path, "hcp", "HCP_1200", str(s), "unprocessed", "3T", "T1w_MPR1")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{s}_3T_T1w_MPR1.nii.gz"), "wb") as f:
            f.write(V.encode_nifti(rng.normal(size=shape).astype(np.float32), (1.0, 0.7, 0.8, 0.9)))


def test_process_subjects_end_to_end_and_rerun(spark, tmpdir_path):
    subjects = [100206, 100307]
    _nifti_dir(tmpdir_path, subjects)
    files = V.read_volume_files(spark, os.path.join(tmpdir_path, "hcp")).select(
        F.col("volume_id").alias("volume_file"), "content")
    subj = spark.createDataFrame([(s,) for s in subjects], "subject long")
    slices_p, prod_p = os.path.join(tmpdir_path, "slices"), os.path.join(tmpdir_path, "products")
    J.process_subjects(subj, files, slices_p, prod_p, "data/HCP_output_v1", "bkt", n=4)
    prod = spark.read.parquet(prod_p)
    assert prod.count() == 6          # 2 subjects x 3 axes
    rows = {(r.series_uid, r.scan_axis): r for r in prod.collect()}
    r = rows[("100206", "cor")]
    assert r.series_date == "NORECORD" and r.manufacturer == "SIEMENS" and r.model_name == "SKYRA"
    assert r.pixel_spacing_x == "{}".format(float(np.float32(0.7)))
    assert r.pixel_spacing_y == "{}".format(float(np.float32(0.9)))
    assert len(r.jpgfiles) == 4
    assert r.jpgfiles[0] == ("https://bkt.s3.amazonaws.com/data/HCP_output_v1/hcp_subject_100206/"
                             "subject100206_3T_T1w_MPR1_cor_0.jpg")
    sl = spark.read.parquet(slices_p).filter(F.col("slice_no").isNotNull())
    assert sl.count() == 2 * 3 * 4
    # re-run: nothing is appended twice
    J.process_subjects(subj, files, slices_p, prod_p, "data/HCP_output_v1", "bkt", n=4)
    assert spark.read.parquet(prod_p).count() == 6


def test_disjoint_subsets_land_once(spark, tmpdir_path):
    """A run over a part keeps what other runs have landed, and a run over all
    of it again adds nothing."""
    subjects = [100206, 100307]
    _nifti_dir(tmpdir_path, subjects, shape=(6, 8, 10))
    files = V.read_volume_files(spark, os.path.join(tmpdir_path, "hcp")).select(
        F.col("volume_id").alias("volume_file"), "content")
    slices_p, prod_p = os.path.join(tmpdir_path, "slices"), os.path.join(tmpdir_path, "products")
    for some in ([subjects[0]], [subjects[1]], subjects, subjects):
        subj = spark.createDataFrame([(s,) for s in some], "subject long")
        J.process_subjects(subj, files, slices_p, prod_p, "out", "bkt", n=4)
    rows = spark.read.parquet(slices_p)
    cut = rows.filter("slice_no is not null")
    assert cut.count() == 2 * 3 * 4 and cut.select("target_key").distinct().count() == 24
    assert {r.subject for r in rows.select("subject").distinct().collect()} == {"100206", "100307"}
    links = spark.read.parquet(prod_p).select(F.explode("jpgfiles").alias("u"))
    assert links.join(cut, links.u.endswith(cut.target_key)).count() == 24
    want = spark.createDataFrame([(r.object_key,) for r in rows.select("object_key").distinct().collect()]
                                 + [("lost",)], "object_key string")
    got = {r.object_key: r.outcome for r in J.volume_outcomes(want, slices_p, "hcp").collect()}
    assert got.pop("lost") == "no file" and set(got.values()) == {"ok"}


def test_shared_file_names_stay_apart(spark, tmpdir_path):
    """Two series whose converter gave the same file name land once each."""
    manifest = C.build_manifest(spark.createDataFrame(CATALOG, schema=SC.SERIES_CATALOG))
    roi = [r.object_key for r in C.select_roi(manifest).collect()]
    data = [V.encode_nifti(np.full((5, 6, 3), i, np.float32) + np.arange(3)) for i in range(2)]
    vols = spark.createDataFrame([(k, "same.nii.gz", bytearray(d)) for k, d in zip(roi, data)], VOLUME_FILES)
    meta = spark.createDataFrame([], "series_key string, file_name string, SeriesInstanceUID string, "
                                     "SeriesDate string, Manufacturer string, ManufacturerModelName string, "
                                     "spacing_x double, spacing_y double")
    slices_p = os.path.join(tmpdir_path, "slices")
    J.process_series(manifest, vols, meta, slices_p, os.path.join(tmpdir_path, "products"), "out", "bkt")
    cut = spark.read.parquet(slices_p).filter("slice_no is not null")
    assert cut.count() == 6 and cut.select("target_key").distinct().count() == 6
    assert {r.object_key: r["count"] for r in cut.groupBy("object_key").count().collect()} == \
        {k: 3 for k in roi}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_bytes_are_shuffled(spark, tmpdir_path):
    """Above and below the decoder: only the listing is exchanged."""
    _nifti_dir(tmpdir_path, [1, 2, 3])
    files = V.list_volume_files(spark, os.path.join(tmpdir_path, "hcp")).withColumn("volume_file", F.col("path"))
    subjects = spark.createDataFrame([(s,) for s in (1, 2, 3)], "subject long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = J._pending(J.subject_volumes(subjects, files, "out"), os.path.join(tmpdir_path, "none"), "hcp")
        decoded = J._decoded(todo, files, ("subject", "object_key", "output_prefix"), mode="central", n=2)
        plan = _plan(decoded)
        assert "content" not in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
        assert decoded.filter("slice_no is not null").count() == 3 * 3 * 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert V.packed(files, bytes_per_task=1).rdd.getNumPartitions() >= 3
    assert V.packed(files, files_per_task=1).rdd.getNumPartitions() >= 3


def test_bad_file_then_mended(spark, tmpdir_path):
    """The first batch holds nothing but a file that cannot be read; mended, it
    lands; further runs add nothing; a run that died does not count."""
    from cortexlake.sinks import writers as W
    subjects = [100206, 100307]
    _nifti_dir(tmpdir_path, subjects, shape=(6, 8, 10))
    folder = os.path.join(tmpdir_path, "hcp")
    bad = next(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if "100206" in f)
    good = open(bad, "rb").read()
    slices_p, prod_p = os.path.join(tmpdir_path, "slices"), os.path.join(tmpdir_path, "products")

    def run(some):
        files = V.list_volume_files(spark, folder).withColumn("volume_file", F.col("path"))
        subj = spark.createDataFrame([(s,) for s in some], "subject long")
        J.process_subjects(subj, files, slices_p, prod_p, "out", "bkt", n=4)
        want = J.subject_volumes(subj, files, "out").select("object_key")
        return {r.object_key.split("/")[1]: r.outcome
                for r in J.volume_outcomes(want, slices_p, "hcp").collect()}

    with open(bad, "wb") as f:
        f.write(good[:len(good) // 2])
    assert run(subjects[:1]) == {"100206": "error"}
    assert run(subjects) == {"100206": "error", "100307": "ok"}
    with open(bad, "wb") as f:
        f.write(good)
    # slices of a run that never reached the ledger
    dead = W.landed_slices(spark, slices_p).withColumn("slice_no", F.lit(99))
    dead.drop("run", "target_key").write.mode("overwrite").parquet(os.path.join(tmpdir_path, "dead"))
    W.append_slices(spark.read.parquet(os.path.join(tmpdir_path, "dead")), slices_p, "run-dead")
    for _ in range(3):
        assert run(subjects) == {"100206": "ok", "100307": "ok"}
    cut = W.landed_slices(spark, slices_p)
    assert cut.count() == cut.select("target_key").distinct().count() == 2 * 3 * 4
    assert spark.read.parquet(prod_p).count() == 6
    ledger = spark.read.parquet(W.ledger_path(slices_p))
    assert sorted((r.subject, r.attempt, r.status) for r in ledger.collect()) == [
        ("100206", 1, "error"), ("100206", 2, "error"), ("100206", 3, "ok"), ("100307", 1, "ok")]


def test_process_series_end_to_end(spark, tmpdir_path):
    cat = spark.createDataFrame(CATALOG, schema=SC.SERIES_CATALOG)
    manifest = C.build_manifest(cat)
    keys = {r.series_uid: r.object_key for r in manifest.collect()}
    rng = np.random.default_rng(12)
    vol_rows = []
    for uid in keys:
        data = rng.normal(size=(5, 6, 3)).astype(np.float32)
        vol_rows.append((keys[uid], f"/conv/{uid[-5:]}/P_3T_desc(1).nii.gz",
                         bytearray(V.encode_nifti(data))))
    vols = spark.createDataFrame(vol_rows, VOLUME_FILES)
    meta = spark.createDataFrame(
        [(uid, f"IM-{i}.dcm", uid, "2001-01-01", "GE", "M1", 0.9375, 0.5)
         for uid in keys for i in (2, 1)],
        "series_key string, file_name string, SeriesInstanceUID string, SeriesDate string, "
        "Manufacturer string, ManufacturerModelName string, spacing_x double, spacing_y double")
    slices_p, prod_p = os.path.join(tmpdir_path, "slices"), os.path.join(tmpdir_path, "products")
    J.process_series(manifest, vols, meta, slices_p, prod_p, "data/TCIA_output_v2", "bkt")
    prod = spark.read.parquet(prod_p).collect()
    # only the two series with an orientation marker are processed
    assert sorted(r.scan_axis for r in prod) == ["ax", "sag"]
    for r in prod:
        assert len(r.jpgfiles) == 3 and r.output_tag == "P_3T_desc1"
        assert r.pixel_spacing_x == "0.9375"
    J.process_series(manifest, vols, meta, slices_p, prod_p, "data/TCIA_output_v2", "bkt")
    assert spark.read.parquet(prod_p).count() == 2


def test_stored_cohort_lookup_prunes_partitions(spark, tmpdir_path):
    from cortexlake.sinks.writers import append_products
    rows = spark.createDataFrame(
        [(f"s{i}", axis, [f"/d/{i}.jpg"], f"t{i}", src) for i, (axis, src) in enumerate(
            (a, s) for a in ("sag", "cor", "other_x_1", "other_y_2") for s in ("hcp", "tcia"))],
        "series_uid string, scan_axis string, jpgfiles array<string>, output_tag string, source string")
    path = os.path.join(tmpdir_path, "products")
    append_products(rows, path)
    assert sorted(os.listdir(os.path.join(path, "source=hcp"))) == [
        "axis_family=cor", "axis_family=other", "axis_family=sag"]
    found = K.images_by_name(K.build_cohorts(spark.read.parquet(path)), "notumor_sag")
    assert [(r.name, r.series_uid, r.scan_axis) for r in found.collect()] == [("notumor_sag", "s0", "sag")]
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines()
                if "PartitionFilters" in x)
    kept = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "axis_family" in kept and "source" in kept


def test_land_store_changes(spark, tmpdir_path):
    stores = spark.createDataFrame([(1, "alpha"), (2, "beta")], "uid int, name string")
    images = spark.createDataFrame([(10, "x", ["/a.jpg"], 1)],
                                   "uid long, name string, images array<string>, store_id int")
    names = [spark.createDataFrame([(n,) for n in ns], "name string")
             for ns in (["gamma", "beta", None], ["alpha", "gamma"])]
    path = os.path.join(tmpdir_path, "v2")
    J.land_store_changes(stores, images, *names, path)
    got = {r.name: r.uid for r in spark.read.parquet(path + "/stores").collect()}
    assert got.pop("gamma") > 2 and got == {"beta": 2}
    assert [r.store_id for r in spark.read.parquet(path + "/images").collect()] == [None]


def test_outcomes_and_markers(spark):
    wanted = spark.createDataFrame([(f"u{k}", k) for k in "abcd"], "series_uid string, object_key string")
    heads = spark.createDataFrame([("a", "ok", None), ("b", "ok", None), ("c", "error", "bad")],
                                  "object_key string, status string, message string")
    got = J.object_outcomes(wanted, heads, spark.createDataFrame([("ua",), ("ua",)], "series_uid string"))
    assert {r.object_key: (r.outcome, r.message) for r in got.collect()} == {
        "a": ("ok", None), "b": ("no metadata", None), "c": ("error", "bad"), "d": ("no file", None)}
    keys = spark.createDataFrame([("p/SAGE/P/D-1/3-T2-9/blob.zip",), ("p/C/P/D-1/3-SAG-9/blob.zip",),
                                  ("short",), (None,)], "object_key string")
    assert C.select_roi(keys).count() == 2
    assert [r.object_key for r in C.select_roi(keys, description_only=True).collect()] == [
        "p/C/P/D-1/3-SAG-9/blob.zip"]
    # Python's word characters: letters and numerals of any script, no marks or joiners
    import re
    text = "a\u0301\u200db\u00bd\u0661\u4e00\u203f_-"
    tag = spark.createDataFrame([(f"p/C/P/{text}/blob.zip",)], "k string").select(C.other_axis_tag("k")).first()[0]
    assert tag == re.sub(r"\W", "_", text)


def test_cohort_jobs(spark, tmpdir_path):
    stores = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "alpha")], "uid int, name string")
    images = spark.createDataFrame(
        [(10, "notumor_ax", ["/d/a%20b/x_0.jpg", "/d/x_1.jpg"], 1),
         (11, "notumor_ax", ["/d/y_0.jpg"], 2), (12, "withtumor_sag", [], None)],
        "uid long, name string, images array<string>, store_id int")
    out = os.path.join(tmpdir_path, "export")
    rows = J.export_cohort_job(images, "notumor_ax", out, "bkt").collect()
    assert sorted(r.entry for r in rows) == ["/d/a b/x_0.jpg", "/d/x_1.jpg", "/d/y_0.jpg"]
    assert {r.bundle for r in rows} == {"notumor_ax.zip"}
    first = J.store_job(stores, images, "bkt", name="alpha").collect()
    assert len(first) == 1 and first[0].store_uid == 1
    assert json.loads(first[0].json) == {"name": "alpha", "images": [
        {"name": "notumor_ax", "images": ["https://bkt.s3.amazonaws.com/d/a%20b/x_0.jpg",
                                          "https://bkt.s3.amazonaws.com/d/x_1.jpg"]}]}
    allj = {r.store_uid: json.loads(r.json) for r in J.store_job(stores, images, "bkt").collect()}
    assert allj[3] == {"name": "alpha", "images": []}
    ins, kept, imgs = J.store_changes_job(
        stores, images, spark.createDataFrame([("gamma",), ("alpha",), ("gamma",)], "name string"),
        spark.createDataFrame([("alpha",), ("nope",)], "name string"))
    st = {r.name: (r.status, r.uid) for r in ins.collect()}
    assert st["alpha"] == ("exists", 1) and st["gamma"][0] == "inserted" and st["gamma"][1] > 3
    assert sorted(r.uid for r in kept.collect()) == [2, 3]
    assert {r.uid: r.store_id for r in imgs.collect()} == {10: None, 11: 2, 12: None}


def test_bounded_store_pages(spark):
    stores = spark.createDataFrame([(1, "hot")], "uid int, name string")
    images = spark.range(0, 1000).select(F.col("id").alias("uid"), F.lit("s").alias("name"),
                                         F.array(F.lit("/p.jpg")).alias("images"),
                                         F.lit(1).alias("store_id"))
    pages = K.stores_json(stores, images, "bkt", page_size=128).collect()
    assert max(r.n_images for r in pages) <= 128
    assert sum(r.n_images for r in pages) == 1000


def test_requests_one_after_the_other(spark, tmpdir_path):
    import random
    r = random.Random(4)
    stores = [(i, f"n{i % 5}") for i in range(12)] + [(50, "alone"), (51, None)]
    images = [(100 + i, "x", ["/a"], u) for i, (u, _) in enumerate(stores)]
    names = [f"n{i}" for i in range(5)] + ["new1", "new2", "hot"]
    log = [(s, r.choice(["insert", "delete"]), "hot" if s % 3 == 0 else r.choice(names)) for s in range(60)]
    log += [(60, "insert", "back"), (61, "delete", "back"), (62, "insert", "back"), (63, "insert", None)]
    left = {n: sorted(u for u, m in stores if m == n) for n in {m for _, m in stores} | {n for _, _, n in log}}
    for _, op, n in log:
        if n is not None and op == "insert" and not left[n]:
            left[n] = ["new"]
        elif n is not None and op == "delete":
            left[n] = left[n][1:]
    path = os.path.join(tmpdir_path, "replayed")
    J.replay_store_requests(
        spark.createDataFrame(stores, "uid long, name string"),
        spark.createDataFrame(images, "uid long, name string, images array<string>, store_id int"),
        spark.createDataFrame(r.sample(log, len(log)), "seq long, op string, name string"), path)
    old = {u for u, _ in stores}
    got = spark.read.parquet(path + "/stores").collect()
    assert sorted(((x.name, x.uid if x.uid in old else "new") for x in got), key=str) == sorted(
        ((n, u) for n, us in left.items() for u in us), key=str)
    assert len({x.uid for x in got}) == len(got)
    stay = {u for us in left.values() for u in us}
    assert {x.uid: x.store_id for x in spark.read.parquet(path + "/images").collect()} == {
        i: u if u in stay else None for i, _, _, u in images}


def test_cases_without_their_links(spark):
    """A delivery is counted from its sets' sizes: the links need not be written."""
    rows = spark.createDataFrame([("a", "s1", 2), ("a", "s1", 3), ("b", "s2", 0), ("b", None, 1)],
                                 "name string, series_uid string, n_images int")
    state = K.case_state(rows, K.case_numbers(rows), F.col("n_images"))
    assert sorted(map(tuple, K.cases_of(state).collect())) == [("a", 2, 1, 5), ("b", 2, 1, 1)]


def test_bundle_parts(spark):
    import random
    r = random.Random(6)
    rows = [("big" if i % 3 else f"c{i % 7}", i, 0, r.choice([0, 10, 90, 250])) for i in range(400)] + [(None, 1, 0, 5)]
    df = spark.createDataFrame(rows, "name string, uid long, image_no int, bytes long").repartition(6)
    got = {(x.name, x.uid): (x.part, x.part_offset) for x in K.export_parts(df, 200).collect()}
    at, first, want = {}, {}, {}
    for name, uid, _, size in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        before = at.get(name, 0)
        part = before // 200
        want[name, uid] = (part, before - first.setdefault((name, part), before))
        at[name] = before + size
    assert got == want


def test_published_versions(spark, tmpdir_path):
    import pytest
    from cortexlake.sinks import writers as W
    path = os.path.join(tmpdir_path, "manifest")
    with pytest.raises(FileNotFoundError):
        W.read_published(spark, path, SC.MANIFEST_FILE)
    one = C.build_manifest(spark.createDataFrame(CATALOG, schema=SC.SERIES_CATALOG))
    W.publish(one, path)
    fail = F.udf(lambda x: 1 / 0, "string")
    with pytest.raises(Exception):
        W.publish(one.withColumn("object_key", fail("object_key")), path)      # dies while it writes
    assert W.read_published(spark, path, one.schema).count() == 3
    W.publish(one.limit(1), path)
    assert W.read_published(spark, path, one.schema).count() == 1
    last = W.published(spark, path)
    assert last["number"] == 2 and last["rows"] == 1 and last["files"] >= 1


def test_large_catalog_in_many_tasks(spark, tmpdir_path):
    import random
    r = random.Random(1)
    text = ["plain", 'a},{"b":1},{c', "},", "{}},{},{", 'say \\"hi\\"', "é中", "x" * 300, None, ""]
    rows = [{"Collection": r.choice(text), "PatientID": f"P{i}", "SeriesNumber": i, "Other": {"a": {"b": [1]}, "c": {}},
             "SeriesDescription": r.choice(text), "SeriesInstanceUID": f"1.{i}"} for i in range(300)]
    files = {"one_line": json.dumps(rows), "many_lines": json.dumps(rows, indent=2, ensure_ascii=False),
             "empty": "[]", "single": json.dumps(rows[:1])}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    spark.conf.set("spark.sql.files.openCostInBytes", "400b")
    try:
        for name, body in files.items():
            path = os.path.join(tmpdir_path, name + ".json")
            with open(path, "w") as f:
                f.write(body)
            got = SC.read_large_catalog(spark, path)
            want = SC.read_series_catalog(spark, path).filter("SeriesInstanceUID is not null")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        lines = spark.read.option("lineSep", "},").text(os.path.join(tmpdir_path, "one_line.json"))
        assert lines.rdd.getNumPartitions() > 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stored_stacks_are_normalised_where_they_lie(spark):
    import uuid

    from cortexlake.operators import slices as S
    rows = [(f"v{i % 5}", i % 2, i, [float(i * k % 7) for k in range(4)]) for i in range(60)] + [("n", 0, 0, [1.0, float("nan")])]
    df = spark.createDataFrame(rows, "volume_id string, axis int, slice_no int, pixels array<double>")
    table = f"stacks_{uuid.uuid4().hex}"
    S.write_stacks(df, table, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = S.minmax_normalise_stored(spark.table(table))
        plan = _plan(got)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(map(str, got.collect())) == sorted(map(str, S.minmax_normalise(df).select(got.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"drop table {table}")
