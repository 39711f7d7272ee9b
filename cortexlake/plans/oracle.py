"""DuckDB oracle SQL for the registered queries.

Only the driver's tables are registered in DuckDB, so the fixture views are
inlined as CTEs. Text rules are written in DuckDB's dialect (``'g'`` flag on
``regexp_replace``, ``list_*`` functions, ``lambda x:`` syntax).
"""

from __future__ import annotations

from .. import fixtures as fx
from ..functions import text as T

ORACLE: dict[str, str] = {}

OUT_DIR = "data/TCIA_output_v2"
HOST = "https://example-bucket.s3.amazonaws.com"
DOWNLOAD_BASE = "https://services.cancerimagingarchive.net/services/v4/TCIA/query/getImage?SeriesInstanceUID="


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_clean(col: str, mode: str) -> str:
    if mode == "twopass":
        expr, rules = f"upper(coalesce({col}, 'NULL'))", T.TWO_PASS_RULES
    else:
        expr = f"upper({col})"
        rules = [(r"\s+", "_") if p == T.PY_SPACE + "+" else (p, r) for p, r in T.ONE_PASS_RULES]
    for p, r in rules:
        expr = f"regexp_replace({expr}, {_q(p)}, {_q(r)}, 'g')"
    return expr if mode == "twopass" else f"coalesce({expr}, 'NULL')"


def sql_key(mode: str) -> str:
    def nf(c):
        return f"coalesce({c}, 'NULL')"
    if mode == "twopass":
        prefix = T.TWO_PASS_PREFIX
        ss = f"substr({nf('StudyInstanceUID')}, 60, 5)"
        si = f"substr({nf('SeriesInstanceUID')}, 60, 5)"
    else:
        prefix = T.ONE_PASS_PREFIX
        ss = nf("right(StudyInstanceUID, 5)")
        si = nf("right(SeriesInstanceUID, 5)")
    return (f"concat('{prefix}/', {nf('Collection')}, '/', {nf('PatientID')}, '/', "
            f"{nf('SeriesDate')}, '-', {ss}, '/', {nf('SeriesNumber')}, '-', "
            f"{sql_clean('SeriesDescription', mode)}, '-', {si}, '/blob.zip')")


def sql_tag(key: str) -> str:
    parts = f"string_split(replace({key}, '/blob.zip', ''), '/')"
    return f"array_to_string(list_slice({parts}, 4, len({parts})), '@')"


def sql_axis(key: str) -> str:
    u = f"upper({key})"
    return (f"case when contains({u}, 'SAG') then 'sag' when contains({u}, 'COR') then 'cor' "
            f"when contains({u}, 'AXIAL') or contains({u}, 'AX_') then 'ax' "
            f"else concat('other_', regexp_replace({sql_tag(key)}, '\\W', '_', 'g')) end")


def sql_quote(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


MANIFEST_CTE = (f"manifest as (select coalesce(SeriesInstanceUID, 'NULL') as series_uid, "
                f"{sql_key('twopass')} as object_key, * from series_catalog)")


def with_catalog(body: str, manifest: bool = False) -> str:
    ctes = [fx.SERIES_CATALOG_SQL] + ([MANIFEST_CTE] if manifest else [])
    return "with " + ",\n".join(ctes) + "\n" + body


def oracle(name: str, sql: str):
    ORACLE[name] = sql


# ----------------------------------------------------------------- catalog
oracle("null_fill", with_catalog(
    "select SeriesInstanceUID as series_uid, coalesce(Collection, 'NULL') as collection, "
    "coalesce(SeriesNumber, 'NULL') as series_number, "
    "coalesce(SeriesDescription, 'NULL') as series_description from series_catalog"))
oracle("clean_description_twopass", with_catalog(
    f"select SeriesInstanceUID as series_uid, {sql_clean('SeriesDescription', 'twopass')} "
    f"as clean_description from series_catalog"))
oracle("clean_description_onepass", with_catalog(
    f"select SeriesInstanceUID as series_uid, {sql_clean('SeriesDescription', 'onepass')} "
    f"as clean_description from series_catalog"))
oracle("uid_suffix_fixed", with_catalog(
    "select SeriesInstanceUID as series_uid, substr(StudyInstanceUID, 60, 5) as study_sfx, "
    "substr(SeriesInstanceUID, 60, 5) as instance_sfx from series_catalog"))
oracle("uid_suffix_last5", with_catalog(
    "select SeriesInstanceUID as series_uid, right(StudyInstanceUID, 5) as study_sfx, "
    "right(SeriesInstanceUID, 5) as instance_sfx from series_catalog"))
oracle("object_key", with_catalog("select series_uid, object_key from manifest", True))
oracle("published_manifest", ORACLE["object_key"])
oracle("object_key_onepass", with_catalog(
    f"select SeriesInstanceUID as series_uid, {sql_key('onepass')} as object_key from series_catalog"))
oracle("select_roi", with_catalog(
    "select series_uid, object_key from manifest where contains(object_key, 'SAG') or "
    "contains(object_key, 'COR') or contains(object_key, 'AXIAL') or contains(object_key, 'AX_')",
    True))
oracle("select_roi_description", with_catalog(
    "select series_uid, object_key from (select *, string_split(object_key, '/')[-2] as d from manifest) "
    "where contains(d, 'SAG') or contains(d, 'COR') or contains(d, 'AXIAL') or contains(d, 'AX_')", True))
oracle("classify_axis", with_catalog(
    f"select series_uid, {sql_axis('object_key')} as scan_axis from manifest", True))
oracle("axis_counts", with_catalog(
    f"select case when starts_with(a, 'other_') then 'other' else a end as axis, "
    f"count(*) as n_series from (select {sql_axis('object_key')} as a from manifest) group by 1",
    True))
oracle("object_tag", with_catalog(
    f"select series_uid, {sql_tag('object_key')} as object_tag from manifest", True))
oracle("output_prefix", with_catalog(
    f"select series_uid, concat('{OUT_DIR}/', {sql_tag('object_key')}) as output_prefix "
    f"from manifest", True))
oracle("job_tag", with_catalog(
    "select series_uid, replace(replace(object_key, '/blob.zip', ''), '/', '-') as job_tag "
    "from manifest", True))
oracle("source_request_url", with_catalog(
    f"select SeriesInstanceUID as series_uid, concat({_q(DOWNLOAD_BASE)}, SeriesInstanceUID) "
    f"as request_url from series_catalog"))
oracle("output_tag", with_catalog(
    f"select series_uid, replace(replace(replace(string_split(concat('/work/', "
    f"{sql_tag('object_key')}, '/', PatientID, '_3T_', coalesce(SeriesDescription, ''), "
    f"'.nii.gz'), '/')[-1], '.nii.gz', ''), '(', ''), ')', '') as output_tag from manifest", True))
oracle("volume_key_from_subject",
       "select c_custkey as subject, "
       "format('HCP_1200/{0}/unprocessed/3T/T1w_MPR1/{0}_3T_T1w_MPR1.nii.gz', c_custkey) as volume_key, "
       "concat('hcp_subject_', c_custkey) as object_tag, "
       "concat('subject', c_custkey, '_3T_T1w_MPR1_cor') as output_tag from customer")

# ------------------------------------------------------------------- links
oracle("url_quote", f"select page_id, {sql_quote('url')} as quoted from pages")
oracle("url_quote_keys", with_catalog(
    f"select series_uid, {sql_quote('object_key')} as quoted from manifest", True))
oracle("url_unquote",
       f"select page_id, url_decode({sql_quote('url')}) as round_trip, url_decode(url) as unquoted "
       f"from pages")
oracle("public_url", with_catalog(
    f"select series_uid, concat('{HOST}/', {sql_quote('object_key')}) as landing_url, "
    f"concat('{HOST}', '/', object_key) as api_url from manifest", True))
_LINK_KEY = f"concat('{OUT_DIR}/', {sql_tag('object_key')}, '/', clean_description, '_', i, '.jpg')"
oracle("enumerate_links", with_catalog(
    f"select series_uid, n_slices, cast(n_slices as int) as n_links, "
    f"array_to_string(list_transform(range(0, n_slices), lambda i: concat('{HOST}/', "
    f"{sql_quote(_LINK_KEY)})), '|') "
    f"as links from (select *, {sql_clean('SeriesDescription', 'twopass')} as clean_description "
    f"from manifest)", True))

# ------------------------------------------------------------------ slices
# DuckDB's double -> int cast rounds half to even; the bounds rule truncates
SLICE_BOUNDS = ("cast(trunc(case when b < 0 then 0 else b end) as int) as b0, "
                "cast(trunc(case when e >= dim then dim - 1 else e end) as int) as e0")


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


CENTRAL50 = (with_ctes(fx.SLICE_STACK_SQL) +
             "select * from (select *, " + SLICE_BOUNDS + " from (select *, dim / 2 - 25.0 as b, "
             "dim / 2 + 25.0 as e from slice_stack) s) t where slice_no >= b0 and slice_no < e0")
oracle("slice_central", f"select volume_id, slice_no, dim from ({CENTRAL50})")
oracle("slice_range", with_ctes(fx.SLICE_STACK_SQL) +
       "select volume_id, slice_no, dim from slice_stack where slice_no >= least(5, dim) "
       "and slice_no < greatest(dim - 5, 0)")

# a plane along each axis: sagittal [y][z], coronal [x][z], axial [x][y]
_PLANE = {0: ("ny", "nz", "nx"), 1: ("nx", "nz", "ny"), 2: ("nx", "ny", "nz")}
_VOX = {0: "j + nx * r + nx * ny * c", 1: "r + nx * j + nx * ny * c", 2: "r + nx * c + nx * ny * j"}
# row and column in the plane that position p of the rotated slice comes from
_FROM = {0: ("p // w", "p % w"), 1: ("p % h", "w - 1 - p // h"),
         2: ("h - 1 - p // w", "w - 1 - p % w"), 3: ("h - 1 - p % h", "p // h")}


def _slices_sql(axis: int, rot: int = 0, where: str = "true", first: str = "0",
                end: str = "ext") -> str:
    h, w, ext = _PLANE[axis]
    r, c = _FROM[rot]
    oh, ow = ("w", "h") if rot % 2 else ("h", "w")
    return (f"select volume_id, cast(j - f as int) as slice_no, cast({oh} as int) as height, "
            f"cast({ow} as int) as width, cast(p as int) as pixel, voxels[{_VOX[axis]} + 1] as value "
            f"from (select *, {r} as r, {c} as c from (select *, unnest(range(0, h * w)) as p "
            f"from (select *, unnest(range(f, e)) as j from (select *, {first} as f, {end} as e "
            f"from (select *, {h} as h, {w} as w, {ext} as ext from volumes3d where {where})))))")


_VOLUMES = with_ctes(fx.VOLUMES3D_SQL)
for _a, _name in enumerate(("sag", "cor", "ax")):
    oracle(f"slice_all_{_name}", _VOLUMES +
           f"select volume_id, cast({_a} as int) as axis, slice_no, pixel, value from ({_slices_sql(_a)})")

_THIN = "list_position([nx, ny, nz], least(nx, ny, nz)) = {} + 1"
oracle("slice_all_thinnest", _VOLUMES + " union all ".join(
    f"select volume_id, cast({_a} as int) as axis, slice_no, pixel, value from ({_slices_sql(_a, where=_THIN.format(_a))})"
    for _a in range(3)))

for _k in (1, 2, 3):
    oracle(f"rot90_{_k}", _VOLUMES +
           f"select volume_id, slice_no, height, width, pixel, value from ({_slices_sql(2, _k)})")

_SHAPES3 = with_ctes(fx.VOLUME_SHAPES_SQL)
oracle("detect_slice_axis", _SHAPES3 +
       "select volume_id, cast(list_position(shape, list_min(shape)) - 1 as int) as slice_axis "
       "from volume_shapes where len(shape) = 3")
oracle("skip_non_3d", _SHAPES3 +
       "select volume_id, cast(len(shape) as int) as n_dims from volume_shapes where len(shape) = 3")
oracle("inplane_resolution", _SHAPES3 +
       "select volume_id, slice_axis, "
       "cast(case when slice_axis = 0 then pixdim[3] else pixdim[2] end as double) as res_x, "
       "cast(case when slice_axis = 2 then pixdim[3] else pixdim[4] end as double) as res_y from "
       "(select *, cast(list_position(shape, list_min(shape)) - 1 as int) as slice_axis "
       "from volume_shapes where len(shape) = 3)")

_NORM = (f"with kept as ({CENTRAL50}), "
         "ext as (select volume_id, min(list_min(pixels)) as gmin, max(list_max(pixels)) as gmax "
         "from kept group by volume_id), "
         "px as (select k.volume_id, k.slice_no, unnest(range(0, 64)) as pixel, k.pixels, "
         "e.gmin, e.gmax from kept k join ext e on k.volume_id = e.volume_id) ")
oracle("minmax_normalise", _NORM +
       "select cast(volume_id as varchar) as volume_id, slice_no, cast(pixel as int) as pixel, "
       "case when gmax = gmin then 'NaN'::double else (pixels[pixel + 1] - gmin) / (gmax - gmin) end "
       "as value from px")
oracle("minmax_normalise_stored", ORACLE["minmax_normalise"])
oracle("scale_range_check", _NORM +
       ", nv as (select volume_id, (pixels[pixel + 1] - gmin) / (gmax - gmin) as v from px) "
       "select cast(volume_id as varchar) as volume_id, min(v) as scale_min, max(v) as scale_max, "
       "min(v) = 0 and max(v) = 1 as in_unit_range from nv group by volume_id")
oracle("display_scale", with_ctes(fx.SLICE_STACK_SQL) +
       "select cast(volume_id as varchar) as volume_id, slice_no, cast(pixel as int) as pixel, "
       "cast(case when mx = mn then 0 else least(floor((pixels[(7 - pixel // 8) * 8 + pixel % 8 + 1] - mn) "
       "/ (mx - mn) * 256), 255) end as int) as value from "
       "(select *, list_min(pixels) as mn, list_max(pixels) as mx, unnest(range(0, 64)) as pixel "
       "from slice_stack) s")
oracle("axis_fanout",
       "select subject, axis, axis_name, "
       "format('HCP_1200/{0}/unprocessed/3T/T1w_MPR1/{0}_3T_T1w_MPR1.nii.gz', subject) as volume_key, "
       "concat('data/HCP_output_v1/hcp_subject_', subject) as output_prefix, "
       "concat('subject', subject, '_3T_T1w_MPR1_', axis_name) as output_tag from "
       "(select c_custkey as subject, unnest([{'axis': 0, 'axis_name': 'sag'}, "
       "{'axis': 1, 'axis_name': 'cor'}, {'axis': 2, 'axis_name': 'ax'}], recursive := true) "
       "from customer)")

# ------------------------------------------------------------------ decode
# the files that can be read: not damaged, three extents
_READ = "volume_id % 25 <> 3 and volume_id % 10 <> 9"
oracle("decode_volumes", _VOLUMES + " union all ".join(
    f"select cast(volume_id as varchar) as volume_id, cast({a} as int) as axis, slice_no, pixel, value "
    f"from ({_slices_sql(a, where=f'{_READ} and volume_id % 3 = {m}')})"
    for m, a in enumerate((0, 2, 1))))
# two central slices along z (one where z has two), a quarter turn, normalised
# over the stack
oracle("decode_normalised", _VOLUMES +
       "select cast(volume_id as varchar) as volume_id, cast(2 as int) as axis, slice_no, height, width, pixel, "
       "case when gmax = gmin then 'NaN'::double else (value - gmin) / (gmax - gmin) end as value from "
       "(select *, min(value) over (partition by volume_id) as gmin, "
       "max(value) over (partition by volume_id) as gmax from ("
       + _slices_sql(2, 1, _READ, "ext // 2 - 1",
                     "case when ext // 2 + 1 >= ext then ext - 1 else ext // 2 + 1 end") + "))")
oracle("decode_headers", _VOLUMES +
       "select cast(volume_id as varchar) as volume_id, case when volume_id % 25 = 3 then 'error' "
       "when volume_id % 10 = 9 then 'skipped' else 'ok' end as status, "
       "case when volume_id % 25 = 3 then null when volume_id % 10 = 9 then '2x4x4x2' "
       "else concat(nx, 'x', ny, 'x', nz) end as shape, "
       "case when volume_id % 25 = 3 then null else cast(0.5 as double) end as spacing_x from volumes3d")

# ---------------------------------------------------------------- metadata
_FIRST = ("first_meta as (select series_key, m.SeriesInstanceUID, m.SeriesDate, m.Manufacturer, "
          "m.ManufacturerModelName, m.spacing_x, m.spacing_y from (select series_key, "
          "min(struct_pack(_f := file_name, SeriesInstanceUID := SeriesInstanceUID, "
          "SeriesDate := SeriesDate, Manufacturer := Manufacturer, "
          "ManufacturerModelName := ManufacturerModelName, spacing_x := spacing_x, "
          "spacing_y := spacing_y)) as m from dicom_files group by series_key) t)")
oracle("first_file_metadata", with_ctes(fx.DICOM_FILES_SQL, _FIRST) +
       "select series_key, SeriesDate, Manufacturer, ManufacturerModelName, "
       "cast(spacing_x as double) as spacing_x, cast(spacing_y as double) as spacing_y from first_meta")

_TAG_FILE = (f"replace(replace(replace(string_split(concat('/work/', {sql_tag('object_key')}, '/', "
             f"PatientID, '_3T_', coalesce(SeriesDescription, ''), '.nii.gz'), '/')[-1], "
             f"'.nii.gz', ''), '(', ''), ')', '')")


def _links_sql(prefix: str, tag: str, n: str) -> str:
    key = f"concat({prefix}, '/', {tag}, '_', i, '.jpg')"
    return (f"array_to_string(list_transform(range(0, {n}), lambda i: concat('{HOST}/', "
            f"{sql_quote(key)})), '|')")


oracle("series_metadata", with_ctes(fx.SERIES_CATALOG_SQL, MANIFEST_CTE, fx.DICOM_FILES_SQL, _FIRST) +
       "select coalesce(f.SeriesInstanceUID, 'None') as series_uid, coalesce(f.SeriesDate, 'None') as series_date, "
       f"{sql_axis('m.object_key')} as scan_axis, coalesce(f.Manufacturer, 'None') as manufacturer, "
       "coalesce(f.ManufacturerModelName, 'None') as model_name, "
       "coalesce(f.spacing_x, 'None') as pixel_spacing_x, coalesce(f.spacing_y, 'None') as pixel_spacing_y, "
       "cast(m.n_slices as int) as n_links, "
       + _links_sql(f"concat('{OUT_DIR}/', {sql_tag('m.object_key')})", "m.tag", "m.n_slices") +
       f" as jpgfiles from (select *, {_TAG_FILE} as tag from manifest) m "
       "join first_meta f on m.series_uid = f.series_key")

oracle("product_sink_columns",
       'select series_uid as "series instance uid", series_date as "series date", scan_axis as "scan axis", '
       'manufacturer, model_name as "manufacturer model name", pixel_spacing_x as "pixel spacing-x", '
       f'pixel_spacing_y as "pixel spacing-y", jpgfiles from ({ORACLE["series_metadata"]})')
oracle("job_outcomes", with_ctes(fx.SERIES_CATALOG_SQL, MANIFEST_CTE, fx.DICOM_FILES_SQL) +
       "select series_uid, object_key, case when n_slices = 0 then 'no file' when s <> 'ok' then s "
       "when series_uid not in (select series_key from dicom_files) then 'no metadata' else 'ok' end as outcome, "
       "case when n_slices > 0 and s <> 'ok' then 'header: ' || s end as message from (select *, "
       "case when n_slices = 1 then 'skipped' when SeriesNumber is null then 'error' else 'ok' end as s "
       "from manifest) where contains(object_key, 'SAG') or contains(object_key, 'COR') or "
       "contains(object_key, 'AXIAL') or contains(object_key, 'AX_')")

_SUBJ_AX = ("subj as (select volume_id as subject, shape, pixdim, axis, axis_name, "
            "shape[axis + 1] as dim from (select *, unnest([{'axis': 0, 'axis_name': 'sag'}, "
            "{'axis': 1, 'axis_name': 'cor'}, {'axis': 2, 'axis_name': 'ax'}], recursive := true) "
            "from volume_shapes where len(shape) = 3) v)")
oracle("subject_metadata", with_ctes(fx.VOLUME_SHAPES_SQL, _SUBJ_AX) +
       "select cast(subject as varchar) as series_uid, 'NORECORD' as series_date, axis_name as scan_axis, "
       "'SIEMENS' as manufacturer, 'SKYRA' as model_name, "
       "cast(cast(case when axis = 0 then pixdim[3] else pixdim[2] end as double) as varchar) as pixel_spacing_x, "
       "cast(cast(case when axis = 2 then pixdim[3] else pixdim[4] end as double) as varchar) as pixel_spacing_y, "
       "cast(greatest(e0 - b0, 0) as int) as n_links, "
       + _links_sql("concat('data/HCP_output_v1/hcp_subject_', subject)",
                    "concat('subject', subject, '_3T_T1w_MPR1_', axis_name)", "greatest(e0 - b0, 0)") +
       " as jpgfiles from (select *, " + SLICE_BOUNDS + " from (select *, dim / 2 - 25.0 as b, "
       "dim / 2 + 25.0 as e from subj) s) t")

# whole volume jobs: of sound files; each volume's thinnest extent is two
_SERIES_TAG = "concat(PatientID, '_3T', SeriesDate)"
oracle("series_products", with_ctes(fx.SERIES_CATALOG_SQL, MANIFEST_CTE, fx.DICOM_FILES_SQL, _FIRST) +
       "select distinct coalesce(f.SeriesInstanceUID, 'None') as series_uid, coalesce(f.SeriesDate, 'None') as series_date, "
       f"{sql_axis('m.object_key')} as scan_axis, case when {sql_axis('m.object_key')} like 'other%' then 'other' "
       f"else {sql_axis('m.object_key')} end as axis_family, coalesce(f.Manufacturer, 'None') as manufacturer, "
       "coalesce(f.ManufacturerModelName, 'None') as model_name, "
       "coalesce(f.spacing_x, 'None') as pixel_spacing_x, coalesce(f.spacing_y, 'None') as pixel_spacing_y, "
       "m.tag as output_tag, "
       + _links_sql(f"concat('{OUT_DIR}/', {sql_tag('m.object_key')})", "m.tag", "2") +
       f" as jpgfiles from (select *, {_SERIES_TAG} as tag from manifest where contains(object_key, 'SAG') or "
       "contains(object_key, 'COR') or contains(object_key, 'AXIAL') or contains(object_key, 'AX_')) m "
       "join first_meta f on m.series_uid = f.series_key join embeddings e on m.series_uid = "
       f"concat('{fx.SERIES_ROOT}', lpad(cast(vec_id as varchar), 40, '7')) where "
       + _READ.replace("volume_id", "vec_id"))
_LANDED = with_ctes(fx.VOLUMES3D_SQL, "landed as (select volume_id as subject, axis, axis_name, "
                    "case axis when 0 then nx when 1 then ny else nz end as dim, "
                    "cast(case axis when 0 then ny else nx end as int) as height, "
                    "cast(case axis when 2 then ny else nz end as int) as width "
                    "from (select *, unnest([{'axis': 0, 'axis_name': 'sag'}, {'axis': 1, 'axis_name': 'cor'}, "
                    "{'axis': 2, 'axis_name': 'ax'}], recursive := true) from volumes3d "
                    f"where {_READ} and volume_id in (select c_custkey from customer)) v)")
_SUBJECT_TAG = "concat('subject', subject, '_3T_T1w_MPR1_', axis_name)"
oracle("subject_products", _LANDED +
       "select cast(subject as varchar) as series_uid, 'NORECORD' as series_date, axis_name as scan_axis, "
       "'SIEMENS' as manufacturer, 'SKYRA' as model_name, "
       "case axis when 0 then '0.75' else '0.5' end as pixel_spacing_x, "
       f"case axis when 2 then '0.75' else '1.25' end as pixel_spacing_y, {_SUBJECT_TAG} as output_tag, "
       + _links_sql("concat('data/HCP_output_v1/hcp_subject_', subject)", _SUBJECT_TAG, "dim - 1") +
       " as jpgfiles from landed")
oracle("slice_targets", _LANDED +
       "select cast(subject as varchar) as subject, cast(axis as int) as axis, cast(i as int) as slice_no, "
       "height, width, cast(height * width as int) as n_pixels, "
       f"concat('data/HCP_output_v1/hcp_subject_', subject, '/', {_SUBJECT_TAG}, '_', i, '.jpg') as target_key "
       "from (select *, unnest(range(0, dim - 1)) as i from landed) s")

# ----------------------------------------------------------------- cohorts
_CLEAN2 = sql_clean("SeriesDescription", "twopass")
_PROD = ("products as (select series_uid, " + sql_axis("object_key") + " as scan_axis, "
         f"list_transform(range(0, n_slices), lambda i: concat('/', "
         f"{sql_quote(chr(39) + OUT_DIR + chr(39) + ' || ' + chr(39) + '/' + chr(39) + ' || ' + sql_tag('object_key') + ' || ' + chr(39) + '/' + chr(39) + ' || ' + _CLEAN2 + ' || ' + chr(39) + '_' + chr(39) + ' || i || ' + chr(39) + '.jpg' + chr(39))})) as paths, "
         f"cast(n_slices as int) as n_links, {_CLEAN2} as output_tag, source from manifest)")
_COH = ("cohorts as (select case when source = 'hcp' then 'notumor' else 'withtumor' end || '_' || scan_axis "
        "as name, series_uid, scan_axis, paths as images from products where scan_axis in ('sag', 'cor', 'ax'))")
_CP = with_ctes(fx.SERIES_CATALOG_SQL, MANIFEST_CTE, _PROD, _COH)

oracle("cohort_union", _CP + "select series_uid, source, scan_axis, n_links from products")
oracle("build_cohorts", _CP +
       "select name, series_uid, cast(len(images) as int) as n_images, array_to_string(images, '|') as images "
       "from cohorts")
oracle("count_cases", _CP +
       "select name, count(*) as n_sets, count(distinct series_uid) as n_cases, "
       "cast(sum(len(images)) as bigint) as n_images from cohorts group by name")
oracle("count_cases_merged", ORACLE["count_cases"])
oracle("images_by_name", _CP +
       "select name, series_uid, cast(len(images) as int) as n_images from cohorts where name = 'notumor_sag'")
oracle("first_store_by_name", _CP +
       "select name, m.series_uid, m.scan_axis from (select name, "
       "min(struct_pack(series_uid := series_uid, scan_axis := scan_axis)) as m from cohorts group by name) t")
oracle("export_cohort", _CP +
       "select name, name || '.zip' as bundle, cast(image_no as int) as image_no, url_decode(image) as entry, "
       f"'{HOST}' || image as url from (select name, unnest(images) as image, "
       "unnest(range(0, len(images))) as image_no from cohorts) t")
oracle("export_parts", _CP +
       "select name, part, cast(row_number() over (partition by name, part order by series_uid, image_no, entry) as int) "
       "as entry_no, entry, bytes, before - min(before) over (partition by name, part) as part_offset from "
       "(select *, cast(before // 65536 as bigint) as part from (select *, cast(sum(bytes) over (partition by name "
       "order by series_uid, image_no, entry) - bytes as bigint) as before from (select *, "
       "cast(1000 + 37 * length(entry) % 4096 as bigint) as bytes from (select name, series_uid, image_no, "
       "url_decode(image) as entry from (select name, series_uid, unnest(images) as image, "
       "unnest(range(0, len(images))) as image_no from cohorts) t) u) v) w) x")
_SI = with_ctes(fx.STORE_SQL, fx.IMAGE_SET_SQL)
oracle("store_images", _SI +
       "select s.uid as store_uid, s.name as store_name, i.uid as image_uid, i.name as image_name, "
       "cast(len(i.images) as int) as n_images from store s left join image_set i on s.uid = i.store_id")
oracle("image_json", _SI +
       f"select uid, cast(to_json(struct_pack(name := name, images := list_transform(images, "
       f"lambda p: '{HOST}' || p))) as varchar) as json from image_set")
oracle("image_list_json", _CP +
       f"select name, cast(to_json(struct_pack(name := name, images := list_transform(images, "
       f"lambda p: '{HOST}' || p))) as varchar) as json from cohorts")
oracle("stores_json", _SI +
       "select store_uid, page, cast(count(image_uid) as int) as n_images, "
       "cast(to_json(struct_pack(name := store_name, images := coalesce(list(struct_pack(name := image_name, "
       f"images := list_transform(images, lambda p: '{HOST}' || p)) order by image_uid) "
       "filter (where image_uid is not null), []))) as varchar) as json "
       "from (select s.uid as store_uid, s.name as store_name, i.uid as image_uid, i.name as image_name, "
       "i.images, cast(coalesce(i.uid % p.pages, 0) as bigint) as page "
       "from store s left join image_set i on s.uid = i.store_id left join (select store_id, "
       "cast(ceil(count(*) / 256.0) as bigint) as pages from image_set group by store_id) p "
       "on s.uid = p.store_id) t group by store_uid, store_name, page")
_NEW_UID = "cast('0x' || substr(md5(n.name), 1, 15) as bigint)"
oracle("insert_if_absent", with_ctes(fx.STORE_SQL) +
       f"select n.name, coalesce(s.uid, {_NEW_UID}) as uid, "
       "case when s.uid is null then 'inserted' else 'exists' end as status, "
       "cast(s.uid as bigint) as existing_uid from (select distinct name from (select r_name as name from region "
       "union all select n_name from nation union all select c_mktsegment from customer) u "
       "where name is not null) n left join (select name, min(uid) as uid from store group by name) s "
       "on n.name = s.name")
_DEL = ("gone as (select min(uid) as uid from store where name in (select n_name from nation "
        "where n_regionkey in (select r_regionkey from region where r_name = 'EUROPE')) group by name)")
oracle("store_by_name", with_ctes(fx.STORE_SQL) +
       "select uid, name from store where name = 'NATION_7' order by uid limit 1")
oracle("stores_after_changes", with_ctes(fx.STORE_SQL, _DEL) +
       "select cast(uid as bigint) as uid, name from store where uid not in (select uid from gone) union all "
       f"select {_NEW_UID}, n.name from (select r_name as name from region union select n_name from nation "
       "union select c_mktsegment from customer) n "
       "where n.name is not null and n.name not in (select name from store)")
oracle("delete_by_name", with_ctes(fx.STORE_SQL, _DEL) +
       "select uid, name from store where uid not in (select uid from gone)")
oracle("delete_by_name_images", with_ctes(fx.STORE_SQL, fx.IMAGE_SET_SQL, _DEL) +
       "select uid, name, case when store_id in (select uid from gone) then null else store_id end "
       "as store_id from image_set")
# the requests one after the other, by brute force over a name's whole sequence
oracle("stores_replayed", "with recursive " + ", ".join((
       fx.STORE_SQL, fx.STORE_REQUESTS_SQL,
       "r as (select *, row_number() over (partition by name order by seq) as i from store_requests)",
       "o as (select name, list(cast(uid as bigint) order by uid) as uids from store group by name)",
       "n as (select name from store union select name from store_requests where name is not null)",
       "step as (select n.name, cast(0 as bigint) as i, coalesce(o.uids, cast([] as bigint[])) as uids from n "
       "left join o on o.name = n.name union all select s.name, r.i, case when r.op = 'insert' and len(s.uids) = 0 "
       f"then [{_NEW_UID.replace('n.name', 's.name')}] when r.op = 'delete' then list_slice(s.uids, 2, len(s.uids)) "
       "else s.uids end from step s join r on r.name = s.name and r.i = s.i + 1)")) +
       " select unnest(uids) as uid, name from (select name, arg_max(uids, i) as uids from step group by name) t")
oracle("pending_manifest", with_ctes(fx.SERIES_CATALOG_SQL, MANIFEST_CTE, fx.DICOM_FILES_SQL) +
       "select series_uid, object_key from manifest where series_uid not in "
       "(select series_key from dicom_files)")
oracle("count_completed",
       "select count(*) filter (where event_type <> 'error') as n_ok, count(*) as n_total from events")

# ----------------------------------------------------------------- archives
oracle("explode_archives",
       "select cast(page_id as varchar) as object_key, 'index.html' as member, "
       "cast(octet_length(encode(coalesce(html, ''))) as bigint) as n_bytes, 'ok' as status from pages "
       "union all select cast(page_id as varchar), 'meta/url.txt', "
       "cast(octet_length(encode(coalesce(url, ''))) as bigint), 'ok' from pages")
