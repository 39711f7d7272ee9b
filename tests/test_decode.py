"""Round trips of files: NIfTI volumes and zip archives written to a temp dir
and read back through Spark's whole-file source."""

from __future__ import annotations

import gzip
import io
import os
import zipfile
import zlib

import numpy as np

from cortexlake.sources import archives as A
from cortexlake.sources import volumes as V


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_header_layout_roundtrip():
    v = np.arange(60, dtype=np.int16).reshape((3, 4, 5), order="F")
    raw = V.encode_nifti(v, (1.0, 0.9, 0.8, 0.7), datatype=4, compress=False)
    assert len(raw) == 352 + 60 * 2
    hdr, data = V.decode_nifti(gzip.compress(raw))
    assert hdr["shape"] == [3, 4, 5] and hdr["magic"] == b"n+1\x00"
    assert np.allclose(hdr["pixdim"][:4], [1.0, 0.9, 0.8, 0.7])
    assert np.array_equal(data, v.astype(float))


def test_decode_job_thinnest_and_reports(spark, tmpdir_path):
    rng = np.random.default_rng(5)
    a = rng.integers(-100, 100, size=(3, 4, 5)).astype(np.int16)
    b = rng.integers(0, 50, size=(6, 2, 4)).astype(np.int16)
    const = np.full((2, 3, 3), 5, dtype=np.float32)
    withnan = rng.normal(size=(4, 4, 2)).astype(np.float32)
    withnan[1, 1, 1] = np.nan
    four_d = np.zeros((2, 2, 2, 2), dtype=np.float32)
    d = tmpdir_path
    _write(f"{d}/a.nii.gz", V.encode_nifti(a, datatype=4))
    _write(f"{d}/b.nii.gz", V.encode_nifti(b, datatype=4))
    _write(f"{d}/c.nii.gz", V.encode_nifti(const))
    _write(f"{d}/n.nii.gz", V.encode_nifti(withnan))
    _write(f"{d}/q.nii.gz", V.encode_nifti(four_d))
    _write(f"{d}/t.nii.gz", V.encode_nifti(a, datatype=4)[:40])   # truncated
    files = V.read_volume_files(spark, d)
    dec = V.decode_volumes(files, mode="thinnest", normalise=True)
    heads = {os.path.basename(r.volume_id): r for r in V.headers_of(dec).collect()}
    assert heads["a.nii.gz"].status == "ok" and heads["a.nii.gz"].shape == [3, 4, 5]
    assert heads["q.nii.gz"].status == "skipped"
    assert heads["t.nii.gz"].status == "error"
    sl = {}
    for r in V.slices_of(dec).collect():
        sl.setdefault(os.path.basename(r.volume_id), {})[r.slice_no] = r
    # a: thinnest axis 0, normalised over the whole stack
    ref = a.astype(float)
    ref = (ref - ref.min()) / (ref.max() - ref.min())
    assert sorted(sl["a.nii.gz"]) == [0, 1, 2]
    for j, r in sl["a.nii.gz"].items():
        assert r.axis == 0 and (r.height, r.width) == (4, 5)
        assert np.allclose(r.pixels, ref[j].ravel())
    # b: thinnest axis 1
    assert {r.axis for r in sl["b.nii.gz"].values()} == {1}
    # constant and NaN stacks are all NaN, as with NumPy
    assert all(np.isnan(r.pixels).all() for r in sl["c.nii.gz"].values())
    assert all(np.isnan(np.array(r.pixels, dtype=float)).all() for r in sl["n.nii.gz"].values())
    assert "q.nii.gz" not in sl and "t.nii.gz" not in sl


def test_decode_job_central_three_axes(spark, tmpdir_path):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(10, 12, 8)).astype(np.float32)
    _write(f"{tmpdir_path}/s.nii.gz", V.encode_nifti(v))
    dec = V.decode_volumes(V.read_volume_files(spark, tmpdir_path), mode="central", n=4, rot=1)
    rows = V.slices_of(dec).collect()
    vv = v.astype(float)
    for axis in (0, 1, 2):
        b, e = V.central_range(v.shape[axis], 4)
        planes = [np.rot90(vv[j] if axis == 0 else (vv[:, j] if axis == 1 else vv[:, :, j]), 1)
                  for j in range(b, e)]
        st = np.asarray(planes)
        st = (st - st.min()) / (st.max() - st.min())
        got = sorted((r.slice_no, r) for r in rows if r.axis == axis)
        assert [s for s, _ in got] == list(range(e - b))
        for s, r in got:
            assert np.allclose(r.pixels, st[s].ravel())


def test_slices_in_bounded_turns():
    """Any room gives the same slices; a file is read again for each turn."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(7, 9, 5)).astype(np.float32)
    raw, opened = V.encode_nifti(v), []

    def open_file():
        opened.append(1)
        return io.BytesIO(raw)

    picks = [(0, 0, 7), (1, 2, 8), (2, 1, 4)]
    for room in (1, 1000, 1 << 20):
        opened.clear()
        got = {(i, j): s for i, j, s in V.volume_slices(V.PlaneReader(open_file, 64), picks, False, room)}
        assert len(got) == 7 + 6 + 3
        for (i, j), s in got.items():
            assert np.array_equal(s, np.take(v.astype(float), picks[i][1] + j, axis=picks[i][0]))
        turns = V._turns([7, 9, 5], picks, room)
        assert len(opened) == 2 + len(turns)
        size = [9 * 5 * 8, 7 * 5 * 8, 0]
        assert all(sum((e - b) * size[i] for i, b, e in t) <= room or sum(e - b for i, b, e in t if i < 2) == 1
                   for t in turns)


def test_damage_is_found_before_any_slice():
    raw = V.encode_nifti(np.arange(600, dtype=np.float32).reshape(10, 10, 6))
    two = raw + b"\0" * 7                                  # padding after the end is none
    assert len(list(V.PlaneReader(lambda: io.BytesIO(two), 50).planes())) == 6
    for bad in (raw[:-20], raw[:-8] + b"\1" * 8, gzip.compress(gzip.decompress(raw)[:900])):
        try:
            list(V.volume_slices(V.PlaneReader(lambda: io.BytesIO(bad), 50), [(2, 0, 6)], False, 1 << 20))
        except (V.NiftiError, EOFError, OSError, zlib.error):
            continue
        raise AssertionError("damage not found")


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def test_explode_archives(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/s1/blob.zip", _zip([("IM-0001.dcm", b"a" * 10), ("sub/IM-0002.dcm", b"b" * 3)]))
    _write(f"{d}/s2/blob.zip", _zip([]))
    _write(f"{d}/s3/blob.zip", b"not a zip")
    got = A.explode_archives(A.read_archives(spark, d)).collect()
    by = {}
    for r in got:
        by.setdefault(r.object_key.split("/")[-2], []).append(r)
    assert sorted((r.member, len(r.content)) for r in by["s1"]) == [("IM-0001.dcm", 10), ("sub/IM-0002.dcm", 3)]
    assert [r.status for r in by["s2"]] == ["empty"]
    assert by["s3"][0].status.startswith("error")


def test_spacing_text_is_pythons():
    """F16: the header's float32 spacing as the text of the widened float."""
    vals = [0.7, 1e-5, 5e-4, 1e7, 1e16, -2.5e-7, 100.0, 0.0, -0.0, 1e-30, float("nan"), float("inf"), float("-inf")]
    vals += np.random.default_rng(7).uniform(-10, 10, 67).tolist()
    for i in range(0, len(vals), 8):
        eight = [float(np.float32(v)) for v in vals[i:i + 8]]
        head = V.parse_header(gzip.decompress(V.encode_nifti(np.zeros((2, 2, 2), np.float32), tuple(eight))))
        assert head["pixdim_text"] == ["{}".format(x) for x in eight]
    assert "0.699999988079071" in V.parse_header(gzip.decompress(V.encode_nifti(np.zeros((1, 1, 1), np.float32), (0.7,) * 8)))["pixdim_text"]
