"""Slice operators against NumPy (the reference computes them with NumPy)."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cortexlake.operators import slices as S
from cortexlake.sources.volumes import central_range


def _np_central(dim, n):
    begin, end = 0, dim - 1
    if n != -1:
        n2 = n / 2
        mid = dim / 2
        begin, end = mid - n2, mid + n2
    if begin < 0:
        begin = 0
    if end >= dim:
        end = dim - 1
    return int(begin), int(end)


@pytest.mark.parametrize("dim,n,expect", [(40, 50, (0, 39)), (49, 50, (0, 48)), (50, 50, (0, 49)),
                                          (51, 50, (0, 50)), (52, 50, (1, 51)), (256, 50, (103, 153))])
def test_central_bounds_table(dim, n, expect):
    assert central_range(dim, n) == expect == _np_central(dim, n)


def test_central_bounds_spark_equals_rule(spark):
    pairs = [(d, n) for d in (0, 1, 2, 3, 7, 40, 49, 50, 51, 52, 99, 256) for n in (-1, 0, 1, 2, 5, 50, 51)]
    rows = [(d, n, j) for d, n in pairs for j in range(d)]
    df = spark.createDataFrame(rows, "dim int, n int, slice_no int")
    from cortexlake.functions.geometry import central_bounds
    b, e = central_bounds("dim", F.col("n"))
    kept = {(r.dim, r.n, r.slice_no) for r in df.filter((F.col("slice_no") >= b) & (F.col("slice_no") < e)).collect()}
    expect = set()
    for d, n in pairs:
        lo, hi = _np_central(d, n)
        expect |= {(d, n, j) for j in range(d)[lo:hi]}
    assert kept == expect


def _vol_df(spark, vols):
    return spark.createDataFrame(
        [(i, list(v.shape), [float(x) for x in v.ravel(order="F")]) for i, v in enumerate(vols)],
        "volume_id long, shape array<int>, voxels array<double>")


def test_slice_all_geometry_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vols = [rng.normal(size=(3, 4, 5)), rng.normal(size=(6, 2, 4)), rng.normal(size=(4, 4, 4))]
    df = _vol_df(spark, vols)
    for axis in (0, 1, 2):
        got = {(r.volume_id, r.slice_no): (r.height, r.width, r.pixels)
               for r in S.slice_all(df, axis=axis).collect()}
        for i, v in enumerate(vols):
            for j in range(v.shape[axis]):
                plane = v[j, :, :] if axis == 0 else (v[:, j, :] if axis == 1 else v[:, :, j])
                h, w, px = got[(i, j)]
                assert (h, w) == plane.shape
                assert np.allclose(px, plane.ravel(order="C"))


def test_slice_all_default_axis_is_thinnest(spark):
    vols = [np.zeros((6, 2, 4)), np.zeros((3, 3, 5))]
    got = {(r.volume_id, r.axis) for r in S.slice_all(_vol_df(spark, vols)).collect()}
    assert got == {(0, 1), (1, 0)}


def test_slice_all_default_axis_in_one_pass(spark):
    rng = np.random.default_rng(11)
    vols = [rng.normal(size=s) for s in [(2, 3, 4), (4, 2, 3), (3, 4, 2), (2, 2, 2)]]
    sl = S.slice_all(_vol_df(spark, vols))
    assert "Union" not in sl._jdf.queryExecution().optimizedPlan().toString()
    rows = sl.collect()
    assert len(rows) == 8
    for r in rows:
        v = vols[r.volume_id]
        plane = np.take(v, r.slice_no, axis=int(np.argmin(v.shape)))
        assert r.axis == int(np.argmin(v.shape)) and (r.height, r.width) == plane.shape and r.dim == 2
        assert np.allclose(r.pixels, plane.ravel(order="C"))


@pytest.mark.parametrize("k", [1, 2, 3, 4, -1])
def test_rot90_matches_numpy(spark, k):
    rng = np.random.default_rng(k + 10)
    imgs = [rng.normal(size=(3, 5)), rng.normal(size=(4, 4))]
    df = spark.createDataFrame([(i, m.shape[0], m.shape[1], [float(x) for x in m.ravel()])
                                for i, m in enumerate(imgs)],
                               "volume_id long, height int, width int, pixels array<double>")
    for r in S.rotate(df, k).collect():
        ref = np.rot90(imgs[r.volume_id], k)
        assert (r.height, r.width) == ref.shape
        assert np.allclose(r.pixels, ref.ravel())


def _stack_df(spark, stacks):
    rows = []
    for vid, st in enumerate(stacks):
        for j, sl in enumerate(st):
            rows.append((str(vid), 0, j, sl.shape[0], sl.shape[1], [float(x) for x in sl.ravel()]))
    return spark.createDataFrame(rows, "volume_id string, axis int, slice_no int, height int, "
                                       "width int, pixels array<double>")


def test_minmax_normalise_matches_numpy(spark):
    rng = np.random.default_rng(3)
    stacks = [rng.normal(size=(5, 3, 4)), np.full((2, 2, 2), 7.0), rng.normal(size=(3, 2, 2))]
    stacks[2][1, 0, 1] = np.nan
    out = {(r.volume_id, r.slice_no): r.pixels for r in S.minmax_normalise(_stack_df(spark, stacks)).collect()}
    for vid, st in enumerate(stacks):
        with np.errstate(invalid="ignore", divide="ignore"):
            ref = (st - np.min(st)) / (np.max(st) - np.min(st))
        for j in range(st.shape[0]):
            got = np.array(out[(str(vid), j)], dtype=float)
            assert np.allclose(got, ref[j].ravel(), equal_nan=True)
    # the normalised regular stack spans exactly [0, 1]
    sr = {r.volume_id: r for r in S.scale_range(S.minmax_normalise(_stack_df(spark, stacks))).collect()}
    assert sr["0"].in_unit_range and not sr["1"].in_unit_range and not sr["2"].in_unit_range


def test_minmax_normalise_shuffle_join_path(spark):
    """Without a broadcast the same result comes from a shuffle join."""
    rng = np.random.default_rng(4)
    stacks = [rng.normal(size=(3, 2, 2)) for _ in range(4)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = sorted((r.volume_id, r.slice_no, tuple(r.pixels)) for r in
                   S.minmax_normalise(_stack_df(spark, stacks)).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    b = sorted((r.volume_id, r.slice_no, tuple(r.pixels)) for r in
               S.minmax_normalise(_stack_df(spark, stacks)).collect())
    assert a == b


def test_display_scale(spark):
    img = np.array([[0.0, 1.0], [2.0, 4.0]])
    df = _stack_df(spark, [img[None, :, :], np.full((1, 2, 2), 3.0)])
    got = {r.volume_id: r.grey for r in S.display_scale(df).collect()}
    level = np.minimum(np.floor((img - 0) / 4 * 256), 255).astype(int)
    assert got["0"] == list(level[::-1].ravel())
    assert got["1"] == [0, 0, 0, 0]


def test_detect_axis_skip_and_resolution(spark):
    df = spark.createDataFrame([(1, [5, 3, 3], [1.0, 0.5, 0.6, 0.7] + [0.0] * 4),
                                (2, [4, 4, 4, 2], [1.0] * 8),
                                (3, [9, 9, 2], [1.0, 0.5, 0.6, 0.7] + [0.0] * 4)],
                               "volume_id long, shape array<int>, pixdim array<float>")
    v = S.with_inplane_resolution(S.with_slice_axis(S.skip_non_3d(df)), "slice_axis", "pixdim")
    got = {r.volume_id: (r.slice_axis, round(r.res_x, 4), round(r.res_y, 4)) for r in v.collect()}
    assert got == {1: (1, 0.5, 0.7), 3: (2, 0.5, 0.6)}
