"""Column helpers for slice geometry: slice bounds, in-plane resolution,
slicing axis, 90-degree rotation and the voxel index of a slice pixel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def central_bounds(dim: ColumnOrName, n: int | ColumnOrName = -1) -> tuple[Column, Column]:
    """A2 bounds: ``[begin, end)`` of ``n`` central slices of an axis of
    extent ``dim``. Default (n = -1): ``[0, dim-1)``. Otherwise
    ``dim/2 -+ n/2`` in floating point, ``begin < 0 -> 0``,
    ``end >= dim -> dim-1``, then truncated to integers."""
    d = _c(dim).cast("double")
    nn = (F.lit(n) if isinstance(n, int) else _c(n)).cast("double")
    b = F.when(nn == -1, F.lit(0.0)).otherwise(d / 2 - nn / 2)
    e = F.when(nn == -1, d - 1).otherwise(d / 2 + nn / 2)
    b = F.when(b < 0, F.lit(0.0)).otherwise(b)
    e = F.when(e >= d, d - 1).otherwise(e)
    return b.cast("int"), e.cast("int")


def python_slice_bounds(dim: ColumnOrName, begin: int, end: int) -> tuple[Column, Column]:
    """A1: ``[begin:end]`` on an axis of extent ``dim`` with Python's slice
    rules (negative positions count from the end, out-of-range clamps)."""
    d = _c(dim).cast("int")

    def norm(v: int) -> Column:
        if v < 0:
            return F.greatest(d + F.lit(v), F.lit(0))
        return F.least(F.lit(v), d)
    return norm(int(begin)), norm(int(end))


def inplane_resolution(axis: ColumnOrName, pixdim: ColumnOrName) -> tuple[Column, Column]:
    """A3: the two spacings of a slice plane from the header vector
    ``pixdim[0..7]`` (slot 0 is not a spacing): axis 0 -> (2, 3),
    axis 1 -> (1, 3), axis 2 -> (1, 2)."""
    a, p = _c(axis), _c(pixdim)
    rx = F.when(a == 0, F.try_element_at(p, F.lit(3))).otherwise(F.try_element_at(p, F.lit(2)))
    ry = F.when(a == 2, F.try_element_at(p, F.lit(3))).otherwise(F.try_element_at(p, F.lit(4)))
    return rx, ry


def slice_axis_of(shape: ColumnOrName) -> Column:
    """A5: the axis with the smallest extent (the first one on ties)."""
    s = _c(shape)
    return (F.array_position(s, F.array_min(s)) - 1).cast("int")


def rot90(pixels: ColumnOrName, height: ColumnOrName, width: ColumnOrName, k: int) -> tuple[Column, Column, Column]:
    """A4: rotate a row-major ``height x width`` slice by ``k`` quarter turns
    counter-clockwise (as ``numpy.rot90``). Returns (pixels, height, width)."""
    px, h, w = _c(pixels), _c(height), _c(width)
    k %= 4
    if k == 0:
        return px, h, w
    if k == 1:
        def src(o):
            return (o % h) * w + (w - 1 - F.floor(o / h).cast("int"))
        nh, nw = w, h
    elif k == 2:
        def src(o):
            return (h - 1 - F.floor(o / w).cast("int")) * w + (w - 1 - o % w)
        nh, nw = h, w
    else:
        def src(o):
            return (h - 1 - o % h) * w + F.floor(o / h).cast("int")
        nh, nw = w, h
    out = F.transform(px, lambda _x, o: F.element_at(px, src(o) + 1))
    return out, nh, nw


def voxel_index(axis: int, j: ColumnOrName, p: ColumnOrName, shape: ColumnOrName) -> Column:
    """0-based flat index (x fastest: ``x + nx*y + nx*ny*z``) of pixel ``p``
    of slice ``j`` along ``axis``. The slice plane is row-major:
    sagittal ``[y][z]``, coronal ``[x][z]``, axial ``[x][y]``."""
    s = _c(shape)
    nx, ny, nz = F.element_at(s, 1), F.element_at(s, 2), F.element_at(s, 3)
    j, p = _c(j), _c(p)
    if axis == 0:
        y, z = F.floor(p / nz).cast("int"), p % nz
        return j + nx * y + nx * ny * z
    if axis == 1:
        x, z = F.floor(p / nz).cast("int"), p % nz
        return x + nx * j + nx * ny * z
    x, y = F.floor(p / ny).cast("int"), p % ny
    return x + nx * y + nx * ny * j


def plane_shape(axis: int, shape: ColumnOrName) -> tuple[Column, Column]:
    """(height, width) of a slice plane along ``axis``."""
    s = _c(shape)
    dims = [F.element_at(s, i) for i in (1, 2, 3)]
    rest = [dims[i] for i in range(3) if i != axis]
    return rest[0], rest[1]
