"""Slice operators on the slice table (D6: one row per 2-D slice).

Row filters and per-row array expressions are narrow (no shuffle). The one
operator that needs a whole stack -- min-max normalisation -- aggregates
extrema per stack (partial aggregation: one row per stack per task crosses
the shuffle) and joins them back; pixel arrays themselves never go through a
shuffle unless the extrema table is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

STACK_KEYS = ("volume_id", "axis")


def slice_range(slices: DataFrame, begin: int = 1, end: int = 1, dim: str = "dim") -> DataFrame:
    """A1: slices ``[begin:end]`` of each stack with Python slice rules
    (the default range is empty, as in the original helper)."""
    b, e = G.python_slice_bounds(dim, begin, end)
    return slices.filter((F.col("slice_no") >= b) & (F.col("slice_no") < e))


def slice_central(slices: DataFrame, n: int = -1, dim: str = "dim") -> DataFrame:
    """A2: the ``n`` central slices of each stack by the bounds rule
    (a stack of at most ``n`` slices always loses its last one)."""
    b, e = G.central_bounds(dim, n)
    return slices.filter((F.col("slice_no") >= b) & (F.col("slice_no") < e))


def renumber(slices: DataFrame, begin: Column) -> DataFrame:
    """Slice numbers relative to the first kept slice (link index)."""
    return slices.withColumn("slice_no", (F.col("slice_no") - begin).cast("int"))


def rotate(slices: DataFrame, k: int) -> DataFrame:
    """A4: rotate every slice by ``k`` quarter turns (height/width swap)."""
    px, _, _ = G.rot90("pixels", "height", "width", k)
    out = slices.withColumn("pixels", px)
    if k % 2:
        # swap the extents in a later projection: inside the lambda above,
        # "height"/"width" must name the input extents, and an alias of the
        # same name in the same projection would be picked up instead
        out = out.withColumns({"height": F.col("width"), "width": F.col("height")})
    return out


def skip_non_3d(volumes: DataFrame, shape: str = "shape") -> DataFrame:
    """Keep volumes whose shape has exactly three extents."""
    return volumes.filter(F.size(shape) == 3)


def with_slice_axis(volumes: DataFrame, shape: str = "shape") -> DataFrame:
    """A5: add ``slice_axis`` (smallest extent; first on ties)."""
    return volumes.withColumn("slice_axis", G.slice_axis_of(shape))


def with_inplane_resolution(df: DataFrame, axis: str = "axis", pixdim: str = "pixdim") -> DataFrame:
    """A3: add ``res_x``/``res_y`` for the slice plane of ``axis``."""
    rx, ry = G.inplane_resolution(axis, pixdim)
    return df.withColumns({"res_x": rx, "res_y": ry})


def slice_all(volumes: DataFrame, axis: int | None = None, shape: str = "shape",
              voxels: str = "voxels", keep: tuple[str, ...] = ("volume_id",)) -> DataFrame:
    """A6 on volumes held as flat arrays (small volumes or chunks): one row
    per slice along ``axis`` (default: every volume's smallest extent, A5, in
    the same pass), no rotation.
    Large volumes are sliced by the decode job instead, never held in a cell."""
    s, j, a = F.col(shape), F.col("slice_no"), F.col("axis")

    def along(of):
        """``of`` the axis, which every row has of its own if none is given."""
        if axis is not None:
            return of(axis)
        return F.when(a == 0, of(0)).when(a == 1, of(1)).otherwise(of(2))

    at = F.lit(axis) if axis is not None else G.slice_axis_of(shape)
    ext = F.element_at(s, a + 1).cast("int")
    v = volumes.select(*keep, shape, voxels, at.alias("axis")).select(
        *keep, shape, voxels, "axis", ext.alias("dim"),
        along(lambda k: G.plane_shape(k, s)[0]).cast("int").alias("height"),
        along(lambda k: G.plane_shape(k, s)[1]).cast("int").alias("width"),
        F.explode(F.sequence(F.lit(0), ext - 1)).alias("slice_no"))
    px = along(lambda k: F.transform(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1),
                                     lambda p: F.element_at(F.col(voxels), G.voxel_index(k, j, p, s) + 1)))
    return v.select(*keep, "axis", "slice_no", "height", "width", px.alias("pixels"), "dim")


# ------------------------------------------------------------ normalisation
def stack_extrema(slices: DataFrame, keys=STACK_KEYS, pixels: str = "pixels") -> DataFrame:
    """min/max over all pixels of each stack, plus a NaN flag.
    ``array_min`` skips NaN and ``array_max`` sorts it last, so NaN is
    tracked separately (NumPy would make the whole stack NaN)."""
    px = F.col(pixels)
    return slices.groupBy(*keys).agg(
        F.min(F.array_min(px)).alias("gmin"),
        F.max(F.array_max(px)).alias("gmax"),
        F.max(F.exists(px, lambda x: F.isnan(x)).cast("int")).alias("has_nan"),
    )


def _scaled(px: Column, gmin: Column, gmax: Column, has_nan: Column) -> Column:
    nan = F.lit(float("nan"))
    # a constant stack (gmax = gmin) divides 0 by 0 in NumPy: all NaN
    return F.when((has_nan == 1) | (gmax == gmin), F.transform(px, lambda _x: nan)) \
            .otherwise(F.transform(px, lambda x: (x - gmin) / (gmax - gmin)))


def minmax_normalise(slices: DataFrame, keys=STACK_KEYS, pixels: str = "pixels") -> DataFrame:
    """``(x - gmin) / (gmax - gmin)`` with extrema over the whole stack
    (all kept slices of a volume and axis), not per slice."""
    ext = stack_extrema(slices, keys, pixels)
    # one extrema row per stack; by its size at run time Spark broadcasts it or
    # shuffles, and splits a hot stack
    j = slices.join(ext, list(keys))
    return j.withColumn(pixels, _scaled(F.col(pixels), F.col("gmin"), F.col("gmax"),
                                        F.col("has_nan"))).drop("gmin", "gmax", "has_nan")


def write_stacks(slices: DataFrame, table: str, buckets: int, keys=STACK_KEYS) -> None:
    """K5 for stacks that are read again and again: the slices as a table in
    ``buckets`` buckets by ``stack`` (their ``keys`` as one value)."""
    stack = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    (slices.withColumn("stack", stack).repartition(buckets, "stack").write.mode("errorifexists")
     .bucketBy(buckets, "stack").sortBy("stack").saveAsTable(table))


def minmax_normalise_stored(stacks: DataFrame, pixels: str = "pixels") -> DataFrame:
    """A7 on a table of ``write_stacks``: a bucket holds all slices of its
    stacks, so extrema are taken and meet the pixels where they lie; nothing
    is exchanged, whatever the sizes. The merge join streams a stack's slices
    past its one row of extrema."""
    ext = stack_extrema(stacks, ("stack",), pixels)
    return stacks.join(ext.hint("merge"), "stack").withColumn(
        pixels, _scaled(F.col(pixels), F.col("gmin"), F.col("gmax"), F.col("has_nan"))) \
        .drop("gmin", "gmax", "has_nan", "stack")


def scale_range(slices: DataFrame, keys=STACK_KEYS, pixels: str = "pixels") -> DataFrame:
    """min/max of each (normalised) stack and whether it spans [0, 1]."""
    e = stack_extrema(slices, keys, pixels)
    return e.select(*keys, F.col("gmin").alias("scale_min"), F.col("gmax").alias("scale_max"),
                    ((F.col("has_nan") == 0) & (F.col("gmin") == 0.0) & (F.col("gmax") == 1.0))
                    .alias("in_unit_range"))


def display_scale(slices: DataFrame, pixels: str = "pixels") -> DataFrame:
    """What the renderer draws: each slice autoscaled by its own min/max
    to 256 grey levels (``min(floor(256 * (x - mn) / (mx - mn)), 255)``; a
    constant slice is level 0) and drawn bottom row first (vertical flip).
    The slice extrema are projected first so the per-pixel lambda only reads
    columns (nothing is recomputed per pixel)."""
    px = F.col(pixels)
    df = slices.withColumns({"_mn": F.array_min(px), "_mx": F.array_max(px)})
    mn, mx, h, w = F.col("_mn"), F.col("_mx"), F.col("height"), F.col("width")

    def level(x: Column) -> Column:
        return F.when(mx == mn, F.lit(0)).otherwise(
            F.least(F.floor((x - mn) / (mx - mn) * 256), F.lit(255))).cast("int")
    grey = F.transform(px, lambda _x, o: level(F.element_at(
        px, (h - 1 - F.floor(o / w).cast("int")) * w + o % w + 1)))
    return df.withColumn("grey", grey).drop("_mn", "_mx")
