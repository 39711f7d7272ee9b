"""Distributed volume decoding.

A listing of files (or any ``(volume_id, content)`` DataFrame) goes through one
``mapInArrow`` job: each task opens, inflates and decodes its NIfTI-1 files in
pieces (fixed 348-byte header layout of the published format) and emits one
row per 2-D slice plus one header row per volume. A volume is a single file,
so it never spans tasks; it is read plane by plane, as often as its slices need
to be gathered in bounded memory, and no bytes of files are ever shuffled.

Two slicing modes, one per source of the archive:
* ``"thinnest"``: every slice along the axis with the smallest extent (A5/A6).
* ``"central"``:  the ``n`` central slices along each requested axis (A2/A11),
  rotated by ``rot`` quarter turns (A4).
Both can normalise each selected stack by its own min/max (A7) in the task,
since a stack never leaves the task that decoded it.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# NIfTI-1 header layout (byte offsets) and data type codes.
HEADER_SIZE = 348
OFF_DIM, OFF_DATATYPE, OFF_BITPIX, OFF_PIXDIM = 40, 70, 72, 76
OFF_VOX_OFFSET, OFF_SCL_SLOPE, OFF_SCL_INTER, OFF_MAGIC = 108, 112, 116, 344
DTYPES = {
    2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8",
    256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8",
}

DECODED = T.StructType([
    T.StructField("volume_id", T.StringType(), False),
    T.StructField("axis", T.IntegerType(), True),
    T.StructField("slice_no", T.IntegerType(), True),
    T.StructField("height", T.IntegerType(), True),
    T.StructField("width", T.IntegerType(), True),
    T.StructField("dim", T.IntegerType(), True),
    T.StructField("pixels", T.ArrayType(T.DoubleType(), True), True),
    # header row only (slice_no is null there)
    T.StructField("shape", T.ArrayType(T.IntegerType(), True), True),
    T.StructField("pixdim", T.ArrayType(T.FloatType(), True), True),
    T.StructField("pixdim_text", T.ArrayType(T.StringType(), True), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
])
DECODED_COLUMNS = [f.name for f in DECODED.fields]


class NiftiError(ValueError):
    pass


def parse_header(raw: bytes) -> dict:
    """Decode the fixed NIfTI-1 header; byte order from ``sizeof_hdr``.
    ``pixdim_text`` is F16: the eight spacings as Python's ``"{}".format(x)``
    writes them, float32 widened to double first (``0.699999988079071``)."""
    if len(raw) < HEADER_SIZE:
        raise NiftiError(f"file too short for a header ({len(raw)} bytes)")
    order = "<"
    if int(np.frombuffer(raw, "<i4", 1, 0)[0]) != HEADER_SIZE:
        if int(np.frombuffer(raw, ">i4", 1, 0)[0]) != HEADER_SIZE:
            raise NiftiError("not a NIfTI-1 header (sizeof_hdr != 348)")
        order = ">"
    dim = np.frombuffer(raw, order + "i2", 8, OFF_DIM).astype(int)
    ndim = int(dim[0])
    if not 1 <= ndim <= 7:
        raise NiftiError(f"bad dim[0] = {ndim}")
    pixdim = [float(x) for x in np.frombuffer(raw, order + "f4", 8, OFF_PIXDIM)]
    return {
        "order": order,
        "shape": [int(x) for x in dim[1:ndim + 1]],
        "datatype": int(np.frombuffer(raw, order + "i2", 1, OFF_DATATYPE)[0]),
        "pixdim": pixdim,
        "pixdim_text": ["{}".format(x) for x in pixdim],
        "vox_offset": float(np.frombuffer(raw, order + "f4", 1, OFF_VOX_OFFSET)[0]),
        "slope": float(np.frombuffer(raw, order + "f4", 1, OFF_SCL_SLOPE)[0]),
        "inter": float(np.frombuffer(raw, order + "f4", 1, OFF_SCL_INTER)[0]),
        "magic": bytes(raw[OFF_MAGIC:OFF_MAGIC + 4]),
    }


def decode_nifti(content: bytes) -> tuple[dict, np.ndarray]:
    """(header, float64 voxel array indexed [x, y, z, ...]); applies the
    header's scaling when its slope is non-zero (as image readers do)."""
    raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)
    hdr = parse_header(raw)
    code = hdr["datatype"]
    if code not in DTYPES:
        raise NiftiError(f"unsupported datatype {code}")
    dt = np.dtype(hdr["order"] + DTYPES[code])
    n = int(np.prod(hdr["shape"])) if hdr["shape"] else 0
    off = int(hdr["vox_offset"]) if hdr["vox_offset"] >= HEADER_SIZE else 352
    need = off + n * dt.itemsize
    if len(raw) < need:
        raise NiftiError(f"truncated data ({len(raw)} of {need} bytes)")
    data = np.frombuffer(raw, dt, n, off).reshape(hdr["shape"], order="F").astype(np.float64)
    slope, inter = hdr["slope"], hdr["inter"]
    if slope != 0 and np.isfinite(slope):
        data = data * slope + (inter if np.isfinite(inter) else 0.0)
    return hdr, data


def encode_nifti(data: np.ndarray, pixdim=(1.0,) * 8, datatype: int = 16,
                 compress: bool = True) -> bytes:
    """Inverse of ``decode_nifti``: a single-file NIfTI-1 image (header +
    4 pad bytes + Fortran-ordered data), gzip-compressed by default."""
    dt = np.dtype("<" + DTYPES[datatype])
    hdr = bytearray(352)
    hdr[0:4] = np.int32(HEADER_SIZE).tobytes()
    dim = np.zeros(8, "<i2")
    dim[0] = data.ndim
    dim[1:data.ndim + 1] = data.shape
    hdr[OFF_DIM:OFF_DIM + 16] = dim.tobytes()
    hdr[OFF_DATATYPE:OFF_DATATYPE + 2] = np.int16(datatype).tobytes()
    hdr[OFF_BITPIX:OFF_BITPIX + 2] = np.int16(dt.itemsize * 8).tobytes()
    pd8 = np.zeros(8, "<f4")
    pd8[:len(pixdim)] = pixdim
    hdr[OFF_PIXDIM:OFF_PIXDIM + 32] = pd8.tobytes()
    hdr[OFF_VOX_OFFSET:OFF_VOX_OFFSET + 4] = np.float32(352).tobytes()
    hdr[OFF_MAGIC:OFF_MAGIC + 4] = b"n+1\0"
    raw = bytes(hdr) + np.asarray(data, dtype=dt).tobytes(order="F")
    return gzip.compress(raw, compresslevel=1) if compress else raw


def central_range(dim: int, n: int) -> tuple[int, int]:
    """A2 bounds rule (same as ``geometry.central_bounds``)."""
    begin, end = 0.0, float(dim - 1)
    if n != -1:
        begin, end = dim / 2 - n / 2, dim / 2 + n / 2
    if begin < 0:
        begin = 0.0
    if end >= dim:
        end = float(dim - 1)
    return int(begin), int(end)


def _to_range(shape: list, axis: int, b: int, e: int) -> tuple[int, int, int]:
    return axis, b, max(b, min(e, shape[axis]))


class PlaneReader:
    """The planes of a volume file, one after the other as its bytes arrive.
    ``open_file`` gives a new stream from the file's start; compressed bytes
    are inflated in pieces, so neither the file nor the volume is ever held."""

    def __init__(self, open_file, chunk: int = 1 << 20):
        self.open_file, self.chunk = open_file, chunk
        self.header = parse_header(self._head())

    def _bytes(self) -> Iterator[bytes]:
        with self.open_file() as f:
            data = f.read(self.chunk)
            if data[:2] != b"\x1f\x8b":
                while data:
                    yield data
                    data = f.read(self.chunk)
                return
            inflate = zlib.decompressobj(wbits=31)
            while True:
                out = inflate.decompress(data, 4 * self.chunk)
                if out:
                    yield out
                if inflate.eof:                        # another member may follow; padding does not count
                    data = inflate.unused_data.lstrip(b"\0") or f.read(self.chunk).lstrip(b"\0")
                    if not data:
                        return
                    inflate = zlib.decompressobj(wbits=31)
                    continue
                data = inflate.unconsumed_tail or f.read(self.chunk)
                if not data and not out:
                    raise EOFError("compressed file ends before its end marker")

    def _head(self) -> bytes:
        head = b""
        for part in self._bytes():
            head += part
            if len(head) >= HEADER_SIZE:
                break
        return head

    def planes(self) -> Iterator[np.ndarray]:
        """Every plane of constant z as scaled float64, indexed [y, x]. The
        file is read to its end, so damage anywhere is noticed."""
        h = self.header
        if h["datatype"] not in DTYPES:
            raise NiftiError(f"unsupported datatype {h['datatype']}")
        dt, (nx, ny, nz) = np.dtype(h["order"] + DTYPES[h["datatype"]]), h["shape"]
        if min(nx, ny, nz) < 0:
            raise NiftiError(f"bad extents {h['shape']}")
        skip = int(h["vox_offset"]) if h["vox_offset"] >= HEADER_SIZE else 352
        size, done, held = nx * ny * dt.itemsize, 0, bytearray()
        scale, shift = h["slope"], h["inter"] if np.isfinite(h["inter"]) else 0.0
        if size == 0:
            nz = 0
        for part in self._bytes():
            if done == nz:
                continue
            held += part
            at = min(skip, len(held))
            skip -= at
            while done < nz and skip == 0 and len(held) - at >= size:
                plane = np.frombuffer(held[at:at + size], dt).reshape(ny, nx).astype(np.float64)
                yield plane * scale + shift if scale != 0 and np.isfinite(scale) else plane
                at, done = at + size, done + 1
            del held[:at]
        if done < nz:
            raise NiftiError(f"truncated data ({done} of {nz} planes)")


def _extrema(planes, picks: list) -> list[tuple[float, float]]:
    """Smallest and largest value of every picked stack; NaN if it has one."""
    found = [[np.inf, -np.inf] for _ in picks]
    for z, plane in enumerate(planes):
        for own, (axis, b, e) in zip(found, picks):
            part = plane[:, b:e] if axis == 0 else plane[b:e] if axis == 1 else plane if b <= z < e else plane[:0]
            if part.size:
                own[0], own[1] = np.minimum(own[0], part.min()), np.maximum(own[1], part.max())
    return [(float(lo), float(hi)) for lo, hi in found]


def _turns(shape: list, picks: list, room: int) -> list[list[tuple[int, int, int]]]:
    """The picks' slices in turns of reading the file: ``(pick, begin, end)``.
    Slices along z come out of the stream and need no room; of the others as
    many are gathered in a turn as ``room`` bytes hold, and one at least."""
    parts = [(i, b, e) for i, (axis, b, e) in enumerate(picks) if axis == 2 and b < e]
    turns, free = [parts] if parts else [], room
    for i, (axis, b, e) in enumerate(picks):
        each = 8 * max(1, shape[1 - axis] * shape[2]) if axis < 2 else 0
        while axis < 2 and b < e:
            n = min(e - b, free // each)
            if n < 1 and free < room or not turns:
                turns.append([])
                free = room
                continue
            n = max(1, n)
            turns[-1].append((i, b, b + n))
            b, free = b + n, free - n * each
    return turns


def volume_slices(reader: PlaneReader, picks: list, normalise: bool, room: int):
    """``(pick, slice number, 2-D slice)`` of the picked ranges ``(axis, begin,
    end)``. The first reading finds the extrema (and any damage); further ones
    gather the slices, within ``room`` bytes whatever the volume's size."""
    nx, ny, nz = reader.header["shape"]
    extent = _extrema(reader.planes(), picks)

    def finished(i, s):
        if not normalise:
            return s
        lo, hi = extent[i]
        with np.errstate(invalid="ignore", divide="ignore"):
            return (s - lo) / np.float64(hi - lo)

    for turn in _turns([nx, ny, nz], picks, room):
        held = {t: np.empty((t[2] - t[1], ny if picks[t[0]][0] == 0 else nx, nz)) for t in turn if picks[t[0]][0] < 2}
        for z, plane in enumerate(reader.planes()):
            for t in turn:
                i, b, e = t
                if t in held:
                    held[t][:, :, z] = plane[:, b:e].T if picks[i][0] == 0 else plane[b:e]
                elif b <= z < e:
                    yield i, z - picks[i][1], finished(i, plane.T)
        for (i, b, _), stack in held.items():
            for j, s in enumerate(stack):
                yield i, b + j - picks[i][1], finished(i, s)


class _Rows:
    """Buffers output rows across volumes and hands them out as one Arrow
    batch per ``max_rows`` rows or ``max_bytes`` of pixels, so small volumes
    share batches and large ones never build a huge one."""

    def __init__(self, schema: T.StructType, max_rows: int, max_bytes: int = 32 * 1024 * 1024):
        self.schema, self.max_rows, self.max_bytes = to_arrow_schema(schema), max_rows, max_bytes
        self._reset()

    def _reset(self):
        self.cols = {c: [] for c in self.schema.names}
        self.n = self.nbytes = 0

    def add(self, **row):
        for c, values in self.cols.items():
            values.append(row.get(c))
        self.n += 1
        px = row.get("pixels")
        self.nbytes += 0 if px is None else px.nbytes

    def full(self) -> bool:
        return self.n >= self.max_rows or self.nbytes >= self.max_bytes

    def flush(self) -> pa.RecordBatch:
        cols = []
        for field in self.schema:
            values = self.cols[field.name]
            if field.name == "pixels":              # flat values: a NaN stays a NaN
                ends = np.cumsum([0] + [0 if v is None else len(v) for v in values])
                at = pa.array([None if v is None else int(a) for v, a in zip(values, ends)] + [int(ends[-1])], pa.int32())
                flat = [v for v in values if v is not None]
                cols.append(pa.ListArray.from_arrays(
                    at, pa.array(np.concatenate(flat) if flat else np.empty(0)), type=field.type))
            else:
                cols.append(pa.array(values, field.type))
        self._reset()
        return pa.RecordBatch.from_arrays(cols, schema=self.schema)


def open_path(path: str, write: bool = False):
    """A stream of a file's own bytes (or to them), wherever its path says it
    is: the machine's folders, or any store that Arrow's file systems know."""
    from pyarrow import fs
    scheme, place, rest = re.fullmatch(r"(?:(\w[\w+.-]*):(?://([^/]*))?)?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        system, base = fs.LocalFileSystem(), ""
    else:
        system, base = fs.FileSystem.from_uri(f"{scheme}://{place or ''}/")
    rest = base.rstrip("/") + rest
    if write:
        system.create_dir(rest.rpartition("/")[0])
        return system.open_output_stream(rest, compression=None)
    return system.open_input_stream(rest, compression=None)


def make_decoder(schema: T.StructType, open_file, mode: str = "thinnest", n: int = 50, axes=(0, 1, 2),
                 rot: int = 0, normalise: bool = True, rows_per_batch: int = 64, room: int = 64 << 20):
    """The ``mapInArrow`` function for ``decode_volumes``: input columns are
    the id, what ``open_file`` opens (a path or bytes), and the carried ones."""
    if mode not in ("thinnest", "central"):
        raise ValueError(f"unknown slicing mode {mode!r}")
    carry = schema.names[len(DECODED_COLUMNS):]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema, rows_per_batch)
        for batch in batches:
            for i in range(batch.num_rows):
                vid, source, *kept = (c[i].as_py() for c in batch.columns)
                kept, begun = dict(zip(carry, kept)), False
                try:
                    if source is None:
                        raise NiftiError("no file")
                    reader = PlaneReader(lambda: open_file(source))
                    shape = reader.header["shape"]
                    head = {"volume_id": vid, "shape": shape, "pixdim": reader.header["pixdim"],
                            "pixdim_text": reader.header["pixdim_text"], **kept}
                    if len(shape) != 3:
                        # Only 3-D volumes are sliced; others are reported
                        out.add(**head, status="skipped", message=f"{len(shape)}-D volume")
                        continue
                    if mode == "thinnest":
                        a = int(np.argmin(shape))
                        picks = [(a, 0, shape[a])]
                    else:
                        picks = [_to_range(shape, a, *central_range(shape[a], n)) for a in axes]
                    for k, j, s in volume_slices(reader, picks, normalise, room):
                        begun = True
                        s = np.rot90(s, rot) if rot % 4 else s
                        out.add(volume_id=vid, axis=picks[k][0], slice_no=j, height=s.shape[0], width=s.shape[1],
                                dim=shape[picks[k][0]], pixels=s.ravel(order="C"), **kept)
                        if out.full():
                            yield out.flush()
                    out.add(**head, status="ok")
                except (NiftiError, OSError, EOFError, zlib.error, ValueError) as e:
                    if begun:                        # sound at its first reading, not at a later one
                        raise
                    out.add(volume_id=vid, status="error", message=str(e), **kept)
                if out.full():
                    yield out.flush()
        if out.n:
            yield out.flush()
    return decode


def decode_volumes(files: DataFrame, mode: str = "thinnest", n: int = 50, axes=(0, 1, 2),
                   rot: int = 0, normalise: bool = True, id_col: str = "volume_id",
                   content_col: str = "content", rows_per_batch: int = 64, carry=(),
                   path_col: str | None = None) -> DataFrame:
    """S4 + A2/A4/A5/A6/A7 + P7: decode every volume file into slice rows and
    one header row each. Only the id, the text columns named in ``carry`` and
    the file enter the Python worker: with ``path_col`` its path, opened in the
    decoding task, else the bytes of ``content_col``. Carried columns come out
    on every row of their volume, so nothing has to be joined to pixels. A task
    holds a piece of one file, 64 MB of slices being gathered, and one output
    batch, whatever the volumes' size."""
    schema = T.StructType(DECODED.fields + [T.StructField(c, T.StringType()) for c in carry])
    src = files.select(F.col(id_col).cast("string").alias("volume_id"),
                       F.col(path_col or content_col).alias("file"),
                       *[F.col(c).cast("string").alias(c) for c in carry])
    return src.mapInArrow(make_decoder(schema, open_path if path_col else io.BytesIO, mode, n, axes, rot,
                                       normalise, rows_per_batch), schema)


def packed(listing: DataFrame, order: str = "volume_file", length: str = "length",
           bytes_per_task: int = 256 << 20, files_per_task: int = 512) -> DataFrame:
    """The listing's rows (paths and keys, no bytes of files) dealt over
    tasks of about ``bytes_per_task`` bytes of files each, in the files' order.
    For opening it a file counts as the ``files_per_task``-th part of a task
    more: small files make many tasks too."""
    from ..operators.running import with_running_sum
    cost = F.coalesce(length, F.lit(0)) + bytes_per_task // files_per_task
    rows = with_running_sum(listing, cost, [order], name="_before").withColumn(
        "_bin", F.floor(F.col("_before") / bytes_per_task))
    bins = rows.agg(F.max("_bin")).first()[0]
    return rows.repartitionByRange(int(bins or 0) + 1, "_bin").drop("_bin", "_before")


def list_volume_files(spark, path: str, glob: str = "*.nii.gz") -> DataFrame:
    """``path, length, modified`` of the volume files below ``path``: Spark's
    listing alone, no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def slices_of(decoded: DataFrame) -> DataFrame:
    """The slice rows (D6) of a decoded table."""
    return decoded.filter(F.col("slice_no").isNotNull()).select(
        "volume_id", "axis", "slice_no", "height", "width", "dim", "pixels")


def headers_of(decoded: DataFrame) -> DataFrame:
    """One row per input file: shape, spacing vector (numbers and text) and status."""
    return decoded.filter(F.col("slice_no").isNull()).select(
        "volume_id", "shape", "pixdim", "pixdim_text", "status", "message")


def read_volume_files(spark, path: str, glob: str = "*.nii.gz") -> DataFrame:
    """``binaryFile`` listing of volume files (path becomes the volume id)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("volume_id"), "length", "content"))
