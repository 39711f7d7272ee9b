"""Shared helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import os
import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path

#: The white space that the text contracts name: space, and TAB to CR.
SPACE = r"[\x20\x09-\x0D]"
#: Type name of a column of bytes.
BYTES = T.BinaryType().simpleString()
ARROW_BYTES = to_arrow_type(T.BinaryType())
#: Stands for a missing doc_id where ids are ordered: after every real id.
NO_ID = (1 << 63) - 1
#: By thread: paths of the tables saved within ``steps``.
_made: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: the lineage is cut, a lost executor costs nothing that was written,
    and the planner knows the table's size."""
    return _written(df, scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    if threading.get_ident() in _made:
        _made[threading.get_ident()].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Rounds:
    """A saved table that each round of a loop replaces: the one before is
    deleted once the next is written."""

    def __init__(self, name: str):
        self.name, self.path = name, None

    def next(self, df: DataFrame) -> DataFrame:
        old, self.path = self.path, scratch_path(df.sparkSession, f"{self.name}-{uuid.uuid4().hex}")
        table = _written(df, self.path)
        if old is not None:
            deleted(df.sparkSession, old)
        return table


@contextlib.contextmanager
def steps(spark: SparkSession):
    """The list of tables ``saved`` inside, which are deleted at the end; what
    the caller takes out of the list stays, what it adds goes too. Only for
    work whose result is written inside."""
    made: list = []
    me = threading.get_ident()
    outer = _made.get(me)
    _made[me] = made
    try:
        yield made
    finally:
        del _made[me]
        if outer is not None:
            _made[me] = outer
        for path in made:
            deleted(spark, path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns an operator needs; whatever else the table has,
    clashing names included, stays out of the plan."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def likely(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """``rows`` without most of those whose 64-bit ``key`` is not among
    ``wanted`` (one column), so that a join after it shuffles little. The bits
    of ``wanted`` go to the tasks as a broadcast table of at most ``bits`` bits
    (8 MB), whatever the input; the fuller it is, the more rows pass."""
    slot = lambda k: F.pmod(F.col(k), F.lit(bits))
    maps = saved(wanted.select(slot(wanted.columns[0]).alias("slot")).groupBy(
        F.bitmap_bucket_number("slot").alias("_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")), "bits")
    at = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(maps), F.bitmap_bucket_number(slot(key)) == F.col("_page")).filter(
        F.getbit(byte, (at % 8).cast("int")) == 1).drop("_page", "_bits")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file, on whichever machine asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


def slices(batches, rows: int = 256):
    """Arrow batches cut to at most ``rows`` rows, to bound what is decoded
    into Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


class Memo:
    """Bounded memory of per-unit results inside one Python worker.

    A *unit* is a stretch of text that a tokenizer treats alone. Misses are
    cut into smaller pieces by ``split``, only unknown pieces reach
    ``encode_many`` (one library call for all), and ``combine`` joins their
    results. Once ``limit`` entries are held the memory starts anew: results
    never depend on what it holds."""

    def __init__(self, encode_many, split, combine, limit: int = 1_000_000, known=None):
        self.encode_many, self.split, self.combine, self.limit = encode_many, split, combine, limit
        self.known = known or {}
        self.units: dict = {}
        self.pieces: dict = dict(self.known)

    def values(self, units: list) -> list:
        if len(self.units) > self.limit:
            self.units = {}
        if len(self.pieces) > self.limit:
            self.pieces = dict(self.known)
        got = list(map(self.units.get, units))
        missed = [i for i, v in enumerate(got) if v is None]
        if missed:
            self._learn({units[i] for i in missed})
            for i in missed:
                got[i] = self.units[units[i]]
        return got

    def _learn(self, units: set) -> None:
        cut = {u: self.split(u) for u in units}
        new = list({p for ps in cut.values() for p in ps if p not in self.pieces})
        if new:
            self.pieces.update(zip(new, self.encode_many(new)))
        at, combine = self.pieces.__getitem__, self.combine
        for u, ps in cut.items():
            self.units[u] = combine(map(at, ps))


# A blank before anything but white space always starts a new match of the
# rank files' pattern: the run of white space before it ends one short of it,
# and no other alternative holds a blank inside.
_BOUNDARY = re.compile(r"(?= \S)")
_ODD_BLANK = re.compile(r" (?:\s|\Z)")
# Texts of these characters alone are split here exactly as the pattern does:
# letters, digits and the rest are told apart alike by every Unicode version.
_PLAIN = re.compile(r"[\n\x20-\x7EÀ-ÿ]*")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")


def blank_units(text: str) -> tuple[str, list]:
    """Cut a text at the safe boundaries: the head, and the units after it
    without the blank that each starts with."""
    if _ODD_BLANK.search(text) is None:
        head, *rest = text.split(" ")
        return head, rest
    head, *rest = _BOUNDARY.split(text)
    if not head and rest:          # the text starts with a boundary
        return "", [u[1:] for u in rest]
    return head, [u[1:] for u in rest]


def pattern_pieces(unit: str) -> list:
    """Pieces of one unit (its blank given back) that can be encoded apart."""
    unit = " " + unit
    return _PIECE.findall(unit) if len(unit) < 200 and _PLAIN.fullmatch(unit) else [unit]


def quiet_tokenizers() -> None:
    """One thread per Python worker: Spark runs as many workers as cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
