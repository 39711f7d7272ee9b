"""Best-fit packing with certified bounds.

Documents become token pieces of at most ``capacity`` ids where they are read.
Packing then looks at lengths only. Every partition packs its pieces best-fit
decreasing and computes a lower bound on its bins from dual-feasible
functions; bins == bound certifies the partition. Bins without room are final.
From partitions with a gap the bins with room, and from certified ones the
emptiest bin (the rounding of its bound), go to a common exchange, spread over
fewer partitions, and are packed again; a round is kept only if it needs fewer
bins. When gaps yield no more, the remainders of the certified partitions join
in. Rounds end when the bins with room meet their own bound, or when nothing
is gained."""

from __future__ import annotations

import functools
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, state int"

_L = "A-Za-zÀ-ÖØ-öø-ÿ"
# The word vocabulary drops white space and never looks across it, so these
# four blanks are safe boundaries; letters and single marks are told apart the
# same way by every Unicode version in the plain range.
_PLAIN_UNIT = re.compile(r"[\x21-\x7EÀ-ÿ]{1,200}")
_PLAIN_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^\s{_L}0-9]+")


def word_units(text: str) -> list:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


@functools.lru_cache(1024)
def _layout(n: int) -> struct.Struct:
    return struct.Struct(f"<{n}I")


class WordEncoder:
    """Ids of whole texts under a white-space-free vocabulary, as bytes of
    little-endian unsigned 32-bit ids, with a bounded memory per worker."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        C.quiet_tokenizers()
        self.t = Tokenizer.from_file(path)
        self.special = [x.content for x in self.t.get_added_tokens_decoder().values()]
        # plain pieces need no normalizing and no splitting any more: they go
        # to the merges straight away, in the byte-level alphabet
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {i: spell(chr(i))[0][0] for i in range(0xC0, 0x100)}
        self.merges = self.t.model.tokenize
        self.memo = C.Memo(self._many, self._split, b"".join, limit)

    def _split(self, unit: str) -> list:
        if unit.isascii() and unit.isalpha() and len(unit) <= 200:       # the most frequent plain unit
            return [unit.lower()]
        if _PLAIN_UNIT.fullmatch(unit) and not ("<" in unit and any(s in unit for s in self.special)):
            return _PLAIN_PIECE.findall(unit.lower())
        return [unit] if unit else []

    def _many(self, pieces: list) -> list:
        out, merges = [], self.merges
        for p in pieces:
            if p.isascii() and p.isalpha() and len(p) <= 200:            # spelt alike in that alphabet
                ids = [x.id for x in merges(p)]
            elif _PLAIN_UNIT.fullmatch(p) and _PLAIN_PIECE.fullmatch(p):
                ids = [x.id for x in merges(p.translate(self.alphabet))]
            else:
                ids = self.t.encode(p, add_special_tokens=False).ids
            out.append(_layout(len(ids)).pack(*ids))
        return out

    def __call__(self, text: str) -> bytes:
        return b"".join(self.memo.values(word_units(text)))


@functools.lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    """One per Python worker: what a task has learned serves the next one."""
    return WordEncoder(path)


def token_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = 2048,
                 end_id: int = 0, with_ids: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``, cut every
    ``capacity`` ids. ``with_ids`` adds the ids as bytes (``ids``)."""
    def run(batches):
        enc = word_encoder(C.vocabulary(vocabulary))
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in C.slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc(text or "") + end
                for k, i in enumerate(range(0, len(ids), step)):
                    part = ids[i:i + step]
                    rows.append((doc_id, k, i // 4, len(part) // 4, zlib.crc32(part))
                                + ((part,) if with_ids else ()))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), C.ARROW_BYTES]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            cols = list(zip(*rows)) or [[]] * (5 + with_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names[:len(cols)])

    return C.id_text(docs, id_col, text_col).mapInArrow(
        run, PIECES + (f", ids {C.BYTES}" if with_ids else ""))


def lower_bound(lengths, counts, capacity: int) -> int:
    """Largest of the bounds that dual-feasible functions give for the number
    of bins: any such f with sum(f(x)) over a bin <= 1 proves
    ceil(sum f(x)) bins. Two families: the threshold functions (items over
    capacity - a count whole, items under a not at all) for every a, and the
    rounding functions u_k for k = 1..32. Integer arithmetic throughout."""
    x, n = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    if not n.sum():
        return 0
    up = lambda total, unit: int(-(-int(total) // unit))
    best = up((x * n).sum(), capacity)
    for a in np.unique(x[x <= capacity // 2]):
        f = np.where(x > capacity - a, capacity, np.where(x < a, 0, x))
        best = max(best, up((f * n).sum(), capacity))
    for k in range(1, 33):
        y = x * (k + 1)
        f = np.where(y % capacity == 0, x * k, y // capacity * capacity)   # in 1/(k*capacity)
        best = max(best, up((f * n).sum(), k * capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every item, room left per bin.
    Bins wait by the room they have; a bit mask finds the least room that
    still fits."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, left = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = mask >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            k = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, k = capacity, len(left)
            left.append(capacity)
        where[i], offset[i], left[k] = k, capacity - room, room - n
        if room > n:
            rooms[room - n].append(k)
            mask |= 1 << (room - n)
    return where, offset, np.asarray(left, np.int64)


def _pack_partitions(pieces: DataFrame, capacity: int, turn: int, run_items: int) -> DataFrame:
    """Pack what each partition holds, ``run_items`` pieces at a time."""
    names = [c.split()[0] for c in PIECES.split(",")]

    def pack(pdf: pd.DataFrame, first: int) -> tuple[pd.DataFrame, int]:
        lengths = pdf["length"].to_numpy()
        where, offset, left = best_fit(lengths, capacity)
        bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        # 0: no room left, 1: room in a certified partition, 2: to be exchanged
        state = np.where(left == 0, 0, 2 if len(left) > bound else 1)
        state[np.argmax(left)] = 2 if left.max() else 0
        place = (turn << 58) | (TaskContext.get().partitionId() << 34) | first
        return pdf.assign(sequence_id=where + place, offset=offset, state=state[where]), len(left)

    def run(frames):
        held, n, first = [], 0, 0
        for pdf in frames:
            held.append(pdf[names])
            n += len(pdf)
            if n >= run_items:
                out, bins = pack(pd.concat(held, ignore_index=True), first)
                first, held, n = first + bins, [], 0
                yield out
        if n:
            yield pack(pd.concat(held, ignore_index=True), first)[0]

    return pieces.select(*names).mapInPandas(run, PACKED)


def pack(pieces: DataFrame, capacity: int = 2048, run_items: int = 200_000,
         rounds: int = 6) -> DataFrame:
    """Pieces (``PIECES`` columns, lengths 1..capacity) with their
    ``sequence_id`` and ``offset``. Null ids and repeated rows are items like
    any other; an empty table packs into nothing."""
    def again(some: DataFrame, turn: int) -> DataFrame | None:
        """Another packing of the bins in ``some``, if it needs fewer."""
        hist = some.groupBy("length").count().collect()       # at most `capacity` rows
        items = sum(r["count"] for r in hist)
        bins = some.select("sequence_id").distinct().count()
        if bins <= max(1, lower_bound([r["length"] for r in hist], [r["count"] for r in hist], capacity)):
            return None
        together = 4 * run_items                    # open bins are few: more of them meet
        spread = some.repartition(max(1, -(-items // together)))
        new = C.saved(_pack_partitions(spread, capacity, turn, together), "packed")
        return new if new.select("sequence_id").distinct().count() < bins else None

    out = C.saved(_pack_partitions(pieces, capacity, 0, run_items), "packed")
    done, rest = out.filter("state = 0"), out.filter("state > 0")
    for turn in range(1, rounds + 1):
        for least in (2, 1):
            new = again(rest.filter(F.col("state") >= least), turn)
            if new is not None:
                done = done.unionByName(new.filter("state = 0"))
                rest = rest.filter(F.col("state") < least).unionByName(new.filter("state > 0"))
                break
        else:
            break
    return done.unionByName(rest).drop("state")


def best_fit_packing(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = 2048,
                     end_id: int = 0, run_items: int = 200_000, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens:
    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null or empty text is a document of the end id alone; null ids and
    repeated rows are packed like any other; texts of any length are cut into
    pieces, never dropped; other columns are ignored; an empty table gives an
    empty result."""
    return pack(C.saved(token_pieces(docs, vocabulary, capacity, end_id, id_col=id_col,
                                     text_col=text_col), "pieces"), capacity, run_items)
