"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document; its minimiser is the
smallest hash among its word pairs. Consecutive windows whose minimisers
fall in the same bucket travel as one packed string (a super-k-mer) instead of
one string each. In a bucket the windows are sorted and counted exactly: equal
windows always have the same minimiser, so they meet.

1. A first pass adds up how many words every minimiser slot will receive (a
   table of 2^13 to 2^20 slots, by the input's estimated size). Small slots
   share buckets of about ``bucket_words``. A larger slot is divided: by further
   bits of its minimisers, which leaves super-k-mers whole, or, if it is far
   over the mean (a very common line or phrase), by a second key of the window,
   its largest pair hash.
2. Blocks of documents are cut into super-k-mers. Equal ones of a block are
   sent once, with the smallest and largest doc_id that has them; a group of
   copies costs one string per block. What travels is compressed.
3. Buckets find the smallest doc_id of every window and answer each block with
   the ranges of windows that started in a smaller document. Where the input
   has more than ``group_blocks`` blocks, the packets of far too large slots
   are merged first, those of so many blocks at a time: windows that repeat
   there go on once, so a window that is in every block is no large group.
4. Blocks turn answers into word ranges per document, which join the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PAIR = 2
SLICE = 256          # texts that are decoded into Python objects at a time
CHARS = 250_000      # of texts whose words are Python objects at a time (or one text)
SLOTS, MOST_SLOTS = 1 << 13, 1 << 20
PACKET = f"bucket long, block string, payload {C.BYTES}"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULT = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()          # of bytes: ASCII white space only


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i:i+width] for every i that has so many."""
    n = len(x) - width + 1
    span, y = 1, x
    while span * 2 <= width:
        y = op(y[:len(y) - span], y[span:])
        span *= 2
    return op(y[:n], y[width - span:width - span + n])


def window_keys(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser and second key (64 bits each, mixed) of the window at every word."""
    t = hashes[:-1] * _MULT[0] + hashes[1:] * _MULT[1]
    t = (t ^ (t >> np.uint64(29))) * _MIX
    width = window - PAIR + 1
    low, high = _sliding(t, width, np.minimum), _sliding(t, width, np.maximum)
    mix = lambda x: ((x ^ (x >> np.uint64(31))) * _MULT[0]) ^ (x >> np.uint64(17))
    return mix(low), mix(high)


def slots_of(first: np.ndarray, slots: int) -> np.ndarray:
    """Slot (of a power of two) of each minimiser: its leading bits."""
    return (first >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _slots(rows: DataFrame, bucket_words: int) -> int:
    """Slots for about a quarter bucket each, by the planner's estimate of the
    input's bytes. The result does not depend on it, only the buckets' evenness."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = 4 * size // (6 * bucket_words)
    return min(MOST_SLOTS, max(SLOTS, 1 << wanted.bit_length()))


def _some(texts: list) -> Iterator[list]:
    """The texts in parts of about ``CHARS`` characters, one text at least."""
    some, n = [], 0
    for t in texts:
        some.append(t)
        n += len(t or "")
        if n >= CHARS:
            yield some
            some, n = [], 0
    yield some


class Block:
    """Words of some documents, one after the other, and where windows start.
    The words stay as one string (``joined``, by blanks) with their lengths
    ``sizes``, if asked to ``keep`` them; only those of a few texts at a time
    are Python objects."""

    def __init__(self, texts: list, window: int, keep: bool = False):
        starts, at, first, second, doc, joined, sizes = [], [], [], [], [], [], []
        docs = n = 0
        for some in _some(texts):
            cut = [words_of(t) for t in some]
            words = [w for ws in cut for w in ws]
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            del cut
            ends = np.cumsum(lengths)
            starts.append(n + ends - lengths)
            if len(words) >= window:
                own = np.repeat(np.arange(len(lengths)), lengths)
                inside = np.flatnonzero(np.arange(len(words)) + window <= ends[own])  # of a document
                keys = window_keys(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), window)
                for held, x in zip((at, first, second, doc), (n + inside, *(k[inside] for k in keys),
                                                              docs + own[inside])):
                    held.append(x)
            if keep and words:
                joined.append(b" ".join(words))
                sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
            docs, n = docs + len(lengths), n + len(words)
        none = [np.zeros(0, np.int64)]
        self.starts = np.concatenate(starts)
        self.at, self.doc = np.concatenate(at or none), np.concatenate(doc or none)
        self.first, self.second = (np.concatenate(x or [np.zeros(0, np.uint64)]) for x in (first, second))
        self.joined, self.sizes = b" ".join(joined), np.concatenate(sizes or none)

    def runs(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each super-k-mer."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.flatnonzero((np.diff(self.at) != 1) | (np.diff(bucket) != 0)
                             | (np.diff(self.doc) != 0)) + 1
        first = np.concatenate([[0], new])
        return first, np.diff(np.append(first, len(self.at)))


def _blocks(batches, chars: int):
    """(ids, hashes, texts) of up to about ``chars`` characters."""
    ids, keys, texts, n = [], [], [], 0
    for b in C.slices(batches):
        for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            ids.append(C.NO_ID if i is None else i)
            keys.append(k)
            texts.append(t)
            n += len(t or "") + 64
            if n >= chars:
                yield ids, keys, texts
                ids, keys, texts, n = [], [], [], 0
    if ids:
        yield ids, keys, texts


def _load(window: int, chars: int, slots: int):
    def run(batches):
        load, blocks = np.zeros(slots, np.int64), 0
        for _, _, texts in _blocks(batches, chars):
            blocks += 1
            b = Block(texts, window)
            slot = slots_of(b.first, slots)
            first, n = b.runs(slot)
            load += np.bincount(slot[first], n + window - 1, slots).astype(np.int64)
            del texts, b, slot, first, n                    # before the next block is read
        used = np.flatnonzero(load)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, slots)),
                                          pa.array(np.append(load[used], blocks))], ["slot", "words"])
    return run


class Buckets:
    """Slots cut into buckets of about ``size`` words. A slot over ``size`` has
    buckets of its own, by its minimisers; over four times the mean as well, by
    the second key, as one minimiser may then make up most of it."""

    def __init__(self, load: np.ndarray, size: int):
        large = load > size
        self.hot = large & (load > 4 * load.mean())
        self.any_calm = bool((large & ~self.hot).any())
        self.parts = np.where(large, -(-load // size), 1)
        small = np.where(large, 0, load)
        place = (np.cumsum(small) - small) // size
        own = lambda which: np.cumsum(np.where(which, self.parts, 0)) - self.parts
        shared = int(place.max()) + 1
        self.first_hot = shared + int(self.parts[large & ~self.hot].sum())
        self.base = np.where(self.hot, self.first_hot + own(self.hot),
                             np.where(large, shared + own(large & ~self.hot), place))
        self.count = self.first_hot + int(self.parts[self.hot].sum())

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        slot = slots_of(first, len(self.parts))
        key = np.where(self.hot[slot], second, first) if self.any_calm else second
        return self.base[slot] + (key % self.parts[slot].astype(np.uint64)).astype(np.int64)


def _pack(*arrays) -> bytes:
    """Integer arrays (as differences, which are mostly small) and bytes in
    one compressed payload."""
    raw = [a if isinstance(a, bytes) else np.diff(a, prepend=a.dtype.type(0)).tobytes()
           for a in arrays]
    head = np.array([len(raw), *map(len, raw)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def _unpack(payload: bytes, *kinds) -> list:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    sizes = np.frombuffer(raw, "<i8", 1 + len(kinds))[1:]
    out, at = [], 8 * (1 + len(kinds))
    for n, kind in zip(sizes.tolist(), kinds):
        part = raw[at:at + n]
        out.append(part if kind is None else np.cumsum(np.frombuffer(part, kind), dtype=kind))
        at += n
    return out


def _packets(ids: list, keys: list, texts: list, block: str, window: int, buckets: Buckets) -> list[tuple]:
    """Rows of ``PACKET`` that a block sends."""
    b = Block(texts, window, keep=True)
    ids = np.array(ids, np.int64)
    bucket = buckets.of(b.first, b.second)
    first, n = b.runs(bucket)
    stop = np.cumsum(b.sizes + 1) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    known: dict = {}
    number = np.fromiter((known.setdefault(b.joined[x:y], len(known)) for x, y in zip(
        start[b.at[first]].tolist(), stop[b.at[first] + n + window - 2].tolist())), np.int32, len(first))
    strings = list(known)
    del known, start, stop
    doc = b.doc[first]
    low = np.full(len(strings), C.NO_ID)
    high = np.full(len(strings), -C.NO_ID)
    np.minimum.at(low, number, ids[doc])
    np.maximum.at(high, number, ids[doc])
    where, wide = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int32)
    where[number], wide[number] = bucket[first], n
    # what the block needs to read its answers goes straight to it
    rows = [(-1 - (xxhash.xxh64_intdigest(block) >> 2), block,
             _pack(ids, np.array(keys, np.int64), number, doc.astype(np.int32),
                   (b.at[first] - b.starts[doc]).astype(np.int32)))]
    del b
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order])) + 1
    for some in np.split(order, cuts) if len(order) else []:
        rows.append((int(where[some[0]]), block, _pack(
            b"\n".join([strings[i] for i in some.tolist()]), some.astype(np.int32),
            wide[some], low[some], high[some])))
    return rows


def _send(window: int, chars: int, buckets: Buckets):
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for ids, keys, texts in _blocks(batches, chars):
            rows = _packets(ids, keys, texts, f"{part}-{k}", window, buckets)
            k += 1
            del ids, keys, texts
            for i in range(0, len(rows), 200):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 200]),
                                                    (pa.int64(), pa.string(), C.ARROW_BYTES))],
                    ["bucket", "block", "payload"])
            del rows                                       # before the next block is read
    return run


_BASE = 0xD1342543DE82EF95                                # odd: has an inverse modulo 2^64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def sorted_windows(ids: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows of word ids starting at ``at`` that brings equal
    ones together, and whether each equals the next. Windows are sorted by a
    rolling hash; neighbours are compared word by word, and if a hash ever
    stands for two windows, all words are sorted."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(32)
    total = np.cumsum(np.concatenate([[np.uint64(0)], x * _powers(_BASE, len(x))]), dtype=np.uint64)
    h = (total[window:] - total[:-window]) * _powers(pow(_BASE, -1, 1 << 64), len(x) - window + 1)
    h = h[at]
    h ^= h >> np.uint64(29)
    order = np.argsort(h)
    same = np.diff(h[order]) == 0
    twin = np.flatnonzero(same)
    a, b = at[order[twin]], at[order[twin + 1]]
    equal = np.ones(len(twin), bool)
    for j in range(window):
        equal &= ids[a + j] == ids[b + j]
    if not equal.all():
        order = np.lexsort([ids[at + j] for j in range(window)])
        s = at[order]
        same = np.ones(len(s) - 1, bool)
        for j in range(window):
            same &= ids[s[1:] + j] == ids[s[:-1] + j]
    return order, same


def smallest_start(ids: np.ndarray, at: np.ndarray, low: np.ndarray, window: int) -> np.ndarray:
    """For windows of word ids starting at ``at``: the smallest ``low`` of all
    equal windows."""
    order, same = sorted_windows(ids, at, window)
    out = low.copy()                                       # a window that occurs once: its own
    some = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
    if len(some):
        first = ~np.insert(same, 0, False)[some]           # of each group of equal windows
        least = np.minimum.reduceat(low[order[some]], np.flatnonzero(first))
        out[order[some]] = least[np.cumsum(first) - 1]
    return out


class Received:
    """The super-k-mers of some packets, one after the other: their word ids
    (and ``words``, if asked), and of each window its super-k-mer, offset there
    and place."""

    def __init__(self, payloads, window: int, words: bool = False):
        ids, number, wide, low, high, packet = [], [], [], [], [], []
        numbers, self.words = _Numbers(), [] if words else None
        for i, p in enumerate(payloads):
            s, *rest = _unpack(p, None, np.int32, np.int32, np.int64, np.int64)
            cut = s.split()                                # of one packet: objects of its words only
            ids.append(np.fromiter(map(numbers.__getitem__, cut), np.int32, len(cut)))
            if words:
                self.words += cut
            for held, x in zip((number, wide, low, high), rest):
                held.append(x)
            packet.append(np.full(len(rest[0]), i))
        self.ids = np.concatenate(ids)
        del numbers, ids, cut, s
        self.number, wide, self.low, self.high, self.packet = map(
            np.concatenate, (number, wide, low, high, packet))
        wide = wide.astype(np.int64)
        begin = np.cumsum(wide + window - 1) - (wide + window - 1)
        self.own = np.repeat(np.arange(len(wide)), wide)
        self.off = np.arange(len(self.own)) - np.repeat(np.cumsum(wide) - wide, wide)
        self.at = begin[self.own] + self.off


def _merge(window: int):
    """Packets of one bucket from some blocks, as one packet: windows that
    repeat are cut out and go once, runs of others stay whole. ``kind`` 1 is
    that packet, ``kind`` 2 tells where its strings came from."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r = Received(pdf["payload"], window, words=True)
        order, same = sorted_windows(r.ids, r.at, window)
        group = np.empty(len(order), np.int64)               # of equal windows
        group[order] = np.cumsum(np.append(False, ~same))
        many = np.bincount(group)[group] > 1
        first = np.flatnonzero(np.concatenate([[True], (np.diff(r.own) != 0) | many[1:] | many[:-1]]))
        wide = np.diff(np.append(first, len(group)))
        low, high = r.low[r.own[first]], r.high[r.own[first]]
        # a run of others has a group of its own: that of its first window
        _, head, number = np.unique(group[first], return_index=True, return_inverse=True)
        least, most = np.full(len(head), C.NO_ID), np.full(len(head), -C.NO_ID)
        np.minimum.at(least, number, low)
        np.maximum.at(most, number, high)
        at, wide = r.at[first[head]], wide[head]
        strings = [b" ".join(r.words[a:a + n + window - 1]) for a, n in zip(at.tolist(), wide.tolist())]
        me = f"~{key[0]}.{key[1]}"
        own = r.own[first]
        return pd.DataFrame([
            (1, key[0], me, _pack(b"\n".join(strings), np.arange(len(head), dtype=np.int32),
                                  wide.astype(np.int32), least, most)),
            (2, key[0], me, _pack("\n".join(pdf["block"]).encode(), number.astype(np.int32),
                                  r.packet[own].astype(np.int32), r.number[own].astype(np.int32),
                                  r.off[first].astype(np.int32)))],
            columns=["kind", "bucket", "block", "payload"])
    return run


def _pass_on(pdf: pd.DataFrame) -> pd.DataFrame:
    """The answer to a merged packet, as answers to the blocks it came from."""
    note = pdf[pdf["kind"] == 2].iloc[0]
    names, number, packet, string, start = _unpack(note["payload"], None, *[np.int32] * 4)
    names = names.decode().split("\n")
    order = np.argsort(number, kind="stable")
    number, packet, string, start = (x[order] for x in (number, packet, string, start))
    rows = []
    for p in pdf[pdf["kind"] == 1]["payload"]:
        want, off, n, least = _unpack(p, np.int32, np.int32, np.int32, np.int64)
        a, b = np.searchsorted(number, want), np.searchsorted(number, want, "right")
        which = np.repeat(np.arange(len(want)), b - a)
        inst = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[which]
        turn = np.lexsort((start[inst] + off[which], string[inst], packet[inst]))
        which, inst = which[turn], inst[turn]
        for some in np.split(np.arange(len(inst)), np.flatnonzero(np.diff(packet[inst])) + 1):
            if len(some):
                i, w = inst[some], which[some]
                rows.append((note["bucket"], names[packet[i[0]]], _pack(
                    string[i], start[i] + off[w], n[w], least[w])))
    return pd.DataFrame(rows, columns=["bucket", "block", "payload"])


def _count(window: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return pdf                                     # a block's own notes pass through
        r = Received(pdf["payload"], window)
        own, off, number, blocks, high = r.own, r.off, r.number, r.packet, r.high
        least = smallest_start(r.ids, r.at, r.low[own], window)
        hit = np.flatnonzero(least < high[own])
        if not len(hit):
            return pdf.iloc[:0]
        own, off, least = own[hit], off[hit], least[hit]
        first = np.concatenate([[0], np.flatnonzero(
            (np.diff(own) != 0) | (np.diff(off) != 1) | (np.diff(least) != 0)) + 1])
        length = np.diff(np.append(first, len(own)))
        block = blocks[own[first]]
        rows = []
        for some in np.split(np.arange(len(first)), np.flatnonzero(np.diff(block)) + 1):
            f = first[some]
            rows.append((key[0], pdf["block"].iloc[block[some[0]]], _pack(
                number[own[f]], off[f].astype(np.int32), length[some].astype(np.int32), least[f])))
        return pd.DataFrame(rows, columns=["bucket", "block", "payload"])
    return run


def _ranges(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        notes = pdf[pdf["bucket"] < 0]["payload"].iloc[0]
        ids, keys, number, doc, start = _unpack(notes, np.int64, np.int64, np.int32, np.int32, np.int32)
        order = np.argsort(number, kind="stable")
        number, doc, start = number[order], doc[order], start[order]
        docs, begins, ends = [], [], []
        for p in pdf[pdf["bucket"] >= 0]["payload"]:
            want, off, n, least = _unpack(p, np.int32, np.int32, np.int32, np.int64)
            a, b = np.searchsorted(number, want), np.searchsorted(number, want, "right")
            which = np.repeat(np.arange(len(want)), b - a)       # answer for each instance
            inst = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[which]
            ok = least[which] < ids[doc[inst]]
            which, inst = which[ok], inst[ok]
            docs.append(doc[inst])
            begins.append(start[inst].astype(np.int64) + off[which])
            ends.append(begins[-1] + n[which] + window - 1)
        rows = []
        if docs:
            docs, begins, ends = map(np.concatenate, (docs, begins, ends))
            order = np.lexsort((begins, docs))
            docs, begins, ends = docs[order], begins[order], ends[order]
            for some in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(docs)) + 1):
                if not len(some):
                    continue
                reach = np.maximum.accumulate(ends[some])
                new = np.concatenate([[True], begins[some][1:] > reach[:-1]])
                last = np.append(np.flatnonzero(new)[1:] - 1, len(some) - 1)
                d = docs[some[0]]
                rows.append((ids[d], keys[d], np.stack([begins[some][new], reach[last]], 1)
                             .astype("<i8").tobytes()))
        return pd.DataFrame(rows, columns=["id", "key", "ranges"])
    return run


def _answers(packets: DataFrame, window: int, first_hot: int, salts: int) -> DataFrame:
    """Answers to blocks (and their notes). With ``salts`` over 1 the packets
    of buckets from ``first_hot`` on are merged first, in so many parts."""
    if salts == 1:
        return packets.groupBy("bucket").applyInPandas(_count(window), PACKET)
    merge, count = _merge(window), _count(window)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[["bucket", "block", "payload"]]
        return merge(key, pdf) if key[0] >= first_hot else count(key, pdf).assign(kind=0)

    part = F.when(F.col("bucket") >= first_hot, F.pmod(F.xxhash64("block"), F.lit(salts))).otherwise(0)
    some = C.saved(packets.withColumn("part", part).groupBy("bucket", "part").applyInPandas(
        run, "kind int, " + PACKET), "merged")
    packet = ["bucket", "block", "payload"]
    merged = some.filter("kind = 1").select(packet).groupBy("bucket").applyInPandas(count, PACKET)
    back = some.filter("kind = 2").unionByName(merged.withColumn("kind", F.lit(1)))
    return some.filter("kind = 0").select(packet).unionByName(
        back.groupBy("block").applyInPandas(_pass_on, PACKET))


def duplicate_ranges(docs: DataFrame, window: int = 13, block_chars: int = 3_000_000,
                     bucket_words: int = 1_000_000, group_blocks: int = 4096) -> DataFrame:
    """``id, key, ranges``: of documents (``doc_id, text``) with words to
    remove, the word ranges [begin, end) as pairs of little-endian longs. id is
    the doc_id (NO_ID if missing), key the XXH64 of the text."""
    rows = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("key"), "text")
    slots = _slots(rows, bucket_words)
    load = np.zeros(slots + 1, np.int64)                    # the last: number of blocks
    used = (rows.mapInArrow(_load(window, block_chars, slots), "slot long, words long")
            .groupBy("slot").agg(F.sum("words").alias("words")).toArrow())       # a row per slot at most
    load[used.column("slot").to_numpy()] = used.column("words").to_numpy()
    buckets, blocks = Buckets(load[:-1], bucket_words), int(load[-1])
    packets = rows.mapInArrow(_send(window, block_chars, buckets), PACKET)
    answers = _answers(packets, window, buckets.first_hot, max(1, -(-blocks // group_blocks)))
    return (answers.groupBy("block").applyInPandas(_ranges(window), f"id long, key long, ranges {C.BYTES}")
            .dropDuplicates(["id", "key"]))


def substring_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Every input row with all its columns in the struct ``row``, the words
    that stay joined by one blank (``kept``), ``n_words`` and ``n_removed``.

    Words are runs of anything but ASCII white space, unchanged. A word goes if
    a window over it has the words of a window that starts in a document of
    smaller doc_id, all on the input. A null text has no words and stays null
    in ``row``; a missing doc_id counts as larger than all; repeated rows of an
    id never remove each other's words; a text shorter than a window keeps
    all. ``docs`` should be a written table: blocks are told by the order in
    which a task reads its rows."""
    ranges = duplicate_ranges(C.id_text(docs, id_col, text_col), window)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col].cast("string")
    joined = rows.join(ranges, (F.coalesce(F.col("row")[id_col].cast("long"), F.lit(C.NO_ID))
                                == ranges["id"]) & (F.xxhash64(text) == ranges["key"]), "left") \
        .select("row", text.alias("text"), "ranges")

    # only the text and its ranges go to Python: the other columns stay where they are
    @F.arrow_udf("kept string, n_words long, n_removed long")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            parts = []
            for i in range(0, max(1, len(texts)), SLICE):
                kept, total, gone = [], [], []
                for t, r in zip(texts.slice(i, SLICE).to_pylist(), ranges.slice(i, SLICE).to_pylist()):
                    words = words_of(t)
                    total.append(len(words))
                    removed = 0
                    for x, y in np.frombuffer(r, "<i8").reshape(-1, 2)[::-1].tolist() if r else ():
                        del words[x:y]
                        removed += y - x
                    gone.append(removed)
                    kept.append(b" ".join(words).decode())
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                    ["kept", "n_words", "n_removed"]))
            yield pa.concat_arrays(parts)

    # not deterministic for the planner: it may not repeat the call in projections
    return joined.select("row", cut.asNondeterministic()("text", "ranges").alias("_cut")) \
        .select("row", "_cut.kept", "_cut.n_words", "_cut.n_removed")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                         lambda x: x <> '') AS w FROM documents),
n AS (SELECT r, doc_id, i, w[i:i+12] AS win FROM
      (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT *, min(doc_id) OVER (PARTITION BY win) AS least FROM n),
h AS (SELECT r, i FROM m WHERE least < doc_id),
c AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM h),
x AS (SELECT d.r, i, w[i] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) d),
k AS (SELECT x.r, count(c.i) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL), '') AS kept
      FROM x LEFT JOIN c ON x.r = c.r AND x.i = c.i GROUP BY x.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
