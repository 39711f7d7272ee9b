"""Language ID by segmentation-marginalised unigrams.

A language is a unigram model over the pieces of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces,
by the forward algorithm; a text's is the product over its words. Piece
probabilities start from piece occurrences and are refined by expectation
maximisation over the same lattice. All letter pieces take part and words stay
whole, however long. The forward pass is one numpy recursion over many words of
a length at once; per-word results live in a bounded memory of the Python
worker."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

UNDETERMINED = "und"
FLOOR = 1e-7         # probability of a letter that is no piece, and of unseen pieces
STEP = 8             # positions between two rescalings of the recursion
SLICE = 256          # texts that are decoded into Python objects at a time
LETTERS = 65_536     # letters of a batch of words that are held as a lattice at once
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_PIECE = regex.compile(r" ?[\p{L}\p{M}]*")


class Pieces:
    """Pieces of letters and marks of a public vocabulary, lower case, indexed
    from 1 (0 is the unknown letter); a piece that starts a word carries a
    leading blank. Kept as a trie in arrays: the child of node x over letter c
    is found by bisection for x * letters + c."""

    def __init__(self, found: list[str]):
        self.size = len(found) + 1
        self.longest = max(map(len, found), default=1)
        letters = sorted(set("".join(found)))
        self.width = len(letters) + 1
        self.code = np.zeros(0x110000, np.int64)
        for i, c in enumerate(letters, 1):
            self.code[ord(c)] = i
        nodes, edges, piece = {"": 0}, {}, [-1]
        for i, p in enumerate(found, 1):
            for j in range(1, len(p) + 1):
                if p[:j] not in nodes:
                    nodes[p[:j]] = len(piece)
                    edges[nodes[p[:j - 1]] * self.width + int(self.code[ord(p[j - 1])])] = len(piece)
                    piece.append(-1)
            piece[nodes[p]] = i
        self.dead = len(piece)
        self.piece = np.array(piece + [-1], np.int32)
        self.keys = np.array(sorted(edges) + [np.iinfo(np.int64).max])
        self.child = np.array([edges[k] for k in sorted(edges)] + [self.dead])

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = node * self.width + code
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.child[at], self.dead)


@functools.cache
def pieces(vocabulary: str) -> Pieces:
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=C.vocabulary(vocabulary))
    found = (m.id_to_piece(i).replace("▁", " ").lower() for i in range(m.get_piece_size()))
    return Pieces(sorted({p for p in found if p and _PIECE.fullmatch(p)}))


def words_of(unit: str) -> list[str]:
    """Scored words of a stretch without white space: its runs of letters and
    the marks on them, whole and in lower case, with the blank that starts a
    word."""
    return [" " + w for w in _WORD.findall(unit.lower())]


def lattice(words: list[str], index: Pieces, start: int = 0, stop: int | None = None) -> np.ndarray:
    """For words of one length n: piece index of word[j-l:j] at
    [:, j - start, l] for the ends j from ``start`` to ``stop`` (n), -1 where
    that is no piece; single characters are always allowed."""
    k, n = len(words), len(words[0])
    stop = n if stop is None else stop
    top = min(index.longest, n)
    low = max(0, start - top)                                # first character that a piece may start at
    code = index.code[np.frombuffer("".join(w[low:stop] for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
                      .reshape(k, stop - low)]
    out = np.full((k, stop - start + 1, top + 1), -1, np.int32)
    node = np.zeros((k, stop - low), np.int64)
    for l in range(1, min(top, stop - low) + 1):
        node = index.step(node[:, :stop - low - l + 1], code[:, l - 1:])
        if (node == index.dead).all():
            break
        first = low + l                                      # end of the first piece of this length
        skip = max(0, start - first)
        out[:, first + skip - start:, l] = index.piece[node[:, skip:]]
    single = out[:, 1 if start == 0 else 0:, 1]
    np.maximum(single, 0, out=single)
    return out


class Forward:
    """The forward recursion over words of one length, a part of their ends at
    a time: of what was before only the last positions are held, with their
    common scale, so runs of any length neither underflow nor fill memory.
    ``p[piece, lang]``."""

    def __init__(self, k: int, p: np.ndarray, top: int):
        self.p = np.vstack([p, np.zeros((1, p.shape[1]))])   # index -1: no piece
        self.top, self.scale = top, np.zeros((k, p.shape[1]))
        self.tail = np.zeros((k, top, p.shape[1]))
        self.tail[:, -1] = 1.0                               # position 0: the empty prefix

    def over(self, lat: np.ndarray, every: bool = False) -> np.ndarray:
        """Logarithms of the total probability of the characters up to the last
        end of ``lat`` (its first is where the part before stopped) over all
        segmentations; ``every``: up to each end, [word, end, lang]."""
        top, m = self.top, lat.shape[1] - 1
        alpha = np.concatenate([self.tail, np.zeros((len(lat), m, self.tail.shape[2]))], axis=1)
        logs = [self.last()] if every else []
        used = (lat >= 0).any(axis=0)
        for j in range(1, m + 1):
            at = top - 1 + j
            ls = np.flatnonzero(used[j])
            alpha[:, at] = (alpha[:, at - ls] * self.p[lat[:, j, ls]]).sum(axis=1)
            if j % STEP == 0:
                held = alpha[:, at - top + 1:at + 1]
                most = np.maximum(held.max(axis=1), 1e-300)
                held /= most[:, None]
                self.scale += np.log(most)
            if every:
                logs.append(np.log(np.maximum(alpha[:, at], 1e-300)) + self.scale)
        self.tail = alpha[:, -top:].copy()
        return np.stack(logs, axis=1) if every else self.last()

    def last(self) -> np.ndarray:
        return np.log(np.maximum(self.tail[:, -1], 1e-300)) + self.scale


def log_forward(lat: np.ndarray, p: np.ndarray) -> np.ndarray:
    """[word, j, lang]: log of the total probability of the first j characters."""
    return Forward(len(lat), p, lat.shape[2] - 1).over(lat, every=True)


def forward(lat: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha[w, j, lang]: total probability of the first j characters over all
    segmentations; ``p[piece, lang]``."""
    return np.exp(log_forward(lat, p))


def _backward(lat: np.ndarray) -> np.ndarray:
    """The lattice of the words read from their ends."""
    out = np.full_like(lat, -1)
    for l in range(1, lat.shape[2]):
        out[:, l:, l] = lat[:, l:, l][:, ::-1]
    return out


def _batches(words: list[str]):
    """(rows, length) of words of one length, of bounded size together."""
    by_length: dict = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for n, rows in by_length.items():
        some = max(1, LETTERS // n)
        for i in range(0, len(rows), some):
            yield rows[i:i + some], n


def log_probabilities(words: list[str], index: Pieces, p: np.ndarray) -> np.ndarray:
    """log P(word | language) for every word, rows in the order given."""
    out = np.zeros((len(words), p.shape[1]))
    for rows, n in _batches(words):
        ws = [words[r] for r in rows]
        run = Forward(len(ws), p, min(index.longest, n))
        for start in range(0, n, LETTERS):
            run.over(lattice(ws, index, start, min(n, start + LETTERS)))
        out[rows] = run.last()
    return out


def fit(words: list[str], counts: np.ndarray, index: Pieces, rounds: int) -> np.ndarray:
    """Piece probabilities of one language by EM over counted words."""
    size, counts, p = index.size, np.asarray(counts, float), None
    for _ in range(rounds + 1):
        seen = np.zeros(size)
        for rows, n in _batches(words):
            lat, c = lattice([words[r] for r in rows], index), counts[rows]
            if p is not None:
                alpha = log_forward(lat, p[:, None])[:, :, 0]
                beta = log_forward(_backward(lat), p[:, None])[:, ::-1, 0]
                padded = np.append(p, 0.0)
            for l in range(1, lat.shape[2]):
                piece = lat[:, l:, l]
                row, at = np.nonzero(piece >= 0)             # a piece ends at l + at
                if p is None:                                # every occurrence counts alike
                    weight = c[row]
                else:
                    share = alpha[row, at] + beta[row, at + l] - alpha[row, n]
                    weight = c[row] * padded[piece[row, at]] * np.exp(share)
                seen += np.bincount(piece[row, at], weight, size)
        p = np.maximum(seen / max(seen.sum(), 1.0), FLOOR)
        p[0] = FLOOR
        p /= p.sum()
    return p


# ---------------------------------------------------------------- training
def train(docs: DataFrame, sample_docs: int = 2000, rounds: int = 2,
          vocabulary: str = "piece_bpe_32k.model", text_col: str = "text",
          lang_col: str = "lang", id_col: str = "doc_id", sample_letters: int = 100_000) -> tuple[list[str], np.ndarray]:
    """Languages and ``p[piece, language]``, learned from labelled rows.

    ``sample_docs`` bounds the fit: of each language about so many documents
    are taken, those with the lowest hash of their id (all, if it has fewer);
    runs of over ``sample_letters`` letters are not in the sample (scoring
    reads them whole).
    Rows without text, label or id teach nothing."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("long").alias("doc_id")).filter(
        "lang is not null and text is not null and doc_id is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], np.zeros((pieces(vocabulary).size, 0))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches):
        for b in C.slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = [w for w in words_of(text) if len(w) <= sample_letters]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string())],
                    ["lang", "word"])

    counted = (rows.filter(lot < share).select("lang", "text").mapInArrow(cut, "lang string, word string")
               .groupBy("lang", "word").agg(F.count("*").alias("n")))

    def learn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("word")
        p = fit(pdf["word"].tolist(), pdf["n"].to_numpy(), pieces(vocabulary), rounds)
        return pd.DataFrame({"lang": [key[0]], "p": [p.astype("<f8").tobytes()]})

    models = counted.groupBy("lang").applyInPandas(learn, f"lang string, p {C.BYTES}").collect()
    models = sorted((m["lang"], np.frombuffer(m["p"], "<f8")) for m in models)
    if not models:
        return [], np.zeros((pieces(vocabulary).size, 0))
    return [m[0] for m in models], np.stack([m[1] for m in models], axis=1)


# ----------------------------------------------------------------- scoring
class Scorer:
    """Scores whole texts; remembers sums per white-space-free stretch."""

    def __init__(self, langs: list[str], p: np.ndarray, vocabulary: str, limit: int = 250_000):
        self.langs, self.p, self.index, self.limit = langs, p, pieces(vocabulary), limit
        self._clear()

    def _clear(self) -> None:
        self.units: dict = {}                    # stretch -> row of `sums`, -1 without letters
        self.words: dict = {}                    # word -> row of `logs`
        self.sums = np.zeros((1 << 16, len(self.langs)))
        self.logs = np.zeros((1 << 16, len(self.langs)))

    @staticmethod
    def _put(held: np.ndarray, at: int, rows: np.ndarray) -> np.ndarray:
        if at + len(rows) > len(held):
            held = np.vstack([held, np.zeros((max(len(held), len(rows)), held.shape[1]))])
        held[at:at + len(rows)] = rows
        return held

    def _learn(self, units: list[str]) -> None:
        cut = [words_of(u) for u in units]
        new = list({w for ws in cut for w in ws if w not in self.words})
        if new:
            at = len(self.words)
            self.logs = self._put(self.logs, at, log_probabilities(new, self.index, self.p))
            self.words.update(zip(new, range(at, at + len(new))))
        lettered = [i for i, ws in enumerate(cut) if ws]
        sums = np.zeros((len(units), len(self.langs)))
        if lettered:
            flat = [self.words[w] for ws in cut for w in ws]
            starts = np.cumsum([0] + [len(cut[i]) for i in lettered[:-1]])
            sums[lettered] = np.add.reduceat(self.logs[flat], starts, axis=0)
        at = len(self.units)
        self.sums = self._put(self.sums, at, sums)
        self.units.update((u, i if ws else -1) for i, (u, ws) in enumerate(zip(units, cut), at))

    def __call__(self, texts: list) -> list[tuple[str, float]]:
        cut = [(t or "").split() for t in texts]
        if len(self.units) > self.limit:
            self._clear()
        units = list(itertools.chain.from_iterable(cut))
        rows = list(map(self.units.get, units))
        missed = [i for i, r in enumerate(rows) if r is None]
        if missed:
            self._learn(list({units[i] for i in missed}))
            for i in missed:
                rows[i] = self.units[units[i]]
        rows, out, at = np.array(rows, np.int64), [], 0
        for us in cut:
            own = rows[at:at + len(us)]
            own, at = own[own >= 0], at + len(us)
            if not len(own) or not self.langs:
                out.append((UNDETERMINED, 0.0))
                continue
            total = self.sums[own].sum(axis=0)
            post = np.exp(total - total.max())
            best = int(post.argmax())
            out.append((self.langs[best], float(post[best] / post.sum())))
        return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray],
            vocabulary: str = "piece_bpe_32k.model", text_col: str = "text") -> DataFrame:
    """Every input row with all its columns in the struct ``row``, with
    ``lang_pred`` and ``score`` (posterior of that language, 0 to 1).

    Only the text is looked at, all of it. ``und`` with score 0 where the text
    is null or has no letter (or nothing was learned); ties go to the language
    first in order; texts and words of any length are scored whole; repeated
    rows get the same answer each; an empty table stays empty; further columns
    of any name stay inside ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # pieces x languages

    # only the text goes to Python: the other columns stay where they are
    @F.arrow_udf("lang_pred string, score double")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(*shared.value, vocabulary)
        for texts in batches:
            found = [x for i in range(0, len(texts), SLICE) for x in scorer(texts.slice(i, SLICE).to_pylist())]
            yield pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()),
                                              pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"])

    # not deterministic for the planner: it may not repeat the call in filters
    found = told.asNondeterministic()(docs[text_col].cast("string"))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), found.alias("_found")) \
        .select("row", "_found.lang_pred", "_found.score")


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text is a multiple of 5 (no id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast(C.BYTES)) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame, sample_docs: int = 2000) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; learns only
    from labelled documents that are not held out."""
    model = train(docs.filter(~held_out()), sample_docs)
    return predict(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), held_out("row.doc_id").alias("held_out"),
        "lang_pred", "score")
