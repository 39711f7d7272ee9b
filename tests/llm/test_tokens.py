"""Token counts, BPE codec and packing against the libraries themselves."""
from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cortexlake.llm import bpe_codec, common as C, packing, token_counts

RANKS = "byte_bpe_multi_50k.tiktoken"
TEXT = st.lists(st.sampled_from(list(" \n\t\x1cab1,'sé中<|>½") + ["  ", " the"]), max_size=80).map("".join)


MADE: dict = {}


def tokenizer(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(C.vocabulary(name))


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_units_give_back_the_text(text):
    head, units = C.blank_units(text)
    assert head + "".join(" " + u for u in units) == text


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_encode_is_the_librarys(text):
    ids = np.frombuffer(bpe_codec.encode_text(text, RANKS), "<u4").tolist()
    assert ids == bpe_codec.encoder(RANKS).encode_ordinary(text)
    assert bpe_codec.decode_ids(bpe_codec.encode_text(text, RANKS), RANKS) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_word_ids_are_the_librarys(text):
    if "w" not in MADE:
        MADE["w"] = packing.WordEncoder(C.vocabulary("word_bpe_49k.json"))
    w = MADE["w"]
    assert np.frombuffer(w(text), "<u4").tolist() == w.t.encode(text, add_special_tokens=False).ids


def test_word_encoder_is_kept_by_its_worker():
    enc = packing.word_encoder(C.vocabulary("word_bpe_49k.json"))
    assert packing.word_encoder(C.vocabulary("word_bpe_49k.json")) is enc
    text = "Alpha alpha, " + "Q" * 200 + " " + "q" * 201 + " <unk> <|endoftext|> \u00c9t\u00e9 x1 don't"
    for _ in range(2):
        assert np.frombuffer(enc(text), "<u4").tolist() == enc.t.encode(text, add_special_tokens=False).ids


def test_long_text_is_cut_at_safe_boundaries():
    text = ("word  \n other " * 9000) + "z" * 40000 + " " * 40000
    ids = np.frombuffer(bpe_codec.encode_text(text, RANKS), "<u4").tolist()
    assert ids == bpe_codec.encoder(RANKS).encode_ordinary(text)


def test_counts(docs_of, odd_texts):
    rows = [(i if i else None, t) for i, t in enumerate(odd_texts)]
    t = tokenizer("byte_bpe_50k.json")
    want = sorted((i or -1, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False)))
                  for i, x in rows)
    docs = docs_of(rows).withColumn("n_tokens", F.lit("clash"))
    got = token_counts.count_tokens(docs).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.count_tokens(docs_of([])).count() == 0


def test_round_trip(docs_of, odd_texts):
    rows = list(enumerate(odd_texts))
    docs = docs_of(rows).withColumn("ids", F.lit(1))
    e = bpe_codec.encoder(RANKS)
    got = {r.doc_id: r for r in bpe_codec.round_trip(docs).collect()}
    for i, x in rows:
        ids = e.encode_ordinary(x or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((x or "").encode()).hexdigest()
    back = bpe_codec.decode(bpe_codec.encode(docs)).collect()
    assert {r.doc_id: bytes(r.content).decode() for r in back} == {i: x or "" for i, x in rows}
    assert bpe_codec.round_trip(docs_of([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit_and_bound(lengths):
    where, offset, left = packing.best_fit(np.array(lengths, np.int64), 100)
    fill = [0] * len(left)
    for k, o, n in sorted(zip(where, offset, lengths)):
        assert o == fill[k]
        fill[k] += n
    assert all(f + r == 100 for f, r in zip(fill, left))
    bound = packing.lower_bound(*np.unique(lengths, return_counts=True), 100) if lengths else 0
    assert bound <= len(left) <= max(1, 1.3 * bound + 1)


def test_bound_sees_what_the_sum_does_not():
    assert packing.lower_bound([60], [5], 100) == 5          # no two fit
    assert packing.lower_bound([34], [6], 100) == 3          # two to a bin


@pytest.mark.parametrize("run_items", [100, 200_000])
def test_packing(docs_of, odd_texts, run_items):
    rows = list(enumerate(odd_texts)) + [(100 + i, "the of and to " * (i % 50)) for i in range(300)]
    rows += [(None, "no id"), (None, "no id")]
    got = packing.best_fit_packing(docs_of(rows), capacity=256, run_items=run_items).collect()
    t = tokenizer("word_bpe_49k.json")
    want = []
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 256)):
            part = ids[s:s + 256]
            want.append((i or -1, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 256
    bound = packing.lower_bound(*np.unique([w[3] for w in want], return_counts=True), 256)
    assert bound <= len(bins) <= bound + 1
    assert packing.best_fit_packing(docs_of([])).count() == 0


def test_tier_one_answers_frequent_pre_tokens(docs_of):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(C.vocabulary("byte_bpe_50k.json"))
    rows = [(i, "odd" + " the" * 9 + " cat's" * 4 + f" seldom{'abcdefghij'[i % 10]}" + " " + "y" * 99) for i in range(200)]
    docs = docs_of(rows)
    assert token_counts.frequent(docs, "byte_bpe_50k.json", 2000, 3) == [" the", " cat", "'s"]
    some = token_counts.frequent(docs, "byte_bpe_50k.json", 20, 1 << 16)
    assert " the" in some and all(len(p) <= 64 for p in some)
    for n, entries in ((2000, 1 << 16), (2000, 1), (1, 0)):
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, sample_docs=n, entries=entries).collect()}
        assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in rows}
