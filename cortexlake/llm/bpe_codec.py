"""Byte-level BPE encoding and decoding with the tiktoken library.

The encoder is built from a local rank file. Long texts are cut by a regular
expression at boundaries where the pre-split pattern always starts a new
match, so that the library sees bounded stretches and their ids, put end to
end, are those of the whole text. Decoding joins the raw bytes of the ids,
which is exact also where a character is split over several ids."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

_ENCODERS: dict = {}
#: At least so many characters to a stretch, then up to the next blank that is
#: followed by anything but white space: such a blank always starts a match.
_STRETCH = re.compile(r".{1,16384}(?:(?! \S).)*", re.S)


def encoder(vocabulary: str):
    """The worker's encoder for a rank file, made once."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        with open(C.vocabulary(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={})
    return _ENCODERS[vocabulary]


def encode_text(text: str, vocabulary: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    e = encoder(vocabulary)
    return b"".join(e.encode_to_numpy(x, disallowed_special=()).astype("<u4", copy=False).tobytes()
                    for x in _STRETCH.findall(text))


def decode_ids(ids: bytes, vocabulary: str) -> bytes:
    return encoder(vocabulary).decode_bytes(np.frombuffer(ids, "<u4").tolist())


def _map(docs: DataFrame, schema: str, row) -> DataFrame:
    """Map every (doc_id, value) row to ``row(value)``'s further columns."""
    def run(batches):
        for b in C.slices(batches):
            out = [row(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(cols))],
                ["doc_id", *(n for n, _ in cols)])

    kinds = {"long": pa.int64(), "string": pa.string(), C.BYTES: C.ARROW_BYTES}
    cols = [(n, kinds[t]) for n, t in (x.split() for x in schema.split(","))]
    return docs.mapInArrow(run, "doc_id long, " + schema)


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text as little-endian unsigned
    32-bit integers. Null text encodes as empty; null ids, repeated rows,
    empty tables and other columns do no harm."""
    return _map(C.id_text(docs, id_col, text_col), f"ids {C.BYTES}",
                lambda x: (encode_text(x or "", vocabulary),))


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """``doc_id, content``: the raw bytes of ``ids`` (null: empty)."""
    return _map(encoded.select("doc_id", "ids"), f"content {C.BYTES}",
                lambda x: (decode_ids(x or b"", vocabulary),))


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken",
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding every whole text, in one pass:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def row(x):
        ids = encode_text(x or "", vocabulary)
        return (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(decode_ids(ids, vocabulary)).hexdigest())

    return _map(C.id_text(docs, id_col, text_col),
                "n_tokens long,ids_sha256 string,decoded_sha256 string", row)
