"""Token counts: map-side two-tier lookup.

Tier one is a broadcast table of the token counts of frequent pre-tokens, those
of a bounded sample of the documents (at most ``entries`` of them); what is in
it changes no result, only who encodes. Tier two
is a bounded memory in each Python worker that encodes what the table misses
with the library. Texts are counted where they are read: outside the sample no
pre-token is ever shuffled, and the plan is one scan and one map."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def frequent(docs: DataFrame, vocabulary: str, sample_docs: int, entries: int) -> list[str]:
    """The ``entries`` most frequent pre-tokens (of at most 64 characters) of
    about ``sample_docs`` documents, those with the lowest hash of id and text:
    both bounds hold whatever the input. Counts are added up per task."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches):
        from tokenizers import Tokenizer
        counts: Counter = Counter()
        pieces = _pieces(Tokenizer.from_file(C.vocabulary(vocabulary)))
        for b in C.slices(batches):
            for text in b.column(0).to_pylist():
                for unit, n in Counter(C.blank_units(text or "")[1]).items():
                    for piece in pieces(unit):
                        counts[piece] += n
        counts = {p: n for p, n in counts.items() if len(p) <= 64}
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                         ["piece", "n"])

    counted = docs.filter(lot < share).select("text").mapInArrow(run, "piece string, n long") \
        .groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    return [r["piece"] for r in counted.select("piece").collect()]


def _pieces(t):
    """Cuts a unit into what is encoded apart; the library takes special
    strings before it splits."""
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    return lambda unit: [" " + unit] if any(x in unit for x in special) else C.pattern_pieces(unit)


def _lengths(t, texts: list) -> list:
    return [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024,
                 memory: int = 1_000_000, sample_docs: int = 2000, entries: int = 1 << 16,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Null text counts as empty (0 bytes, 0 tokens); a null doc_id and repeated
    rows are kept as they are; an empty table gives an empty result; texts of
    any length are counted whole; other columns are ignored. Special strings
    inside texts are taken as the library does by default."""
    from tokenizers import Tokenizer
    C.quiet_tokenizers()
    rows = C.id_text(docs, id_col, text_col)
    often = frequent(rows, vocabulary, sample_docs, entries)
    shared = docs.sparkSession.sparkContext.broadcast(
        dict(zip(often, _lengths(Tokenizer.from_file(C.vocabulary(vocabulary)), often))))

    def run(batches):
        from tokenizers import Tokenizer
        C.quiet_tokenizers()
        t = Tokenizer.from_file(C.vocabulary(vocabulary))
        pieces = _pieces(t)
        memo = C.Memo(lambda xs: _lengths(t, xs), pieces, sum, memory, shared.value)
        for b in C.slices(batches):
            ids, sizes, counts = b.column(0), [], []
            texts = [x or "" for x in b.column(1).to_pylist()]
            cut = [C.blank_units(x) for x in texts]
            heads = _lengths(t, [h for h, _ in cut])
            for x, (_, units), n in zip(texts, cut, heads):
                sizes.append(len(x.encode()))
                counts.append(n + sum(memo.values(units)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, SCHEMA)
