"""Substring dedup by content-defined chunks.

A gear hash rolls over the lower-cased bytes of a text: shifted left by one and
a table value for the next byte added, in 16 bits, so it knows the last 16
bytes only. A chunk ends where its top bits are zero. Cuts therefore depend on
the text around them alone: after an insertion they fall back into step.

Chunks are deduplicated by digest. The digest table is aggregated before it is
joined to the chunks, so a passage in a third of all documents costs a row a
task, and the join is one that adaptive execution splits. Neighbouring chunks
of a document that occur in other documents are joined to spans. A span needs
several chunks in a row, so that no collision of digests makes one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import staged, text_of

#: A cut is made where this many top bits of the hash are zero.
CUT_BITS = 5
LEAST = 12
MOST = 256
#: Words a span must hold. Chunks at both ends of a passage reach beyond it, so a passage of 50 is seen as less.
SPAN_WORDS = 15

CHUNK = "digest long, doc long, tag int, idx int, start int, end int, first_word int, last_word int"


def gear_table(seed: int = 9) -> np.ndarray:
    """256 numbers of 16 bits from SplitMix64."""
    out, mask = [], (1 << 64) - 1
    for i in range(1, 257):
        z = (seed + i * 0x9E3779B97F4A7C15) & mask
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & mask
        out.append((z ^ z >> 31) & 0xFFFF)
    return np.array(out, np.uint16)


def cuts(data: np.ndarray, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of the bytes, the last being their length."""
    h = gear[data]
    for width in (1, 2, 4, 8):  # sums over 2, 4, 8 and then 16 bytes
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    ends, at = [], 0
    for end in (np.flatnonzero(h >> np.uint16(16 - CUT_BITS) == 0) + 1).tolist():
        while end - at > MOST:
            at += MOST
            ends.append(at)
        if end - at >= LEAST:
            at = end
            ends.append(at)
    while len(data) - at > MOST:
        at += MOST
        ends.append(at)
    if len(data) > at:
        ends.append(len(data))
    return ends


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each chunk of each text: digest, document, number, and where it lies in code points and words.

    ``tag`` tells texts with one id apart. A null or empty text has no chunk.
    """
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 6]
    names = [x.split()[0] for x in CHUNK.split(", ")]
    gear = gear_table()
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in names]
            for doc, tag, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = text.as_py().encode("utf-8", "surrogatepass").lower()
                if not raw:
                    continue
                data = np.frombuffer(raw, np.uint8)
                ends = cuts(data, gear)
                starts = [0, *ends[:-1]]
                gap = space[data]
                word = ~gap
                word[1:] &= gap[:-1]
                chars = np.cumsum(np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int32), starts))
                words = np.cumsum(np.add.reduceat(word.astype(np.int32), starts))
                n = len(ends)
                row = [
                    np.array([digest(raw[s:e]) for s, e in zip(starts, ends)], np.uint64).view(np.int64), np.full(n, doc), np.full(n, tag), np.arange(n),
                    np.concatenate(([0], chars[:-1])), chars, np.concatenate(([0], words[:-1])), words,
                ]
                for column, part in zip(out, row):
                    column.append(part)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t.to_pandas_dtype()), t) for c, t in zip(out, types)], names=names)

    text = text_of(text_col)
    return docs.select(_doc(id_col).alias("doc"), _tag(text).alias("tag"), text.alias("text")).mapInArrow(run, CHUNK)


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))


def _tag(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def repeated_spans(docs: DataFrame, span_words: int = SPAN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of text that other documents hold too: doc_id, start, end, n_words, n_chunks, first_doc_id, removed, text_tag.

    Positions are code points, end exclusive. A chunk stays in the document with the
    smallest id that holds it; ``removed`` tells whether the span's chunks stay elsewhere.
    Neighbouring shared chunks with ``span_words`` words together are reported, however they fall
    into spans by ``removed``,
    and ``first_doc_id`` is the smallest id that holds one of them. Repeats within one document,
    which rows with one id are, are not reported. Rows without an id count as one
    document with a null id, the last. Documents without a span, null and empty
    ones among them, have no row; nor has an empty table. Other columns are not read.
    """
    cut = staged(chunks(docs, id_col, text_col), "chunks")
    shared = cut.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    shared = staged(shared.select("digest", "first"), "shared")
    found = cut.join(shared, "digest").withColumn("removed", F.col("doc") != F.col("first"))
    run = F.col("idx") - F.dense_rank().over(Window.partitionBy("doc", "tag").orderBy("idx"))
    whole = Window.partitionBy("doc", "tag", "run")
    found = found.withColumn("run", run).withColumn("held", F.max("last_word").over(whole) - F.min("first_word").over(whole)).filter(F.col("held") >= span_words)
    place = F.dense_rank().over(Window.partitionBy("doc", "tag", "removed").orderBy("idx"))
    spans = found.withColumn("island", F.col("idx") - place).groupBy("doc", "tag", "removed", "run", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("last_word") - F.min("first_word")).alias("n_words"),
        (F.max("idx") - F.min("idx") + 1).alias("n_chunks"), F.min("first").alias("first"),
    )
    last = F.lit((1 << 63) - 1)
    return spans.select(
        F.when(F.col("doc") != last, F.col("doc")).alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        "n_words", "n_chunks", F.when(F.col("first") != last, F.col("first")).alias("first_doc_id"), "removed", F.col("tag").alias("text_tag"),
    )


def remove_repeats(docs: DataFrame, span_words: int = SPAN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed spans cut out of their texts; every row stays, all columns with it.

    A span under ``span_words`` stays: cut out, it would break a passage that stays around it.
    """
    spans = repeated_spans(docs, span_words, id_col, text_col).filter(F.col("removed") & (F.col("n_words") >= span_words))
    lists = staged(spans.groupBy("doc_id", "text_tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "cut")

    @F.arrow_udf("string")
    def without(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, cut in texts:
            out = []
            for t, c in zip(text.to_pylist(), cut.to_pylist()):
                for s in reversed(c or []):
                    t = t[: s["start"]] + t[s["end"]:]
                out.append(t)
            yield pa.array(out, pa.string())

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).cast("long").alias("__id"), _tag(text_of(text_col)).alias("__tag"))
    keyed = lists.toDF("__sid", "__stag", "__spans")
    joined = packed.join(keyed, F.col("__id").eqNullSafe(F.col("__sid")) & (F.col("__tag") == F.col("__stag")), "left")
    text = F.when(F.col("__spans").isNull(), F.col(f"__row.{text_col}")).otherwise(without(F.col(f"__row.{text_col}"), F.col("__spans")))
    return joined.withColumn("__row", F.col("__row").withField(text_col, text)).select("__row.*")
