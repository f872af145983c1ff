"""Best-fit packing by minimum bin slack.

Pieces of one length are interchangeable, so the packing is planned on the
counts of the lengths, at most ``size`` numbers however many documents there
are. For each bin the longest length left is set, and a subset-sum dynamic
program over a bitset of reachable fills finds the fullest combination that
the lengths left over allow. The combination is removed as often as the counts
allow before the next one is sought, so that every round uses up a length: at most
``size`` rounds, at most 63 different lengths in a bin, hence under 130,000
plan entries for 2,048 tokens, whatever the input.

Pieces get their places by their rank among the pieces of their length. The
rank is counted in sub-groups by row key with offsets from their counts, so a
length that a third of all documents share is spread over many tasks.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import staged, text_of

SIZE = 2048
END = 0
SUBGROUPS = 256


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(vocabulary: str):
    """texts -> ids of the tokenizer in the file, without added special tokens.

    Where the same folder has the vocabulary as ranks for tiktoken, texts of
    plain Latin characters go through that, which makes the same merges four times faster;
    texts with any other character, for which the two libraries' character
    classes could differ, or with the text of a special token go through the file itself.
    """
    import base64
    import re

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(vocabulary)
    ranks = os.path.splitext(vocabulary)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    other = re.compile("[^\t\n\r -~¡-ɏ]|<\\|")

    def encode(texts: list[str]) -> list[list[int]]:
        return [whole.encode(t, add_special_tokens=False).ids if other.search(t) else fast.encode_ordinary(t) for t in texts]

    return encode


def pieces(docs: DataFrame, size: int = SIZE, end: int = END, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for each piece of each document.

    A document is its tokens and then ``end``; a longer one than ``size`` is cut so that
    only its first piece is shorter. A null text is empty: one token.
    """
    path = vocabulary or tokenizer_path()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for b in batches:
            encode = encode or encoder(path)
            out: list[list] = [[] for _ in schema]
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode([text.as_py()])[0], end], "<u4")
                start, at, cut = 0, 0, len(ids) % size or size
                while start < len(ids):
                    part = ids[start:cut]
                    row = [i, at, start, len(part), zlib.crc32(part.tobytes())]
                    for column, value in zip(out, row + [part] * with_ids):
                        column.append(value)
                    start, at, cut = cut, at + 1, cut + size
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """Length -> how often, of the fullest bin that has the longest length left."""
    first = max(counts)
    use, room = {first: 1}, size - first
    reach, trail = 1, []  # bit f of reach: fill f is possible
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length] - (length == first), room // length), 1
        while left > 0 and not reach >> room & 1:
            k = min(k, left)
            new = (reach | reach << length * k) & ((1 << room + 1) - 1)
            if new != reach:
                trail.append((length, k, reach))
                reach = new
            left, k = left - k, k * 2
        if reach >> room & 1:
            break
    fill = reach.bit_length() - 1
    for length, k, before in reversed(trail):
        if not before >> fill & 1:
            use[length] = use.get(length, 0) + k
            fill -= length * k
    return use


def plan_bins(counts: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """[(length -> how often in a bin, number of such bins)] that use up the counts."""
    counts, out = {k: n for k, n in counts.items() if n}, []
    while counts:
        use = fullest(counts, size)
        times = min(counts[x] // k for x, k in use.items())
        out.append((use, times))
        for x, k in use.items():
            counts[x] -= k * times
            if not counts[x]:
                del counts[x]
    return out


def _places(bins: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Length -> rows (first rank, bins, first bin, offset), ordered by rank."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    base = 0
    for use, times in bins:
        offset = 0
        for length, k in sorted(use.items(), reverse=True):
            for _ in range(k):
                rank = used.get(length, 0)
                rows.setdefault(length, []).append((rank, times, base, offset))
                used[length] = rank + times
                offset += length
        base += times
    return {x: np.array(r, np.int64) for x, r in rows.items()}


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Staged pieces with sequence_id and offset added; needs the columns of ``pieces``."""
    keyed = staged(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counted = keyed.groupBy("length", F.pmod(F.xxhash64("__row"), F.lit(SUBGROUPS)).alias("__sub")).count()
    counts = {r.length: r["count"] for r in counted.groupBy("length").agg(F.sum("count").alias("count")).collect()}  # at most ``size`` rows
    places = _places(plan_bins(counts, size))
    by_sub = Window.partitionBy("length").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.withColumn("__before", F.coalesce(F.sum("count").over(by_sub), F.lit(0))).drop("count")
    sub = F.pmod(F.xxhash64("__row"), F.lit(SUBGROUPS))
    local = keyed.withColumn("__sub", sub).withColumn("__n", F.row_number().over(Window.partitionBy("length", "__sub").orderBy("__row")) - 1)
    ranked = local.join(before, ["length", "__sub"]).withColumn("__rank", F.col("__n") + F.col("__before")).select(*cut.columns, "__rank")
    names = cut.columns
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, ranks = b.column("length").to_numpy(zero_copy_only=False), b.column("__rank").to_numpy(zero_copy_only=False)
            bins, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for x in np.unique(lengths):
                at = np.flatnonzero(lengths == x)
                table = places[int(x)]
                hit = table[np.searchsorted(table[:, 0], ranks[at], "right") - 1]
                bins[at], offsets[at] = hit[:, 2] + ranks[at] - hit[:, 0], hit[:, 3]
            columns = [b.column(n) for n in names] + [pa.array(bins), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, out)


def pack(docs: DataFrame, size: int = SIZE, end: int = END, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    Every row of the input is a document of its own, also where ids repeat or
    are null; a null or empty text is the end token alone. The pieces of a sequence lie
    gapless from offset 0. An empty table gives no rows; other columns are not read.
    """
    return place(pieces(docs, size, end, vocabulary, id_col, text_col, with_ids), size)
