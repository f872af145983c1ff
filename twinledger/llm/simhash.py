"""SimHash near-dedup: fingerprints, links through BK-trees, components.

Two fingerprints at most r bits apart agree on at least one of r + 1 blocks
of their bits. A *shard* holds the fingerprints that agree on one block, and
each shard has a BK-tree: a child hangs below its parent under their integer
Hamming distance, and a search follows only edges within r of the distance
to the query. Every fingerprint is a query to its r + 1 shards.

A shard over ``TREE_LIMIT`` fingerprints is cut again by the same rule over
the bits its members may still differ in, up to four times: at the last level
a shard has at most ``2**13`` fingerprints, whatever the data. So the tree of
a task has a proven bound and no link is lost. Trees are sent to the tasks
that hold their shard's queries; sending every tree to every query would cost
the square of the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import keep_rows, staged, text_of
from twinledger.llm.components import components

WORDS = 3
RADIUS = 2
SEED = 42
TREE_LIMIT = 1024
LEVELS = 4
BITS = 64


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64 bits, unsigned: a bit is 1 if set in over half the shingles' XXH64; 0 without a word."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends[: -words])).tolist()
    ends = (ends[words - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[s:e], seed) for s, e in zip(starts, ends)]), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):  # a long text's bits are never all unpacked at once
        ones += np.unpackbits(hashes[at: at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) for each row; fp is the fingerprint as a signed long.

    Null texts are empty; texts without a word have fingerprint 0.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([signed(simhash(t.as_py(), words)) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _parts(mask: int, radius: int) -> list[int]:
    """The bits outside the mask in radius + 1 runs, each added to the mask."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(free) * k // (radius + 1) for k in range(radius + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def tree_edges(members: list[int], radius: int) -> list[tuple[int, int]]:
    """A BK-tree over the members (unsigned); each is searched for, then added. Edges span what is connected."""
    parent = {members[0]: members[0]}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    root = (members[0], {})
    for q in members[1:]:
        parent[q] = q
        todo = [root]
        while todo:
            value, children = todo.pop()
            d = (value ^ q).bit_count()
            if d <= radius:
                a, b = find(value), find(q)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            todo += [children[e] for e in range(max(1, d - radius), d + radius + 1) if e in children]
        value, children = root
        while (d := (value ^ q).bit_count()) in children:
            value, children = children[d]
        children[d] = (q, {})
    return [(x, r) for x in members if (r := find(x)) != x]


def links(fps: DataFrame, radius: int = RADIUS, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """Edges (a, b) between fingerprints that span every component of the links within ``radius`` bits.

    ``fps`` has one long column ``fp`` of different values.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges: list[tuple[int, int]] = []
            for group in b.column(0):
                edges += tree_edges(sorted(x & 0xFFFFFFFFFFFFFFFF for x in group.as_py()), radius)
            yield pa.RecordBatch.from_arrays([pa.array(np.array([e[k] for e in edges], np.uint64).view(np.int64)) for k in (0, 1)], schema=schema)

    masks, found = [0], []
    rows = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    for level in range(LEVELS):
        below = {m: _parts(m, radius) for m in masks}
        choice = F.coalesce(*[F.when(F.col("mask") == _long(m), F.array(*[_long(x) for x in parts])) for m, parts in below.items()])
        sharded = rows.select("fp", F.explode(choice).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sized = sharded.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1")
        known = staged(sharded.join(sized, ["mask", "value"]), "shards")
        last = level == LEVELS - 1
        trees = (known if last else known.filter(F.col("n") <= tree_limit)).groupBy("mask", "value").agg(F.collect_list("fp").alias("members"))
        found.append(trees.select("members").mapInArrow(search, "a long, b long"))
        rows = known.filter(F.col("n") > tree_limit).select("fp", "mask")
        if last or rows.isEmpty():
            break
        masks = [x for parts in below.values() for x in parts]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_groups(prints: DataFrame, radius: int = RADIUS, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """(fp, component_id, best): the smallest id reachable, and the row (id, text_hash) that stays for its component."""
    ids = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    ids = staged(ids, "fingerprints")
    label = components(links(ids.select("fp"), radius, tree_limit))
    joined = ids.join(label.toDF("fp", "label"), "fp", "left").select("fp", "best", F.coalesce("label", "fp").alias("label"))
    joined = staged(joined, "labelled")
    best = joined.groupBy("label").agg(F.min("best").alias("best"))
    return joined.select("fp", "label").join(best, "label").select("fp", F.col("best.doc_id").alias("component_id"), "best")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased; a shingle is ``words`` words, a shorter text its whole
    word sequence; texts without a word (null, empty, white space) have
    fingerprint zero and are linked like any other. Null ids never name
    a component unless nothing else is in it. Repeated rows come back as
    often as they are given, an empty table gives none, other columns are not read.
    """
    prints = staged(fingerprints(docs, words, id_col, text_col), "simhash")
    groups = near_groups(prints, radius)
    return prints.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: its smallest id, all columns."""
    groups = near_groups(staged(fingerprints(docs, words, id_col, text_col), "simhash"), radius)
    best = staged(groups.select("best.doc_id", "best.text_hash").distinct(), "simhash-kept")
    return keep_rows(docs, [F.col(id_col).cast("long"), F.xxhash64(text_of(text_col))], best)
