"""Exact dedup: digest runs merged along a tree.

Every input partition makes a *run*: its texts as (digest, SHA-256, bytes)
in order, equal ones collapsed to the best identifier and a count. Runs are
the leaves of a binomial tree. In round r node n hands its run to node
``n - 2**r`` when that bit of n is set; ``ROUNDS_PER_EXCHANGE`` rounds share
one exchange, after which a node merges all the runs it got. A run travels
in slices by digest, so a node's work is spread over many tasks and no task
ever holds a whole run. At every level equal digests merge only if SHA-256
and length agree too, and the best identifier is retained.

A group of copies, however large, has one entry a run: the leaves collapse
it before anything is shuffled, and the answer goes back to entries (at most
one a run for a text), which then unfold to their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import ascii_lower, keep_rows, staged, text_of

ROUNDS_PER_EXCHANGE = 3
SLICES = 4096

LEAF = "digest long, sha binary, n_bytes long, node int, ids array<long>"
RUN = "slice int, node int, digest long, sha binary, n_bytes long, best long, best_node int, n long"


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (digest, sha, n_bytes, node, id) to one entry for each text with its ids in order."""
    out, key, ids = [], None, []
    schema = pa.schema([("digest", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64()), ("node", pa.int32()), ("ids", pa.list_(pa.int64()))])

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for *row, i in zip(*cols):
            if row == key:
                ids.append(i)
            else:
                if key is not None:
                    out.append((*key, ids))
                key, ids = row, [i]
        if len(out) >= 4096:
            yield batch(out)
            out = []
    if key is not None:
        out.append((*key, ids))
        yield batch(out)


def _merge(largest: bool):
    """Sorted entries of several runs to one run: adjacent equal texts become one entry."""
    schema = pa.schema([("slice", pa.int32()), ("node", pa.int32()), ("digest", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64()), ("best", pa.int64()), ("best_node", pa.int32()), ("n", pa.int64())])

    def better(a: tuple, b: tuple) -> bool:
        """(id, node) a before b: null ids last, then the wanted end of the ids, then the lower run."""
        if (a[0] is None) != (b[0] is None):
            return b[0] is None
        if a[0] != b[0]:
            return (a[0] > b[0]) == largest
        return a[1] < b[1]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, n, out = None, None, 0, []

        def batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for b in batches:
            for *row, i, node, k in zip(*[c.to_pylist() for c in b.columns]):
                if row == key:
                    n += k
                    if better((i, node), best):
                        best = (i, node)
                else:
                    if key is not None:
                        out.append((*key, *best, n))
                    key, best, n = row, (i, node), k
            if len(out) >= 4096:
                yield batch(out)
                out = []
        if key is not None:
            out.append((*key, *best, n))
            yield batch(out)

    return merge


def leaf_runs(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The run of every input partition, staged: one row for each text of the partition with the ids that carry it."""
    norm = ascii_lower(text_of(text_col))
    rows = docs.select(
        F.xxhash64(norm).alias("digest"), F.unhex(F.sha2(norm, 256)).alias("sha"), F.octet_length(norm).cast("long").alias("n_bytes"),
        F.spark_partition_id().alias("node"), F.col(id_col).cast("long").alias("id"),
    )
    order = F.desc_nulls_last("id") if keep == "largest" else F.asc_nulls_last("id")
    return staged(rows.sortWithinPartitions("digest", "sha", "n_bytes", order).mapInArrow(_leaves, LEAF), "exact-runs")


def merge_tree(leaves: DataFrame, keep: str = "largest") -> DataFrame:
    """All runs merged: a row for each text with the best id, the run that holds it and the number of rows."""
    top = leaves.agg(F.max("node")).first()[0] or 0
    merge = _merge(keep == "largest")
    runs = leaves.select(
        F.pmod("digest", F.lit(SLICES)).cast("int").alias("slice"), "node", "digest", "sha", "n_bytes",
        F.col("ids")[0].alias("best"), F.col("node").alias("best_node"), F.size("ids").cast("long").alias("n"),
    )
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        top >>= ROUNDS_PER_EXCHANGE
        runs = (
            runs.withColumn("node", F.shiftright("node", ROUNDS_PER_EXCHANGE))
            .repartition(parts, "slice", "node")
            .sortWithinPartitions("slice", "node", "digest", "sha", "n_bytes")
            .mapInArrow(merge, RUN)
        )
        if top == 0:
            return runs.select("digest", "sha", "n_bytes", "best", "best_node", "n")


def exact_groups(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null is empty, and
    empty texts are equal. The row with the largest (or smallest) id stays.
    A null id stays only if the whole group has none. Of rows that repeat
    text and id one stays. An empty table gives no rows; other columns of
    the input are not read.
    """
    leaves = leaf_runs(docs, keep, id_col, text_col)
    best = merge_tree(leaves, keep)
    rows = leaves.join(best, ["digest", "sha", "n_bytes"])
    return rows.select("*", F.posexplode("ids").alias("pos", "doc_id")).select(
        "doc_id", F.col("best").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("node") == F.col("best_node")) & (F.col("pos") == 0)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each different text, with all their columns."""
    best = merge_tree(leaf_runs(docs, keep, id_col, text_col), keep)
    winners = staged(best.select("sha", "best"), "exact-kept")
    norm = ascii_lower(text_of(text_col))
    return keep_rows(docs, [F.unhex(F.sha2(norm, 256)), F.col(id_col).cast("long")], winners)
