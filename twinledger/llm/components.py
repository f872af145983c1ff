"""Connected components by local contraction, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b), both long; equal labels: connected.

    Each round moves a node to the smallest node among itself and its
    neighbours and redraws the edges between the moved ends, which halves
    a component about every round if the numbers carry no order (fingerprints
    and hashes do not). Minima are pre-aggregated, so the centre of a large
    star costs one row a task; the joins are inner ones that adaptive
    execution splits along such a centre.
    """
    def ordered(frame: DataFrame, a: str, b: str) -> DataFrame:
        return frame.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    rest, moves = staged(ordered(edges, "a", "b"), "edges"), []
    while True:
        near = rest.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("m")).select("m.*")
        move = staged(near.groupBy("node").agg(F.min("to").alias("to")), "moves")
        moves.append(move)
        ends = rest.join(move.toDF("a", "ma"), "a").join(move.toDF("b", "mb"), "b")
        rest = staged(ordered(ends, "ma", "mb"), "edges")
        if rest.isEmpty():
            break
    label = moves.pop().toDF("node", "label")
    for move in reversed(moves):
        later = label.toDF("to", "label")
        label = move.join(later, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return label
