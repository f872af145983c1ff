"""Keyed comparison of two frames that carry the same column names.

The output of ``reconcile`` has one row per key match or unmatched row:
the key columns, ``in_source`` / ``in_target`` and, for every other column c,
``source__c`` and ``target__c``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions import values as V

IN_SOURCE, IN_TARGET = "in_source", "in_target"
#: Rows of one target key that a task joins, and differing cells that a task sorts.
HOT_ROWS, CELLS_A_TASK = 100_000, 500_000


def _side(df: DataFrame, key, payload, prefix: str, marker: str) -> DataFrame:
    return df.select(
        *[F.col(V.quoted(k)).alias(f"{prefix}#{i}") for i, k in enumerate(key)],
        *[F.col(V.quoted(c)).alias(f"{prefix}{c}") for c in payload],
        F.lit(True).alias(marker),
    )


def _same_key(left: DataFrame, right: DataFrame, n: int, lp: str, rp: str) -> Column:
    """Null keys match null keys; still an equi-join for the planner."""
    return reduce(
        lambda a, b: a & b,
        [left[f"{lp}#{i}"].eqNullSafe(right[f"{rp}#{i}"]) for i in range(n)],
    )


def repeated_keys(df: DataFrame, key) -> DataFrame:
    """Key tuples that occur more than once, with their number of rows."""
    return df.groupBy(*[F.col(V.quoted(k)) for k in key]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def reconcile(src: DataFrame, tgt: DataFrame, key, target_unique: bool = False) -> DataFrame:
    """Full outer match of the sides on ``key``, which no two source rows share.

    ``target_unique`` states that no target key repeats either (proved by the
    caller): one full outer join whose partitions have even weight.  A full
    outer join cannot be split when a target key is hot, so otherwise the
    target rows look up their source row in an outer join, and the source rows
    without any match come from an anti join against the distinct target keys.
    The rows of a key with over ``HOT_ROWS`` of them are dealt by their values to
    parts, each of which gets the source row; at most one key in ``HOT_ROWS`` rows is broadcast.
    """
    key = list(key)
    payload = [c for c in src.columns if c not in key]
    s = _side(src, key, payload, "source__", IN_SOURCE)
    t = _side(tgt, key, payload, "target__", IN_TARGET)
    n = len(key)
    if target_unique:
        joined = s.join(t, _same_key(s, t, n, "source__", "target__"), "full_outer")
        return _shape(joined, key, payload)

    t_keys = tgt.groupBy(*[F.col(V.quoted(k)).alias(f"other__#{i}") for i, k in enumerate(key)]).agg(F.count(F.lit(1)).alias("n"))
    hot = t_keys.where(F.col("n") > HOT_ROWS)
    parted_t, parted_s = (_with_parts(df, hot, n, p) for df, p in ((t, "target__"), (s, "source__")))
    spread = [F.col(V.quoted(f"target__{c}")) for c in payload if "map<" not in t.select(V.quoted(f"target__{c}")).dtypes[0][1]]
    parted_t = parted_t.withColumn("target__#part", F.pmod(F.xxhash64(F.lit(0), *spread), F.col("target__#parts")))
    parted_s = parted_s.withColumn("source__#part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("source__#parts") - 1)))
    same = _same_key(parted_t, parted_s, n, "target__", "source__") & (F.col("target__#part") == F.col("source__#part"))
    found = parted_t.join(parted_s, same, "left_outer").drop(*[f"{p}__#{c}" for p in ("target", "source") for c in ("part", "parts")])
    only_s = s.join(t_keys, _same_key(s, t_keys, n, "source__", "other__"), "left_anti")
    return _shape(found.unionByName(only_s, allowMissingColumns=True), key, payload)


def _with_parts(df: DataFrame, hot: DataFrame, n: int, prefix: str) -> DataFrame:
    """The rows with the number of parts of their key: one, unless it is hot."""
    few = hot.select(*[F.col(f"other__#{i}").alias(f"hot__#{i}") for i in range(n)], F.ceil(F.col("n") / HOT_ROWS).alias("hot__#n"))
    marked = df.join(F.broadcast(few), _same_key(df, few, n, prefix, "hot__"), "left_outer")
    return marked.withColumn(f"{prefix}#parts", F.coalesce("hot__#n", F.lit(1).cast("bigint"))).select(*[V.quoted(c) for c in df.columns], f"{prefix}#parts")


def _shape(joined: DataFrame, key, payload) -> DataFrame:
    present = lambda marker: F.coalesce(F.col(marker), F.lit(False)).alias(marker)
    keys = [
        F.when(F.col(IN_SOURCE), F.col(f"source__#{i}")).otherwise(F.col(f"target__#{i}")).alias(k)
        for i, k in enumerate(key)
    ]
    values = [F.col(V.quoted(f"{p}__{c}")) for c in payload for p in ("source", "target")]
    return joined.select(*keys, present(IN_SOURCE), present(IN_TARGET), *values)


def only_in_source(joined: DataFrame) -> DataFrame:
    return joined.where("in_source and not in_target")


def only_in_target(joined: DataFrame) -> DataFrame:
    return joined.where("in_target and not in_source")


def matched_rows(joined: DataFrame) -> DataFrame:
    return joined.where("in_source and in_target")


def differs(column: str) -> str:
    """A matched row whose two values differ; null equals null only."""
    s, t = V.quoted(f"source__{column}"), V.quoted(f"target__{column}")
    return f"in_source and in_target and not ({s} <=> {t})"


def differences(joined: DataFrame, payload) -> DataFrame:
    """Unmatched rows and matched rows with at least one differing value."""
    tests = ["not (in_source and in_target)"] + [f"({differs(c)})" for c in payload]
    return joined.where(" or ".join(tests))


def extra_record_counts(joined: DataFrame) -> DataFrame:
    return joined.selectExpr("count_if(not in_target) as only_in_source", "count_if(not in_source) as only_in_target")


def mismatch_counts(joined: DataFrame, payload) -> DataFrame:
    """(column_name, mismatches) of the columns that differ anywhere, from one
    aggregate over all columns."""
    wide = joined.selectExpr(*[f"count_if({differs(c)}) as c{i}" for i, c in enumerate(payload)])
    rows = [
        f"struct({i} as ordinal, {V.text_literal(c)} as column_name, c{i} as mismatches)" for i, c in enumerate(payload)
    ]
    return wide.selectExpr(f"inline(array({', '.join(rows)}))").where("mismatches > 0")


def key_map(joined: DataFrame, key, names=None) -> Column:
    types = {f.name: f.dataType for f in joined.schema.fields}
    parts = [
        f"{V.text_literal(names[k] if names else k)}, coalesce({V.render(V.quoted(k), types[k])}, 'null')" for k in key
    ]
    return F.expr(f"map({', '.join(parts)})")


def spread_cells(diff: DataFrame, cells: int) -> DataFrame:
    """The matched rows of ``diff``, dealt by their values so that a task gets about ``CELLS_A_TASK`` of the differing cells.

    Few cells stay where they are. A file of ``diff`` may hold many rows with one value in a
    column, small on disk but not when their cells are sorted.
    """
    if cells <= CELLS_A_TASK:
        return diff
    parts = max(cells // CELLS_A_TASK + 1, diff.rdd.getNumPartitions())
    return matched_rows(diff).repartition(parts, *[F.col(V.quoted(c)) for c, dtype in diff.dtypes if "map<" not in dtype])


def mismatch_samples(diff: DataFrame, key, payload, limit: int, columns=None, cells: int = 0) -> DataFrame:
    """The first ``limit`` differing cells of every column in key order.

    ``diff`` holds the rows of ``differences`` and is read once, however many
    columns differ; ``columns`` names those known to differ, ``cells`` is the number
    of differing cells where that is known.  Each row unfolds to
    its differing cells; every task keeps the first ``limit`` of a column
    before anything is shuffled.  A key that repeats on the target gives several
    rows: the texts of the values break the tie.
    """
    types = {f.name: f.dataType for f in diff.schema.fields}
    names = [V.quoted(k) for k in key]
    diff, cells = spread_cells(diff, cells), []
    for i, c in enumerate(payload):
        if columns is not None and c not in columns:
            continue
        s, t = f"source__{c}", f"target__{c}"
        cells.append(
            f"if({differs(c)}, struct({i} as ordinal, {V.text_literal(c)} as column_name, "
            f"{V.render(V.quoted(s), types[s])} as source_value, {V.render(V.quoted(t), types[t])} as target_value), null)"
        )
    found = diff.selectExpr(*names, f"inline(array_compact(array({', '.join(cells)})))")
    order = [F.col(k).asc_nulls_first() for k in key] + [F.col(v).asc_nulls_first() for v in ("source_value", "target_value")]
    return (
        found.withColumn("example", F.row_number().over(Window.partitionBy("ordinal").orderBy(*order)))
        .where(F.col("example") <= limit)
        .select("ordinal", "column_name", *key, "source_value", "target_value", "example")
    )


def multiset_difference(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Keyless comparison: whole rows with more copies on one side.

    Both directions of EXCEPT ALL from a single grouping that combines copies
    before the shuffle.
    """
    columns = [F.col(V.quoted(c)) for c in src.columns]
    one = src.select("*", F.lit(1).cast("bigint").alias("__s"), F.lit(0).cast("bigint").alias("__t"))
    two = tgt.select("*", F.lit(0).cast("bigint").alias("__s"), F.lit(1).cast("bigint").alias("__t"))
    return (
        one.unionByName(two)
        .groupBy(*columns)
        .agg(F.sum("__s").alias("__s"), F.sum("__t").alias("__t"))
        .where("__s <> __t")
        .select(
            *columns,
            F.greatest(F.col("__s") - F.col("__t"), F.lit(0)).cast("bigint").alias("surplus_in_source"),
            F.greatest(F.col("__t") - F.col("__s"), F.lit(0)).cast("bigint").alias("surplus_in_target"),
        )
    )
