"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources in order of their names weigh 5, 2, 1, 5, ...; together
they get ``share`` of all words, none more than ``most`` times its own, and
what a source cannot take is shared again by weight.

A source takes whole epochs first and then part of one: every document draws
``1 - u ** (1 / weight)``, which orders documents as the exponential keys
``-ln(u) / weight`` do, and the source takes documents in that order, each
that still fits its budget. u is a hash of seed, id and text, so reruns agree.

Equal rows draw equal keys, and far keys of light documents round together; behind
the key come the whole hash and ``at``, the number of the staged row, so no two
rows share a place in the order and a budget may end among copies.

The order is never sorted whole. A pass sums sizes by source and key bucket,
runs the prefix sum over buckets, and looks closer only where the budget ends:
at the keys of that bucket, then, if rows share the key, at the partitions of
these rows and at the rows of one partition. What a pass takes is a step (size
<= s, place before ``stop``, the first that did not fit); the next pass looks
behind it for documents that fit what is left, until nothing fits. Thus a
document is taken if any step holds it, however many documents a source has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import WORD, staged, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17
BUCKETS = 4096


def words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.25 to 1: the share of letters and white space among the characters; an empty text has 0.25."""
    length = F.char_length(text)
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\s]"))
    return F.when(length == 0, F.lit(0.25)).otherwise(1.0 - 0.75 * odd / length)


def draws(docs: DataFrame, seed: int = SEED, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> list[Column]:
    """doc_id, source, size, key and hash of each row; a weight that is null, not positive or over 1 counts as 1."""
    text, ident = text_of(text_col), F.col(id_col).cast("long")
    w = quality_weight(text) if weight is None else F.when((weight > 0) & (weight <= 1), weight).otherwise(1.0)
    drawn = F.xxhash64(F.lit(seed), ident, text)
    u = (F.shiftrightunsigned(drawn, 11) + 0.5) / float(1 << 53)
    return [ident.alias("doc_id"), F.col(source_col).cast("string").alias("source"), words_of(text).alias("size"), (1.0 - F.pow(u, 1.0 / w)).alias("key"), drawn.alias("hash")]


def numbered(rows: DataFrame) -> DataFrame:
    """The rows staged, with ``at``: a number of their own, the partition above the place in it."""
    return staged(rows.withColumn("at", F.monotonically_increasing_id()), "draws")


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``rank`` from 0 in code-point order, null last; sorted by ranges, so no task gets all."""
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    dealt = sources.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = staged(dealt.withColumn("__at", F.monotonically_increasing_id()), "sources")
    part, place = F.shiftright("__at", 33).cast("int"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r.part: r["count"] for r in numbered.groupBy(part.alias("part")).count().collect()}  # a row for each shuffle partition
    before, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(p, 0)
    base = F.get(F.array(*[F.lit(x).cast("long") for x in before or [0]]), part)
    return numbered.withColumn("rank", base + place).drop("__at")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Each round shares what the full sources leave among the others by weight;
    those that would get more than ``most`` times their size become full. The
    driver sees three sums a round.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    state = staged(ranked(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)), "targets")
    total = state.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rate = 0.0  # words for each unit of weight
    while True:  # the rate only grows, and so do the full sources: it ends when none is added
        full = F.col("cap") <= F.col("weight") * rate
        r = state.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("used"), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open")).first()
        if not r.open:
            break
        new = (total * share - r.used) / r.open
        if new <= rate:
            break
        rate = new
    return state.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * rate).alias("target"))


def _place(key: str = "key", drawn: str = "hash", at: str = "at") -> Column:
    """Where a row stands in the order of its source."""
    return F.struct(F.col(key).alias("key"), F.col(drawn).alias("hash"), F.col(at).alias("at"))


def _bound(key: float) -> Column:
    """A place before (-1) or behind (infinity) all rows."""
    return F.struct(F.lit(key).alias("key"), F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("at"))


def _ends(rows: DataFrame, level: Column) -> DataFrame:
    """Where the budget of each source ends: src, room, words (of all), end (level, base, n, at); no end where all fits.

    ``rows`` has src, room, base (the words before these rows), size and at.
    """
    sums = rows.groupBy("src", level.alias("level")).agg(
        F.sum("size").alias("words"), F.max("room").alias("room"), F.max("base").alias("base"), F.count(F.lit(1)).alias("n"), F.min("at").alias("at"),
    )
    run = F.sum("words").over(Window.partitionBy("src").orderBy("level").rowsBetween(Window.unboundedPreceding, 0))
    until = sums.withColumn("until", F.col("base") + run)
    over = F.struct("level", (F.col("until") - F.col("words")).alias("base"), "n", "at")
    return staged(until.groupBy("src").agg(F.max("room").alias("room"), F.sum("words").alias("words"), F.min(F.when(F.col("until") > F.col("room"), over)).alias("end")), "ends")


def _inside(rows: DataFrame, level: Column, ends: DataFrame) -> DataFrame:
    """The rows at which the budget ends, with the words before them as base."""
    at = ends.filter("end IS NOT NULL").select(F.col("src").alias("end_src"), F.col("end.level").alias("end_level"), F.col("end.base").alias("end_base"))
    return rows.join(at, F.col("src").eqNullSafe(F.col("end_src")) & (level == F.col("end_level"))).withColumn("base", F.col("end_base")).drop("end_src", "end_level", "end_base")


def _pass(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One step for each source with room: state (source, room, after) to (source, s, stop, got); s is the room.

    ``stop`` is the place of the first row that did not fit; its key is
    infinite where all that fit singly were taken.
    """
    fit = rows.join(state, F.col("source").eqNullSafe(F.col("src"))).filter((F.col("size") > 0) & (F.col("size") <= F.col("room")) & (_place() > F.col("after")))
    fit = fit.select("src", "room", F.lit(0).cast("long").alias("base"), "size", "key", "hash", "at")
    bucket, pair, part = F.floor(F.col("key") * BUCKETS).cast("int"), F.struct("key", "hash"), F.shiftright("at", 33)
    buckets = _ends(fit, bucket)
    whole = buckets.filter("end IS NULL").select("src", F.col("room").alias("s"), _bound(float("inf")).alias("stop"), F.col("words").alias("got"))
    near = _inside(fit, bucket, buckets)
    pairs = _ends(near, pair)

    def steps(ends: DataFrame, key: str, drawn: str, at: str) -> DataFrame:
        return ends.select("src", F.col("room").alias("s"), _place(key, drawn, at).alias("stop"), F.col("end.base").alias("got"))

    alone = steps(pairs.filter("end.n = 1"), "end.level.key", "end.level.hash", "end.at")
    tied = pairs.filter("end.n > 1")
    if tied.isEmpty():
        return whole.union(alone)
    ties = _inside(near, pair, tied)
    parts = _ends(ties, part)
    last = _ends(_inside(ties, part, parts), F.struct("at", "key", "hash"))
    return whole.union(alone).union(steps(last, "end.level.key", "end.level.hash", "end.level.at"))


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """What each source takes: source, source_size, target, epochs, steps (array of (nr, s, stop)); one row a source.

    ``rows`` has source, size, key, hash and at.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = staged(targets(sources, weights, share, most), "goals")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("room", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    state, steps = goal.select(F.col("source").alias("src"), "room", _bound(-1.0).alias("after")), []
    while True:  # stop only moves forward, past at least one row a pass
        step = _pass(rows, state)
        steps.append(step.select("src", F.lit(len(steps)).alias("nr"), "s", "stop"))
        left = step.filter("stop.key < double('inf') AND s > got").select("src", (F.col("s") - F.col("got")).alias("room"), F.col("stop").alias("after"))
        state = staged(left, "room")
        if state.isEmpty():
            break
    taken = reduce(DataFrame.union, steps).groupBy("src").agg(F.array_sort(F.collect_list(F.struct("nr", "s", "stop"))).alias("steps"))
    return goal.join(taken, F.col("source").eqNullSafe(F.col("src")), "left").select("source", "source_size", "target", "epochs", "steps")


def _times(size: Column, place: Column) -> Column:
    held = F.coalesce(F.exists("steps", lambda x: (size <= x["s"]) & (place < x["stop"])), F.lit(False)) & (size > 0)
    return F.when(size > 0, F.col("epochs") + held.cast("long")).otherwise(F.lit(0).cast("long"))


def mix(docs: DataFrame, seed: int = SEED, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each input row: doc_id, source, size, source_size, target, times, taken.

    Size counts words; a null or empty text has 0 and is never taken. The null
    source is a source of its own, the last. Rows that repeat id and text
    draw the same key and are taken one after the other; where the budget ends among them, only some are. A
    source misses its target by less than its smallest document left out. An empty table gives no rows; other columns are not read.
    """
    rows = numbered(docs.select(*draws(docs, seed, weight, id_col, text_col, source_col)))
    chosen = staged(plan(rows), "mix").withColumnRenamed("source", "src")
    joined = rows.join(chosen, F.col("source").eqNullSafe(F.col("src")))
    times = _times(F.col("size"), _place())
    return joined.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    The rows are staged, as equal ones are told apart by their staged place. Only
    the table of sources is joined to them; their texts are not shuffled.
    """
    _, source, size, key, drawn = draws(docs, seed, weight, id_col, text_col, source_col)
    kept = [c for c, kind in docs.dtypes if kind != "void"]  # Parquet has no void columns
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    rows = numbered(docs.select(row.alias("__row"), source, size, key, drawn))
    chosen = staged(plan(rows.drop("__row")), "mix").withColumnRenamed("source", "src")
    joined = rows.join(chosen, F.col("source").eqNullSafe(F.col("src")))
    times = _times(F.col("size"), _place()).cast("int")
    back = [F.col(f"__row.c{kept.index(c)}").alias(c) if c in kept else F.lit(None).alias(c) for c in docs.columns]
    return joined.select("__row", F.explode(F.array_repeat(F.lit(0), times))).select(*back)
