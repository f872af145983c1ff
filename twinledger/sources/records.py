"""Records of quoted CSV, read by many tasks from one file, and the broken ones among them.

A line of a file is a function from "a quoted field is open before it" to "a
quoted field is open behind it". These functions are composed for chunks of
lines and along the chunks of a file, so that every line learns
whether it begins a record without any task reading a file from its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNCLOSED = "a quoted field is not closed"
LONG = "more fields than the header"
SHORT = "fewer fields than the header"
CHUNK = 4096  # lines whose functions are composed in one array, and that are put in order together
UNIT = ("file", "start", "chunk")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(file, start, chunk, id, value, f0, f1): the lines with their block, their chunk of it and their function.

    ``id`` rises by one along a block. ``f0`` and ``f1`` say whether a
    quoted field is open behind the line if none / one was open before it.
    Doubled quotes are left out first; of the others, one closes the field
    that is open, or opens one at the begin of a field; elsewhere it is
    text. A line that cannot go on inside a quoted field (a closing quote
    with more text behind it) but is sound as the begin of a record proves
    that a field before it was never closed; it counts as the begin of a record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "\r$", "").alias("line"), "value")
    lines = lines.withColumn("chunk", F.expr(f"id div {CHUNK}"))
    parts = F.split(F.replace("line", F.lit('""'), F.lit("")), '"', -1)
    lines = lines.withColumn("parts", F.when(F.contains("line", F.lit('"')), parts)).withColumn("last", F.size("parts") - 1)

    def opens(part, i):
        return F.when(part.endswith(",") | ((i == 0) & (part == "")), 1).otherwise(0)

    def sound(first):
        """Every part outside of quotes, if those at ``first``, ``first + 2``, ... are, begins and ends at a separator."""
        def fits(part, i):
            begins = part.startswith(",") | ((i == 0) & (part == "")) | ((i == F.col("last")) & (part == ""))
            begins = begins | (i == 0)
            ends = part.endswith(",") | ((i == 0) & (part == "")) | (i == F.col("last"))
            return (i % 2 != first) | (begins & ends)
        return F.forall(F.transform("parts", fits), lambda ok: ok)

    def behind(open_before):
        steps = F.transform(F.slice("parts", F.lit(1), F.col("last")), opens)
        return F.aggregate(steps, F.lit(open_before), lambda state, opened: F.when(state == 1, 0).otherwise(opened))

    quoted = F.col("last") > 0
    restart = quoted & ~sound(1) & sound(0)
    lines = lines.withColumn("restart", F.coalesce(restart, F.lit(False)))
    lines = lines.withColumn("f0", F.when(quoted, behind(0)).otherwise(0))
    return lines.withColumn("f1", F.when(F.col("restart"), F.col("f0")).when(quoted, behind(1)).otherwise(1)).drop("parts", "last", "line")


def composed(functions):
    """(f0, f1) of the functions of an array, applied one after the other."""
    def through(state, f):
        return F.struct(F.when(state["f0"] == 1, f["f1"]).otherwise(f["f0"]).alias("f0"),
                        F.when(state["f1"] == 1, f["f1"]).otherwise(f["f0"]).alias("f1"))
    return F.aggregate(functions, F.struct(F.lit(0).alias("f0"), F.lit(1).alias("f1")), through)


def open_before(frame: DataFrame, unit, order, carry) -> DataFrame:
    """``open``: whether a quoted field is open before each row, from the functions of the rows of its unit before it.

    The last function that forgets its argument decides, turned by every
    later one that swaps; without such a function ``carry`` is turned.
    """
    upto = Window.partitionBy(*unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0)
    frame = frame.withColumn("swaps", F.sum(swaps).over(upto))
    fixed = F.when(F.col("f0") == F.col("f1"), F.struct("f0", "swaps"))
    frame = frame.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(ahead), "swapped": F.coalesce(F.last("swaps").over(ahead), F.lit(0))})
    state = F.when(F.col("fixed").isNull(), carry + F.col("swapped")).otherwise(F.col("fixed.f0") + F.col("swapped") - F.col("fixed.swaps"))
    return frame.withColumn("open", (state % 2).cast("int")).drop("swaps", "fixed", "swapped")


def read_chunks(lines: DataFrame) -> DataFrame:
    """(file, start, chunk, base, carry, lines_before, header): one row a chunk of at most ``CHUNK`` lines of a block.

    Only functions other than the identity are shuffled, in arrays of at
    most ``CHUNK`` lines; then one function a chunk goes along its file.
    """
    moves = F.when((F.col("f0") != 0) | (F.col("f1") != 1), F.struct("id", "f0", "f1"))
    filled = F.when(F.trim("value") != "", F.when(F.trim("value") != "\r", F.col("id")))
    chunks = lines.groupBy(*UNIT).agg(
        F.array_sort(F.collect_list(moves)).alias("moves"), F.count("*").alias("n"), F.min("id").alias("base"), F.min(filled).alias("filled"))
    chunks = chunks.withColumn("f", composed(F.col("moves"))).select(*UNIT, "n", "base", "filled", "f.f0", "f.f1")
    before = Window.partitionBy("file").orderBy("start", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("lines_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    header = F.min(F.col("lines_before") + F.col("filled") - F.col("base") + 1).over(Window.partitionBy("file"))
    chunks = open_before(chunks.withColumn("header", header), ["file"], ["start", "chunk"], F.lit(0))
    return chunks.select(*UNIT, "base", F.col("open").alias("carry"), "lines_before", "header")


def read_records(spark: SparkSession, path) -> DataFrame:
    """(file, line, record, closed): every record below the header with the number of its first line.

    ``record`` keeps the line breaks inside its quoted fields. A record
    whose quoted field never closes comes as one row for each of its lines,
    ``closed`` false and ``line`` the number of that line, so that nothing gathers
    the rest of a file. Empty lines between records are left out. Text is UTF-8 and
    lines end with ``\\n`` or ``\\r\\n``.
    """
    lines = read_lines(spark, path)
    lines = lines.join(read_chunks(lines), list(UNIT))
    lines = lines.withColumn("line", F.col("lines_before") + F.col("id") - F.col("base") + 1)
    lines = open_before(lines, UNIT, ["id"], F.col("carry"))
    begins = (F.col("open") == 0) | F.col("restart")
    upto = Window.partitionBy(*UNIT).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({"begins": begins, "behind": F.when(begins, F.col("f0")).otherwise(F.col("f1"))})
    lines = lines.withColumn("first", F.last(F.when(F.col("begins"), F.col("line")), ignorenulls=True).over(upto))
    single = F.col("begins") & (F.col("behind") == 0)
    whole = lines.where(single).select("file", "line", "header", F.col("value").alias("record"), F.lit(True).alias("closed"))

    pieces = lines.where(~single).select(*UNIT, "line", "first", "header", "value", "behind")
    earlier = Window.partitionBy("file").orderBy("start", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    # what is open at the end of a chunk began there or, if none of its lines begins a record, earlier
    ends = pieces.groupBy(*UNIT).agg(F.max("first").alias("ends"))
    ends = ends.select(*UNIT, F.last("ends", ignorenulls=True).over(earlier).alias("ends"))
    pieces = pieces.join(ends, list(UNIT)).withColumn("first", F.coalesce("first", "ends")).drop("start", "chunk", "ends")
    state = pieces.groupBy("file", "first").agg((F.max_by("behind", "line") == 0).alias("closed"))
    pieces = pieces.join(state, ["file", "first"])
    joined = pieces.where("closed").groupBy("file", "first", "header").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("v"))
    joined = joined.select("file", F.col("first").alias("line"), "header", F.array_join("v.value", "\n").alias("record"), F.lit(True).alias("closed"))
    broken = pieces.where("not closed").select("file", "line", "header", F.col("value").alias("record"), "closed")
    out = whole.unionByName(joined).unionByName(broken).where("line > header or not closed")
    out = out.withColumn("record", F.regexp_replace("record", "\r$", ""))
    return out.where((F.trim("record") != "") | ~F.col("closed")).select("file", "line", "record", "closed")


def parsed(records: DataFrame, width: int, options: dict) -> DataFrame:
    """(file, line, record, reason, c0, c1, ...): the fields of each record as text; ``reason`` says why it is broken, else null.

    A short record has nulls in the fields it lacks; an unclosed one has no fields.
    """
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in [*names, "other"])
    known = {k: options[k] for k in ("sep", "quote", "escape") if k in options}
    fields = F.from_csv("record", schema, {**known, "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": "other"})
    outside = F.filter(F.split(F.replace("record", F.lit('""'), F.lit("")), '"', -1), lambda part, i: i % 2 == 0)
    many = F.length(F.regexp_replace(F.array_join(outside, ""), "[^,]", "")) >= width
    frame = records.withColumn("f", F.when(F.col("closed"), fields))
    reason = F.when(~F.col("closed"), UNCLOSED).when(F.col("f.other").isNotNull(), F.when(many, LONG).otherwise(SHORT))
    return frame.select("file", "line", "record", reason.alias("reason"), *[F.col(f"f.{c}").alias(c) for c in names])
