"""Document fingerprints by SpotSigs, DataFrame functions only.

A *spot* is an anchor word (a frequent word that running text has and page
furniture lacks) with the chain of the next content words behind it; stop
words in between are skipped. The set of a text's spots is its fingerprint.
Sets are partitioned by their length, in steps of the threshold, so that sets
of at least that Jaccard likeness lie in the same or neighbouring partitions,
and are compared there through a Jaccard that is pruned by length first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import bound, staged, text_of

CHAIN = 2
THRESHOLD = 0.8
#: Buckets are dealt to partitions by hash; many small ones make the partitions even.
BUCKETS_PER_PARTITION = 8
#: Hex digits of a spot's MD5.
DIGITS = 12

# Articles and copulas in English, German, French and Spanish.
ANCHORS = ("a", "an", "the", "is", "der", "die", "das", "ein", "le", "les", "un", "une", "el", "los", "una")
# Further frequent words of these languages that a chain skips.
STOPS = (
    "of", "and", "to", "in", "that", "was", "with", "by", "for", "on", "as", "at", "it", "be", "or", "from", "this", "are", "he",
    "und", "von", "im", "ist", "nicht", "mit", "den", "dem", "des", "sich", "auf", "zu", "als", "auch", "es",
    "de", "la", "et", "du", "en", "que", "qui", "dans", "par", "pour", "sur", "au", "avec", "pas", "est",
    "y", "las", "del", "se", "por", "con", "para", "su", "al", "esta",
)


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted set of the text's spots, each as ``DIGITS`` hex digits.

    A text without a whole spot has one signature, that of all its words; a text without a word has none.
    """
    anchor, stop = "(?:" + "|".join(ANCHORS) + ") ", "(?:" + "|".join(STOPS) + ") "
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    told = F.regexp_replace(words, "(?<= )" + stop, "")
    behind = ("(?:" + anchor + ")*+[^ ]+ ") * (chain - 1)
    # The last anchor of a run starts one spot. The others of longer runs are taken run by run, so that no run is read once for each of its anchors.
    last = F.lit("(?<= )(?=(" + anchor + "(?!" + anchor + ")[^ ]+ " + behind + "))")
    run = F.lit("(?<= )(?<! (?:" + "|".join(ANCHORS) + ") )(?=((?:" + anchor + "){2,}+[^ ]+ " + behind + "))")

    def spread(match: Column) -> Column:
        """A line for each anchor of the run, with the words of the chain."""
        own = F.array_distinct(F.split(F.rtrim(F.regexp_extract(match, "^(?:" + anchor + ")++", 0)), " "))
        chained = F.trim(F.regexp_replace(F.concat(F.lit(" "), match), "(?<= )" + anchor, ""))
        return F.array_join(F.transform(own, lambda a: F.concat(a, F.lit(" "), chained)), "\n")

    def lines(told: Column) -> Column:
        first = F.regexp_replace(F.array_join(F.regexp_extract_all(told, last, F.lit(1)), "\n"), "(?<= )" + anchor, "")
        return F.concat_ws("\n", first, F.array_join(F.transform(F.regexp_extract_all(told, run, F.lit(1)), spread), "\n"))

    whole = F.trim(F.regexp_replace(words, " +", " "))
    found = bound(F.split(F.btrim(bound(told, lines), F.lit(" \n")), " ?\n+"), lambda own: F.when(own[0] != "", own).when(whole != "", F.array(whole)).otherwise(F.array().cast("array<string>")))
    return F.sort_array(F.array_distinct(F.transform(found, lambda s: F.substring(F.md5(s.cast("binary")), 1, DIGITS))))


def length_partition(sigs: Column, threshold: float = THRESHOLD) -> Column:
    """Lengths up to a factor of 1 / threshold share a partition; an empty set has -1."""
    return F.when(F.size(sigs) == 0, -1).otherwise(F.floor(F.log(F.size(sigs).cast("double")) / -math.log(threshold) + 1e-9)).cast("int")


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets, 1 for two empty ones; 0 without intersecting them if their lengths force it under ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(large == 0, F.lit(1.0)).when((small == 0) | (small / large < least), F.lit(0.0)).otherwise(exact)


def _bucketed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, text, bucket) with buckets of about equal numbers of rows in order of the ids; null ids lie in the last."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = parts * BUCKETS_PER_PARTITION
    ident = F.col(id_col).cast("long")
    cuts = docs.agg(F.percentile_approx(ident, [i / n for i in range(1, n)], 50 * n)).first()[0] or []
    bounds = sorted(set(cuts))
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    if bounds:  # binary search: how many bounds are not above the id
        bound = F.array(*[F.lit(b).cast("long") for b in bounds])
        at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda lo, s: F.when(F.get(bound, lo + s - 1) <= F.col("id"), lo + s).otherwise(lo))
        bucket = F.when(F.col("id").isNull(), F.lit(len(bounds))).otherwise(at)
    else:
        bucket = F.lit(0)
    return docs.select(ident.alias("id"), text_of(text_col).alias("text")).withColumn("bucket", bucket), parts


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, sigs, next_text, next_sigs): each row beside the next in order of id, the last beside the first.

    Rows of one id are ordered by a hash of their texts. A text is shuffled once: to its bucket, which
    also gets the first row of the bucket behind it.
    """
    rows, parts = _bucketed(docs, id_col, text_col)
    spark = docs.sparkSession
    order = F.xxhash64("text")
    firsts = {r.bucket: (r.id, r.any) for r in rows.groupBy("bucket").agg(F.min("id").alias("id"), F.count("*").alias("any")).collect()}  # a row for each bucket
    there = sorted(firsts)
    before = {b: there[i - 1] for i, b in enumerate(there)}
    known = spark.createDataFrame([(firsts[b][0], b, before[b]) for b in there], "f_id long, f_bucket int, into int")
    first = rows.join(F.broadcast(known), F.col("id").eqNullSafe(F.col("f_id")) & (F.col("bucket") == F.col("f_bucket")))
    heads = first.groupBy("into", "id").agg(F.min_by("text", order).alias("text"))
    dealt = rows.withColumn("copy", F.lit(False)).unionByName(heads.select("id", "text", F.col("into").alias("bucket"), F.lit(True).alias("copy")))
    dealt = dealt.repartition(parts, "bucket").withColumn("sigs", signatures(F.col("text")))
    in_order = Window.partitionBy("bucket").orderBy("copy", F.asc_nulls_last("id"), order)
    paired = dealt.withColumn("next_text", F.lead("text").over(in_order)).withColumn("next_sigs", F.lead("sigs").over(in_order))
    return paired.filter(~F.col("copy")).select("id", "text", "sigs", "next_text", "next_sigs")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, length_partition.

    The edited text has its last quarter replaced by as much of the beginning
    of the next document. A fingerprint is the sorted spots, joined. A null
    text is empty: its fingerprint is empty and like other empty ones only. A
    null id comes last. A single document is its own next one; an empty table
    gives no rows. Other columns are not read.
    """
    pairs = with_next(docs, id_col, text_col)
    length = F.char_length("text")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = pairs.withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        F.col("id").alias("doc_id"), length.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("sigs", "").alias("fingerprint"), F.array_join("edited_sigs", "").alias("edited_fingerprint"),
        pruned_jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), pruned_jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_partition(F.col("sigs")).alias("length_partition"),
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class, sigs): one row for each input row; equal fingerprints share a class, named by the MD5 of the joined spots.

    Null ids, repeated rows and texts without a word, whose class is that of the empty fingerprint, have theirs like any other.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), signatures(text_of(text_col)).alias("sigs"))
    return rows.withColumn("class", F.md5(F.array_join("sigs", "").cast("binary"))).select("doc_id", "class", "sigs")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): (doc_id, class) of every input row, and (a, b, likeness) with a < b of classes at least ``threshold`` alike.

    Together they hold every link between rows: those within a class and, for each pair, those of
    all rows of one class with all of the other. Copies are compared once, as a class. Only the rarest
    ``n - ceil(threshold * n) + 1`` spots of a set are looked up: sets as like as that share one
    of them. They meet within a length partition and with the one below. The empty fingerprint is like no other.
    """
    own = staged(classes(docs, id_col, text_col), "spots")
    sets = own.filter("size(sigs) > 0").groupBy("class").agg(F.any_value("sigs").alias("sigs"))  # alike in all rows of a class
    sets = staged(sets, "spot-sets")
    spots = sets.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("spot"))
    often = spots.groupBy("spot").agg(F.count("*").alias("df"))
    ranked = spots.join(often, "spot").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("rare"))
    kept = F.slice("rare", 1, (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    part = length_partition(F.col("rare"), threshold).alias("part")
    lists = staged(ranked.select("class", "n", part, F.explode(kept).alias("r")).select("class", "n", "part", "r.spot"), "spot-lists")
    right = lists.select("spot", F.col("class").alias("b_class"), F.col("n").alias("b_n"), F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    fits = (F.col("n") <= F.col("b_n")) & (F.col("n") >= F.col("b_n") * threshold - 1e-9) & (F.col("class") != F.col("b_class"))
    met = lists.join(right, ["spot", "part"]).filter(fits)
    pairs = met.select(F.least("class", "b_class").alias("a"), F.greatest("class", "b_class").alias("b")).distinct()
    full = pairs.join(sets.select(F.col("class").alias("a"), F.col("sigs").alias("a_sigs")), "a").join(sets.select(F.col("class").alias("b"), F.col("sigs").alias("b_sigs")), "b")
    likeness = pruned_jaccard(F.col("a_sigs"), F.col("b_sigs"), threshold)
    return own.select("doc_id", "class"), full.select("a", "b", likeness.alias("likeness")).filter(F.col("likeness") >= threshold)
