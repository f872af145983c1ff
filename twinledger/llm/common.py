"""What the operators share: reading, normalising, staging, row keys."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.session import scratch_path

#: A word: no space and no ASCII control white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet under the shared folder and read again.

    Lineage ends here: a lost executor rereads the files.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased; ``lower`` does that fast where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where a lambda inside names it."""
    return F.transform(F.array(value), use)[0]


def running_sum(numbers: Column) -> Column:
    """array<bigint>: the sum of each place and those before it, by doubling steps: n log n whatever the length."""

    def doubled(own: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda s: s < F.size(own))
        return F.aggregate(steps, own, lambda sums, s: F.transform(sums, lambda x, i: x + F.when(i >= s, F.get(sums, i - s)).otherwise(F.lit(0).cast("long"))))

    return bound(F.transform(numbers, lambda x: x.cast("long")), doubled)


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_rows(docs: DataFrame, keys: list[Column], winners: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``winners``, whose columns hold the keys' values.

    Nulls match nulls. Of several rows with the same keys one stays. The
    columns of ``docs`` come back whatever their names. A key becomes two columns
    without nulls, its value and whether it is null, so the join and the grouping
    behind it agree on one exchange of the rows.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[k.alias(n) for k, n in zip(keys, names)])
    wanted = winners.toDF(*names)
    zero = {"bigint": F.lit(0).cast("long"), "binary": F.lit(b""), "string": F.lit("")}

    def filled(frame: DataFrame) -> list[Column]:
        types = dict(frame.dtypes)
        return [c for n in names for c in (F.coalesce(F.col(n), zero[types[n]]).alias(n), F.col(n).isNull().alias(f"{n}_null"))]

    on = [c for n in names for c in (n, f"{n}_null")]
    kept = packed.select("__row", *filled(packed)).join(wanted.select(*filled(wanted)), on, "left_semi")
    return kept.dropDuplicates(on).select("__row.*")
