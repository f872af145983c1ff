"""File datasets: CSV as text columns, Parquet and ORC with their own types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V
from twinledger.model import DatasetError
from twinledger.sources.records import LONG, SHORT, parsed, read_records

OVERFLOW = "__overflow"
MALFORMED = "the file has records that cannot be read"


@dataclass(frozen=True)
class FileRef:
    """A path and its format; the format defaults to the file extension.

    ``splittable`` states whether no quoted CSV field holds a line break, so
    that Spark's own reader may cut one large file; stated as false, each file of the
    folder is one unit of parallelism. Where it is not stated, the lines are
    looked through for an open quote first, and files that have one are
    read by their quotes (``records``), by many tasks as well.
    With ``quarantine`` the broken records of a CSV file are set aside.
    """

    path: str
    format: str | None = None
    null_tokens: tuple = V.NULL_TOKENS
    splittable: bool | None = None
    quarantine: bool = False
    options: dict = field(default_factory=dict, hash=False)

    @property
    def label(self) -> str:
        return self.path


def file_format(ref: FileRef) -> str:
    fmt = ref.format or ref.path.rstrip("/").rsplit(".", 1)[-1].lower()
    if fmt not in ("csv", "parquet", "orc"):
        raise DatasetError("FILE_TYPE_UNSUPPORTED", f"cannot read {ref.path}")
    return fmt


def read_file(spark: SparkSession, ref: FileRef) -> DataFrame:
    fmt = file_format(ref)
    try:
        df = read_csv(spark, ref) if fmt == "csv" else spark.read.options(**ref.options).format(fmt).load(ref.path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise DatasetError("FILE_NOT_FOUND", ref.path) from e
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise DatasetError("FILE_EMPTY", ref.path) from e
        raise DatasetError("FILE_UNREADABLE", f"{ref.path}: {e}") from e
    except PySparkException as e:
        raise DatasetError("FILE_UNREADABLE", f"{ref.path}: {e}") from e
    return upper_header(df)


def require_distinct(names) -> None:
    upper = [c.upper() for c in names]
    twice = {c for c in upper if upper.count(c) > 1}
    if twice:
        raise DatasetError("DUPLICATE_COLUMN", ",".join(sorted(twice)))


def upper_header(df: DataFrame) -> DataFrame:
    require_distinct(df.columns)
    return df.toDF(*[c.upper() for c in df.columns])


def look_through(spark: SparkSession, path: str):
    """(header lines with the files that have them, no quoted field holds a line break).

    One pass over the lines, split like any text. A field that goes on behind
    the end of its line leaves an odd number of quotes in it, because quotes
    inside fields are doubled. The first line of a file is the first of
    its first block.
    """
    lines = spark.read.text(path).where("value <> ''").selectExpr(
        "value", "_metadata.file_path as file", "_metadata.file_block_start as start")
    blocks = lines.groupBy("file", "start").agg(
        F.first("value").alias("line"), F.count_if(F.expr("length(value) - length(replace(value, '\"', ''))") % 2 == 1).alias("open"))
    files = blocks.groupBy("file").agg(F.min_by("line", "start").alias("header"), F.sum("open").alias("open"))
    rows = files.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"), F.sum("open").alias("open")).collect()
    rows = sorted(rows, key=lambda r: r["files"][0])
    return {r["header"]: r["files"] for r in rows}, not any(r["open"] for r in rows)


def read_csv(spark: SparkSession, ref: FileRef) -> DataFrame:
    """Header, comma, UTF-8; every column as text with null tokens as null.

    Value classes are inferred later from all values.  A record with too few
    fields is filled with nulls; one with too many, or with a quoted field that never
    closes, stops the job that reads it, unless ``ref.quarantine`` sets
    broken records aside, short ones included (``bad_records`` gives them).  Files
    of a folder may order their columns differently; other columns are an error.
    """
    options = _options(ref)
    headers, whole_lines = look_through(spark, ref.path) if _plain(options) else ({None: None}, False)
    if not headers:
        raise DatasetError("FILE_EMPTY", ref.path)
    splittable = whole_lines if ref.splittable is None else ref.splittable
    options = {"multiLine": not splittable, **options}
    by_quotes = _by_quotes(ref, options) and (ref.quarantine or not (splittable or ref.splittable is False))
    parts = [_read_alike(spark, ref, options, files if len(headers) > 1 else ref.path, by_quotes) for files in headers.values()]
    names = {frozenset(c.upper() for c in p.columns) for p in parts}
    if len(names) > 1:
        raise DatasetError("FILE_HEADERS_DIFFER", ref.path)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(upper_header(p).toDF(*[_as_in(out, c) for c in p.columns]))
    return out


def bad_records(spark: SparkSession, ref: FileRef) -> DataFrame:
    """(file, line, reason, record): the broken records of CSV files with the number of their first line.

    A record is broken if it has more or fewer fields than the header of its
    file or a quoted field that never closes; of the last kind every line
    that it swallowed is one row, up to the line that proves the mistake or to the end of the file.
    """
    options = _options(ref)
    if file_format(ref) != "csv" or not _by_quotes(ref, options):
        raise DatasetError("FILE_TYPE_UNSUPPORTED", f"broken records are known only of plain CSV, not of {ref.path}")
    headers, _ = look_through(spark, ref.path)
    if not headers:
        raise DatasetError("FILE_EMPTY", ref.path)
    out = None
    for files in headers.values():
        path = files if len(headers) > 1 else ref.path
        frame = parsed(read_records(spark, path), len(_header(spark, ref, options, path)), options)
        frame = frame.where("reason is not null").select("file", "line", "reason", "record")
        out = frame if out is None else out.unionByName(frame)
    return out


def lines_ahead(spark: SparkSession, ref: FileRef, headers: int = 0) -> DataFrame:
    """(file, ahead): the lines of all files before each file of a folder, by name, without the first ``headers`` of a later file.

    Added to a line's number in its file, it gives the number in the files put one behind the other under one header.
    One row a file is left when they are put in order.
    """
    lines = spark.read.option("lineSep", "\n").text(ref.path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return lines.select("file", F.coalesce(F.sum(F.col("n") - headers).over(before), F.lit(0)).alias("ahead"))


def _options(ref: FileRef) -> dict:
    return {"header": True, "sep": ",", "encoding": "UTF-8", "quote": '"', "escape": '"', **ref.options}


def _plain(options: dict) -> bool:
    """What counts as an open quote is known only for doubled quotes in UTF-8."""
    return (options["quote"], options["escape"], options["encoding"].upper()) == ('"', '"', "UTF-8")


def _by_quotes(ref: FileRef, options: dict) -> bool:
    return _plain(options) and options["sep"] == "," and not set(ref.options) - {"sep", "quote", "escape", "encoding", "header"}


def _as_in(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.upper() == name.upper())


def _header(spark: SparkSession, ref: FileRef, options: dict, path) -> list[str]:
    # the names as written: the reader itself would rename repeated ones
    header = spark.read.options(**{**options, "header": False}).csv(path).head()
    if header is None:
        raise DatasetError("FILE_EMPTY", ref.path)
    names = [name or f"_C{i}" for i, name in enumerate(header)]
    require_distinct(names)
    return names


def _read_alike(spark: SparkSession, ref: FileRef, options: dict, path, by_quotes: bool) -> DataFrame:
    """Files with one header."""
    names = _header(spark, ref, options, path)
    if by_quotes:
        df = parsed(read_records(spark, path), len(names), options)
        if ref.quarantine:
            fits = F.col("reason").isNull()
        else:
            where = F.concat(F.lit(f"{MALFORMED}: "), "file", F.lit(" line "), "line", F.lit(": "), "reason")
            fits = F.when(F.col("reason").isNull() | (F.col("reason") == SHORT), True).otherwise(F.raise_error(where).cast("boolean"))
        df = df.where(fits).drop("file", "line", "record", "reason").toDF(*names)
    else:
        fields = [T.StructField(c, T.StringType()) for c in names]
        schema = T.StructType(fields + [T.StructField(OVERFLOW, T.StringType())])
        df = spark.read.options(**options).schema(schema).csv(path)
        fits = F.when(F.col(OVERFLOW).isNull(), True).otherwise(F.raise_error(F.lit(f"{MALFORMED}: {ref.path}: {LONG}")))
        df = df.where(fits.cast("boolean"))
    return df.selectExpr(*[f"{V.null_tokens_to_null(V.quoted(c), ref.null_tokens)} as {V.quoted(c)}" for c in names])
