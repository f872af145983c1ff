"""Plain data carried between the planning side and the Spark jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Report labels, one per check (fixed values).
COUNT_CHECK = "Count validation"
DATATYPE_CHECK = "Datatype Validation"
DATA_CHECK = "Data Validation"
DUPLICATE_CHECK = "Duplicate Validation"
CHECKS = (COUNT_CHECK, DATATYPE_CHECK, DATA_CHECK, DUPLICATE_CHECK)

# Dataset systems (fixed values).
SQLSERVER = "SQLSERVER"
SNOWFLAKE = "SNOWFLAKE"
SPARK = "SPARK"
FILE = "FILE"

INFO, WARNING, ERROR = "info", "warning", "error"

# code -> (severity, makes the check fail, position inside its check)
FINDING_CODES = {
    "COUNT": (INFO, False, 0),
    "COUNT_MISMATCH": (ERROR, True, 0),
    "TYPE_UNMAPPED": (ERROR, True, 0),
    "TYPE_MISMATCH": (ERROR, True, 1),
    "TRUNCATION": (WARNING, False, 2),
    "KEY_NOTE": (INFO, False, 0),
    "UNSUPPORTED_TYPE": (ERROR, True, 1),
    "DATE_AMBIGUOUS": (WARNING, False, 1),
    "BAD_RECORDS": (ERROR, True, 1),
    "EXTRA_EMPTY_RECORDS": (ERROR, True, 2),
    "MISSING_EMPTY_RECORDS": (ERROR, True, 2),
    "NULL_POPULATED": (ERROR, True, 3),
    "TARGET_KEY_NOT_UNIQUE": (WARNING, True, 4),
    "EXTRA_IN_SOURCE": (ERROR, True, 5),
    "EXTRA_IN_TARGET": (ERROR, True, 6),
    "MISMATCH_COUNT": (ERROR, True, 7),
    "VALUE_MISMATCH": (ERROR, True, 8),
    "EXTRA_DUPLICATES": (ERROR, True, 0),
    "DUPLICATES_NOT_LOADED": (WARNING, True, 0),
    "DUPLICATES_EQUAL": (WARNING, True, 1),
    "DUPLICATES_PARTIAL": (WARNING, True, 2),
    "DUPLICATES_EXTRA_LOADED": (ERROR, True, 3),
    "DUPLICATES_ONLY_SOURCE": (ERROR, True, 4),
    "DUPLICATES_ONLY_TARGET": (ERROR, True, 5),
    "PAIR_ERROR": (ERROR, True, 9),
}

FINDINGS_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("code", T.StringType(), False),
        T.StructField("source_column", T.StringType()),
        T.StructField("target_column", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("key", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source_value", T.StringType()),
        T.StructField("target_value", T.StringType()),
        # position of the column in the compared list, then of the example
        # inside its column: together with the code they order a report
        T.StructField("column_order", T.IntegerType()),
        T.StructField("example", T.IntegerType()),
    ]
)

# Columns of the report and of the pair manifest.
REPORT_COLUMNS = (
    "source_table",
    "target_table",
    "Validation_type",
    "Validation_Result",
    "Reason",
    "execution_time",
)

MANIFEST_COLUMNS = (
    "SourceDB",
    "SourceSchema",
    "SourceTable",
    "SourceFilePath",
    "SourceColumns",
    "TargetDB",
    "TargetSchema",
    "TargetTable",
    "TargetFilePath",
    "TargetColumns",
)
# Columns of the manifest that may be left out.
MANIFEST_OPTIONS = ("SourceKey", "SourcePartitionColumn", "TargetPartitionColumn")


class DatasetError(Exception):
    """A dataset or a pair that cannot be validated, with a stable code."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code
        self.message = message


@dataclass(frozen=True)
class ColumnPair:
    source: str
    target: str


@dataclass(frozen=True)
class ValueClass:
    """How the values of one column pair are compared.

    ``kind`` is boolean, numeric, date, string or nested.  ``number`` is the
    common Spark type of a numeric pair; the formats are those that every
    textual date of a side fits (None: the side is a real date/timestamp).
    """

    kind: str
    number: str = "double"
    source_format: str | None = None
    target_format: str | None = None


@dataclass(frozen=True)
class RunConfig:
    """What the operator of a validation run chooses."""

    source_type: str = SPARK
    target_type: str = SPARK
    output_type: str = "CSV"
    output_path: str | None = None
    output_table: str | None = None
    source_connection: object | None = None
    target_connection: object | None = None
    output_connection: object | None = None
    max_error_records: int = 10
    date_formats: tuple[str, ...] | None = None
    null_tokens: tuple[str, ...] | None = None
    key_sample_rows: int = 50_000
    # None: every CSV folder is looked through for fields that hold line breaks
    csv_splittable: bool | None = None
    # broken CSV records are set aside and reported; else they fail the pair
    csv_quarantine: bool = False
    concurrent_pairs: int = 4
    # so many repeated row digests, of eight bytes each, may be broadcast
    broadcast_digests: int = 1_000_000

    def __post_init__(self):
        n = self.max_error_records
        if isinstance(n, bool) or not isinstance(n, int) or n < 0:
            raise DatasetError("BAD_CONFIG", f"max_error_records must be a whole number >= 0, got {n!r}")


def finding(check, code, source_column=None, target_column=None, count=None,
            source_value=None, target_value=None, column_order=0):
    """One finding row known on the planning side."""
    return (check, FINDING_CODES[code][0], code, source_column, target_column, count,
            None, source_value, target_value, column_order, 0)
