"""Findings of a pair -> report rows with one verdict per check."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.model import CHECKS, FINDING_CODES, FINDINGS_SCHEMA, REPORT_COLUMNS
from twinledger.plans.comparison import by_code

# Codes that share one report row for all their columns.
ONE_ROW_CODES = ("TYPE_UNMAPPED", "TYPE_MISMATCH", "TRUNCATION", "NULL_POPULATED", "MISMATCH_COUNT",
                 "UNSUPPORTED_TYPE", "DATE_AMBIGUOUS")
HIDDEN_CODES = ("KEY_NOTE",)


def findings_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), FINDINGS_SCHEMA)


def _names(c: str) -> str:
    return V.display_name_of(c)


# What one finding contributes to the reason of its report row.
KEY_TEXT = f"array_join(transform(map_entries(key), e -> concat({_names('e.key')}, ' = ', e.value)), ', ')"
CELL_TEXT = (
    f"concat('source ', {_names('source_column')}, ' = ', coalesce(source_value, 'null'), "
    f"', target ', {_names('target_column')}, ' = ', coalesce(target_value, 'null'), ' for key ', {KEY_TEXT})"
)
PIECE = f"""case
    when code in ('COUNT', 'COUNT_MISMATCH')
        then concat('source count = ', source_value, ', target count = ', target_value)
    when code = 'MISMATCH_COUNT' then concat({_names('source_column')}, ' = ', count)
    when code = 'NULL_POPULATED' then {_names('target_column')}
    when code = 'VALUE_MISMATCH' then {CELL_TEXT}
    when code = 'PAIR_ERROR' then source_value
    when code = 'BAD_RECORDS' then concat(count, ' in ', coalesce(source_value, target_value))
    when source_column is not null then {_names('source_column')}
    else cast(count as string) end"""


# Our own wording, one text per code.
REASONS = {
    "COUNT": "{}",
    "COUNT_MISMATCH": "{}",
    "TYPE_UNMAPPED": "no type mapping for {}",
    "TYPE_MISMATCH": "datatype mismatch in {}",
    "TRUNCATION": "warning: values may be truncated in {}",
    "UNSUPPORTED_TYPE": "columns of an unsupported type: {}",
    "DATE_AMBIGUOUS": "warning: day and month cannot be told apart in {}",
    "BAD_RECORDS": "broken records set aside: {}",
    "EXTRA_EMPTY_RECORDS": "{} extra empty records in target",
    "MISSING_EMPTY_RECORDS": "{} empty records missing in target",
    "NULL_POPULATED": "target columns populated as nulls: {}",
    "TARGET_KEY_NOT_UNIQUE": "warning: the key is not unique in target: {}",
    "EXTRA_IN_SOURCE": "{} extra records in source",
    "EXTRA_IN_TARGET": "{} extra records in target",
    "MISMATCH_COUNT": "mismatch count by column: {}",
    "VALUE_MISMATCH": "mismatched data: {}",
    "EXTRA_DUPLICATES": "{} extra duplicate records in target",
    "DUPLICATES_NOT_LOADED": "warning: none of the {} duplicate records was loaded",
    "DUPLICATES_EQUAL": "warning: {} duplicate records are the same on both sides",
    "DUPLICATES_PARTIAL": "warning: {} duplicate records are partially loaded",
    "DUPLICATES_EXTRA_LOADED": "{} duplicate records are loaded too often",
    "DUPLICATES_ONLY_SOURCE": "{} duplicate records did not reach target",
    "DUPLICATES_ONLY_TARGET": "{} duplicate records exist only in target",
    "PAIR_ERROR": "{}",
}


def _reason(pieces: str) -> str:
    cases = []
    for code, text in REASONS.items():
        before, after = text.split("{}")
        cases.append(f"when '{code}' then concat('{before}', {pieces}, '{after}')")
    return f"case code {' '.join(cases)} end"


def report(findings: DataFrame, source_label: str, target_label: str, checks=CHECKS,
           execution_time: datetime | None = None) -> DataFrame:
    """Report rows, failed checks first.

    A finding frame holds a few rows per column, so the groupings below are
    over control data whatever the size of the tables. The time is that of the
    call, not of the later job that writes the rows.
    """
    failing = ", ".join(f"'{code}'" for code, spec in FINDING_CODES.items() if spec[1])
    one_row = "code in (" + ", ".join(f"'{c}'" for c in ONE_ROW_CODES) + ")"
    verdicts = findings.selectExpr("check", f"code in ({failing}) as fails").groupBy("check").agg(
        F.max("fails").alias("failed"))
    rows = (
        findings.where("code not in (" + ", ".join(f"'{c}'" for c in HIDDEN_CODES) + ")")
        .selectExpr("check", "code", f"if({one_row}, 0, column_order) as at", f"if({one_row}, 0, example) as nth",
                    f"struct(column_order, {PIECE} as piece) as piece")
        .groupBy("check", "code", "at", "nth")
        .agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
        .selectExpr("check", "code", "at", "nth", f"{by_code(2)} as code_order",
                    _reason("array_join(transform(pieces, p -> p.piece), ', ')") + " as Reason")
    )
    base = findings.sparkSession.createDataFrame([(c, CHECKS.index(c)) for c in checks], "check string, seq int")
    now = F.lit(execution_time if execution_time is not None else datetime.now(UTC))
    return (
        base.join(verdicts, "check", "left").join(rows, "check", "left")
        .withColumn("result", F.expr("if(coalesce(failed, false), 'Fail', 'Pass')"))
        .orderBy(F.expr("result <> 'Fail'"), "seq", "code_order", "at", "nth")
        .withColumn("now", now)
        .selectExpr(
            f"{V.text_literal(source_label)} as source_table", f"{V.text_literal(target_label)} as target_table",
            "check as Validation_type", "result as Validation_Result", "coalesce(Reason, '') as Reason",
            "date_format(now, 'yyyy-MM-dd HH:mm:ss') as execution_time",
        )
        .select(*REPORT_COLUMNS)
    )
