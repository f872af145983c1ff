"""Validation of one pair and of a manifest of pairs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from threading import Lock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.model import (
    CHECKS,
    COUNT_CHECK,
    DATA_CHECK,
    DATATYPE_CHECK,
    FILE,
    MANIFEST_COLUMNS,
    MANIFEST_OPTIONS,
    REPORT_COLUMNS,
    SPARK,
    SQLSERVER,
    SNOWFLAKE,
    DatasetError,
    RunConfig,
    finding,
)
from twinledger.operators import classes as C
from twinledger.operators.clean import COPIES, group_copies, repeated_digests, split_copies, with_row_digest
from twinledger.operators.datatypes import datatype_comparison, datatype_findings
from twinledger.operators.keys import OUTSIDE, KeyResult, resolve_key
from twinledger.plans.comparison import Comparison, by_code
from twinledger.plans.pairing import align, pair_columns, split_names, split_supported
from twinledger.plans.report import findings_frame, report
from twinledger.session import Staged, scratch_path
from twinledger.sinks.ledger import Ledger
from twinledger.sources import jdbc, metadata
from twinledger.sources.files import MALFORMED, FileRef, bad_records, file_format, read_file
from twinledger.sources.jdbc import JdbcRef
from twinledger.sources.tables import TableRef, read_table


@dataclass(frozen=True)
class PairSpec:
    """One row of a manifest after its references are resolved.

    A side is a FileRef, TableRef, JdbcRef or a DataFrame; ``labels`` name the
    sides in the report where the reference does not.
    """

    source: object
    target: object
    source_columns: object = None
    target_columns: object = None
    declared_key: tuple = ()
    source_system: str = SPARK
    target_system: str = SPARK
    labels: tuple = (None, None)


@dataclass
class PairResult:
    findings: DataFrame
    report: DataFrame
    key: KeyResult | None = None
    classes: dict = field(default_factory=dict)
    staged: list = field(default_factory=list)

    def release(self) -> None:
        for s in self.staged:
            s.release()
        self.staged = []


def load(spark: SparkSession, ref) -> DataFrame:
    if isinstance(ref, DataFrame):
        return ref.toDF(*[c.upper() for c in ref.columns])
    if isinstance(ref, FileRef):
        return read_file(spark, ref)
    if isinstance(ref, TableRef):
        return read_table(spark, ref)
    if isinstance(ref, JdbcRef):
        if not jdbc.table_exists(spark, ref):
            raise DatasetError("TABLE_NOT_FOUND", ref.full_name)
        return jdbc.read_jdbc(spark, ref)
    raise DatasetError("UNKNOWN_SOURCE", f"cannot read {ref!r}")


def _label(ref, given) -> str:
    return given or getattr(ref, "label", None) or "dataframe"


def _metadata(spark, ref, df, system):
    if isinstance(ref, JdbcRef):
        return jdbc.column_metadata(spark, ref)
    return metadata.declared_metadata(df, system)


def run_pair(spark: SparkSession, spec: PairSpec, config: RunConfig | None = None,
             mapping: DataFrame | None = None, execution_time: datetime | None = None) -> PairResult:
    """All checks of one pair.

    A pair that cannot be read or paired becomes a failed report row instead
    of stopping a run.
    """
    config = config or RunConfig()
    labels = tuple(_label(r, given) for r, given in zip((spec.source, spec.target), spec.labels))
    try:
        return _validate(spark, spec, config, mapping, execution_time, labels)
    except DatasetError as e:
        return _failed(spark, str(e), labels, execution_time)
    except PySparkException as e:
        if MALFORMED not in str(e):
            raise
        shown = [_broken(spark, ref, name) for ref, name in zip((spec.source, spec.target), ("source", "target"))]
        found = "; ".join(f"{n} in {text}" for n, text in filter(None, shown))
        return _failed(spark, f"FILE_MALFORMED: {MALFORMED}" + (f": {found}" if found else ""), labels, execution_time)


def _broken(spark, ref, name: str, shown: int = 3):
    """(number of broken records, text that names the first few) of a CSV side, None without any."""
    try:
        if not isinstance(ref, FileRef) or file_format(ref) != "csv":
            return None
        bad = bad_records(spark, ref)
    except DatasetError:
        return None
    first = bad.orderBy("file", "line").select("file", "line", "reason").limit(shown).collect()
    if not first:
        return None
    return bad.count(), f"{name} (" + ", ".join(f"{r['file'].rsplit('/', 1)[-1]} line {r['line']}: {r['reason']}" for r in first) + ")"


def _failed(spark, message, labels, execution_time) -> PairResult:
    findings = findings_frame(spark, [finding(DATA_CHECK, "PAIR_ERROR", source_value=message)])
    return PairResult(findings, report(findings, *labels, checks=(DATA_CHECK,), execution_time=execution_time))


def _validate(spark, spec, config, mapping, execution_time, labels) -> PairResult:
    source, target = load(spark, spec.source), load(spark, spec.target)
    is_file = [isinstance(r, FileRef) for r in (spec.source, spec.target)]
    pairs = pair_columns(spec.source_columns, spec.target_columns, source.columns, target.columns, *is_file)
    # positions as names: no clash with helper columns, no quoting of odd names
    at = [f"c{i}" for i in range(len(pairs))]
    s_names = {a: p.source for a, p in zip(at, pairs)}
    t_names = {a: p.target for a, p in zip(at, pairs)}
    local, frames = [], []
    for ref, side, column in ((spec.source, "source", "source_value"), (spec.target, "target", "target_value")):
        broken = _broken(spark, ref, side) if getattr(ref, "quarantine", False) else None
        if broken:
            local.append(finding(DATA_CHECK, "BAD_RECORDS", count=broken[0], **{column: broken[1]}))

    checks = CHECKS
    if any(is_file):
        checks = tuple(c for c in CHECKS if c != DATATYPE_CHECK)
    else:
        frames.append(_datatype_frame(spark, spec, source, target, pairs, mapping))

    src, tgt = align(source, target, pairs, at)
    columns, unsupported = split_supported(src, tgt)
    if not columns:
        raise DatasetError("UNSUPPORTED_TYPE", "no column of the pair can be compared")
    local += [finding(DATA_CHECK, "UNSUPPORTED_TYPE", s_names[c], t_names[c], column_order=at.index(c))
              for c in unsupported]
    formats = config.date_formats or V.DATE_FORMATS

    with ThreadPoolExecutor(2) as pool:  # the sides do not depend on each other
        s, t = pool.map(lambda df: Side(df.select(*columns), config.broadcast_digests), (src, tgt))
    comparison = None
    try:
        s_facts, t_facts = C.collect_facts(s.frame, t.frame, columns, formats)
        local.append(_count_finding(s_facts.rows, t_facts.rows))

        rows = s.frame.drop(COPIES).dropna("all", subset=columns)
        declared = spec.declared_key
        if not declared and isinstance(spec.source, JdbcRef):
            declared = jdbc.declared_key(spark, spec.source)
        distinct = s_facts.rows - s_facts.surplus_rows - (1 if s_facts.empty_rows else 0)
        by_name = {s_names[c]: c for c in columns}
        known = [by_name.get(d.upper()) for d in declared]
        key, note = resolve_key(rows, columns, () if None in known else known, sample_rows=config.key_sample_rows,
                                total=distinct, non_null={c: s_facts.columns[c].values for c in columns})
        note = OUTSIDE if None in known else note
        if note:
            local.append(finding(DATA_CHECK, "KEY_NOTE", ",".join(declared), source_value=note))

        comparison = Comparison(s.frame, t.frame, columns, s_names, t_names, key.columns, s_facts, t_facts, formats)
        local += comparison.local_findings()
        for known, frame in (comparison.data_findings(config.max_error_records), comparison.duplicate_findings()):
            local += known
            if frame is not None:
                frames.append(frame)

        findings = findings_frame(spark, local)
        for f in frames:
            findings = findings.unionByName(f)
        findings, staged = _keep(findings)
    finally:
        for held in (s, t):
            held.release()
        if comparison is not None:
            comparison.release()
    rows = report(findings, *labels, checks=checks, execution_time=execution_time)
    return PairResult(
        findings, rows, KeyResult(tuple(s_names[c] for c in key.columns), key.origin),
        {s_names[c]: cls for c, cls in comparison.classes.items()}, staged,
    )


class Side:
    """Distinct rows of one side with copies and digest, from a single scan of the source.

    The rows are staged with their digests; the digest column alone is then
    grouped. Rows with a single digest stay as they were written; only the
    others are shuffled and grouped by all columns. Up to ``most`` repeated
    digests, of eight bytes each, are sent to every task; beyond that the staged
    rows are grouped as a whole.
    """

    def __init__(self, df: DataFrame, most: int):
        rows = Staged(with_row_digest(df), "rows")
        self.held = [rows]
        repeated = Staged(repeated_digests(rows.frame), "repeated")
        self.held.append(repeated)
        n = repeated.frame.count()
        if not n:
            self.frame = rows.frame.withColumn(COPIES, F.lit(1).cast("bigint"))
        elif n > most:
            whole = Staged(group_copies(rows.frame), "side")
            self.held.append(whole)
            self.frame = whole.frame
        else:
            single, several = split_copies(rows.frame, repeated.frame)
            several = Staged(several, "copies")
            self.held.append(several)
            self.frame = single.unionByName(several.frame)

    def release(self) -> None:
        for s in self.held:
            s.release()


def _count_finding(s: int, t: int):
    code = "COUNT" if s == t else "COUNT_MISMATCH"
    return finding(COUNT_CHECK, code, count=abs(s - t), source_value=str(s), target_value=str(t))


def _datatype_frame(spark, spec, source, target, pairs, mapping) -> DataFrame:
    comparison = datatype_comparison(
        _metadata(spark, spec.source, source, spec.source_system),
        _metadata(spark, spec.target, target, spec.target_system),
        pairs, spec.source_system, spec.target_system, mapping,
    )
    return datatype_findings(comparison).selectExpr(
        f"'{DATATYPE_CHECK}' as check", f"{by_code(0)} as severity", "code", "source_column", "target_column",
        "cast(null as bigint) as count", "cast(null as map<string,string>) as key",
        "source_type as source_value", "target_type as target_value", "ordinal as column_order", "0 as example",
    )


def _keep(findings: DataFrame):
    """The findings as a staged table, which no longer needs the sides.

    Findings are a few rows per column and the examples asked for, but one
    example may hold a whole text, so they never pass the driver.
    """
    staged = Staged(findings, "findings")
    if staged.lazy:
        staged.frame.count()
    return staged.frame, [staged]


# -- manifest -----------------------------------------------------------------


def read_manifest(manifest: DataFrame) -> list:
    """Rows of the pair list; identifiers are upper-cased, paths are not."""
    missing = [c for c in MANIFEST_COLUMNS if c not in manifest.columns]
    if missing:
        raise DatasetError("BAD_MANIFEST", f"manifest lacks {', '.join(missing)}")
    keep = [c for c in manifest.columns if c in MANIFEST_COLUMNS or c in MANIFEST_OPTIONS]
    out = [
        F.col(c) if c.endswith("FilePath") else F.upper(F.trim(F.col(c))).alias(c) for c in keep
    ]
    blank_is_absent = [F.when(F.trim(c) != "", c).alias(n) for c, n in zip(out, keep)]
    return [r.asDict() for r in manifest.select(*blank_is_absent).collect()]


def pair_spec(row: dict, config: RunConfig) -> PairSpec:
    key = tuple(split_names(row.get("SourceKey")) or ())

    def side(name, system, connection):
        path, table = row[f"{name}FilePath"], row[f"{name}Table"]
        if path:
            tokens = V.NULL_TOKENS if config.null_tokens is None else config.null_tokens
            return FileRef(path, null_tokens=tokens, splittable=config.csv_splittable, quarantine=config.csv_quarantine)
        if not table:
            raise DatasetError("BAD_MANIFEST", f"{name} names neither a table nor a file")
        db, schema = row[f"{name}DB"], row[f"{name}Schema"]
        if system in (SQLSERVER, SNOWFLAKE):
            return JdbcRef(jdbc.require_connection(connection, name), db, schema, table,
                           partition_column=row.get(f"{name}PartitionColumn"), key=key if name == "Source" else ())
        return TableRef(table, schema, db)

    return PairSpec(
        side("Source", config.source_type, config.source_connection),
        side("Target", config.target_type, config.target_connection),
        row["SourceColumns"], row["TargetColumns"],
        key,
        SPARK if config.source_type == FILE else config.source_type,
        SPARK if config.target_type == FILE else config.target_type,
    )


def run_manifest(spark: SparkSession, manifest: DataFrame, config: RunConfig | None = None,
                 mapping: DataFrame | None = None, execution_time: datetime | None = None,
                 on_report: Callable[[DataFrame], None] | None = None, ledger: Ledger | None = None,
                 on_commit: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """Validate every pair of the manifest and return the combined report.

    A few pairs are in work at once: the small jobs of one fill the gaps of
    another, and the cluster's scheduler shares the executors among them.
    The rows of a pair are written when the pair ends, whatever becomes of the
    others; ``on_report`` then gets them, one pair at a time. Any failure of a pair
    becomes its row.

    With a ``ledger`` a pair is committed when its rows are written as a whole, and a
    rerun of that run takes the committed pairs from there. ``on_commit`` gets the rows of
    a pair with a name of their own; it is called again in a rerun only if it did not come back before.
    """
    config = config or RunConfig()
    rows = read_manifest(manifest)
    if not rows:
        raise DatasetError("BAD_MANIFEST", "manifest has no pairs")
    held = ledger or Ledger(spark, scratch_path(spark, "reports"), "run")
    names, turn = [held.name(nr, row) for nr, row in enumerate(rows)], Lock()

    def validate(row) -> PairResult:
        labels = tuple(row[f"{side}Table"] or row[f"{side}FilePath"] or "" for side in ("Source", "Target"))
        try:
            spec = pair_spec(row, config)
            labels = tuple(_label(r, None) for r in (spec.source, spec.target))
            return run_pair(spark, spec, config, mapping, execution_time)
        except DatasetError as e:
            return _failed(spark, str(e), labels, execution_time)
        except Exception as e:  # a driver that is missing, a lost database: the other pairs still get their rows
            reason = (str(e).strip() or type(e).__name__).splitlines()[0]
            return _failed(spark, f"JOB_FAILED: {reason}", labels, execution_time)

    def finish(nr: int) -> None:
        name = names[nr]
        if not held.committed(name):
            result = validate(rows[nr])
            try:
                held.commit(name, result.report.coalesce(1).withColumn("place", F.monotonically_increasing_id()))
            finally:
                result.release()
            if on_report:
                with turn:
                    on_report(held.rows(name).orderBy("place").select(*REPORT_COLUMNS))
        if on_commit and not held.handed_over(name):
            with turn:
                on_commit(held.rows(name).orderBy("place").select(*REPORT_COLUMNS), f"{held.run}-{name}")
                held.hand_over(name)

    with ThreadPoolExecutor(max(1, config.concurrent_pairs)) as pool:
        list(pool.map(finish, range(len(rows))))
    paths = [held.folder.at(name) for name in names]
    nr = F.regexp_extract(F.col("_metadata.file_path"), r"/pair-(\d+)-[0-9a-f]{16}/[^/]*$", 1)
    return spark.read.parquet(*paths).withColumn("pair", nr).orderBy("pair", "place").select(*REPORT_COLUMNS)
