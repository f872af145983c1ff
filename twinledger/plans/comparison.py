"""Data and duplicate findings of one pair of sides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V
from twinledger.model import DATA_CHECK, DUPLICATE_CHECK, FINDING_CODES, FINDINGS_SCHEMA, finding
from twinledger.operators import classes as C
from twinledger.operators import duplicates as D
from twinledger.operators import reconcile as R
from twinledger.operators.clean import COPIES, DIGEST
from twinledger.session import Staged

WHOLE_ROW = "__row"


def _null_in(key) -> str:
    return "(" + " or ".join(f"{V.quoted(k)} is null" for k in key) + ")"


def _null_safe(left: DataFrame, right: DataFrame, pairs):
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def collapse(df: DataFrame, columns) -> DataFrame:
    """Rows that became equal by normalising, merged; surplus copies add up."""
    return df.groupBy(*columns).agg((F.sum(F.col(COPIES) - 1) + 1).alias(COPIES))


def match_whole_rows(src: DataFrame, tgt: DataFrame, key, columns, scope: str):
    """Add ``__row`` to both sides, to be matched beside the key.

    It is null except for rows inside ``scope`` whose key repeats: null-bearing
    keys on either side, other keys on the source.  Such rows would match each
    other many to many; with the whole row as part of the key they match as a
    set of rows instead, and no source row shares its match key with another.
    """
    def tuples(df, where):
        return R.repeated_keys(df.where(where).select(*key), key).select(*key)

    repeated = tuples(src, scope).unionByName(tuples(tgt, f"{scope} and {_null_in(key)}")).dropDuplicates()
    repeated = repeated.select(*[F.col(k).alias(f"__rep_{i}") for i, k in enumerate(key)], F.lit(True).alias("__hot"))
    row = F.struct(*[F.col(c) for c in columns])

    def mark(df):
        inside = df.where(scope)
        keys = [(k, f"__rep_{i}") for i, k in enumerate(key)]
        marked = inside.join(repeated, _null_safe(inside, repeated, keys), "left")
        marked = marked.withColumn(WHOLE_ROW, F.when(F.col("__hot"), row)).select(*df.columns, WHOLE_ROW)
        outside = df.where(f"not ({scope})").withColumn(WHOLE_ROW, F.when(F.lit(False), row))
        return outside.unionByName(marked)

    return mark(src), mark(tgt)


def keeps_distinct(dtype: T.DataType, cls) -> bool:
    """Normalising cannot make two different values of the type equal."""
    if cls.kind == "numeric":
        if isinstance(dtype, V.TEXTUAL):
            return False
        return cls.number != "double" or isinstance(dtype, V.FLOATING + (T.ByteType, T.ShortType, T.IntegerType))
    if cls.kind == "date":
        return isinstance(dtype, V.TEMPORAL)
    if cls.kind == "string":
        return isinstance(dtype, V.TEXTUAL)
    return cls.kind == "nested"


class Comparison:
    """Normalised sides of one pair, ready for the data and duplicate checks.

    ``src`` and ``tgt`` are distinct rows with copies under common column
    names; ``source_names`` and ``target_names`` give the names to report.
    """

    def __init__(self, src, tgt, columns, source_names, target_names, key, src_facts, tgt_facts, formats=V.DATE_FORMATS):
        self.columns, self.key = list(columns), list(key)
        self.source_names, self.target_names = source_names, target_names
        self.src_facts, self.tgt_facts = src_facts, tgt_facts
        self.classes = C.infer_classes(src.schema, tgt.schema, src_facts, tgt_facts, key, formats)
        self.held = []
        types = {f.name: f.dataType for f in src.schema.fields}
        self._src = C.normalize(src.drop(DIGEST), self.classes, "source").dropna("all", subset=self.columns)
        self._tgt = C.normalize(tgt.drop(DIGEST), self.classes, "target").dropna("all", subset=self.columns)
        self.match_key = list(self.key)
        self.target_unique = False
        if not self.key:
            # only a source without rows has no key
            self._src, self._tgt = (collapse(df, self.columns) for df in (self._src, self._tgt))
            self.match_key, self.target_unique = self.columns, True
            return
        # the key was found on raw values: may its normalised values repeat?
        exact = all(keeps_distinct(types[k], self.classes[k]) for k in self.key)
        if not exact and self._repeats(self._src):
            self._src, self._tgt = (collapse(df, self.columns) for df in (self._src, self._tgt))
            self._match_whole_rows("true")
        elif self._null_in_key():
            self._match_whole_rows(_null_in(self.key))
        self.target_unique = not self._repeats(self._tgt)

    def _match_whole_rows(self, scope: str) -> None:
        self._src, self._tgt = match_whole_rows(self._src, self._tgt, self.key, self.columns, scope)
        self.match_key = [*self.key, WHOLE_ROW]

    def _null_in_key(self) -> bool:
        for facts in (self.src_facts, self.tgt_facts):
            rows = facts.rows - facts.surplus_rows - (1 if facts.empty_rows else 0)
            if any(facts.columns[k].values < rows for k in self.key):
                return True
        return False

    def _repeats(self, df: DataFrame) -> bool:
        """Does a match key repeat?  Only key columns are shuffled."""
        return not R.repeated_keys(df.select(*self.match_key), self.match_key).isEmpty()

    # -- data ---------------------------------------------------------------

    def local_findings(self):
        """Findings that follow from the collected counts alone."""
        out = []
        s, t = self.src_facts, self.tgt_facts
        if t.empty_rows > s.empty_rows:
            out.append(finding(DATA_CHECK, "EXTRA_EMPTY_RECORDS", count=t.empty_rows - s.empty_rows))
        if t.empty_rows < s.empty_rows:
            out.append(finding(DATA_CHECK, "MISSING_EMPTY_RECORDS", count=s.empty_rows - t.empty_rows))
        for i, c in enumerate(self.columns):
            if s.columns[c].ambiguous or t.columns[c].ambiguous:
                out.append(finding(DATA_CHECK, "DATE_AMBIGUOUS", self.source_names[c], self.target_names[c], column_order=i))
            if c not in self.key and s.columns[c].values and not t.columns[c].values:
                out.append(finding(DATA_CHECK, "NULL_POPULATED", self.source_names[c], self.target_names[c],
                                   column_order=i))
        if self.key and not self.target_unique:
            out.append(finding(DATA_CHECK, "TARGET_KEY_NOT_UNIQUE",
                               ",".join(self.source_names[k] for k in self.key),
                               ",".join(self.target_names[k] for k in self.key)))
        return out

    def data_findings(self, limit: int):
        """(findings known from counts, frame of examples or None)."""
        if not self.key:
            return self._keyless_findings(), None
        payload = [c for c in self.columns if c not in self.key]
        joined = R.reconcile(self._src.drop(COPIES), self._tgt.drop(COPIES), self.match_key, self.target_unique)
        if payload and limit:
            # the rows that differ are kept for the readers below, unmatched
            # rows without their values
            matched = R.IN_SOURCE + " and " + R.IN_TARGET
            kept = Staged(R.differences(joined, payload).selectExpr(
                *self.key, R.IN_SOURCE, R.IN_TARGET,
                *[f"case when {matched} then {p}__{c} end as {p}__{c}" for c in payload for p in ("source", "target")],
            ), "differences")
            self.held.append(kept)
            joined = kept.frame
        counts = joined.selectExpr(
            "count_if(not in_target) as only_source",
            "count_if(not in_source) as only_target",
            *[f"count_if({R.differs(c)}) as n{i}" for i, c in enumerate(payload)],
        ).first()
        known = self._extras(counts["only_source"], counts["only_target"])
        differing = {c: counts[f"n{i}"] for i, c in enumerate(payload) if counts[f"n{i}"]}
        known += [
            finding(DATA_CHECK, "MISMATCH_COUNT", self.source_names[c], self.target_names[c], n,
                    column_order=self.columns.index(c))
            for c, n in differing.items()
        ]
        if not (differing and limit):
            return known, None
        samples = R.mismatch_samples(joined, self.key, payload, limit, differing, sum(differing.values()))
        of_column = lambda texts: f"element_at(array({', '.join(texts)}), ordinal + 1)"
        return known, samples.withColumn("key", R.key_map(samples, self.key, self.source_names)).selectExpr(
            f"'{DATA_CHECK}' as check",
            f"'{FINDING_CODES['VALUE_MISMATCH'][0]}' as severity",
            "'VALUE_MISMATCH' as code",
            of_column(V.text_literal(self.source_names[c]) for c in payload) + " as source_column",
            of_column(V.text_literal(self.target_names[c]) for c in payload) + " as target_column",
            "cast(null as bigint) as count",
            "key",
            "source_value",
            "target_value",
            of_column(str(self.columns.index(c)) for c in payload) + " as column_order",
            "example",
        )

    def _extras(self, only_source: int, only_target: int):
        both = (("EXTRA_IN_SOURCE", only_source), ("EXTRA_IN_TARGET", only_target))
        return [finding(DATA_CHECK, code, count=n) for code, n in both if n]

    def _keyless_findings(self):
        diff = R.multiset_difference(self._src.select(*self.columns), self._tgt.select(*self.columns))
        counts = diff.selectExpr("coalesce(sum(surplus_in_source), 0L)", "coalesce(sum(surplus_in_target), 0L)").first()
        return self._extras(*counts)

    # -- duplicates ---------------------------------------------------------

    def duplicate_findings(self):
        """(findings known from totals, frame of classified groups or None)."""
        s, t = self.src_facts.surplus_rows, self.tgt_facts.surplus_rows
        if not s and not t:
            return [], None
        if not s:
            return [finding(DUPLICATE_CHECK, "EXTRA_DUPLICATES", count=t)], None
        if not t:
            return [finding(DUPLICATE_CHECK, "DUPLICATES_NOT_LOADED", count=s)], None
        groups = D.duplicate_groups(D.surplus_of_copies(self._src), D.surplus_of_copies(self._tgt),
                                    self.match_key, self.target_unique)
        counted = D.duplicate_classes(groups).select("code", F.col("groups").alias("count"))
        return [], _as_findings(counted, DUPLICATE_CHECK)

    def release(self) -> None:
        for staged in self.held:
            staged.release()


def by_code(position: int) -> str:
    """Property of the finding code in column ``code``."""
    pairs = ", ".join(f"'{code}', {spec[position]!r}" for code, spec in FINDING_CODES.items())
    return f"element_at(map({pairs}), code)"


def _as_findings(df: DataFrame, check: str) -> DataFrame:
    """Complete a frame of codes and counts to the findings schema."""
    known = {"check": f"'{check}'", "severity": by_code(0), "column_order": "0", "example": "0"}
    return df.selectExpr(*[
        f.name if f.name in df.columns
        else f"{known.get(f.name) or f'cast(null as {f.dataType.simpleString()})'} as {f.name}"
        for f in FINDINGS_SCHEMA.fields
    ])
