"""Which column of the source is compared with which column of the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.functions.values import is_comparable
from twinledger.model import ColumnPair, DatasetError


def split_names(text) -> list:
    """Names of a comma-separated list, trimmed and upper-cased; None if absent."""
    if text is None:
        return None
    parts = text.split(",") if isinstance(text, str) else list(text)
    return [p.strip().upper() for p in parts]


def pair_columns(source_columns, target_columns, source_header, target_header,
                 source_is_file=False, target_is_file=False) -> list:
    """Pairs by position.

    One list given: it serves both sides.  Lists of unequal length: the tail
    of the longer one completes the shorter.  No list: the header of the only
    file, or else the sorted headers, which then must be the same set.
    """
    src, tgt = split_names(source_columns), split_names(target_columns)
    if src is None and tgt is None:
        if source_is_file and not target_is_file:
            src = split_names(source_header)
        elif target_is_file and not source_is_file:
            tgt = split_names(target_header)
        else:
            src, tgt = sorted(split_names(source_header)), sorted(split_names(target_header))
            if src != tgt:
                raise DatasetError("COLUMNS_DIFFER", "the sides do not have the same columns")
    src = tgt if src is None else src
    tgt = src if tgt is None else tgt
    longer, n = (src, len(tgt)) if len(src) > len(tgt) else (tgt, len(src))
    tail = longer[n:]
    src, tgt = (src, tgt + tail) if len(src) > len(tgt) else (src + tail, tgt)
    require_columns("source", src, source_header)
    require_columns("target", tgt, target_header)
    return [ColumnPair(a, b) for a, b in zip(src, tgt)]


def require_columns(side: str, wanted, header) -> None:
    known = set(split_names(header))
    missing = [c for c in wanted if c not in known]
    if missing:
        raise DatasetError("COLUMNS_MISSING", f"{side} has no column {', '.join(missing)}")
    twice = sorted({c for c in wanted if wanted.count(c) > 1})
    if twice:
        raise DatasetError("DUPLICATE_COLUMN", f"{side} lists {', '.join(twice)} twice")


def align(src: DataFrame, tgt: DataFrame, pairs, names=None):
    """Both sides projected to the compared columns under common names, those
    of the source unless others are given.  Maps become their sorted entries, so
    that they group, join and compare like any nested value."""
    names = names or [p.source for p in pairs]

    def projected(df: DataFrame, own) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        # a name of another case may be meant: only the column itself tells its type then
        typed = [(c, types[c] if c in types else df.select(F.col(V.quoted(c))).schema[0].dataType) for c in own]
        return df.selectExpr(*[f"{V.without_maps(V.quoted(c), t)} as {V.quoted(n)}" for (c, t), n in zip(typed, names)])

    return projected(src, [p.source for p in pairs]), projected(tgt, [p.target for p in pairs])


def split_supported(src: DataFrame, tgt: DataFrame):
    """(comparable column names, names that are not on either side)."""
    a = {f.name: f.dataType for f in src.schema.fields}
    b = {f.name: f.dataType for f in tgt.schema.fields}
    bad = [c for c in src.columns if not (is_comparable(a[c]) and is_comparable(b[c]))]
    return [c for c in src.columns if c not in bad], bad


def translate_key(key, pairs) -> list:
    """Target names of source key columns."""
    by_source = {p.source: p.target for p in pairs}
    return [by_source[k] for k in key]
