"""Secret scans through a trigram inverted index, DataFrame functions only.

From every rule's regex a Boolean query is derived: an OR of ANDs of trigrams
that any match must hold, over lower-cased text so that one index serves
rules of either case. The index lists, for each trigram that some query names,
the documents that hold it; posting lists are intersected where they meet, by document,
and the rules whose query holds are verified with their regex. A rule
without a mandatory trigram is matched against every text.

Positions: ``split`` by a regex gives what lies between the matches that
``regexp_extract_all`` returns, so lengths in code points add up to starts.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import ascii_lower, bound, running_sum, staged, text_of

EXACT_STRINGS = 64
CLASS_SIZE = 8

Query = frozenset  # of frozensets of trigrams: OR of ANDs
TRUE: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """``pattern`` means the same to Java and Python; ``group`` must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds. A maximal run is matched either way, so for access and hex the least
# length may stand in the pattern; for assign a match that fails still uses up its text.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)
# Published formats of keys that the base kinds do not name.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED


def _absorb(query: Query) -> Query:
    return frozenset(q for q in query if not any(other < q for other in query))


def _both(a: Query, b: Query) -> Query:
    return _absorb(frozenset(x | y for x in a for y in b))


def _trigrams(strings: frozenset[str]) -> Query:
    """What holds for a text with any of the strings in it."""
    return _absorb(frozenset(frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in (x.lower() for x in strings)))


def _item(code, value) -> tuple[frozenset[str] | None, Query]:
    """(all strings the item can match, if they are few; its query)."""
    if code == op.LITERAL:
        return frozenset([chr(value)]), TRUE
    if code == op.IN:
        chars: set[str] = set()
        for kind, x in value:
            if kind == op.LITERAL:
                chars.add(chr(x))
            elif kind == op.RANGE and x[1] - x[0] < CLASS_SIZE:
                chars |= {chr(c) for c in range(x[0], x[1] + 1)}
            else:
                return None, TRUE
        return (frozenset(chars), TRUE) if len(chars) <= CLASS_SIZE else (None, TRUE)
    if code == op.SUBPATTERN:
        return _sequence(value[3])
    if code == op.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        query = _absorb(frozenset().union(*[q for _, q in parts]))
        if all(e is not None for e, _ in parts):
            return frozenset().union(*[e for e, _ in parts]), query
        return None, query
    if code in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        exact, query = _sequence(inner)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, TRUE
        return None, query if least else TRUE
    if code in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return frozenset([""]), TRUE
    return None, TRUE


def _sequence(items) -> tuple[frozenset[str] | None, Query]:
    run, query, whole = frozenset([""]), TRUE, True
    for code, value in items:
        exact, own = _item(code, value)
        if exact is not None and len(run) * len(exact) <= EXACT_STRINGS:
            run = frozenset(a + b for a in run for b in exact)
            continue
        whole = False
        query = _both(_both(query, _trigrams(run)), own)
        run = exact if exact is not None else frozenset([""])
    query = _both(query, _trigrams(run))
    return (run if whole else None), query


def trigram_query(pattern: str) -> Query:
    """OR of ANDs of trigrams in the lower-cased text of any match; ``TRUE`` if the pattern forces none."""
    return _sequence(parser.parse(pattern))[1]


def _keys(id_col: str, text: Column) -> list[Column]:
    return [F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash")]


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: (trigram, id, hash of the text) for each of the given trigrams that a text holds."""
    text = text_of(text_col)
    lowered = docs.select(*_keys(id_col, text), ascii_lower(text).alias("text"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("text"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select(F.explode(held).alias("trigram"), "id", "hash")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(id, hash, rules): the rules whose query a document's postings satisfy, where there are any."""
    lists = index.groupBy("id", "hash").agg(F.collect_set("trigram").alias("held"))

    def holds(query: Query) -> Column:
        return reduce(Column.__or__, [reduce(Column.__and__, [F.array_contains("held", t) for t in sorted(q)]) for q in sorted(query, key=sorted)])

    rules = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind)) for kind, q in queries.items()]))
    return lists.select("id", "hash", rules.alias("rules")).filter(F.size("rules") > 0)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind, end>> of the rule's matches, left to right, none overlapping."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    told = F.struct(F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gaps"), F.transform(found, F.char_length).alias("sizes"), F.transform(held, F.char_length).alias("held"))

    def placed(z: Column) -> Column:
        ends = running_sum(F.zip_with(F.slice(z["gaps"], 1, F.size(z["sizes"])), z["sizes"], lambda g, n: g + n))
        rows = F.filter(F.arrays_zip(ends.alias("end"), z["sizes"].alias("size"), z["held"].alias("held")), lambda r: r["held"] >= rule.least)
        return F.transform(rows, lambda r: F.struct((r["end"] - r["size"]).alias("start"), F.lit(order).alias("kind"), r["end"].alias("end")))

    spans = bound(told, placed)
    return F.when(text.rlike(rule.pattern), spans).otherwise(empty)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_<kind> for each base kind, base_sha256, spans, found.

    ``found`` is an array of (start, kind, end) in code points, end exclusive, by start and then
    kind as listed; ``spans`` says the same as kind:start:end joined by commas,
    ``base_sha256`` is the SHA-256 of that for the base kinds. A null text is empty
    and has no span. Repeated rows come back as often as they are given, an
    empty table gives none; other columns are not read.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != TRUE}
    trigrams = sorted({t for q in indexed.values() for part in q for t in part})
    index = staged(postings(docs, trigrams, id_col, text_col), "trigrams")
    chosen = staged(candidates(index, indexed), "candidates").toDF("c_id", "c_hash", "rules")
    text = text_of(text_col)
    rows = docs.select(*_keys(id_col, text), text.alias("text"))
    rows = rows.join(chosen, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("hash") == F.col("c_hash")), "left")
    text, none = F.col("text"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    parts = []
    for order, rule in enumerate(rules):
        spans = _spans(text, rule, order)
        parts.append(F.when(F.array_contains("rules", rule.kind), spans).otherwise(none) if rule.kind in indexed else spans)
    names = F.array(*[F.lit(r.kind) for r in rules])
    base_kinds = [i for i, r in enumerate(rules) if r in base]

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    out = rows.select(F.col("id").alias("doc_id"), F.array_sort(F.concat(*parts)).alias("found"))
    counts = [number(i).alias(f"n_{rules[i].kind}") for i in base_kinds]
    own = F.filter("found", lambda s: s["kind"].isin(base_kinds))
    named = F.transform("found", lambda s: F.struct(s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end")))
    return out.select("doc_id", *counts, F.sha2(said(own), 256).alias("base_sha256"), said(F.col("found")).alias("spans"), named.alias("found"))
