"""Uniqueness of keys and discovery of the smallest key.

Discovery returns the first column set, by size and then by list order, that
is unique over the distinct rows.  A row sample only ever *rules out* sets:
two rows that agree on some columns prove that no key lies inside them.  Sets
that survive are tested on all rows, in order, until one passes, so the answer
is exact whatever the sample holds.

A test on all rows shuffles hashes of the candidate alone, first those of a small
part of its hashes: rows that agree are in the same part, so most candidates that
repeat anything are out before all of their hashes are shuffled.
"""

from __future__ import annotations

from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.operators.clean import (
    COPIES, DIGEST, clean, drop_empty_rows, repeated_digests, split_copies, with_missing_as_null,
)
from twinledger.operators.removal import agreement, has_repeats, key_by_removal, mask_of
from twinledger.plans.covers import Exhausted, minimal, open_candidates, to_mask
from twinledger.session import Staged, free_shuffles


# pairs of rows that refute a candidate come from so many parts of its groups, two from each
PAIR_GROUPS = 8
# rows of the sample that are compared with each other at the start of a search
COMPARED_ROWS = 512
# parts of the hashes of a candidate, by their lowest bits
PARTS = 256
# all rows are tested in these steps: up to which part, and how many candidates one pass takes at most, so
# that none shuffles more hashes than there are rows; a step takes more of them after each that fails
TESTED = ((1, 16), (16, 8), (PARTS, 1))
# so many repeated row digests, of eight bytes each, are sent to every task
REPEATED = 1_000_000
# with more of them, rows are made distinct in so many parts, one after the other
CLEANED = 8
# agreements of compared rows that are kept, those with most columns first
LARGEST = 4096
# short keys are enumerated in so many rounds, of so many steps each, before long ones are sought by removal
ROUNDS = 40
STEPS = 5_000
OUTSIDE = "declared key is outside the compared columns"


@dataclass(frozen=True)
class KeyResult:
    columns: tuple
    origin: str  # declared, discovered, discovered_ignoring_nulls, none
    rows: int = 0  # distinct rows it was looked for on


def key_statistics(df: DataFrame, key) -> DataFrame:
    """(row_count, distinct_keys, repeated_keys, null_keys) in one grouping by
    the key; only key columns are read and shuffled."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.count_if(null_key).alias("null_keys"),
    )


def key_is_unique(df: DataFrame, key) -> DataFrame:
    stats = key_statistics(df, key)
    return stats.withColumn("is_unique", F.col("repeated_keys") == 0)


def declared_key_check(df: DataFrame, key, distinct: bool = False) -> DataFrame:
    """Proof of a declared key over the distinct rows: status 1 proven, 2
    violated, with the number of rows and keys.

    Null-bearing tuples do not count against a key.  Unless the rows are known
    to be ``distinct``, copies of a row are told from violations, but only
    rows whose key occurs more than once are compared as a whole: a key that
    holds costs one shuffle of its own columns.
    """
    per_key = df.select(*key).dropna(how="any").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    if distinct:
        counted = per_key
    else:
        repeated = per_key.where("n > 1").select(*key)
        versions = df.join(repeated, list(key), "left_semi").dropDuplicates()
        counted = per_key.where("n = 1").unionByName(versions.groupBy(*key).agg(F.count(F.lit(1)).alias("n")))
    return counted.selectExpr(
        "cast(if(count_if(n > 1) = 0, 1, 2) as int) as status",
        "coalesce(sum(n), 0L) as keyed_rows",
        "count(*) as distinct_keys",
    )


def _long_hash(mask: int, names) -> str:
    """Hash of a candidate's columns, null where one of them is."""
    cols = [V.quoted(n) for n in _names_in(mask, names)]
    return f"case when {' and '.join(f'{c} is not null' for c in cols)} then xxhash64({', '.join(cols)}) end"


def _evidence(rows: DataFrame, names, candidates):
    """Agreements of row pairs that repeat a candidate, and the candidates
    that no group repeats.

    Per candidate the rows are grouped by 96 bits of hash of its columns, which
    spares the shuffle long texts; of the groups with several rows a bounded number of pairs
    of row digests per candidate comes back.  The pairs are then compared on the real
    values, so a hash collision can delay a decision but not falsify it.
    Returns (agreement masks, candidates without any repeated group).
    """
    tuples = []
    for i, mask in enumerate(candidates):
        listed = ", ".join(V.quoted(n) for n in _names_in(mask, names))
        tuples.append(f"struct({i} as cand, {_long_hash(mask, names)} as long_hash, hash({listed}) as short_hash)")
    groups = (
        rows.selectExpr(DIGEST, f"inline(array({', '.join(tuples)}))")
        .where("long_hash is not null")
        .groupBy("cand", "long_hash", "short_hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min(DIGEST).alias("lo"), F.max(DIGEST).alias("hi"))
        .where("n > 1")
    )
    picked = groups.groupBy("cand", F.expr(f"pmod(short_hash, {PAIR_GROUPS})").alias("part")).agg(
        F.min("lo").alias("lo1"), F.min_by("hi", "lo").alias("hi1"),
        F.max("lo").alias("lo2"), F.max_by("hi", "lo").alias("hi2"),
    ).collect()  # at most so many rows per candidate
    repeated = {r["cand"] for r in picked}
    free = [m for i, m in enumerate(candidates) if i not in repeated]
    pairs = {(r[f"lo{k}"], r[f"hi{k}"]) for r in picked for k in (1, 2) if r[f"lo{k}"] != r[f"hi{k}"]}
    if not pairs:
        return set(), free

    digests = sorted({d for p in pairs for d in p})
    hit = rows.where(F.col(DIGEST).isin(digests)).selectExpr(DIGEST, f"struct({', '.join(V.quoted(n) for n in names)}) as r")
    pair_rows = rows.sparkSession.createDataFrame(sorted(pairs), "lo bigint, hi bigint")
    left = hit.select(F.col(DIGEST).alias("lo"), F.col("r").alias("a"))
    right = hit.select(F.col(DIGEST).alias("hi"), F.col("r").alias("b"))
    masks = (
        pair_rows.join(left, "lo").join(right, "hi")
        .selectExpr(agreement(names, "a", "b") + " as mask").distinct().collect()
    )
    return {mask_of(m["mask"]) for m in masks}, free


def _names_in(mask: int, names):
    return [n for j, n in enumerate(names) if mask >> j & 1]


def _filled(rows: DataFrame, cols) -> DataFrame:
    """The given columns of the rows that have a value in all of them."""
    return rows.select(*[V.quoted(c) for c in cols]).where(" and ".join(f"{V.quoted(c)} is not null" for c in cols))


def _covered(mask: int, agreements) -> bool:
    return any(mask & a == mask for a in agreements)


def _settle(rows: DataFrame, names, candidates, agreements: set) -> set:
    """The candidates that are unique on ``rows``; what refutes the others is
    added to ``agreements``."""
    masks, free = _evidence(rows, names, candidates)
    agreements |= masks
    unique = set(free)
    for m in candidates:
        if m in unique or _covered(m, agreements):
            continue
        cols = _names_in(m, names)  # only hash collisions were seen: group by the values
        if has_repeats(_filled(rows, cols), [V.quoted(c) for c in cols]):
            agreements.add(m)
        else:
            unique.add(m)
    return unique


def _unique_in(rows: DataFrame, names, candidates, agreements: set, first: int, upto: int) -> set:
    """The candidates that repeat nothing in the parts of their hashes from ``first`` to before ``upto``;
    what refutes the others is added to ``agreements``.

    The hashes of these parts are all that is shuffled. Rows are read again only for hashes that occur
    more than once, for a bounded number of them, and there values decide.
    """
    tuples = [f"struct({i} as cand, {_long_hash(m, names)} as h)" for i, m in enumerate(candidates)]
    repeated = (
        rows.selectExpr(f"inline(array({', '.join(tuples)}))")
        .where(f"h is not null and h & {PARTS - 1} between {first} and {upto - 1}")
        .groupBy("cand", "h").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("cand", F.expr(f"pmod(hash(h), {PAIR_GROUPS})").alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        .collect()  # at most so many rows per candidate
    )
    looked_up, several = {}, {}
    for r in repeated:
        mask = candidates[r["cand"]]
        looked_up.setdefault(mask, set()).update((r["lo"], r["hi"]))
        several[mask] = several.get(mask, 0) + r["n"]
    unique = {m for m in candidates if m not in several}
    if several:
        found = [F.coalesce(F.expr(_long_hash(m, names)).isin(sorted(hashes)), F.lit(False)) for m, hashes in looked_up.items()]
        some = rows.where(reduce(lambda a, b: a | b, found))
        for m in _settle(some, names, list(several), agreements):  # only hashes were equal
            cols = _names_in(m, names)
            if several[m] > len(looked_up[m]) and has_repeats(_filled(rows, cols), [V.quoted(c) for c in cols]):
                agreements.add(m)
            else:
                unique.add(m)
    return unique


class _AllRows:
    """Tests of candidates on all rows, which remember how far each of them came."""

    def __init__(self, rows: DataFrame, names, agreements: set):
        self.rows, self.names, self.agreements = rows, names, agreements
        self.upto = {}  # candidate -> part before which it repeats nothing
        self.together = [most if not step else 1 for step, (_, most) in enumerate(TESTED)]

    def unique(self, first: int, others=()) -> bool:
        """Is ``first`` unique? What refutes it is added to the agreements.

        The others are tested with it as far as that costs little, those that came as far as it did.
        """
        done = 0
        for step, (upto, most) in enumerate(TESTED):
            if _covered(first, self.agreements):
                return False
            if self.upto.get(first, 0) < upto:
                tested = [first, *(m for m in others if m != first and self.upto.get(m, 0) == done)]
                tested = [m for m in tested if not _covered(m, self.agreements)][:self.together[step]]
                free_shuffles(self.rows.sparkSession)  # of the test before, or of what made the rows
                kept = _unique_in(self.rows, self.names, tested, self.agreements, done, upto)
                self.upto.update((m, upto) for m in kept)
                if first not in kept:
                    self.together[step] = min(2 * self.together[step], most)
                    return False
            done = upto
        return True


def _compared(sample: DataFrame, names) -> set:
    """Agreements of every two among a bounded number of rows of the sample, the largest of them.

    The rows reach the driver as one hash a column; rows that agree in all hashes
    are the same row or a collision and say nothing.
    """
    codes = [f"if({V.quoted(c)} is null, null, xxhash64({V.quoted(c)}))" for c in names]
    rows = sample.orderBy(DIGEST).limit(COMPARED_ROWS).selectExpr(f"array({', '.join(codes)}) as codes").collect()
    best = {}
    for i, a in enumerate(rows):
        for b in rows[:i]:
            mask = 0
            for j, (x, y) in enumerate(zip(a.codes, b.codes)):
                if x is not None and x == y:
                    mask |= 1 << j
            best[mask] = None
    full = to_mask(range(len(names)))
    needed = sorted((full & ~m for m in best if m != full), key=int.bit_count)[:LARGEST]
    return {full & ~d for d in minimal(needed)}


def _search(rows, sample, names, allowed, agreements, batch, require_rows, rounds, all_rows):
    """First key among the allowed columns, or None.  ``sample`` is ``rows``
    itself when that is small; else ``all_rows`` tests what the sample leaves.

    Short keys are enumerated from below.  Where that takes too long, columns without
    nulls are searched from above; if that has too many candidates, on from below.
    """
    steps, tried = None if require_rows else STEPS, 0
    excluded, passed = [], set()  # passed: the sample repeats nothing inside these
    for size in range(1, len(allowed) + 1):
        while True:
            tried += 1
            try:
                if steps is not None and tried > rounds:
                    raise Exhausted
                todo = open_candidates(allowed, agreements, size, batch, excluded, steps)
            except Exhausted:
                steps = None
                found = key_by_removal(rows, names, allowed, agreements)
                if found is not None:
                    return tuple(_names_in(found, names))
                continue
            if not todo:
                break
            fresh = [m for m in todo if m not in passed]
            if fresh:
                passed |= _settle(sample, names, fresh, agreements)
            first = todo[0]
            if first not in passed:
                continue
            if sample is not rows and not all_rows.unique(first, [m for m in todo if m in passed]):
                continue
            cols = _names_in(first, names)
            if require_rows and _filled(rows, cols).isEmpty():
                excluded.append(first)
                continue
            return tuple(cols)
    return None


def discover_key(rows: DataFrame, columns, non_null=None, total=None,
                 sample_rows: int = 50_000, batch: int = 64, rounds: int = ROUNDS) -> KeyResult:
    """Smallest key of distinct rows that carry ``__digest``.

    Pass 1 takes columns without nulls; pass 2 all columns, ignoring rows with
    a null in the set, of which at least one must be complete.  ``non_null``
    (column -> number of values) and ``total`` spare a scan when known.  After
    ``rounds`` rounds of short sets pass 1 looks for long ones by removal, with 0 at once.
    """
    names = [c for c in columns]
    types = {f.name: f.dataType for f in rows.schema.fields}
    if non_null is None:
        row = rows.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(V.quoted(c))).alias(c) for c in names]).first()
        total, non_null = row["__rows"], {c: row[c] for c in names}
    if not total:
        return KeyResult((), "none", 0)

    # a table of a few samples' size is its own sample
    whole = total <= 4 * sample_rows
    picked = rows if whole else rows.sample(False, min(1.0, sample_rows / total), seed=17)
    # long values are replaced by a digest of their whole content
    slim = [
        f"sha2({V.as_text(V.quoted(c), types[c])}, 256) as {V.quoted(c)}"
        if isinstance(types[c], V.TEXTUAL + V.NESTED)
        else V.quoted(c)
        for c in names
    ]
    sample = None if whole else Staged(picked.selectExpr(DIGEST, *slim), "key-sample")
    tested = rows if whole else sample.frame
    agreements = _compared(tested, names)
    all_rows = _AllRows(rows, names, agreements)
    try:
        complete = [i for i, c in enumerate(names) if non_null[c] == total]
        found, everything = None, to_mask(complete)
        # no subset can be unique when all complete columns together are not;
        # all columns are, because the rows are distinct
        if complete and (len(complete) == len(names) or _settle(tested, names, [everything], agreements)
                         and (whole or all_rows.unique(everything))):
            found = _search(rows, tested, names, complete, agreements, batch, False, rounds, all_rows)
        if found:
            return KeyResult(found, "discovered", total)
        some = [i for i, c in enumerate(names) if non_null[c] > 0]
        found = _search(rows, tested, names, some, agreements, batch, True, rounds, all_rows)
        if found:
            return KeyResult(found, "discovered_ignoring_nulls", total)
    finally:
        if sample is not None:
            sample.release()
    return KeyResult((), "none", total)


def with_digest(distinct: DataFrame) -> DataFrame:
    """Distinct rows as ``discover_key`` takes them."""
    keep = [c for c in distinct.columns if c not in (COPIES, DIGEST)]
    keep = [V.quoted(c) for c in keep]
    return distinct.select(*keep, F.xxhash64(*keep).alias(DIGEST))


@contextmanager
def staged_distinct(df: DataFrame, most: int = REPEATED):
    """``with_digest(clean(df))``, staged in one scan of ``df``.

    The rows are staged as they are read and only their digests are grouped. Rows with a single digest
    stay where they were written, the others are grouped by all columns; with more than ``most``
    repeated digests the staged rows are cleaned whole, a part of the digests at a time, so that not all
    of them are shuffled at once. The digest is not staged, it would not compress.
    """
    spark = df.sparkSession
    with ExitStack() as held:
        def stage(frame, name):
            staged = Staged(frame, name)
            held.callback(staged.release)
            return staged

        read = stage(drop_empty_rows(with_missing_as_null(df)), "rows")
        rows = with_digest(read.frame)
        repeated = stage(repeated_digests(rows), "repeated").frame
        n = repeated.count()
        if n > most:
            parts = []
            for i in range(CLEANED):
                part = rows.where(f"pmod({DIGEST}, {CLEANED}) = {i}").drop(DIGEST)
                parts.append(stage(clean(part), "distinct").frame)
                parts[-1].count()  # computes it where no folder is shared
                free_shuffles(spark)
            rows = with_digest(reduce(DataFrame.unionByName, parts))
            if not read.lazy:
                read.release()
        elif n:
            single, several = split_copies(rows, repeated)
            rows = single.unionByName(stage(several, "copies").frame).drop(COPIES)
        yield rows


def find_key(df: DataFrame, columns=None, **kwargs) -> KeyResult:
    """``discover_key`` for a frame as it was read: its distinct rows are
    staged once for all the jobs of the search."""
    with staged_distinct(df) as rows:
        return discover_key(rows, columns or df.columns, **kwargs)


def resolve_key(rows: DataFrame, columns, declared=(), **kwargs):
    """Key of the source: the declared one when it lies in the compared
    columns and is proven, else a discovered one.  Returns (KeyResult, note)."""
    declared = list(declared or ())
    by_upper = {c.upper(): c for c in columns}
    note = None
    if declared:
        if any(d.upper() not in by_upper for d in declared):
            note = OUTSIDE
        else:
            key = [by_upper[d.upper()] for d in declared]
            status = declared_key_check(rows, key, distinct=True).first()
            if status["status"] == 1 and status["keyed_rows"]:
                return KeyResult(tuple(key), "declared"), None
            if status["status"] == 1 and not rows.head(1):
                return KeyResult(tuple(key), "declared"), "no rows: the declared key is not proven"
            note = "declared key is not unique" if status["status"] == 2 else "no row has the declared key filled"
    return discover_key(rows, columns, **kwargs), note
