"""Smallest key of many columns, found from the columns that can be left out.

Columns can be left out if the other columns are still unique.  Every part of
such a set can be left out too, so the sets are found size by size: a set is a
candidate when all its parts of one column less can be left out.

All candidates of a size are tested together on position lists.  The columns
are dealt into blocks; for each union of blocks that holds candidates, the
rows are grouped by the columns outside the union, and only rows in groups of
several go on.  They are then grouped by the remaining columns of each
candidate in the union.
"""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.operators.clean import DIGEST
from twinledger.plans.covers import positions, to_mask
from twinledger.session import Staged

#: Candidates of one size beyond which the search is left to the other direction.
MOST = 50_000
#: Blocks of columns beyond the size of a candidate.
MORE_BLOCKS = 5


def has_repeats(df: DataFrame, key) -> bool:
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return not repeated.isEmpty()


def agreement(names, left: str, right: str):
    """Bit mask of the columns that two rows share, as text of 0 and 1."""
    bits = [f"if(coalesce({left}.{V.quoted(c)} = {right}.{V.quoted(c)}, false), '1', '0')" for c in names]
    return f"concat({', '.join(bits)})"


def mask_of(bits: str) -> int:
    return to_mask(i for i, bit in enumerate(bits) if bit == "1")


def grown(free, allowed) -> list:
    """Sets of one column more, all of whose parts of one column less are free."""
    known, out = set(free), []
    for f in known:
        for c in allowed:
            mask = f | 1 << c
            if 1 << c > f and all(mask & ~(1 << p) in known for p in positions(mask)):
                out.append(mask)
    return out


def unions(candidates):
    """The blocks of columns, and the candidates by the blocks that they touch."""
    columns = positions(to_mask(set(chain.from_iterable(positions(c) for c in candidates))))
    number = min(len(columns), candidates[0].bit_count() + MORE_BLOCKS)
    blocks = [columns[b::number] for b in range(number)]
    masks = [to_mask(b) for b in blocks]
    touched = {}
    for c in candidates:
        touched.setdefault(tuple(i for i, b in enumerate(masks) if b & c), []).append(c)
    return blocks, touched


def xor(terms) -> str:
    return " ^ ".join(["0L", *terms])


def repeated_without(codes: DataFrame, full: int, candidates) -> dict:
    """Candidate -> digests of two rows that agree in all other columns, by hash.

    ``codes`` has the digest and one hash a column; the hash of several columns is their exclusive or,
    so leaving columns out takes one step for each. The lists of unions and candidates are
    literals or broadcast; there are at most ``MOST``.
    """
    spark, size = codes.sparkSession, candidates[0].bit_count()
    blocks, touched = unions(candidates)
    number = {c: i for i, c in enumerate(candidates)}
    lists = [{"u": u, "t": [*held, *[len(blocks)] * (size - len(held))]} for u, held in enumerate(touched)]
    dealt = F.from_json(F.lit(json.dumps(lists)), "array<struct<u int, t array<int>>>")
    inside = spark.createDataFrame([(u, number[c], positions(c)) for u, held in enumerate(touched.values()) for c in held],
                                   "u int, cand int, p array<int>")
    sums = [xor(f"codes[{p}]" for p in block) for block in blocks]
    total = xor(f"codes[{p}]" for p in positions(full))
    listed = (
        codes.selectExpr(DIGEST, f"{total} as total", f"array({', '.join(sums)}, 0L) as sums")
        .select(DIGEST, "total", "sums", F.inline(dealt))
        .selectExpr("u", xor(["total", *[f"sums[t[{i}]]" for i in range(size)]]) + " as h", DIGEST)
    )
    several = listed.groupBy("u", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u", "h")
    stripped = listed.join(several, ["u", "h"], "left_semi").join(codes.selectExpr(DIGEST, "codes", f"{total} as total"), DIGEST)
    groups = (
        stripped.join(F.broadcast(inside), "u")
        .selectExpr("cand", "h", xor(["total", *[f"codes[p[{i}]]" for i in range(size)]]) + " as rest", DIGEST)
        .groupBy("cand", "h", "rest").agg(F.count(F.lit(1)).alias("n"), F.min(DIGEST).alias("lo"), F.max(DIGEST).alias("hi"))
        .where("n > 1")
    )
    pairs = groups.groupBy("cand").agg(F.min(F.struct("lo", "hi")).alias("pair")).collect()  # one row a candidate
    return {candidates[r["cand"]]: (r["pair"]["lo"], r["pair"]["hi"]) for r in pairs}


def shared(rows: DataFrame, names, pairs) -> dict:
    """(lo, hi) -> columns in which the two rows really agree; the pairs are bounded by the candidates."""
    wanted = rows.sparkSession.createDataFrame(sorted(set(pairs)), "lo bigint, hi bigint")
    digests = wanted.select(F.explode(F.array("lo", "hi")).alias(DIGEST)).distinct()
    hit = rows.join(F.broadcast(digests), DIGEST, "left_semi").selectExpr(DIGEST, f"struct({', '.join(V.quoted(n) for n in names)}) as r")
    left = hit.select(F.col(DIGEST).alias("lo"), F.col("r").alias("a"))
    right = hit.select(F.col(DIGEST).alias("hi"), F.col("r").alias("b"))
    got = wanted.join(left, "lo").join(right, "hi").selectExpr("lo", "hi", agreement(names, "a", "b") + " as mask").collect()
    return {(r["lo"], r["hi"]): mask_of(r["mask"]) for r in got}


def refuted(rows: DataFrame, codes: DataFrame, names, full: int, candidates) -> set:
    """The candidates without which the other columns repeat.

    Hashes only propose: a pair of rows is compared by its values, and a candidate whose
    pair was a collision is tested by grouping the values.
    """
    pairs = repeated_without(codes, full, candidates)
    masks = shared(rows, names, pairs.values()) if pairs else {}
    out = set()
    for cand, pair in pairs.items():
        others = full & ~cand
        if pair[0] != pair[1] and masks[pair] & others == others:
            out.add(cand)
        elif has_repeats(rows, [V.quoted(names[p]) for p in positions(others)]):
            out.add(cand)
    return out


def key_by_removal(rows: DataFrame, names, allowed, agreements, most: int = MOST):
    """First smallest key (mask) among the allowed columns, which hold no null and are unique together.

    The key is what remains without the largest set that can be left out; of several
    keys the first in list order.  None if a size has more than ``most`` candidates.
    """
    full = to_mask(allowed)
    differences = {full & ~a for a in agreements}
    hashes = ", ".join(f"xxhash64({V.quoted(n)}, {i})" for i, n in enumerate(names))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # each row is read many times over
    codes = Staged(rows.selectExpr(DIGEST, f"array({hashes}) as codes").repartition(tasks, DIGEST), "key-codes")
    try:
        free = [0]
        while True:
            candidates = [c for c in grown(free, allowed) if c != full and c not in differences]
            if len(candidates) > most:
                return None
            bad = refuted(rows, codes.frame, names, full, candidates) if candidates else set()
            wider = [c for c in candidates if c not in bad]
            if not wider:
                return min((full & ~c for c in free), key=positions)
            free = wider
    finally:
        codes.release()
