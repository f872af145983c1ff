"""Differences of two sides found from small aggregates, without moving equal rows.

Two structures, both summed where the rows lie, of a size that does not grow with the rows:

* checksums of key-hash buckets. Buckets with equal checksums hold equal rows; the others are
  split into finer ones, and only the rows of the finest unequal buckets are joined by value;
* invertible cells for whole rows, in strata and then in groups whose number follows from the strata. The cells of
  both sides are subtracted and peeled group by group in tasks, which gives the digests of the rows that one side
  has more often; only rows with these digests are compared by value.

Digests are two 64-bit hashes of all columns and of which of them are null. What is called equal is equal in
both; everything reported is compared by value.
"""

from __future__ import annotations

import sys
import zlib
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.operators.reconcile import IN_SOURCE, IN_TARGET, multiset_difference, reconcile
from twinledger.session import Staged

# cells are peeled in tasks, where this package need not be installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of the key's hash that name a bucket, level by level; the last one bounds what is ever broadcast (2^20 ids).
LEVELS = (10, 15, 20)


def _columns(df: DataFrame, names=None) -> list[Column]:
    return [F.col(V.quoted(c)) for c in (names if names is not None else df.columns)]


def _checked(src: DataFrame, tgt: DataFrame) -> None:
    if src.dtypes != tgt.dtypes:
        raise ValueError(f"the sides differ in columns or types: {src.dtypes} and {tgt.dtypes}")


def row_digests(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit digests of a row. Nulls count by their places, which a hash of the values alone skips."""
    columns = _columns(df)
    bits = [F.when(c.isNull(), F.lit(1 << i % 62).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(columns)]
    nulls = [reduce(Column.__add__, bits[i:i + 62]) for i in range(0, len(bits), 62)]
    return F.xxhash64(*nulls, *columns), F.xxhash64(F.lit(7), *reversed(columns), *nulls)


def _bucket(key: list[Column], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)


def _checksums(df: DataFrame, key, bits: int, digests) -> DataFrame:
    """(bucket, five facts) in one map-side combined aggregate of at most 2^bits rows a task."""
    first, second = digests(df)
    exact = lambda d: F.sum(d.cast("decimal(20,0)"))
    rows = df.select(_bucket(_columns(df, key), bits).alias("bucket"), first.alias("a"), second.alias("b"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), exact(F.col("a")).alias("sa"), exact(F.col("b")).alias("sb"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))


def unequal_buckets(src: DataFrame, tgt: DataFrame, key, bits: int, digests=row_digests) -> DataFrame:
    """(bucket): the key-hash buckets whose checksums differ between the sides, or which only one side has."""
    facts = ("n", "sa", "sb", "xa", "xb")
    s = _checksums(src, key, bits, digests).select("bucket", F.struct(*facts).alias("s"))
    t = _checksums(tgt, key, bits, digests).select("bucket", F.struct(*facts).alias("t"))
    return s.join(t, "bucket", "full_outer").where(~F.col("s").eqNullSafe(F.col("t"))).select("bucket")


def _within(df: DataFrame, key, buckets: DataFrame, bits: int, how: str) -> DataFrame:
    """Rows in (left_semi) or out of (left_anti) the buckets; their ids are broadcast, at most 2^bits longs."""
    ids = F.broadcast(buckets.withColumnRenamed("bucket", "__bucket"))
    return df.join(ids, _bucket(_columns(df, key), bits) == F.col("__bucket"), how)


class Drilled:
    """The finest unequal buckets of two sides, and the rows in them."""

    def __init__(self, src: DataFrame, tgt: DataFrame, key, levels=LEVELS, small: int = 10_000, digests=row_digests):
        """Levels end early where no bucket is unequal, or where about ``small`` rows are left in unequal ones."""
        _checked(src, tgt)
        spark, self.key, self.bits = src.sparkSession, list(key), levels[0]
        rows = None
        self.source, self.target = src, tgt
        for self.bits in levels:
            found = unequal_buckets(self.source, self.target, self.key, self.bits, digests)
            ids = [r.bucket for r in found.collect()]  # at most 2^bits longs
            self.buckets = spark.createDataFrame([(i,) for i in ids], "bucket long")
            self.source = _within(src, self.key, self.buckets, self.bits, "left_semi")
            self.target = _within(tgt, self.key, self.buckets, self.bits, "left_semi")
            if not ids:
                break
            if rows is None:
                rows = src.count()
            if rows / 2**self.bits * len(ids) <= small:
                break

    def equal_rows(self, src: DataFrame) -> DataFrame:
        """The rows of the source in buckets proven equal; the target has the same ones."""
        return _within(src, self.key, self.buckets, self.bits, "left_anti")


def differing_rows(src: DataFrame, tgt: DataFrame, key, levels=LEVELS, digests=row_digests) -> DataFrame:
    """``reconcile`` of the rows in unequal buckets: all unmatched and differing rows, and a few equal ones beside them."""
    drilled = Drilled(src, tgt, key, levels, digests=digests)
    return reconcile(drilled.source, drilled.target, drilled.key)


def reconcile_by_buckets(src: DataFrame, tgt: DataFrame, key, levels=LEVELS, digests=row_digests) -> DataFrame:
    """The rows of ``reconcile``: only rows of unequal buckets are shuffled, rows of equal ones are read from the source.

    No two source rows share a key; a target key may repeat, and null keys match null keys. Both sides have
    the same columns and types, of types that can be hashed.
    """
    drilled = Drilled(src, tgt, key, levels, digests=digests)
    found = reconcile(drilled.source, drilled.target, drilled.key)
    payload = [c for c in src.columns if c not in drilled.key]
    equal = drilled.equal_rows(src)
    both = [F.col(V.quoted(c)).alias(f"{side}__{c}") for c in payload for side in ("source", "target")]
    return found.unionByName(equal.select(*_columns(equal, drilled.key), F.lit(True).alias(IN_SOURCE), F.lit(True).alias(IN_TARGET), *both))


# -- invertible cells

#: Cells of each of the three parts, in a stratum and in all groups at most; a power of two up to 2^PART_BITS.
FIRST_CELLS, MOST_CELLS, PART_BITS = 1 << 10, 1 << 20, 20
#: Cells of each part of a group, strata beside the last, and bits of a digest in one of the sums.
GROUP_CELLS, STRATA, PIECE = 1 << 12, 20, 22
PARTS = 3
FACTS = ("n", "a2", "a1", "a0", "b2", "b1", "b0", "c1", "c0")


def _sums(src: DataFrame, tgt: DataFrame, size: int, digests, group) -> DataFrame:
    """(group, cell, FACTS): source minus target sums over the rows of each cell, other than none.

    ``group`` names a row's group from its second digest. Digests and checks are summed in pieces of at most
    PIECE bits: plain long sums, which 2^41 rows in one cell do not exceed.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        first, second = digests(df)
        return df.select(first.alias("a"), second.alias("b"), F.lit(sign).cast("bigint").alias("sign"))

    def pieces(name: str) -> dict[str, Column]:
        low = F.lit((1 << PIECE) - 1).cast("bigint")
        c = F.col(name)
        return {f"{name}2": F.shiftright(c, 2 * PIECE), f"{name}1": F.shiftright(c, PIECE).bitwiseAND(low), f"{name}0": c.bitwiseAND(low)}

    rows = side(src, 1).unionByName(side(tgt, -1))
    places = [F.pmod(F.shiftrightunsigned("a", PART_BITS * p), F.lit(size)) + p * size for p in range(PARTS)]  # sizes are powers of two
    check = F.crc32(F.concat_ws(":", F.col("a").cast("string"), F.col("b").cast("string")).cast("binary"))
    known = rows.select("a", "b", "sign", check.alias("c"), group(F.col("b")).cast("int").alias("group"), F.array(*[p.cast("int") for p in places]).alias("places"))
    dealt = known.select("group", F.explode("places").alias("cell"), "a", "b", "c", "sign")
    c = {k: v for k, v in pieces("c").items() if k != "c2"}
    facts = {"n": F.lit(1).cast("bigint"), **pieces("a"), **pieces("b"), **c}
    summed = dealt.groupBy("group", "cell").agg(*[F.sum(facts[f] * F.col("sign")).alias(f) for f in FACTS])
    return summed.where(" or ".join(f"{f} <> 0" for f in FACTS))


def _joined(pieces) -> int:
    """The number from its pieces, the highest first."""
    out = 0
    for x in pieces:
        out = (out << PIECE) + int(x)
    return out


def cells(src: DataFrame, tgt: DataFrame, size: int, digests=row_digests) -> DataFrame:
    """(cell, n, a, b, c): source minus target sums of the number, both digests and a check of the rows in each cell.

    A row lies in one cell of each part, named by bits of its first digest. One aggregate, combined before
    the shuffle to at most PARTS * size rows a task; cells without a difference are left out.
    """
    def whole(name: str, most: int) -> Column:
        parts = [F.col(f"{name}{i}").cast("decimal(20,0)") * F.lit(1 << PIECE * i).cast("decimal(17,0)") for i in range(most)]
        return sum(parts[1:], parts[0]).alias(name)

    return _sums(src, tgt, size, digests, lambda b: F.lit(0)).select("cell", "n", whole("a", 3), whole("b", 3), whole("c", 2))


def peel(found: dict[int, tuple[int, int, int, int]], size: int) -> dict[tuple[int, int], int] | None:
    """{digests: surplus copies in the source} from the cells' sums, or None if they do not decode.

    A cell with one distinct row shows it: its sums divide by the number of copies, the check agrees and the
    digest names this cell. The row is taken out of its other cells, which may show further ones.
    """
    left = {cell: list(sums) for cell, sums in found.items()}
    out: dict[tuple[int, int], int] = {}
    queue = list(left)
    while queue:
        cell = queue.pop()
        n, a, b, c = left.get(cell, (0, 0, 0, 0))
        if n == 0 or a % n or b % n:
            continue
        first, second = a // n, b // n
        if c != n * zlib.crc32(f"{first}:{second}".encode()):
            continue
        own = [(((first & (2**64 - 1)) >> (PART_BITS * p)) % size) + p * size for p in range(PARTS)]
        if cell not in own:
            continue
        if (first, second) in out:  # a cell that only looked like one row
            return None
        out[first, second] = n
        for place in own:
            sums = left.setdefault(place, [0, 0, 0, 0])
            for i, x in enumerate((n, a, b, c)):
                sums[i] -= x
            if any(sums):
                queue.append(place)
            else:
                del left[place]
    return None if left else out


def _peeled(sums: DataFrame, size: int) -> DataFrame:
    """(group, a, b, told): the digests of each group's surplus rows, or one row with ``told`` false if its cells do not decode."""
    def run(frame):
        import pandas as pd

        numbers = zip(*[frame[c].tolist() for c in ("cell", *FACTS)])
        told = peel({x[0]: (x[1], _joined(x[2:5]), _joined(x[5:8]), _joined(x[8:])) for x in numbers}, size)
        rows = [(None, None, False)] if told is None else [(a, b, True) for a, b in told]
        out = pd.DataFrame(rows, columns=["a", "b", "told"]).astype({"a": "Int64", "b": "Int64", "told": "bool"})
        out.insert(0, "group", int(frame["group"].iloc[0]))
        return out

    return sums.groupBy("group").applyInPandas(run, "group int, a long, b long, told boolean")


def _stratum(b: Column) -> Column:
    """Zeros at the end of a digest, STRATA at most: half of the rows lie in stratum 0, a quarter in stratum 1, ..."""
    low = b.bitwiseAND(F.lit((1 << STRATA) - 1)).bitwiseOR(F.lit(1 << STRATA))
    return F.bit_count(low.bitwiseXOR(low - 1)) - 1


def _rows_told(df: DataFrame, told: DataFrame, digests) -> DataFrame:
    a, b = digests(df)
    return df.join(F.broadcast(told.select(F.col("a").alias("__a"), F.col("b").alias("__b"))), (a == F.col("__a")) & (b == F.col("__b")), "left_semi")


def difference_by_cells(src: DataFrame, tgt: DataFrame, first: int = FIRST_CELLS, most: int = MOST_CELLS, digests=row_digests) -> DataFrame:
    """The rows of ``multiset_difference`` from cells: no row is shuffled unless its digest differs in number.

    Cells of strata come first. If all decode, they tell the differing digests; else those that do tell how many
    there are, and a second pass has groups of cells for as many. The rows of a group that does not decode
    are compared as a whole, and so are all rows where more than ``most`` cells a part were needed. Groups are
    peeled in tasks; at most 2 * most digests are broadcast.
    """
    _checked(src, tgt)
    strata = Staged(_peeled(_sums(src, tgt, first, digests, _stratum), first), "strata").frame
    found = {r["group"]: (r["told"], r["n"]) for r in strata.groupBy("group").agg(F.every("told").alias("told"), F.count("*").alias("n")).collect()}
    failed = [g for g, (told, _) in found.items() if not told]
    if not failed:
        return multiset_difference(*[_rows_told(df, strata, digests) for df in (src, tgt)])
    above = sum(n for g, (_, n) in found.items() if g > max(failed))
    wanted = max(above, 1) * 2 ** (max(failed) + 1) // 2  # half as many cells in each of the parts as digests differ
    if wanted > most:
        return multiset_difference(src, tgt)
    size = min(GROUP_CELLS, most)
    groups = 1 << max(0, -(-wanted // size) - 1).bit_length()

    def group(b: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(b, 2 * PART_BITS), F.lit(groups))

    told = Staged(_peeled(_sums(src, tgt, size, digests, group), size), "told").frame
    undecoded = [r["group"] for r in told.where("not told").collect()]
    parts = [_rows_told(df, told.where("told"), digests) for df in (src, tgt)]
    if undecoded:
        parts = [part.unionByName(df.where(group(digests(df)[1]).isin(undecoded))) for part, df in zip(parts, (src, tgt))]
    return multiset_difference(*parts)
