import random
import time
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from twinledger.operators import clean, keys, removal
from twinledger.plans import covers
from twinledger.plans.covers import open_candidates, to_mask


def brute_open(n, agreements, size):
    return [to_mask(c) for c in combinations(range(n), size) if not any(to_mask(c) & a == to_mask(c) for a in agreements)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 7), st.lists(st.integers(0, 127), max_size=8), st.integers(1, 7))
def test_open_candidates_equal_brute_force(n, agreements, size):
    agreements = {a & ((1 << n) - 1) for a in agreements}
    if size <= n:
        assert open_candidates(range(n), agreements, size, 10_000) == brute_open(n, agreements, size)


def test_open_candidates_stop_at_the_limit_and_skip_excluded():
    assert open_candidates(range(4), set(), 2, 2) == [0b11, 0b101]
    assert open_candidates(range(3), set(), 2, 9, excluded=[0b1]) == [0b110]


def brute_key(rows, width):
    rows = list(dict.fromkeys(rows))
    for strict in (True, False):
        for size in range(1, width + 1):
            for combo in combinations(range(width), size):
                picked = [tuple(r[i] for i in combo) for r in rows]
                full = [p for p in picked if None not in p]
                if strict and len(full) < len(picked):
                    continue
                if full and len(set(full)) == len(full):
                    return combo
    return ()


def random_rows(rng, n, width, nulls):
    spread = [rng.choice([2, 3, 6, 40]) for _ in range(width)]
    return [tuple(None if rng.random() < nulls else rng.randrange(s) for s in spread) for _ in range(n)]


@pytest.mark.parametrize("seed,nulls,sample", [(1, 0.0, 50_000), (2, 0.0, 5), (3, 0.1, 50_000), (4, 0.1, 5), (5, 0.5, 8)])
def test_first_smallest_key_equals_brute_force(spark, seed, nulls, sample):
    """Small samples force the test on all rows and its evidence."""
    rng = random.Random(seed)
    width = 4
    rows = random_rows(rng, 60, width, nulls)
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)).repartition(3)
    rows = [r for r in rows if any(v is not None for v in r)]
    got = keys.find_key(df, sample_rows=sample, batch=3)
    assert got.columns == tuple(names[i] for i in brute_key(rows, width))


def test_key_of_texts_found_through_sample_digests(spark):
    rows = [(i // 2 % 7, "same long text " * 50 + str(i // 2), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, t string, b int")
    assert keys.find_key(df, sample_rows=10).columns == ("t", "b")


def test_all_null_column_is_no_key(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), (None, None, 2)], "n int, a int, b int")
    got = keys.find_key(df)
    assert got.columns == ("a", "b") and got.origin == "discovered_ignoring_nulls"


def test_no_rows_no_key(spark):
    assert keys.find_key(spark.createDataFrame([], "a int, b int")).origin == "none"


def test_uniqueness_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None), (3, 3)], "a int, b int")
    r = keys.key_is_unique(df, ["a", "b"]).first()
    assert (r["row_count"], r["distinct_keys"], r["repeated_keys"], r["null_keys"], r["is_unique"]) == (5, 3, 2, 1, False)


@pytest.mark.parametrize("declared,columns,note", [
    (["K"], ("K",), None),
    (["k"], ("K",), None),
    (["V"], ("K",), "declared key is not unique"),
    (["OTHER"], ("K",), "declared key is outside the compared columns"),
    ([], ("K",), None),
])
def test_declared_key_is_proven_or_replaced(spark, declared, columns, note):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "K int, V int")
    rows = keys.with_digest(clean.clean(df))
    key, got = keys.resolve_key(rows, ["K", "V"], declared)
    assert key.columns == columns and got == note


def test_copies_of_a_row_do_not_break_a_key(spark):
    df = spark.createDataFrame([(1, 5)] * 50 + [(2, 5)], "k int, v int")
    assert keys.find_key(df).columns == ("k",)
    for frame, distinct in ((df, False), (clean.clean(df), True)):
        r = keys.declared_key_check(frame, ["k"], distinct).first()
        assert (r["status"], r["keyed_rows"], r["distinct_keys"]) == (1, 2, 2)
    bad = df.union(spark.createDataFrame([(1, 6), (None, 1), (None, 2)], "k int, v int"))
    r = keys.declared_key_check(bad, ["k"]).first()
    assert (r["status"], r["keyed_rows"], r["distinct_keys"]) == (2, 3, 2)


def brute_covers(n, agreements, size):
    return [m for m in (covers.to_mask(c) for c in combinations(range(n), size)) if not any(m & a == m for a in agreements)]


@pytest.mark.parametrize("seed", range(6))
def test_candidates_equal_brute_force(seed):
    rng = random.Random(seed)
    n = 14
    agreements = {rng.getrandbits(n) | rng.getrandbits(n) for _ in range(40)} - {(1 << n) - 1}
    for size in range(1, n + 1):
        want = brute_covers(n, agreements, size)
        got = covers.open_candidates(range(n), agreements, size, 10**9)
        in_order = sorted(want, key=lambda m: [i for i in range(n) if m >> i & 1])
        assert got == in_order
        assert covers.open_candidates(range(n), agreements, size, 3, want[:1]) == [m for m in in_order if m & want[0] != want[0]][:3] if want else not got


@pytest.mark.parametrize("n", [14, 24, 40])
def test_flags_that_number_the_rows_are_found_in_time(spark, n):
    """Two-valued columns: ten of them number the rows, the others say little."""
    rng = random.Random(n)
    rows = [tuple(i >> j & 1 for j in range(10)) + tuple(int(rng.random() < 0.1) for _ in range(n - 10)) for i in range(600)]
    names = [f"f{i}" for i in range(n)]
    df = spark.createDataFrame([tuple(reversed(r)) for r in rows], ", ".join(f"{c} int" for c in names))
    start = time.time()
    found = keys.find_key(df)
    assert time.time() - start < 90
    assert df.select(*found.columns).distinct().count() == 600 and len(found.columns) == 10


def test_a_small_sample_finds_the_same_key(spark):
    rng = random.Random(8)
    rows = [(i // 50, i % 50, rng.randrange(3), rng.randrange(4)) for i in range(4000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int").repartition(5)
    assert keys.find_key(df, sample_rows=20).columns == keys.find_key(df).columns == ("a", "b")


def from_above(monkeypatch, steps=0, most=50_000):
    """Turn to the removal search after so many steps, and say what it answered."""
    answers = []
    monkeypatch.setattr(keys, "STEPS", steps)
    monkeypatch.setattr(keys, "key_by_removal", lambda *a: answers.append(removal.key_by_removal(*a, most=most)) or answers[-1])
    return answers


@pytest.mark.parametrize("seed,n,width", [(1, 40, 14), (2, 150, 14), (3, 300, 12), (4, 3, 5)])
def test_key_by_removal_equals_brute_force(spark, monkeypatch, seed, n, width):
    answers = from_above(monkeypatch)
    rng = random.Random(seed)
    rows = list({tuple(rng.randrange(2) if i % 5 else rng.choice("ab") for i in range(width)) for _ in range(n)})
    df = spark.createDataFrame(rows, ", ".join(f"`c.{i}` {'int' if i % 5 else 'string'}" for i in range(width))).repartition(3)
    got = keys.find_key(df)
    assert got.columns == tuple(f"c.{i}" for i in brute_key(rows, width))
    assert len(answers) == 1 and answers[0] == to_mask(brute_key(rows, width))


def test_removal_with_too_many_candidates_goes_on_from_below(spark, monkeypatch):
    answers = from_above(monkeypatch, most=10)
    rows = [tuple(int(b) for b in f"{i:06b}") + (i % 7,) for i in range(64)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} int" for i in range(7)))
    assert keys.find_key(df).columns == tuple(f"c{i}" for i in brute_key(rows, 7)) and answers == [None]


def test_colliding_hashes_refute_nothing(spark, monkeypatch):
    """All columns hash alike: every candidate is then decided by its values."""
    from_above(monkeypatch)
    rows = list({tuple(random.Random(i).randrange(2) for _ in range(1)) + (i % 3, i % 2, i // 6) for i in range(24)})
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    real = removal.repeated_without
    monkeypatch.setattr(removal, "repeated_without", lambda codes, full, c: real(
        codes.withColumn("codes", F.transform("codes", lambda x: F.lit(0).cast("long"))), full, c))
    assert keys.find_key(df).columns == tuple("abcd"[i] for i in brute_key(rows, 4))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 9), st.sets(st.integers(1, 511), max_size=40))
def test_grown_sets_have_free_parts_only(n, free):
    free = {f for f in free if f.bit_count() == 2 and f < 1 << n}
    want = {to_mask(c) for c in combinations(range(n), 3) if all(to_mask(c) & ~(1 << p) in free for p in c)}
    got = removal.grown(sorted(free), range(n))
    assert set(got) == want and len(got) == len(want)


def test_unions_hold_each_candidate_once():
    cands = [to_mask(c) for c in combinations(range(3, 30), 3)]
    blocks, touched = removal.unions(cands)
    assert sorted(c for held in touched.values() for c in held) == sorted(cands) and len(touched) < len(cands)
    assert sorted(p for b in blocks for p in b) == list(range(3, 30))
    assert all(c & ~to_mask(p for b in held for p in blocks[b]) == 0 for held, own in touched.items() for c in own)


def test_most_candidates_are_refuted_by_parts_of_their_hashes(spark, monkeypatch):
    """40,000 rows, of which the sample sees few: pairs that repeat a candidate are sought
    among the few rows whose hash of it repeats in a part, never among all rows."""
    seen, plain = [], keys._evidence
    monkeypatch.setattr(keys, "_evidence", lambda rows, *a: seen.append(rows.count()) or plain(rows, *a))
    df = spark.range(0, 40_000, 1, 4).selectExpr("id div 2 as a", "id % 2 + 2 * (id div 40) as b", "id % 5000 as c", "id % 8 as d")
    want = brute_key([tuple(r) for r in df.collect()], 4)
    assert keys.find_key(df, sample_rows=200).columns == tuple("abcd"[i] for i in want) == ("a", "b")
    assert max(seen) < 2000


def test_rows_without_copies_are_not_shuffled_whole(spark, monkeypatch):
    plans, plain = [], keys.Staged
    monkeypatch.setattr(keys, "Staged", lambda frame, *a: plans.append(frame._jdf.queryExecution().analyzed().toString()) or plain(frame, *a))
    assert keys.find_key(spark.range(1000).selectExpr("id", "id % 7 as x")).columns == ("id",)
    assert plans and not any("Deduplicate" in p for p in plans)


@pytest.mark.parametrize("most", [0, 2, 1000])
def test_staged_distinct_rows_equal_clean_rows(spark, most):
    nan = float("nan")
    rows = [(i, "t", i / 2) for i in range(50)] + [(i, "t", i / 2) for i in range(10)] * 3
    rows += [(None, None, None), (None, None, nan), (7, None, nan), (7, None, None), (8, "z", 0.0), (8, "z", -0.0)]
    df = spark.createDataFrame(rows, "`a.b` int, `c``d` string, x double").repartition(4)
    want = sorted(map(repr, keys.with_digest(clean.clean(df)).collect()))
    with keys.staged_distinct(df, most) as got:
        assert sorted(map(repr, got.select("`a.b`", "`c``d`", "x", clean.DIGEST).collect())) == want and len(want) == 52


@pytest.mark.parametrize("seed,hashes", [(1, 1), (2, 8), (3, 300), (6, 40)])
def test_equal_hashes_are_decided_by_values(spark, monkeypatch, seed, hashes):
    """Hashes of few values collide everywhere, in hot groups too."""
    plain = keys._long_hash
    monkeypatch.setattr(keys, "_long_hash", lambda mask, names: f"pmod({plain(mask, names)}, {hashes})")
    rng = random.Random(seed)
    rows = random_rows(rng, 80, 4, 0.1 if seed % 2 else 0.0)
    rows = [r for r in rows if any(v is not None for v in r)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} int" for i in range(4))).repartition(3)
    assert keys.find_key(df, sample_rows=5).columns == tuple(f"c{i}" for i in brute_key(rows, 4))
