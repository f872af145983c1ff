import re
from collections import Counter, defaultdict

import pytest

from twinledger.llm import mixing

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, total = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}, sum(sizes.values())
    full = set()
    while True:
        left, of = 1.5 * total - sum(2 * sizes[n] for n in full), sum(weight[n] for n in names if n not in full)
        new = {n for n in names if n not in full and left * weight[n] / of > 2 * sizes[n]}
        if not new:
            return {n: 2.0 * sizes[n] if n in full else left * weight[n] / of for n in names}
        full |= new


def check(got, rows):
    sizes, own = Counter(), {}
    for i, t, _, s, *_ in rows:
        sizes[s] += len(SPACE.findall(t or ""))
    want, taken, smallest = slow_targets(sizes), Counter(), defaultdict(list)
    assert len(got) == len(rows)
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(i), len(SPACE.findall(t or ""))) for i, t, *_ in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.times * r.size and 0 <= r.times <= 2
        taken[r.source] += r.taken
    for s, target in want.items():
        left = round(target - taken[s])
        assert left >= 0
        epochs = int(target // sizes[s]) if sizes[s] else 0
        out = Counter()
        for r in got:
            if r.source == s and r.size and r.times == epochs:
                out[(r.doc_id, r.size)] += r.size  # rows that repeat are taken together
        assert epochs == 2 or not out or left < min(out.values())  # nothing that is left out still fits
    return own


def test_hard_rows(hard, hard_rows):
    check(mixing.mix(hard).collect(), hard_rows)


def test_documents_and_reruns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = mixing.mix(docs).collect()
    check(got, [tuple(r) for r in docs.collect()])
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rows_come_as_often_as_taken(hard):
    want = Counter()
    for r in mixing.mix(hard).collect():
        want[repr(r.doc_id), r.size] += r.times
    rows = mixing.mixed(hard)
    got = Counter((repr(r.doc_id), len(SPACE.findall(r.text or ""))) for r in rows.collect())
    assert got == +want and rows.columns == hard.columns


def test_heavier_documents_are_taken_more_often(spark):
    from pyspark.sql import functions as F

    docs = spark.range(6000).selectExpr("id doc_id", "concat('w', id % 2) text", "'s' || (id % 3) source")
    rows = mixing.mix(docs, weight=F.when(F.col("text") == "w0", 1.0).otherwise(0.3)).join(docs, "doc_id").collect()
    part = [r for r in rows if 0 < r.target % r.source_size and r.target < 2 * r.source_size]
    share = Counter()
    for r in part:
        share[r.text] += r.times - int(r.target // r.source_size)
    assert share["w0"] > 1.5 * share["w1"]


def test_empty_table(none):
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


def test_the_budget_may_end_among_equal_rows(spark):
    """Ten copies in each place, more words together than any room, and every copy fits singly."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "one two three", s) for s in "abc" for _ in range(10)], "doc_id long, text string, source string")
    docs = docs.withColumn("nothing", F.lit(None)).repartition(4)
    rows = mixing.mix(docs).collect()
    for r in rows:
        assert 0 <= r.target - sum(x.taken for x in rows if x.source == r.source) < 3
    want = Counter()
    for r in rows:
        want[r.source] += r.times
    got = mixing.mixed(docs)
    assert Counter(r.source for r in got.collect()) == +want and got.columns == docs.columns


def test_a_third_of_the_rows_without_id_and_with_one_text(spark):
    rows = [(None if i % 3 == 0 else i, "same words here" if i % 3 == 0 else f"text {i} " * (1 + i % 7), "x" if i % 2 else "y") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    left, out = Counter(), defaultdict(list)
    for r in first:
        left[r.source, r.target] += r.taken
        if r.times == int(r.target // r.source_size):
            out[r.source].append(r.size)
    for (source, target), taken in left.items():
        assert 0 <= round(target - taken) < min(out.get(source, [1]))


def test_keys_that_round_together(spark):
    from pyspark.sql import functions as F

    docs = spark.range(300).selectExpr("id doc_id", "concat('w ', id) text", "'s' || (id % 3) source")
    rows = mixing.mix(docs, weight=F.lit(1e-9)).collect()  # all keys are 1.0
    for s in {r.source for r in rows}:
        part = [r for r in rows if r.source == s]
        assert 0 <= round(part[0].target - sum(r.taken for r in part)) < 2
