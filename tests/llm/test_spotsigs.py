import hashlib
import re
import time

from pyspark.sql import functions as F

from twinledger.llm import spotsigs
from tests.llm.conftest import prose


def slow_sigs(text, chain=spotsigs.CHAIN):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    told = [w for w in words if w not in spotsigs.STOPS]
    out = set()
    for i, w in enumerate(told):
        if w in spotsigs.ANCHORS:
            content = [x for x in told[i + 1:] if x not in spotsigs.ANCHORS][:chain]
            if len(content) == chain:
                out.add(" ".join([w, *content]))
    if not out and words:
        out = {" ".join(words)}
    return sorted({hashlib.md5(s.encode()).hexdigest()[: spotsigs.DIGITS] for s in out})


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = [(i, t or "") for i, t, *_ in rows]
    out = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        edited = t[: len(t) - q] + n[:q]
        a, b, c = slow_sigs(t), slow_sigs(edited), slow_sigs(n)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), jaccard(a, b), jaccard(a, c)))
    return out


def got(frame):
    return [tuple(r)[:7] for r in frame.collect()]


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(got(spotsigs.fingerprint_edits(docs.repartition(5)))) == expected(rows)


def test_hard_rows(hard, hard_rows):
    """Rows that share an id are ordered by a hash, which brute force does not know: they and those before them are left out."""
    shared = {1, 13, None}
    rows = sorted([r for r in hard_rows if r[0] not in shared], key=lambda r: r[0])
    frame = hard.filter("doc_id NOT IN (1, 13)")
    assert sorted(got(spotsigs.fingerprint_edits(frame))) == expected(rows)
    everything = spotsigs.fingerprint_edits(hard).collect()
    assert sorted(repr(r.doc_id) for r in everything) == sorted(repr(r[0]) for r in hard_rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in everything)


def test_single_document_and_empty_table(spark, none):
    one = spark.createDataFrame([(5, "The quick brown fox is a lazy dog of the house.")], "doc_id long, text string")
    assert got(spotsigs.fingerprint_edits(one)) == expected([(5, "The quick brown fox is a lazy dog of the house.")])
    assert spotsigs.fingerprint_edits(none).collect() == []


def test_near_pairs_equal_brute_force(spark):
    base = [" the ".join(prose(6, s * 100 + k) for k in range(30)) for s in range(4)]
    texts = [t for t in base for _ in range(3)]
    for k, t in enumerate(texts):
        parts = t.split(" the ")
        for j in range(k % 5):
            parts[j * 3] = prose(6, 1000 + k * 10 + j)
        texts[k] = " the ".join(parts)
    texts += [texts[0], "no anchors here", ""]
    texts += [texts[1], "", None]
    ids = [*range(len(texts) - 2), None, None]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    sigs = [slow_sigs(t or "") for t in texts]
    names = [hashlib.md5("".join(s).encode()).hexdigest() for s in sigs]
    sets = dict(zip(names, sigs))
    want = {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b and sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8}
    members, pairs = spotsigs.near_classes(docs)
    assert {(r.a, r.b): r.likeness for r in pairs.collect()} == want and want
    assert sorted(map(repr, map(tuple, members.collect()))) == sorted(map(repr, zip(ids, names)))


def test_near_classes_of_hard_and_of_no_rows(hard, hard_rows, none):
    members, pairs = spotsigs.near_classes(hard)
    assert members.count() == len(hard_rows) and all(r.likeness >= 0.8 for r in pairs.collect())
    members, pairs = spotsigs.near_classes(none)
    assert members.collect() == [] and pairs.collect() == []


def test_no_python_in_the_plan(hard):
    plan = spotsigs.fingerprint_edits(hard)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_long_repetitive_texts(spark):
    """Anchors in long runs, alone, alternating, with and without content behind them: equal to brute force, in linear time."""
    texts = ["the " * 200_000, "the a " * 100_000 + "fox dog", "the fox " * 100_000, "is a the x of y an " * 50_000, "w" * 1_000_000, "one " * 200_000, "the a fox", "the a an fox the der dog the", "a fox the"]
    begun = time.time()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(4).select("i", spotsigs.signatures(F.col("text")).alias("sigs")).collect()
    assert time.time() - begun < 60
    assert {r.i: r.sigs for r in rows} == {i: slow_sigs(t) if len(t) < 100 else quick_sigs(t) for i, t in enumerate(texts)}


def quick_sigs(text, chain=spotsigs.CHAIN):
    told = [w for w in text.split() if w not in spotsigs.STOPS]
    out, ahead = set(), []
    for w in reversed(told):
        if w in spotsigs.ANCHORS:
            if len(ahead) == chain:
                out.add(" ".join([w, *ahead]))
        else:
            ahead = [w, *ahead][:chain]
    return sorted({hashlib.md5(s.encode()).hexdigest()[: spotsigs.DIGITS] for s in out or {" ".join(text.split())}})
