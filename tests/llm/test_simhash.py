import random

import pytest
import xxhash

from twinledger.llm import simhash
from twinledger.llm.components import components
from tests.llm.conftest import plain


def slow_print(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, radius):
    """fingerprint -> ids; gives fingerprint -> smallest id reachable."""
    label = {f: f for f in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in ids:
        for b in ids:
            if (a ^ b).bit_count() <= radius:
                label[find(a)] = find(b)
    best = {}
    for f, own in ids.items():
        best[find(f)] = min(([best[find(f)]] if find(f) in best else []) + own)
    return {f: best[find(f)] for f in ids}


def expected(rows):
    by = {}
    for i, t, *_ in rows:
        by.setdefault(slow_print(t), []).append((i is None, i))
    comp = slow_components(by, 2)
    return sorted(((i, f"{slow_print(t):016x}", comp[slow_print(t)][1]) for i, t, *_ in rows), key=repr)


def test_hard_rows_equal_brute_force(hard, hard_rows):
    assert plain(simhash.near_duplicates(hard).collect()) == expected(hard_rows)


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert plain(simhash.near_duplicates(docs).collect()) == expected([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("limit", [2, 7, 1024])
def test_links_span_the_components_also_where_shards_are_cut(spark, limit):
    rng = random.Random(limit)
    near = [0]
    for _ in range(250):  # a crowd that differs in few bits, so that shards are crowded
        near.append(rng.choice(near) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    far = [rng.getrandbits(64) for _ in range(100)]
    prints = list(dict.fromkeys(near + far))
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fp long")
    label = {r.node: r.label for r in components(simhash.links(frame, 2, limit)).collect()}
    want = slow_components({f: [f] for f in prints}, 2)
    got = {f: label.get(f - (1 << 64) if f >> 63 else f, f - (1 << 64) if f >> 63 else f) for f in prints}
    groups = {}
    for f in prints:
        groups.setdefault(want[f], set()).add(got[f])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.label for r in components(edges).collect()} == {0}


def test_drop_keeps_one_document_of_each_group(hard, hard_rows):
    kept = simhash.drop_near(hard)
    assert kept.columns == hard.columns
    by = {}
    for i, text, *_ in hard_rows:
        by.setdefault(slow_print(text), []).append((i is None, i, slow_print(text)))
    first = set(slow_components(by, 2).values())  # the fingerprint tells components apart that share an id
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for _, i, _ in first), key=repr)


def test_empty_table(none):
    assert simhash.near_duplicates(none).collect() == [] and simhash.drop_near(none).collect() == []
