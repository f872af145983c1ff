import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twinledger.llm import packing


def slow_pieces(rows, size):
    whole = Tokenizer.from_file(packing.tokenizer_path())
    out = []
    for i, t, *_ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % size or size
        bounds = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def check(got, rows, size):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == slow_pieces(rows, size)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


@pytest.mark.parametrize("size", [64, 2048])
def test_hard_rows(hard, hard_rows, size):
    check(packing.pack(hard, size).collect(), hard_rows, size)


def test_documents_fill_as_few_sequences_as_can_be(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = packing.pack(docs).collect()
    assert check(got, [(r.doc_id, r.text) for r in docs.collect()], 2048) <= -(-sum(r.length for r in got) // 2048) + 1


def test_ids_come_back(hard, hard_rows):
    docs = defaultdict(dict)
    for r in packing.pack(hard.filter("doc_id = 6"), with_ids=True).collect():
        docs[r.doc_id][r.piece] = r.ids
    ids = [x for _, part in sorted(docs[6].items()) for x in part]
    text = next(t for i, t, *_ in hard_rows if i == 6)
    assert ids[-1] == 0 and Tokenizer.from_file(packing.tokenizer_path()).decode(ids[:-1]) == text


def test_both_encoders_agree():
    whole, encode = Tokenizer.from_file(packing.tokenizer_path()), packing.encoder(packing.tokenizer_path())
    rng = random.Random(5)
    latin = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)]]
    texts = ["".join(rng.choices(latin + [" "] * 40 + list("aeiou") * 9, k=rng.randrange(200))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "日本   x", "it's we'LL  \n\n x", "½ ² ª º ¼"]
    assert encode(texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6))
def test_fullest_bin(counts):
    use = packing.fullest(counts, 30)
    items = [x for x, n in counts.items() for _ in range(n)]
    first = max(items)
    items.remove(first)
    best = max(first + sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if first + sum(c) <= 30) if len(items) < 13 else 30
    fill = sum(x * k for x, k in use.items())
    assert use[first] >= 1 and all(k <= counts[x] for x, k in use.items()) and fill <= 30 and (len(items) >= 13 or fill == best)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 1000), max_size=40))
def test_plan_uses_every_piece_once(counts):
    used = Counter()
    bins = packing.plan_bins(counts, 64)
    for use, times in bins:
        assert sum(x * k for x, k in use.items()) <= 64
        for x, k in use.items():
            used[x] += k * times
    assert used == counts and len(bins) <= 64


def test_empty_table(none):
    assert packing.pack(none).collect() == []
