import hashlib
from collections import defaultdict

import pytest

from twinledger.llm import exact
from tests.llm.conftest import plain


def brute(rows, pick):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        kept = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            stays = i == keep and not kept
            kept = kept or stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_groups_equal_brute_force(hard, hard_rows, keep, pick):
    assert plain(exact.exact_groups(hard, keep).collect()) == brute(hard_rows, pick)


def test_documents_equal_brute_force_over_many_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert plain(exact.exact_groups(docs.repartition(70)).collect()) == brute(rows, max)


def test_drop_keeps_one_row_of_each_text_and_all_columns(hard, hard_rows):
    kept = exact.drop_exact(hard)
    assert kept.columns == hard.columns
    rows = kept.select("doc_id", "text").collect()
    assert len(rows) == len({(t or "").encode().lower() for _, t, *_ in hard_rows})
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((r[0] for r in brute(hard_rows, max) if r[3]), key=repr)


def test_empty_table(none):
    assert exact.exact_groups(none).collect() == [] and exact.drop_exact(none).collect() == []
