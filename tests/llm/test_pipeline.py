from collections import defaultdict

import corpus_pipeline
from twinledger.llm import exact, mixing, packing, quality, simhash

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mixing sources to target weights", "best-fit packing"]


def test_every_stage_does_its_work_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if k < 4:
            assert docs.columns == columns
            assert docs.subtract(before).count() == 0  # rows come back unchanged
        if k == 0:
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            assert ids == sorted(r.doc_id for r in quality.score_quality(before, labels).filter("predicted = 1").collect())
        if k == 1:
            assert ids == sorted(r.doc_id for r in exact.exact_groups(before).filter("kept").collect())
        if k == 2:
            groups = defaultdict(list)
            for r in simhash.near_duplicates(before).collect():
                groups[r.component_id].append(r.doc_id)
            assert ids == sorted(groups)
        if k == 3:
            assert ids == sorted(r.doc_id for r in mixing.mix(before).collect() for _ in range(r.times))
        if k == 4:
            assert ids == sorted(r.doc_id for r in packing.pieces(before).collect())
            ends = defaultdict(int)
            for r in docs.collect():
                ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
            assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(ends.values()) // 2048) + 1


def test_run_gives_packed_pieces(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
