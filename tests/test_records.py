"""CSV records by the quotes of their lines: against Python's csv module, and broken files line by line."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from twinledger.model import RunConfig
from twinledger.plans.pair import PairSpec, run_pair
from twinledger.sources.files import FileRef, bad_records, read_file
from twinledger.sources.records import LONG, SHORT, UNCLOSED, read_records

OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


@pytest.fixture
def small_blocks(spark):
    """Blocks of 2,000 bytes, so that records and quoted fields run over many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, end):
    rnd = random.Random(7)
    texts = ["plain", 'a "q" b', "x\ny", 'x\n\ny, "z"\nw', '"', "\n", 'a,b\nc,d,e\n"k",2', "l\n" * 2500, ",", 'end"', '"\n"']
    rows = [(str(i), rnd.choice(texts), rnd.choice(["u", "v,w", '""'])) for i in range(300)]
    path = tmp_path / "a.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "t", "u"])
        w.writerows(rows)
    df = read_file(spark, FileRef(str(path), null_tokens=()))
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
    assert sorted(map(tuple, df.collect()), key=lambda r: int(r[0])) == rows
    whole = read_file(spark, FileRef(str(path), null_tokens=(), splittable=False))
    assert df.exceptAll(whole).count() == 0 and whole.exceptAll(df).count() == 0
    assert bad_records(spark, FileRef(str(path))).count() == 0


BROKEN = ('id,t,u\n1,"a",x\n2,"b\nc",y\n3,"open,z\n4,plain,k\n5,"q","r"\n6,a,b,c\n7,a\n8,5" pipe,x\n9,"m\nn","e"\n\n   \n10,a,b\n'
          '11,"tail,b\n12,c,d\n')


def test_broken_records_are_set_aside_with_their_lines(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text(BROKEN)
    ref = FileRef(str(path), quarantine=True)
    bad = {(r["line"], r["reason"], r["record"]) for r in bad_records(spark, ref).collect()}
    assert bad == {(5, UNCLOSED, '3,"open,z'), (6, UNCLOSED, "4,plain,k"), (8, LONG, "6,a,b,c"), (9, SHORT, "7,a"),
                   (16, UNCLOSED, '11,"tail,b'), (17, UNCLOSED, "12,c,d")}
    good = sorted(map(tuple, read_file(spark, ref).collect()))
    assert good == sorted([("1", "a", "x"), ("2", "b\nc", "y"), ("5", "q", "r"), ("8", '5" pipe', "x"), ("9", "m\nn", "e"), ("10", "a", "b")])


def test_an_unclosed_field_does_not_gather_the_rest_of_a_file(spark, tmp_path, small_blocks):
    path = tmp_path / "c.csv"
    path.write_text('a,b\n0,"x\n' + "".join(f"{i},plain\n" for i in range(1, 3000)))
    records = read_records(spark, str(path))
    assert records.count() == 3000 and records.where("closed").count() == 0
    assert records.agg(F.max(F.length("record"))).first()[0] < 20


def test_a_pair_goes_on_and_reports_its_broken_records(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,2\n3,4,5\n6,"7"\n8\n')
    (tmp_path / "good.csv").write_text("a,b\n1,2\n6,7\n")
    good = FileRef(f"{tmp_path}/good.csv")
    result = run_pair(spark, PairSpec(good, FileRef(f"{tmp_path}/bad.csv", quarantine=True)), RunConfig())
    found = {r["code"]: r for r in result.findings.collect()}
    assert found["BAD_RECORDS"]["count"] == 2 and f"line 3: {LONG}" in found["BAD_RECORDS"]["target_value"]
    assert "EXTRA_IN_SOURCE" not in found and found["COUNT"]["count"] == 0
    reasons = [r["Reason"] for r in result.report.collect() if r["Validation_Result"] == "Fail"]
    assert len(reasons) == 1 and "broken records set aside: 2 in target (bad.csv line 3" in reasons[0]
    row = run_pair(spark, PairSpec(good, FileRef(f"{tmp_path}/bad.csv"))).report.collect()
    assert len(row) == 1 and "FILE_MALFORMED" in row[0]["Reason"] and f"bad.csv line 3: {LONG}" in row[0]["Reason"]


def test_files_with_other_headers_and_only_headers(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "2.csv").write_text('b,a\n"p\nq",2\n3\n')
    (folder / "3.csv").write_text("a,b\n")
    ref = FileRef(str(folder), quarantine=True)
    assert sorted(map(tuple, read_file(spark, ref).collect())) == [("1", "x\ny"), ("2", "p\nq")]
    assert [(r["line"], r["reason"]) for r in bad_records(spark, ref).collect()] == [(4, SHORT)]


def test_no_task_writes_the_whole_file_and_lines_count_through_the_parts(spark, sf_dir, monkeypatch):
    from suite import spark_queries as Q
    from tests.check_queries import compare

    monkeypatch.setattr(Q, "LINES_A_FILE", 200, raising=False)
    ref = Q.orders_csv(spark, sf_dir, "parts")
    sizes = [r["count"] for r in spark.read.text(ref.path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1000
    for name in ("csv_bad_records", "csv_good_records"):
        same, got, want = compare(spark, sf_dir, name)
        assert same, (name, got[1][:3], want[1][:3])


def test_pages_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from suite import spark_queries as Q

    rows = [(i, f"u{i}", f"<p>\n\"{i}\",\n</p>") for i in range(4000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        out = sorted(map(tuple, Q.csv_line_breaks(spark, str(tmp_path)).collect()), key=lambda r: int(r[0]))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert out == [(str(i), u, h) for i, u, h in rows]
    assert len(list((tmp_path / "pages-csv.csv").glob("part-*"))) == 4


def test_lines_are_put_in_order_by_chunks_of_a_block(spark, tmp_path, monkeypatch):
    """Quoted fields over many chunks of four lines."""
    from twinledger.sources import records

    monkeypatch.setattr(records, "CHUNK", 4)
    path = tmp_path / "d.csv"
    rows = [(str(i), "l\n" * (i % 23) + '"q"', "x") for i in range(200)]
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerows([("a", "b", "c"), *rows])
    got = sorted(map(tuple, read_file(spark, FileRef(str(path), null_tokens=())).collect()), key=lambda r: int(r[0]))
    assert got == rows
    records_read = read_records(spark, str(path))
    assert "chunk" in records_read._jdf.queryExecution().optimizedPlan().toString()
