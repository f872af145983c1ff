import pytest

from twinledger.model import MANIFEST_COLUMNS, SNOWFLAKE, SQLSERVER, DatasetError, RunConfig
from twinledger.plans.pair import PairSpec, run_manifest, run_pair
from twinledger.sinks import reports
from twinledger.sources.control import read_mapping
from twinledger.sources.files import FileRef, read_file
from twinledger.sources.jdbc import SqlServerConnection
from twinledger.sources.tables import TableRef, list_columns, list_tables, read_table, table_exists


def put(path, text):
    path.write_text(text, encoding="UTF-8")
    return FileRef(str(path))


def test_null_tokens_and_upper_header(spark, tmp_path):
    df = read_file(spark, put(tmp_path / "a.csv", "id,amt\n1,NA\n2,\n3,null\n4,7\n5,Nan\n"))
    assert df.columns == ["ID", "AMT"]
    assert [r["AMT"] for r in df.orderBy("ID").collect()] == [None, None, None, "7", "Nan"]


def test_own_null_tokens(spark, tmp_path):
    ref = put(tmp_path / "a.csv", "id,amt\n1,NA\n2,-\n")
    df = read_file(spark, FileRef(ref.path, null_tokens=("-",)))
    assert [r["AMT"] for r in df.orderBy("ID").collect()] == ["NA", None]


def test_quotes_line_breaks_and_short_records(spark, tmp_path):
    text = 'id,txt,n\n1,"a ""b"", c\nsecond line",5\n2,é\n'
    df = read_file(spark, put(tmp_path / "a.csv", text))
    assert [tuple(r) for r in df.orderBy("ID").collect()] == [("1", 'a "b", c\nsecond line', "5"), ("2", "é", None)]


@pytest.mark.parametrize("name,text,code", [
    ("missing.csv", None, "FILE_NOT_FOUND"), ("empty.csv", "", "FILE_EMPTY"), ("a.txt", "x\n1\n", "FILE_TYPE_UNSUPPORTED"),
    ("two.csv", "a,A\n1,2\n", "DUPLICATE_COLUMN"),
])
def test_file_errors(spark, tmp_path, name, text, code):
    if text is not None:
        (tmp_path / name).write_text(text)
    with pytest.raises(DatasetError) as e:
        read_file(spark, FileRef(str(tmp_path / name)))
    assert e.value.code == code


def test_record_with_too_many_fields_fails_the_pair(spark, tmp_path):
    bad = put(tmp_path / "bad.csv", "a,b\n1,2\n3,4,5\n")
    good = put(tmp_path / "good.csv", "a,b\n1,2\n3,4\n")
    row = run_pair(spark, PairSpec(good, bad)).report.collect()
    assert len(row) == 1 and row[0]["Validation_Result"] == "Fail" and "FILE_MALFORMED" in row[0]["Reason"]


def test_two_files_have_no_datatype_rows(spark, tmp_path):
    a = put(tmp_path / "a.csv", "id,flag,day\n1,True,2024-01-31\n2,0,2024-02-01\n")
    b = put(tmp_path / "b.csv", "day,flag,id\n01/31/2024,1,1.0\n02/01/2024,false,2\n")
    rows = run_pair(spark, PairSpec(a, b)).report.collect()
    assert [(r["Validation_type"], r["Validation_Result"]) for r in rows] == [
        ("Count validation", "Pass"), ("Data Validation", "Pass"), ("Duplicate Validation", "Pass")]


def test_catalog_tables(spark):
    spark.sql("drop table if exists tl_items")
    spark.createDataFrame([(1, "x")], "id int, name string").write.saveAsTable("tl_items")
    ref = TableRef("TL_ITEMS")
    assert table_exists(spark, ref) and not table_exists(spark, TableRef("TL_NOPE"))
    assert list_columns(spark, ref) == ["ID", "NAME"] and "TL_ITEMS" in list_tables(spark)
    assert read_table(spark, ref).columns == ["ID", "NAME"]
    with pytest.raises(DatasetError):
        read_table(spark, TableRef("TL_NOPE"))


def test_manifest_goes_on_after_a_bad_pair(spark, tmp_path):
    put(tmp_path / "a.csv", "id,v\n1,x\n2,y\n")
    put(tmp_path / "b.csv", "id,v\n1,x\n2,z\n")
    blank = dict.fromkeys(MANIFEST_COLUMNS)
    pairs = [
        {**blank, "SourceFilePath": f"{tmp_path}/a.csv", "TargetFilePath": f"{tmp_path}/nope.csv"},
        {**blank, "SourceTable": "tl_nope", "TargetFilePath": f"{tmp_path}/a.csv"},
        {**blank, "SourceTable": " ", "TargetFilePath": f"{tmp_path}/a.csv"},
        {**blank, "SourceFilePath": f"{tmp_path}/a.csv", "TargetFilePath": f"{tmp_path}/b.csv", "SourceColumns": "id, v"},
    ]
    manifest = spark.createDataFrame([tuple(p[c] for c in MANIFEST_COLUMNS) for p in pairs],
                                     ", ".join(f"{c} string" for c in MANIFEST_COLUMNS))
    rows = run_manifest(spark, manifest, RunConfig(max_error_records=1)).collect()
    reasons = [r["Reason"] for r in rows]
    assert sum("FILE_NOT_FOUND" in r for r in reasons) == 1
    assert sum("TABLE_NOT_FOUND" in r for r in reasons) == 1
    assert sum("BAD_MANIFEST" in r for r in reasons) == 1
    assert "mismatched data: source V = y, target V = z for key Id = 2" in reasons


def test_sinks_append(spark, tmp_path):
    src = spark.createDataFrame([(1, 'quote " and, comma')], "id int, v string")
    tgt = spark.createDataFrame([(1, "it's")], "id int, v string")
    rows = run_pair(spark, PairSpec(src, tgt, labels=("S", "T"))).report
    n = rows.count()
    want = sorted(r["Reason"] for r in rows.collect())
    for _ in range(2):
        reports.write_report(rows, RunConfig(output_type="CSV", output_path=f"{tmp_path}/csv"))
        reports.write_report(rows, RunConfig(output_type="PARQUET", output_path=f"{tmp_path}/pq"))
    back = spark.read.csv(f"{tmp_path}/csv", header=True, escape='"')
    assert back.columns == rows.columns and back.count() == 2 * n
    assert sorted(r["Reason"] or "" for r in back.collect()) == sorted(want * 2)
    assert spark.read.parquet(f"{tmp_path}/pq").count() == 2 * n
    spark.sql("drop table if exists tl_report")
    for _ in range(2):
        reports.write_report(rows, RunConfig(output_type="TABLE", output_table="tl_report"))
    assert spark.table("tl_report").count() == 2 * n
    with pytest.raises(DatasetError):
        reports.write_report(rows, RunConfig(output_type="CSV"))


def test_command_line(spark, tmp_path):
    from twinledger.__main__ import main

    put(tmp_path / "a.csv", "id,v\n1,x\n2,y\n")
    put(tmp_path / "b.csv", "id,v\n1,x\n2,z\n")
    put(tmp_path / "map.csv", "SQLServer,Snowflake\nint,number\n")
    header = ",".join(MANIFEST_COLUMNS)
    put(tmp_path / "pairs.csv", f"{header}\n,,,{tmp_path}/a.csv,,,,,{tmp_path}/b.csv,\n")
    main(["--manifest", f"{tmp_path}/pairs.csv", "--mapping", f"{tmp_path}/map.csv",
          "--output", f"{tmp_path}/out", "--examples", "1"])
    back = spark.read.csv(f"{tmp_path}/out", header=True, escape='"')
    assert {r["Validation_Result"] for r in back.where("Validation_type = 'Data Validation'").collect()} == {"Fail"}


def test_without_a_shared_folder_rows_are_cached(spark, tmp_path, monkeypatch):
    from twinledger import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: None)
    src = spark.createDataFrame([(i, i % 3) for i in range(50)], "id int, v int")
    tgt = spark.createDataFrame([(i, i % 4) for i in range(50)], "id int, v int")
    staged = session.Staged(src)
    assert staged.frame.storageLevel.useDisk and staged.frame.count() == 50
    staged.release()
    result = run_pair(spark, PairSpec(src, tgt), RunConfig(max_error_records=1))
    assert result.key.columns == ("ID",)
    assert "VALUE_MISMATCH" in {r["code"] for r in result.findings.collect()}


def test_shared_folder_is_read_from_the_session(spark, tmp_path):
    from twinledger import session

    before = spark.conf.get("spark.checkpoint.dir", None)
    try:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    except Exception:  # fixed for the life of the session: then it must be the one used
        root = before
    else:
        root = str(tmp_path)
    try:
        assert session.shared_dir(spark) == root
        staged = session.Staged(spark.range(5))
        assert staged.frame.count() == 5 and root in staged.frame.inputFiles()[0]
        staged.release()
    finally:
        if root != before and before is not None:
            spark.conf.set("spark.checkpoint.dir", before)


def manifest_of(spark, *pairs):
    blank = dict.fromkeys(MANIFEST_COLUMNS)
    return spark.createDataFrame([tuple({**blank, **p}[c] for c in MANIFEST_COLUMNS) for p in pairs],
                                 ", ".join(f"{c} string" for c in MANIFEST_COLUMNS))


def test_database_without_a_driver_beside_a_good_pair(spark, tmp_path):
    put(tmp_path / "a.csv", "id,v\n1,x\n2,y\n")
    table = {"TargetDB": "db", "TargetSchema": "dbo", "TargetTable": "t", "SourceFilePath": f"{tmp_path}/a.csv"}
    manifest = manifest_of(spark, table, {"SourceFilePath": f"{tmp_path}/a.csv", "TargetFilePath": f"{tmp_path}/a.csv"})
    config = RunConfig(target_type=SQLSERVER, target_connection=SqlServerConnection("nowhere:1", "u", "p"))
    rows = run_manifest(spark, manifest, config).collect()
    assert [r["Validation_Result"] for r in rows] == ["Fail", "Pass", "Pass", "Pass"] and "JOB_FAILED" in rows[0]["Reason"]


def test_rows_are_handed_over_as_pairs_end(spark, tmp_path):
    put(tmp_path / "a.csv", "id,v\n1,x\n2,y\n")
    same = {"SourceFilePath": f"{tmp_path}/a.csv", "TargetFilePath": f"{tmp_path}/a.csv"}
    seen = []
    out = run_manifest(spark, manifest_of(spark, same, {**same, "TargetFilePath": f"{tmp_path}/no.csv"}, same), RunConfig(concurrent_pairs=1),
                       on_report=lambda rows: seen.append([r["execution_time"] for r in rows.collect()]))
    assert [len(s) for s in seen] == [3, 1, 3] and seen[0][0] <= seen[1][0] <= seen[2][0]
    assert [r["execution_time"] for r in out.collect()] == [x for s in seen for x in s] == [r["execution_time"] for r in out.collect()]


def test_systems_that_need_a_mapping_go_without_one(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    rows = run_pair(spark, PairSpec(df, df, source_system=SQLSERVER, target_system=SNOWFLAKE)).report.collect()
    assert {r["Validation_type"]: r["Validation_Result"] for r in rows} == {
        "Count validation": "Pass", "Data Validation": "Pass", "Datatype Validation": "Fail", "Duplicate Validation": "Pass"}
    assert any("no type mapping for Id, V" in r["Reason"] for r in rows)


def test_mapping_from_a_file(spark, tmp_path):
    put(tmp_path / "map.csv", "SQLServer,Snowflake\nint,number\n Varchar ,Text\n")
    assert sorted(map(tuple, read_mapping(spark, f"{tmp_path}/map.csv").collect())) == [("INT", "NUMBER"), ("VARCHAR", "TEXT")]
    put(tmp_path / "bad.csv", "a,b\n1,2\n")
    with pytest.raises(DatasetError):
        read_mapping(spark, f"{tmp_path}/bad.csv")


def test_csv_is_split_where_no_field_holds_a_line_break(spark, tmp_path):
    line = ",".join(["some words here"] * 6) + ',"quoted, with ""marks"""'
    text = "a,b,c,d,e,f,g\n" + (line + "\n") * 400_000
    big = put(tmp_path / "big.csv", text)
    df = read_file(spark, big)
    assert df.rdd.getNumPartitions() > 4 and df.count() == 400_000
    put(tmp_path / "broken.csv", text + '1,2,3,4,5,6,"a\nb"\n')
    whole = read_file(spark, FileRef(f"{tmp_path}/broken.csv"))
    assert spark.read.text(f"{tmp_path}/broken.csv").rdd.getNumPartitions() > 4 and whole.count() == 400_001 and whole.where("G = 'a\nb'").count() == 1


def test_files_of_a_folder_may_order_their_columns_differently(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    put(folder / "1.csv", "a,b\n1,x\n")
    put(folder / "2.csv", "b,a\ny,2\n")
    assert sorted(map(tuple, read_file(spark, FileRef(str(folder))).collect())) == [("1", "x"), ("2", "y")]
    put(folder / "3.csv", "a,c\n3,z\n")
    with pytest.raises(DatasetError) as e:
        read_file(spark, FileRef(str(folder)))
    assert e.value.code == "FILE_HEADERS_DIFFER"


def test_a_table_equals_its_own_csv(spark, tmp_path, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.write.csv(f"{tmp_path}/orders.csv", header=True)
    rows = run_pair(spark, PairSpec(orders, FileRef(f"{tmp_path}/orders.csv"))).report.collect()
    assert {r["Validation_Result"] for r in rows} == {"Pass"}


def test_options_of_the_command_line():
    from twinledger.__main__ import build_config, parse

    config = build_config(parse(["--manifest", "m", "--output", "o", "--date-format", "yyyyMMdd", "--null-token", "-", "--null-token", "?",
                                 "--csv-splittable", "no", "--concurrent-pairs", "9"]), {})
    assert (config.date_formats, config.null_tokens, config.csv_splittable, config.concurrent_pairs) == (("yyyyMMdd",), ("-", "?"), False, 9)
    config = build_config(parse(["--manifest", "m", "--output", "o"]), {})
    assert (config.date_formats, config.null_tokens, config.csv_splittable) == (None, None, None)
