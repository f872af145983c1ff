"""A run that stops between its pairs goes on where it stopped and writes nothing twice."""

import pytest

from tests.test_files import manifest_of, put
from twinledger.model import DatasetError, RunConfig
from twinledger.plans import pair as P
from twinledger.sinks.ledger import Ledger, append_once
from twinledger.sinks.reports import write_report


def pairs_of(tmp_path):
    for name, text in (("a", "id,v\n1,x\n2,y\n"), ("b", "id,v\n1,x\n2,z\n"), ("c", "id,v\n1,x\n")):
        put(tmp_path / f"{name}.csv", text)
    path = lambda n: f"{tmp_path}/{n}.csv"
    return [{"SourceFilePath": path(a), "TargetFilePath": path(b)} for a, b in (("a", "a"), ("a", "b"), ("b", "c"), ("a", "no"))]


@pytest.mark.parametrize("kind", ["CSV", "PARQUET"])
def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch, kind):
    manifest = manifest_of(spark, *pairs_of(tmp_path))
    config = RunConfig(concurrent_pairs=1, output_type=kind, output_path=f"{tmp_path}/out", max_error_records=1)
    validated, stop = [], {"at": 1}
    run_pair = P.run_pair
    monkeypatch.setattr(P, "run_pair", lambda *a, **k: validated.append(1) or run_pair(*a, **k))

    def deliver(rows, name):
        if stop["at"] == 0:
            raise RuntimeError("lost")  # before anything of this pair is written
        write_report(rows, config, once=name)
        stop["at"] -= 1
        if stop["at"] == 0 and stop.pop("between", None):
            raise RuntimeError("lost")  # written, but not marked

    def go():
        return P.run_manifest(spark, manifest, config, ledger=Ledger(spark, f"{tmp_path}/ledger", "night"), on_commit=deliver)

    with pytest.raises(RuntimeError):
        go()
    stop |= {"at": 1, "between": True}
    with pytest.raises(RuntimeError):
        go()
    stop |= {"at": 99}
    report = go().collect()
    assert len(validated) == 4  # each pair once, whatever stopped
    back = spark.read.csv(f"{tmp_path}/out", header=True, escape='"') if kind == "CSV" else spark.read.parquet(f"{tmp_path}/out")
    plain = lambda rows: sorted(tuple(x or "" for x in r) for r in rows)
    assert plain(back.collect()) == plain(report) and [r["source_table"][-5] for r in report][0] == "a"
    alone = P.run_manifest(spark, manifest, config).drop("execution_time").collect()
    assert [tuple(r)[:5] for r in report] == [tuple(r) for r in alone]
    assert go().collect() == report and len(validated) == 8
    P.run_manifest(spark, manifest, config, ledger=Ledger(spark, f"{tmp_path}/ledger", "next"))
    assert len(validated) == 12


def test_a_changed_pair_is_validated_again(spark, tmp_path):
    first, second, *_ = pairs_of(tmp_path)
    ledger = Ledger(spark, f"{tmp_path}/ledger", "night")
    run = lambda *p: P.run_manifest(spark, manifest_of(spark, *p), RunConfig(), ledger=ledger).collect()
    one = run(first)
    two = run(second)
    assert {r["Validation_Result"] for r in one} == {"Pass"} and "Fail" in {r["Validation_Result"] for r in two}


def test_names(spark, tmp_path):
    for bad in ("", "a/b", None):
        with pytest.raises(DatasetError):
            Ledger(spark, str(tmp_path), bad)
    rows = spark.createDataFrame([("a",)], "x string")
    for _ in range(2):
        append_once(rows, f"{tmp_path}/o", "n", "PARQUET", {})
    assert spark.read.parquet(f"{tmp_path}/o").count() == 1
