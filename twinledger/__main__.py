"""Validate a manifest of pairs:

    python -m twinledger --manifest pairs.csv --output report --examples 10
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from twinledger.model import SNOWFLAKE, SPARK, SQLSERVER, RunConfig
from twinledger.plans.pair import run_manifest
from twinledger.sinks.ledger import Ledger
from twinledger.sinks.reports import write_report
from twinledger.sources.control import read_control, read_mapping
from twinledger.sources.jdbc import SnowflakeConnection, SqlServerConnection

CONNECTIONS = {SQLSERVER: SqlServerConnection, SNOWFLAKE: SnowflakeConnection}


def connection(kind: str, settings: dict | None):
    return CONNECTIONS[kind](**settings) if kind in CONNECTIONS and settings else None


def build_config(args, settings: dict) -> RunConfig:
    return RunConfig(
        source_type=args.source_type, target_type=args.target_type, output_type=args.output_type,
        output_path=args.output if args.output_type in ("CSV", "PARQUET") else None,
        output_table=None if args.output_type in ("CSV", "PARQUET") else args.output,
        source_connection=connection(args.source_type, settings.get("source")),
        target_connection=connection(args.target_type, settings.get("target")),
        output_connection=connection(args.output_type, settings.get("output")),
        max_error_records=args.examples,
        date_formats=tuple(args.date_format) if args.date_format else None,
        null_tokens=tuple(args.null_token) if args.null_token is not None else None,
        csv_splittable={"auto": None, "yes": True, "no": False}[args.csv_splittable],
        csv_quarantine=args.csv_quarantine,
        concurrent_pairs=args.concurrent_pairs,
    )


def parse(argv=None):
    p = argparse.ArgumentParser(prog="twinledger", description="Validate source/target pairs")
    p.add_argument("--manifest", required=True, help="CSV, JSON, Parquet path or table of pairs")
    p.add_argument("--mapping", help="datatype mapping, for pairs across systems")
    p.add_argument("--source-type", default=SPARK, choices=[SPARK, SQLSERVER, SNOWFLAKE])
    p.add_argument("--target-type", default=SPARK, choices=[SPARK, SQLSERVER, SNOWFLAKE])
    p.add_argument("--output-type", default="CSV", choices=["CSV", "PARQUET", "TABLE", SQLSERVER, SNOWFLAKE])
    p.add_argument("--output", required=True, help="path, table, or database.schema.table")
    p.add_argument("--examples", type=int, default=10, help="mismatch examples per column")
    p.add_argument("--connections", help="JSON file with source/target/output connection settings")
    p.add_argument("--date-format", action="append", help="accepted date layout, in the order of the options; instead of the built-in ones")
    p.add_argument("--null-token", action="append", help="text that stands for a missing value in CSV; instead of the built-in ones")
    p.add_argument("--csv-splittable", default="auto", choices=["auto", "yes", "no"], help="may a CSV file be read by many tasks: no quoted field holds a line break")
    p.add_argument("--csv-quarantine", action="store_true", help="set broken CSV records aside and report them instead of failing the pair")
    p.add_argument("--concurrent-pairs", type=int, default=4, help="pairs in work at once")
    p.add_argument("--ledger", help="folder that keeps which pairs of a run are done; a rerun under the same name goes on behind them")
    p.add_argument("--run", default="run", help="name of the run in the ledger")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse(argv)
    settings = {}
    if args.connections:
        with open(args.connections, encoding="UTF-8") as f:
            settings = json.load(f)
    spark = SparkSession.builder.appName("twinledger").getOrCreate()
    config = build_config(args, settings)
    mapping = read_mapping(spark, args.mapping) if args.mapping else None
    manifest = read_control(spark, args.manifest)
    if args.ledger:
        run_manifest(spark, manifest, config, mapping, ledger=Ledger(spark, args.ledger, args.run),
                     on_commit=lambda rows, name: write_report(rows, config, once=name))
    else:
        run_manifest(spark, manifest, config, mapping, on_report=lambda rows: write_report(rows, config))


if __name__ == "__main__":
    main()
