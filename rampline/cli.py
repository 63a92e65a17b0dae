"""Command line: one subcommand per stage, each meant to be its own job task."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from datetime import timedelta

from rampline.naming import Layout
from rampline.operators.joins import BROADCAST_BYTES
from rampline.session import get_session
from rampline.streaming.stages import Pipeline, run_bronze, run_gold, run_silver

# Required options per stage, and where each goes in the pipeline.
REQUIRED = {
    "bronze": (
        "catalog",
        "bronze-schema",
        "landing-volume",
        "bronze-table",
        "ops-schema",
        "ops-volume",
        "pipeline-run-id",
    ),
    "silver": (
        "catalog",
        "bronze-schema",
        "bronze-table",
        "silver-schema",
        "silver-sensors-table",
        "silver-dbx-metadata-table",
        "silver-tests-table",
        "ops-schema",
        "ops-volume",
        "inc-quarantine-table",
        "out-quarantine-table",
    ),
    "gold": ("catalog", "silver-schema", "gold-schema"),
}

PIPELINE_FIELDS = {
    "bronze_schema": "bronze_schema",
    "silver_schema": "silver_schema",
    "gold_schema": "gold_schema",
    "ops_schema": "ops_schema",
    "landing_volume": "landing_volume",
    "ops_volume": "ops_volume",
    "bronze_table": "bronze_table",
    "silver_sensors_table": "fact_table",
    "silver_tests_table": "tests_table",
    "silver_dbx_metadata_table": "files_table",
    "inc_quarantine_table": "incoming_quarantine",
    "out_quarantine_table": "outgoing_quarantine",
    "mart_table": "mart_table",
    "format": "fmt",
}

DEFAULT_DEVICE = "ASUS_ProArt_P16_(H7606)"
DEFAULT_MART = "mart_proart_p16_h7606wv"


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rampline")
    stages = parser.add_subparsers(dest="stage", required=True)
    for stage, names in REQUIRED.items():
        options = stages.add_parser(stage)
        for name in names:
            options.add_argument(f"--{name}", required=True)
        options.add_argument("--root", default="/Volumes", help="where the volumes are mounted")
        options.add_argument("--table-root", help="where external tables are kept; managed tables if unset")
        options.add_argument("--format", default="parquet")
        if stage != "gold":
            options.add_argument("--max-bytes", help="most input per micro-batch, 64g unless given")
            options.add_argument("--max-files", type=int, help="most files per micro-batch")
        if stage == "bronze":
            options.add_argument(
                "--infer-schema",
                action=argparse.BooleanOptionalAction,
                default=True,
                help="add new fields as columns",
            )
            options.add_argument("--archive", help="where landing files move that are done with; they stay if unset")
            options.add_argument("--infer-since", help="look only at files modified after, such as 2026-01-02T00:00:00")
        if stage == "silver":
            options.add_argument("--strict-numbers", action="store_true", help="name values that are no numbers")
        if stage == "gold":
            options.add_argument("--broadcast-bytes", type=int, default=BROADCAST_BYTES, help="most that is broadcast")
            options.add_argument("--device", default=DEFAULT_DEVICE)
            options.add_argument("--mart-table", default=DEFAULT_MART)
            options.add_argument("--rampup-minutes", type=float, default=10.0)
    return parser


def pipeline_of(args: argparse.Namespace) -> Pipeline:
    given = vars(args)
    fields = {field: given[option] for option, field in PIPELINE_FIELDS.items() if option in given}
    for schema in ("bronze_schema", "silver_schema", "gold_schema", "ops_schema"):
        fields.setdefault(schema, "default")
    return Pipeline(layout=Layout(args.catalog, args.root, args.table_root), **fields)


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = get_session()
    pipeline = pipeline_of(args)
    if args.stage == "bronze":
        run_bronze(
            spark,
            pipeline,
            args.pipeline_run_id,
            infer_schema=args.infer_schema,
            infer_since=args.infer_since,
            max_bytes=args.max_bytes,
            max_files=args.max_files,
            archive=args.archive,
        )
    elif args.stage == "silver":
        run_silver(
            spark,
            pipeline,
            max_bytes=args.max_bytes,
            max_files=args.max_files,
            strict_numbers=args.strict_numbers,
        )
    else:
        run_gold(spark, pipeline, args.device, timedelta(minutes=args.rampup_minutes), args.broadcast_bytes)


if __name__ == "__main__":
    main()
