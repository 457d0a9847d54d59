"""spark-submit entry point: one job on a JSON file.

``report``, ``dimension`` and ``initial-load`` read their own descriptions; ``incremental`` and
``stream`` publish new files of all ``datasets``, by a ``ledger`` or by a stream's ``checkpoint``;
``compact`` folds the changes of a streamed dimension (``path``, ``changes``, ``join_keys``,
``order_by``) into its base.
"""

from __future__ import annotations

import argparse
import datetime
import logging
import sys

from pyspark.sql import SparkSession

from tierwise.plans.dimension import initial_load, merge_dimension
from tierwise.plans.incremental import ingest_new
from tierwise.plans.report import run_report
from tierwise.sources.ledger import Claims, FileLedger
from tierwise.spec import DatasetSpec, ReportSpec, ScdSpec, as_tuple, load_json
from tierwise.streaming.ingest import stream_to_silver
from tierwise.streaming.merge import StreamedDimension

log = logging.getLogger(__name__)


def report(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    run_report(
        spark,
        ReportSpec.from_dict(config),
        metrics_path=args.metrics,
        run_id=args.batch,
        preview=args.preview,
        from_day=args.from_day,
    )


def dimension(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    merge_dimension(spark, ScdSpec.from_dict(config), args.effective, args.quarantine)


def first_load(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    then = config.get("then")
    initial_load(
        spark,
        DatasetSpec.from_dict("first", config["first"]),
        config["gold_path"],
        DatasetSpec.from_dict("then", then) if then else None,
    )


def incremental(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    ledger = FileLedger(spark, config["ledger"])
    batch = args.batch or datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d%H%M%S")
    for name, cfg in config["datasets"].items():
        claims = Claims(spark, f"{config['claims'].rstrip('/')}/{name}", batch) if "claims" in config else None
        log.info("%s: %d new files", name, ingest_new(spark, DatasetSpec.from_dict(name, cfg), ledger, batch, claims))


def stream(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    for name, cfg in config["datasets"].items():
        spec = DatasetSpec.from_dict(name, cfg)
        stream_to_silver(spark, spec, f"{config['checkpoint'].rstrip('/')}/{name}").awaitTermination()


def compact(spark: SparkSession, config: dict, args: argparse.Namespace) -> None:
    keys, order_by = as_tuple(config["join_keys"]), as_tuple(config.get("order_by"))
    rows = StreamedDimension(spark, config["path"], config["changes"], keys, order_by).compact()
    log.info("%s: %s rows", config["path"], rows)


JOBS = {
    "report": report,
    "dimension": dimension,
    "initial-load": first_load,
    "incremental": incremental,
    "stream": stream,
    "compact": compact,
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tierwise")
    parser.add_argument("job", choices=tuple(JOBS))
    parser.add_argument("config", help="path of the job's JSON file")
    parser.add_argument("--effective", type=datetime.date.fromisoformat, help="batch date of a type 2 merge")
    parser.add_argument("--quarantine", help="folder for source rows with an incomplete key")
    parser.add_argument("--preview", type=int, default=0, help="rows of the gold report to show")
    parser.add_argument("--from-day", type=datetime.date.fromisoformat, help="first day of a report run")
    parser.add_argument("--metrics", help="table of the report's aggregates, by run")
    parser.add_argument("--batch", help="name of this run in the ledger or in the metrics; repeat it to rerun")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")

    config = load_json(args.config)
    builder = SparkSession.builder.appName(f"tierwise-{args.job}")
    for key, value in config.get("spark_conf", {}).items():
        builder = builder.config(key, value)
    JOBS[args.job](builder.getOrCreate(), config, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
