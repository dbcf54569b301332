"""Command line of the jobs, for spark-submit.

    jobs.py ingest   --store S --messages PATH --feed NAME [--follow]
    jobs.py ingest   --store S --servers H:P --topic T --feed NAME [--max-per-batch N] [--follow]
    jobs.py publish  DATASET --out PATH | --servers H:P --topic T [--start-row N] [--limit N]
    jobs.py score    --store S [--run-type T] [--window-cycles N] [--use-trained-model --model PATH] [--respect-schedule]
    jobs.py export   --store S --table NAME --output PATH [--order-by COLUMN] [--level L] [--engines TEXT]
    jobs.py train    --csv PATH [PATH ...] --model PATH [--kind forest|boosted]
    jobs.py report   --store S NAME [--output PATH]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from gearwatch import schema as S
from gearwatch.functions.messages import encode_messages
from gearwatch.operators import ml
from gearwatch.operators.metrics import class_report
from gearwatch.plans import reports, totals
from gearwatch.plans.model_run import run_trained_model
from gearwatch.plans.rule_run import run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.session import build_session, scratch_folder
from gearwatch.sources import files, kafka
from gearwatch.streaming.ingest import ingest_stream, read_message_files

TABLES = ("raw", "processed", "predictions", "alerts", "runs", "ingests", "quarantine")


def table(store: Store, name: str) -> DataFrame:
    """Current rows of a table; the raw and processed ids are also shown as ``id``."""
    if name not in TABLES:
        raise ValueError(f"no table {name!r}; known: {', '.join(TABLES)}")
    rows = getattr(store, name)()
    if name == "raw":
        return rows.withColumnRenamed("raw_id", "id")
    return rows.select(F.col("raw_id").alias("id"), "*") if name == "processed" else rows


def report(store: Store, name: str) -> DataFrame:
    """One of the operator reports by name."""
    known = {
        "counts": lambda: totals.headline_counts(store),
        "levels": lambda: totals.risk_distribution(store),
        "status": lambda: totals.engine_status(store),
        "latest": lambda: reports.latest_predictions(store.predictions()),
        "runs": lambda: reports.latest_runs(store.runs()),
        "alerts": lambda: reports.active_alerts(store.alerts()),
        "sources": lambda: reports.rows_per_source(store.raw()),
        "raw": lambda: reports.latest_raw(store.raw()),
        "checkpoint": store.checkpoints,
    }
    if name not in known:
        raise ValueError(f"no report {name!r}; known: {', '.join(known)}")
    return known[name]()


def publish(spark: SparkSession, args: argparse.Namespace) -> int:
    """Send a slice of a dataset as messages to a broker or a folder; returns the number of rows."""
    dataset = args.dataset.upper()
    path = files.dataset_path(dataset, any_path=args.path, folder=args.folder)
    rows = files.replay_lines(spark, path, args.start_row, args.limit).withColumn(S.SOURCE, F.lit(dataset))
    if args.servers:
        kafka.publish(rows, args.servers, args.topic, dataset)
    else:
        wire = encode_messages(rows, dataset, keep=["line"])
        wire.select(F.col("line").alias("arrival_seq"), F.col("value").alias("body")).write.mode("append").parquet(args.out)
    return rows.count()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gearwatch")
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest")
    ingest.add_argument("--store", required=True)
    ingest.add_argument("--messages")
    ingest.add_argument("--servers")
    ingest.add_argument("--topic", default="sensor-data")
    ingest.add_argument("--feed", default="main")
    ingest.add_argument("--default-source", default="UNKNOWN")
    ingest.add_argument("--max-per-batch", type=int)
    ingest.add_argument("--follow", action="store_true", help="keep running instead of stopping when drained")

    send = commands.add_parser("publish")
    send.add_argument("dataset")
    send.add_argument("--path")
    send.add_argument("--folder", default="data")
    send.add_argument("--start-row", type=int, default=1)
    send.add_argument("--limit", type=int)
    send.add_argument("--servers")
    send.add_argument("--topic", default="sensor-data")
    send.add_argument("--out")

    score = commands.add_parser("score")
    score.add_argument("--store", required=True)
    score.add_argument("--run-type", default="manual")
    score.add_argument("--window-cycles", type=int, default=S.CONTEXT_ROWS)
    score.add_argument("--use-trained-model", action="store_true")
    score.add_argument("--model")
    score.add_argument("--limit", type=int)
    score.add_argument("--respect-schedule", action="store_true")

    export = commands.add_parser("export")
    export.add_argument("--store", required=True)
    export.add_argument("--table", default="processed", choices=TABLES)
    export.add_argument("--output", required=True)
    export.add_argument("--order-by", default="id", help="empty for no order")
    export.add_argument("--level", help="of the newest predictions, as the table on screen shows them")
    export.add_argument("--engines", help="engine numbers and ranges of the newest predictions, such as 3, 10-20")

    train = commands.add_parser("train")
    train.add_argument("--csv", nargs="+", required=True)
    train.add_argument("--model", required=True)
    train.add_argument("--kind", choices=("forest", "boosted"), default="boosted")

    show = commands.add_parser("report")
    show.add_argument("--store", required=True)
    show.add_argument("name")
    show.add_argument("--output", help="write CSV there instead of printing all rows")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session()
    if args.command == "publish":
        print(f"published rows={publish(spark, args)}")
        return 0
    if args.command == "train":
        rows = files.union_exports([files.read_csv(spark, path, infer=False) for path in args.csv])
        rows = ml.with_label(ml.numeric_inputs(rows, [*S.MODEL_INPUTS, S.ENGINE, "demo_rul"], []))
        path = scratch_folder(spark, "training")
        rows.select(S.ENGINE, "label", *S.MODEL_INPUTS).write.parquet(path)
        learn, test = ml.split_engines(spark.read.parquet(path))
        model = ml.train(learn, ml.boosted() if args.kind == "boosted" else ml.forest())
        ml.save_model(model, args.model)
        class_report(model.transform(test)).show()
        return 0
    store = Store(spark, args.store).create()
    if args.command == "ingest":
        source = (kafka.read_stream(spark, args.servers, args.topic, args.max_per_batch) if args.servers
                  else read_message_files(spark, args.messages, args.max_per_batch or 1))
        ingest_stream(store, source, args.feed, f"{store.root}/offsets/{args.feed}",
                      default_source=args.default_source, drain=not args.follow).awaitTermination()
    elif args.command == "score" and args.use_trained_model:
        print(run_trained_model(store, args.model, args.run_type, limit=args.limit, respect_schedule=args.respect_schedule))
    elif args.command == "score":
        print(run_rule_scoring(store, args.run_type, args.window_cycles))
    elif args.command == "export":
        rows = table(store, args.table)
        if args.table == "predictions" and (args.level or args.engines):
            rows = reports.latest_predictions(rows, args.level or "ALL", args.engines or "")
        print(f"rows={files.export_csv(rows, args.output, args.order_by)}")
    elif args.output:
        print(f"rows={files.export_csv(report(store, args.name), args.output, None)}")
    else:
        rows = report(store, args.name)
        print("\t".join(rows.columns))
        for row in rows.toLocalIterator():  # one part at a time, so a report of any length is shown whole
            print("\t".join(map(str, row)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
