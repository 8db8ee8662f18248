"""Command line: one subcommand per stage.

    spark-submit … or python -m vigilog report EVENTS.csv REPORT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vigilog.operators.forests import TREES
from vigilog.plans import jobs
from vigilog.session import build_session, remove_work
from vigilog.sources.event_store import batch_ledger


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vigilog")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, words: str, *paths: str) -> argparse.ArgumentParser:
        command = stages.add_parser(name, help=words)
        for path in paths:
            command.add_argument(path)
        return command

    stage("report", "grouped analyses as text", "source", "output")
    ingest = stage("ingest", "dropped CSV files into the event store", "drops", "store", "checkpoint")
    live = stage("live", "dashboard counts kept over dropped CSV files", "drops", "snapshots", "checkpoint")
    for command in (ingest, live):
        command.add_argument("--every", help="trigger interval; without it, take what is there and stop")
        command.add_argument("--max-files", type=int, help="files per micro-batch")
        command.add_argument("--models", help="use the model saved there")
    stage("features", "fit and save the feature pipeline", "source", "models")
    train = stage("train", "train, evaluate and save the classifiers", "source", "models")
    train.add_argument("--trees", type=int, default=TREES, help="trees of either forest")
    charts = stage("dashboard", "every dashboard dataset as Parquet", "source", "output")
    charts.add_argument("--models", help="use the model saved there")
    charts.add_argument("--snapshots", help="take the counts from the live snapshots there")
    for command in stages.choices.values():
        streamed = command in (ingest, live)
        command.add_argument(
            "--multiline",
            action=argparse.BooleanOptionalAction,
            default=True if streamed else None,
            help="whether CSV cells may hold line breaks, which makes a file one task"
            + ("" if streamed else "; by default a scan of the text finds out"),
        )
    return parser.parse_args()


def main() -> None:
    chosen = vars(arguments())
    stage = chosen.pop("stage")
    spark = build_session(f"vigilog-{stage}")
    try:
        run(spark, stage, chosen)
    finally:
        remove_work(spark)


def run(spark: SparkSession, stage: str, chosen: dict) -> None:
    if stage == "report":
        for row in jobs.run_report(spark, **chosen).orderBy("section", "ord").collect():
            print(row.line)
    elif stage == "ingest":
        jobs.run_ingest(spark, **chosen).awaitTermination()
        batch_ledger(spark, chosen["store"]).orderBy("stream_id", "batch_id").show(1000, truncate=False)
    elif stage == "live":
        jobs.run_live(spark, **chosen).awaitTermination()
    elif stage == "features":
        jobs.run_features(spark, **chosen).show(truncate=80)
    elif stage == "train":
        for name, report in jobs.run_training(spark, **chosen).items():
            print(name)
            report.orderBy("kind", "name").show(truncate=False)
    else:
        for name, frame in jobs.run_dashboard(spark, **chosen).items():
            print(name)
            frame.show(truncate=False)


if __name__ == "__main__":
    main()
