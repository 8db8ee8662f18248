"""The stages of the analytics project as jobs over paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigilog.functions.casts import NA_TOKENS, blank_tokens
from vigilog.operators.forests import TREES, CodeForest, load_forest
from vigilog.operators.cleaning import complete_cases
from vigilog.operators.evaluation import printed_report
from vigilog.operators.features import feature_sample, fit_features
from vigilog.operators.scoring import add_predictions, values_seen
from vigilog.plans.dashboard import dashboard, dashboard_rollup, live_dashboard, live_totals
from vigilog.plans.report import report_lines
from vigilog.plans.training import learning_columns, train_code_forest, train_feature_forest
from vigilog.schema import EVENT, STATIC_SCHEMA
from vigilog.session import written
from vigilog.sinks.models import commit_version, current_version, load_pipeline, new_version, save_model
from vigilog.sinks.text_report import write_lines
from vigilog.sources.csv_events import or_empty, raw_events, read_csv_events, stream_raw_csv, typed_events
from vigilog.sources.event_store import ARRIVAL, read_event_store
from vigilog.streaming.ingest import stamp_arrival, start_ingest
from vigilog.streaming.totals import start_totals

PIPELINE, FOREST, SCORER = "feature_pipeline", "spark_rf_model", "scorer"


def is_csv(source: str) -> bool:
    return source.rstrip("/").endswith(("csv", "csv.gz"))


def read_log(spark: SparkSession, source: str, na_tokens=(), multiline: bool | None = None) -> DataFrame:
    """Typed events from CSV files (a path that ends in ``csv``) or from an event store; empty when absent.

    Text among ``na_tokens`` is missing in either; ``multiline`` is for CSV alone.
    """
    if is_csv(source):
        read = lambda: read_csv_events(spark, source, multiline=multiline, na_tokens=na_tokens)
        return typed_events(or_empty(read, spark, STATIC_SCHEMA))
    stored = read_event_store(spark, source)
    return blank_tokens(stored, na_tokens) if na_tokens else stored


def load_scorer(spark: SparkSession, models: str | None) -> CodeForest | None:
    """The current version of the code forest; None where there is none."""
    folder = current_version(spark, f"{models}/{SCORER}") if models else None
    return load_forest(spark, folder) if folder else None


def run_report(spark: SparkSession, source: str, output: str, multiline: bool | None = None) -> DataFrame:
    """Write the grouped report as text and return its lines."""
    lines = written(report_lines(read_log(spark, source, multiline=multiline)), "report")
    write_lines(lines, output)
    return lines


def run_ingest(
    spark: SparkSession,
    drops: str,
    store: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    models: str | None = None,
    multiline: bool = True,
) -> StreamingQuery:
    """Start appending dropped CSV files to the event store, with predictions if there is a model.

    Each file's columns go by its own header. Predictions are made for a micro-batch at a time.
    """
    scorer, events_of = load_scorer(spark, models), raw_events()

    def prepare(raw: DataFrame) -> DataFrame:
        return add_predictions(stamp_arrival(events_of(raw)), scorer)

    raw = stream_raw_csv(spark, drops, multiline=multiline, max_files=max_files)
    return start_ingest(raw, store, checkpoint, every, prepare)


def run_live(
    spark: SparkSession,
    drops: str,
    snapshots: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    models: str | None = None,
    multiline: bool = True,
) -> StreamingQuery:
    """Start keeping the dashboard's results over dropped CSV files, of the values the model sees if there is one.

    The same texts are missing as in ``run_dashboard``, and columns go by each file's header.
    """
    scorer, events_of = load_scorer(spark, models), raw_events(na_tokens=NA_TOKENS)

    def prepare(raw: DataFrame) -> DataFrame:
        return values_seen(stamp_arrival(events_of(raw)), scorer)

    raw = stream_raw_csv(spark, drops, multiline=multiline, max_files=max_files)
    return start_totals(raw, snapshots, checkpoint, live_totals(), every, prepare)


def learning_text(spark: SparkSession, source: str, multiline: bool | None = None) -> DataFrame:
    """Features and target alone, as they were read, in a table: CSV is parsed once, whatever is made of its cells."""
    if is_csv(source):
        rows = or_empty(lambda: read_csv_events(spark, source, multiline=multiline), spark, STATIC_SCHEMA)
    else:
        rows = read_event_store(spark, source)
    return written(rows.select(*learning_columns(EVENT, None)), "learning-text")


def learning_rows(text: DataFrame, na_tokens=()) -> DataFrame:
    return typed_events(blank_tokens(text, na_tokens) if na_tokens else text)


def run_features(spark: SparkSession, source: str, models: str, multiline: bool | None = None) -> DataFrame:
    """Fit and save the feature pipeline; returns a few transformed rows."""
    rows = written(complete_cases(learning_rows(learning_text(spark, source, multiline))), "features")
    pipeline = fit_features(rows)
    save_model(pipeline, f"{models}/{PIPELINE}")
    return feature_sample(rows, pipeline)


def run_training(
    spark: SparkSession,
    source: str,
    models: str,
    trees: int = TREES,
    multiline: bool | None = None,
) -> dict[str, DataFrame]:
    """Train and save both classifiers; returns their reports. The second needs the saved feature pipeline.

    A new version of a model counts when it is whole; jobs that score meanwhile read the one before.
    """
    text = learning_text(spark, source, multiline)
    version = new_version(spark, f"{models}/{SCORER}")
    coded = train_code_forest(learning_rows(text, NA_TOKENS), trees=trees, folder=version)
    commit_version(spark, version)
    reports = {SCORER: printed_report(coded.confusion)}

    pipeline = load_pipeline(spark, f"{models}/{PIPELINE}")
    if pipeline is not None:
        trained = train_feature_forest(learning_rows(text), pipeline=pipeline, trees=trees)
        save_model(trained.forest, f"{models}/{FOREST}")
        reports[FOREST] = printed_report(trained.confusion)
    return reports


def run_dashboard(
    spark: SparkSession,
    source: str,
    output: str,
    models: str | None = None,
    snapshots: str | None = None,
    multiline: bool | None = None,
) -> dict[str, DataFrame]:
    """Compute every dashboard dataset once and write each as Parquet; nothing for an empty log.

    With the ``snapshots`` of a live job all of them come from its last whole batch and the log isn't read; else
    from the log, the counts in one pass.
    """
    scorer = load_scorer(spark, models)
    if snapshots:
        datasets = live_dashboard(spark, snapshots, scorer=scorer)
    else:
        events = read_log(spark, source, NA_TOKENS, multiline)
        if events.isEmpty():
            return {}
        rolled = written(dashboard_rollup(values_seen(events, scorer)), "rollup")
        arrival = [c for c in ARRIVAL if c in events.columns] or [EVENT.timestamp]
        datasets = dashboard(events, rolled, arrival, scorer=scorer)
    for name, frame in datasets.items():
        frame.write.mode("overwrite").parquet(f"{output}/{name}")
    return {name: spark.read.parquet(f"{output}/{name}") for name in datasets}
