"""The registered queries: every operator over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.casts import NA_TOKENS
from vigilog.operators import counting, evaluation, features, labels, ranking, splitting
from vigilog.operators.cleaning import fill_missing, project_existing
from vigilog.operators.forests import PREDICTED, CodeForest, load_forest
from vigilog.operators.grid import grid_histogram
from vigilog.operators.scoring import CONFIDENCE, add_predictions, coded_events, known_codes, score_events
from vigilog.plans import dashboard as board
from vigilog.plans.event_view import VIEW, canonical_log, read_events, sec_all, sec_complete, sec_log, stream_events
from vigilog.plans.report import report_lines, section_lines
from vigilog.plans.training import train_code_forest, train_feature_forest
from vigilog.schema import EMITTED, EVENT, EVENT_COLUMNS
from vigilog.session import work_folder
from vigilog.sinks.models import commit_version, current_version, load_pipeline, new_version, save_model
from vigilog.sources.csv_events import QUOTING, raw_events, read_csv_events, stream_csv_events, stream_raw_csv, typed_events
from vigilog.sources.event_store import batch_ledger, latest_rows, read_event_store
from vigilog.streaming.ingest import stamp_arrival, start_ingest
from vigilog.streaming.live import latest_snapshot, start_snapshots
from vigilog.streaming.totals import Total, start_totals, total_so_far

Query = Callable[[SparkSession, str], DataFrame]

#: Rows per dropped CSV file, about 150 MB: a file with line breaks in cells is one task.
ROWS_PER_FILE = 1_000_000

#: Parts in which the log is dropped where a stream should see several batches.
PARTS = 4


def _all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sec_all(read_events(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sec_log(read_events(spark, sf_dir))


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sec_complete(read_events(spark, sf_dir))


# Grouped analyses


def total(spark, sf_dir):
    return counting.row_total(_log(spark, sf_dir))


def attack_distribution(spark, sf_dir):
    return counting.group_counts(_log(spark, sf_dir), VIEW.attack).orderBy(F.desc("cnt"), VIEW.attack)


def severity_breakdown(spark, sf_dir):
    return counting.group_counts(_log(spark, sf_dir), VIEW.severity).orderBy(F.desc("cnt"), VIEW.severity)


def protocol_packets(spark, sf_dir):
    counts = counting.group_counts(
        _log(spark, sf_dir), VIEW.protocol, avg_packet_length=F.round(F.avg(VIEW.packet_length), 6)
    )
    return counts.orderBy(F.desc("cnt"), VIEW.protocol)


def anomaly_by_attack(spark, sf_dir):
    means = _log(spark, sf_dir).groupBy(VIEW.attack).agg(F.round(F.avg(VIEW.anomaly), 6).alias("avg_anomaly_score"))
    return means.orderBy(F.desc("avg_anomaly_score"), VIEW.attack)


def top_source_ips(spark, sf_dir):
    return ranking.top_values(_log(spark, sf_dir), VIEW.source_ip)


def severity_protocol(spark, sf_dir):
    counts = counting.group_counts(_log(spark, sf_dir), VIEW.severity, VIEW.protocol)
    return ranking.top(counts, 20, VIEW.severity, F.desc("cnt"), VIEW.protocol)


def hourly_trend(spark, sf_dir):
    return counting.hourly_counts(_log(spark, sf_dir), VIEW.timestamp).orderBy("hour")


def kpis(spark, sf_dir):
    return counting.kpis(_all(spark, sf_dir), VIEW)


def kpis_missing_columns(spark, sf_dir):
    return counting.kpis(_all(spark, sf_dir).drop(VIEW.severity, VIEW.anomaly), VIEW)


def value_counts(spark, sf_dir):
    return counting.value_counts(_all(spark, sf_dir), VIEW.protocol)


def severity_counts(spark, sf_dir):
    return counting.value_counts(_all(spark, sf_dir), VIEW.severity)


def category_share(spark, sf_dir):
    return _rounded_share(counting.category_share(_all(spark, sf_dir), VIEW.traffic_type))


def attack_share(spark, sf_dir):
    return _rounded_share(counting.category_share(_all(spark, sf_dir), VIEW.attack))


def _rounded_share(shares: DataFrame) -> DataFrame:
    return shares.withColumn("share", F.round("share", 6))


def anomaly_histogram(spark, sf_dir):
    return counting.histogram(_all(spark, sf_dir), VIEW.anomaly).select("bin", "cnt")


def recent(spark, sf_dir):
    columns = ["event_id", EMITTED, VIEW.source_ip, VIEW.attack, VIEW.severity, VIEW.protocol, VIEW.anomaly, PREDICTED]
    return project_existing(ranking.latest(_all(spark, sf_dir), ["event_id"]), columns)


# Cleaning


def clean_cast(spark, sf_dir):
    return _all(spark, sf_dir).select("event_id", VIEW.anomaly, VIEW.packet_length)


def complete_rows(spark, sf_dir):
    rows = _complete(spark, sf_dir).withColumn(VIEW.packet_length, F.col(VIEW.packet_length).cast("bigint"))
    return rows.select("event_id", *VIEW.numeric)


def fill_policy(spark, sf_dir):
    filled = fill_missing(_all(spark, sf_dir), VIEW)
    packets = F.col(VIEW.packet_length).cast("bigint").alias(VIEW.packet_length)
    return filled.select("event_id", VIEW.anomaly, packets, VIEW.protocol, VIEW.attack)


def quality_counts(spark, sf_dir):
    return counting.quality_counts(_all(spark, sf_dir), VIEW.timestamp, VIEW)


def unseen_fallback(spark, sf_dir):
    rows = _all(spark, sf_dir)
    stored = labels.label_table(rows.filter(F.col(VIEW.protocol) != "ICMP"), [VIEW.protocol], by_frequency=False)
    return known_codes(rows, stored, VIEW.protocol, "code").select("event_id", F.col(VIEW.protocol).alias("protocol_known"))


def _with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed log with some scores that are not a number."""
    score = F.when(F.col("event_id") % 103 == 0, F.lit(float("nan"))).otherwise(F.col(VIEW.anomaly))
    return _all(spark, sf_dir).withColumn(VIEW.anomaly, score)


def nan_fill(spark, sf_dir):
    return fill_missing(_with_nan(spark, sf_dir), VIEW).select("event_id", VIEW.anomaly)


def nan_kpis(spark, sf_dir):
    return counting.kpis(_with_nan(spark, sf_dir), VIEW)


def nan_quality(spark, sf_dir):
    return counting.quality_counts(_with_nan(spark, sf_dir), VIEW.timestamp, VIEW)


# Report


def report_section(spark, sf_dir):
    counts = counting.group_counts(_log(spark, sf_dir), VIEW.severity, VIEW.protocol)
    return section_lines("severity_protocol", counts)


def report_text(spark, sf_dir):
    return report_lines(_all(spark, sf_dir), VIEW, digits=6)


# CSV sources

CSV_OUT = QUOTING | {"maxRecordsPerFile": ROWS_PER_FILE}


def _dropped_csv(spark: SparkSession, sf_dir: str) -> str:
    """The log as CSV files with the event table's header, in the shared work folder."""
    folder = work_folder(spark, "csv")
    canonical_log(read_events(spark, sf_dir)).write.options(**CSV_OUT).csv(folder)
    return folder


def _dropped_in_parts(spark: SparkSession, sf_dir: str, folder: str, parts: Iterable[int], turned: bool = False) -> None:
    """Drop the rows of some of four parts as files of their own; with ``turned``, odd parts have their columns in another order.

    Twenty events at a time have one stamp, five of them in each part.
    """
    stamp = F.date_format(F.timestamp_seconds(F.floor(F.col("User Information").cast("bigint") / 20)), "yyyy-MM-dd HH:mm:ss")
    log = canonical_log(read_events(spark, sf_dir)).withColumn(EMITTED, stamp)
    for part in parts:
        columns = EVENT_COLUMNS[::-1] if turned and part % 2 else EVENT_COLUMNS
        rows = log.filter(F.col("User Information").cast("bigint") % PARTS == part).select(*columns)
        rows.write.mode("append").options(**CSV_OUT).csv(folder)


def _row_id():
    return F.col("User Information").cast("bigint").alias("event_id")


def _scanned(events: DataFrame) -> DataFrame:
    return events.select(
        _row_id(),
        F.col(EVENT.source_ip).alias("src_ip"),
        F.col(EVENT.source_port).alias("src_port"),
        F.col(EVENT.packet_length).alias("packet_len"),
        F.col(EVENT.anomaly).alias("anomaly"),
        F.col("Payload Data").alias("payload"),
    )


def csv_scan(spark, sf_dir):
    return _scanned(typed_events(read_csv_events(spark, _dropped_csv(spark, sf_dir))))


def csv_by_name(spark, sf_dir):
    folder = work_folder(spark, "csv")
    _dropped_in_parts(spark, sf_dir, folder, range(PARTS), turned=True)
    return _scanned(typed_events(read_csv_events(spark, folder)))


def csv_inferred(spark, sf_dir):
    events = read_csv_events(spark, _dropped_csv(spark, sf_dir), infer=True)
    ports = (F.col(EVENT.source_port) + F.col(EVENT.destination_port)).cast("bigint")
    return events.select(_row_id(), ports.alias("ports"), F.col(EVENT.attack).alias("attack_type"))


def csv_na_tokens(spark, sf_dir):
    events = read_csv_events(spark, _dropped_csv(spark, sf_dir), na_tokens=NA_TOKENS)
    names = {EVENT.timestamp: "ts_text", EVENT.packet_length: "packet_text", EVENT.protocol: "protocol"}
    return events.select(_row_id(), *[F.col(c).alias(name) for c, name in names.items()])


# Streaming


def _stored_names(stored: DataFrame) -> DataFrame:
    names = {EVENT.source_ip: "src_ip", EVENT.attack: "attack_type", EVENT.severity: "severity"}
    return stored.select(_row_id(), *[F.col(c).alias(name) for c, name in names.items()])


def stream_ingest(spark, sf_dir):
    drops, store = work_folder(spark, "drops"), work_folder(spark, "store")
    _dropped_in_parts(spark, sf_dir, drops, range(PARTS))
    events = stamp_arrival(stream_csv_events(spark, drops, max_files=1))
    start_ingest(events, store, work_folder(spark, "ingest-checkpoint")).awaitTermination()
    return _stored_names(read_event_store(spark, store))


def stream_by_name(spark, sf_dir):
    drops, store = work_folder(spark, "drops"), work_folder(spark, "store")
    _dropped_in_parts(spark, sf_dir, drops, range(PARTS), turned=True)
    raw = stream_raw_csv(spark, drops, max_files=2)
    start_ingest(raw, store, work_folder(spark, "ingest-checkpoint"), prepare=raw_events()).awaitTermination()
    return _stored_names(read_event_store(spark, store))


def _stored_in_turn(spark: SparkSession, sf_dir: str) -> str:
    """A store whose stream was stopped after each of four parts, and went on from its checkpoint with the next."""
    drops, store, checkpoint = (work_folder(spark, name) for name in ("drops", "store", "ingest-checkpoint"))
    for part in range(PARTS):
        _dropped_in_parts(spark, sf_dir, drops, [part])
        start_ingest(stamp_arrival(stream_csv_events(spark, drops)), store, checkpoint).awaitTermination()
    return store


def store_recent(spark, sf_dir):
    last = latest_rows(spark, _stored_in_turn(spark, sf_dir), board.LATEST_ROWS)
    wanted = project_existing(last, ["User Information", *board.recent_columns()])
    names = {EMITTED: "stamp", EVENT.source_ip: "src_ip", EVENT.attack: "attack_type", EVENT.anomaly: "anomaly"}
    return wanted.select(_row_id(), *[F.col(c).alias(name) for c, name in names.items()])


def batch_counts(spark, sf_dir):
    ledger = batch_ledger(spark, _stored_in_turn(spark, sf_dir))
    return ledger.select("batch_id", "rows", F.col("first").alias("first_stamp"), F.col("last").alias("last_stamp"))


def stream_restart(spark, sf_dir):
    """A stream that takes one file at a time is stopped as soon as it has stored a batch, and goes on from its checkpoint."""
    drops, store, checkpoint = (work_folder(spark, name) for name in ("drops", "store", "ingest-checkpoint"))
    _dropped_in_parts(spark, sf_dir, drops, range(PARTS))
    events = stamp_arrival(stream_csv_events(spark, drops, max_files=1))
    first = start_ingest(events, store, checkpoint, every="10 seconds")  # so long the second file waits
    while first.isActive and not first.recentProgress:
        first.awaitTermination(0.1)
    first.stop()
    start_ingest(events, store, checkpoint).awaitTermination()
    ids = read_event_store(spark, store).select(_row_id(), "stream_id")
    return ids.groupBy("event_id").agg(F.count("*").alias("times"), F.count_distinct("stream_id").alias("streams"))


def _after_stream(spark: SparkSession, totals: DataFrame) -> DataFrame:
    folder = work_folder(spark, "live")
    start_snapshots(totals, folder, work_folder(spark, "live-checkpoint")).awaitTermination()
    return latest_snapshot(spark, folder, totals)


def live_counts(spark, sf_dir):
    stream = sec_all(stream_events(spark, sf_dir))
    totals = counting.group_counts(stream, VIEW.severity, avg_anomaly=F.avg(VIEW.anomaly))
    return _after_stream(spark, totals).withColumn("avg_anomaly", F.round("avg_anomaly", 6))


def _live_total(spark: SparkSession, sf_dir: str, name: str, total: Total | None = None) -> DataFrame:
    """One of the dashboard's live totals (or ``total``) of the log in four files, after a stream over two of them that was
    restarted for a third and then left for another one, with a checkpoint of its own, over all.
    """
    total = total or board.live_totals(VIEW)[name]
    files, folder = work_folder(spark, "files"), work_folder(spark, "live")
    table = read_events(spark, sf_dir)
    checkpoint = work_folder(spark, "live-checkpoint")

    def run(where: str, max_files: int | None = None) -> None:
        found = spark.readStream.schema(table.schema)
        events = sec_all((found.option("maxFilesPerTrigger", max_files) if max_files else found).parquet(files))
        start_totals(events, folder, where, {name: total}).awaitTermination()

    for parts in ((0, 1), (2,)):
        for part in parts:
            table.filter(F.col("event_id") % PARTS == part).write.mode("append").parquet(files)
        run(checkpoint)
    table.filter(F.col("event_id") % PARTS == PARTS - 1).write.mode("append").parquet(files)
    run(work_folder(spark, "live-checkpoint"), max_files=1)
    return total_so_far(spark, folder, name, total)


def live_kpis(spark, sf_dir):
    return board.rolled_kpis(_live_total(spark, sf_dir, "cube"))


def live_attack_share(spark, sf_dir):
    return _rounded_share(board.rolled_share(_live_total(spark, sf_dir, "cube"), "attack")).withColumnRenamed("attack", "attack_type")


def live_protocol_counts(spark, sf_dir):
    return board.rolled_counts(_live_total(spark, sf_dir, "cube"), "protocol")


def live_top_sources(spark, sf_dir):
    return board.live_sources(_live_total(spark, sf_dir, "sources")).withColumnRenamed("source", "src_ip")


def live_histogram(spark, sf_dir):
    """Exact bins need every distinct score: each batch's are stored apart, and the reader sums them."""

    def values(batch: DataFrame, _: int) -> DataFrame:
        return counting.group_counts(batch, VIEW.anomaly, name="rows")

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(VIEW.anomaly).agg(F.sum("rows").alias("rows"))

    scores = _live_total(spark, sf_dir, "scores", Total(values, summed, bounded=False))
    return counting.histogram(scores, VIEW.anomaly, weight="rows").select("bin", "cnt")


def live_grid(spark, sf_dir):
    return grid_histogram(_live_total(spark, sf_dir, "grid"))


def live_recent(spark, sf_dir):
    """The latest rows that a live job keeps, from drops whose stream was restarted after each."""
    drops, folder, checkpoint = (work_folder(spark, name) for name in ("drops", "live", "live-checkpoint"))
    recent_rows = {"recent": board.live_totals()["recent"]}
    for part in range(PARTS):
        _dropped_in_parts(spark, sf_dir, drops, [part], turned=True)
        start_totals(stream_raw_csv(spark, drops), folder, checkpoint, recent_rows, prepare=raw_events()).awaitTermination()
    last = total_so_far(spark, folder, "recent", recent_rows["recent"])
    names = {EMITTED: "stamp", EVENT.source_ip: "src_ip", EVENT.attack: "attack_type", EVENT.anomaly: "anomaly"}
    return last.select(_row_id(), *[F.col(c).alias(name) for c, name in names.items()])


# Features


def freq_index(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    table = labels.label_table(rows, [VIEW.protocol], by_frequency=True)
    return labels.index_by_table(rows, table, VIEW.protocol, "idx").select(VIEW.protocol, "idx").distinct()


def label_index(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    table = labels.label_table(rows, [VIEW.attack], by_frequency=True)
    return labels.index_by_table(rows, table, VIEW.attack, features.LABEL).select("event_id", features.LABEL)


def lex_index(spark, sf_dir):
    rows = fill_missing(_all(spark, sf_dir), VIEW)
    table = labels.label_table(rows, [VIEW.protocol], by_frequency=False)
    return labels.index_by_table(rows, table, VIEW.protocol, "code").select(VIEW.protocol, "code").distinct()


def many_labels(spark, sf_dir):
    """Labels that grow with the log: one for every event, and the addresses."""
    rows = _all(spark, sf_dir).select(F.col("event_id").cast("string").alias("id"), "event_id", VIEW.source_ip)
    for column, by_frequency in (("id", False), (VIEW.source_ip, True)):
        table = labels.label_table(rows, [column], by_frequency)
        rows = labels.index_by_table(rows, table, column, f"{column}_idx")
    return rows.select("event_id", "id_idx", F.col(f"{VIEW.source_ip}_idx").alias("ip_idx"))


def category_codes(spark, sf_dir):
    coded = fill_missing(_all(spark, sf_dir), VIEW)
    outputs = {c: f"{c}_enc" for c in VIEW.categorical} | {VIEW.attack: features.LABEL}
    table = labels.label_table(coded, list(outputs), by_frequency=False)
    for column, code in outputs.items():
        coded = labels.look_up(coded, table, column, code)
    return coded.select("event_id", *[F.col(c).cast("int").alias(c) for c in outputs.values()])


def code_names(spark, sf_dir):
    rows = fill_missing(_all(spark, sf_dir), VIEW)
    table = labels.label_table(rows, [VIEW.attack], by_frequency=False)
    coded = labels.look_up(rows, table, VIEW.attack, "code").select("event_id", "code")
    return labels.names_of(coded, table, VIEW.attack, "code", "name").select("event_id", "name")


def stored_codes(spark, sf_dir):
    """What scoring does with a dictionary that knows two protocols and no other category."""
    rows = _all(spark, sf_dir)
    stored = labels.label_table(rows.filter(F.col(VIEW.protocol).isin("ICMP", "TCP")), [VIEW.protocol], by_frequency=False)
    return coded_events(rows, stored, VIEW).select("event_id", f"{VIEW.protocol}_enc", f"{VIEW.severity}_enc")


def one_hot(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    indexed = features.frequency_indexer(rows, [VIEW.protocol], ["idx"]).transform(rows)
    encoder = features.OneHotEncoder(inputCols=["idx"], outputCols=["encoded"])
    slots = encoder.fit(indexed).transform(indexed).select("event_id", vector_to_array("encoded").alias("slots"))
    return slots.select("event_id", F.posexplode("slots").alias("slot", "value"))


def scaled_measure(spark, sf_dir):
    rows = VectorAssembler(inputCols=[VIEW.anomaly], outputCol="raw").transform(_complete(spark, sf_dir))
    scaled = features.unit_scaler("raw", "scaled").fit(rows).transform(rows)
    return scaled.select("event_id", F.round(vector_to_array("scaled")[0], 4).alias("anomaly_scaled"))


def _vector_slots(featured: DataFrame) -> DataFrame:
    """Every slot of the vector as a row."""
    slots = featured.select("event_id", features.LABEL, F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.withColumn("value", F.round("value", 4))


def feature_vector(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    return _vector_slots(features.fit_features(rows, VIEW).transform(rows))


def saved_pipeline(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    path = work_folder(spark, "pipeline")
    save_model(features.fit_features(rows, VIEW), path)
    return _vector_slots(load_pipeline(spark, path).transform(rows))


def feature_sample(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    return _vector_slots(features.feature_sample(rows, features.fit_features(rows, VIEW), order=["event_id"]))


# Splits, learning, evaluation


def hash_split(spark, sf_dir):
    return _complete(spark, sf_dir).select("event_id", splitting.split_name("event_id").alias("split"))


def random_split(spark, sf_dir):
    """How many sides hold each row: the sizes of this split are chance."""
    train, test = splitting.random_split(_complete(spark, sf_dir))
    return train.union(test).groupBy("event_id").agg(F.count("*").alias("sides"))


def exact_split(spark, sf_dir):
    train, test = splitting.exact_split(_complete(spark, sf_dir).select("event_id", VIEW.attack), "event_id")
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test"))).drop(VIEW.attack)


def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction made from severity by rule, so the metrics need no trained model."""
    rule = F.when(F.col(VIEW.severity) == "High", "error").when(F.col(VIEW.severity) == "Medium", "click").otherwise("view")
    return evaluation.confusion(_log(spark, sf_dir).withColumn("guess", rule), VIEW.attack, "guess")


def class_report(spark, sf_dir):
    report = evaluation.class_report(_rule_scored(spark, sf_dir))
    return report.select("cls", *[F.round(c, 6).alias(c) for c in ("precision_", "recall_", "f1")], "support")


def class_summary(spark, sf_dir):
    summary = evaluation.class_summary(evaluation.class_report(_rule_scored(spark, sf_dir)))
    return summary.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")])


def printed_report(spark, sf_dir):
    report = evaluation.printed_report(_rule_scored(spark, sf_dir))
    return report.select("kind", "name", *[F.round(c, 6).alias(c) for c in ("precision_", "recall_", "f1")], "support")


def forest_spark(spark, sf_dir):
    """The hold-out rows: what a forest says of them has no SQL form but that it is one of its classes."""
    scored = train_feature_forest(_all(spark, sf_dir), VIEW, key="event_id").scored
    known = F.col("prediction").isin(*[float(i) for i in range(6)])
    return scored.select("event_id", features.LABEL, known.alias("known_class"))


def forest_codes(spark, sf_dir):
    scored = train_code_forest(_all(spark, sf_dir), VIEW, key="event_id").scored
    return scored.select("event_id", VIEW.attack, F.col(PREDICTED).isNotNull().alias("known_class"))


def forest_report(spark, sf_dir):
    report = evaluation.printed_report(train_feature_forest(_all(spark, sf_dir), VIEW, key="event_id").confusion)
    shares = [F.col(c).between(0, 1) for c in ("precision_", "recall_", "f1")]
    return report.filter("support > 0").select("kind", "support", (shares[0] & shares[1] & shares[2]).alias("in_range"))


def _checked_scores(scored: DataFrame) -> DataFrame:
    sure = F.col(CONFIDENCE).between(100 / 6, 100) & (F.round(CONFIDENCE, 1) == F.col(CONFIDENCE))
    return scored.select("event_id", VIEW.protocol, F.col(PREDICTED).isNotNull().alias("known_class"), sure.alias("in_range"))


def scored_events(spark, sf_dir):
    events = _all(spark, sf_dir)
    scorer = train_code_forest(events, VIEW, key="event_id").pipeline
    return _checked_scores(score_events(events, scorer, VIEW))


def scored_stream(spark, sf_dir):
    """A scorer is trained into a new version of the model store; the stream loads the current one and scores its batches."""
    models, store = work_folder(spark, "scorers"), work_folder(spark, "scored")
    version = new_version(spark, models)
    train_code_forest(_all(spark, sf_dir), VIEW, key="event_id", folder=version)
    commit_version(spark, version)
    scorer = load_forest(spark, current_version(spark, models))
    events = sec_all(stream_events(spark, sf_dir))

    def prepare(batch: DataFrame) -> DataFrame:
        return stamp_arrival(add_predictions(batch, scorer, VIEW))

    start_ingest(events, store, work_folder(spark, "scored-checkpoint"), prepare=prepare).awaitTermination()
    return _checked_scores(spark.read.parquet(store))


def unscored(spark, sf_dir):
    scorer = load_pipeline(spark, work_folder(spark, "no-model"))
    return score_events(_all(spark, sf_dir), scorer, VIEW).select("event_id", VIEW.protocol, VIEW.anomaly)


def scoring_error(spark, sf_dir):
    """A frame without a feature column is refused before the model is looked at."""
    scorer = CodeForest(work_folder(spark, "no-forest"), [])
    return score_events(_all(spark, sf_dir).drop(VIEW.protocol), scorer, VIEW).select("event_id", PREDICTED, CONFIDENCE)


QUERIES: dict[str, Query] = {
    "q_total": total,
    "q_attack_distribution": attack_distribution,
    "q_severity_breakdown": severity_breakdown,
    "q_protocol_packets": protocol_packets,
    "q_anomaly_by_attack": anomaly_by_attack,
    "q_top_source_ips": top_source_ips,
    "q_severity_protocol": severity_protocol,
    "q_hourly_trend": hourly_trend,
    "q_kpis": kpis,
    "q_kpis_missing_columns": kpis_missing_columns,
    "q_value_counts": value_counts,
    "q_severity_counts": severity_counts,
    "q_category_share": category_share,
    "q_attack_share": attack_share,
    "q_anomaly_histogram": anomaly_histogram,
    "q_recent": recent,
    "q_clean_cast": clean_cast,
    "q_complete_cases": complete_rows,
    "q_fill_policy": fill_policy,
    "q_quality_counts": quality_counts,
    "q_unseen_fallback": unseen_fallback,
    "q_nan_fill": nan_fill,
    "q_nan_kpis": nan_kpis,
    "q_nan_quality": nan_quality,
    "q_report_lines": report_section,
    "q_report_text": report_text,
    "q_csv_scan": csv_scan,
    "q_csv_inferred": csv_inferred,
    "q_csv_na_tokens": csv_na_tokens,
    "q_csv_by_name": csv_by_name,
    "q_stream_ingest": stream_ingest,
    "q_stream_by_name": stream_by_name,
    "q_stream_restart": stream_restart,
    "q_batch_counts": batch_counts,
    "q_store_recent": store_recent,
    "q_live_counts": live_counts,
    "q_live_kpis": live_kpis,
    "q_live_attack_share": live_attack_share,
    "q_live_protocol_counts": live_protocol_counts,
    "q_live_top_sources": live_top_sources,
    "q_live_histogram": live_histogram,
    "q_live_grid": live_grid,
    "q_live_recent": live_recent,
    "q_freq_index": freq_index,
    "q_label_index": label_index,
    "q_lex_index": lex_index,
    "q_many_labels": many_labels,
    "q_category_codes": category_codes,
    "q_code_names": code_names,
    "q_stored_codes": stored_codes,
    "q_one_hot": one_hot,
    "q_scaled_measure": scaled_measure,
    "q_feature_vector": feature_vector,
    "q_saved_pipeline": saved_pipeline,
    "q_feature_sample": feature_sample,
    "q_hash_split": hash_split,
    "q_random_split": random_split,
    "q_exact_split": exact_split,
    "q_class_report": class_report,
    "q_class_summary": class_summary,
    "q_printed_report": printed_report,
    "q_forest_spark": forest_spark,
    "q_forest_codes": forest_codes,
    "q_forest_report": forest_report,
    "q_scored_events": scored_events,
    "q_scored_stream": scored_stream,
    "q_unscored": unscored,
    "q_scoring_error": scoring_error,
}
