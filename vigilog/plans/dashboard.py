"""The data behind the live dashboard: headline numbers, six charts and the latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators.cleaning import project_existing
from vigilog.operators.counting import histogram
from vigilog.operators.forests import PREDICTED, CodeForest
from vigilog.operators.grid import grid, grid_histogram, merged
from vigilog.operators.ranking import latest, top
from vigilog.operators.rollup import mean, only, rollup, summed
from vigilog.operators.scoring import CONFIDENCE, score_events, values_seen
from vigilog.schema import EVENT, EventColumns
from vigilog.streaming.ingest import stamp_arrival
from vigilog.streaming.totals import Total, total_so_far

TOP_SOURCES = 10
LATEST_ROWS = 15

CUBE, SOURCES = 0, 1

#: What the live totals keep of every row's arrival, most significant first.
LIVE_ARRIVAL = ["arrived", "live_batch", "live_seq"]


def dashboard_rollup(events: DataFrame, cols: EventColumns = EVENT, addresses: bool = True) -> DataFrame:
    """All category counts, and with ``addresses`` those of the source addresses, in one pass.

    A column the frame lacks counts as NULL throughout.
    """
    have = events.columns
    names = {"attack": cols.attack, "severity": cols.severity, "protocol": cols.protocol, "traffic": cols.traffic_type}
    keys = {short: F.col(c) if c in have else F.lit(None).cast("string") for short, c in (names | {"source": cols.source_ip}).items()}
    anomaly = F.col(cols.anomaly).try_cast("double") if cols.anomaly in have else F.lit(None).cast("double")
    wanted = events.select(*[column.alias(short) for short, column in keys.items()], anomaly.alias("anomaly"))
    return rollup(wanted, [list(names), ["source"]] if addresses else [list(names)], ["anomaly"])


def rolled_kpis(rolled: DataFrame, digits: int = 3) -> DataFrame:
    """Headline numbers from rollup rows; distinct attack types are counted exactly, NULL left out."""
    return only(rolled, CUBE).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_logs"),
        F.count_distinct("attack").alias("attack_types"),
        F.coalesce(F.sum(F.when(F.col("severity") == "High", F.col("events"))), F.lit(0)).alias("high_severity"),
        F.round(mean("anomaly"), digits).alias("avg_anomaly"),
    )


def rolled_counts(rolled: DataFrame, key: str) -> DataFrame:
    """Rows per value of a category, NULL left out, most frequent first."""
    counts = only(rolled, CUBE).filter(F.col(key).isNotNull()).groupBy(key).agg(summed())
    return counts.orderBy(F.desc("cnt"), key)


def rolled_share(rolled: DataFrame, key: str) -> DataFrame:
    """Rows per value and their share of all rows."""
    counts = only(rolled, CUBE).groupBy(key).agg(summed())
    total = counts.agg(F.sum("cnt").alias("n")).scalar()
    return counts.withColumn("share", F.col("cnt").cast("double") / total)


def rolled_sources(rolled: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """The most frequent source addresses, NULL left out."""
    counts = only(rolled, SOURCES).filter(F.col("source").isNotNull())
    return top(counts.select("source", F.col("events").alias("event_count")), n, F.desc("event_count"), F.asc("source"))


def recent_columns(cols: EventColumns = EVENT) -> list[str]:
    return [cols.emitted, cols.source_ip, cols.attack, cols.severity, cols.protocol, cols.anomaly, PREDICTED, CONFIDENCE]


def recent_events(
    events: DataFrame,
    arrival: Sequence[str],
    cols: EventColumns = EVENT,
    scorer: CodeForest | None = None,
    n: int = LATEST_ROWS,
) -> DataFrame:
    """The last rows by arrival, scored if there is a model, in the columns of the table that exist."""
    return project_existing(score_events(latest(events, arrival, n), scorer, cols), recent_columns(cols))


def dashboard(
    events: DataFrame,
    rolled: DataFrame,
    arrival: Sequence[str],
    cols: EventColumns = EVENT,
    scorer: CodeForest | None = None,
) -> dict[str, DataFrame]:
    """Every dataset by name. ``rolled`` is a written rollup or the latest snapshot of a live one.

    A chart whose column is missing is left out. With a model the charts show the values it saw; predictions
    are computed for the latest rows alone, since no other dataset needs them.
    """
    have = events.columns
    seen = values_seen(events, scorer, cols)
    datasets = {"kpis": rolled_kpis(rolled)}
    if cols.attack in have:
        datasets["attack_share"] = rolled_share(rolled, "attack")
    if cols.protocol in have:
        datasets["protocol_counts"] = rolled_counts(rolled, "protocol")
    if cols.severity in have:
        datasets["severity_counts"] = rolled_counts(rolled, "severity")
    if cols.traffic_type in have:
        datasets["traffic_share"] = rolled_share(rolled, "traffic")
    if cols.anomaly in have:
        datasets["anomaly_histogram"] = histogram(seen, cols.anomaly)
    if cols.source_ip in have:
        datasets["top_sources"] = rolled_sources(rolled)
    datasets["recent"] = recent_events(events, [c for c in arrival if c in have], cols, scorer)
    return datasets


def _summed_rollup(rolled: DataFrame) -> DataFrame:
    """Rollup rows of several parts summed."""
    keys = [c for c in rolled.columns if c not in ("events", "anomaly_sum", "anomaly_n")]
    return rolled.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("events", "anomaly_sum", "anomaly_n")])


def _counted_sources(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source").agg(F.sum("events").alias("events"))


def live_totals(cols: EventColumns = EVENT, n: int = LATEST_ROWS) -> dict[str, Total]:
    """What a stream keeps for the dashboard. Only the addresses have no bound; they are summed by the reader.

    The latest rows go by arrival: the producer's stamp or the batch's time, the batch, the place in it.
    """

    def cube(batch: DataFrame, _: int) -> DataFrame:
        return dashboard_rollup(batch, cols, addresses=False)

    def sources(batch: DataFrame, _: int) -> DataFrame:
        address = F.col(cols.source_ip) if cols.source_ip in batch.columns else F.lit(None).cast("string")
        given = batch.select(address.alias("source")).filter("source is not null")
        return given.groupBy("source").agg(F.count("*").alias("events"))

    def cells(batch: DataFrame, _: int) -> DataFrame:
        column = cols.anomaly if cols.anomaly in batch.columns else None
        value = F.col(column).try_cast("double") if column else F.lit(None).cast("double")
        return grid(batch.select(value.alias("anomaly")), "anomaly")

    def last_rows(rows: DataFrame) -> DataFrame:
        return latest(rows, LIVE_ARRIVAL, n)

    def recent(batch: DataFrame, number: int) -> DataFrame:
        stamped = batch if cols.emitted in batch.columns else stamp_arrival(batch)
        arrived = F.col(cols.emitted if cols.emitted in stamped.columns else "Emit_Timestamp").cast("string")
        placed = stamped.withColumns({"arrived": arrived, "live_batch": F.lit(number).cast("bigint"), "live_seq": F.monotonically_increasing_id()})
        return last_rows(placed)

    return {
        "cube": Total(cube, _summed_rollup),
        "grid": Total(cells, merged),
        "recent": Total(recent, last_rows),
        "sources": Total(sources, _counted_sources, bounded=False),
    }


def live_sources(counts: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """The most frequent of the summed addresses."""
    return top(counts.select("source", F.col("events").alias("event_count")), n, F.desc("event_count"), F.asc("source"))


def live_dashboard(
    spark: SparkSession, folder: str, cols: EventColumns = EVENT, scorer: CodeForest | None = None
) -> dict[str, DataFrame]:
    """Every dataset from the live totals, all as of the last whole batch; the log isn't read. Nothing before the first batch."""
    totals = live_totals(cols)
    parts = {name: total_so_far(spark, folder, name, total) for name, total in totals.items()}
    if parts["cube"] is None:
        return {}
    cube = parts["cube"].withColumn("source", F.lit(None).cast("string"))
    recent = latest(parts["recent"], LIVE_ARRIVAL, LATEST_ROWS)
    have = recent.columns
    datasets = {"kpis": rolled_kpis(cube)}
    for name, key, column, rows in (
        ("attack_share", "attack", cols.attack, rolled_share),
        ("protocol_counts", "protocol", cols.protocol, rolled_counts),
        ("severity_counts", "severity", cols.severity, rolled_counts),
        ("traffic_share", "traffic", cols.traffic_type, rolled_share),
    ):
        if column in have:
            datasets[name] = rows(cube, key)
    if cols.anomaly in have:
        datasets["anomaly_histogram"] = grid_histogram(parts["grid"])
    if cols.source_ip in have:
        datasets["top_sources"] = live_sources(parts["sources"])
    datasets["recent"] = project_existing(score_events(recent, scorer, cols), recent_columns(cols))
    return datasets
