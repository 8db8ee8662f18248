"""The grouped report: a total and seven sections, all from one scan of the events.

Categories, hour and measures are first summed into the small cube of ``rollup``, source addresses into a
set of their own; the sections are sums over those rows. Each section is cut to its first rows by a window
whose limit Spark applies before the shuffle, so no task receives a whole section.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.casts import tolerant_timestamp
from vigilog.functions.text import row_line
from vigilog.operators.cleaning import report_rows
from vigilog.operators.rollup import rollup
from vigilog.schema import EVENT, EventColumns

ATTACKS, SEVERITIES, PROTOCOLS, ANOMALIES, SOURCES, CROSS, HOURS = range(1, 8)

# Section titles, row limits and the words of the report.
TITLES = {
    ATTACKS: "[1] Attack Type Distribution",
    SEVERITIES: "[2] Severity Level Breakdown",
    PROTOCOLS: "[3] Protocol Distribution (avg packet length)",
    ANOMALIES: "[4] Avg Anomaly Score per Attack Type",
    SOURCES: "[5] Top-10 Source IPs by Event Count",
    CROSS: "[6] Severity x Protocol Cross-Tab",
    HOURS: "[7] Hourly Event Trend",
}
LIMITS = {ATTACKS: 10, SEVERITIES: 10, PROTOCOLS: 10, ANOMALIES: 10, SOURCES: 10, CROSS: 20, HOURS: 24}
RULE = "=" * 60
OPENING = "[OK] Total records loaded: "
CLOSING = "[DONE] Batch processing complete."
NO_TREND = "[7] Hourly Event Trend -- skipped (Timestamp column not parseable as datetime)"

SUMS = ["events", "timed", "packet_sum", "packet_n", "anomaly_sum", "anomaly_n"]


def _partials(events: DataFrame, cols: EventColumns) -> DataFrame:
    typed = report_rows(events, cols).select(
        F.col(cols.attack).alias("attack"),
        F.col(cols.severity).alias("severity"),
        F.col(cols.protocol).alias("protocol"),
        F.hour(tolerant_timestamp(events, cols.timestamp)).alias("hour"),
        F.col(cols.source_ip).alias("source"),
        F.col(cols.packet_length).alias("packet"),
        F.col(cols.anomaly).alias("anomaly"),
    )
    return rollup(typed, [["attack", "severity", "protocol", "hour"], ["source"]], ["packet", "anomaly"])


def _share(section: int, key1: str = "CAST(NULL AS STRING)", key2: str = "CAST(NULL AS STRING)") -> str:
    """What one rollup row adds to a section, as SQL: one expression is built much faster than a hundred columns."""
    return f"struct({section} AS section, {key1} AS key1, {key2} AS key2, {', '.join(SUMS)})"


def section_rows(events: DataFrame, cols: EventColumns = EVENT) -> DataFrame:
    """``section, ord, key1, key2`` with counts and means: section 0 is the total, 1 to 7 the analyses."""
    cube = [
        _share(0),
        _share(ATTACKS, "attack"),
        _share(SEVERITIES, "severity"),
        _share(PROTOCOLS, "protocol"),
        _share(ANOMALIES, "attack"),
        _share(CROSS, "severity", "protocol"),
        _share(HOURS, "CAST(hour AS STRING)"),
    ]
    shares = f"inline(IF(set_no = 0, array({', '.join(cube)}), array({_share(SOURCES, 'source')})))"
    nothing = events.sparkSession.range(0, 1, 1, 1).selectExpr(
        "0 AS section", "CAST(NULL AS STRING) AS key1", "CAST(NULL AS STRING) AS key2", *[f"0 AS {c}" for c in SUMS]
    )
    grouped = (
        _partials(events, cols)
        .withColumn("timed", F.expr("IF(hour IS NULL, 0, events)"))
        .selectExpr(shares)
        .filter(f"section <> {HOURS} OR key1 IS NOT NULL")
        .unionByName(nothing)  # an empty log still has its total, 0
        .groupBy("section", "key1", "key2")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
        .withColumns(
            {
                "avg_packet": F.try_divide("packet_sum", "packet_n"),
                "avg_anomaly": F.try_divide("anomaly_sum", "anomaly_n"),
            }
        )
    )

    first = F.expr(f"IF(section = {CROSS}, key1, NULL)")
    second = F.expr(
        f"CASE section WHEN {ANOMALIES} THEN avg_anomaly WHEN {HOURS} THEN -try_cast(key1 AS DOUBLE) ELSE CAST(events AS DOUBLE) END"
    )
    order = Window.partitionBy("section").orderBy(first.asc_nulls_first(), second.desc_nulls_last(), "key1", "key2")
    limits = " ".join(f"WHEN {number} THEN {rows}" for number, rows in LIMITS.items())
    ranked = grouped.withColumn("ord", F.row_number().over(order)).filter(f"ord <= {max(LIMITS.values())}")
    return ranked.filter(f"ord <= CASE section {limits} ELSE 1 END").select(
        "section", "ord", "key1", "key2", "events", "timed", "avg_packet", "avg_anomaly"
    )


def _heading(number: int, *words: str) -> str:
    """Heading lines of a section as SQL; a blank line comes first."""
    lines = [f"struct({number} AS section, {place} AS ord, '{w}' AS line)" for place, w in enumerate(["", *words], start=-4)]
    return f"array({', '.join(lines)})"


def report_lines(events: DataFrame, cols: EventColumns = EVENT, digits: int | None = None) -> DataFrame:
    """The report as ``section, ord, line``; headings have negative ``ord``. ``digits`` rounds the means."""
    rows = section_rows(events, cols)
    if digits is not None:
        rows = rows.withColumns({c: F.round(c, digits) for c in ("avg_packet", "avg_anomaly")})

    headings = ", ".join(_heading(number, RULE, title, RULE) for number, title in TITLES.items() if number != HOURS)
    trend = f"IF(timed > 0, {_heading(HOURS, RULE, TITLES[HOURS], RULE)}, {_heading(HOURS, NO_TREND)})"
    opening = f"array(struct(0 AS section, 0 AS ord, concat('{OPENING}', format_number(events, 0)) AS line))"
    section = F.col("section")
    key1, key2, counted, packet, anomaly = (F.col(c) for c in ("key1", "key2", "events", "avg_packet", "avg_anomaly"))
    body = (
        F.when(section == PROTOCOLS, row_line(key1, counted, packet))
        .when(section == ANOMALIES, row_line(key1, anomaly))
        .when(section == CROSS, row_line(key1, key2, counted))
        .otherwise(row_line(key1, counted))
    )
    return rows.withColumn("line", F.concat(F.lit("  "), body)).selectExpr(
        f"inline(IF(section = 0, concat({opening}, {headings}, {trend}, {_heading(HOURS + 1, CLOSING)}), array(struct(section, ord, line))))"
    )


def section_lines(section: str, frame: DataFrame) -> DataFrame:
    """Any grouped frame as ``section, line``."""
    return frame.select(F.lit(section).alias("section"), row_line(*[F.col(c) for c in frame.columns]).alias("line"))
