"""A security log seen through the ``events`` table: text cells, some malformed or missing, then the typed views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.casts import cast_columns, tolerant_timestamp
from vigilog.operators.cleaning import complete_cases, with_target
from vigilog.schema import EVENT_SCHEMA, EventColumns

VIEW = EventColumns(
    timestamp="ts",
    source_ip="src_ip",
    source_port="src_port",
    destination_port="dst_port",
    protocol="protocol",
    packet_length="packet_len",
    packet_type="packet_type",
    traffic_type="traffic_type",
    anomaly="anomaly",
    attack="attack_type",
    severity="severity",
)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def raw_log(events: DataFrame) -> DataFrame:
    """The log as text, with bad cells at fixed rows."""
    event, user, value, k = (F.col(c) for c in ("event_id", "user_id", "value", "k"))

    def text(number):
        return number.cast("string")

    # A projection of its own parses the JSON once per row.
    parsed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return parsed.select(
        "event_id",
        F.when(event % 101 == 0, "n/a").otherwise(F.substring(text(F.col("ts")), 1, 19)).alias("ts_raw"),
        F.concat(F.lit("10.0."), text(user % 7), F.lit("."), text(user)).alias("src_ip"),
        text(1024 + user).alias("src_port_raw"),
        text(1 + k).alias("dst_port_raw"),
        F.when(event % 61 != 0, F.when(k % 3 == 0, "TCP").when(k % 3 == 1, "UDP").otherwise("ICMP")).alias("protocol"),
        F.when(event % 89 == 0, "").otherwise(text(64 + user * 9)).alias("packet_raw"),
        F.when(k % 2 == 0, "Data").otherwise("Control").alias("packet_type"),
        F.when(user % 3 == 0, "HTTP").when(user % 3 == 1, "DNS").otherwise("FTP").alias("traffic_type"),
        F.when(event % 97 == 0, "bad").otherwise(text(value)).alias("anomaly_raw"),
        F.when(event % 50 != 0, F.col("event_type")).alias("attack_type"),
        F.when(value >= 100, "High").when(value >= 30, "Medium").otherwise("Low").alias("severity"),
    )


def sec_all(events: DataFrame) -> DataFrame:
    """The typed log, malformed cells NULL."""
    named = raw_log(events).withColumnsRenamed(
        {"ts_raw": "ts", "src_port_raw": "src_port", "dst_port_raw": "dst_port", "packet_raw": "packet_len", "anomaly_raw": "anomaly"}
    )
    typed = cast_columns(named, {"src_port": "double", "dst_port": "double", "packet_len": "bigint", "anomaly": "double"})
    return typed.withColumn("ts", tolerant_timestamp(named, "ts"))


def sec_log(events: DataFrame) -> DataFrame:
    return with_target(sec_all(events), VIEW.attack)


def sec_complete(events: DataFrame) -> DataFrame:
    return complete_cases(sec_all(events), VIEW)


def canonical_log(events: DataFrame) -> DataFrame:
    """The raw log under the event table's own 25 text columns, the row's id among them as user information.

    The payload cell holds quotes and a line break, so it needs CSV quoting.
    """
    payload = F.concat(F.lit('{"k": '), (F.col("dst_port_raw").cast("int") - 1).cast("string"), F.lit("},\n"), F.col("severity"))
    filled = {
        "Timestamp": F.col("ts_raw"),
        "Source IP Address": F.col("src_ip"),
        "Source Port": F.col("src_port_raw"),
        "Destination Port": F.col("dst_port_raw"),
        "Protocol": F.col("protocol"),
        "Packet Length": F.col("packet_raw"),
        "Packet Type": F.col("packet_type"),
        "Traffic Type": F.col("traffic_type"),
        "Payload Data": payload,
        "Anomaly Scores": F.col("anomaly_raw"),
        "Attack Type": F.col("attack_type"),
        "Severity Level": F.col("severity"),
        "User Information": F.col("event_id").cast("string"),
    }
    names = [f.name for f in EVENT_SCHEMA][:-1]
    return raw_log(events).select(*[filled.get(n, F.lit(None).cast("string")).alias(n) for n in names])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(events_path(sf_dir))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of Parquet files; a stream wants a pattern, this one fits the table's name alone."""
    schema = read_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{events_path(sf_dir)[:-1]}[t]")
