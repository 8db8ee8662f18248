"""The security-event table: its columns, and the part each of them plays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The columns of the event table in order, and the types of those that are not text.
EVENT_COLUMNS = [
    "Timestamp",
    "Source IP Address",
    "Destination IP Address",
    "Source Port",
    "Destination Port",
    "Protocol",
    "Packet Length",
    "Packet Type",
    "Traffic Type",
    "Payload Data",
    "Malware Indicators",
    "Anomaly Scores",
    "Alerts/Warnings",
    "Attack Type",
    "Attack Signature",
    "Action Taken",
    "Severity Level",
    "User Information",
    "Device Information",
    "Network Segment",
    "Geo-location Data",
    "Proxy Information",
    "Firewall Logs",
    "IDS/IPS Alerts",
    "Log Source",
    "Emit_Timestamp",
]
NOT_TEXT = {
    "Source Port": T.IntegerType(),
    "Destination Port": T.IntegerType(),
    "Packet Length": T.IntegerType(),
    "Anomaly Scores": T.DoubleType(),
}

EVENT_SCHEMA = T.StructType([T.StructField(name, NOT_TEXT.get(name, T.StringType())) for name in EVENT_COLUMNS])
EMITTED = "Emit_Timestamp"

#: The table as it is before a producer stamps it.
STATIC_SCHEMA = T.StructType([f for f in EVENT_SCHEMA if f.name != EMITTED])

#: What the event store adds to every row: which stream and micro-batch brought it, and its place there.
ARRIVAL_SCHEMA = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

#: Event columns followed by those that scoring adds.
SCORED_SCHEMA = T.StructType(
    [*EVENT_SCHEMA, T.StructField("Predicted_Attack", T.StringType()), T.StructField("Confidence_Pct", T.DoubleType())]
)


def as_strings(schema: T.StructType) -> T.StructType:
    """The same columns, every one of them a string."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


@dataclass(frozen=True)
class EventColumns:
    """Which column of a frame plays which part; the defaults are the event table's own names."""

    timestamp: str = "Timestamp"
    source_ip: str = "Source IP Address"
    source_port: str = "Source Port"
    destination_port: str = "Destination Port"
    protocol: str = "Protocol"
    packet_length: str = "Packet Length"
    packet_type: str = "Packet Type"
    traffic_type: str = "Traffic Type"
    anomaly: str = "Anomaly Scores"
    attack: str = "Attack Type"
    severity: str = "Severity Level"
    emitted: str = EMITTED

    @property
    def numeric(self) -> list[str]:
        return [self.source_port, self.destination_port, self.packet_length, self.anomaly]

    @property
    def categorical(self) -> list[str]:
        return [self.protocol, self.packet_type, self.traffic_type, self.severity]


EVENT = EventColumns()
