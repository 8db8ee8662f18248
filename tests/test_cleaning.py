from vigilog.operators.cleaning import (
    complete_cases, fill_missing, project_existing, report_rows, with_target,
)
from vigilog.schema import EVENT

SCHEMA = """`Source Port` string, `Destination Port` string, `Packet Length` string, `Anomaly Scores` string,
 Protocol string, `Packet Type` string, `Traffic Type` string, `Severity Level` string, `Attack Type` string"""
GOOD = ("1", "2", "3", "4.5", "TCP", "Data", "DNS", "High", "DDoS")


def changed(**cells):
    places = {"port": 0, "packet": 2, "anomaly": 3, "protocol": 4, "attack": 8}
    row = list(GOOD)
    for name, value in cells.items():
        row[places[name]] = value
    return tuple(row)


def test_malformed_cell_drops_its_row_before_assembly(spark):
    log = spark.createDataFrame([GOOD, changed(anomaly="bad"), changed(protocol=None), changed(attack=None)], SCHEMA)
    kept = complete_cases(log)
    assert [tuple(r) for r in kept.collect()] == [(1.0, 2.0, 3.0, 4.5, "TCP", "Data", "DNS", "High", "DDoS")]


def test_fill_policy(spark):
    log = spark.createDataFrame([changed(port=None, packet="x", protocol=None, attack=None)], SCHEMA)
    row = fill_missing(log).first()
    assert (row["Source Port"], row["Packet Length"], row["Protocol"], row["Attack Type"]) == (0.0, 0.0, "Unknown", "Unknown")


def test_fill_passes_over_missing_columns(spark):
    assert fill_missing(spark.createDataFrame([(None,)], "Protocol string")).first()[0] == "Unknown"


def test_report_rows(spark):
    log = spark.createDataFrame([GOOD, changed(attack=None), changed(anomaly="bad", packet="")], SCHEMA)
    typed = report_rows(log)
    assert typed.count() == 2
    assert dict(typed.dtypes)["Packet Length"] == "bigint" and dict(typed.dtypes)["Anomaly Scores"] == "double"
    assert with_target(log, EVENT.attack).count() == 2


def test_projection_skips_missing_columns(spark):
    frame = spark.createDataFrame([(1, 2)], "b int, a int")
    assert project_existing(frame, ["a", "x", "b"]).columns == ["a", "b"]
