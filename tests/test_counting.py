import pytest
from pyspark.sql import functions as F

from vigilog.operators import counting, ranking
from vigilog.schema import EVENT

LOG = [("TCP", "High", 1.0), ("TCP", "Low", 3.0), ("UDP", "High", None), (None, "Low", 2.0)]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, "Protocol string, `Severity Level` string, `Anomaly Scores` double")


def test_null_is_a_group_in_one_count_and_dropped_in_the_other(log, rows):
    assert rows(counting.group_counts(log, "Protocol")) == [("TCP", 2), ("UDP", 1), (None, 1)]
    assert rows(counting.value_counts(log, "Protocol")) == [("TCP", 2), ("UDP", 1)]


def test_share_counts_null_rows_in_the_total(log, rows):
    assert rows(counting.category_share(log, "Protocol")) == [("TCP", 2, 0.5), ("UDP", 1, 0.25), (None, 1, 0.25)]


def test_kpis_with_missing_attack_column(log):
    assert counting.kpis(log).first().asDict() == {
        "total_logs": 4, "attack_types": 0, "high_severity": 2, "avg_anomaly": 2.0,
    }


def test_kpis_without_severity(log):
    assert counting.kpis(log.drop(EVENT.severity)).first()["high_severity"] == 0


def test_empty_log(spark, log):
    empty = log.limit(0)
    assert counting.row_total(empty).first()[0] == 0
    assert counting.kpis(empty).first()["avg_anomaly"] is None
    assert counting.histogram(empty, "Anomaly Scores").count() == 0


def test_histogram_closes_the_last_bin(spark, rows):
    values = spark.range(101).select(F.col("id").cast("double").alias("v"))
    found = counting.histogram(values, "v", bins=10)
    assert rows(found, "bin", "cnt") == [(i, 10) for i in range(9)] + [(9, 11)]
    assert [r[0] for r in found.orderBy("bin").select("bin_start").collect()] == [10.0 * i for i in range(10)]


def test_histogram_of_one_value_and_of_not_a_number(spark, rows):
    values = spark.createDataFrame([(5.0,), (5.0,), (float("nan"),), (None,)], "v double")
    assert rows(counting.histogram(values, "v"), "bin", "cnt") == [(0, 2)]


def test_weighted_histogram_equals_the_plain_one(spark, rows):
    values = spark.range(500).select((F.col("id") % 37).cast("double").alias("v"))
    weighted = counting.histogram(counting.group_counts(values, "v", name="w"), "v", weight="w")
    assert rows(weighted, "bin", "cnt") == rows(counting.histogram(values, "v"), "bin", "cnt")


def test_top_values_break_ties_by_value(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in ranking.top_values(frame, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_latest_is_an_ordered_take(spark):
    plan = ranking.latest(spark.range(1000), ["id"], 15)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_quality_counts(spark):
    columns = [*EVENT.numeric, *EVENT.categorical, EVENT.attack]
    schema = ", ".join(f"`{c}` string" for c in columns) + ", ts timestamp"
    full = ["1"] * 9 + [None]
    log = spark.createDataFrame([tuple(full), tuple([None, *full[1:]]), tuple([*full[:8], None, None])], schema)
    assert tuple(counting.quality_counts(log, "ts").first()) == (3, 2, 0, 1)


def test_grouping_is_combined_before_the_shuffle(log):
    plan = counting.group_counts(log, "Protocol")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
