import pytest
from pyspark.sql import functions as F

from vigilog.operators import labels
from vigilog.operators.labels import first_label, index_by_table, label_table, look_up, names_of
from vigilog.operators.ranking import running_sums
from vigilog.operators.scoring import known_codes


def test_running_sums_over_the_whole_order(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("part"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("w"))
    found = running_sums(frame.repartition(9), [-F.col("v")], {"rank": F.lit(1), "before": F.col("w")}).collect()
    total = 0
    for i, r in enumerate(sorted(found, key=lambda r: -r.v)):
        assert (r["rank"], r.before, r.part) == (i, total, "x")
        total += r.w or 0
    assert running_sums(frame.limit(0), [F.col("v")], {"rank": F.lit(1)}).count() == 0


def test_indices_of_several_columns(spark):
    frame = spark.createDataFrame([("z", 5), ("b", 5), ("m", 5), ("m", None), (None, 7)], "v string, n int")
    by = {kind: sorted(tuple(r) for r in label_table(frame, ["v", "n"], kind).select("column", "idx", "value").collect()) for kind in (True, False)}
    assert by[True] == [("n", 0, "5"), ("n", 1, "7"), ("v", 0, "m"), ("v", 1, "b"), ("v", 2, "z")]
    assert by[False] == [("n", 0, "5"), ("n", 1, "7"), ("v", 0, "b"), ("v", 1, "m"), ("v", 2, "z")]


@pytest.mark.parametrize("sent", [100, 0])
def test_unseen_and_null_share_the_extra_index(spark, sent, monkeypatch):
    """With a broadcast table, and with a broadcast of the most frequent labels and a shuffle for the rest."""
    monkeypatch.setattr(labels, "SENT_LABELS", sent)
    monkeypatch.setattr(labels, "HOT_LABELS", 1)
    table = label_table(spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string"), ["v"], by_frequency=True)
    rows = spark.createDataFrame([("a", 1), ("zzz", 2), (None, 3), ("c", 4), ("b", 5), ("a", 6)], "v string, i int")
    found = index_by_table(rows, table, "v", "x").orderBy("i")
    assert found.columns == ["v", "i", "x"] and [r.x for r in found.collect()] == [0.0, 3.0, 3.0, 2.0, 1.0, 0.0]
    back = names_of(found.withColumn("x", F.col("x").cast("int")), table, "v", "x", "name").orderBy("i")
    assert [r.name for r in back.collect()] == ["a", None, None, "c", "b", "a"]


def test_a_million_labels(spark):
    rows = spark.range(1_000_000).select(F.concat(F.lit("label-"), F.col("id")).alias("v"))
    rows = rows.union(spark.range(500_000).select(F.lit("label-77").alias("v")))  # a third of all rows
    table = label_table(rows, ["v"], by_frequency=True)
    assert first_label(table, "v") == "label-77"
    found = index_by_table(rows, table, "v", "i").agg(F.count("*"), F.count_distinct("i"), F.min("i"), F.max("i"), F.count_if(F.col("i") == 0))
    assert tuple(found.first()) == (1_500_000, 1_000_000, 0.0, 999_999.0, 500_001)


def test_unseen_and_missing_fall_back_to_the_first_label(spark):
    frame = spark.createDataFrame([("UDP",), ("zzz",), (None,)], "p string")

    def seen(*values):
        table = label_table(spark.createDataFrame([(v,) for v in values], "p string"), ["p"], by_frequency=False)
        return [tuple(r) for r in known_codes(frame, table, "p", "code").collect()]

    assert seen("TCP", "UDP") == [("UDP", 1), ("TCP", 0), ("TCP", 0)]
    assert seen("TCP", "Unknown") == [("TCP", 0), ("TCP", 0), ("Unknown", 1)]


def test_a_column_without_labels_keeps_its_values(spark):
    table = label_table(spark.createDataFrame([("x",)], "q string"), ["q"], by_frequency=False)
    found = known_codes(spark.createDataFrame([("UDP",), (None,)], "p string"), table, "p", "code")
    assert [tuple(r) for r in found.collect()] == [("UDP", 0), (None, 0)] and first_label(table, "p") is None


def test_no_label_is_in_the_plan(spark):
    table = label_table(spark.createDataFrame([("secret-label",), ("a",)], "p string"), ["p"], by_frequency=False)
    plan = look_up(spark.createDataFrame([("a",)], "p string"), table, "p", "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "secret-label" not in plan
