import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vigilog.operators import features
from vigilog.plans.event_view import VIEW, sec_complete
from vigilog.sinks.models import commit_version, current_version, load_pipeline, new_version, save_model


def numbers(frame, column):
    return [tuple(round(x, 9) for x in r[0]) for r in frame.select(vector_to_array(column)).collect()]


@pytest.fixture(scope="module")
def complete(events):
    return sec_complete(events).orderBy("event_id").cache()


def test_index_ties_go_by_value(spark):
    frame = spark.createDataFrame([("z",), ("b",), ("m",), ("m",)], "v string")
    assert features.label_lists(frame, ["v"], by_frequency=True) == [["m", "b", "z"]]
    assert features.label_lists(frame, ["v"], by_frequency=False) == [["b", "m", "z"]]


def test_unseen_and_null_share_the_extra_index_and_an_empty_vector(spark):
    fitted = features.frequency_indexer(spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string"), ["v"], ["i"])
    other = fitted.transform(spark.createDataFrame([("a",), ("zzz",), (None,)], "v string"))
    assert [r.i for r in other.collect()] == [0.0, 3.0, 3.0]
    encoded = OneHotEncoder(inputCols=["i"], outputCols=["e"]).fit(other).transform(other)
    assert numbers(encoded, "e") == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_labels_of_several_columns_keep_their_lengths(spark):
    frame = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "p string, q string")
    fitted = features.frequency_indexer(frame, ["p", "q"], ["pi", "qi"])
    assert features.indexer_labels(fitted) == {"p": ["a", "b", "c"], "q": ["x"]}
    assert [r.qi for r in fitted.transform(frame).orderBy("p").collect()] == [0.0, 0.0, 1.0]


def test_too_many_labels_are_refused(spark):
    frame = spark.range(50).select(F.col("id").cast("string").alias("v"), F.lit("x").alias("w"))
    with pytest.raises(ValueError, match=r"\['v'\]"):
        features.label_lists(frame, ["w", "v"], by_frequency=True, most=20)


def test_same_columns_as_one_estimator_per_column(complete):
    indexed, encoded = ([f"{c}_{kind}" for c in VIEW.categorical] for kind in ("indexed", "encoded"))
    stages = [StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(VIEW.categorical, indexed)]
    stages += [OneHotEncoder(inputCol=i, outputCol=e) for i, e in zip(indexed, encoded)]
    stages += [
        StringIndexer(inputCol=VIEW.attack, outputCol="label", handleInvalid="keep"),
        VectorAssembler(inputCols=[*VIEW.numeric, *encoded], outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
    ]
    theirs = Pipeline(stages=stages).fit(complete).transform(complete)
    ours = features.fit_features(complete, VIEW).transform(complete)
    assert numbers(ours, "features") == numbers(theirs, "features")
    assert numbers(ours, "raw_features") == numbers(theirs, "raw_features")
    for column in [*indexed, "label"]:
        assert ours.select(column).collect() == theirs.select(column).collect()


def test_label_has_one_class_more_than_values(complete):
    featured = features.fit_features(complete, VIEW).transform(complete)
    assert len(featured.schema["label"].metadata["ml_attr"]["vals"]) == 6


def test_constant_slot_scales_to_zero(spark):
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="raw").transform(
        spark.createDataFrame([(7.0, 1.0), (7.0, 3.0)], "a double, b double")
    )
    scaled = features.unit_scaler("raw", "s").fit(frame).transform(frame)
    assert numbers(scaled, "s") == [(0.0, round(1 / 2**0.5, 9)), (0.0, round(3 / 2**0.5, 9))]


def test_saved_pipeline_gives_the_same_vectors(spark, complete, tmp_path):
    fitted, path = features.fit_features(complete, VIEW), str(tmp_path / "pipeline")
    save_model(fitted, path)
    save_model(fitted, path)  # overwrites
    loaded = load_pipeline(spark, path)
    assert numbers(loaded.transform(complete), "features") == numbers(fitted.transform(complete), "features")


def test_no_saved_pipeline(spark, tmp_path):
    assert load_pipeline(spark, str(tmp_path / "none")) is None


def test_sample(complete):
    fitted = features.fit_features(complete, VIEW)
    assert {"label", "features"} <= set(features.feature_sample(complete, fitted).columns)
    first = features.feature_sample(complete, fitted, 3, order=[F.desc("event_id")])
    assert [r.event_id for r in first.collect()] == [r.event_id for r in complete.orderBy(F.desc("event_id")).limit(3).collect()]


def test_a_model_that_is_being_replaced_is_not_seen(spark, complete, tmp_path):
    """Readers take the last version whose marker is there, and keep its files while newer ones come."""
    path, fitted = str(tmp_path / "pipeline"), features.fit_features(complete, VIEW)
    save_model(fitted, path)
    reader = load_pipeline(spark, path).transform(complete)
    half = new_version(spark, path)
    fitted.write().save(f"{half}/model")  # no marker yet
    assert current_version(spark, path).endswith("version=1")
    commit_version(spark, half)
    assert current_version(spark, path).endswith("version=2")
    assert reader.count() == complete.count()
    for _ in range(3):
        save_model(fitted, path)
    left = sorted(p.name for p in (tmp_path / "pipeline").iterdir())
    assert left == ["version=3", "version=4", "version=5"] and current_version(spark, path).endswith("version=5")
