"""The stages over paths, end to end, on the log written as CSV."""

import pytest
from pyspark.sql import functions as F

from vigilog.operators.forests import PREDICTED
from vigilog.operators.scoring import CONFIDENCE
from vigilog.plans import jobs
from vigilog.plans.event_view import canonical_log
from vigilog.schema import SCORED_SCHEMA
from vigilog.session import work_folder
from vigilog.sinks.models import model_exists
from vigilog.sources.csv_events import read_csv_events, typed_events
from vigilog.sources.event_store import read_event_store


@pytest.fixture(scope="module")
def paths(spark, events, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    canonical_log(events).repartition(2).write.option("header", True).option("escape", '"').csv(f"{root}/log.csv")
    return {n: f"{root}/{n}" for n in ("models", "store", "checkpoint", "charts", "live", "live-checkpoint")} | {
        "log": f"{root}/log.csv", "none": f"{root}/none.csv",
    }


def test_features_then_training(spark, paths):
    assert jobs.run_features(spark, paths["log"], paths["models"]).count() == 5
    reports = jobs.run_training(spark, paths["log"], paths["models"])
    assert set(reports) == {"scorer", "spark_rf_model"}
    assert model_exists(spark, f"{paths['models']}/spark_rf_model")
    for report in reports.values():
        assert report.filter(F.col("name") == "accuracy").count() == 1


def test_training_without_a_feature_pipeline_skips_the_second_forest(spark, paths, tmp_path, monkeypatch):
    from vigilog.plans.training import train_code_forest

    monkeypatch.setattr(jobs, "train_code_forest", lambda rows, trees, folder: train_code_forest(rows, trees=2, folder=folder))

    assert set(jobs.run_training(spark, paths["log"], str(tmp_path / "models"))) == {"scorer"}


def test_scored_ingest_then_dashboard(spark, paths, rows):
    jobs.run_ingest(spark, paths["log"], paths["store"], paths["checkpoint"], max_files=1, models=paths["models"]).awaitTermination()
    stored = read_event_store(spark, paths["store"], SCORED_SCHEMA)
    assert stored.count() == 1000 and stored.select("batch_id").distinct().count() == 2
    assert stored.filter(F.col(PREDICTED).isNull() | F.col(CONFIDENCE).isNull()).isEmpty()
    read = typed_events(read_csv_events(spark, paths["log"]))
    columns = ["User Information", "Source Port", "Protocol", "Anomaly Scores", "Payload Data"]
    assert rows(stored, *columns) == rows(read, *columns)  # predictions leave the events as they are
    charts = jobs.run_dashboard(spark, paths["store"], paths["charts"], paths["models"])
    assert set(charts) == {
        "kpis", "attack_share", "protocol_counts", "severity_counts", "traffic_share", "anomaly_histogram", "top_sources", "recent",
    }
    assert charts["kpis"].first().total_logs == 1000
    assert charts["recent"].count() == 15 and charts["recent"].columns[-2:] == [PREDICTED, CONFIDENCE]
    assert charts["top_sources"].count() == 10
    assert charts["anomaly_histogram"].agg(F.sum("cnt")).first()[0] == 1000  # missing scores were seen as 0


def test_charts_of_missing_columns_are_left_out(events):
    from vigilog.plans.dashboard import dashboard, dashboard_rollup
    from vigilog.plans.event_view import VIEW, sec_all

    log = sec_all(events).drop(VIEW.severity, VIEW.anomaly, VIEW.source_ip)
    charts = dashboard(log, dashboard_rollup(log, VIEW), ["event_id"], VIEW)
    assert set(charts) == {"kpis", "attack_share", "protocol_counts", "traffic_share", "recent"}
    assert charts["recent"].columns == [VIEW.attack, VIEW.protocol] and charts["kpis"].first().high_severity == 0


def test_dashboard_without_a_model(spark, paths, tmp_path):
    charts = jobs.run_dashboard(spark, paths["log"], str(tmp_path / "charts"))
    assert PREDICTED not in charts["recent"].columns
    assert charts["anomaly_histogram"].agg(F.sum("cnt")).first()[0] == 1000 - 11  # rows with a malformed score


def test_dashboard_of_an_empty_log(spark, paths, tmp_path):
    assert jobs.run_dashboard(spark, paths["none"], str(tmp_path / "charts")) == {}


def test_dashboard_from_live_totals_equals_a_pass_over_the_log(spark, paths, rows, tmp_path):
    jobs.run_live(spark, paths["log"], paths["live"], paths["live-checkpoint"], max_files=1).awaitTermination()
    live = jobs.run_dashboard(spark, paths["none"], str(tmp_path / "live"), snapshots=paths["live"])  # the log isn't read
    again = jobs.run_dashboard(spark, paths["log"], str(tmp_path / "again"))
    assert set(live) == set(again)
    for name in set(live) - {"recent", "kpis", "anomaly_histogram"}:
        assert rows(live[name]) == rows(again[name])
    assert live["kpis"].first() == again["kpis"].first()
    assert live["recent"].count() == 15
    counted = [charts["anomaly_histogram"].agg(F.sum("cnt")).first()[0] for charts in (live, again)]
    assert counted[0] == counted[1] == 989


def test_live_totals_of_the_values_a_model_sees(spark, paths, tmp_path):
    folder = str(tmp_path / "live")
    jobs.run_live(spark, paths["log"], folder, str(tmp_path / "c"), models=paths["models"]).awaitTermination()
    charts = jobs.run_dashboard(spark, paths["none"], str(tmp_path / "charts"), paths["models"], folder)
    assert charts["anomaly_histogram"].agg(F.sum("cnt")).first()[0] == 1000  # missing scores were seen as 0
    assert charts["recent"].columns[-2:] == [PREDICTED, CONFIDENCE] and charts["recent"].count() == 15


def test_work_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert not shared or folder.startswith(shared.rstrip("/"))


def test_a_job_removes_its_work_folders(spark, monkeypatch):
    from vigilog import session
    from vigilog.sinks.files import found

    monkeypatch.setattr(session, "_MADE", [])
    assert session.written(spark.range(3), "kept").count() == 3
    (folder,) = session._MADE
    assert found(spark, folder)
    session.remove_work(spark)
    assert not found(spark, folder) and not session._MADE
