from pathlib import Path

from vigilog.plans.event_view import VIEW, canonical_log, sec_all
from vigilog.plans.jobs import run_report
from vigilog.plans.report import report_lines, section_lines, section_rows
from vigilog.sinks.text_report import write_lines


def lines(frame):
    return [r.line for r in frame.orderBy("section", "ord").collect()]


def test_report_from_csv_to_text(spark, events, tmp_path):
    canonical_log(events).write.option("header", True).option("escape", '"').csv(str(tmp_path / "log.csv"))
    run_report(spark, str(tmp_path / "log.csv"), str(tmp_path / "report"))
    text = next(Path(tmp_path / "report").glob("part-*")).read_text().split("\n")
    assert text[0] == "[OK] Total records loaded: 980"
    assert text[1:5] == ["", "=" * 60, "[1] Attack Type Distribution", "=" * 60]
    assert text[-2] == "[DONE] Batch processing complete."
    expected = lines(report_lines(sec_all(events), VIEW))
    assert text[:-1] == expected
    assert sum(line.startswith("  ") for line in text) == 5 + 3 + 4 + 5 + 10 + 12 + 24


def test_empty_log_reports_a_total_of_zero_and_no_trend(spark, events):
    text = lines(report_lines(sec_all(events).limit(0), VIEW))
    assert text[0] == "[OK] Total records loaded: 0"
    assert "[7] Hourly Event Trend -- skipped (Timestamp column not parseable as datetime)" in text
    assert not any(line.startswith("  ") for line in text)


def test_sections_are_cut_and_ordered(spark, events):
    many = spark.range(300).selectExpr(
        "'nope' AS ts", "concat('10.0.0.', id % 30) AS src_ip", "'TCP' AS protocol", "id AS packet_len",
        "CAST(id AS DOUBLE) AS anomaly", "concat('t', id % 13) AS attack_type", "'Low' AS severity",
    )
    found = section_rows(many, VIEW)
    per_section = {r.section: r["count"] for r in found.groupBy("section").count().collect()}
    assert per_section == {0: 1, 1: 10, 2: 1, 3: 1, 4: 10, 5: 10, 6: 1}
    means = [r.avg_anomaly for r in found.filter("section = 4").orderBy("ord").collect()]
    assert means == sorted(means, reverse=True)


def test_one_scan_and_a_limit_before_the_shuffle(events):
    plan = report_lines(sec_all(events), VIEW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_section_lines_of_any_frame(spark, tmp_path, rows):
    frame = spark.createDataFrame([("a", None, 1)], "x string, y string, n int")
    assert rows(section_lines("s", frame)) == [("s", "a | NULL | 1")]
    numbered = frame.selectExpr("1 AS section", "n AS ord", "x AS line")
    write_lines(numbered, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == "a"
