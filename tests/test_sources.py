import pytest
from pyspark.sql import functions as F

from vigilog.functions.casts import NA_TOKENS
from vigilog.schema import EVENT_COLUMNS, EVENT_SCHEMA, STATIC_SCHEMA
from vigilog.sources.csv_events import by_header, or_empty, read_csv_events, records_span_lines, typed_events
from vigilog.sources.event_store import read_event_store

QUOTED = 'id,payload,atk\n1,"line1\nline2",DDoS\n2,"he said ""hi"", ok",Malware\n'
PLAIN = "id,payload,atk\n1,a,DDoS\n2,NA,Malware\n3,,NULL\n"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="t.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_quoted_line_breaks_and_doubled_quotes(spark, csv, rows):
    path = csv(QUOTED)
    assert records_span_lines(spark, path)
    assert rows(read_csv_events(spark, path)) == [("1", "line1\nline2", "DDoS"), ("2", 'he said "hi", ok', "Malware")]


def test_plain_file_stays_splittable(spark, csv):
    path = csv('id,payload\n1,"a, b"\n2,"say ""x"""\n')
    assert not records_span_lines(spark, path)
    assert read_csv_events(spark, path).count() == 2


def test_a_quote_inside_an_unquoted_cell_is_no_line_break(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text('a,b\n5" disk,1\n"x,""y""",2\n"",""\n')
    broken.write_text('a,b\n1,"two ""\nlines"\n')
    assert not records_span_lines(spark, str(plain))
    assert records_span_lines(spark, str(broken))


def test_all_strings_by_default_and_inferred_on_request(spark, csv):
    path = csv(PLAIN)
    assert {kind for _, kind in read_csv_events(spark, path).dtypes} == {"string"}
    assert dict(read_csv_events(spark, path, infer=True).dtypes)["id"] == "int"


def test_na_tokens(spark, csv, rows):
    found = rows(read_csv_events(spark, csv(PLAIN), na_tokens=NA_TOKENS))
    assert found == [("1", "a", "DDoS"), ("2", None, "Malware"), ("3", None, None)]


def test_missing_source_is_an_empty_event_table(spark, tmp_path):
    nothing = or_empty(lambda: read_csv_events(spark, str(tmp_path / "none.csv")), spark)
    assert nothing.isEmpty() and nothing.schema == STATIC_SCHEMA


def test_missing_store_is_empty(spark, tmp_path):
    store = read_event_store(spark, str(tmp_path / "none"))
    assert store.isEmpty() and store.columns[:26] == EVENT_COLUMNS


def test_other_read_errors_are_not_hidden(spark, csv):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        or_empty(lambda: read_csv_events(spark, csv(PLAIN)).select("no such column"), spark)


def test_typed_events_from_a_full_file(spark, csv):
    cells = {"Source Port": "443", "Packet Length": "bad", "Anomaly Scores": "28.67", "Attack Type": "DDoS"}
    header = ",".join(EVENT_COLUMNS[:-1])
    path = csv(header + "\n" + ",".join(cells.get(c, "") for c in EVENT_COLUMNS[:-1]) + "\n")
    row = typed_events(read_csv_events(spark, path)).first()
    assert (row["Source Port"], row["Packet Length"], row["Anomaly Scores"], row["Protocol"]) == (443, None, 28.67, None)
    assert typed_events(read_csv_events(spark, path)).schema == STATIC_SCHEMA
    assert read_csv_events(spark, path, schema=EVENT_SCHEMA).columns == EVENT_COLUMNS


def test_places_of_columns_are_worked_out_once_a_file(spark):
    raw = spark.range(3).select(F.lit("file").alias("csv_file"), *[F.concat(F.lit(f"{n}-"), "id").alias(f"cell_{n}") for n in range(3)])
    headers = spark.range(1).select(F.lit("file").alias("csv_file"), F.array(F.lit("c"), F.lit("a"), F.lit("b")).alias("csv_header"))
    rows = by_header(raw, ["a", "b", "gone"], headers)
    assert [tuple(r) for r in rows.orderBy("a").collect()] == [(f"1-{i}", f"2-{i}", None) for i in range(3)]
    unlike = by_header(raw, ["a", "b", "gone"], headers.withColumn("csv_file", F.lit("other")))
    assert [tuple(r) for r in unlike.orderBy("a").collect()] == [(f"0-{i}", f"1-{i}", f"2-{i}") for i in range(3)]
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "Join" in plan and "array_position" not in plan[: plan.index("Join")]
