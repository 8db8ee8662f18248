import pytest
from pyspark.sql import functions as F

from vigilog.functions.casts import blank_tokens, cast_columns, cast_to_schema, tolerant, tolerant_timestamp
from vigilog.functions.keys import hash_bucket
from vigilog.functions.text import row_line
from vigilog.schema import EVENT_SCHEMA, as_strings


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_malformed_numbers_become_null(spark, ansi):
    cells = spark.createDataFrame([("1.5", "7"), ("bad", ""), (None, "503.0"), ("12", "x9")], "a string, n string")
    cast = cast_columns(cells, {"a": "double", "n": "bigint"})
    assert [tuple(r) for r in cast.collect()] == [(1.5, 7), (None, None), (None, 503), (12.0, None)]
    assert cast.dtypes == [("a", "double"), ("n", "bigint")]


def test_whole_number_casts_keep_large_values(spark):
    cells = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",), ("-3.9",)], "n string")
    assert [r[0] for r in cells.select(tolerant("n", "bigint")).collect()] == [9223372036854775807, None, -3]


def test_malformed_times_become_null(spark, ansi):
    cells = spark.createDataFrame([("2024-05-06 07:08:09",), ("nope",), (None,)], "t string")
    parsed = cells.select(F.hour(tolerant_timestamp(cells, "t")))
    assert [r[0] for r in parsed.collect()] == [7, None, None]


def test_typed_column_is_not_cast_again(spark):
    typed = spark.createDataFrame([(1.0,)], "a double")
    assert cast_columns(typed, {"a": "double"}).columns == ["a"]


def test_schema_cast_ignores_other_columns(spark):
    text = spark.createDataFrame([("80", "x", "keep")], "`Source Port` string, Protocol string, other string")
    cast = cast_to_schema(text, EVENT_SCHEMA)
    assert dict(cast.dtypes) == {"Source Port": "int", "Protocol": "string", "other": "string"}


def test_tokens_become_null_in_text_only(spark, rows):
    frame = spark.createDataFrame([("NA", 1), ("n/a", 2), ("TCP", 3), (None, 4)], "p string, n int")
    assert rows(blank_tokens(frame), "n", "p") == [(1, None), (2, None), (3, "TCP"), (4, None)]


def test_schema_has_26_columns():
    assert len(EVENT_SCHEMA) == 26 and all(f.nullable for f in EVENT_SCHEMA)
    assert {f.dataType.simpleString() for f in as_strings(EVENT_SCHEMA)} == {"string"}


def test_row_line_spells_null(spark):
    frame = spark.createDataFrame([("High", None, 3)], "s string, p string, n bigint")
    assert frame.select(row_line(*[F.col(c) for c in frame.columns])).first()[0] == "High | NULL | 3"


def test_hash_bucket_is_the_md5_prefix(spark):
    import hashlib

    buckets = spark.range(50).select("id", hash_bucket("id"))
    assert all(b == int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 100 for i, b in buckets.collect())
