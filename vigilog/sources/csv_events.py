"""CSV event tables, batch and streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.functions.casts import blank_tokens, cast_to_schema
from vigilog.schema import EVENT_SCHEMA, STATIC_SCHEMA, as_strings
from vigilog.session import written

#: Quoted cells may hold commas, doubled quotes and line breaks.
QUOTING = {"header": "true", "quote": '"', "escape": '"'}

_NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def records_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether some quoted cell holds a line break.

    Such a cell opens with a quote and is not closed on its line; a quote inside an unquoted cell counts for
    nothing. The text scan is splittable and stops at the first such line.
    """
    undoubled = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    unquoted = F.regexp_replace(undoubled, '(^|,)"[^"]*"(?=,|$)', ",")
    return not spark.read.text(path).filter(unquoted.rlike('(^|,)"')).isEmpty()


#: Where a raw row comes from, and the header of that file.
_FILE, _HEADER = "csv_file", "csv_header"

#: Where the known columns stand in such a file.
_PLACES = "csv_places"


#: Columns that the files of a path may have together.
MOST_COLUMNS = 10_000

#: Cells beyond the known columns that a raw row may have.
_SPARE = 16


def _raw_schema(names: Sequence[str]) -> T.StructType:
    """Cells by position, whatever the header says."""
    return T.StructType([T.StructField(f"cell_{i}", T.StringType()) for i in range(len(names) + _SPARE)])


def _cells(names: Sequence[str]) -> Column:
    return F.array(*[F.col(f"cell_{i}") for i in range(len(names) + _SPARE)])


def _is_header(cells: Column, names: Sequence[str]) -> Column:
    """Whether the first cell and most of all cells that are there are column names; the others are looked at if the first one is."""
    known = [F.lit(n) for n in names]
    there = F.filter(cells, lambda c: c.isNotNull())
    given = F.filter(there, lambda c: c.isin(*known))
    return F.when(F.get(cells, 0).isin(*known), 2 * F.size(given) > F.size(there)).otherwise(F.lit(False))


def other_headers(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame | None:
    """``csv_file`` and ``csv_header`` of the files whose header isn't ``names`` in this order; None if there are none.

    A path of one file has none. Else one splittable scan of the text looks at the lines that begin with the name of a column, of
    ``names`` or of the event table.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) < 2:
        return None
    known = [*names, *[n for n in EVENT_SCHEMA.names if n not in names]]
    bare = F.regexp_replace("value", '["\\r]', "")
    begun = lines.select(bare.alias("line"), F.col("_metadata.file_path").alias(_FILE)).filter(F.substring_index("line", ",", 1).isin(known))
    ordered = F.array(*[F.lit(n) for n in names])
    cells = F.split("line", ",")
    found = begun.select(_FILE, cells.alias(_HEADER)).filter(_is_header(F.col(_HEADER), known) & (F.col(_HEADER) != ordered))
    headers = written(found.groupBy(_FILE).agg(F.first(_HEADER).alias(_HEADER)), "headers")
    return None if headers.isEmpty() else headers


def by_header(raw: DataFrame, names: Sequence[str], headers: DataFrame) -> DataFrame:
    """The columns ``names`` of raw rows (cells by position and their file), each file by its own header; headers are left out.

    ``headers`` holds a row for each file whose header may have another order, others go by position; Spark broadcasts it while
    it is small. A column that a file lacks is NULL there, one that isn't among ``names`` is left out.
    """
    places = F.array(*[F.array_position(_HEADER, name).cast("int") - 1 for name in names])  # once for each file
    own = F.coalesce(_PLACES, F.array(*[F.lit(i) for i in range(len(names))])).alias(_PLACES)
    cells = F.array(*[F.col(c) for c in raw.columns if c != _FILE])
    known = [*names, *[n for n in EVENT_SCHEMA.names if n not in names]]
    held = raw.join(headers.select(_FILE, places.alias(_PLACES)), _FILE, "left").select(cells.alias("csv_cells"), own)
    rows = held.filter(~_is_header(F.col("csv_cells"), known))
    return rows.select(*[F.get("csv_cells", F.get(_PLACES, F.lit(i))).alias(name) for i, name in enumerate(names)])


def named_rows(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns ``names`` of a micro-batch of raw rows, whose headers are rows among them."""
    found = raw.select(F.col(_FILE).alias(_FILE), _cells(names).alias(_HEADER)).filter(_is_header(F.col(_HEADER), names))
    return by_header(raw, names, found.groupBy(_FILE).agg(F.first(_HEADER).alias(_HEADER)))


def read_csv_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    multiline: bool | None = None,
    na_tokens: Iterable[str] = (),
) -> DataFrame:
    """A CSV table with a header in every file; files may have columns in different orders, and some that others lack.

    Without ``schema`` every column is a string named by the header, or with ``infer`` of the type Spark
    finds (one scan more). ``multiline`` makes a file one task, so by default it is on only if a cheap
    splittable scan finds a record that needs it. Cells among ``na_tokens`` become NULL.
    """
    if multiline is None:
        multiline = records_span_lines(spark, path)
    reader = spark.read.options(**QUOTING).option("multiLine", multiline).option("inferSchema", infer)
    frame = (reader if schema is None else reader.schema(schema)).csv(path)
    headers = other_headers(spark, path, frame.columns)
    if headers is not None:
        names = frame.columns
        if schema is None:
            more = headers.select(F.explode(_HEADER).alias("name")).distinct().filter(~F.col("name").isin(names))
            names = [*names, *[r.name for r in more.orderBy("name").limit(MOST_COLUMNS).collect()]]
        raw = spark.read.options(**QUOTING | {"header": "false"}).option("multiLine", multiline).schema(_raw_schema(names)).csv(path)
        text = by_header(raw.withColumn(_FILE, F.col("_metadata.file_path")), names, headers)
        frame = cast_to_schema(text, frame.schema)  # inferred types hold for the first file: a cell that has another is NULL
    tokens = list(na_tokens)
    return blank_tokens(frame, tokens) if tokens else frame


def typed_events(frame: DataFrame) -> DataFrame:
    """An all-string event table with the event types; malformed cells become NULL."""
    return cast_to_schema(frame, EVENT_SCHEMA)


def or_empty(read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType = STATIC_SCHEMA) -> DataFrame:
    """What ``read`` returns, or an empty frame when there is nothing at its path yet."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() in _NOTHING_THERE:
            return spark.createDataFrame([], schema)
        raise


def stream_csv_events(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = EVENT_SCHEMA,
    multiline: bool = True,
    max_files: int | None = None,
    na_tokens: Iterable[str] = (),
) -> DataFrame:
    """The CSV files dropped into a folder, as a stream of rows parsed as the batch parses them: read as text,
    cells among ``na_tokens`` made NULL, then cast to ``schema``.

    Columns go by position: see ``stream_raw_csv`` for files with headers in different orders. Every file is read once:
    producers must drop whole new files, rows appended to a file already read are not seen. Turn ``multiline`` off for feeds
    without line breaks in cells, so that large files split.
    """
    reader = _streamed(spark, as_strings(schema), multiline, max_files, header=True)
    frame, tokens = reader.csv(folder), list(na_tokens)
    return cast_to_schema(blank_tokens(frame, tokens) if tokens else frame, schema)


def _streamed(spark: SparkSession, schema: T.StructType, multiline: bool, max_files: int | None, header: bool):
    options = QUOTING | {"header": str(header).lower(), "multiLine": multiline}
    reader = spark.readStream.schema(schema).options(**options)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def stream_raw_csv(
    spark: SparkSession, folder: str, schema: T.StructType = EVENT_SCHEMA, multiline: bool = True, max_files: int | None = None
) -> DataFrame:
    """The CSV files dropped into a folder, as cells by position and the file they stand in, headers among the rows.

    ``raw_events`` makes events of each micro-batch, whose files are whole.
    """
    raw = _streamed(spark, _raw_schema(schema.names), multiline, max_files, header=False).csv(folder)
    return raw.withColumn(_FILE, F.col("_metadata.file_path"))


def raw_events(schema: T.StructType = EVENT_SCHEMA, na_tokens: Iterable[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Makes events of a micro-batch of ``stream_raw_csv``: columns by the header of their file, cells as the batch parses them."""
    tokens = list(na_tokens)

    def events(raw: DataFrame) -> DataFrame:
        frame = named_rows(raw, schema.names)
        return cast_to_schema(blank_tokens(frame, tokens) if tokens else frame, schema)

    return events
