"""Report lines to a text file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ``line`` in (section, ord) order as one text file; for reports, whose sections are cut to n rows."""
    one_file = lines.repartition(1).sortWithinPartitions("section", "ord")
    one_file.select("line").write.mode("overwrite").text(path)
