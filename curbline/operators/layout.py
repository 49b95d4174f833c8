"""How rows lie in files: which files a predicate on a time has to open."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rows_a_file(rows: int, least: int, files: int) -> int:
    """Rows of a file so that ``rows`` lie in about ``files`` files: a fixed number would make files, each with its cost, grow with the table."""
    return max(least, -(-rows // files))


def file_spans(table: DataFrame, time: str) -> DataFrame:
    """file, first, last, row_count: the span of days of each file of a table read from files."""
    day = F.to_date(time)
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count("*").alias("row_count"))


def files_met(spans: DataFrame, days: DataFrame) -> DataFrame:
    """day, files: how many files a one-day predicate meets, for each of ``days`` (day).

    A file is met on every day of its span, as its footer tells the reader no more than the span. Files are spread over
    their days, so there is no range join: a clustered file has few, and the calendar bounds the others.
    """
    spread = spans.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.join(spread.groupBy("day").agg(F.count("*").alias("files")), "day", "left").na.fill(0, ["files"])
