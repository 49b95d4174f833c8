"""File scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..session import folder_exists


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_month(spark: SparkSession, path: str, year: int, month: int,
               schema: StructType | None = None) -> DataFrame:
    """One month of a partitioned table; only that month's folder is listed and read."""
    reader = spark.read.schema(schema) if schema else spark.read
    folder = f"{path}/year={year}/month={month}"
    if folder_exists(spark, folder):
        return reader.option("basePath", path).parquet(folder)
    return reader.parquet(path).where((F.col("year") == year) & (F.col("month") == month))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None where none has been written yet."""
    if not folder_exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header. "N/A" is text here, not NULL."""
    return spark.read.csv(path, header=True, schema=schemas.ZONE_LOOKUP, quote='"')


def read_gold_for_load(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """A gold month with upper-case names, as case-folding warehouses store them."""
    month_rows = read_month(spark, path, year, month)
    return month_rows.toDF(*(c.upper() for c in month_rows.columns))
