"""Named tables: sources by (group, table), models by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _view(group: str, name: str) -> str:
    return f"{group}__{name}"


def register_view(df: DataFrame, name: str, group: str | None = None) -> None:
    df.createOrReplaceTempView(_view(group, name) if group else name)


def named_source(spark: SparkSession, group: str, name: str) -> DataFrame:
    """Source table of a group: a registered view first, a catalog table ``group.name`` otherwise."""
    view = _view(group, name)
    return spark.table(view if spark.catalog.tableExists(view) else f"{group}.{name}")


def model(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
