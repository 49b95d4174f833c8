"""Which steps of a month's run have finished, kept beside the lake, so that a failed run goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date
from typing import Any

from pyspark.sql import SparkSession

from ..session import list_files, remove_tree
from ..sources.files import read_table


def fingerprint(spark: SparkSession, path: str) -> str:
    """Of names, sizes and times of the files at ``path``: another file is another run."""
    return hashlib.sha256(json.dumps(list_files(spark, path)).encode()).hexdigest()


class Journal:
    """Steps of the run of one month. ``source`` names the input; entries of another input count for nothing."""

    def __init__(self, spark: SparkSession, path: str, month: date, source: str):
        self.spark, self.path, self.source = spark, f"{path}/run={month:%Y-%m}", source
        rows = read_table(spark, self.path)
        self.found = {r.step: r.result for r in rows.collect() if r.source == source} if rows is not None else {}
        self.run: list[str] = []

    def step(self, name: str, work: Callable[[], Any]) -> Any:
        """What ``work`` returns (a JSON value): of an earlier run if that finished the step, and all before it."""
        if name in self.found:
            return json.loads(self.found[name])
        result = work()
        # A step that runs again makes those after it stale.
        self.found = {}
        self.run.append(name)
        row = self.spark.createDataFrame([(name, self.source, json.dumps(result))], "step string, source string, result string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/at={name}")
        return result

    def forget(self) -> None:
        """Start anew."""
        remove_tree(self.spark, self.path)
        self.found = {}
