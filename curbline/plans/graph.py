"""Models declared by name, with what they read and what must hold of them.

A model says which models and sources it reads and gets just those; the order of building follows. A model whose checks
fail stops what depends on it, directly or further on, and nothing else. Small models are views, large ones tables. Of a view
that several models read the rows are kept during the run, so that it is computed once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.catalog import named_source, register_view

Refs = Mapping[str, DataFrame]
BUILT, FAILED, SKIPPED = "built", "failed", "skipped"


class GraphError(ValueError):
    """The declarations contradict each other."""


@dataclass(frozen=True)
class Model:
    """``build`` and ``checks`` get the frames named in ``reads`` ("group.table" is a source); ``checks`` also the model itself.

    ``kind`` is "view", computed where it is read if one model reads it, or "table", written once to a folder of its own.
    """

    name: str
    build: Callable[[Refs], DataFrame]
    reads: tuple[str, ...] = ()
    kind: str = "view"
    checks: Callable[[DataFrame, Refs], DataFrame] | None = None


def ordered(models: Iterable[Model]) -> list[Model]:
    """Models so that each comes after what it reads; of those that could come next, the one declared first."""
    by_name: dict[str, Model] = {}
    for m in models:
        if m.name in by_name:
            raise GraphError(f"model {m.name} is declared twice")
        by_name[m.name] = m
    for m in by_name.values():
        unknown = [r for r in m.reads if "." not in r and r not in by_name]
        if unknown:
            raise GraphError(f"model {m.name} reads {unknown}, which nothing declares")
    sorter = TopologicalSorter({m.name: [r for r in m.reads if "." not in r] for m in by_name.values()})
    try:
        sorter.prepare()
    except CycleError as err:
        raise GraphError("models read each other: " + " <- ".join(err.args[1])) from err
    place, out = {n: i for i, n in enumerate(by_name)}, []
    while sorter.is_active():
        ready = sorted(sorter.get_ready(), key=place.__getitem__)
        out += [by_name[n] for n in ready]
        sorter.done(*ready)
    return out


def run_graph(spark: SparkSession, models: Iterable[Model], root: str) -> DataFrame:
    """Build models in order below the folder ``root``; returns model, kind, status, failed_check, stopped_by.

    Built models are registered as views of their names. A failed model is built, for a look at its rows, but nothing reads it.
    """
    models = ordered(models)
    readers = Counter(r for m in models for r in set(m.reads))
    built: dict[str, DataFrame] = {}
    stopped: dict[str, str] = {}
    report = []
    for m in models:
        cause = next((stopped[r] for r in m.reads if r in stopped), None)
        if cause:
            stopped[m.name] = cause
            report.append((m.name, m.kind, SKIPPED, None, cause))
            continue
        refs = {r: named_source(spark, *r.split(".", 1)) if "." in r else built[r] for r in m.reads}
        frame = m.build(refs)
        if m.kind == "table" or readers[m.name] > 1:
            folder = f"{root}/{m.name}" if m.kind == "table" else f"{root}/_views/{m.name}"
            frame.write.mode("overwrite").parquet(folder)
            frame = spark.read.schema(frame.schema).parquet(folder)
        register_view(frame, m.name)
        failed = sorted(r.check for r in m.checks(frame, refs).where(F.col("status") == "fail").collect()) if m.checks else []
        if failed:
            stopped[m.name] = m.name
        else:
            built[m.name] = frame
        report.append((m.name, m.kind, FAILED if failed else BUILT, ", ".join(failed) or None, None))
    return spark.createDataFrame(report, "model string, kind string, status string, failed_check string, stopped_by string")
