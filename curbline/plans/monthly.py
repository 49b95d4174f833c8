"""One month end to end, and a range of months."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import check_states as states, checks, reconcile as recon
from ..operators.checks import gate
from ..sources.files import read_month
from .journal import Journal, fingerprint
from .lake import Lake, build_gold, build_silver, ingest_bronze
from .marts import (build_dimensions, build_fct_trips, load_warehouse_month, loaded_checks, month_checks, record_run, run_history,
                    volume_check)


def run_month(spark: SparkSession, lake: Lake, raw_path: str, run_month: date, zone_csv: str, calendar: tuple[date, date],
              as_of: datetime, demand: str | None = None, resume: bool = False) -> dict[str, float]:
    """Raw file to checked marts. Stops at the first failing gate; running it again changes nothing.

    Gates, in this order: the age of the source before silver is built, the models' checks before the run counts, the month's
    volume against the months before it, the runtime checks as of ``as_of``; and, if ``demand`` names the speed layer's table,
    the checks of that table and the drift between the layers. ``as_of`` is the time that ages are seen from: for replayed
    history a time in that history. The month's volume is stored when all gates have passed.

    Finished steps are noted beside the lake. With ``resume`` a run of the same raw file, zones and calendar goes
    on where the last one stopped.
    """
    year, month = run_month.year, run_month.month
    inputs = f"{fingerprint(spark, raw_path)} {fingerprint(spark, zone_csv)} {calendar[0]} {calendar[1]}"
    journal = Journal(spark, lake.journal, run_month, inputs)
    if not resume:
        journal.forget()
    step = journal.step
    step("bronze", lambda: ingest_bronze(spark, lake, raw_path, year, month))
    step("source_gate", lambda: gate(checks.run_checks(read_month(spark, lake.bronze, year, month, schemas.BRONZE), [checks.source_freshness(as_of)])))
    metrics = step("silver", lambda: build_silver(spark, lake, year, month))
    step("gold", lambda: build_gold(spark, lake, year, month))
    step("warehouse", lambda: load_warehouse_month(spark, lake, year, month))
    step("dimensions", lambda: build_dimensions(spark, lake, zone_csv, *calendar))
    written = step("facts", lambda: build_fct_trips(spark, lake, run_month))
    step("states", lambda: states.update_states(spark, lake.fct_trips, lake.states, [(y, m) for y, m in written]))
    fct, zones, dates = read_marts(spark, lake)
    step("model_gate", lambda: gate(month_checks(spark, lake, zones, dates)))
    step("volume_gate", lambda: gate(volume_check(run_history(spark, lake, run_month), run_month)))
    step("runtime_gate", lambda: gate(loaded_checks(spark, lake, as_of)))
    if demand:
        live = spark.read.schema(schemas.ZONE_DEMAND).parquet(demand)
        step("live_gate", lambda: gate(checks.run_checks(live, checks.demand_checks(as_of))))
        recent = recon.recent_trips(spark, lake.fct_trips, states.spans(spark, lake.states), as_of)
        step("drift_gate", lambda: recon.assert_reconciled(recon.reconcile(recent, live, as_of)))
    step("history", lambda: record_run(spark, lake, run_month))
    return metrics


def read_marts(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (spark.read.schema(schemas.FCT_TRIPS).parquet(lake.fct_trips),
            spark.read.parquet(lake.dim_zones), spark.read.parquet(lake.dim_date))


def backfill(spark: SparkSession, lake: Lake, raw_path_of: Callable[[date], str], months: Iterable[date], zone_csv: str,
             calendar: tuple[date, date], as_of: Callable[[date], datetime], demand: str | None = None,
             resume: bool = True) -> dict[date, dict[str, float]]:
    """Run months in order. Each is one set of jobs over its own files and partitions.

    ``as_of`` says for a month the time that its ages are seen from. A backfill that failed is called again: finished months
    and steps of the same inputs are passed over. ``resume=False`` runs all of them anew.
    """
    return {m: run_month(spark, lake, raw_path_of(m), m, zone_csv, calendar, as_of(m), demand, resume) for m in months}
