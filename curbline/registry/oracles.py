"""The same queries as SQL over the star tables, for an independent engine.

Written as a chain of named subqueries; each oracle lists the ones it needs.
"""

from __future__ import annotations

_CTE: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, needs: list[str], sql: str) -> None:
    _CTE[name] = (needs, sql)


def _with(needs: list[str], body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _CTE[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in ordered) + "\n" + body


def _sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def _avg(c: str) -> str:
    return f"{_sum(c)} / NULLIF(count({c}), 0)"


def _md5(*parts: str) -> str:
    texts = ", ".join(f"COALESCE(CAST({p} AS VARCHAR), '<null>')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


_KEY = "pickup_datetime, dropoff_datetime, pickup_zone_id, dropoff_zone_id, total_amount"
_TRIP_MD5 = _md5("epoch_us(pickup_datetime)", "epoch_us(dropoff_datetime)", "pickup_zone_id",
                 "dropoff_zone_id", "CAST(CAST(total_amount AS DECIMAL(18,4)) * 10000 AS BIGINT)")
_GATE = """pickup_datetime < dropoff_datetime AND fare_amount >= 0 AND total_amount >= 0
    AND payment_type IN (1, 2, 3, 4, 5, 6) AND pickup_zone_id IS NOT NULL AND dropoff_zone_id IS NOT NULL"""
# Of copies, one the gate accepts, then the most complete, then by value.
_VALID_FIRST = """NOT COALESCE(fare_amount >= 0, FALSE), NOT COALESCE(payment_type IN (1, 2, 3, 4, 5, 6), FALSE),
    CAST(passenger_count IS NULL AS INTEGER) + CAST(trip_distance IS NULL AS INTEGER) + CAST(fare_amount IS NULL AS INTEGER)
      + CAST(tip_amount IS NULL AS INTEGER) + CAST(payment_type IS NULL AS INTEGER)"""
_MARCH = "year = 1998 AND month = 3"

_cte("raw_once", [], """
  SELECT l_orderkey,
    CASE WHEN l_orderkey % 101 <> 0
         THEN l_shipdate + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 11) % 1440 AS BIGINT)) END AS tpep_pickup_datetime,
    CASE WHEN l_orderkey % 103 <> 0
         THEN l_shipdate + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 11) % 1440 + l_quantity - 3 AS BIGINT)) END AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 97 <> 0 THEN l_suppkey % 26 END AS PULocationID,
    CASE WHEN l_partkey % 89 <> 0 THEN l_partkey % 25 END AS DOLocationID,
    CASE WHEN l_linenumber <> 6 THEN l_linenumber END AS passenger_count,
    l_quantity * 4.5 AS trip_distance,
    CASE WHEN l_orderkey % 107 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 3000 AS DOUBLE) END AS fare_amount,
    CAST(CAST(l_discount * 100 AS DECIMAL(18,0)) AS DOUBLE) AS tip_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 3100 + CAST(l_discount * 100 AS DECIMAL(18,0)) AS DOUBLE) AS total_amount,
    l_linenumber AS payment_type,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
  FROM lineitem""")
_cte("raw_trips", ["raw_once"], """
  SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE l_orderkey % 211 = 0
  UNION ALL SELECT * REPLACE (CAST(NULL AS DOUBLE) AS fare_amount, passenger_count - 1 AS passenger_count)
    FROM raw_once WHERE l_orderkey % 211 <> 0 AND l_orderkey % 223 = 0
  UNION ALL SELECT * REPLACE (9 AS payment_type, passenger_count - 1 AS passenger_count)
    FROM raw_once WHERE l_orderkey % 211 <> 0 AND l_orderkey % 223 <> 0 AND l_orderkey % 227 = 0""")
def _lake(prefix: str, raw: str) -> None:
    _cte(prefix + "bronze", [raw], f"""
  SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    CAST(PULocationID AS INTEGER) AS pickup_zone_id, CAST(DOLocationID AS INTEGER) AS dropoff_zone_id,
    CAST(passenger_count AS INTEGER) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
    fare_amount, tip_amount, total_amount, CAST(payment_type AS INTEGER) AS payment_type,
    CAST(NULL AS DOUBLE) AS airport_fee, year, month
  FROM {raw}""")
    _cte(prefix + "tagged", [prefix + "bronze"], f"""
  SELECT *, CASE WHEN pickup_datetime IS NULL THEN 'null_pickup'
                 WHEN dropoff_datetime IS NULL THEN 'null_dropoff'
                 WHEN dropoff_datetime <= pickup_datetime THEN 'zero_or_negative_duration'
                 WHEN fare_amount < 0 THEN 'negative_fare'
                 WHEN trip_distance > 200 THEN 'absurd_distance' END AS _reject_reason
  FROM {prefix}bronze""")
    _cte(prefix + "silver", [prefix + "tagged"], f"""
  SELECT * EXCLUDE (_reject_reason) FROM {prefix}tagged WHERE _reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY {_KEY}, year, month
    ORDER BY {_VALID_FIRST}, passenger_count NULLS LAST, trip_distance NULLS LAST, fare_amount NULLS LAST,
             tip_amount NULLS LAST, payment_type NULLS LAST) = 1""")


def _staged(name: str, source: str, where: str = "TRUE") -> None:
    _cte(name, [source], f"""
  SELECT {_TRIP_MD5} AS trip_sk, pickup_datetime, dropoff_datetime,
    date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    pickup_zone_id, dropoff_zone_id, passenger_count, trip_distance, fare_amount, tip_amount,
    total_amount, payment_type, year, month
  FROM (SELECT * FROM {source} WHERE {where} AND {_GATE}
        QUALIFY row_number() OVER (PARTITION BY {_KEY}
          ORDER BY {_VALID_FIRST}, passenger_count NULLS LAST, trip_distance NULLS LAST, fare_amount NULLS LAST,
                   tip_amount NULLS LAST, payment_type NULLS LAST, year, month) = 1)""")


_lake("", "raw_trips")
_staged("fct", "silver")
_staged("fct_march", "silver", _MARCH)
# Two months whose fares are of a usual size and whose zones are all known, as the chain's gates want them.
_cte("chain_raw", ["raw_trips"], """
  SELECT * REPLACE (PULocationID % 25 AS PULocationID, floor(fare_amount / 10) / 100 AS fare_amount, floor(total_amount / 10) / 100 AS total_amount)
  FROM raw_trips WHERE year = 1998 AND month IN (2, 3)""")
_lake("chain_", "chain_raw")
_staged("chain_fct", "chain_silver")
_cte("zones", [], """
  SELECT n_nationkey AS zone_id, r_name AS borough, n_name AS zone_name,
    CASE WHEN n_nationkey % 5 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
_cte("dates", ["bronze"], """
  SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%a') AS day_name, strftime(d, '%b') AS month_name,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(week(d) AS INTEGER) AS week_of_year, isodow(d) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(min(CAST(pickup_datetime AS DATE)), max(CAST(pickup_datetime AS DATE)),
                                      INTERVAL 1 DAY)) AS d FROM bronze)""")
_cte("trip_events", [], """
  SELECT 'e' || event_id AS trip_id, ts AS dropoff_datetime,
    CAST(CASE WHEN event_id % 97 <> 0 THEN user_id % 25 END AS INTEGER) AS pickup_zone_id,
    value AS fare_amount, value AS total_amount
  FROM events""")
_cte("sane", ["raw_trips"], """
  SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    CAST(PULocationID AS INTEGER) AS pickup_zone_id, CAST(DOLocationID AS INTEGER) AS dropoff_zone_id,
    CAST(passenger_count AS INTEGER) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
    fare_amount, tip_amount, total_amount, CAST(payment_type AS INTEGER) AS payment_type
  FROM raw_trips WHERE tpep_dropoff_datetime > tpep_pickup_datetime""")


def _demand(name: str, source: str) -> None:
    _cte(name, [source], f"""
  SELECT time_bucket(INTERVAL 5 MINUTE, dropoff_datetime) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, dropoff_datetime) + INTERVAL 5 MINUTE AS window_end, pickup_zone_id,
    count(*) AS trip_count, {_avg('fare_amount')} AS avg_fare, {_sum('total_amount')} AS total_revenue
  FROM {source} WHERE pickup_zone_id IS NOT NULL GROUP BY ALL""")


_demand("demand", "trip_events")
_demand("speed", "sane")


def _hop(name: str, minutes: int, slide: int) -> None:
    _cte(name, ["trip_events"], f"""
  SELECT pickup_zone_id, window_start, window_start + INTERVAL {minutes} MINUTE AS window_end,
    {_avg('fare_amount')} AS zone_avg_fare
  FROM (SELECT *, time_bucket(INTERVAL {slide} MINUTE, dropoff_datetime)
               - to_minutes(CAST(unnest(range(0, {minutes}, {slide})) AS BIGINT)) AS window_start FROM trip_events)
  GROUP BY pickup_zone_id, window_start""")
    _cte(name + "_anomalies", ["trip_events", name], f"""
  SELECT e.trip_id, e.dropoff_datetime, e.pickup_zone_id, e.fare_amount, z.zone_avg_fare,
    e.fare_amount / NULLIF(z.zone_avg_fare, 0) AS deviation_ratio
  FROM trip_events e JOIN {name} z ON e.pickup_zone_id = z.pickup_zone_id
    AND e.dropoff_datetime >= z.window_start AND e.dropoff_datetime < z.window_end
  WHERE e.fare_amount > 3 * z.zone_avg_fare""")


_hop("hop", 30, 5)
_hop("stream_hop", 12 * 60, 2 * 60)
# A stream that has run to its end has closed what ended before its newest event less the delay.
_cte("closed", ["trip_events"], """
  SELECT max(dropoff_datetime) FILTER (pickup_zone_id IS NOT NULL) - INTERVAL 150 SECOND AS closed_at FROM trip_events""")
_cte("closed_demand", ["demand", "closed"], "SELECT * FROM demand WHERE window_end <= (SELECT closed_at FROM closed)")
_hop("wide", 36 * 60, 6 * 60)
_cte("batch_recount", ["fct"], """
  SELECT time_bucket(INTERVAL 5 MINUTE, dropoff_datetime) AS window_start, pickup_zone_id, count(*) AS batch_count
  FROM fct GROUP BY ALL""")
def _drifts(name: str, batch: str, speed: str) -> None:
    _cte(name, [batch, speed], f"""
  SELECT * FROM (
    SELECT COALESCE(b.window_start, s.window_start) AS window_start,
      COALESCE(b.pickup_zone_id, s.pickup_zone_id) AS zone_id,
      COALESCE(b.batch_count, 0) AS batch_count, COALESCE(s.trip_count, 0) AS speed_count,
      abs(COALESCE(b.batch_count, 0) - COALESCE(s.trip_count, 0))
        / NULLIF(greatest(COALESCE(b.batch_count, 0), COALESCE(s.trip_count, 0)), 0) AS rel_diff
    FROM {batch} b FULL OUTER JOIN {speed} s
      ON b.window_start = s.window_start AND b.pickup_zone_id = s.pickup_zone_id)
  WHERE rel_diff > 0.01""")


_drifts("drifts", "batch_recount", "speed")
_DAY = "TIMESTAMP '2001-06-14 12:05:00'"
_cte("batch_recount_day", ["batch_recount"], f"SELECT * FROM batch_recount WHERE window_start >= {_DAY}")
_cte("speed_day", ["speed"], f"SELECT * FROM speed WHERE window_start >= {_DAY}")
_drifts("drifts_day", "batch_recount_day", "speed_day")
_cte("monthly", ["fct"], """
  SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month_start, count(*) AS trips FROM fct GROUP BY ALL""")


def _totals(source: str) -> str:
    return f"""SELECT year, month, pickup_zone_id, count(*) AS row_count, {_sum('total_amount')} AS total_revenue
FROM {source} GROUP BY ALL"""


def _check(name: str, observed: str, passes: str, threshold: str, source: str, warns: str = "FALSE") -> str:
    return f"""SELECT '{name}' AS "check",
  CASE WHEN o IS NULL THEN 'not_evaluated' WHEN {passes} THEN 'pass' WHEN {warns} THEN 'warn' ELSE 'fail' END AS status,
  o AS observed, '{threshold}' AS threshold FROM (SELECT CAST({observed} AS DOUBLE) AS o FROM {source})"""


def _all(*checks: str) -> str:
    return "\nUNION ALL\n".join(checks)


def _repeated(table: str, column: str) -> str:
    return f"""(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""


def _null_check(table: str, source: str, column: str) -> str:
    return _check(f"not_null({table}.{column})", f"count(*) FILTER (WHERE {column} IS NULL)", "o = 0", "= 0", source)


def _age(column: str, as_of: str) -> str:
    return f"(epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({column}))) / CAST(3.6e9 AS DOUBLE)"


_TRIPS_AS_OF, _EVENTS_AS_OF = "2002-01-01 00:00:00", "2024-01-31 00:00:00"


def _model_checks(fct: str) -> list[str]:
    """The checks that gate the models, over any fact table."""
    return [
        *(_null_check("fct_trips", fct, c) for c in ("trip_sk", "pickup_zone_id", "trip_duration_minutes")),
        _check("accepted_values(fct_trips.payment_type)",
               "count(*) FILTER (WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6))", "o = 0", "= 0", fct),
        _check("zero_duration_trips", "count(*) FILTER (WHERE pickup_datetime >= dropoff_datetime)",
               "o = 0", "= 0", fct),
        _null_check("dim_zones", "zones", "zone_id"), _null_check("dim_date", "dates", "date_day"),
        *(_check(f"unique({t}.{c})", "count(*)", "o = 0", "= 0", _repeated(s, c))
          for t, s, c in (("fct_trips", fct, "trip_sk"), ("dim_zones", "zones", "zone_id"),
                      ("dim_date", "dates", "date_day"))),
        _check("relationships(fct_trips.pickup_zone_id)", "count(*)", "o = 0", "= 0",
               f"(SELECT * FROM {fct} WHERE pickup_zone_id NOT IN (SELECT zone_id FROM zones))")]


def _fact_checks(fct: str) -> list[str]:
    """The checks of the loaded fact table, freshness aside."""
    return [
        _check("row_count(fct_trips)", "count(*)", "o > 0", "> 0", fct),
        _check("missing_count(fare_amount)", "count(*) - count(fare_amount)", "o = 0", "= 0", fct),
        _check("min(fare_amount)", "min(fare_amount)", "o >= 0", ">= 0", fct),
        _check("max(trip_duration_minutes)", "max(trip_duration_minutes)", "o < 300", "< 300", fct),
        _check("invalid_percent(payment_type)",
               "100.0 * count(*) FILTER (WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)) / count(*)",
               "o < 0.1", "< 0.1%", fct),
        _check("avg(fare_amount)", _avg("fare_amount"), "o BETWEEN 5 AND 60", "between 5 and 60", fct)]


def _no_repeats(fct: str) -> str:
    return _check("duplicate_count(trip_sk)", "count(*)", "o = 0", "= 0", _repeated(fct, "trip_sk"))


def oracle_sql() -> dict[str, str]:
    return {
        "bronze_normalize": _with(["bronze"], "SELECT * FROM bronze"),
        "bronze_optional_col": _with(["bronze"], "SELECT * REPLACE (tip_amount / 4 AS airport_fee) FROM bronze"),
        "month_scan": _with(["bronze"], f"SELECT * FROM bronze WHERE {_MARCH}"),
        "out_of_month": _with(["bronze"], """
SELECT year, month, count(*) FILTER (WHERE year(pickup_datetime) <> year OR month(pickup_datetime) <> month)
  AS out_of_month FROM bronze GROUP BY ALL"""),
        "reject_reasons": _with(["tagged"], """
SELECT COALESCE(_reject_reason, 'none') AS reject_reason, year, month, count(*) AS row_count FROM tagged GROUP BY ALL"""),
        "quarantine": _with(["tagged"], "SELECT * FROM tagged WHERE _reject_reason IS NOT NULL"),
        "silver_clean": _with(["silver"], "SELECT * FROM silver"),
        "silver_metrics": _with(["tagged"], """
SELECT year, month, count(*) AS silver_total, count(_reject_reason) AS silver_quarantined,
  count(_reject_reason) / greatest(count(*), 1) AS quarantine_pct FROM tagged GROUP BY ALL"""),
        "fct_trips_merge_moved": _with(["fct"], _totals(f"""(
  SELECT * REPLACE (CASE WHEN {_MARCH} AND payment_type = 1 THEN month + 1 ELSE month END AS month) FROM fct)""")),
        "clustered_write": _with(["fct"], _totals("fct")),
        "zone_csv": """SELECT n_nationkey AS zone_id, r_name AS borough,
  CASE WHEN n_nationkey % 7 = 0 THEN 'N/A' ELSE n_name END AS zone_name,
  CASE WHEN n_nationkey % 5 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "reconcile_day": _with(["drifts_day"], "SELECT * FROM drifts_day"),
        "reconcile_gate": _with(["drifts_day"], """SELECT count(*) AS drifts, max(rel_diff) AS largest, count(*) = 0 AS agree
FROM drifts_day"""),
        "amount_extremes": """WITH a AS (SELECT l_linenumber, l_orderkey % 1000 = 7 AS rare,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS usual,
  CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 1099511627776.0::DOUBLE ELSE l_quantity / 1048576.0::DOUBLE END AS odd FROM lineitem)
, s AS (SELECT l_linenumber, rare, sum(odd) AS odd, CAST(sum(usual) AS DOUBLE) AS usual, count(*) AS n FROM a
  GROUP BY l_linenumber, rare)
SELECT l_linenumber, rare, CASE WHEN rare THEN odd ELSE usual END AS total,
  CASE WHEN rare THEN odd ELSE usual END / n AS average FROM s""",
        "daily_zone_agg": _with(["silver"], f"""
SELECT CAST(pickup_datetime AS DATE) AS trip_date, pickup_zone_id, count(*) AS trip_count,
  {_sum('total_amount')} AS total_revenue, {_avg('fare_amount')} AS avg_fare, {_avg('tip_amount')} AS avg_tip, year, month
FROM silver GROUP BY CAST(pickup_datetime AS DATE), pickup_zone_id, year, month"""),
        "replace_partition": _with(["bronze"], _totals("""(
  SELECT * FROM bronze WHERE NOT (year = 1999 OR (year = 2000 AND month = 1))
  UNION ALL SELECT * FROM bronze WHERE year = 1999 AND payment_type = 1)""")),
        "delete_append_month": _with(["silver"], _totals(f"""(
  SELECT * FROM silver WHERE NOT ({_MARCH})
  UNION ALL SELECT * REPLACE (total_amount + 1 AS total_amount) FROM silver WHERE {_MARCH})""")),
        "stg_gate": _with(["silver"], f"SELECT * FROM silver WHERE {_GATE}"),
        "gate_rejects": _with(["silver"], f"""
SELECT *, CASE WHEN NOT COALESCE(pickup_datetime < dropoff_datetime, FALSE) THEN 'duration_not_positive'
  WHEN NOT COALESCE(fare_amount >= 0, FALSE) THEN 'fare_missing_or_negative'
  WHEN NOT COALESCE(total_amount >= 0, FALSE) THEN 'total_missing_or_negative'
  WHEN NOT COALESCE(payment_type IN (1, 2, 3, 4, 5, 6), FALSE) THEN 'payment_type_unknown'
  WHEN pickup_zone_id IS NULL THEN 'pickup_zone_missing' ELSE 'dropoff_zone_missing' END AS _gate_reason
FROM silver WHERE NOT COALESCE({_GATE}, FALSE)"""),
        "staging_loss": _with(["bronze"], f"""
SELECT reason, count(*) AS rows FROM (
  SELECT CASE WHEN NOT COALESCE(pickup_datetime < dropoff_datetime, FALSE) THEN 'duration_not_positive'
    WHEN NOT COALESCE(fare_amount >= 0, FALSE) THEN 'fare_missing_or_negative'
    WHEN NOT COALESCE(total_amount >= 0, FALSE) THEN 'total_missing_or_negative'
    WHEN NOT COALESCE(payment_type IN (1, 2, 3, 4, 5, 6), FALSE) THEN 'payment_type_unknown'
    WHEN pickup_zone_id IS NULL THEN 'pickup_zone_missing'
    WHEN dropoff_zone_id IS NULL THEN 'dropoff_zone_missing'
    WHEN row_number() OVER (PARTITION BY {_KEY}, COALESCE({_GATE}, FALSE)) > 1 THEN 'duplicate' END AS reason
  FROM bronze) WHERE reason IS NOT NULL GROUP BY reason"""),
        "stg_dedup": _with(["bronze"], f"""
SELECT * FROM bronze WHERE {_GATE}
QUALIFY row_number() OVER (PARTITION BY {_KEY}
  ORDER BY {_VALID_FIRST}, passenger_count NULLS LAST, trip_distance NULLS LAST, fare_amount NULLS LAST,
           tip_amount NULLS LAST, payment_type NULLS LAST, year, month) = 1"""),
        "stg_trips": _with(["fct"], "SELECT * FROM fct"),
        "fct_trips_month": _with(["fct_march"], "SELECT * FROM fct_march"),
        "fct_trips_merge": _with(["fct", "fct_march"], f"""
SELECT * FROM fct WHERE NOT ({_MARCH} AND payment_type = 2) AND trip_sk NOT IN (SELECT trip_sk FROM fct_march)
UNION ALL SELECT * REPLACE (tip_amount + 1 AS tip_amount) FROM fct_march"""),
        "dim_zones": _with(["zones"], "SELECT * FROM zones"),
        "dim_date": _with(["dates"], "SELECT * FROM dates"),
        "to_event_stream": _with(["sane"], f"""
SELECT {_TRIP_MD5} AS trip_id, epoch_ms(pickup_datetime) AS pickup_datetime, epoch_ms(dropoff_datetime) AS dropoff_datetime,
  pickup_zone_id, dropoff_zone_id, passenger_count, trip_distance, fare_amount, tip_amount, total_amount, payment_type,
  CAST(COALESCE(pickup_zone_id, 0) AS VARCHAR) AS event_key FROM sane"""),
        "zone_demand_5min": _with(["demand"], "SELECT * FROM demand"),
        "zone_hop_avg": _with(["hop"], "SELECT * FROM hop"),
        "fare_anomalies": _with(["hop_anomalies"], "SELECT * FROM hop_anomalies"),
        "fare_anomalies_wide": _with(["wide_anomalies"], "SELECT * FROM wide_anomalies"),
        "fare_anomalies_once": _with(["wide_anomalies"], """
SELECT * FROM wide_anomalies
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY deviation_ratio DESC, zone_avg_fare) = 1"""),
        "live_demand": _with(["demand"], """
SELECT * FROM demand WHERE window_end > (SELECT max(window_end) FROM demand) - INTERVAL 6 HOUR"""),
        "anomaly_feed": _with(["wide_anomalies"], """
SELECT * FROM wide_anomalies ORDER BY dropoff_datetime DESC, trip_id, deviation_ratio DESC LIMIT 50"""),
        "stream_zone_demand": _with(["closed_demand"], "SELECT * FROM closed_demand"),
        "stream_restart": _with(["closed_demand"], "SELECT * FROM closed_demand"),
        "stream_fare_anomalies": _with(["trip_events", "stream_hop", "closed"], """
SELECT e.trip_id, e.dropoff_datetime, e.pickup_zone_id, e.fare_amount, z.zone_avg_fare,
  e.fare_amount / NULLIF(z.zone_avg_fare, 0) AS deviation_ratio
FROM trip_events e JOIN stream_hop z ON e.pickup_zone_id = z.pickup_zone_id
  AND e.dropoff_datetime >= z.window_start AND e.dropoff_datetime < z.window_end
WHERE e.fare_amount > 3 * z.zone_avg_fare AND z.window_end <= (SELECT closed_at FROM closed)"""),
        "contract_split": _with(["trip_events"], f"""
SELECT violation, pickup_zone_id, count(*) AS messages, {_sum("fare_amount")} AS fares,
  date_trunc('millisecond', min(dropoff_datetime)) AS first, date_trunc('millisecond', max(dropoff_datetime)) AS last
FROM (SELECT violation, CASE WHEN violation IS NULL THEN pickup_zone_id END AS pickup_zone_id,
        CASE WHEN violation IS NULL THEN fare_amount END AS fare_amount, CASE WHEN violation IS NULL THEN dropoff_datetime END AS dropoff_datetime
      FROM (SELECT *, CASE WHEN n IN (7, 13, 17) THEN 'malformed' WHEN n = 11 THEN 'missing trip_id'
                           WHEN n = 19 THEN 'missing trip_id' END AS violation
            FROM (SELECT *, CAST(substr(trip_id, 2) AS BIGINT) % 40 AS n FROM trip_events)))
GROUP BY ALL"""),
        "batch_recount": _with(["batch_recount"], "SELECT * FROM batch_recount"),
        "reconcile_pruned": _with(["drifts_day"], "SELECT * FROM drifts_day"),
        "reconcile": _with(["drifts"], "SELECT * FROM drifts"),
        "reconcile_top": _with(["drifts"], """
SELECT * FROM drifts ORDER BY rel_diff DESC, window_start, zone_id LIMIT 50"""),
        "star_join": _with(["fct", "zones", "dates"], """
SELECT f.*, f.pickup_zone_id AS zone_id, z.borough, z.zone_name, z.service_zone, CAST(f.pickup_datetime AS DATE) AS date_day,
  d.quarter, d.week_of_year, d.day_of_week, d.day_name, d.is_weekend
FROM fct f LEFT JOIN zones z ON f.pickup_zone_id = z.zone_id
  LEFT JOIN dates d ON CAST(f.pickup_datetime AS DATE) = d.date_day"""),
        "bi_measures": _with(["fct"], f"""
SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month_start, count(*) AS trips,
  {_sum('total_amount')} AS total_revenue, {_avg('fare_amount')} AS avg_fare,
  {_sum('tip_amount')} / NULLIF({_sum('fare_amount')}, 0) AS tip_rate
FROM fct GROUP BY 1"""),
        "revenue_trend": _with(["fct"], f"""
SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month_start, {_sum('total_amount')} AS total_revenue
FROM fct GROUP BY 1"""),
        "trips_yoy": _with(["monthly"], """
SELECT m.month_start, m.trips, p.trips AS prev_trips, (m.trips - p.trips) / NULLIF(p.trips, 0) AS yoy
FROM monthly m LEFT JOIN monthly p ON p.month_start = m.month_start - INTERVAL 1 YEAR"""),
        "service_mix": _with(["fct", "zones"], f"""
SELECT service_zone, trips, total_revenue, trips / sum(trips) OVER () AS trip_share,
  total_revenue / CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) OVER () AS DOUBLE) AS revenue_share
FROM (SELECT service_zone, count(*) AS trips, {_sum('total_amount')} AS total_revenue
      FROM fct LEFT JOIN zones ON pickup_zone_id = zone_id GROUP BY service_zone)"""),
        "zone_heatmap": _with(["fct"], """
SELECT pickup_zone_id, dropoff_zone_id, count(*) AS trips FROM fct GROUP BY ALL"""),
        "top_zones": _with(["fct"], """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY direction ORDER BY trips DESC, zone_id) AS INTEGER) AS rank FROM (
    SELECT 'pickup' AS direction, pickup_zone_id AS zone_id, count(*) AS trips FROM fct GROUP BY ALL
    UNION ALL SELECT 'dropoff', dropoff_zone_id, count(*) FROM fct GROUP BY ALL))
WHERE rank <= 10"""),
        "borough_drilldown": _with(["fct", "zones"], f"""
SELECT borough, zone_name, pickup_zone_id AS zone_id, count(*) AS trips, {_sum('total_amount')} AS total_revenue,
  {_avg('fare_amount')} AS avg_fare
FROM fct LEFT JOIN zones ON pickup_zone_id = zones.zone_id GROUP BY borough, zone_name, pickup_zone_id"""),
        "dq_not_null": _with(["fct", "zones", "dates"], _all(
            *(_null_check("fct_trips", "fct", c) for c in ("trip_sk", "pickup_zone_id", "trip_duration_minutes")),
            _null_check("dim_zones", "zones", "zone_id"), _null_check("dim_date", "dates", "date_day"))),
        "dq_unique": _with(["fct", "zones", "dates"], _all(
            *(_check(f"unique({t}.{c})", "count(*)", "o = 0", "= 0", _repeated(s, c))
              for t, s, c in (("fct_trips", "fct", "trip_sk"), ("dim_zones", "zones", "zone_id"),
                              ("dim_date", "dates", "date_day"))))),
        "dq_accepted_values": _with(["silver"], _check(
            "accepted_values(silver.payment_type)",
            "count(*) FILTER (WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6))", "o = 0", "= 0", "silver")),
        "dq_relationships": _with(["fct", "zones"], _check(
            "relationships(fct_trips.pickup_zone_id)", "count(*)", "o = 0", "= 0",
            "(SELECT * FROM fct WHERE pickup_zone_id NOT IN (SELECT zone_id FROM zones))")),
        "dq_zero_duration": _with(["bronze"], _check(
            "zero_duration_trips", "count(*)", "o = 0", "= 0",
            "(SELECT * FROM bronze WHERE pickup_datetime >= dropoff_datetime)")),
        "build_checks": _with(["fct", "zones", "dates"], _all(*_model_checks("fct"))),
        "dq_source_freshness": _with(["bronze"], _check(
            "freshness(_ingested_at)",
            _age("CAST(CAST(dropoff_datetime AS DATE) + 1 AS TIMESTAMP)", _TRIPS_AS_OF), "o <= 26",
            "warn > 26h, error > 48h", "bronze", warns="o <= 48")),
        "dq_freshness": _with(["fct", "demand"], _all(
            _check("freshness(pickup_datetime)", _age("pickup_datetime", _TRIPS_AS_OF), "o < 26", "< 26h", "fct"),
            _check("freshness(window_end)", _age("window_end", _EVENTS_AS_OF), "o < 0.25", "< 0.25h", "demand"))),
        "dq_scan": _with(["fct", "demand"], _all(
            *_fact_checks("fct"), _check("row_count(rt_zone_demand)", "count(*)", "o > 0", "> 0", "demand"))),
        "check_states": _with(["fct", "zones", "dates"], _all(*_model_checks("fct"), *_fact_checks("fct"), _no_repeats("fct"))),
        "clustered_files": _with(["fct"], """
SELECT CAST(pickup_datetime AS DATE) AS day, count(*) AS trips, TRUE AS no_more_files FROM fct GROUP BY 1"""),
        "month_chain": _with(["chain_fct", "zones"], f"""
SELECT "check" AS item, status, observed FROM ({_all(*_fact_checks("chain_fct"), _no_repeats("chain_fct"))})
UNION ALL SELECT 'trips ' || year || '-' || month, NULL, CAST(count(*) AS DOUBLE) FROM chain_fct GROUP BY year, month
UNION ALL SELECT 'revenue ' || year || '-' || month, NULL, {_sum("total_amount")} FROM chain_fct GROUP BY year, month"""),
        "model_graph": _with(["fct", "zones", "dates"], """
SELECT * FROM (VALUES
  ('dim_zones', 'table', 'built', NULL, NULL), ('dim_date', 'table', 'built', NULL, NULL),
  ('fct_trips', 'table', 'failed', 'relationships(fct_trips.pickup_zone_id)', NULL), ('stg_trips', 'view', 'built', NULL, NULL),
  ('monthly_revenue', 'table', 'built', NULL, NULL), ('trips_by_borough', 'table', 'skipped', NULL, 'fct_trips'),
  ('borough_share', 'view', 'skipped', NULL, 'fct_trips')) AS m(model, kind, status, failed_check, stopped_by)
LEFT JOIN (
  SELECT 'dim_zones' AS model, count(*) AS row_count FROM zones UNION ALL SELECT 'dim_date', count(*) FROM dates
  UNION ALL SELECT 'stg_trips', count(*) FROM fct UNION ALL SELECT 'fct_trips', count(*) FROM fct
  UNION ALL SELECT 'monthly_revenue', count(DISTINCT (year, month)) FROM fct) USING (model)"""),
        "dq_duplicates": _with(["sane"], _check(
            "duplicate_count(trip_id)", "count(*)", "o = 0", "= 0",
            f"(SELECT {_TRIP_MD5} FROM sane GROUP BY 1 HAVING count(*) > 1)")),
        "dq_volume_change": _with(["silver"], """
SELECT table_name, run_at, row_count, change_pct,
  CASE WHEN change_pct IS NULL THEN 'not_evaluated' WHEN change_pct < 20 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT *, CAST(abs(row_count * count(row_count) OVER w - sum(row_count) OVER w) AS DOUBLE) * 100.0
              / NULLIF(CAST(sum(row_count) OVER w AS DOUBLE), 0) AS change_pct
      FROM (SELECT 'fct_trips' AS table_name, make_date(year, month, 1) AS run_at, count(*) AS row_count
            FROM silver GROUP BY year, month)
      WINDOW w AS (ORDER BY run_at ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""),
    }
