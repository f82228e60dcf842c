"""Independent oracle: DuckDB SQL over the driver's raw tables.

Each string recomputes its query from the base tables with plain SQL
(windows where the Spark side uses aggregates, and so on), applying the same
exact-decimal sums and half-up rounding as ``tripmart.functions.core``.
"""

from __future__ import annotations

from tripmart.sources.tables import TRIPS_KNOWN_CARGO

ERROR_RULES = [
    ("positive_weight", "cargo_weight_tons > 0"),
    ("non_negative_value", "freight_value_brl >= 0 AND freight_value_brl < 1e15"),
    ("non_negative_delay", "delay_minutes >= 0"),
    ("valid_departure", "departure_time IS NOT NULL"),
    ("valid_arrival", "arrival_time IS NOT NULL"),
    ("time_sequence", "arrival_time > departure_time"),
]
_KNOWN = ", ".join(f"'{c}'" for c in TRIPS_KNOWN_CARGO)
WARN_RULES = [
    ("reasonable_weight", "cargo_weight_tons < 15000"),
    ("known_cargo_type", f"cargo_type IN ({_KNOWN})"),
]
LINEAGE = ["_ingestion_timestamp", "_pipeline_run_id", "_source_path", "_ingestion_date"]
TRIP_COLUMNS = [
    "trip_id", "origin_station", "destination_station", "cargo_type", "cargo_weight_tons",
    "departure_time", "arrival_time", "train_id", "operator", "freight_value_brl",
    "fuel_cost_brl", "delay_minutes", "l_partkey", "l_suppkey", "l_returnflag",
    "l_linestatus", "l_tax",
]


def R(expr: str, digits: int) -> str:
    """Half-up rounding through decimal, as double."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def XSUM(expr: str) -> str:
    return f"CAST(SUM(CAST(({expr}) AS DECIMAL(18,6))) AS DOUBLE)"


def XAVG(expr: str) -> str:
    return f"(CAST(SUM(CAST(({expr}) AS DECIMAL(18,6))) AS DOUBLE) / COUNT({expr}))"


TRIPS = """trips AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS trip_id,
         sn.n_name AS origin_station,
         cn.n_name AS destination_station,
         p.p_type AS cargo_type,
         CASE WHEN l.l_quantity = 50 THEN NULL ELSE (l.l_quantity - 1) * 400 END AS cargo_weight_tons,
         o.o_orderdate AS departure_time,
         l.l_shipdate AS arrival_time,
         'TRAIN-' || CAST(l.l_suppkey AS VARCHAR) AS train_id,
         c.c_mktsegment AS operator,
         l.l_extendedprice - 1000 AS freight_value_brl,
         l.l_extendedprice * l.l_discount AS fuel_cost_brl,
         CAST(l.l_partkey % 11 AS INTEGER) * 15 - 15 AS delay_minutes,
         l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus, l.l_tax
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
)"""

BRONZE = """bronze AS (
  SELECT *,
         strftime(arrival_time, '%Y-%m-%dT%H:%M:%S+00:00') AS _ingestion_timestamp,
         'run-' || strftime(arrival_time, '%Y%m%d') AS _pipeline_run_id,
         'freight/year=' || strftime(arrival_time, '%Y') || '/month=' || strftime(arrival_time, '%m')
           || '/freight_' || strftime(arrival_time, '%Y-%m') || '.csv' AS _source_path,
         CAST(date_trunc('month', arrival_time) AS DATE) AS _ingestion_date
  FROM trips
)"""


def typed(src: str = "bronze", prefilter_nulls: bool = False) -> str:
    where = "WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL" if prefilter_nulls else ""
    return f"""typed AS (
  SELECT * REPLACE (upper(trim(cargo_type)) AS cargo_type,
                    upper(trim(origin_station)) AS origin_station,
                    upper(trim(destination_station)) AS destination_station),
         CAST(departure_time AS DATE) AS trip_date,
         CAST(hour(departure_time) AS INTEGER) AS departure_hour,
         {R("date_diff('second', departure_time, arrival_time) / 3600", 2)} AS trip_duration_hours,
         CASE WHEN cargo_weight_tons > 0 THEN {R("freight_value_brl / cargo_weight_tons", 2)} END AS revenue_per_ton,
         {R("freight_value_brl - fuel_cost_brl", 2)} AS margin_brl,
         delay_minutes > 30 AS is_delayed
  FROM {src} {where}
)"""


def flagged(on_unknown: str = "quarantine") -> str:
    rules = ",\n         ".join(f"{cond} AS _dq_{name}" for name, cond in ERROR_RULES)
    passed = " AND ".join(f"coalesce(_dq_{n}, false)" for n, _ in ERROR_RULES)
    any_false = " OR ".join(f"coalesce(NOT _dq_{n}, false)" for n, _ in ERROR_RULES)
    policy = "true" if on_unknown == "quarantine" else "false"
    return f"""flagged0 AS (
  SELECT *,
         {rules}
  FROM typed
),
flagged AS (
  SELECT *, ({passed}) AS _dq_passed,
         CASE WHEN ({passed}) THEN 'clean'
              WHEN ({any_false}) OR {policy} THEN 'quarantine'
              ELSE 'dropped' END AS _dq_status
  FROM flagged0
)"""


def dedup(src: str = "flagged") -> str:
    rest = [c for c in TRIP_COLUMNS if c not in ("trip_id", "departure_time")]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    return f"""deduped AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY trip_id, departure_time
        ORDER BY _dq_passed DESC, _ingestion_timestamp DESC NULLS LAST, {order}) AS _rn
    FROM {src}) WHERE _rn = 1
)"""


def reason(compat: bool = False, on_unknown: str = "quarantine") -> str:
    if compat:
        slots = ", ".join(f"CASE WHEN NOT _dq_{n} THEN '{n}' ELSE '' END" for n, _ in ERROR_RULES)
    elif on_unknown == "quarantine":
        slots = ", ".join(f"CASE WHEN NOT coalesce(_dq_{n}, false) THEN '{n}' END" for n, _ in ERROR_RULES)
    else:
        slots = ", ".join(f"CASE WHEN NOT _dq_{n} THEN '{n}' END" for n, _ in ERROR_RULES)
    return f"concat_ws(', ', {slots})"


def warn_cols() -> str:
    return ", ".join(f"NOT ({cond}) AS _warn_{n}" for n, cond in WARN_RULES)


DQ_COLS = [f"_dq_{n}" for n, _ in ERROR_RULES] + ["_dq_passed", "_dq_status"]


def clean(src: str = "deduped") -> str:
    return f"""clean AS (
  SELECT * EXCLUDE ({", ".join(DQ_COLS)}), {warn_cols()}
  FROM {src} WHERE _dq_status = 'clean'
)"""


def silver_ctes(
    on_unknown: str = "quarantine", prefilter_nulls: bool = False, compat: bool = False, change: str = "SELECT * FROM bronze"
) -> str:
    """WITH-list ending in ``silver`` (clean rows, lineage dropped) and
    ``quarantine``; ``change`` is what becomes of bronze before."""
    return ",\n".join(
        [
            TRIPS,
            BRONZE,
            f"changed AS ({change})",
            typed("changed", prefilter_nulls),
            flagged(on_unknown),
            dedup(),
            clean(),
            f"silver AS (SELECT * EXCLUDE ({', '.join(LINEAGE)}) FROM clean)",
            f"""quarantine AS (
  SELECT * EXCLUDE (_dq_passed, _dq_status), {reason(compat, on_unknown)} AS _failure_reason
  FROM deduped WHERE _dq_status = 'quarantine'
)""",
        ]
    )


def with_silver(body: str, **options) -> str:
    return f"WITH {silver_ctes(**options)}\n{body}"


# ── per-query oracle SQL ─────────────────────────────────────────────────────

def _rate_by_day(src: str = "deduped") -> str:
    return f"""SELECT trip_date, COUNT(*) AS total_rows,
       COUNT_IF(_dq_status = 'quarantine') AS quarantined_rows,
       COUNT_IF(_dq_status = 'dropped') AS dropped_rows,
       {R("COUNT_IF(_dq_status = 'quarantine') / NULLIF(COUNT(*), 0) * 100", 2)} AS quarantine_rate_pct
FROM {src} GROUP BY trip_date"""


def _on_time(delayed: str, total: str) -> str:
    return R(f"(1 - {delayed} / NULLIF({total}, 0)) * 100", 2)


A1_BODY = f"""SELECT *, {_on_time("delayed_trips", "total_trips")} AS on_time_rate_pct,
       {R("total_margin_brl / NULLIF(total_revenue_brl, 0) * 100", 2)} AS margin_rate_pct
FROM (
  SELECT trip_date,
         COUNT(*) AS total_trips,
         {XSUM("cargo_weight_tons")} AS total_cargo_tons,
         {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
         {R(XAVG("freight_value_brl"), 2)} AS avg_revenue_per_trip,
         {R(XSUM("margin_brl"), 2)} AS total_margin_brl,
         {R(XAVG("trip_duration_hours"), 2)} AS avg_duration_hours,
         {R(XAVG("delay_minutes"), 1)} AS avg_delay_min,
         COUNT_IF(is_delayed) AS delayed_trips,
         COUNT(DISTINCT origin_station) AS unique_origins,
         COUNT(DISTINCT train_id) AS unique_trains
  FROM silver GROUP BY trip_date)
ORDER BY trip_date"""

A2_BODY = f"""SELECT *, CAST(rank() OVER (PARTITION BY trip_date ORDER BY total_revenue_brl DESC NULLS LAST) AS INTEGER)
         AS revenue_rank_daily
FROM (
  SELECT origin_station, destination_station, trip_date,
         COUNT(*) AS total_trips,
         {R(XSUM("cargo_weight_tons"), 0)} AS total_tons,
         {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
         {R(XAVG("revenue_per_ton"), 2)} AS avg_revenue_per_ton,
         {R(XAVG("delay_minutes"), 1)} AS avg_delay_min,
         {R(XAVG("trip_duration_hours"), 2)} AS avg_duration_hours
  FROM silver GROUP BY origin_station, destination_station, trip_date)"""

A3_BODY = f"""SELECT *, {R("total_revenue_brl / NULLIF(CAST(SUM(CAST(total_revenue_brl AS DECIMAL(18,6))) OVER (PARTITION BY trip_date) AS DOUBLE), 0) * 100", 2)}
         AS revenue_share_pct
FROM (
  SELECT cargo_type, trip_date,
         COUNT(*) AS total_trips,
         {R(XSUM("cargo_weight_tons"), 0)} AS total_tons,
         {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
         {R(XAVG("freight_value_brl"), 2)} AS avg_revenue_per_trip,
         {R(XAVG("revenue_per_ton"), 2)} AS avg_revenue_per_ton,
         {R(XAVG("delay_minutes"), 1)} AS avg_delay_min
  FROM silver GROUP BY cargo_type, trip_date)"""

A4_BODY = f"""SELECT *, {_on_time("delayed_trips", "total_trips")} AS on_time_rate_pct
FROM (
  SELECT operator, trip_date,
         COUNT(*) AS total_trips,
         {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
         {R(XAVG("delay_minutes"), 1)} AS avg_delay_min,
         COUNT_IF(is_delayed) AS delayed_trips,
         {R(XAVG("trip_duration_hours"), 2)} AS avg_duration_hours
  FROM silver GROUP BY operator, trip_date)"""

AS_OF = "(SELECT MAX(trip_date) FROM silver)"

A6_BODY = f"""SELECT trip_date,
       COUNT(*) AS total_trips,
       {XSUM("cargo_weight_tons")} AS total_cargo_tons,
       {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
       {R(XAVG("freight_value_brl"), 2)} AS avg_revenue_per_trip,
       {R(XAVG("delay_minutes"), 1)} AS avg_delay_min,
       COUNT_IF(delay_minutes > 60) AS trips_delayed_over_1h
FROM silver WHERE trip_date >= {AS_OF} - 30
GROUP BY trip_date ORDER BY trip_date DESC"""

_RATIO = "freight_value_brl / NULLIF(cargo_weight_tons, 0)"
A7_BODY = f"""SELECT cargo_type,
       COUNT(*) AS total_trips,
       {R(XSUM("cargo_weight_tons"), 0)} AS total_tons,
       {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl,
       {R(XAVG(_RATIO), 2)} AS revenue_per_ton,
       {R(XAVG("delay_minutes"), 1)} AS avg_delay_min
FROM silver WHERE trip_date >= {AS_OF} - 90
GROUP BY cargo_type ORDER BY total_revenue_brl DESC, cargo_type"""

A8_SELECT = f"""SELECT origin_station, destination_station,
       COUNT(*) AS total_trips,
       {R(XSUM("cargo_weight_tons"), 0)} AS total_tons,
       {R(XAVG("delay_minutes"), 1)} AS avg_delay_min,
       {R(XSUM("freight_value_brl"), 2)} AS total_revenue_brl
FROM silver WHERE trip_date >= {AS_OF} - 30
GROUP BY origin_station, destination_station
ORDER BY total_tons DESC NULLS LAST, origin_station ASC NULLS LAST, destination_station ASC NULLS LAST
LIMIT 20"""

_PCT = "percent_rank() OVER (PARTITION BY cargo_type ORDER BY freight_value_brl ASC NULLS FIRST)"
_ROUTE_W = "(PARTITION BY origin_station, destination_station)"
_ROUTE_COLS = (
    R(f"CAST(SUM(CAST(freight_value_brl AS DECIMAL(18,6))) OVER {_ROUTE_W} AS DOUBLE)"
      f" / COUNT(freight_value_brl) OVER {_ROUTE_W}", 2)
    + " AS route_avg_revenue_historical, "
    + f"COUNT(*) OVER {_ROUTE_W} AS route_trip_count_historical"
)
_RAW_SCORE = R("cargo_weight_tons / 10000 * 0.3 + trip_duration_hours / 48 * 0.4 + 0.1", 4)


def _dedup_plain() -> str:
    rest = [c for c in TRIP_COLUMNS if c not in ("trip_id", "departure_time")]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    return f"""WITH {TRIPS},
{BRONZE},
{typed("bronze")}
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id, departure_time
                               ORDER BY _ingestion_timestamp DESC NULLS LAST, {order}) AS _rn
  FROM typed) WHERE _rn = 1"""


def _contract_select(contract, wide: bool = False) -> str:
    cols = []
    for c, t, _ in contract:
        dt = "VARCHAR" if t.startswith("varchar") else t.upper().replace("INT", "INTEGER") if t == "int" else t.upper()
        value = f"TRY_CAST({c} AS {dt})"
        cols.append(f"CAST({value} AS DOUBLE) AS {c}" if wide and t.startswith("decimal") else f"{value} AS {c}")
    return ", ".join(cols)


def _violations(contract, table: str, src: str) -> str:
    import re

    parts = []
    for c, t, nullable in contract:
        m = re.fullmatch(r"varchar\((\d+)\)", t)
        dt = "VARCHAR" if m else ("INTEGER" if t == "int" else t.upper())
        nn = "0" if nullable else f"COUNT_IF({c} IS NULL)"
        ln = f"COUNT_IF(length({c}) > {m.group(1)})" if m else "0"
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({nn} AS BIGINT) AS not_null_violations, "
            f"COUNT_IF({c} IS NOT NULL AND TRY_CAST({c} AS {dt}) IS NULL) AS cast_lost_values, "
            f"CAST({ln} AS BIGINT) AS too_long_values FROM ({src})"
        )
    return "\nUNION ALL\n".join(parts)


EXPECTED = [
    "trip_id", "origin_station", "destination_station", "cargo_type", "cargo_weight_tons",
    "departure_time", "arrival_time", "train_id", "operator", "freight_value_brl",
    "fuel_cost_brl", "delay_minutes",
]

A5_BODY = f"""SELECT origin_station, destination_station,
       COUNT(*) AS trip_count,
       {XAVG("cargo_weight_tons")} AS avg_weight,
       {XAVG("freight_value_brl")} AS avg_revenue,
       {XAVG("delay_minutes")} AS avg_delay,
       {XAVG("trip_duration_hours")} AS avg_duration,
       COUNT(DISTINCT cargo_type) AS cargo_diversity
FROM silver GROUP BY origin_station, destination_station HAVING COUNT(*) >= 10"""

_TRIPS_YM = f"""{TRIPS},
ty AS (SELECT *, CAST(year(departure_time) AS INTEGER) AS year,
              CAST(month(departure_time) AS INTEGER) AS month FROM trips)"""


def oracle_queries() -> dict[str, str]:
    from tripmart.schema import SERVING_CONTRACTS

    out = _oracle_base()
    a1 = A1_BODY.replace("ORDER BY trip_date", "")
    heuristic = out["f3_heuristic"]
    four = "\nUNION ALL BY NAME\n".join(
        f"SELECT *, '{name}' AS mart FROM ({body})"
        for name, body in (("gold_daily_kpis", a1), ("gold_route_performance", A2_BODY), ("gold_cargo_mix", A3_BODY), ("gold_operator_ranking", A4_BODY))
    )
    out.update(
        {
            "a5_route_features": with_silver(A5_BODY),
            "k3_overwrite_roundtrip": with_silver(A5_BODY),
            "s1_csv_roundtrip": f"WITH {_TRIPS_YM},\n{typed('ty')}\nSELECT * FROM typed",
            "s2_landing_partitions": f"""WITH {_TRIPS_YM}
SELECT year, month, COUNT(*) AS rows FROM ty WHERE year >= 1996 GROUP BY year, month""",
            "m1_expected_columns": f"WITH {TRIPS}\n"
            + "\nUNION ALL\n".join(
                f"SELECT '{c}' AS column_name, true AS present, COUNT({c}) AS non_null_rows, COUNT(*) AS total_rows FROM trips"
                for c in EXPECTED
            ),
            "m2_lineage": f"""WITH {_TRIPS_YM}
SELECT trip_id, CAST(departure_time AS VARCHAR) AS departure_time, l_partkey, l_suppkey,
       'run-oracle' AS _pipeline_run_id,
       'year=' || CAST(year AS VARCHAR) || '/month=' || CAST(month AS VARCHAR) AS source_partition
FROM ty""",
            "k1_append_roundtrip": f"WITH {TRIPS},\n{BRONZE}\nSELECT * FROM bronze",
            "k2_overwrite_roundtrip": with_silver("SELECT * FROM silver"),
            "k4_conditional_write": with_silver(
                "SELECT _failure_reason, COUNT(*) AS rows FROM quarantine GROUP BY _failure_reason"
            ),
            "k5_serving_roundtrip": with_silver(
                "\nUNION ALL BY NAME\n".join(
                    f"SELECT {_contract_select(SERVING_CONTRACTS[t], wide=True)}, '{t}' AS mart FROM ({body})"
                    for t, body in (("daily_kpis", a1), ("route_performance", A2_BODY), ("cargo_mix", A3_BODY), ("operator_ranking", A4_BODY))
                )
            ),
            "j7_roll_back": "",
            "k6_incremental_load": with_silver(
                f"SELECT {_contract_select(SERVING_CONTRACTS['route_performance'])} FROM ({A2_BODY})"
            ),
            "m4_contract_violations": with_silver(
                "\nUNION ALL\n".join(
                    [
                        _violations(SERVING_CONTRACTS["daily_kpis"], "daily_kpis", a1),
                        _violations(SERVING_CONTRACTS["route_performance"], "route_performance", A2_BODY),
                        _violations(SERVING_CONTRACTS["cargo_mix"], "cargo_mix", A3_BODY),
                        _violations(SERVING_CONTRACTS["operator_ranking"], "operator_ranking", A4_BODY),
                    ]
                )
            ),
            "m6_registered_layer": with_silver(
                """SELECT cargo_type, operator, COUNT(*) AS total_trips, COUNT(DISTINCT trip_date) AS days
FROM silver GROUP BY cargo_type, operator"""
            ),
            "j2_refine_job": with_silver("SELECT * FROM silver"),
            "t1_stream_ingest": f"""WITH {_TRIPS_YM}
SELECT trip_id, CAST(departure_time AS VARCHAR) AS departure_time, l_partkey, l_suppkey,
       'stream' AS _pipeline_run_id,
       'year=' || CAST(year AS VARCHAR) || '/month=' || CAST(month AS VARCHAR) AS source_partition
FROM ty""",
            "t2_stream_silver": with_silver("SELECT * FROM silver"),
            "s5_events": f"""WITH {TRIPS},
files AS (SELECT CAST(year(departure_time) AS INTEGER) AS y, CAST(month(departure_time) AS INTEGER) AS m,
                 COUNT(*) AS n, SUM(l_partkey) AS s FROM trips GROUP BY 1, 2),
acc AS (
  SELECT 'raw-freight' AS bucket,
         'freight/year=' || CAST(y AS VARCHAR) || '/month=' || lpad(CAST(m AS VARCHAR), 2, '0')
           || '/freight ' || CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '.csv' AS key,
         CASE WHEN m % 3 = 0 THEN substring('req-' || CAST(y AS VARCHAR) || '-0000000000000000', 1, 20)
              ELSE md5(CAST(n AS VARCHAR) || ':' || CAST(s AS VARCHAR)) END AS etag,
         CAST(CASE WHEN m % 3 = 0 THEN 0 ELSE n * 100 END AS BIGINT) AS size_bytes, m % 3 <> 0 AS own
  FROM files WHERE m % 4 IN (2, 3))
SELECT * EXCLUDE (own), 'dev-' || substring(replace(etag, '-', ''), 1, 20) || CASE WHEN own THEN '' ELSE '-' || substring(md5(key), 1, 8) END AS execution_name FROM acc""",
            "s6_ledger": f"""WITH {_TRIPS_YM}
SELECT 'year=' || CAST(year AS VARCHAR) || '/month=' || CAST(month AS VARCHAR) AS source_partition,
       COUNT(*) AS rows
FROM ty WHERE year > 1997 GROUP BY 1""",
            "t3_stream_dedup": _stream_dedup(),
            "t3_stream_dedup_timers": _stream_dedup(),
            "t4_late_days": with_silver(four),
            "t2_stream_quarantine": with_silver(
                "SELECT _failure_reason, _ingestion_date, COUNT(*) AS rows FROM quarantine GROUP BY 1, 2"
            ),
            "j2_quarantine_job": with_silver(
                "SELECT _failure_reason, _ingestion_date, COUNT(*) AS rows FROM quarantine GROUP BY 1, 2"
            ),
            "j3_gold_job": with_silver(four),
            "j2_rerun_shrunk_bronze": with_silver(
                """SELECT trip_date, COUNT(*) AS rows, 'silver' AS side FROM silver GROUP BY 1
UNION ALL SELECT trip_date, COUNT(*), 'quarantine' FROM quarantine GROUP BY 1""",
                change="""SELECT * REPLACE (CASE WHEN l_partkey % 7 = 0 THEN -1 ELSE delay_minutes END AS delay_minutes)
  FROM bronze WHERE month(departure_time) <> 3""",
            ),
            "j2_clean_only": with_silver(
                """SELECT COUNT(*) AS rows_read, COUNT(*) - COUNT(DISTINCT (trip_id, departure_time)) AS duplicates_removed,
       COUNT(DISTINCT (trip_id, departure_time)) AS rows_clean, CAST(0 AS BIGINT) AS rows_quarantined FROM flagged WHERE _dq_passed"""
            ),
            "p5_prefilter_nulls": with_silver(
                _rate_by_day(), prefilter_nulls=True,
                change="SELECT * REPLACE (CASE WHEN l_partkey % 5 <> 0 THEN departure_time END AS departure_time) FROM bronze",
            ),
            "q_amount_limit": with_silver(
                a1,
                change="""SELECT * REPLACE (CASE WHEN l_partkey % 11 = 0 THEN 1e15 + freight_value_brl ELSE freight_value_brl END AS freight_value_brl)
  FROM bronze""",
            ),
            "k8_write_counts": with_silver(
                f"""SELECT 'routes' AS name, COUNT(*) AS written, COUNT(*) AS read FROM ({A5_BODY})
UNION ALL SELECT 'none', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""
            ),
            "m5_sorted_files": with_silver(f"SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM ({A2_BODY})"),
            "j7_gate": with_silver(
                f"""SELECT true AS refused, COUNT_IF(day(trip_date) > 3) AS loaded, COUNT_IF(day(trip_date) <= 3) AS rejected FROM ({A4_BODY})"""
            ),
            "f2_model_score": with_silver(_model_score()),
            "f2_spark_model_score": with_silver(
                f"""SELECT trip_id, departure_time, l_partkey, l_suppkey, {" AND ".join(f"{x} IS NOT NULL" for x in _MODEL_FEATURES)} AS scored, true AS agrees
FROM silver"""
            ),
            "f7_clusters": with_silver(f"SELECT *, true AS in_nearest FROM ({A5_BODY})"),
            "j6_cluster_job": with_silver(f"SELECT *, true AS in_nearest FROM ({A5_BODY})"),
            "f8_cluster_sizes": with_silver(
                f"""SELECT CAST(6 AS BIGINT) AS clusters, COUNT(*) AS routes, true AS sizes_hold, true AS centres_are_means, true AS numbered_by_centre,
       true AS silhouette_in_range FROM ({A5_BODY})"""
            ),
            "m5_bucketed_join": with_silver(
                f"""SELECT trip_date, origin_station, destination_station,
       {R("r.total_revenue_brl / nullif(d.total_revenue_brl, 0) * 100", 2)} AS share_of_day_pct,
       CAST(rank() OVER (PARTITION BY trip_date ORDER BY r.total_revenue_brl DESC NULLS LAST) AS INTEGER) AS rank_in_day
FROM ({A2_BODY}) r JOIN ({a1}) d USING (trip_date)"""
            ),
            "a6_from_partials": out["a6_daily_30d"],
            "a7_from_partials": out["a7_cargo_90d"],
            "a8_from_partials": out["a8_top20_routes"],
            "a1_a4_from_partials": with_silver(
                f"""SELECT * FROM (WITH corrected AS (
  SELECT * REPLACE (CASE WHEN cargo_weight_tons > 0 THEN {R("freight_value_brl / cargo_weight_tons", 2)} END AS revenue_per_ton,
                    {R("freight_value_brl - fuel_cost_brl", 2)} AS margin_brl)
  FROM (SELECT * REPLACE (CASE WHEN month(trip_date) = 3 AND l_partkey % 7 = 0 THEN freight_value_brl * 2 ELSE freight_value_brl END AS freight_value_brl) FROM silver))
{four.replace("FROM silver", "FROM corrected")})"""
            ),
            "j1_changed_landing": f"""WITH {_TRIPS_YM},
years AS (SELECT year, COUNT(*) AS n, row_number() OVER (ORDER BY CAST(year AS VARCHAR)) <= 3 AS first FROM ty GROUP BY year)
SELECT CAST(0 AS INTEGER) AS run, true AS read, CAST(SUM(n) FILTER (first) AS BIGINT) AS rows FROM years
UNION ALL SELECT 1, true, CAST(SUM(n) FILTER (NOT first) AS BIGINT) FROM years UNION ALL SELECT 2, false, 0 UNION ALL SELECT 3, true, 0""",
            "j9_command_line": with_silver(
                f"""SELECT 'silver' AS output, COUNT(*) AS rows FROM silver UNION ALL SELECT 'quarantine', COUNT(*) FROM quarantine
UNION ALL SELECT 'scores', COUNT(*) FROM silver UNION ALL SELECT 'report', COUNT(*) FROM ({A7_BODY})
UNION ALL SELECT mart, COUNT(*) FROM ({four}) GROUP BY mart"""
            ),
            "c_session": with_silver(
                f"""SELECT mart, COUNT(*) AS rows, true AS settings, 'snappy' AS codec, false AS still_cached FROM ({four}) GROUP BY mart"""
            ),
            "s1_drift": f"""WITH {TRIPS}
SELECT trip_id, cargo_type, CASE WHEN l_partkey % 2 = 1 THEN operator END AS operator, CAST(l_partkey AS VARCHAR) AS l_partkey FROM trips""",
            "s1_quoted_lines": f"""WITH {TRIPS}
SELECT trip_id, CASE WHEN l_partkey % 3 = 0 THEN cargo_type || chr(10) || '"' || operator || '",' || chr(10) || chr(10) ELSE cargo_type || ',' || operator END AS note,
       CAST(l_partkey AS VARCHAR) AS l_partkey FROM trips""",
            "s1_inferred_types": f"""WITH {TRIPS}
SELECT * REPLACE (CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey) FROM trips""",
            "s1_corrupt": f"WITH {TRIPS}\nSELECT COUNT(*) AS rows, COUNT_IF(l_partkey % 9 = 0) AS corrupt FROM trips",
            "j1_ingest_twice": f"WITH {TRIPS}\nSELECT 'run-13' AS _pipeline_run_id, COUNT(*) AS rows, CAST(0 AS BIGINT) AS corrupt FROM trips",
            "s5_rejected": f"""WITH {TRIPS},
files AS (SELECT DISTINCT year(departure_time) AS y, month(departure_time) AS m FROM trips),
named AS (SELECT *, 'req-' || y || '-0000000000000000' AS request_id,
  CASE WHEN m % 4 = 0 THEN 'other-prefix/' ELSE 'freight/' END AS a, CASE WHEN m % 4 = 1 THEN '.parquet' ELSE '.csv' END AS z, lpad(CAST(m AS VARCHAR), 2, '0') AS mm FROM files)
SELECT DISTINCT request_id, '' AS key, 'unreadable event' AS rejected FROM named WHERE y = 1996
UNION ALL
SELECT request_id, CASE WHEN y = 1997 THEN a || 'year%3D' || y || '/month%3D' || mm || '/100%zz' || y || '-' || mm || z
  ELSE a || 'year=' || y || '/month=' || mm || '/freight ' || y || '-' || mm || z END,
  CASE WHEN m % 4 = 0 THEN 'other prefix' ELSE 'other suffix' END
FROM named WHERE y <> 1996 AND m % 4 IN (0, 1)""",
            "s5_started": f"""WITH {TRIPS},
files AS (SELECT DISTINCT year(departure_time) AS y, month(departure_time) AS m FROM trips)
SELECT 'req-' || y || '-0000000000000000' AS request_id, COUNT_IF(m % 4 IN (2, 3)) AS executions_started FROM files GROUP BY y""",
            "s8_synth": _synth(),
            "m7_statistics": "",
            "j4_backfill_job": out["h1_history"],
            "j5_score_job": heuristic,
            "a9_load_counts": with_silver(
                f"""SELECT 'daily_kpis' AS table_name, COUNT(*) AS row_count FROM ({a1})
UNION ALL SELECT 'route_performance', COUNT(*) FROM ({A2_BODY})
UNION ALL SELECT 'cargo_mix', COUNT(*) FROM ({A3_BODY})
UNION ALL SELECT 'operator_ranking', COUNT(*) FROM ({A4_BODY})"""
            ),
        }
    )
    out["m7_statistics"] = out["a9_load_counts"]
    out["j7_roll_back"] = out["k5_serving_roundtrip"]
    return out


_MODEL_FEATURES = [
    "cargo_weight_tons", "freight_value_brl", "fuel_cost_brl", "trip_duration_hours",
    "sin(CAST(3.14159 AS DOUBLE) * 2 * departure_hour / 24)", "cos(CAST(3.14159 AS DOUBLE) * 2 * departure_hour / 24)",
    "ln(1 + cargo_weight_tons)", "ln(1 + freight_value_brl)",
]


def _stream_dedup() -> str:
    """The best copy among those that are not late.  The watermark of a micro-batch is
    the newest departure of the batches before it less 60 days; a batch drops what the
    watermark of the batch before it has passed, and in the end the keys that the last
    watermark has passed are out."""
    return f"""WITH {TRIPS},
{BRONZE},
{typed()},
{flagged()},
cut AS (SELECT *, least(3, CASE WHEN departure_time < '1994-07-01' THEN 0 WHEN departure_time < '1997-01-01' THEN 1 ELSE 2 END + l_partkey % 3) AS file FROM flagged),
newest AS (SELECT file, max(max(departure_time)) OVER (ORDER BY file) - INTERVAL 60 DAY AS passed FROM cut GROUP BY file),
heard AS (SELECT c.* EXCLUDE (file) FROM cut c LEFT JOIN newest n ON n.file = c.file - 2 WHERE n.passed IS NULL OR c.departure_time > n.passed),
{dedup("heard")}
SELECT * EXCLUDE ({", ".join(DQ_COLS + DERIVED)}) FROM deduped WHERE departure_time <= (SELECT max(passed) FROM newest)"""


DERIVED = ["trip_date", "departure_hour", "trip_duration_hours", "revenue_per_ton", "margin_brl", "is_delayed"]


def _model_score() -> str:
    from tripmart.plans.queries import FIXED_MODEL

    z = " + ".join(f"({w!r}) * {x}" for w, x in zip(FIXED_MODEL, _MODEL_FEATURES))
    return f"""SELECT trip_id, trip_date, origin_station, destination_station, cargo_type,
       round(1 / (1 + exp(-({z} + 0.2))), 9) AS delay_probability, 'LogisticModel' AS model_used FROM silver"""


def _synth() -> str:
    from tripmart.sources import synth as s

    n = len(s.STATIONS)
    stations = "[" + ", ".join(f"'{x}'" for x in s.STATIONS) + "]"
    us = ", ".join(
        f"CAST('0x' || substring(md5('42|{i}|' || l_orderkey || '|' || l_linenumber), 1, 13) AS BIGINT) / {float(2**52)!r} AS u{i}" for i in range(1, 18)
    )

    def pick(u: str, options) -> str:
        out, total = "CASE", 0.0
        for value, p in options:
            total += p
            out += f" WHEN {u} < {total!r} THEN {value!r}"
        return f"{out} ELSE {options[-1][0]!r} END"

    column = lambda k: pick("u3", [(c[k], c[1]) for c in s.CARGO])
    return f"""WITH u AS (SELECT md5('42|' || l_orderkey || '|' || l_linenumber) AS h, {us} FROM lineitem),
v AS (SELECT *, CAST(floor(u1 * {n}) AS INTEGER) AS o, {column(0)} AS cargo, CAST({column(2)} AS DOUBLE) AS lo, CAST({column(3)} AS DOUBLE) AS hi,
  CAST({column(4)} AS DOUBLE) AS rate, 300 + u5 * 2200 AS dist, 50 + u6 * 30 AS speed,
  TIMESTAMP '2024-01-01' + to_seconds(CAST(floor(u7 * 180) * 86400 + floor(u8 * 23 * 3600) AS BIGINT)) AS dep,
  u15 < {s.DIRTY_SHARE} AS dirty FROM u),
w AS (SELECT *, {R("lo + u4 * (hi - lo)", 2)} AS weight FROM v)
SELECT concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12)) AS trip_id,
  {stations}[o + 1] AS origin_station,
  {stations}[(o + 1 + CAST(floor(u2 * {n - 1}) AS INTEGER)) % {n} + 1] AS destination_station,
  cargo AS cargo_type,
  CASE WHEN dirty AND u16 < 1 / 3 THEN -1.0 ELSE weight END AS cargo_weight_tons,
  CASE WHEN dirty AND u16 >= 2 / 3 THEN NULL ELSE strftime(dep, '%Y-%m-%d %H:%M:%S') END AS departure_time,
  strftime(dep + to_seconds(CAST(floor(dist / speed * 3600) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS arrival_time,
  'BR-' || CAST(1000 + floor(u13 * 8999) AS INTEGER) AS train_id,
  {pick("u14", s.OPERATORS)} AS operator,
  CASE WHEN dirty AND u16 >= 1 / 3 AND u16 < 2 / 3 THEN -100.0 ELSE {R("weight * rate * dist / 1000 * (0.8 + 0.4 * u11)", 2)} END AS freight_value_brl,
  {R("dist * (8 + 6 * u12)", 2)} AS fuel_cost_brl,
  CAST(CASE WHEN u9 < {s.DELAYED_SHARE} THEN floor(-{s.MEAN_DELAY_MIN} * ln(1 - u10)) ELSE 0 END AS INTEGER) AS delay_minutes
FROM w"""


def _oracle_base() -> dict[str, str]:
    feats = ", ".join(
        [
            "round(sin(CAST(3.14159 AS DOUBLE) * 2 * departure_hour / 24), 9) AS hour_sin",
            "round(cos(CAST(3.14159 AS DOUBLE) * 2 * departure_hour / 24), 9) AS hour_cos",
            "round(ln(1 + cargo_weight_tons), 9) AS log_weight",
            "round(ln(1 + freight_value_brl), 9) AS log_revenue",
        ]
    )
    return {
        "p_refine": f"WITH {TRIPS},\n{typed('trips')}\nSELECT * FROM typed",
        "q_split_clean": with_silver("SELECT * FROM clean"),
        "q_split_quarantine": with_silver("SELECT * FROM quarantine"),
        "q_reason_compat": with_silver("SELECT * FROM quarantine", on_unknown="drop", compat=True),
        "q_unknown_drop": with_silver(_rate_by_day(), on_unknown="drop"),
        "q_warn": with_silver(
            "SELECT _warn_reasonable_weight, _warn_known_cargo_type, COUNT(*) AS rows FROM clean GROUP BY 1, 2"
        ),
        "q_audit": with_silver(
            """SELECT _failure_reason AS failure_reason, COUNT(*) AS rejected_rows,
       MIN(_ingestion_date) AS first_seen, MAX(_ingestion_date) AS last_seen
FROM quarantine GROUP BY _failure_reason ORDER BY rejected_rows DESC, failure_reason"""
        ),
        "q_rate_by_day": with_silver(_rate_by_day()),
        "q10_run_counts": with_silver(
            """SELECT (SELECT COUNT(*) FROM bronze) AS rows_read,
       COUNT(*) AS rows_deduped,
       (SELECT COUNT(*) FROM bronze) - COUNT(*) AS duplicates_removed,
       COUNT_IF(_dq_status = 'clean') AS rows_clean,
       COUNT_IF(_dq_status = 'quarantine') AS rows_quarantined,
       COUNT_IF(_dq_status = 'dropped') AS rows_dropped
FROM deduped"""
        ),
        "d_dedup": _dedup_plain(),
        "j2_silver": with_silver("SELECT * FROM silver"),
        "a1_daily_kpis": with_silver(A1_BODY),
        "a2_route_performance": with_silver(A2_BODY),
        "a3_cargo_mix": with_silver(A3_BODY),
        "a4_operator_ranking": with_silver(A4_BODY),
        "a6_daily_30d": with_silver(A6_BODY),
        "a7_cargo_90d": with_silver(A7_BODY),
        "a8_top20_routes": with_silver(A8_SELECT),
        "j8_sql_reports": with_silver(
            f"""SELECT 'top_routes' AS report, origin_station || '->' || destination_station AS item,
       total_trips AS rows, total_revenue_brl FROM ({A8_SELECT})
UNION ALL
SELECT 'cargo_ranking', cargo_type, total_trips, total_revenue_brl FROM ({A7_BODY})
UNION ALL
SELECT 'daily_report', CAST(trip_date AS VARCHAR), total_trips, total_revenue_brl FROM ({A6_BODY})
UNION ALL
SELECT 'quarantine_audit', _failure_reason, COUNT(*), NULL FROM quarantine GROUP BY _failure_reason"""
        ),
        "w3_percent_rank": with_silver(f"SELECT *, {_PCT} AS revenue_percentile FROM silver"),
        "w3_percent_rank_scalable": with_silver(f"SELECT *, {_PCT} AS revenue_percentile FROM silver"),
        "w4_w5_route_history": with_silver(f"SELECT *, {_ROUTE_COLS} FROM silver"),
        "w4_w5_route_history_scalable": with_silver(f"SELECT *, {_ROUTE_COLS} FROM silver"),
        "h1_history": with_silver(f"SELECT *, {_PCT} AS revenue_percentile, {_ROUTE_COLS} FROM silver"),
        "f1_scalar_features": with_silver(
            f"SELECT trip_id, departure_time, l_partkey, l_suppkey, {feats} FROM silver"
        ),
        "f3_heuristic": with_silver(
            f"""SELECT trip_id, trip_date, origin_station, destination_station, cargo_type,
       CAST(CASE WHEN {_RAW_SCORE} IS NULL THEN NULL ELSE least(1.0, {_RAW_SCORE}) END AS DOUBLE) AS delay_probability,
       'heuristic' AS model_used
FROM silver"""
        ),
        "f3_heuristic_compat": f"""WITH {TRIPS},
{typed('trips')}
SELECT trip_id, departure_time, l_partkey, l_suppkey,
       CAST(least(1.0, {_RAW_SCORE}) AS DOUBLE) AS delay_probability
FROM typed""",
    }
