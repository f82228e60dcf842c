"""Rolling SQL reports (A6-A8, P12-P14, O2, O3) in DataFrame and SQL form.

``as_of`` should be a literal date in production so the ``trip_date`` filter
prunes partitions at planning time.  When it is None the reports use the
newest ``trip_date`` of the input, as a scalar subquery.

Fixed values: the reports' column names, windows and digits.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.core import exact_avg, exact_sum, half_up, rounded_sum

DATE = "trip_date"


def _as_of(df: DataFrame, as_of) -> Column:
    if as_of is None:
        return df.select(F.max(DATE)).scalar()
    if isinstance(as_of, (str, _dt.date)):
        return F.lit(as_of).cast("date")
    return as_of


def last_days(df: DataFrame, days: int, as_of=None) -> DataFrame:
    """Rows with trip_date >= as_of - days.

    With a literal ``as_of`` the same bound is put on ``departure_time``, of which
    ``trip_date`` is the day: that filter reaches scans that only hold the time."""
    first = F.date_sub(_as_of(df, as_of), days)
    out = df.filter(F.col(DATE) >= first)
    if as_of is not None and dict(df.dtypes).get("departure_time") == "timestamp_ntz":
        out = out.filter(F.col("departure_time") >= first.cast("timestamp_ntz"))
    return out


def daily_report(df: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Per day of the window: trips, tons, revenue, average delay and
    trips delayed more than an hour; newest first."""
    return (
        last_days(df, days, as_of)
        .groupBy(DATE)
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            exact_sum("cargo_weight_tons").alias("total_cargo_tons"),
            rounded_sum("freight_value_brl", 2).alias("total_revenue_brl"),
            half_up(exact_avg("freight_value_brl"), 2).alias("avg_revenue_per_trip"),
            half_up(exact_avg("delay_minutes"), 1).alias("avg_delay_min"),
            F.count_if(F.col("delay_minutes") > 60).alias("trips_delayed_over_1h"),
        )
        .orderBy(F.col(DATE).desc())
    )


def cargo_ranking(df: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """Per cargo type over the window, by revenue; revenue_per_ton is the
    average of the per-trip ratio with a NULL-safe divisor (P12)."""
    ratio = F.try_divide(F.col("freight_value_brl"), F.nullif(F.col("cargo_weight_tons"), F.lit(0)))
    return (
        last_days(df, days, as_of)
        .groupBy("cargo_type")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            rounded_sum("cargo_weight_tons", 0).alias("total_tons"),
            rounded_sum("freight_value_brl", 2).alias("total_revenue_brl"),
            half_up(exact_avg(ratio), 2).alias("revenue_per_ton"),
            half_up(exact_avg("delay_minutes"), 1).alias("avg_delay_min"),
        )
        .orderBy(F.col("total_revenue_brl").desc(), F.col("cargo_type").asc_nulls_last())
    )


def top_routes(df: DataFrame, days: int = 30, as_of=None, n: int = 20) -> DataFrame:
    """A8 + O3: top ``n`` routes by tons over the window (route names break
    ties so the cut is deterministic).  Planned as TakeOrderedAndProject:
    each task keeps its own top n, only those meet on one task."""
    return (
        last_days(df, days, as_of)
        .groupBy("origin_station", "destination_station")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            rounded_sum("cargo_weight_tons", 0).alias("total_tons"),
            half_up(exact_avg("delay_minutes"), 1).alias("avg_delay_min"),
            rounded_sum("freight_value_brl", 2).alias("total_revenue_brl"),
        )
        .orderBy(
            F.col("total_tons").desc_nulls_last(),
            F.col("origin_station").asc_nulls_last(),
            F.col("destination_station").asc_nulls_last(),
        )
        .limit(n)
    )


# The saved queries in SQL form, over registered views.  ``{as_of}`` is a
# date literal such as DATE '2001-08-01'.
SQL_REPORTS = {
    "daily_report": """
SELECT trip_date,
       COUNT(*) AS total_trips,
       CAST(SUM(CAST(cargo_weight_tons AS DECIMAL(28,6))) AS DOUBLE) AS total_cargo_tons,
       CAST(ROUND(CAST(SUM(CAST(freight_value_brl AS DECIMAL(28,6))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total_revenue_brl,
       CAST(ROUND(CAST(try_divide(CAST(SUM(CAST(freight_value_brl AS DECIMAL(28,6))) AS DOUBLE),
                                  COUNT(freight_value_brl)) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_revenue_per_trip,
       CAST(ROUND(CAST(try_divide(CAST(SUM(CAST(delay_minutes AS DECIMAL(28,6))) AS DOUBLE),
                                  COUNT(delay_minutes)) AS DECIMAL(38,6)), 1) AS DOUBLE) AS avg_delay_min,
       COUNT_IF(delay_minutes > 60) AS trips_delayed_over_1h
FROM {table}
WHERE trip_date >= date_sub({as_of}, 30)
GROUP BY trip_date
ORDER BY trip_date DESC""",
    "cargo_ranking": """
SELECT cargo_type,
       COUNT(*) AS total_trips,
       CAST(ROUND(CAST(SUM(CAST(cargo_weight_tons AS DECIMAL(28,6))) AS DECIMAL(38,6)), 0) AS DOUBLE) AS total_tons,
       CAST(ROUND(CAST(SUM(CAST(freight_value_brl AS DECIMAL(28,6))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total_revenue_brl,
       CAST(ROUND(CAST(try_divide(CAST(SUM(CAST(try_divide(freight_value_brl, NULLIF(cargo_weight_tons, 0)) AS DECIMAL(28,6))) AS DOUBLE),
                                  COUNT(try_divide(freight_value_brl, NULLIF(cargo_weight_tons, 0)))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS revenue_per_ton,
       CAST(ROUND(CAST(try_divide(CAST(SUM(CAST(delay_minutes AS DECIMAL(28,6))) AS DOUBLE),
                                  COUNT(delay_minutes)) AS DECIMAL(38,6)), 1) AS DOUBLE) AS avg_delay_min
FROM {table}
WHERE trip_date >= date_sub({as_of}, 90)
GROUP BY cargo_type
ORDER BY total_revenue_brl DESC, cargo_type ASC NULLS LAST""",
    "top_routes": """
SELECT origin_station, destination_station,
       COUNT(*) AS total_trips,
       CAST(ROUND(CAST(SUM(CAST(cargo_weight_tons AS DECIMAL(28,6))) AS DECIMAL(38,6)), 0) AS DOUBLE) AS total_tons,
       CAST(ROUND(CAST(try_divide(CAST(SUM(CAST(delay_minutes AS DECIMAL(28,6))) AS DOUBLE),
                                  COUNT(delay_minutes)) AS DECIMAL(38,6)), 1) AS DOUBLE) AS avg_delay_min,
       CAST(ROUND(CAST(SUM(CAST(freight_value_brl AS DECIMAL(28,6))) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total_revenue_brl
FROM {table}
WHERE trip_date >= date_sub({as_of}, 30)
GROUP BY origin_station, destination_station
ORDER BY total_tons DESC NULLS LAST, origin_station ASC NULLS LAST, destination_station ASC NULLS LAST
LIMIT 20""",
    "quarantine_audit": """
SELECT _failure_reason AS failure_reason,
       COUNT(*) AS rejected_rows,
       MIN(_ingestion_date) AS first_seen,
       MAX(_ingestion_date) AS last_seen
FROM {table}
GROUP BY _failure_reason
ORDER BY rejected_rows DESC, failure_reason ASC NULLS LAST""",
}


def run_sql_report(spark, name: str, table: str, as_of: str | None = None) -> DataFrame:
    """Run a saved report as SQL text over a registered view."""
    if as_of is None:
        as_of_sql = f"(SELECT MAX(trip_date) FROM {table})"
    else:
        as_of_sql = f"DATE '{as_of}'"
    return spark.sql(SQL_REPORTS[name].format(table=table, as_of=as_of_sql))
