"""Silver typing and derived columns.

All columns are replaced or added with one ``withColumns`` each, so the whole
refine step collapses into a single projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.core import (
    guarded_ratio,
    half_up,
    normalise_text,
    to_double,
    to_int,
    to_timestamp,
)

TIMESTAMP_COLUMNS = ("departure_time", "arrival_time")
DOUBLE_COLUMNS = ("cargo_weight_tons", "freight_value_brl", "fuel_cost_brl")
INT_COLUMNS = ("delay_minutes",)
TEXT_COLUMNS = ("cargo_type", "origin_station", "destination_station")


def cast_types(
    df: DataFrame,
    timestamps=TIMESTAMP_COLUMNS,
    doubles=DOUBLE_COLUMNS,
    ints=INT_COLUMNS,
    texts=TEXT_COLUMNS,
) -> DataFrame:
    """Typed silver columns; anything unparsable becomes NULL and is
    then caught by the quality rules instead of failing the job.

    Trip times become ``timestamp_ntz``, so dates and hours do not move with the
    session zone; text with an offset becomes its UTC wall clock."""
    present, kinds = set(df.columns), dict(df.dtypes)
    exprs = {}
    exprs.update({c: to_timestamp(c) if kinds[c] == "string" else F.col(c).try_cast("timestamp_ntz") for c in timestamps if c in present})
    exprs.update({c: to_double(c) for c in doubles if c in present})
    exprs.update({c: to_int(c) for c in ints if c in present})
    exprs.update({c: normalise_text(c) for c in texts if c in present})
    return df.withColumns(exprs)


def require_times(df: DataFrame, columns=TIMESTAMP_COLUMNS) -> DataFrame:
    """P5: keep rows whose departure and arrival are both set."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def derive_columns(
    df: DataFrame,
    departure: str = "departure_time",
    arrival: str = "arrival_time",
    weight: str = "cargo_weight_tons",
    value: str = "freight_value_brl",
    fuel: str = "fuel_cost_brl",
    delay: str = "delay_minutes",
    delay_threshold: int = 30,
) -> DataFrame:
    """trip_date, departure_hour, trip_duration_hours (may be <= 0),
    revenue_per_ton (NULL unless weight > 0), margin_brl, is_delayed."""
    seconds = wall_clock_seconds(departure, arrival)
    return df.withColumns(
        {
            "trip_date": F.to_date(departure),
            "departure_hour": F.hour(departure),
            "trip_duration_hours": half_up(seconds / 3600, 2),
            "revenue_per_ton": guarded_ratio(value, weight, 2),
            "margin_brl": half_up(F.col(value) - F.col(fuel), 2),
            "is_delayed": F.col(delay) > delay_threshold,
        }
    )


def wall_clock_seconds(start: str, end: str):
    """Whole seconds from ``start`` to ``end`` on the wall clock: day
    difference plus time-of-day difference, so the result does not depend on
    the session time zone (no DST hour) for ``timestamp_ntz`` values."""

    def tod(c):
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 86400 + tod(end) - tod(start)


def refine(df: DataFrame) -> DataFrame:
    """Cast then derive: the typed, enriched silver candidate rows."""
    return derive_columns(cast_types(df))
