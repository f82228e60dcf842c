import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.functions.core import half_up, to_timestamp
from tripmart.operators.refine import cast_types, derive_columns, require_times

NIGHT_TRAIN = {
    "departure_time": "2023-11-02 22:15:00",
    "arrival_time": "2023-11-03 03:45:30",
    "cargo_weight_tons": "812.5",
    "freight_value_brl": "64030.10",
    "fuel_cost_brl": "7110.45",
    "delay_minutes": "31",
    "cargo_type": "  soybean",
    "origin_station": "curitiba ",
    "destination_station": "porto alegre",
}


def typed(spark, *changes):
    return cast_types(spark.createDataFrame([dict(NIGHT_TRAIN, **c) for c in changes or ({},)]))


def test_text_becomes_typed_columns(spark):
    kinds = dict(typed(spark).dtypes)
    assert {kinds[c] for c in ("departure_time", "arrival_time")} == {"timestamp_ntz"}
    assert {kinds[c] for c in ("cargo_weight_tons", "freight_value_brl", "fuel_cost_brl")} == {"double"}
    assert kinds["delay_minutes"] == "int"


def test_names_are_trimmed_and_upper_case(spark):
    row = typed(spark).first()
    assert (row["cargo_type"], row["origin_station"], row["destination_station"]) == ("SOYBEAN", "CURITIBA", "PORTO ALEGRE")


@pytest.mark.parametrize(
    "column, text, value",
    [("departure_time", "yesterday", None), ("cargo_weight_tons", "heavy", None), ("delay_minutes", "12.9", 12),
     ("delay_minutes", "-12.9", -12), ("delay_minutes", "9e12", None), ("delay_minutes", "", None)],
)
def test_what_does_not_parse_is_null(spark, column, text, value):
    assert typed(spark, {column: text}).first()[column] == value


@pytest.mark.parametrize(
    "text, wall",
    [("2024-01-01T10:00:00+03:00", dt.datetime(2024, 1, 1, 7)), ("2024-01-01 10:00:00Z", dt.datetime(2024, 1, 1, 10)),
     ("2024-01-01 23:30:00-0200", dt.datetime(2024, 1, 2, 1, 30)), ("2024-01-01 10:00:00", dt.datetime(2024, 1, 1, 10)),
     ("2024-01-01", dt.datetime(2024, 1, 1)), ("2024-01-01 10:00:00.250", dt.datetime(2024, 1, 1, 10, 0, 0, 250000))],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_offsets_are_honoured_in_any_session_zone(spark, text, wall, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert spark.createDataFrame([(text,)], "t string").select(to_timestamp("t").alias("t")).first()["t"] == wall
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_derived_columns(spark):
    row = derive_columns(typed(spark)).first()
    assert (row["trip_date"], row["departure_hour"]) == (dt.date(2023, 11, 2), 22)
    assert row["trip_duration_hours"] == 5.51  # 5 h 30 min 30 s
    assert row["revenue_per_ton"] == 78.81 and row["margin_brl"] == 56919.65
    assert row["is_delayed"] is True
    assert derive_columns(typed(spark, {"delay_minutes": "30"})).first()["is_delayed"] is False


def test_no_ratio_without_weight(spark):
    rows = derive_columns(typed(spark, {"cargo_weight_tons": "0"}, {"cargo_weight_tons": "-5"}, {"cargo_weight_tons": None})).collect()
    assert [r["revenue_per_ton"] for r in rows] == [None] * 3


def test_rounding_is_half_up_on_the_decimal_value(spark):
    values = [(1.005, 2, 1.01), (-2.5, 0, -3.0), (123456789012345.675, 2, 123456789012345.67), (4.0e14, 2, 4.0e14)]
    for x, digits, expected in values:
        assert spark.range(1).select(half_up(F.lit(x), digits)).first()[0] == pytest.approx(expected, abs=0.02)


def test_rows_without_times_can_be_left_out(spark):
    df = typed(spark, {}, {"arrival_time": None}, {"departure_time": "?"})
    assert require_times(df).count() == 1
