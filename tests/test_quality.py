from pyspark.sql import functions as F

from tripmart.operators import quality as q
from tripmart.operators.refine import cast_types

BASE = {
    "trip_id": "s-77",
    "cargo_type": "SUGAR",
    "cargo_weight_tons": 2310.5,
    "freight_value_brl": 41800.0,
    "delay_minutes": 4,
    "departure_time": "2024-04-09 13:00:00",
    "arrival_time": "2024-04-10 02:20:00",
}


def frame(spark, rows):
    return cast_types(spark.createDataFrame(rows))


def test_each_error_rule_alone(spark):
    cases = {
        "positive_weight": {"cargo_weight_tons": 0.0},
        "non_negative_value": {"freight_value_brl": -0.01},
        "non_negative_delay": {"delay_minutes": -1},
        "time_sequence": {"arrival_time": BASE["departure_time"]},
    }
    rows = [BASE] + [dict(BASE, trip_id=name, **change) for name, change in cases.items()]
    clean, quar = q.split(frame(spark, rows))
    assert [r["trip_id"] for r in clean.collect()] == ["s-77"]
    assert {r["trip_id"]: r["_failure_reason"] for r in quar.collect()} == {n: n for n in cases}


def test_amounts_beyond_exact_sums_are_quarantined(spark):
    rows = [dict(BASE, trip_id="v", freight_value_brl=1e15), dict(BASE, trip_id="w", cargo_weight_tons=3e20)]
    clean, quar = q.split(frame(spark, rows))
    assert clean.count() == 0
    assert {r["trip_id"]: r["_failure_reason"] for r in quar.collect()} == {"v": "non_negative_value", "w": "positive_weight"}


def test_unknown_rows_policy(spark):
    rows = [
        dict(BASE, trip_id="a", cargo_weight_tons=1.0),
        dict(BASE, trip_id="b", cargo_weight_tons=None),
        dict(BASE, trip_id="c", cargo_weight_tons=None, delay_minutes=-1),
        dict(BASE, trip_id="d", cargo_weight_tons=-1.0),
    ]
    df = frame(spark, rows)
    clean, quar = q.split(df)  # default: unknown is quarantined, nothing lost
    assert clean.count() == 1 and quar.count() == 3
    reasons = {r["trip_id"]: r["_failure_reason"] for r in quar.collect()}
    assert reasons["b"] == "positive_weight"
    assert reasons["c"] == "positive_weight, non_negative_delay"
    clean_d, quar_d = q.split(df, on_unknown="drop")  # the original behaviour: b is lost
    assert clean_d.count() == 1 and quar_d.count() == 2
    assert {r["trip_id"] for r in quar_d.collect()} == {"c", "d"}


def test_compat_reason_text(spark):
    df = frame(spark, [dict(BASE, cargo_weight_tons=-1.0)])
    _, quar = q.split(df, compat=True)
    assert quar.collect()[0]["_failure_reason"] == "positive_weight, , , , , "
    many = frame(spark, [dict(BASE, cargo_weight_tons=-1.0, freight_value_brl=-1.0, arrival_time="2020-05-05 00:00:00")])
    _, quar = q.split(many)
    assert quar.collect()[0]["_failure_reason"] == "positive_weight, non_negative_value, time_sequence"


def test_null_times_are_quarantined_not_filtered(spark):
    df = frame(spark, [dict(BASE, departure_time=None), dict(BASE, departure_time="garbage")])
    clean, quar = q.split(df)
    assert clean.count() == 0
    assert {r["_failure_reason"] for r in quar.collect()} == {"valid_departure, time_sequence"}


def test_warning_flags(spark):
    rows = [
        dict(BASE, trip_id="w1", cargo_weight_tons=15000.0),
        dict(BASE, trip_id="w2", cargo_weight_tons=14999.99),
        dict(BASE, trip_id="w3", cargo_type="ROCKS"),
        dict(BASE, trip_id="w4", cargo_type=None),
    ]
    clean, _ = q.split(frame(spark, rows))
    got = {r["trip_id"]: (r["_warn_reasonable_weight"], r["_warn_known_cargo_type"]) for r in clean.collect()}
    assert got == {"w1": (True, False), "w2": (False, False), "w3": (False, True), "w4": (False, None)}
    assert not [c for c in clean.columns if c.startswith("_dq_")]


def test_clean_plus_quarantine_equals_input_on_trips(spark):
    from conftest import SF_SMALL
    from tripmart.plans.pipeline import bronze_trips, flag_and_dedup, trips_rules

    flagged = flag_and_dedup(bronze_trips(spark, SF_SMALL), trips_rules())
    n = flagged.count()
    clean = q.clean_side(flagged, trips_rules()).count()
    quar = q.quarantine_side(flagged, trips_rules()).count()
    assert clean + quar == n
    assert n == 4599  # distinct (trip_id, departure_time) at sf0.001


def test_rule_helpers(spark):
    rules = [q.positive("w"), q.not_null("w", name="w_set"), q.in_range("w", 0, 10), q.one_of("c", ["A"])]
    df = spark.createDataFrame([(5.0, "A"), (None, "B"), (20.0, "A")], "w double, c string")
    clean, quar = q.split(df, rules)
    assert clean.count() == 1
    assert sorted(r["_failure_reason"] for r in quar.collect()) == ["w_in_range", "w_positive, w_set, w_in_range"]
