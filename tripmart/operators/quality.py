"""Declarative data-quality rules (Q1-Q10).

A rule is a boolean SQL condition, TRUE meaning pass.  Rules evaluate in one
projection; the split into clean and quarantine is two filters over the same
flagged frame, so a caller can persist that frame once and write both sides.

Three-valued logic: a rule whose condition is NULL (e.g. weight missing) is
*unknown*.  ``on_unknown="quarantine"`` (default) sends such rows to the
quarantine with the rule named in the reason, so no row is lost;
``on_unknown="drop"`` reproduces the original behaviour, where such rows end
up in neither output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.core import AMOUNT_LIMIT

ERROR = "error"
WARNING = "warning"

# The freight cargo types the shipped warning rule accepts.
FREIGHT_CARGO_TYPES = ["GRAIN", "FUEL", "IRON_ORE", "CONTAINER", "SUGAR", "SOYBEAN", "OTHER"]

STATUS = "_dq_status"
CLEAN, QUARANTINE, DROPPED = "clean", "quarantine", "dropped"
PASSED = "_dq_passed"
REASON = "_failure_reason"


@dataclass(frozen=True)
class DQRule:
    """Q1: name, condition (SQL text or Column; TRUE = pass), severity."""

    name: str
    condition: str | Column
    severity: str = ERROR
    description: str = ""

    def column(self) -> Column:
        if isinstance(self.condition, str):
            return F.expr(self.condition)
        return self.condition


def not_null(column: str, name: str | None = None, severity: str = ERROR) -> DQRule:
    return DQRule(name or f"{column}_not_null", F.col(column).isNotNull(), severity, f"{column} is required")


def positive(column: str, name: str | None = None, severity: str = ERROR) -> DQRule:
    return DQRule(name or f"{column}_positive", F.col(column) > 0, severity, f"{column} must be > 0")


def non_negative(column: str, name: str | None = None, severity: str = ERROR) -> DQRule:
    return DQRule(name or f"{column}_non_negative", F.col(column) >= 0, severity, f"{column} must be >= 0")


def in_range(column: str, low=None, high=None, name: str | None = None, severity: str = ERROR) -> DQRule:
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(column) >= low)
    if high is not None:
        cond = cond & (F.col(column) < high)
    return DQRule(name or f"{column}_in_range", cond, severity, f"{column} in [{low}, {high})")


def one_of(column: str, values, name: str | None = None, severity: str = WARNING) -> DQRule:
    return DQRule(name or f"{column}_known", F.col(column).isin(list(values)), severity, f"{column} in list")


def default_rules(known_cargo_types=FREIGHT_CARGO_TYPES, amount_limit: float | None = AMOUNT_LIMIT) -> list[DQRule]:
    """Q2, Q3: the error and warning rules of the silver layer.

    With ``amount_limit`` an amount too large for exact sums fails the rule of
    its column, so it is quarantined instead of stopping every mart."""
    below = "" if amount_limit is None else " AND {} < " + repr(float(amount_limit))
    # Rule names and the conditions without the limit.
    return [
        DQRule("positive_weight", "cargo_weight_tons > 0" + below.format("cargo_weight_tons"), ERROR, "a trip carries some cargo"),
        DQRule("non_negative_value", "freight_value_brl >= 0" + below.format("freight_value_brl"), ERROR, "no freight is paid for by the carrier"),
        DQRule("non_negative_delay", "delay_minutes >= 0", ERROR, "early arrivals are recorded as zero"),
        DQRule("valid_departure", "departure_time IS NOT NULL", ERROR, "without it the trip has no day"),
        DQRule("valid_arrival", "arrival_time IS NOT NULL", ERROR, "without it the trip has no duration"),
        DQRule("time_sequence", "arrival_time > departure_time", ERROR, "a trip takes time"),
        DQRule("reasonable_weight", "cargo_weight_tons < 15000", WARNING, "heavier than any train in service"),
        DQRule("known_cargo_type", F.col("cargo_type").isin(list(known_cargo_types)), WARNING, "not in the cargo list"),
    ]


def _errors(rules):
    return [r for r in rules if r.severity == ERROR]


def _warnings(rules):
    return [r for r in rules if r.severity == WARNING]


def passed_column(rules=None) -> Column:
    """TRUE when every error rule is TRUE (unknown counts as not passed)."""
    rules = default_rules() if rules is None else rules
    passed = F.lit(True)
    for r in _errors(rules):
        passed = passed & F.coalesce(r.column(), F.lit(False))
    return passed


def evaluate_rules(df: DataFrame, rules=None, on_unknown: str = QUARANTINE) -> DataFrame:
    """Q4: add ``_dq_<rule>`` (raw result) per error rule, ``_dq_passed``
    (all TRUE) and ``_dq_status`` (clean / quarantine / dropped)."""
    if on_unknown not in (QUARANTINE, "drop"):
        raise ValueError("on_unknown must be 'quarantine' or 'drop'")
    rules = default_rules() if rules is None else rules
    errors = _errors(rules)
    flags = {f"_dq_{r.name}": r.column() for r in errors}
    df = df.withColumns(flags)
    passed = F.lit(True)
    any_false = F.lit(False)
    for name in flags:
        passed = passed & F.coalesce(F.col(name), F.lit(False))
        any_false = any_false | F.coalesce(~F.col(name), F.lit(False))
    status = (
        F.when(passed, F.lit(CLEAN))
        .when(any_false | F.lit(on_unknown == QUARANTINE), F.lit(QUARANTINE))
        .otherwise(F.lit(DROPPED))
    )
    return df.withColumns({PASSED: passed, STATUS: status})


def failure_reason(df: DataFrame, rules=None, compat: bool = False, on_unknown: str = QUARANTINE) -> DataFrame:
    """Q6: ``_failure_reason``.  Compact: failed names joined by ', ' (an
    unknown result counts as failed under ``on_unknown="quarantine"``).
    ``compat=True``: one slot per error rule, empty when the rule passed or
    was unknown, joined by ', ' (``'positive_weight, , , , , '``)."""
    rules = default_rules() if rules is None else rules
    errors = _errors(rules)
    if compat:
        slots = [F.when(~F.col(f"_dq_{r.name}"), F.lit(r.name)).otherwise(F.lit("")) for r in errors]
    elif on_unknown == QUARANTINE:
        slots = [F.when(~F.coalesce(F.col(f"_dq_{r.name}"), F.lit(False)), F.lit(r.name)) for r in errors]
    else:
        slots = [F.when(~F.col(f"_dq_{r.name}"), F.lit(r.name)) for r in errors]
    return df.withColumn(REASON, F.concat_ws(", ", *slots))


def warning_flags(df: DataFrame, rules=None) -> DataFrame:
    """Q7: ``_warn_<rule>`` = NOT condition; NULL stays NULL."""
    rules = default_rules() if rules is None else rules
    return df.withColumns({f"_warn_{r.name}": ~r.column() for r in _warnings(rules)})


def drop_dq_columns(df: DataFrame) -> DataFrame:
    """M3: drop every ``_dq_*`` column."""
    return df.drop(*[c for c in df.columns if c.startswith("_dq_")])


def clean_side(flagged: DataFrame, rules=None) -> DataFrame:
    """Q5 (clean half): rows passing every error rule, with warning flags."""
    clean = flagged.filter(F.col(STATUS) == CLEAN)
    return drop_dq_columns(warning_flags(clean, rules))


def quarantine_side(flagged: DataFrame, rules=None, compat: bool = False, on_unknown: str = QUARANTINE) -> DataFrame:
    """Q5 (quarantine half): rows failing a rule, with ``_failure_reason``;
    the per-rule ``_dq_*`` flags stay for auditing."""
    q = flagged.filter(F.col(STATUS) == QUARANTINE)
    q = failure_reason(q, rules, compat=compat, on_unknown=on_unknown)
    return q.drop(PASSED, STATUS)


def split(df: DataFrame, rules=None, on_unknown: str = QUARANTINE, compat: bool = False):
    """Q4-Q7: returns ``(clean, quarantine)``."""
    flagged = evaluate_rules(df, rules, on_unknown)
    return clean_side(flagged, rules), quarantine_side(flagged, rules, compat, on_unknown)


def quarantine_audit(quarantine: DataFrame, reason: str = REASON, date_col: str = "_ingestion_date") -> DataFrame:
    """Q8: rejected rows per reason with first and last ingestion date,
    most frequent first (ties by reason)."""
    return (
        quarantine.groupBy(F.col(reason).alias("failure_reason"))
        .agg(
            F.count(F.lit(1)).alias("rejected_rows"),
            F.min(date_col).alias("first_seen"),
            F.max(date_col).alias("last_seen"),
        )
        .orderBy(F.col("rejected_rows").desc(), F.col("failure_reason").asc_nulls_last())
    )


def quarantine_rate_by_day(flagged: DataFrame, date_col: str = "trip_date") -> DataFrame:
    """Q9: per day, all rows seen, rows quarantined and the rate in percent."""
    from tripmart.functions.core import half_up

    return (
        flagged.groupBy(date_col)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(STATUS) == QUARANTINE).alias("quarantined_rows"),
            F.count_if(F.col(STATUS) == DROPPED).alias("dropped_rows"),
        )
        .withColumn(
            "quarantine_rate_pct",
            half_up(F.try_divide(F.col("quarantined_rows"), F.col("total_rows")) * 100, 2),
        )
    )


def run_counts(flagged_deduped: DataFrame, copies: str) -> DataFrame:
    """Q10 + D2 as a one-row frame from one pass: rows read, rows after dedup,
    duplicates removed, clean, quarantined, dropped.  ``copies`` names the column
    with the number of input rows each survivor stands for (``dedup``)."""
    return flagged_deduped.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_deduped"),
        (F.coalesce(F.sum(copies), F.lit(0)) - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(F.col(STATUS) == CLEAN).alias("rows_clean"),
        F.count_if(F.col(STATUS) == QUARANTINE).alias("rows_quarantined"),
        F.count_if(F.col(STATUS) == DROPPED).alias("rows_dropped"),
    )
