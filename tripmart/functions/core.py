"""Scalar and aggregate building blocks.

Money is summed as ``decimal(28,6)``: the result is exact and does not depend
on how rows are split across tasks, so re-running a job after a lost executor
gives the same digits.  Rounding goes through a decimal so ``1.005`` rounds
half-up to ``1.01`` regardless of its binary representation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(28,6)"
ROUND_TYPE = "decimal(38,6)"
#: Amounts beyond this size are an error of the data (see ``quality.default_rules``);
#: below it, sums of 10^10 rows still fit the sum's decimal(38,6).
AMOUNT_LIMIT = 1e15


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact fixed-point form of a double amount; NULL where it has none."""
    return _col(c).try_cast(MONEY_TYPE)


def half_up(c, digits: int) -> Column:
    """round(x, digits), half away from zero on the decimal value, as double."""
    return F.round(_col(c).try_cast(ROUND_TYPE), digits).cast("double")


def rounded_sum(c, digits: int) -> Column:
    """Sum rounded half-up while it is still a decimal, as double."""
    return F.round(F.sum(money(c)), digits).cast("double")


def exact_sum(c) -> Column:
    """Order-independent sum of a double column, as double."""
    return F.sum(money(c)).cast("double")


def exact_avg(c) -> Column:
    """avg(x) ignoring NULLs, from an exact sum; NULL when no value."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(_col(c)))


def to_timestamp(c) -> Column:
    """Text or timestamp to wall-clock timestamp; unparsable -> NULL.

    A text with an offset (``+03:00``, ``Z``) names an instant and becomes its
    UTC wall clock; one without is a wall clock already."""
    text = _col(c).cast("string")
    zoned = text.rlike(r":[0-9.]+ *(Z|[+-][0-9]{2}:?[0-9]{2}) *$")
    utc = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    return F.when(zoned, utc).otherwise(text.try_cast("timestamp_ntz"))


def to_double(c) -> Column:
    """To double; unparsable -> NULL."""
    return _col(c).try_cast("double")


def to_int(c) -> Column:
    """To int through double, truncating ('45.7' -> 45); out of range or
    unparsable -> NULL."""
    return _col(c).try_cast("double").try_cast("int")


def normalise_text(c) -> Column:
    """upper(trim(x)); trim removes spaces only."""
    return F.upper(F.trim(_col(c)))


def guarded_ratio(num, den, digits: int = 2) -> Column:
    """round(num / den, digits) when den > 0, else NULL."""
    return F.when(_col(den) > 0, half_up(F.try_divide(_col(num), _col(den)), digits))
