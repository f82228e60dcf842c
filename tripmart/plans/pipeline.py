"""Silver pipeline composition: bronze -> typed -> flagged -> deduped -> split.

``flag_and_dedup`` is the one frame both outputs come from.  Because the
dedup order is total, recomputing it (after a lost executor or a second
action) yields the same survivors, so clean and quarantine always partition
the same deduplicated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import dedup as dd
from tripmart.operators import quality as q
from tripmart.operators.refine import cast_types, derive_columns, require_times
from tripmart.schema import NATURAL_KEY
from tripmart.sources.tables import TRIPS_KNOWN_CARGO, trips


def simulated_lineage(df: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Test fixture only: lineage columns as if each trip arrived on its
    arrival day in the monthly landing file, ingested on the first day of
    that month."""
    a = F.col(arrival).cast("timestamp_ntz").cast("string")  # 'yyyy-MM-dd HH:mm:ss'
    day, month = F.substring(a, 1, 10), F.substring(a, 1, 7)
    return df.withColumns(
        {
            "_ingestion_timestamp": F.concat(day, F.lit("T"), F.substring(a, 12, 8), F.lit("+00:00")),
            "_pipeline_run_id": F.concat(F.lit("run-"), F.regexp_replace(day, "-", "")),
            "_source_path": F.concat(
                F.lit("freight/year="), F.substring(a, 1, 4),
                F.lit("/month="), F.substring(a, 6, 2),
                F.lit("/freight_"), month, F.lit(".csv"),
            ),
            "_ingestion_date": F.concat(month, F.lit("-01")).cast("date"),
        }
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips`` plus (simulated) bronze lineage."""
    return simulated_lineage(trips(spark, sf_dir))


def trips_rules():
    return q.default_rules(known_cargo_types=TRIPS_KNOWN_CARGO)


def flag_and_dedup(
    bronze: DataFrame,
    rules=None,
    on_unknown: str = q.QUARANTINE,
    prefilter_nulls: bool = False,
    deduplicate: bool = True,
    copies: str | None = None,
) -> DataFrame:
    """Type, keep one row per natural key (preferring a copy that passes the
    rules), derive, evaluate the rules.  ``prefilter_nulls=True`` drops rows
    without departure or arrival before the rules, as the original job did.

    Only raw columns and the pass/fail outcome go through the dedup shuffle;
    everything derived, ``trip_date`` included, is computed on the survivors.
    A date filter on the result therefore reaches the scan through the key."""
    df = cast_types(bronze)
    if prefilter_nulls:
        df = require_times(df)
    if deduplicate:
        df = dd.dedup(df.withColumn(q.PASSED, q.passed_column(rules)), copies=copies)
    return q.evaluate_rules(derive_columns(df), rules, on_unknown)


def drop_metadata(df: DataFrame) -> DataFrame:
    """M3: drop every ``_*`` column except the ``_warn*`` flags."""
    return df.drop(*[c for c in df.columns if c.startswith("_") and not c.startswith("_warn")])


def split_silver(flagged: DataFrame, rules=None, compat: bool = False, on_unknown: str = q.QUARANTINE):
    """(silver, quarantine): silver without lineage, quarantine with it."""
    clean = q.clean_side(flagged, rules)
    return drop_metadata(clean), q.quarantine_side(flagged, rules, compat=compat, on_unknown=on_unknown)


NEWEST = "_ingestion_timestamp"


def clean_silver(typed: DataFrame, rules=None, dedup=dd.dedup) -> DataFrame:
    """The silver of :func:`split_silver` from typed rows, without what does not reach it:
    a copy that passes the rules wins over those that do not, so only copies that pass are
    compared, and metadata behind the last other column would only decide between copies
    with equal silver rows."""
    named = [str(r.condition) for r in rules or []]  # a warning may be about metadata
    last = max(i for i, c in enumerate(typed.columns) if not c.startswith("_") or any(c in n for n in named))
    kept = [c for i, c in enumerate(typed.columns) if i <= last or c == NEWEST]
    passing = typed.filter(q.passed_column(rules)).select(*kept)
    if NEWEST in kept and typed.columns.index(NEWEST) > last:  # its text decides nothing, so the time travels
        passing = passing.withColumn(NEWEST, F.col(NEWEST).try_cast("timestamp"))
    return drop_metadata(q.warning_flags(derive_columns(dedup(passing)), rules))


def rejected(typed: DataFrame, rules=None, on_unknown: str = q.QUARANTINE, dedup=dd.dedup) -> DataFrame:
    """The rest of :func:`flag_and_dedup`: the flagged survivors of keys that no passing
    copy has.  Of copies that pass, only the key travels."""
    judged = typed.withColumn(q.PASSED, q.passed_column(rules))
    rest = {c: F.when(~F.col(q.PASSED), F.col(c)) for c in typed.columns if c not in NATURAL_KEY}
    return q.evaluate_rules(derive_columns(dedup(judged.withColumns(rest)).filter(~F.col(q.PASSED))), rules, on_unknown)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table of the test data."""
    return clean_silver(cast_types(bronze_trips(spark, sf_dir)), trips_rules())
