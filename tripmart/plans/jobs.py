"""Jobs J1-J8 and the command line.

Each job reads its input layer, builds one lazy plan and writes.  J2-J5 read the
whole layer below them and replace the whole layer they write (static
overwrite), so a re-run leaves nothing stale; work limited to touched days
replaces those days and deletes the ones that became empty.  J1 appends; with a
content ledger a second run appends nothing.  What is used twice is staged as a
table in the shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import history, marts, quality, reports, scoring, segment, serve, sinks
from tripmart.operators import dedup as dd
from tripmart.operators.refine import cast_types, require_times
from tripmart.plans.pipeline import clean_silver, rejected
from tripmart.schema import SERVING_CONTRACTS, SERVING_SORT_KEYS
from tripmart.session import staged, staging
from tripmart.sources import events
from tripmart.sources.landing import add_lineage, missing_columns, read_landing
from tripmart.sources.quoted import read_quoted

SORT_KEYS = {f"gold_{k}": v for k, v in SERVING_SORT_KEYS.items()}


def _raw(spark: SparkSession, landing: str, multi_line: bool, files: list[str] | None = None) -> DataFrame:
    """Landing rows as text, of all files or of the given ones."""
    if multi_line:
        return read_quoted(spark, landing, base_path=landing, keep_corrupt=True, files=files)
    raw = read_landing(spark, landing, base_path=landing, keep_corrupt=True)
    return raw if files is None else raw.filter(F.col("_metadata.file_path").isin(files))  # prunes the list of files


def ingest(
    spark: SparkSession, landing: str, bronze: str, run_id: str | None = None, strict: bool = False,
    ledger: str | None = None, multi_line: bool = False,
) -> dict:
    """Landing CSV -> expected-column check -> lineage -> append bronze
    partitioned by ingestion date.  A run has one date, so its rows need no clustering.

    With ``ledger`` (S6) files that it lists unchanged are not opened.  The rows of the
    others are read once and staged; of those only files whose content no earlier run
    ingested are appended, one file for each content.  The ledger is written last.
    Lines that do not parse are kept with their text in ``_corrupt_record``."""
    run_id = run_id or str(uuid.uuid4())
    if ledger is None:
        raw = _raw(spark, landing, multi_line)
        missing = missing_columns(raw, strict=strict)
        return {"rows": sinks.append_partitioned(add_lineage(raw, run_id=run_id), bronze, "_ingestion_date", cluster=False), "missing_columns": missing, "run_id": run_id}
    with staging(spark):
        seen = spark.read.schema(events.LEDGER_SCHEMA).parquet(ledger) if sinks.exists(spark, ledger) else None
        found = events.file_identities(spark, landing, compressed=not multi_line)  # ranges of a compressed file cannot be read
        files = staged(events.unlisted_files(found, seen), "new-files")
        paths = [r[0] for r in files.select("_source_path").collect()]  # names of this run's new files
        if not paths:
            return {"rows": 0, "missing_columns": [], "run_id": run_id, "files_read": 0}
        raw = _raw(spark, landing, multi_line, paths)
        missing = missing_columns(raw, strict=strict)
        data = [c for c in raw.columns if c not in ("year", "month", "_source_path")]
        rows = staged(add_lineage(raw, run_id=run_id), "new-rows")
        # the ledger must not be read while it is appended to
        judged = staged(events.judged_files(files, events.content_fingerprints(rows, data), seen), "judged-files")
        fresh = rows.join(judged.filter("ingested").select("_source_path"), "_source_path", "left_semi")
        n = sinks.append_partitioned(fresh.select(*rows.columns), bronze, "_ingestion_date", cluster=False)
        events.record(judged, ledger)
    return {"rows": n, "missing_columns": missing, "run_id": run_id, "files_read": len(paths)}


def refine_job(
    spark: SparkSession,
    bronze: str,
    silver: str,
    quarantine: str,
    rules=None,
    on_unknown: str = quality.QUARANTINE,
    prefilter_nulls: bool = False,
    compat: bool = False,
) -> dict:
    """All of bronze -> typed, flagged, deduplicated -> silver (by trip_date)
    and quarantine (by ingestion date, so NULL trip dates are no problem).

    The input is the whole layer, so both outputs are replaced as a whole: days
    and rejections that are no longer in bronze go.  The keys are counted first, by day
    and by month; then rows are moved once for each output, by what it is written by
    (days; months of departure, as trips arrive soon after), and written where they are."""
    typed = cast_types(spark.read.option("mergeSchema", "true").parquet(bronze))
    src = require_times(typed) if prefilter_nulls else typed
    day = F.to_date("departure_time")
    month = F.trunc(day, "month")
    counted = dd.bucket_rows(src, day=day, month=month)
    read, hot = sum(counted["keys"].values()), dd.hot_of(counted["keys"])
    moved = lambda unit, n: lambda rows: dd.dedup_moved(rows, hot, part=dd.part_of(unit, n), rows=read)
    flagged = rejected(src, rules, on_unknown, moved(month, counted["month"]))
    dropped = Observation(f"dropped-{uuid.uuid4().hex[:8]}")
    flagged = flagged.observe(dropped, F.count_if(F.col(quality.STATUS) == quality.DROPPED).alias("rows"))
    quar = quality.quarantine_side(flagged, rules, compat, on_unknown)
    clean = clean_silver(src, rules, moved(day, counted["day"]))
    n_quar = sinks.write_counted(quar, quarantine, partition_by=("_ingestion_date",), overwrite_mode="static", cluster=False)
    n_clean = sinks.write_counted(clean, silver, partition_by=("trip_date",), overwrite_mode="static", cluster=False)
    n_dropped = sinks.observed_rows(dropped)
    out = {"rows_read": read, "duplicates_removed": read - n_clean - n_quar - n_dropped, "rows_clean": n_clean, "rows_quarantined": n_quar, "rows_dropped": n_dropped}
    if prefilter_nulls:  # rows filtered out beforehand were read too
        filtered = typed.count() - read
        out |= {"rows_read": read + filtered, "rows_without_times": filtered}
    return out


def build_marts(spark: SparkSession, silver: str, gold: str, cache: bool = False, days=None, by: str = "month") -> dict:
    """The four daily marts, each scanning only its columns, clustered by day.

    A mart has a handful of rows a day, so its files are monthly by default, with
    ``trip_date`` as a sorted column whose statistics prune days; ``by="day"`` gives a
    folder a day.  All of silver replaces all of gold; with ``days`` only those days
    (their months) are recomputed and replaced, and emptied ones deleted."""
    if by not in ("month", "day"):
        raise ValueError("by must be 'month' or 'day'")
    df = spark.read.parquet(silver)
    unit = "trip_date" if by == "day" else sinks.MONTH
    touched = None
    if days is not None:
        touched = sorted({str(d) if by == "day" else str(d)[:7] for d in days})
        day = F.col("trip_date").cast("string")
        df = df.filter(day.isin(touched) if by == "day" else F.substring(day, 1, 7).isin(touched))
    if cache:
        df = df.select(*marts.INPUTS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {}
        for name, fn in marts.MARTS.items():
            path = f"{gold}/{name}"
            mart = fn(df) if by == "day" else sinks.by_month(fn(df))
            layout = {"partition_col": unit, "sort_by": SORT_KEYS[name], "tasks": sinks.slots(spark)}
            if touched is None:
                counts[name] = sinks.overwrite_partitioned(mart, path, dynamic=False, **layout)
            else:
                counts[name] = sinks.replace_partitions(staged(mart, name), path, touched, **layout)
        return counts
    finally:
        if cache:
            df.unpersist()


def backfill(spark: SparkSession, silver: str, out: str, scalable: bool = True) -> dict:
    """H1 over the whole silver history, replaced as a whole."""
    trips = spark.read.parquet(silver)
    enriched = history.enrich_history(trips, scalable=scalable)
    tasks = sinks.writing_tasks(spark, trips.count())  # a count of Parquet reads footers only
    return {"rows": sinks.overwrite_partitioned(enriched, out, "trip_date", dynamic=False, tasks=tasks)}


def score_job(spark: SparkSession, silver: str, out: str, model=None, compat: bool = False) -> dict:
    """F1-F4, scored trips by trip_date, replaced as a whole.  ``model``: an
    object with ``predict_proba``, a fitted ``PipelineModel``, or None."""
    trips = spark.read.parquet(silver)
    scored = scoring.score(trips, model=model, compat=compat)
    rows = sinks.overwrite_partitioned(scored, out, "trip_date", dynamic=False, tasks=sinks.writing_tasks(spark, trips.count()))
    return {"rows": rows, "model_used": "heuristic" if model is None else type(model).__name__}


def cluster_job(spark: SparkSession, silver: str, out: str, k: int = 6, centres: str | None = None) -> dict:
    """A5 + F5-F9, route clusters overwritten unpartitioned, and with ``centres``
    the k centres as a table of their own."""
    clusters, report = segment.segment_routes(spark.read.parquet(silver), k=k)
    report["rows"] = sinks.overwrite(clusters, out)
    if centres:
        sinks.overwrite(segment.centre_table(spark, report), centres)
    return report


def publish_job(spark: SparkSession, gold: str, serving_root: str, prefix: str = "serving_", on_violation: str = "refuse") -> DataFrame:
    """Check the four marts against their contracts, load the typed serving
    tables as new versions, analyze them, show them and return their row counts."""
    frames = {key: spark.read.parquet(f"{gold}/gold_{key}") for key in SERVING_CONTRACTS}
    return serve.publish(spark, frames, serving_root, prefix, on_violation=on_violation)


def report_job(spark: SparkSession, name: str, source: str, out: str, as_of: str | None = None) -> dict:
    """One saved report over a silver or quarantine folder, written as CSV."""
    spark.read.parquet(source).createOrReplaceTempView("report_source")
    df = reports.run_sql_report(spark, name, "report_source", as_of)
    return {"rows": sinks.write_counted(df, out, partition_by=(), fmt="csv", options={"header": "true"})}


def main(argv=None) -> int:
    """``python -m tripmart.plans.jobs --mode ... --input ... --output ...``."""
    from tripmart.session import get_spark

    p = argparse.ArgumentParser(description="tripmart jobs")
    p.add_argument("--mode", required=True, choices=["ingest", "refine", "gold", "backfill", "score", "cluster", "publish", "report"])
    p.add_argument("--input", required=True, help="landing / bronze / silver / gold path")
    p.add_argument("--output", required=True, help="bronze / silver / gold / output path")
    p.add_argument("--quarantine", default="", help="quarantine path (refine)")
    p.add_argument("--k", type=int, default=6, help="clusters (cluster)")
    p.add_argument("--centres", default=None, help="path for the centres (cluster)")
    p.add_argument("--by", default="month", choices=["month", "day"], help="folders of the marts (gold)")
    p.add_argument("--ledger", default=None, help="content ledger path (ingest)")
    p.add_argument("--multi-line", action="store_true", help="quoted line breaks in CSV (ingest)")
    p.add_argument("--model", default=None, help="folder of a saved PipelineModel (score)")
    p.add_argument("--report", default="daily_report", choices=sorted(reports.SQL_REPORTS), help="which report (report)")
    p.add_argument("--as-of", default=None, help="report date, yyyy-MM-dd (report)")
    p.add_argument("--on-violation", default="refuse", choices=["refuse", "route"], help="contract violations (publish)")
    p.add_argument("--on-unknown", default=quality.QUARANTINE, choices=[quality.QUARANTINE, "drop"])
    a = p.parse_args(argv)
    spark = get_spark(f"tripmart-{a.mode}")
    if a.mode == "ingest":
        res = ingest(spark, a.input, a.output, ledger=a.ledger, multi_line=a.multi_line)
    elif a.mode == "refine":
        res = refine_job(spark, a.input, a.output, a.quarantine or f"{a.output.rstrip('/')}_quarantine",
                         on_unknown=a.on_unknown)
    elif a.mode == "gold":
        res = build_marts(spark, a.input, a.output, by=a.by)
    elif a.mode == "backfill":
        res = backfill(spark, a.input, a.output)
    elif a.mode == "score":
        model = None
        if a.model:
            from pyspark.ml import PipelineModel

            model = PipelineModel.load(a.model)
        res = score_job(spark, a.input, a.output, model=model)
    elif a.mode == "cluster":
        res = cluster_job(spark, a.input, a.output, k=a.k, centres=a.centres)
    elif a.mode == "report":
        res = report_job(spark, a.report, a.input, a.output, a.as_of)
    else:
        res = {r["table_name"]: r["row_count"] for r in publish_job(spark, a.input, a.output, on_violation=a.on_violation).collect()}
    print(json.dumps(res, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
