import json
import time

from pyspark.sql import functions as F

from tripmart.operators import sinks
from tripmart.session import scratch_path
from tripmart.sources import events as ev


def _event(*records):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": "raw"}, "object": o}} for o in records]})


def test_file_arrivals(spark):
    events = spark.createDataFrame(
        [
            ("req-aaaaaaaaaaaaaaaaaaaaaaaa", _event({"key": "freight/2024/file.csv", "size": 10, "eTag": '"abc-1"'})),
            ("req-2", _event({"key": "other-prefix/file.csv"}, {"key": "freight/file.parquet"})),
            ("req-3", _event({"key": "freight/a+b%20c.csv"}, {"key": "freight/x.csv", "size": 5, "eTag": "e1"})),
            ("req-4", json.dumps({"Records": []})),
        ],
        "request_id string, body string",
    )
    out = {r["key"]: r for r in ev.file_arrivals(events).collect()}
    assert set(out) == {"freight/2024/file.csv", "freight/a b c.csv", "freight/x.csv"}
    assert out["freight/2024/file.csv"]["etag"] == "abc-1"
    assert out["freight/2024/file.csv"]["execution_name"] == "dev-abc1"
    assert out["freight/a b c.csv"]["etag"] == "req-3" and out["freight/a b c.csv"]["size_bytes"] == 0


def test_nothing_arrives_unseen(spark):
    events = spark.createDataFrame(
        [("r1", _event({"key": "freight/100%.csv"}, {"key": "freight/a.csv"}, {"key": "freight/b.csv"})), ("r2", "{not json"), ("r3", None),
         ("r4", _event({"key": "elsewhere/x.csv"})), ("r5", json.dumps({"Records": []}))],
        "request_id string, body string",
    )
    accepted = ev.file_arrivals(events).collect()
    assert {r["key"] for r in accepted} == {"freight/100%.csv", "freight/a.csv", "freight/b.csv"}
    assert len({r["execution_name"] for r in accepted}) == 3  # no ETag: still told apart
    rejected = {r["request_id"]: r["rejected"] for r in ev.rejected_records(events).collect()}
    assert rejected == {"r2": "unreadable event", "r3": "unreadable event", "r4": "other prefix"}
    assert {r["request_id"]: r["executions_started"] for r in ev.started_counts(events).collect()} == {"r1": 3, "r2": 0, "r3": 0, "r4": 0}


def test_fingerprints_tell_nulls_and_columns_apart(spark):
    rows = [("f1", "a", None), ("f2", None, "a"), ("f3", "a", "")]
    df = spark.createDataFrame(rows, "_source_path string, x string, y string")
    fps = ev.content_fingerprints(df, ["x", "y"])
    assert fps.select("content_hash", "content_check").distinct().count() == 3
    twins = spark.createDataFrame([("g1", "q", "w"), ("g2", "q", "w")], "_source_path string, x string, y string")
    assert [r["_source_path"] for r in ev.unseen_files(ev.content_fingerprints(twins, ["x", "y"]), None).collect()] == ["g1"]


def test_same_content_is_not_ingested_twice(spark):
    df = spark.createDataFrame([("f1", 1, "a"), ("f1", 2, "b"), ("f2", 3, "c")], "_source_path string, x int, y string")
    fps = ev.content_fingerprints(df, ["x", "y"])
    ledger = scratch_path(spark, "ledger")
    ev.record(ev.unseen_files(fps, None), ledger)
    again = spark.createDataFrame([("f9", 2, "b"), ("f9", 1, "a")], "_source_path string, x int, y string")
    assert ev.unseen_files(ev.content_fingerprints(again, ["x", "y"]), spark.read.parquet(ledger)).count() == 0


def test_counted_dynamic_overwrite_is_idempotent(spark):
    path = scratch_path(spark, "t")
    df = spark.range(100).select((F.col("id") % 5).alias("trip_date"), "id")
    assert sinks.overwrite_partitioned(df, path) == 100
    assert sinks.overwrite_partitioned(df.filter("trip_date = 1"), path) == 20
    assert spark.read.parquet(path).count() == 100


def test_conditional_write_skips_empty(spark):
    path = scratch_path(spark, "empty")
    assert sinks.write_if_rows(spark.range(0), path) == 0


def test_landing_csv_roundtrip_keeps_null_time_rows(spark):
    from tripmart.sources.landing import read_landing

    path = scratch_path(spark, "landing")
    df = spark.createDataFrame([("t1", "2024-01-05 10:00:00"), ("t2", None)], "trip_id string, departure_time string")
    assert sinks.write_landing_csv(df, path) == 2
    back = read_landing(spark, path, base_path=path)
    assert back.count() == 2 and {"year", "month"} <= set(back.columns)


def test_synth_distribution(spark):
    from tripmart.sources.synth import synthesize

    df = synthesize(spark.range(20000).withColumnRenamed("id", "k"), ["k"])
    stats = df.agg(
        F.avg((F.col("delay_minutes") > 0).cast("double")).alias("delayed"),
        F.avg((F.col("origin_station") == F.col("destination_station")).cast("double")).alias("same"),
        F.count_distinct("trip_id").alias("ids"),
    ).first()
    assert 0.2 < stats["delayed"] < 0.3 and stats["same"] == 0.0 and stats["ids"] == 20000
    again = synthesize(spark.range(20000).withColumnRenamed("id", "k").repartition(3), ["k"])
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))


def test_append_without_clustering_is_written_by_the_tasks_that_have_the_rows(spark):
    from tripmart.session import scratch_path

    path = scratch_path(spark, "append")
    df = spark.range(0, 400, 1, 4).selectExpr("id", "date'2024-01-01' as day")
    assert sinks.append_partitioned(df, path, "day", cluster=False) == 400
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 4


def test_files_for_broken_and_quoted_lines_grow_with_the_rows(spark, monkeypatch):
    from conftest import SF_SMALL
    from tripmart.plans import queries

    paths, real = [], queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    monkeypatch.setattr(queries, "CSV_ROWS", 150)
    assert queries.s1_corrupt(spark, SF_SMALL).first()["rows"] == queries.trips(spark, SF_SMALL).count()
    assert len(sinks.partition_values(spark, paths[0], "part")) > 30
    assert queries.s1_quoted_lines(spark, SF_SMALL).count() == queries.trips(spark, SF_SMALL).count()
    assert spark.read.format("binaryFile").load(f"{paths[1]}/*.csv").count() >= 4


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_finished_write_leaves_no_shuffle_files(spark):
    from tripmart.session import staged

    df, before = spark.range(1000).withColumn("day", F.col("id") % 7), _shuffle_files(spark)
    assert sinks.write_counted(df, scratch_path(spark, "freed"), partition_by=("day",)) == 1000
    staged(df.repartition(3), "freed")
    until = time.time() + 10  # block managers are told, not waited for
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_staged_tables_go_with_their_job(spark):
    from tripmart.session import staged, staging

    with staging(spark):
        inside = staged(spark.range(5), "inside").inputFiles()[0]
        assert sinks.exists(spark, inside)
    assert not sinks.exists(spark, inside) and staged(spark.range(5), "outside").count() == 5
