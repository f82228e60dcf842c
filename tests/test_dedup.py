from pyspark.sql import functions as F

from tripmart.operators import dedup as dd
from tripmart.operators.dedup import dedup


def test_one_row_a_key_and_its_number_of_copies(spark):
    rows = [("x", "06:00", 1), ("x", "06:00", 2), ("x", "07:00", 3), ("y", None, 4), ("y", None, 5), ("y", None, 6)]
    df = spark.createDataFrame(rows, "trip_id string, departure_time string, v int")
    out = {(r["trip_id"], r["departure_time"]): (r["v"], r["n"]) for r in dedup(df, copies="n").collect()}
    assert out == {("x", "06:00"): (1, 2), ("x", "07:00"): (3, 1), ("y", None): (4, 3)}


def test_survivor_prefers_passing_then_newest(spark):
    schema = "trip_id string, departure_time string, _dq_passed boolean, _ingestion_timestamp string, v double"
    rows = [
        ("T1", "d", False, "2024-02-01T00:00:00+00:00", 1.0),
        ("T1", "d", True, "2024-01-01T00:00:00+00:00", 2.0),
        ("T1", "d", True, "2024-01-15T00:00:00+00:00", 3.0),
        ("T2", "d", True, None, 4.0),
        ("T2", "d", True, "2024-01-01T00:00:00+00:00", 5.0),
        (None, None, True, None, 7.0),
        (None, None, True, None, 6.0),
    ]
    out = {(r["trip_id"]): r["v"] for r in dedup(spark.createDataFrame(rows, schema)).collect()}
    assert out == {"T1": 3.0, "T2": 5.0, None: 6.0}


def test_dedup_is_deterministic_across_partitionings(spark):
    from conftest import SF_SMALL
    from tripmart.operators.refine import refine
    from tripmart.plans.pipeline import bronze_trips

    df = refine(bronze_trips(spark, SF_SMALL))
    a = sorted(map(tuple, dedup(df).collect()))
    b = sorted(map(tuple, dedup(df.repartition(7)).collect()))
    assert a == b and len(a) == 4599


def test_moved_rows_give_the_same_survivors_with_and_without_hot_keys(spark):
    rows = [(f"t{i % 40}" if i % 3 else None, f"2024-01-0{i % 5 + 1}" if i % 7 else None, i % 4, None if i % 6 == 0 else f"2024-02-0{i % 9 + 1}") for i in range(600)]
    df = spark.createDataFrame(rows, "trip_id string, departure_time string, v int, _ingestion_timestamp string")
    want = sorted(map(repr, dd.dedup(df, copies="n").collect()))
    everything = list(range(dd.HOT_BUCKETS))
    some = [r[0] for r in df.select(dd._bucket(dd.NATURAL_KEY)).distinct().limit(9).collect()]
    for hot in ([], some, everything):
        assert sorted(map(repr, dd.dedup_moved(df, hot, copies="n").collect())) == want
    # rows are moved as they are: the aggregate comes after the only exchange
    lines = dd.dedup_moved(df, [])._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and not any("Aggregate" in line for line in lines[shuffles[0] :])


def test_hot_buckets_are_found(spark, monkeypatch):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as trip_id", "1 as departure_time")
    assert dd.hot_buckets(df) == []
    monkeypatch.setattr(dd, "HOT_ROWS", 100)
    assert dd.hot_buckets(df) == [df.filter("trip_id = 'hot'").select(dd._bucket(dd.NATURAL_KEY)).first()[0]]


def test_rows_moved_by_a_unit_of_the_key_give_the_same_survivors(spark, monkeypatch):
    rows = [(f"t{i % 40}" if i % 3 else None, f"2024-01-0{i % 5 + 1}" if i % 7 else None, i % 4, None if i % 6 == 0 else f"2024-02-0{i % 9 + 1}") for i in range(600)]
    df = spark.createDataFrame(rows, "trip_id string, departure_time string, v int, _ingestion_timestamp string")
    want = sorted(map(repr, dd.dedup(df, copies="n").collect()))
    day = F.to_date("departure_time")
    counted = dd.bucket_rows(df, day=day)
    assert sum(counted["keys"].values()) == sum(counted["day"].values()) == 600 and len(counted["day"]) == 6
    hot = [r[0] for r in df.select(dd._bucket(dd.NATURAL_KEY)).distinct().limit(5).collect()]
    for task_rows, most in ((dd.TASK_ROWS, 1), (160, 6)):  # days in one piece, and in several
        monkeypatch.setattr(dd, "TASK_ROWS", task_rows)
        part = dd.part_of(day, counted["day"])
        pieces = df.groupBy("departure_time").agg(F.count_distinct(part).alias("n")).agg(F.max("n")).first()[0]
        assert (pieces == 1) if most == 1 else (1 < pieces <= most)
        for some in ([], hot):
            assert sorted(map(repr, dd.dedup_moved(df, some, part=part, rows=600, copies="n").collect())) == want
    lines = dd.dedup_moved(df, [], part=part, rows=600)._jdf.queryExecution().executedPlan().toString()
    assert lines.count("Exchange hashpartitioning") == 1


def test_texts_come_back_from_the_one_column_they_are_moved_in(spark):
    odd = ["", None, " a ", 'say "x", [y]', "\\", "null", "a\nb\r\tc", "\x00\x01 ", "ação 列車 \U0001f682", "x" * (dd.TEXT_BYTES + 1)]
    rows = [(i, a, b) for i, a in enumerate(odd) for b in odd[:9]]
    df = spark.createDataFrame(rows, "k int, trip_id string, note string").withColumn("bytes", F.expr("if(k < 3, cast(x'c3ff41' as string), trip_id)"))
    one = dd.texts_in_one(df.withColumn("part", F.lit(1)))
    assert dict(one.dtypes) == {"k": "int", "part": "int", dd._TEXT: "string", dd._PLAIN: "array<string>"}
    back = dd.texts_apart(one, df)
    assert back.columns == [*df.columns, "part"] and [t for _, t in back.dtypes] == [*[t for _, t in df.dtypes], "int"]
    exact = lambda d: sorted(map(repr, d.select("k", *[F.hex(c) for c in ("trip_id", "note", "bytes")]).collect()))
    assert exact(back) == exact(df)
    numbers = df.select("k")
    assert dd.texts_apart(dd.texts_in_one(numbers), numbers).columns == ["k"]


def test_rows_moved_by_a_unit_have_their_texts_in_one_column(spark):
    rows = [(f"t{i % 40}", "2024-01-01", f"v{i % 9}", 'a "b"' if i % 2 else None, "2024-02-01") for i in range(200)]
    df = spark.createDataFrame(rows, "trip_id string, departure_time string, v string, w string, _ingestion_timestamp string")
    got = dd.dedup_moved(df, [], part=F.xxhash64("departure_time"), rows=200)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, dd.dedup(df).collect()))
    lines = got._jdf.queryExecution().executedPlan().toString().split("\n")
    sent = next(lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert f"AS {dd._TEXT}" in sent and " AS v" not in sent and sent.count(", ") > 0
