import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import sinks
from tripmart.plans import jobs
from tripmart.session import scratch_path
from tripmart.sources import events, infer
from tripmart.sources.landing import read_landing
from tripmart.sources.quoted import Lines, begin_states, range_functions, read_quoted


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


# ── ledger in two levels ─────────────────────────────────────────────────────

HEAD = "trip_id,cargo_type\n"


def landing_of(spark):
    root = scratch_path(spark, "landing")
    write(f"{root}/in/year=2024/month=1/a.csv", HEAD + "t1,GRAIN\nt2,FUEL\n")
    write(f"{root}/in/year=2024/month=2/b.csv", HEAD + "t3,SUGAR\n")
    return root


def ingest(spark, root):
    got = jobs.ingest(spark, f"{root}/in", f"{root}/bronze", ledger=f"{root}/ledger")
    return got["files_read"], got["rows"]


def test_known_files_are_not_opened(spark):
    root = landing_of(spark)
    assert ingest(spark, root) == (2, 3)
    assert ingest(spark, root) == (0, 0)
    # the same length and time with other content: if it were opened, it would be new
    path = f"{root}/in/year=2024/month=1/a.csv"
    at = os.stat(path)
    write(path, HEAD + "x1,GRAIN\nx2,FUEL\n")
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    assert ingest(spark, root) == (0, 0)
    write(f"{root}/in/year=2024/month=3/again.csv", HEAD + "t2,FUEL\nt1,GRAIN\n")  # known content under another name
    write(f"{root}/in/year=2024/month=3/new.csv", HEAD + "t9,FUEL\n")
    write(f"{root}/in/year=2024/month=3/twin.csv", HEAD + "t9,FUEL\n")
    write(f"{root}/in/year=2024/month=3/none.csv", HEAD)
    assert ingest(spark, root) == (4, 1)
    assert ingest(spark, root) == (0, 0)
    os.utime(f"{root}/in/year=2024/month=3/new.csv", (1, 1))  # touched: opened, but not new
    assert ingest(spark, root) == (1, 0)
    assert spark.read.parquet(f"{root}/bronze").count() == 4


def test_only_new_files_are_scanned(spark):
    root = landing_of(spark)
    raw = read_landing(spark, f"{root}/in", base_path=f"{root}/in")
    first = [r[0] for r in events.file_identities(spark, f"{root}/in").select("_source_path").collect()][:1]
    some = raw.filter(F.col("_metadata.file_path").isin(first))
    assert some.collect()
    plan = some._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    assert leaf.metrics().apply("numFiles").value() == 1


def test_a_ledger_without_identities_is_read(spark):
    root = landing_of(spark)
    raw = read_landing(spark, f"{root}/in", base_path=f"{root}/in", keep_corrupt=True).withColumn("_source_path", F.col("_metadata.file_path"))
    data = [c for c in raw.columns if c not in ("year", "month", "_source_path")]
    events.record(events.content_fingerprints(raw, data), f"{root}/ledger")
    assert ingest(spark, root) == (2, 0)


# ── quoted line breaks ───────────────────────────────────────────────────────

HOSTILE = [
    'a,b,c\n1,"x\ny",3\n2,"p ""q"" r",4\n',
    'a,b,c\r\n1,"two\r\nlines",3\r\n\r\n2,,\r\n',
    'a,b,c\n1,st"ray,3\n2,5" pipe,"\n\n"\n3,"",""""\n',
    'a,b,c\n"only\n\n\nquoted","a,b","c\n,\n"\n1,2,3',
    "a,b,c\n",
    'a,b,c\n1,2,"open to the end\nof the file',
    'a,b,c\n"1" ,2,3\n\n4,"5",6\n',
]


def long_file(seed):
    """Records that end in \\r\\n throughout, or in a mix where the first ends in \\n."""
    rng = random.Random(seed)
    field = lambda: rng.choice(["", "plain", "ünï", '"q ""in"" q"', '"' + "line\n" * rng.randint(1, 60) + '"', '"a,b"', "12\" wide", '"\n"', '"\r\n"'])
    ends = ["\r\n"] if seed % 2 else ["\n", "\n", "\r\n"]
    return "a,b,c" + ends[0] + "".join(",".join(field() for _ in range(3)) + rng.choice(ends) for _ in range(300))


def rows(df):
    return sorted(map(repr, df.select("n", "a", "b", "c").collect()))


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_quoted_line_breaks_equal_the_whole_file_reader(spark, small_ranges):
    path = scratch_path(spark, "quoted")
    for i, text in enumerate([*HOSTILE, *[long_file(s) for s in range(4)]]):
        write(f"{path}/n={i}/f.csv", text)
    want = spark.read.options(header=True, multiLine=True, escape='"', basePath=path).csv(path)
    assert rows(read_quoted(spark, path, base_path=path)) == rows(want)


def test_a_large_file_is_read_by_many_tasks(spark, small_ranges):
    path = scratch_path(spark, "quoted")
    write(f"{path}/year=2024/month=5/f.csv", long_file(9))
    write(f"{path}/year=2024/month=6/g.csv", long_file(10))
    got = read_quoted(spark, path, base_path=path)
    want = spark.read.options(header=True, multiLine=True, escape='"', basePath=path).csv(path)
    columns = ["a", "b", "c", "year", "month"]
    assert sorted(map(repr, got.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))
    assert want.rdd.getNumPartitions() <= 2 and got.rdd.getNumPartitions() > 20
    assert got.select("_source_path").distinct().count() == 2


def test_states_compose_over_ranges(spark):
    rng = random.Random(4)
    functions = [(f, i * 10, *rng.choice([(False, True), (True, False), (False, False), (True, True)])) for f in "xy" for i in range(60)]
    table = spark.createDataFrame(functions, "_file string, _start long, from_out boolean, from_in boolean")
    got = {(r["_file"], r["_start"]): r["begins_inside"] for r in begin_states(table).collect()}
    state = {}
    for f, start, out, inn in functions:
        now = state.get(f, False)
        assert got[f, start] == now
        state[f] = inn if now else out
    assert range_functions(spark.createDataFrame([], "_file string, _start long, value string")).count() == 0


def test_line_rules():
    rule = Lines()
    assert [rule.leads_inside(x, False) for x in ('a,"b', '"a""', 'a"b,c"', '"a","b"', '"a"x,"', "")] == [True, True, False, False, True, False]
    assert [rule.leads_inside(x, True) for x in ('end",b', 'no quote', 'x"",y', 'x","', '"')] == [False, True, True, True, False]


def test_ingest_with_quoted_line_breaks(spark, small_ranges):
    root = scratch_path(spark, "multi")
    write(f"{root}/in/year=2024/month=1/a.csv", 'trip_id,cargo_type\nt1,"GR\nAIN"\n' + "".join(f't{i},"a\n{"b" * 200}"\n' for i in range(2, 30)))
    got = jobs.ingest(spark, f"{root}/in", f"{root}/bronze", ledger=f"{root}/ledger", multi_line=True)
    assert (got["files_read"], got["rows"]) == (1, 29)
    df = spark.read.parquet(f"{root}/bronze")
    assert df.filter("trip_id = 't1'").first()["cargo_type"] == "GR\nAIN" and df.select("_source_path").first()[0].endswith("a.csv")


# ── types in one pass ────────────────────────────────────────────────────────

COLUMNS = {
    "i": ["1", "-2", "+3", ""], "l": ["1", "3000000000", "", "-7"], "d": ["1", "2.5", "1e3", "-.5"], "big": ["1", "123456789012345678901", "", "2"],
    "t": ["2024-01-05 10:00:00", "2024-01-05T11:30:00", "", "2024-02-01 00:00:00"], "day": ["2024-01-05", "2024-02-29", "", "1999-12-31"],
    "b": ["true", "FALSE", "", "true"], "s": ["a", "1", "", "b"], "n": ["", "", "", ""], "mixed": ["1", "true", "2", "3"], "x": ["1", "NaN", "2", "-Inf"],
    "notime": ["2024-01-05", "2024-01-05 10:00:00", "", "2024-01-06"], "late": ["1", "2", "3", "x"], "bad": ["2024-13-45", "2024-01-01", "", ""],
}


def test_inferred_types_equal_sparks(spark):
    path = scratch_path(spark, "types")
    names = list(COLUMNS)
    for k in range(2):
        lines = [",".join(names)] + [",".join(COLUMNS[c][i] for c in names) for i in (2 * k, 2 * k + 1)]
        write(f"{path}/{k}.csv", "\n".join(lines) + "\n")
    want = {f.name: f.dataType for f in spark.read.options(header=True, inferSchema=True).csv(path).schema.fields}
    got = infer.infer_types(spark.read.options(header=True).csv(path))
    assert got == want
    assert infer.typed(spark.read.options(header=True).csv(path), got).filter("l = 3000000000 and d = 2.5").count() == 1
    assert infer.infer_types(spark.read.options(header=True).csv(path).limit(0)) == {c: T.StringType() for c in names}


def test_inferred_types_of_landing_files(spark):
    from conftest import SF_SMALL
    from tripmart.sources.tables import trips

    path = scratch_path(spark, "landing")
    sinks.write_landing_csv(trips(spark, SF_SMALL), path)
    want = {f.name: f.dataType for f in spark.read.options(header=True, inferSchema=True, escape='"', basePath=path).csv(path).schema.fields}
    got = infer.infer_types(read_landing(spark, path, base_path=path).drop("year", "month"))
    assert got == {c: t for c, t in want.items() if c not in ("year", "month")}


def test_landing_rows_are_moved_as_they_are_typed(spark):
    from conftest import SF_SMALL
    from tripmart.sources.tables import trips

    path, df = scratch_path(spark, "landing"), trips(spark, SF_SMALL)
    plans = []
    real = sinks.write_counted
    sinks.write_counted = lambda out, *args, **kwargs: plans.append(out._jdf.queryExecution().optimizedPlan().toString()) or real(out, *args, **kwargs)
    try:
        assert sinks.write_landing_csv(df, path, compression="gzip") == df.count()
    finally:
        sinks.write_counted = real
    # the cast to text is above the move, and the move holds one text column
    assert plans[0].index("as string") < plans[0].index("RebalancePartitions") and "_moved_text" in plans[0]
    back = read_landing(spark, path, base_path=path).drop("year", "month")
    same = df.select(*[F.col(c).cast("string") for c in back.columns])
    assert back.exceptAll(same).isEmpty() and same.exceptAll(back).isEmpty()


def test_compressed_files_are_ingested_once_and_nothing_staged_stays(spark):
    import glob
    import gzip

    root = landing_of(spark)
    os.makedirs(f"{root}/in/year=2024/month=3")
    with gzip.open(f"{root}/in/year=2024/month=3/c.csv.gz", "wt") as f:
        f.write(HEAD + "t4,SALT\n")
    before = set(glob.glob(f"{root.rsplit('/', 1)[0]}/new-rows-*"))
    assert ingest(spark, root) == (3, 4)
    assert ingest(spark, root) == (0, 0)
    assert set(glob.glob(f"{root.rsplit('/', 1)[0]}/new-rows-*")) == before


def test_streamed_rows_of_one_date_are_not_moved(spark, monkeypatch):
    from tripmart.streaming import incremental as st

    root = landing_of(spark)
    monkeypatch.setattr(sinks, "layout", None)
    schema = read_landing(spark, f"{root}/in", base_path=f"{root}/in").schema
    assert st.stream_ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", schema) == 3
    assert st.stream_ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", schema) == 0
