"""Operators 11 to 13 against brute force, exact round trips and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm import cases
from pyspark.sql import functions as F

from tripmart.llm import compress, infill, queries, resample
from tripmart.llm.common import SLICE_BYTES, read_table

ROWS = cases.corpus()
#: Rows that repeat an id and a text, a missing id, and a text longer than a slice.
EXTRA = [(7, "twice the same row here", "s")] * 3 + [(None, "no id at all", None), (None, None, None), (9001, "Wörd ab\tc " * (SLICE_BYTES // 10 + 1), "s")]
RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark, ROWS + EXTRA).persist()


@pytest.fixture(scope="module")
def none(spark):
    return cases.frame(spark, ROWS).limit(0)


def test_crc_of_any_span_from_prefixes():
    rng = random.Random(1)
    data = rng.randbytes(3 * resample.LANE + 17)
    spans = [sorted((rng.randint(0, len(data)), rng.randint(0, len(data)))) for _ in range(400)]
    spans += [(0, 0), (0, len(data)), (len(data), len(data)), (resample.LANE, 2 * resample.LANE), (resample.LANE - 1, resample.LANE + 1)]
    got = resample.PrefixCrc(np.frombuffer(data, np.uint8)).spans(*np.array(spans).T)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def features(text, longest):
    w = RUN.findall((text or "").translate(cases.LOW))
    return len(w), [zlib.crc32(" ".join(w[k : k + n]).encode()) % 1000 for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


@pytest.mark.parametrize("longest,share", [(1, 10), (3, 60)])
def test_resampling(spark, docs, longest, share):
    target = [t for _, t, _ in ROWS[::4]]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = resample.resample(docs, bench, longest=longest, buckets=1000, share_pct=share, min_words=5)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    s, t = Counter(), Counter()
    for _, text, _ in ROWS + EXTRA:
        s.update(features(text, longest)[1])
    for text in target:
        t.update(features(text, longest)[1])
    big_s, big_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 1000.0) / ((s[b] + 1.0) * (big_t + 1000.0)))) for b in range(1000)]
    want = []
    for i, text, _ in ROWS + EXTRA:
        n, found = features(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        want.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in want if r[1] >= 5), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    ranked = [(*r, k + 1 if k < share * len(able) // 100 else None) for k, r in enumerate(able)] + [(*r, None) for r in want if r[1] < 5]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(ranked, key=key)
    drawn = resample.drawn(docs, bench, longest=longest, buckets=1000, share_pct=share, min_words=5)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.select("doc_id").collect()} == {r[0] for r in rows if r[-1]}


def test_resampling_of_nothing(docs, none):
    assert resample.resample(none, docs).count() == 0
    rows = resample.resample(docs, none).collect()
    assert len(rows) == len(ROWS + EXTRA) and all(r["weight"] >= 0 or r["n_features"] for r in rows)
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, sum(r["n_words"] >= 20 for r in rows) // 10 + 1))


def test_equal_scores_go_to_the_smaller_id(spark):
    docs = cases.frame(spark, [(i, "word " * 20, "s") for i in range(200)] + [(3, "word " * 20, "s")] * 50)
    rows = sorted(resample.resample(docs, docs, share_pct=50).collect(), key=lambda r: (-r["score"], r["doc_id"]))
    assert [r["rank"] for r in rows] == [*range(1, 126), *[None] * 125]


def test_skip_lists_reach_every_rank():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abZ é日 \n") for _ in range(rng.choice([0, 1, 40, 3000]))) for _ in range(60)] + ["", None, "x"]
    points, offsets = infill.units(pa.array(texts))
    lists = infill.SkipLists(points, offsets)
    assert len(lists.lanes) >= 3
    for share in (0.0, 0.3, 0.77, 1.0):
        rank = (np.diff(offsets) * share).astype(np.int64)
        got = iter(lists.code_points(rank[lists.some]).tolist())
        for t, n, r in zip(texts, np.diff(offsets), rank):
            pieces = UNIT.findall(t or "")
            assert len(pieces) == n
            if n:
                assert next(got) == len("".join(pieces[:r]))


def infilled(i, text):
    t, digest = text or "", hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    u = UNIT.findall(t)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(u), "plain", None, None, t
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    return (i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark, docs, none):
    marks = [(10_000 + k, t, "s") for k, t in enumerate(["a<P>b", "<M>", "x <S", "P> <P <S<M tail", "<<<>>>" * 9] * 6)]
    made = infill.fill_in_middle(docs.unionByName(cases.frame(spark, marks)))
    got = made.select("*", infill.restored().alias("back")).collect()
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted((tuple(r)[:-1] for r in got), key=key) == sorted((infilled(i, t) for i, t, _ in ROWS + EXTRA + marks), key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t, _ in ROWS + EXTRA + marks)
    assert infill.fill_in_middle(none).count() == 0


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_fill_in_middle"])
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_classifier_on_held_out_labels(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = queries.op12_quality_classifier(spark, sf)
    labelled = rows.join(read_table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert len(labelled) > 50
    right = {q: [r["predicted"] == q for r in labelled if r["quality"] == q] for q in (0, 1)}
    assert np.mean(right[1]) > 0.95 and np.mean(right[0]) > 0.75
    # calibrated: the mean score is near the share of good rows
    assert abs(np.mean([r["score"] for r in labelled]) - np.mean([r["quality"] for r in labelled])) < 0.05
    assert rows.count() == read_table(spark, sf, "documents").count()
    assert rows.filter("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0


def labelled(spark, ids, classes=(0, 1)):
    return spark.createDataFrame([(i, classes[k % len(classes)], 0, "x") for k, i in enumerate(ids)], "doc_id long, quality int, toxic int, text string")


def test_classifier_learns_nothing_from_held_out_rows(spark):
    docs, labels = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")
    kept = labels.filter(~compress.held_out(F.col("doc_id")))
    flipped = kept.unionByName(labels.filter(compress.held_out(F.col("doc_id"))).withColumn("quality", 1 - F.col("quality"))).filter(~compress.held_out(F.col("doc_id")))
    assert compress.fit(docs, kept) == compress.fit(docs, flipped)
    held = {r["doc_id"] for r in docs.filter(compress.held_out(F.col("doc_id"))).collect()}
    assert held == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}


def test_classifier_on_awkward_rows(spark, docs, none):
    ids = [i for i, _, _ in ROWS]
    labels = labelled(spark, [*ids, *ids[:5], None, 123456])  # some both ways, one without a text
    model = compress.fit(docs, labels)
    rows = compress.score(docs, model).collect()
    assert len(rows) == len(ROWS + EXTRA) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in {i for i, t, _ in ROWS if not t}}
    assert len(empty) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 7 and r["difference"] == rows[[x["doc_id"] for x in rows].index(7)]["difference"]}) == 1
    assert compress.score(none, model).count() == 0
    for some in (labelled(spark, ids, (1,)), labels.limit(0)):  # one class, no class
        flat = compress.fit(docs, some)
        assert flat.slope == 0 and len({r["score"] for r in compress.score(docs, flat).collect()}) == 1
    assert compress.fit(none, labels).slope == 0


def test_a_long_text_is_measured_to_its_end(spark):
    model = compress.fit(read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels"))
    head = "plain words here " * 400
    texts = [(1, head, "s"), (2, head + "BUY!! NOW!! " * 4000, "s")]
    got = cases.by_id(compress.score(cases.frame(spark, texts), model))
    assert got[1]["difference"] != got[2]["difference"]
