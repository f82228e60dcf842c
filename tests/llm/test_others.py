"""Vectors, archives, the trie, shared helpers and the pipeline."""

import numpy as np
import pytest
from llm import cases
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import common, elias_fano, mixing, vectors, warc


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(500 + i, 501 + i) for i in range(60)] + [(700, 800 + i) for i in range(80)]
    df = spark.createDataFrame(edges, "a long, b long")
    root = cases.unions(edges)
    got = {r["node"]: r["root"] for r in common.components(df).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert common.components(df.limit(0)).count() == 0


def test_salted_rank(spark):
    rows = [(k % 3 if k % 7 else None, k, k % 5) for k in range(200)]
    df = spark.createDataFrame(rows, "g int, v long, w long").withColumn("s", F.pmod("v", F.lit(4)))
    got = common.salted_rank(df, ["g"], "s", ["v"], "rank").collect()
    sums = {r["v"]: r["rank"] for r in common.salted_rank(df, ["g"], "s", ["v"], "rank", weight="w").collect()}
    for g in (0, 1, 2, None):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        assert [(r["s"], r["v"]) for r in mine] == sorted((r["s"], r["v"]) for r in mine)
        assert [sums[r["v"]] for r in mine] == np.cumsum([0] + [r["w"] for r in mine])[:-1].tolist()


def test_bitmap_has_no_false_negatives(spark):
    df = spark.range(0, 5000, 7)
    bitmap = common.Bitmap.of(df, "id", 16)
    inside = df.select(common.Bitmap.slot("id", 16)).toPandas()["_slot"].to_numpy()
    outside = spark.range(10_000, 15_000).select(common.Bitmap.slot("id", 16)).toPandas()["_slot"].to_numpy()
    assert bitmap.has_slots(inside).all() and bitmap.has_slots(outside).mean() < 0.03


def vector_rows():
    rng = np.random.default_rng(2)
    out, centre = [], rng.standard_normal((6, 24))
    for i in range(180):
        v = centre[i % 6] + rng.standard_normal(24) * [0.05, 0.2, 0.35, 0.5, 1.0, 2.0][i // 30]
        out.append((i, [float(np.float32(x)) for x in v]))
    out += [(200 + i, out[3][1]) for i in range(4)] + [(300, [2 * x for x in out[5][1]]), (2, out[10][1])]
    out += [(400, None), (401, []), (402, [0.0] * 24), (403, [float("nan")] + [1.0] * 23), (404, [None] + [1.0] * 23), (405, [float("inf")] * 24), (406, [1.0] * 5), (407, [3.0] * 5)]
    return out


@pytest.mark.parametrize("kind, part_rows", [("float", 4096), ("double", 16)])
def test_near_vectors(spark, kind, part_rows):
    rows = [r for r in vector_rows() if r != (2, vector_rows()[10][1])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("label", F.lit(1)).withColumn("id", F.lit(0)).repartition(3)
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    links, n = [], dict.fromkeys((i for i, _ in rows), 0)
    for k, (i, v) in enumerate(good):
        for j, u in good[:k]:
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    root = cases.unions(links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df, part_rows=part_rows).collect()}
    assert got == {i: (n[i], root(i), root(i) == i) for i, _ in rows}
    assert len(links) > 300


def test_near_vectors_without_ids_and_without_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in vectors.near_vectors(df).collect())
    assert rows == [(-1, 0, None), (-1, 0, None), (3, 1, 3), (3, 1, 3)]
    assert vectors.near_vectors(df.limit(0)).count() == 0


def pages(spark, n=300):
    rows = [(i * 2, f"https://x.test/{i}", f"<p>{'é' * (i % 9)}{i}</p>") for i in range(n)] + [(8, None, None), (8, None, None), (None, "u", ""), (8, "other", "text")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("x")).withColumn("hash", F.lit(1)).repartition(4)


def test_audit_finds_the_changed_records_and_no_others(spark):
    source = pages(spark)
    archived = common.stage(warc.archive(source, per_file=50), "warc")
    rows = sorted(archived.collect(), key=lambda r: (r["file"], r["seq"]))
    assert len(rows) == source.count()
    end, file = 0, 0
    for r in rows:  # offsets are those of the records one after another
        end = end if r["file"] == file else 0
        file = r["file"]
        assert (r["offset"], r["length"]) == (end, len(r["record"]))
        end += r["length"]
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.0\r\n") and int(head.rsplit(b": ", 1)[1]) == len(body) - 4
    mine = warc.tree(archived, 50, 4)
    assert len(mine) == 4 and mine[-1].count() == len({r["file"] for r in rows})
    assert warc.audit(mine, warc.tree(archived, 50, 4), 4).count() == 0
    hit = (F.col("file") == 1) & F.col("seq").isin(0, 17) | (F.col("file") == 5) & (F.col("seq") == 49)
    other = archived.withColumn("record", F.when(hit, F.lit(b"changed")).otherwise(F.col("record"))).filter(~((F.col("file") == 3) & (F.col("seq") == 4)))
    found = {(r["file"], r["node"], r["other_hash"] is None) for r in warc.audit(mine, warc.tree(other, 50, 4), 4).collect()}
    assert found == {(1, 0, False), (1, 17, False), (5, 49, False), (3, 4, True)}


def test_fixity_marks_exactly_the_decayed_pages(spark):
    out = warc.fixity(pages(spark), per_file=64)
    rot = F.substring(F.md5(F.concat(F.lit("rot"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))), 1, 2).isin("00", "01", "02", "03")
    assert out.filter(F.col("corrupt") != rot).count() == 0 and out.count() == 304 and out.filter("corrupt").count() > 0
    assert warc.fixity(pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (1000, 1000), (1000, 10**9), (3000, 70)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
    made = elias_fano.EliasFano.encode(values, universe)
    buffer = np.frombuffer(b"\0" * 8 + made.to_bytes(), np.uint8)
    read, end = elias_fano.EliasFano.read(buffer, 8)
    assert end == len(buffer)
    assert (read.get(np.arange(n)) == values).all()
    asked = rng.integers(0, universe, 500)
    assert (read.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie_from_memory_and_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(4)
    grams = {(int(a), int(b)): float(rng.integers(0, 200)) / 32 for a, b in rng.integers(0, 300, (4000, 2))}
    order = sorted(grams)
    trie = elias_fano.NgramTrie.build(np.array([a for a, _ in order]), np.array([b for _, b in order]), np.array([grams[g] for g in order]), 300)
    data = trie.to_bytes()
    (tmp_path / "trie").write_bytes(data)
    asked = rng.integers(0, 300, (3000, 2))
    expected = np.array([grams.get((int(a), int(b)), 0.0) for a, b in asked])
    for t in (elias_fano.NgramTrie.read(np.frombuffer(data, np.uint8)), elias_fano.NgramTrie.open(str(tmp_path / "trie"))):
        assert np.allclose(t.lookup(asked[:, 0], asked[:, 1]), expected)
    assert len(data) < 5 * len(grams) + 2000


def test_pipeline(spark, tmp_path):
    rows = cases.corpus()
    cases.frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    docs, after = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        docs = common.stage(function(spark, docs, str(tmp_path)), name)
        after.append(docs)
        assert i == 4 or docs.columns == columns
    good = [r for r in rows if (lambda q: q[0] >= 50 and 100 * q[4] <= 50 * q[0])(cases.quality(r[1]))]
    kept = {r["doc_id"] for r in after[0].collect()}
    assert kept <= {r[0] for r in good} and len(kept) > 10
    roots = cases.near_duplicates([r for r in rows if r[0] in kept])
    assert {r["doc_id"] for r in after[1].collect()} == {i for i, (_, root) in roots.items() if i == root}
    for r in after[2].collect():
        assert not cases.secrets(r["text"]) and r["n_chars"] == len(r["text"])
    assert sorted(r["doc_id"] for r in after[3].collect()) == sorted(r["doc_id"] for r in after[2].collect())
    last = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in after[4].collect()}
    whole = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert last == whole and {i for i, _ in last} == {r["doc_id"] for r in after[3].collect()}


def test_source_weights_decide_on_the_sequences(spark, tmp_path, monkeypatch):
    sources = ["a"] * 300 + ["b"] * 300
    words = cases.prose(cases.random.Random(8), 1200).split()
    rows = [(i, " ".join(words[i : i + 400]), s) for i, s in enumerate(sources)]
    docs = cases.frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    outcome, packing_of = {}, dict(corpus_pipeline.STAGES)["best_fit_packing"]
    for first, second in ((9, 1), (1, 9)):
        weights = spark.createDataFrame([("a", first), ("b", second)], "source string, weight int")
        mix = lambda spark, docs, sf_dir, w=weights: mixing.in_mixed_order(docs, mixing.mix(docs, w, block_docs=2))
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("mix_sources", mix), ("best_fit_packing", packing_of)])
        out = corpus_pipeline.run(spark, str(tmp_path)).collect()
        outcome[first] = {(r["doc_id"], r["piece"]): (r["sequence_id"], r["offset"]) for r in out}
        assert {i for i, _ in outcome[first]} == set(range(600))
        ids = {x for x, _ in outcome[first].values()}
        assert ids == set(range(len(ids))) and "_place" not in out[0].asDict()
        early = [sources[i] for (i, _), (x, _) in outcome[first].items() if x < len(ids) // 4]
        assert (early.count("a") > 2 * early.count("b")) == (first == 9) and (early.count("b") > 2 * early.count("a")) == (first == 1)
        # rows of all files in their order, each place once
        mixed = common.stage(mix(spark, docs, None), "mixed")
        places = [r[0] for r in mixed.select(mixing.file_place().alias("p")).collect()]
        assert len(set(places)) == 600
    assert outcome[9] != outcome[1]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    cases.frame(spark, cases.corpus()).limit(0).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
