"""Near-duplicate documents by one-permutation MinHash.

1. Every document's set of word shingles is hashed once; one permutation fills
   ``bands * rows`` bins with the least value each, and empty bins borrow by
   optimal densification (each probes its own sequence of bins until it finds
   one that is filled).  Bands of ``rows`` bins are the buckets.
2. Equal sets collapse to one representative, so copies meet no bucket at all.
3. Candidate edges are stars: every member of a bucket with the one that meets
   most others in all its buckets, a number linear in the bucket.  All are
   verified on full sets.
4. A star can miss a link between two members that both differ from the centre.
   So buckets whose members are still in different components get further
   stars, around members outside the largest one's component (sixteen times as
   many each round), until every such member has been a centre.  Nothing is capped.
   A pair is compared in the first bucket that it shares, and passed over where
   wide sketches (2048 bits, of the members of such buckets only, from their full
   sets) differ too much for the similarity asked for.

With 44 bands of 5 rows a pair at similarity 0.75 shares no bucket with
probability (1 - 0.75^5)^44 = 7e-6; its wide sketches differ in 256 bits on average,
with a deviation of 15, and it is passed over beyond 342 (1e-8).  Pairs below 0.67
differ in more, as a rule.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import (
    LOWER, SMALL_SLICE, Bitmap, Roller, U, components, mix, row_bounds, slices, stage, text_bytes, word_hashes, word_spans,
)

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 75, 44, 5
_PROBES = 64
_FILTER_BITS = 24
#: Bits of a wide sketch: one of the least value in each bin of each permutation.
_ROUNDS, _WIDE_BINS = 128, 16
#: Below so many shingles the bins of a sketch repeat each other: no pair is passed over.
_SKETCH_LEAST = 60


@lru_cache(maxsize=8)
def roller(seed: int) -> Roller:
    return Roller(seed)


@lru_cache(maxsize=4)
def probes(bins: int) -> np.ndarray:
    """For every bin, the sequence of bins it borrows from; at last all the others in turn."""
    rng = np.random.Generator(np.random.PCG64(7))
    some = rng.integers(0, bins, (bins, _PROBES))
    rest = (np.arange(bins)[:, None] + np.arange(1, bins + 1)) % bins
    return np.hstack([some, rest])


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    data, offsets = text_bytes(texts)
    starts, ends, row = word_spans(LOWER[data], offsets)
    hashes = word_hashes(LOWER[data], starts, ends, roller(11))
    sums = roller(12).prefix(hashes)
    windows = roller(12).windows(sums, shingle)
    bounds = row_bounds(row, len(texts))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(windows[a : b - shingle + 1]))
        else:
            out.append(roller(12).spans(sums, np.array([a]), np.array([b])) if b > a else np.zeros(0, U))
    return out


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One-permutation sketches with optimal densification: (sets, bands) bucket keys."""
    bins, n = bands * rows, len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    value = mix((np.concatenate(sets) if n else np.zeros(0, U)) ^ U(0x5851F42D4C957F2D))
    slot = ((value >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    empty = U(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(n * bins, empty)
    np.minimum.at(sketch, owner * bins + slot, value)
    sketch = sketch.reshape(n, bins)
    filled, source = sketch != empty, probes(bins)
    todo = np.argwhere(~filled & (sizes > 0)[:, None])
    for k in range(source.shape[1]):
        if not len(todo):
            break
        donor = source[todo[:, 1], k]
        has = filled[todo[:, 0], donor]
        done = todo[has]
        sketch[done[:, 0], done[:, 1]] = mix(sketch[done[:, 0], donor[has]] + U(k + 1))
        todo = todo[~has]
    grouped = sketch.reshape(n, bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1).astype(U)), (n, bands)).copy()
    for r in range(rows):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + grouped[:, :, r])
    return keys


def wide_sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit of the least value in each of 16 bins, for 128 permutations: 32 numbers.
    An empty bin borrows from the same bin of the next permutations."""
    least = np.full((_ROUNDS, _WIDE_BINS), U(0xFFFFFFFFFFFFFFFF))
    seeds = mix(np.arange(1, _ROUNDS + 1).astype(U) * U(0x9E3779B97F4A7C15))
    for part in np.array_split(shingles, -(-len(shingles) // 8192)):  # bounded memory for long texts
        value = mix(part[None, :] ^ seeds[:, None])
        at = (value >> U(60)).astype(np.int64) + _WIDE_BINS * np.arange(_ROUNDS)[:, None]
        np.minimum.at(least.reshape(-1), at.ravel(), value.ravel())
    own, missing = least, least == U(0xFFFFFFFFFFFFFFFF)
    for k in range(1, _ROUNDS):
        if not missing.any():
            break
        donor = np.roll(own, -k, axis=0)
        filled = missing & (donor != U(0xFFFFFFFFFFFFFFFF))
        least = np.where(filled, mix(donor + U(k)), least)
        missing &= ~filled
    return np.packbits(((least >> U(17)) & U(1)).astype(bool).ravel(), bitorder="little").view(U)


def wide_sketches(sets: DataFrame) -> DataFrame:
    """(doc, bits) of (doc, shingles), a set at a time."""

    def run(batches):
        for batch in batches:
            bits = [wide_sketch(s.values.to_numpy().view(U)).view(np.int64) for s in batch.column("shingles")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(list(bits), pa.list_(pa.int64()))], names=["doc", "bits"])

    return sets.select("doc", "shingles").mapInArrow(run, "doc long, bits array<long>")


def sketch_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands): k1 and k2 name the whole set."""

    def run(batches):
        for batch in slices(batches, limit=SMALL_SLICE):
            sets = shingle_sets(batch.column("text"), shingle)
            keys = signatures(sets, bands, rows)
            sizes = np.array([len(s) for s in sets], np.int64)
            k1 = np.array([int(mix(s).sum(dtype=U)) for s in sets], U).view(np.int64)
            k2 = np.array([int(mix(s ^ U(0xD1B54A32D192ED03)).sum(dtype=U)) for s in sets], U).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(k1), pa.array(k2), lists], names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc, shingles): the sets of the documents in ``wanted(doc)``.

    A bitmap of fixed size picks the texts inside the scan, so texts are never
    shuffled; the exact join on the few sets follows."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(Bitmap.of(wanted, "doc", _FILTER_BITS))

    def run(batches):
        for batch in slices(batches, limit=SMALL_SLICE):
            keep = np.flatnonzero(bitmap.value.has_slots(batch.column("_slot").to_numpy()))
            if len(keep):
                sets = shingle_sets(batch.column("text").take(pa.array(keep)), shingle)
                bounds = np.cumsum([0, *map(len, sets)])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep)), lists], names=["doc", "shingles"])

    rows = docs.filter("doc_id is not null").select("doc_id", "text", Bitmap.slot("doc_id", _FILTER_BITS)).mapInArrow(run, "doc long, shingles array<long>")
    return stage(rows.join(wanted.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"]), "sets")


def verified(edges: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The edges (a, b) whose sets are similar enough, on full sets.  Sets are
    compared where the join puts them: a row at a time, whatever their length."""
    first = edges.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa")), "a")
    both = first.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb")), "b")
    counted = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return counted.filter(100 * F.col("common") >= similarity * (F.col("total") - F.col("common"))).select("a", "b")


def _too_different(similarity: int):
    """Condition on (bits, hub_bits): more differing bits than a similar pair has,
    by over five and a half deviations."""
    bins = _ROUNDS * _WIDE_BINS
    differ = sum((F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("hub_bits", F.lit(k)))) for k in range(bins // 64)), F.lit(0))
    share = (1 - similarity / 100) / 2
    most = bins * share + 5.75 * (bins * share * (1 - share)) ** 0.5
    return (F.least("n", "hub_n") >= _SKETCH_LEAST) & (differ > int(most))


def bucket_links(members: DataFrame, classes: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Verified links (a, b) that give every bucket's links the same components.

    ``members``: (key, doc, n, c) of buckets with c >= 2 documents, staged;
    ``classes``: (doc, bands), staged; ``sets``: (doc, shingles), staged."""

    def pairs(hubs: DataFrame, others: DataFrame) -> DataFrame:
        may = (F.col("hub") != F.col("doc")) & (100 * F.least("n", "hub_n") >= similarity * F.greatest("n", "hub_n"))
        if "bits" in others.columns:
            first_shared = F.element_at(F.array_intersect("hub_bands", "bands"), 1) == F.col("key")
            may = may & (F.col("comp") != F.col("hub_comp")) & ~_too_different(similarity) & first_shared
        met = hubs.join(others.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & may)
        return met.select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()

    weight = members.groupBy("doc").agg(F.sum("c").alias("w")).withColumnRenamed("doc", "_d")
    weighed = members.join(weight, F.col("doc") == F.col("_d"))
    first = weighed.groupBy("key").agg(F.max(F.struct("w", (-F.col("doc")).alias("_neg"), "doc", "n")).alias("h"))
    first = stage(first.select("key", F.col("h.doc").alias("hub"), F.col("h.n").alias("hub_n")), "centres")
    tested = stage(pairs(first, members), "star")
    links = stage(verified(tested, sets, similarity), "links")
    several = members.filter("c > 2").select("key", "doc", "n")  # a bucket of two is one pair, tested
    used, centres, more, open_, wide = first.select("key", "hub"), 4, links, None, None
    while True:
        if open_ is None or not more.isEmpty():
            torn = _open_buckets(several, components(links))
            if wide is None:  # buckets only close: these are all that will be asked for
                some = torn.select("doc").distinct()
                wide = stage(wide_sketches(sets.join(some, "doc", "left_semi")).join(classes.select("doc", "bands"), "doc"), "wide")
            open_ = stage(torn.join(wide, "doc"), "open")
        strays = open_.filter("comp <> home").select("key", F.col("doc").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"), F.col("bits").alias("hub_bits"), F.col("bands").alias("hub_bands"))
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("hub"), "hub"))
        hubs = stage(strays.join(used, ["key", "hub"], "left_anti").withColumn("_r", rank).filter(F.col("_r") <= centres).drop("_r"), "centres")
        if hubs.isEmpty():
            return links
        new = stage(pairs(hubs, open_).join(tested, ["a", "b"], "left_anti"), "star")
        more = stage(verified(new, sets, similarity), "links")
        links = links.unionByName(more)
        tested, used, centres = tested.unionByName(new), used.unionByName(hubs.select("key", "hub")), 16 * centres


def _open_buckets(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (key, doc, n, comp, home) of buckets that hold several components;
    ``home`` is the component with most of the bucket."""
    placed = members.join(comp, members.doc == comp.node, "left").select("key", "doc", "n", F.coalesce("root", "doc").alias("comp"))
    counts = placed.groupBy("key", "comp").agg(F.count("*").alias("k")).groupBy("key").agg(F.max(F.struct("k", "comp")).alias("h"), F.count("*").alias("comps"))
    mixed = counts.filter("comps > 1").select(F.col("key").alias("_key"), F.col("h.comp").alias("home"))
    return stage(placed.join(mixed, F.col("key") == F.col("_key")).drop("_key"), "torn")


def near_duplicates(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, similarity: int = SIMILARITY,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of ``docs``.

    Texts of fewer words than a shingle are one shingle; without words (or NULL)
    a text links with nothing.  Rows without id link with nothing and are
    neither in a component nor kept.  Repeated rows repeat in the result.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = stage(sketch_documents(base, bands, rows, shingle), "sketches")
    usable = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(usable.groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct("doc_id", "bands")).alias("m")).select("k1", "k2", F.col("n_shingles").alias("n"), "m.bands", F.col("m.doc_id").alias("doc")), "classes")
    spread = classes.select("doc", "n", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    members = stage(spread.join(shared, "key").select("key", "doc", "n", "c"), "buckets")
    sets = full_sets(base, members.select("doc"), shingle)
    roots = components(bucket_links(members, classes.select("doc", "bands"), sets, similarity))
    labels = classes.join(roots, classes.doc == roots.node, "left").select("k1", "k2", F.col("n").alias("_n"), F.coalesce("root", "doc").alias("_root"))
    named = sketches.join(labels, (sketches.k1 == labels.k1) & (sketches.k2 == labels.k2) & (sketches.n_shingles == labels._n) & sketches.doc_id.isNotNull(), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without near duplicates, with their columns: the smallest id of each
    component stays.  Texts without words and rows without id stay; of rows that are
    equal in all columns one stays, other rows that share an id stay or go together.

    A bitmap of fixed size marks the ids that go or repeat.  Rows that miss it stay
    where they are; only those that hit it, mostly rows that go, are shuffled for the
    exact join."""
    found = stage(near_duplicates(docs, doc_id=doc_id, **options).filter("doc_id is not null"), "near")
    ids = found.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    asked = stage(ids.filter("not kept or n > 1").select(F.col("doc_id").alias("_asked"), F.col("kept").alias("_kept")), "near-asked")
    bitmap = docs.sparkSession.sparkContext.broadcast(Bitmap.of(asked, "_asked", _FILTER_BITS))

    @F.pandas_udf("boolean")
    def hit(slot: pd.Series) -> pd.Series:
        return pd.Series(bitmap.value.has_slots(slot.fillna(0).to_numpy().astype(np.int64)) & slot.notna().to_numpy())

    marked = docs.withColumn("_hit", hit(F.when(F.col(doc_id).isNotNull(), Bitmap.slot(doc_id, _FILTER_BITS))))
    rest = marked.filter("_hit").drop("_hit").join(asked, F.col(doc_id) == F.col("_asked"), "left")
    alone = rest.filter("_asked is null").select(*docs.columns)  # hit by chance
    repeated = rest.filter("_kept").select(*docs.columns).distinct()
    return marked.filter("not _hit").select(*docs.columns).unionByName(alone).unionByName(repeated)
