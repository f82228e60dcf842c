"""Helpers shared by the corpus operators.

* :func:`stage` cuts lineage with a Parquet table below the shared folder that
  ``spark.checkpoint.dir`` names, so a lost executor costs one re-read.
* :func:`salted_rank` and :func:`components` are the two distributed building
  blocks (ranks without one task per group, connected components).
* :class:`Bitmap` is a filter of fixed size: the only thing broadcast whose
  content follows the data; its size never does.
* the numpy part hashes words and windows of a whole Arrow batch at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripmart.session import ensure_checkpoint_dir

# --- staging -------------------------------------------------------------------


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripmart/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- distributed building blocks -------------------------------------------------


def salted_rank(
    df: DataFrame, group: list[str], salt: str, order: list[str], out: str, weight: str | None = None
) -> DataFrame:
    """Add ``out``: the 0-based rank of each row in its group by (salt, order),
    or with ``weight`` the sum of the weights before it.

    A group is never sorted in one task: rows are ranked inside (group, salt)
    and a small table of (group, salt) totals gives each salt its start.  The
    salt must lead the order and spread every group evenly, for instance
    leading digits of a hash.  NULL groups form one group.
    """
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\x00null")).alias(f"_g{i}") for i, g in enumerate(group)]
    rows = df.select("*", *keys)
    by = [f"_g{i}" for i in range(len(group))]
    amount = F.lit(1) if weight is None else F.col(weight)
    totals = rows.groupBy(*by, salt).agg(F.sum(amount).cast("long").alias("_total"))
    before = Window.partitionBy(*by).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, F.col(salt).alias("_salt"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, salt).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    on = [ranked[b] == starts[b] for b in by] + [ranked[salt] == starts["_salt"]]
    joined = ranked.join(starts, on, "inner")
    return joined.select(*[ranked[c] for c in df.columns], (F.col("_start") + F.col("_in")).cast("long").alias(out))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root) for every
    node, ``root`` being the smallest node of its component.

    First every node keeps the edge to its smallest neighbour below it, and hands
    its other lower neighbours over to that one, until the edges are a forest; a
    round never has more edges than the one before.  Then nodes skip to their
    parent's parent until they point to roots.  A round is an aggregate with a
    map-side part and a join, staged; the driver sees one count a round.
    """
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(current, "forest")
    while True:
        low = current.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("_high"))
        torn = low.filter("m <> _high").select(F.col("a").alias("_a"), F.col("m").alias("_m"))
        handed = current.join(torn, F.col("a") == F.col("_a")).filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"), F.lit(True).alias("new"))
        current = stage(low.select("a", F.col("m").alias("b"), F.lit(False).alias("new")).unionByName(handed), "forest")
        if not current.filter("new").count():
            break
    roots = current.select("a", "b")
    while True:
        above = roots.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
        jumped = roots.join(above, F.col("b") == F.col("_a"), "left").select("a", F.coalesce("_b", "b").alias("b"), F.col("_b").isNotNull().alias("moved"))
        jumped = stage(jumped, "roots")
        roots = jumped.select("a", "b")
        if not jumped.filter("moved").count():
            break
    return roots.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().unionByName(roots.select(F.col("a").alias("node"), F.col("b").alias("root")))


class Bitmap:
    """A set of 64-bit keys as 2^bits bits: membership has false positives,
    never false negatives.  The size is fixed by ``bits`` (2^26 bits: 8 MB), so
    it may be broadcast whatever the data; a fuller one only lets more rows
    through to the exact step that follows."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @staticmethod
    def of(keys: DataFrame, column: str, bits: int = 24) -> Bitmap:
        """Bitmap of a BIGINT column.  At most 2^(bits-6) rows reach the driver."""
        slot = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << bits))
        packed = keys.select(slot.alias("_s")).groupBy(F.shiftright("_s", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(_s & 63 as int))")).alias("v")
        )
        got = packed.toArrow()
        words = np.zeros(1 << max(0, bits - 6), np.uint64)
        words[got["w"].to_numpy()] = got["v"].to_numpy().view(np.uint64)
        return Bitmap(words, bits)

    def has_slots(self, slots: np.ndarray) -> np.ndarray:
        slots = slots.astype(np.uint64)
        return (self.words[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1

    @staticmethod
    def slot(column: str, bits: int = 24):
        """Column with the slot of ``column``, to be sent along with the rows."""
        return F.pmod(F.xxhash64(F.col(column)), F.lit(1 << bits)).alias("_slot")


# --- texts in numpy ---------------------------------------------------------------

#: ASCII white space: what separates words in every operator here.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 4 << 20
#: For work that keeps some dozens of bytes for each byte of text: workers of all slots share
#: an executor's memory, and keep what their largest slice took.
SMALL_SLICE = 1 << 20
U = np.uint64


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(sizes) else np.array([], int)
        for a, b in zip(cuts, np.r_[cuts[1:], len(sizes)]):
            yield batch.slice(int(a), int(b - a))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after another, and len+1 offsets; NULL is empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Roller:
    """Polynomial hashes modulo 2^64 of any spans of a sequence, from prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power, self.back = np.ones(1, U), np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            for name, b in (("power", self.base), ("back", self.inverse)):
                steps = np.full(n, U(b % (1 << 64)))
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of byte values (uint8) or of 64-bit items."""
        self._grow(len(values) + 1)
        items = self.byte[values] if values.dtype == np.uint8 else values
        sums = np.zeros(len(values) + 1, U)
        np.cumsum(items * self.power[: len(values)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.back[starts] + (ends - starts).astype(U))

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hash of every span of ``width`` items, by start."""
        n = max(0, len(sums) - width)
        return mix((sums[width:] - sums[:n]) * self.back[:n] + U(width))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, roller: Roller) -> np.ndarray:
    return roller.spans(roller.prefix(data), starts, ends)


def row_bounds(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's items, for items sorted by row."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed differences, byte plane by byte plane."""
    steps = np.diff(values.astype(U), prepend=U(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the smallest node of each one's component."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


LONG = T.LongType()
