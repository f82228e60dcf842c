"""Importance resampling towards a target corpus (operator 11).

A feature is a run of consecutive words; its bucket is the CRC-32 of the run modulo
the number of buckets.  A slice of documents is normalised (lower case, one space
between words) and scanned once: the running CRC of every prefix is kept, and the
CRC of any run follows from the two prefixes around it.  A CRC register is linear
over GF(2), so pushing zero bytes through it is a matrix; shifting the shorter
prefix by the run's length and adding it to the longer one cancels all that came
before the run.

The corpus is read twice: once for the counts of the buckets (a histogram of fixed
size a task), once for the weights.  Ranks are taken inside ranges of the score, so
no task sorts all documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import LOWER, salted_rank, shuffle_partitions, slices, stage, text_bytes

BUCKETS = 10_000
MIN_WORDS = 20
SHARE_PCT = 10
SEED = 2024

# --- CRC-32 of any span from prefixes ---------------------------------------------

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: Bytes a lane scans; lanes of a slice advance together.
LANE = 1024


def _byte_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
    return steps


def _through(matrix: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A GF(2) matrix, given by its images of the four bytes, times registers."""
    return matrix[0][register & 255] ^ matrix[1][(register >> 8) & 255] ^ matrix[2][(register >> 16) & 255] ^ matrix[3][register >> 24]


def _zero_steps(powers: int = 40) -> list[np.ndarray]:
    """Matrix number k pushes 2^k zero bytes through a register."""
    places = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    out = [(places >> 8) ^ BYTE[places & 255]]
    while len(out) < powers:
        out.append(_through(out[-1], out[-1]))
    return out


BYTE = _byte_steps()
ZEROS = _zero_steps()


def shift(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers after ``n`` zero bytes each."""
    out = register.copy()
    k = 0
    while (n >> k).any():
        at = np.flatnonzero((n >> k) & 1)
        out[at] = _through(ZEROS[k], out[at])
        k += 1
    return out


class PrefixCrc:
    """Running CRC registers of all prefixes of ``data``, from one scan."""

    def __init__(self, data: np.ndarray):
        lanes = max(1, -(-len(data) // LANE))
        grid = np.zeros(lanes * LANE, np.uint8)
        grid[: len(data)] = data
        grid = np.ascontiguousarray(grid.reshape(lanes, LANE).T)
        self.local = np.zeros((LANE + 1, lanes), np.uint32)
        for i in range(LANE):
            r = self.local[i]
            self.local[i + 1] = (r >> 8) ^ BYTE[(r ^ grid[i]) & 255]
        # what the lanes before leave in the register at the start of a lane
        self.before = np.zeros(lanes, np.uint32)
        step, past = ZEROS[LANE.bit_length() - 1], np.zeros(1, np.uint32)
        for lane in range(1, lanes):
            past = _through(step, past) ^ self.local[LANE, lane - 1]
            self.before[lane] = past[0]

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of ``data[start:end]`` from the prefixes at both ends.  Where both lie
        in one lane, what came before the lane cancels too."""
        lane = starts // LANE
        low, high = starts - lane * LANE, ends - lane * LANE
        before, after = self.local[low, lane], self.local[np.minimum(high, LANE), lane]
        far = np.flatnonzero(high > LANE)
        if len(far):
            before[far], after[far] = self._whole(starts[far]), self._whole(ends[far])
        return after ^ shift(before ^ ONES, ends - starts) ^ ONES

    def _whole(self, position: np.ndarray) -> np.ndarray:
        """Register of the prefix from the very start."""
        lane = np.minimum(position // LANE, len(self.before) - 1)
        i = position - lane * LANE
        return self.local[i, lane] ^ shift(self.before[lane], i)


# --- features ---------------------------------------------------------------------

#: ASCII digits and letters, and all bytes of other characters, make words.
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a column in lower case, a space after each; start and end of each
    word in it, and its row."""
    data, offsets = text_bytes(column)
    inside = IN_WORD[data]
    new_text = np.zeros(len(data) + 1, bool)
    new_text[offsets] = True
    first = inside & np.r_[True, ~inside[:-1] | new_text[1:-1]][: len(data)]
    last = inside & np.r_[~inside[1:] | new_text[1:-1], True][: len(data)]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, begin, "right") - 1
    length = end - begin
    starts = np.cumsum(length + 1) - (length + 1)
    out = np.full(int((length + 1).sum()), 32, np.uint8)
    letters = np.ones(len(out), bool)
    letters[starts + length] = False
    out[letters] = LOWER[data[inside]]
    return out, starts, starts + length, row


def buckets_of(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each run of 1 to ``longest`` words, sorted by row; words a row."""
    data, starts, ends, row = normalised(column)
    n_words = np.bincount(row, minlength=len(column))
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    prefixes = PrefixCrc(data)
    found, rows = [], []
    for n in range(1, longest + 1):
        i = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
        found.append(prefixes.spans(starts[i], ends[i + n - 1]) % np.uint32(buckets))
        rows.append(row[i])
    found, rows = np.concatenate(found).astype(np.int64), np.concatenate(rows)
    order = np.argsort(rows, kind="stable") if longest > 1 else slice(None)
    return found[order], rows[order], n_words


def bucket_counts(df: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket.  A task returns one
    histogram, and ``buckets`` sums reach the driver, whatever the input."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in slices(batches, "t"):
            counts += np.bincount(buckets_of(batch.column("t"), longest, buckets)[0], minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    parts = df.select(F.col(text).cast("string").alias("t")).mapInArrow(histogram, "bucket long, n long")
    got = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, floored."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def _gumbel(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


WEIGHED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
    T.StructField("weight", T.LongType()), T.StructField("score", T.LongType()),
])


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, longest: int, seed: int) -> DataFrame:
    """Words, features, sum of gains and that sum with Gumbel noise, for each document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            bucket, row, n_words = buckets_of(batch.column("t"), longest, len(gain))
            sums = np.r_[0, np.cumsum(gain[bucket])]
            bounds = np.searchsorted(row, np.arange(len(batch) + 1))
            weight = sums[bounds[1:]] - sums[bounds[:-1]]
            noise = np.array([_gumbel(i, seed) for i in batch.column("i").to_pylist()], np.int64)
            columns = [batch.column("i"), pa.array(n_words), pa.array(np.diff(bounds)), pa.array(weight), pa.array(weight + noise)]
            yield pa.RecordBatch.from_arrays(columns, WEIGHED.names)

    return docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).cast("string").alias("t")).mapInArrow(weigh, WEIGHED)


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1,
    buckets: int = BUCKETS, min_words: int = MIN_WORDS, share_pct: int = SHARE_PCT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for each row of ``docs``; rank
    is 1, 2, 3 ... for the ``share_pct`` percent (floored) of the documents with at
    least ``min_words`` words that are drawn, NULL for the others.

    Drawing the highest of weight plus Gumbel noise is sampling without replacement in
    proportion to the importance weight.  NULL or empty texts have no features and
    weight 0.  Rows that repeat an id are drawn each on its own, with the same noise; a
    NULL id counts as the empty string there and ranks last among equal scores.  Equal
    scores go to the smaller id.  An empty target or corpus counts as zeros.  Other
    columns of ``docs`` are ignored.  A very long text is one slice of its task.
    """
    gain = gains(bucket_counts(target, target_text, longest, buckets), bucket_counts(docs, text, longest, buckets))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    scored = stage(weights(docs, gain, doc_id, text, longest, seed), "importance")
    able = scored.filter(F.col("n_words") >= min_words).withColumn("_row", F.monotonically_increasing_id())
    # ranges of the score are written out, so that a row's range is a stored value
    ranges = stage(able.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).withColumn("_range", F.spark_partition_id()), "importance-ranges")
    drawn = share_pct * ranges.count() // 100
    ranked = salted_rank(ranges, [], "_range", order, "_rank").drop("_row", "_range")
    ranked = ranked.select("*", F.when(F.col("_rank") < drawn, F.col("_rank") + 1).alias("rank")).drop("_rank")
    short = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short)


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` draws, with all their columns.  Rows
    that repeat an id are returned when one of them is drawn."""
    ids = resample(docs, target, doc_id=doc_id, **options).filter("rank is not null").select(F.col("doc_id").alias("_drawn"))
    return docs.join(ids, docs[doc_id].cast("long").eqNullSafe(F.col("_drawn")), "left_semi")

