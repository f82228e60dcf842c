"""Quality classifier by compression (operator 12).

Two zstandard dictionaries are built, from well and from badly labelled text.  A
text is cut into chunks, and each chunk is compressed once with each dictionary; a
text resembles the class whose dictionary makes it smaller.  The difference of the
two sizes over their sum, for the whole text, goes through a logistic curve that is
fitted on labelled texts which are in no dictionary.

Chunks keep the dictionaries in sight: compressed as a whole, a long text would soon
refer to itself alone.  Labels are looked up for a bounded sample of ids only, and
the model (two dictionaries and two numbers) has a fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import slices, stage, text_bytes

#: Labelled rows a class that a model is fitted on, at most: one half gives the
#: dictionaries, the other the curve.  They are drawn by a hash of the id.
FIT_ROWS = 4000
#: Chunks a class that its dictionary is built from, at most, drawn by a hash.
DICT_CHUNKS = 8192
CHUNK, DICT_BYTES, LEVEL = 1024, 112_640, 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """Dictionaries of both classes, and the curve 1 / (1 + exp(-(shift + slope * difference)))."""

    bad: bytes
    good: bytes
    shift: float
    slope: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in (self.bad, self.good):
            kind = zstandard.DICT_TYPE_AUTO if data[:4] == MAGIC else zstandard.DICT_TYPE_RAWCONTENT
            words = zstandard.ZstdCompressionDict(data, dict_type=kind) if data else None
            if words is not None:
                words.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False))
        return out


# Fixed value: the four bytes that begin a trained dictionary.
MAGIC = b"\x37\xa4\x30\xec"


def chunk_starts(start: int, end: int) -> range:
    return range(start, end, CHUNK)


def differences(texts: pa.Array, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """(size as bad - size as good) / (their sum) for each whole text; 0 for an empty one."""
    data, offsets = text_bytes(texts)
    raw, bounds = memoryview(data.tobytes()), offsets.tolist()
    bad, good = (c.compress for c in compressors)
    out = np.zeros(len(texts))
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        as_bad = as_good = 0
        for i in chunk_starts(a, b):
            chunk = raw[i : min(i + CHUNK, b)]
            as_bad += len(bad(chunk))
            as_good += len(good(chunk))
        if b > a:
            out[k] = (as_bad - as_good) / (as_bad + as_good)
    return out


def with_difference(df: DataFrame, model: Model, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` (all long) and ``difference``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in slices(batches, "t"):
            columns = [batch.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(differences(batch.column("t"), compressors))], [*keep, "difference"])

    rows = df.select(*[F.col(c).cast("long").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(measure, ", ".join(f"{c} long" for c in keep) + ", difference double")


def dictionary(chunks: list[bytes]) -> bytes:
    """A dictionary of the chunks; the chunks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-DICT_BYTES:]


def logistic(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Shift and slope of the curve by Newton's method, targets smoothed by one row a
    class; the slope is not negative."""
    n1, n0 = (weight * good).sum(), (weight * ~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = float(np.std(x)) or 1.0
    design = np.c_[np.ones(len(x)), x / scale]
    beta = np.array([math.log((n1 + 1) / (n0 + 1)), 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (weight * (target - p)))
        step *= min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    if beta[1] <= 0:
        return math.log((n1 + 1) / (n0 + 1)), 0.0
    return float(beta[0]), float(beta[1] / scale)


def _order(*columns: Column) -> Column:
    return F.xxhash64(F.lit("compress"), *columns)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """A model from the rows of ``labels`` (label 0 or 1) and the texts of those ids.

    At most ``fit_rows`` ids a class are used, drawn by a hash of the id; their share of
    their class weighs them, so the curve follows the shares of all labelled ids.  Ids
    that are NULL, or labelled both ways, teach nothing; rows that repeat an id all
    teach, NULL and empty texts only the curve.  Without any row of a class the score is
    one number, the smoothed share of label 1.
    """
    named = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = stage(named.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).filter("y = _y").drop("_y"), "labelled")
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = math.log((count.get(1, 0) + 1) / (count.get(0, 0) + 1))
    if len(count) < 2:
        return Model(b"", b"", prior, 0.0)
    drawn = [known.filter(F.col("y") == y).orderBy(_order("id"), "id").limit(fit_rows) for y in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most 2 * fit_rows ids
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    rows = stage(texts.join(ids, "id"), "labelled-texts")
    first = F.pmod(_order("id", F.lit("half")), F.lit(2)) == 0
    words = [dictionary(_chunks(rows.filter(first & (F.col("y") == y)))) for y in (0, 1)]
    model = Model(words[0], words[1], prior, 0.0)
    if not all(words):
        return model
    curve = with_difference(rows.filter(~first), model, ["y"], "t").toArrow()  # at most 2 * fit_rows pairs of numbers
    good, x = curve["y"].to_numpy() == 1, curve["difference"].to_numpy()
    if not good.any() or good.all():
        return model
    share = [count[y] / max(1, int((good == bool(y)).sum())) for y in (0, 1)]
    weight = np.where(good, share[1], share[0]) * len(x) / (count[0] + count[1])
    return Model(words[0], words[1], *logistic(x, good, weight))


def _chunks(rows: DataFrame) -> list[bytes]:
    """At most DICT_CHUNKS chunks of the rows' texts, in the order of a hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            data, offsets = text_bytes(batch.column("t"))
            raw, ids, at, parts = data.tobytes(), [], [], []
            for i, a, b in zip(batch.column("id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                for k in chunk_starts(a, b):
                    ids.append(i), at.append(k - a), parts.append(raw[k : min(k + CHUNK, b)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array(parts, pa.binary())], ["id", "at", "chunk"])

    parts = rows.select("id", "t").mapInArrow(cut, "id long, at long, chunk binary")
    return [bytes(r["chunk"]) for r in parts.orderBy(_order("id", "at"), "id", "at", "chunk").limit(DICT_CHUNKS).collect()]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, difference, score (probability of label 1), predicted (1 from
    ``threshold`` on) for each row.

    NULL and empty texts have difference 0 and the score of the curve there.  Rows that
    repeat an id are scored each on its own, equal texts alike.  An empty table gives an
    empty table.  Other columns are ignored.  A text of any length is compressed to its
    end, chunk by chunk.
    """
    p = 1 / (1 + F.exp(-(F.lit(model.shift) + F.lit(model.slope) * F.col("difference"))))
    scored = with_difference(docs, model, [doc_id], text).withColumn("score", p)
    return scored.select(F.col(doc_id).alias("doc_id"), "difference", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Rows kept from the fitting: crc32 of the id as text, modulo ``folds``."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))
