"""Fill-in-the-middle transformation (operator 13).

A text is cut into units (a run of ASCII letters, or one other character) and two
ranks among them are drawn from a hash of its id.  An indexable skip list takes the
ranks to places in the text: its lowest lane has a link a unit, each further lane
keeps about one node in sixteen, and a link carries how many units and how many code
points it passes.  A descent from the top lane adds up widths until exactly the rank
is reached, in about 16 steps a lane.

The lists of all texts of a slice lie one after the other in the same arrays, so a
lane is built with one sum over segments, and all descents advance together.  A text
is cut where it is read; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import mix, slices, text_bytes

SEED = 1
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
RATE_PCT, SPM_PCT = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: A node joins the next lane with probability 2^-CLIMB.
CLIMB = 4


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each unit of all texts, and len+1 offsets of the texts' units."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    points = (data & 0xC0) != 0x80
    joined = np.r_[False, letter[:-1]] & letter
    joined[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(points & ~joined)
    return np.add.reduceat(points.astype(np.int64), starts), np.searchsorted(starts, offsets)


class SkipLists:
    """One indexable skip list a text, over units with their widths in code points."""

    def __init__(self, points: np.ndarray, offsets: np.ndarray):
        self.some = np.flatnonzero(np.diff(offsets))
        heads = offsets[:-1][self.some]
        # height: trailing zeros of a hash of the node's place, in steps of CLIMB; heads rise to the top
        bits = mix(np.arange(1, len(points) + 1, dtype=np.uint64)) | np.uint64(1 << 60)
        height = np.log2((bits & (~bits + np.uint64(1))).astype(float)).astype(np.int64) // CLIMB
        height[heads] = 64
        self.lanes = [(np.ones(len(points), np.int64), points, None)]
        while len(height) > len(heads):
            kept = np.flatnonzero(height >= len(self.lanes))
            below = self.lanes[-1]
            self.lanes.append((np.add.reduceat(below[0], kept), np.add.reduceat(below[1], kept), kept))
            height = height[kept]

    def code_points(self, rank: np.ndarray) -> np.ndarray:
        """Code points before the unit of the given rank, for each text that has units."""
        left, passed, at = rank.copy(), np.zeros(len(rank), np.int64), np.arange(len(rank))
        for width, points, down in reversed(self.lanes):
            going = np.flatnonzero(left > 0)
            while len(going):
                going = going[width[at[going]] <= left[going]]
                link = at[going]
                left[going] -= width[link]
                passed[going] += points[link]
                at[going] += 1
                going = going[left[going] > 0]
            if down is not None:
                at = down[np.minimum(at, len(down) - 1)]
        return passed


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2^32 from a hash of the id; a NULL id counts as the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
])


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate_pct: int = RATE_PCT, spm_pct: int = SPM_PCT,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output for each row.

    ``output`` is the text itself (form ``plain``; empty texts, texts that contain a
    mark, and all but ``rate_pct`` percent of the others), or prefix, suffix, middle
    (``psm``), or suffix, prefix, middle (``spm``, ``spm_pct`` percent), each after its
    mark.  A NULL text is empty; its output is the empty string.  Rows that repeat an
    id are transformed each on its own with the same draws; a NULL id counts as the
    empty string there.  Two equal ranks give an empty middle.  An empty table gives
    an empty table.  Other columns are ignored.  A very long text is one slice of its
    task.
    """
    p_mark, s_mark, m_mark = marks

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            points, offsets = units(batch.column("t"))
            n = np.diff(offsets)
            drawn = np.array([draws(i, seed) for i in batch.column("i").to_pylist()], np.int64).reshape(-1, 4)
            one, two = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
            lists = SkipLists(points, offsets)
            a, b = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            a[lists.some] = lists.code_points(np.minimum(one, two)[lists.some])
            b[lists.some] = lists.code_points(np.maximum(one, two)[lists.some])
            plain, spm = (n == 0) | (drawn[:, 2] % 100 >= rate_pct), drawn[:, 3] % 100 < spm_pct
            forms, prefixes, middles, outputs = [], [], [], []
            for t, i, j, as_is, back in zip(batch.column("t").to_pylist(), a.tolist(), b.tolist(), plain.tolist(), spm.tolist()):
                t = t or ""
                if as_is or any(mark in t for mark in marks):
                    forms.append(PLAIN), prefixes.append(None), middles.append(None), outputs.append(t)
                    continue
                forms.append(SPM if back else PSM), prefixes.append(i), middles.append(j - i)
                lead, tail = p_mark + t[:i], s_mark + t[j:]
                outputs.append((tail + lead if back else lead + tail) + m_mark + t[i:j])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(n), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())],
                RESULT.names,
            )

    return docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).cast("string").alias("t")).mapInArrow(transform, RESULT)


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS):
    """Column with the text, from output and form alone: a text that holds a mark is
    plain, and a mark cannot arise where parts meet, so the marks stand apart."""
    parts = F.split(F.col(output), "|".join(re.escape(m) for m in marks))
    return (
        F.when(F.col(form) == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(F.col(form) == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(F.col(output))
    )
