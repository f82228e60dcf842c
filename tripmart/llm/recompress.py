"""Repeated passages of words, found by recompression.

Words are named by 64-bit hashes and recompressed in rounds, the same way in
every task: first runs of one symbol become a symbol, then pairs (left, right)
of the two halves into which a hash splits all symbols.  A name is a hash of
what it stands for, so names are global without a dictionary.  No symbol may
outgrow the round's limit; longer runs stay as they are.  A round therefore
spoils at most ``2 * limit - 1`` words at each edge of a passage: inside, equal
passages fall into equal symbols.

After two rounds (symbols of up to four words) the middle 30 words of any 50 are
cut alike wherever they stand.  The least-named group of three symbols that
starts in the first 19 of them is the window's anchor: what two documents share
is revealed by shared groups, and verified on hashes of whole passages
(:mod:`tripmart.llm.repeats`).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm import repeats
from tripmart.llm.common import Roller, U, mix, row_bounds, text_bytes, word_hashes, word_spans

WIDTH = 50
LIMITS = (2, 4)
_GROUP = 3
_EDGE = sum(2 * x - 1 for x in LIMITS)
_SLICE = 4 << 20


@lru_cache(maxsize=8)
def roller(seed: int) -> Roller:
    return Roller(seed)


def rollers() -> tuple[Roller, Roller]:
    return roller(32), roller(33)


def recompress(names: np.ndarray, row: np.ndarray, limits: tuple[int, ...] = LIMITS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a sequence after one round a limit: (first item, name) of each.
    ``row`` keeps documents apart."""
    first, size = np.arange(len(names)), np.ones(len(names), np.int64)
    for number, limit in enumerate(limits):
        if not len(names):
            break
        # runs: n equal neighbours that together stay within the limit
        head = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (row[1:] != row[:-1])])
        length = np.diff(np.r_[head, len(names)])
        joined = (length > 1) & (length * size[head] <= limit)
        inner = np.repeat(joined, length)
        inner[head] = False
        names = names.copy()
        names[head[joined]] = mix(names[head[joined]] * U(0x9E3779B97F4A7C15) + length[joined].astype(U))
        size = size.copy()
        size[head[joined]] *= length[joined]
        names, size, first, row = names[~inner], size[~inner], first[~inner], row[~inner]
        # pairs: a left symbol followed by a right one
        right = (mix(names + U(number + 1)) & U(1)).astype(bool)
        pair = np.flatnonzero(~right[:-1] & right[1:] & (row[1:] == row[:-1]) & (size[1:] + size[:-1] <= limit))
        names[pair] = mix(names[pair] * U(0xC2B2AE3D27D4EB4F) + mix(names[pair + 1]))
        size[pair] += size[pair + 1]
        stay = np.ones(len(names), bool)
        stay[pair + 1] = False
        names, size, first, row = names[stay], size[stay], first[stay], row[stay]
    return first, names


def spans_of(texts: pa.Array) -> repeats.Spans:
    data, offsets = text_bytes(texts)
    starts, ends, row = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, roller(31))
    bounds = row_bounds(row, len(texts))
    none = np.zeros(0, np.int64)
    if len(words) < WIDTH:
        return repeats.Spans(words, bounds, none, none, none, none.astype(U), none.astype(U), [none.astype(U)])
    first, names = recompress(words, row)
    group = mix(names[:-2] * U(0x9E3779B97F4A7C15) + mix(names[1:-1] * U(0xC2B2AE3D27D4EB4F) + mix(names[2:])))
    keys = np.full(len(words), U(0xFFFFFFFFFFFFFFFF))
    keys[first[:-2]] = group
    reach = WIDTH - 2 * _EDGE - _GROUP * LIMITS[-1] + 1
    anchor = repeats.sliding_argmin(keys, reach)[_EDGE:]
    first, count, own = repeats.runs_of_windows(anchor, row, WIDTH)
    one, two = (r.spans(r.prefix(words), first, first + count + WIDTH - 1) for r in rollers())
    return repeats.Spans(words, bounds, row[first], first, count, one, two, [mix(keys[own])])


def covered(ranges: list[tuple[int, int]] | None, n: int) -> np.ndarray:
    """Which of ``n`` items lie in a range."""
    edge = np.zeros(n + 1, np.int64)
    for a, b in ranges or ():
        edge[a] += 1
        edge[min(b, n)] -= 1
    return np.cumsum(edge)[:n] > 0


def _digest(texts: pa.Array, ranges: list) -> list[pa.Array]:
    n_words, n_removed, digests = [], [], []
    for text, mine in zip(texts, ranges):
        words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()  # ASCII white space
        kept = words
        if mine:
            gone = covered(mine, len(words))
            kept = [w for w, g in zip(words, gone.tolist()) if not g]
        n_words.append(len(words)), n_removed.append(len(words) - len(kept))
        digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]


def repeated_word_ranges(docs: DataFrame) -> DataFrame:
    """(doc, at, size) of tagged ``docs``: words that a smaller document holds too."""
    maps = repeats.shared_keys(docs, spans_of, _SLICE)
    rows = repeats.candidate_rows(docs, spans_of, maps, rollers, _SLICE, WIDTH, resolvable=False)
    return repeats.repeat_ranges(rows, WIDTH)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    NULL and texts below 50 words lose nothing.  A row without id neither loses
    words nor costs others any; rows that share an id are one document, so they
    cost each other nothing, and each is cut by its own text.
    """
    rows = repeats.tagged(docs, doc_id, text)
    return repeats.finish(rows, repeated_word_ranges(rows), _digest, "n_words long, n_removed long, kept_sha256 string", ["n_words", "n_removed", "kept_sha256"], _SLICE)
