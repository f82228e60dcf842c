"""Repeated byte passages, from the interval tree of an enhanced suffix array.

The corpus is cut to the places where a suffix array is worth building.  The
anchor of a 50-byte window is its least 10-byte string; windows next to each
other with one anchor form a span.  A window has 20 bytes before its anchor or 20
after it, so equal windows share one of two 30-byte keys, and
:mod:`tripmart.llm.repeats` finds the keys that documents share.  Spans that are
alike in all documents are settled by their content.  The others, where a repeat begins or ends, go by key into
tasks that sort all their suffixes with common-prefix lengths (an enhanced suffix
array), scan them with a stack into the tree of common-prefix intervals, and keep
the intervals whose occurrences differ in the byte before: the maximal repeats,
each with all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm import repeats
from tripmart.llm.common import Roller, U, text_bytes
from tripmart.llm.recompress import covered

WIDTH = 50
GRAM, REACH = 10, 20
_SLICE = 1 << 20


@lru_cache(maxsize=8)
def roller(seed: int) -> Roller:
    return Roller(seed)


def rollers() -> tuple[Roller, Roller]:
    return roller(41), roller(42)


def spans_of(texts: pa.Array) -> repeats.Spans:
    data, offsets = text_bytes(texts)
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return repeats.Spans(data, offsets[:-1], none, none, none, none.astype(U), none.astype(U), [none.astype(U)])
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    one, two = rollers()
    sums = one.prefix(data)
    keys = one.windows(sums, GRAM)
    anchor = repeats.sliding_argmin(keys, WIDTH - GRAM + 1)
    first, count, own = repeats.runs_of_windows(anchor, row, WIDTH)
    ends = first + count + WIDTH - 1
    # at the edge of a text a key may reach into the next one; it is not used then
    before = one.spans(sums, np.maximum(own - REACH, 0), own + GRAM)
    after = one.spans(sums, own, np.minimum(own + GRAM + REACH, len(data)))
    return repeats.Spans(data, offsets[:-1], row[first], first, count, one.spans(sums, first, ends), two.spans(two.prefix(data), first, ends), [before, after], own - REACH + 1)


def suffix_array(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Enhanced suffix array of short texts: (text, place, common prefix with the
    suffix before) of all suffixes of ``least`` bytes or more, in order.

    A suffix ends with its text, so no common prefix runs from text to text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    depth = int(sizes.max(initial=0))
    n = np.maximum(0, sizes - least + 1)
    owner = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    flat = np.frombuffer(b"".join(texts) + bytes(depth), np.uint8)
    at = (np.cumsum(sizes) - sizes)[owner] + place
    left = sizes[owner] - place
    rows = flat[at[:, None] + np.arange(depth)]
    rows[np.arange(depth) >= left[:, None]] = 0
    order = np.argsort(rows.view(f"S{depth}").ravel(), kind="stable") if len(rows) else np.zeros(0, np.int64)
    rows, left = rows[order], left[order]
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = rows[1:] != rows[:-1]
        agree = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
        common[1:] = np.minimum(agree, np.minimum(left[1:], left[:-1]))
    return owner[order], place[order], common


def maximal_repeats(texts: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences (text, place)) of every repeat of ``least`` bytes or
    more that cannot be extended to either side in all its occurrences."""
    owner, place, common = suffix_array(texts, least)
    before = np.fromiter((texts[t][p - 1] if p else -1 for t, p in zip(owner.tolist(), place.tolist())), np.int64, len(owner))
    yield from ((length, list(zip(owner[a:b].tolist(), place[a:b].tolist()))) for length, a, b in left_diverse_intervals(common, before, least))


def left_diverse_intervals(common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan: (common prefix, from, to) of the intervals of the tree whose
    occurrences differ in the byte before (-1: none, differs from all)."""
    n = len(common)
    starts = np.flatnonzero(common < least)
    for lo, hi in zip(starts.tolist(), np.r_[starts[1:], n].tolist()):
        if hi - lo < 2:
            continue
        depth, left = common[lo:hi].tolist(), before[lo:hi].tolist()
        stack: list[list[int]] = []  # [common prefix, from, byte before or -1 when it differs]
        for i in range(1, hi - lo + 1):
            now = depth[i] if i < hi - lo else 0
            begin, side = i - 1, left[i - 1]
            while stack and stack[-1][0] > now:
                length, begin, own = stack.pop()
                side = own if own == side else -1
                if side == -1:
                    yield length, lo + begin, lo + i
            if now >= least:
                if stack and stack[-1][0] == now:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == side else -1
                else:
                    stack.append([now, begin, side])


def merged(doc: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same bytes as ranges that do not touch."""
    order = np.lexsort((at, doc))
    doc, at, size = doc[order], at[order], size[order]
    tag = at >> repeats.PLACE_BITS
    text = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])][: len(doc)])
    place = (text << repeats.PLACE_BITS + 1) + (at & (1 << repeats.PLACE_BITS) - 1)
    end = np.maximum.accumulate(place + size)
    first = np.flatnonzero(np.r_[True, place[1:] > end[:-1]][: len(doc)])
    last = np.r_[first[1:], len(doc)][: len(first)] - 1
    return doc[first], at[first], end[last] - place[first]


def resolve(table: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """Ranges of the spans of some keys.  Rows come by key, content and document:
    the first row of a content stands for it.  Its rows in larger documents are
    repeats as a whole; those of the same document lose what the first one loses."""
    g, s, doc, at, n = (table[c].to_numpy() for c in ("g", "s", "doc", "at", "n"))
    head = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
    low = doc[head]
    owner = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(g)]))
    again = doc > low[owner]
    out_doc, out_at, out_n = [doc[again]], [at[again]], [n[again] + width - 1]
    key = g[head]
    several = np.flatnonzero(np.r_[False, key[1:] == key[:-1]] | np.r_[key[1:] == key[:-1], False])
    texts = table["content"].take(pa.array(head[several])).to_pylist()
    owners, places, common = suffix_array(texts, width)
    before = np.fromiter((texts[t][p - 1] if p else -1 for t, p in zip(owners.tolist(), places.tolist())), np.int64, len(owners))
    first_doc = low[several][owners]
    # the texts side by side with a gap after each: where ranges begin and end
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begin = np.cumsum(sizes) - sizes
    flat = begin[owners] + places
    edges = np.zeros(int(sizes.sum()) + 1, np.int64)
    for length, a, b in left_diverse_intervals(common, before, width):
        docs = first_doc[a:b]
        later = flat[a:b][docs > docs.min()]
        np.add.at(edges, later, 1)
        np.add.at(edges, later + length, -1)
    inside = np.cumsum(edges) > 0
    start = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    size = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - start
    text = np.searchsorted(begin, start, "right") - 1
    # every row that the smallest document has of the content
    own = np.bincount(owner[~again], minlength=len(head))[several][text]
    row = np.repeat(head[several][text] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    out_doc.append(doc[row]), out_at.append(at[row] + np.repeat(start - begin[text], own)), out_n.append(np.repeat(size, own))
    out = merged(*(np.concatenate(x) for x in (out_doc, out_at, out_n)))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["doc", "at", "size"])


def _digest(texts: pa.Array, ranges: list) -> list[pa.Array]:
    n_bytes, n_removed, n_spans, digests = [], [], [], []
    for text, mine in zip(texts, ranges):
        raw = text.as_buffer() if text.is_valid else b""
        gone = 0
        runs = 0
        size = len(raw)
        if mine:
            out = covered(mine, size)
            gone = int(out.sum())
            runs = int((out & ~np.r_[False, out[:-1]]).sum())
            raw = np.frombuffer(raw, np.uint8)[~out].tobytes()
        n_bytes.append(size), n_removed.append(gone), n_spans.append(runs)
        digests.append(hashlib.sha256(raw).hexdigest())
    return [*(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string())]


def repeated_byte_ranges(docs: DataFrame) -> DataFrame:
    """(doc, at, size) of tagged ``docs``: bytes that a smaller document holds too."""
    maps = repeats.shared_keys(docs, spans_of, _SLICE)
    rows = repeats.candidate_rows(docs, spans_of, maps, rollers, _SLICE, WIDTH, resolvable=True)
    return repeats.repeat_ranges(rows, WIDTH, resolve)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    NULL and texts below 50 bytes lose nothing; rows without id or with a shared
    id are treated as in :func:`tripmart.llm.recompress.remove_repeats`.
    """
    rows = repeats.tagged(docs, doc_id, text)
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeats.finish(rows, repeated_byte_ranges(rows), _digest, fields, ["n_bytes", "n_removed", "n_spans", "kept_sha256"], _SLICE)
