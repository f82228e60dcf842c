"""Passages that repeat across documents, found without shuffling texts.

A *window* is ``width`` consecutive items (words or bytes) of one document.  An
operator names one item of every window its *anchor*, from the window's content
alone, so that equal windows have equal anchors.  Neighbouring windows with one
anchor form a *span*.  Three steps, each linear in the input:

1. Every span sends 32 bits of each of its keys and 32 of its content.  (A key is a
   part of the content that equal windows share; an operator may cut a span in two
   halves with a key each.)  Shards of keys find the keys that two documents share
   and those of them with differing contents ("mixed": where repeats begin and
   end).  The answer is bitmaps of fixed size (a third marks keys with a great many
   contents).
2. A second scan sends the spans with shared keys.  Where all contents of its keys
   are equal the span stands for all its windows.  Otherwise its halves go apart:
   by their content hash where that is the key's only one, else as single windows or
   with their content for the operator to resolve (keys with a great many contents
   always go as windows, so what is resolved together stays small).  Occurrences
   inside one slice are compared at once and only the smallest document goes on, so
   a passage that a third of all documents hold costs a row a slice.  Rows are
   then sorted by content and document and read as a stream: all after the first
   document are repeats.  No group is held in memory.
3. Documents with repeats, picked by a bitmap of fixed size, are joined with
   their ranges; all others are finished in the scan.

Bitmaps only ever let too many rows through; every decision is made on 128 bits
of content hash (or on the content itself).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Bitmap, Roller, U, pack_sorted, shuffle_partitions, slices, stage, unpack_sorted

#: Bits of the bitmaps of shared, mixed and crowded keys: 32, 8 and 8 MB.
BITS = (28, 26, 26)
CROWD = 20_000
DOC_BITS = 24
PLACE_BITS = 40  # low bits of a place; above them a tag of the row's text


@dataclass
class Spans:
    """Spans of a slice: row, first window (item place in the slice), number of
    windows, two content hashes; the items, and where each row's start.

    ``keys`` has a key for the windows before ``cut`` (a window start) and, if there
    is a second one, for those from it on."""

    items: np.ndarray
    starts: np.ndarray
    row: np.ndarray
    first: np.ndarray
    count: np.ndarray
    content: np.ndarray
    check: np.ndarray
    keys: list[np.ndarray]
    cut: np.ndarray | None = None

    def halves(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first window, number of windows, key) of all spans, for each key."""
        end = self.first + self.count
        if len(self.keys) == 1:
            return [(self.first, self.count, self.keys[0])]
        cut = np.clip(self.cut, self.first, end)
        return [(self.first, cut - self.first, self.keys[0]), (cut, end - cut, self.keys[1])]


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the least key (leftmost among equals) of every ``width`` neighbours;
    keys compare by their high bits."""
    bits = max(24, int(len(keys)).bit_length())  # the same in every slice
    mask = U((1 << bits) - 1)
    least = (keys & ~mask) | np.arange(len(keys)).astype(U)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return (least & mask).astype(np.int64)


def runs_of_windows(anchor: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of each span, given the anchor of
    every window start and the row of every item."""
    n = max(0, len(row) - width + 1)
    valid = np.flatnonzero(row[:n] == row[width - 1 : width - 1 + n])
    if not len(valid):
        return valid, valid, valid
    own = anchor[valid]
    fresh = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1)])
    return valid[fresh], np.diff(np.r_[fresh, len(valid)]), own[fresh]


def _summaries(docs: DataFrame, spans_of: Callable[[pa.Array], Spans], shards: int, limit: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches, limit=limit):
            s = spans_of(batch.column("text"))
            if not len(s.row):
                continue
            some = [n > 0 for _, n, _ in s.halves()]
            packed = np.concatenate([(k[x] & U(0xFFFFFFFF00000000)) | (s.content[x] >> U(32)) for (_, _, k), x in zip(s.halves(), some)])
            row = np.concatenate([s.row[x] for x in some])
            order = np.argsort(packed, kind="stable")
            packed, row = packed[order], row[order]
            key = packed >> U(32)
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            # the same key in two rows of this slice
            most, least = np.maximum.reduceat(row, head), np.minimum.reduceat(row, head)
            several = np.repeat(most != least, np.diff(np.r_[head, len(key)]))
            fresh = np.r_[True, packed[1:] != packed[:-1]]
            packed, several = packed[fresh], several[fresh]
            shard = (packed >> U(32)).astype(np.int64) * shards >> 32
            cut = np.searchsorted(shard, np.arange(shards + 1))
            full = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([pack_sorted(packed[cut[i] : cut[i + 1]]) for i in full], pa.binary()),
                 pa.array([np.packbits(several[cut[i] : cut[i + 1]]).tobytes() for i in full], pa.binary())],
                names=["shard", "packed", "several"])

    return docs.select("text").mapInArrow(run, "shard int, packed binary, several binary")


def shared_keys(docs: DataFrame, spans_of: Callable[[pa.Array], Spans], limit: int) -> list[np.ndarray]:
    """Bitmaps (shared, mixed, crowded) over the high bits of keys."""
    shards = 1 << max(5, (2 * shuffle_partitions(docs.sparkSession)).bit_length())

    def merge(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        blobs = [unpack_sorted(x.as_py()) for x in table["packed"]]
        flags = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(b)) for x, b in zip(table["several"], blobs)]
        packed = np.concatenate(blobs)
        order = np.argsort(packed, kind="stable")
        packed, several = packed[order], np.concatenate(flags)[order].astype(bool)
        source = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])[order]
        key = packed >> U(32)
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        low, high = np.minimum.reduceat(source, head), np.maximum.reduceat(source, head)
        shared = (low != high) | np.logical_or.reduceat(several, head)
        last = np.r_[head[1:], len(key)] - 1
        mixed = shared & (packed[head] != packed[last])
        crowded = mixed & (last - head >= CROWD)
        out = []
        for hits, bits in zip((shared, mixed, crowded), BITS):
            part = np.zeros((1 << bits) // shards, bool)
            part[(key[head] >> U(32 - bits)).astype(np.int64)[hits] - (shard << bits) // shards] = True
            out.append(np.packbits(part, bitorder="little").tobytes())
        return pa.table({"shard": pa.array([shard], pa.int32()), "maps": pa.array([out], pa.list_(pa.binary()))})

    maps = [np.zeros((1 << bits) // 8, np.uint8) for bits in BITS]
    # bounded: the bitmaps have a fixed size
    parts = _summaries(docs, spans_of, shards, limit).groupBy("shard").applyInArrow(merge, "shard int, maps array<binary>")
    for row in parts.toLocalIterator():
        for m, part in zip(maps, row["maps"]):
            size = len(m) // shards
            m[row["shard"] * size : (row["shard"] + 1) * size] = np.frombuffer(part, np.uint8)
    return maps


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys >> U(65 - (8 * len(bitmap)).bit_length())).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


#: Rows of the second scan.  kind 0: equal (g, s) is equal content, ``n`` windows;
#: kind 1: to be resolved among the rows of key ``g``; kind 2: a repeat already known.
ROWS = "kind int, g long, s long, doc long, at long, n long, content binary"


def candidate_rows(docs: DataFrame, spans_of: Callable[[pa.Array], Spans], maps: list[np.ndarray], rollers: Callable[[], tuple[Roller, Roller]], limit: int, width: int, resolvable: bool) -> DataFrame:
    """Spans with shared keys; halves with mixed keys as single windows, or with
    their content where the operator can resolve them."""
    bitmaps = docs.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        shared, mixed, crowded = bitmaps.value
        for batch in slices(batches, limit=limit):
            s = spans_of(batch.column("text"))
            if not len(s.row):
                continue
            tag, doc = batch.column("_tag").to_numpy(), batch.column("doc_id").to_numpy()
            halves = s.halves()
            known = [(n > 0) & _has(shared, k) for _, n, k in halves]
            torn = [x & _has(mixed, k) for x, (_, _, k) in zip(known, halves)]
            any_torn = np.logical_or.reduce(torn)
            whole = np.flatnonzero(np.logical_or.reduce(known) & ~any_torn)
            one, two = ((r, r.prefix(s.items)) for r in rollers())
            g, h, row, first, count = [s.content[whole]], [s.check[whole]], [s.row[whole]], [s.first[whole]], [s.count[whole]]
            for (a, n, k), x, t in zip(halves, known, torn):
                single = t & (_has(crowded, k) if resolvable else True)
                alone = np.flatnonzero(x & any_torn & ~t)
                at = [a[alone], a[single]]
                reps = n[single]
                at[1] = np.repeat(at[1] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
                size = [n[alone], np.ones(len(at[1]), np.int64)]
                at, size = np.concatenate(at), np.concatenate(size)
                for out, (r, sums) in ((g, one), (h, two)):
                    out.append(r.spans(sums, at, at + size + width - 1) if len(at) else np.zeros(0, U))
                row.append(np.r_[s.row[alone], np.repeat(s.row[single], reps)]), first.append(at), count.append(size)
                open_ = np.flatnonzero(t & ~single)
                if len(open_):
                    b = a[open_]
                    content = [s.items[x:y].tobytes() for x, y in zip(b.tolist(), (b + n[open_] + width - 1).tolist())]
                    own = one[0].spans(one[1], b, b + n[open_] + width - 1)
                    r = s.row[open_]
                    yield from _emit(1, k[open_], own, doc[r], (tag[r] << PLACE_BITS) + b - s.starts[r], n[open_], content)
            g, h, row, first, count = (np.concatenate(x) for x in (g, h, row, first, count))
            yield from _emit(0, g, h, doc[row], (tag[row] << PLACE_BITS) + first - s.starts[row], count, None)

    return docs.filter("doc_id is not null").mapInArrow(run, ROWS)


def _emit(kind, g, s, doc, at, n, content):
    """Rows for the shuffle; of equal contents only the smallest document's first
    one goes on, those of larger documents are repeats at once (kind 2)."""
    if not len(g):
        return
    order = np.lexsort((at, doc, s, g))
    g, s, doc, at, n = g[order], s[order], doc[order], at[order], n[order]
    head = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])]
    low = doc[np.flatnonzero(head)][np.cumsum(head) - 1]
    known = doc > low
    kinds = np.where(known, 2, kind)
    if content is None:
        bodies = pa.nulls(len(g), pa.binary())
    else:
        bodies = pa.array([None if k else content[i] for i, k in zip(order.tolist(), known.tolist())], pa.binary())
    g = np.where(known, doc.astype(U) * U(0x9E3779B97F4A7C15), g)  # spread what only passes through
    yield pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(g.view(np.int64)), pa.array(s.view(np.int64)), pa.array(doc), pa.array(at), pa.array(n), bodies],
        names=["kind", "g", "s", "doc", "at", "n", "content"])


def repeat_ranges(rows: DataFrame, width: int, resolve: Callable | None = None) -> DataFrame:
    """(doc, at, size): ranges of items that a smaller document holds too.

    Rows are sorted by content and document inside their partition and streamed.
    ``resolve`` gets the rows of kind 1, a bounded number of keys at a time."""

    def run(batches):
        last, pending, held = None, [], 0
        for batch in batches:
            kind, g, s, doc, at, n = (batch.column(c).to_numpy() for c in ("kind", "g", "s", "doc", "at", "n"))
            out_doc, out_at, out_n = [doc[kind == 2]], [at[kind == 2]], [n[kind == 2] + width - 1]
            plain = np.flatnonzero(kind == 0)
            if len(plain):
                pg, ps, pd_ = g[plain], s[plain], doc[plain]
                head = np.r_[True, (pg[1:] != pg[:-1]) | (ps[1:] != ps[:-1])]
                low = pd_[np.flatnonzero(head)]
                if last is not None and (pg[0], ps[0]) == last[:2]:
                    low[0] = last[2]
                low = low[np.cumsum(head) - 1]
                last = (pg[-1], ps[-1], low[-1])
                again = plain[pd_ > low]
                out_doc.append(doc[again]), out_at.append(at[again]), out_n.append(n[again] + width - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_doc, out_at, out_n)], names=["doc", "at", "size"])
            if resolve is not None and (kind == 1).any():
                pending.append(batch.filter(pa.array(kind == 1)))
                held += pending[-1].nbytes
                if held > (2 << 20):
                    table = pa.Table.from_batches(pending)
                    keys = table["g"].to_numpy()
                    open_from = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                    if open_from:  # the last key may go on in the next batch
                        yield from resolve(table.slice(0, open_from), width)
                        pending = table.slice(open_from).combine_chunks().to_batches()
                        held = sum(x.nbytes for x in pending)
        if pending:
            yield from resolve(pa.Table.from_batches(pending), width)

    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "g").sortWithinPartitions("kind", "g", "s", "doc")
    return dealt.mapInArrow(run, "doc long, at long, size long")


def tagged(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, _tag): the tag tells rows that share an id apart."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text"), F.pmod(F.xxhash64(t), F.lit(1 << 20)).alias("_tag"))


def finish(docs: DataFrame, ranges: DataFrame, digest: Callable[[pa.Array, list], list[pa.Array]], fields: str, names: list[str], limit: int) -> DataFrame:
    """Apply ``digest(texts, ranges of each)`` to every row of ``docs`` (tagged)."""
    place = F.col("at").bitwiseAND((1 << PLACE_BITS) - 1)
    by_row = ranges.select("doc", F.shiftright("at", PLACE_BITS).alias("tag"), place.alias("a"), (place + F.col("size")).alias("b"))
    found = stage(by_row.groupBy("doc", "tag").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("ranges")), "ranges")
    bitmap = docs.sparkSession.sparkContext.broadcast(Bitmap.of(found, "doc", DOC_BITS))

    def scan(batches):
        for batch in slices(batches, limit=limit):
            hit = bitmap.value.has_slots(batch.column("_slot").to_numpy())
            texts = batch.column("text")
            clean = np.flatnonzero(~hit)
            done = digest(texts.take(pa.array(clean)), [None] * len(clean))
            back = np.full(len(hit), -1)
            back[clean] = np.arange(len(clean))
            at = pa.array(back, mask=hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_tag"), texts.take(pa.array(np.arange(len(hit)), mask=~hit)), *(x.take(at) for x in done)],
                names=["doc_id", "_tag", "text", *names])

    # a NULL id is in no range; its slot may be set, then the join below finds nothing
    scanned = stage(docs.withColumn("_slot", F.coalesce(Bitmap.slot("doc_id", DOC_BITS), F.lit(0))).mapInArrow(scan, f"doc_id long, _tag long, text string, {fields}"), "scanned")
    rest = scanned.filter("text is not null").select("doc_id", "_tag", "text")
    joined = rest.join(found, (rest.doc_id == found.doc) & (rest._tag == found.tag), "left").select("doc_id", "text", "ranges")

    def apply(batches):
        for batch in slices(batches, limit=limit):
            ranges_of = [None if r is None else [(x["a"], x["b"]) for x in r] for r in batch.column("ranges").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *digest(batch.column("text"), ranges_of)], names=["doc_id", *names])

    return scanned.filter("text is null").select("doc_id", *names).unionByName(joined.mapInArrow(apply, f"doc_id long, {fields}"))
