"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Method: large-item matching.  Only lengths matter, and there are at most
``capacity`` of them, so the plan is made on the histogram of lengths:

1. pieces above half the capacity are matched, largest first, each with the
   largest piece above one third that still fits (at most two such pieces fit
   into a sequence); what is left above one third is paired with itself;
2. the smaller pieces, longest first, go into the tightest gap that holds them,
   for whole runs of equal sequences at a time.

The histogram and the plan (runs "these n sequences take k pieces of length L
each") are bounded by the capacity whatever the corpus; they are all that the
driver sees.  Every piece then finds its place from its rank among the pieces
of its length, a rank that no single task has to compute for a whole length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import LOWER, SMALL_SLICE, Roller, salted_rank, shuffle_partitions, slices, stage, text_bytes, word_hashes, word_spans

CAPACITY = 2048
#: Distinct pieces a worker remembers: about 30 bytes each, and as much again while it learns.
_CACHE_PIECES = 1_000_000
_MARK = "\x01"
BLOCK_BITS = 12  # places in one sort task of a length: 4096


class WordEncoder:
    """Ids of texts, piece by piece.

    The vocabulary's splitter never joins across white space, nor across a border of an
    ASCII letter with another ASCII character (but for apostrophes and the marks of
    special tokens), and it lower-cases.  So the ids of a text are those of its pieces,
    and a piece of ASCII alone may be lower-cased first.  Pieces are named by 64-bit
    hashes; each distinct one is encoded once per worker, and a full table is started
    anew."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, and each one's piece
        self.starts, self.pool = np.zeros(1, np.int64), np.zeros(1 << 16, np.uint32)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has: many pieces in a text, a mark after
        each, where the mark is one id that no piece has."""
        if len(self.mark) != 1 or any(_MARK in x for x in pieces):
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.fromiter((i for ids in lists for i in ids), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))
        texts = [f" {_MARK} ".join([*pieces[i : i + 256], ""]) for i in range(0, len(pieces), 256)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self.mark[0])
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Encode the pieces with these (sorted, unknown) hashes."""
        plain = np.array([_MARK not in x for x in pieces])
        ids, sizes = [], np.zeros(len(pieces), np.int64)
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            if len(some):
                found, n = self._encoded([pieces[i] for i in some])
                ids.append(found)
                sizes[some] = n
        order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
        flat, used, first = np.concatenate(ids), int(self.starts[-1]), len(self.starts) - 1
        while used + len(flat) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros(len(self.pool), np.uint32)]
        self.pool[used : used + len(flat)] = flat
        self.starts = np.r_[self.starts, used + np.cumsum(sizes[order])]
        number = np.empty(len(pieces), np.int64)
        number[order] = first + np.arange(len(pieces))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.number = np.insert(self.keys, at, keys), np.insert(self.number, at, number)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and len+1 offsets by text."""
        data, starts, ends, row = text_pieces(texts)
        coded = pa.array(word_hashes(data, starts, ends, roller())).dictionary_encode()
        names, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        at, unseen = self._find(names)
        if unseen.any() and len(self.keys) + int(unseen.sum()) > _CACHE_PIECES:
            self._forget()
            at, unseen = self._find(names)
        if unseen.any():
            where = np.full(len(names), -1)
            where[code[::-1]] = np.arange(len(code))[::-1]  # a place of each distinct piece
            new = np.flatnonzero(unseen)
            new = new[np.argsort(names[new])]
            raw = data.tobytes()
            self._learn(names[new], [raw[starts[i] : ends[i]].decode() for i in where[new].tolist()])
            at, _ = self._find(names)
        piece = self.number[at][code] if len(code) else np.zeros(0, np.int64)
        sizes = (self.starts[1:] - self.starts[:-1])[piece]
        filled = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[piece] - (filled - sizes), sizes) + np.arange(int(sizes.sum()))]
        return ids, np.r_[0, filled][np.searchsorted(row, np.arange(len(texts) + 1))]

    def _find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash among the known ones, and whether it is not there."""
        if not len(self.keys):
            return np.zeros(len(names), np.int64), np.ones(len(names), bool)
        at = np.minimum(np.searchsorted(self.keys, names), len(self.keys) - 1)
        return at, self.keys[at] != names


def text_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with pieces of ASCII alone in lower case; start, end and row of
    each piece."""
    data, offsets = text_bytes(texts)
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return data, starts, ends, row
    special = np.r_[(data[:-1] == 60) & (data[1:] == 124), False]  # <|
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    other = (data > 32) & (data < 127) & ~letter
    border = np.r_[False, letter[:-1] & other[1:] | other[:-1] & letter[1:]]
    border &= ~_inside(starts, ends, special | (data == 39))
    cuts = np.flatnonzero(border)
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        row = np.searchsorted(offsets, starts, "right") - 1
    # other characters and special tokens stay as they are
    return np.where(_inside(starts, ends, special | (data >= 128)), data, LOWER[data]), starts, ends, row


def _inside(starts: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Mask of the bytes of the spans that hold a marked byte."""
    at = np.flatnonzero(marks)
    hit = np.zeros(len(starts), bool)
    if len(at):
        span = np.searchsorted(starts, at, "right") - 1
        hit[span[span >= 0]] = True
    steps = np.zeros(len(marks) + 1, np.int8)
    np.add.at(steps, starts[hit], 1)
    np.add.at(steps, ends[hit], -1)
    return np.cumsum(steps[:-1], dtype=np.int8) > 0


@lru_cache(maxsize=1)
def roller() -> Roller:
    return Roller(21)


@lru_cache(maxsize=2)
def encoder_for(path: str) -> WordEncoder:
    """The worker's encoder, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def cut_pieces(batches, encoder: WordEncoder, capacity: int, end_id: int, with_ids: bool):
    """The pieces of the batches' documents (doc_id, text and perhaps _place), slice by slice."""
    for batch in slices(batches, limit=SMALL_SLICE):
        ids, offsets = encoder.encode(batch.column("text"))
        sizes = np.diff(offsets) + 1
        n_pieces = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), n_pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = piece * capacity
        length = np.minimum(capacity, sizes[doc] - start)
        tail = np.zeros(len(sizes) and int(sizes.sum()), "<u4")
        keep = np.ones(len(tail), bool)
        ends = np.cumsum(sizes) - 1
        keep[ends] = False
        tail[keep], tail[ends] = ids, end_id
        at = (ends - sizes + 1)[doc] + start
        raw = memoryview(tail).cast("B")
        crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())), np.int64, len(at))
        columns = [batch.column("doc_id").take(pa.array(doc)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.r_[at, len(tail)], pa.int32()), pa.array(tail.astype(np.int32))))
            names.append("ids")
        if "_place" in batch.schema.names:
            columns.append(batch.column("_place").take(pa.array(doc)))
            names.append("_place")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text", place: Column | None = None,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: doc_id, piece, start,
    length, ids_crc32 (little-endian unsigned 32-bit ids), the ids
    themselves unless ``with_ids`` is off, and _place (BIGINT) if ``place`` is given.

    NULL text is an empty text: one piece with the end id alone.  Other columns
    of ``docs`` are not read.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "") + (", _place long" if place is not None else "")
    run = lambda batches: cut_pieces(batches, encoder_for(tokenizer), capacity, end_id, with_ids)
    places = [] if place is None else [place.cast("long").alias("_place")]
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *places).mapInArrow(run, schema)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset, pieces per
    sequence): the pieces of ``length`` with ranks from ``first rank`` on fill
    consecutive sequences from ``first sequence``, so many in each, side by side
    from ``offset``.  ``counts``: number of pieces by length, 1..capacity."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank, runs, made = dict.fromkeys(left, 0), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many)
    order: list[int] = []

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def put(length: int, first: int, n: int, offset: int, per: int = 1) -> None:
        runs.append((length, rank[length], n, first, offset, per))
        rank[length] += n
        left[length] -= n

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    partners = sorted(n for n in large if 2 * n <= capacity)
    for big in [n for n in large if 2 * n > capacity]:
        while left[big]:
            fits = [p for p in partners if left[p] and p + big <= capacity]
            n = min(left[big], left[fits[-1]]) if fits else left[big]
            put(big, made, n, 0)
            if fits:
                put(fits[-1], made, n, big)
            free(capacity - big - (fits[-1] if fits else 0), made, n)
            made += n
    open_one = None  # a sequence with one piece above a third, still without its second
    for mid in reversed(partners):
        if open_one and left[mid]:
            put(mid, open_one[0], 1, open_one[1])
            free(capacity - open_one[1] - mid, open_one[0], 1)
            open_one = None
        pairs = left[mid] // 2
        if pairs:
            put(mid, made, 2 * pairs, 0, 2)
            free(capacity - 2 * mid, made, pairs)
            made += pairs
        if left[mid]:
            put(mid, made, 1, 0)
            open_one = (made, mid)
            made += 1
    if open_one:
        free(capacity - open_one[1], open_one[0], 1)
    for small in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[small]:
            at = bisect_left(order, small)
            if at == len(order):
                per = capacity // small
                full, rest = divmod(left[small], per)
                if full:
                    put(small, made, full * per, 0, per)
                    free(capacity - per * small, made, full)
                    made += full
                if rest:
                    put(small, made, rest, 0, rest)
                    free(capacity - rest * small, made, 1)
                    made += 1
                continue
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            per = gap // small
            full, rest = divmod(left[small], per)
            used = min(n, full)
            if used:
                put(small, first, used * per, capacity - gap, per)
                free(gap - per * small, first, used)
            if used < n and rest:
                put(small, first + used, rest, capacity - gap, rest)
                free(gap - rest * small, first + used, 1)
                used += 1
            free(gap, first + used, n - used)
    return runs


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, piece, length, ids_crc32, ...).

    ``pieces`` is read three times: stage it first.  Deterministic: pieces of
    one length are ranked by a hash of (doc_id, piece), then by all their
    columns; equal rows are interchangeable.  With a column ``_place`` they are
    ranked by it, so that a length's sequences fill in that order.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    salts = salts or max(16, shuffle_partitions(spark), total // 20_000)
    runs = np.array(sorted(plan_sequences(counts, capacity)), np.int64).reshape(-1, 6)
    span = 1 << 44
    shared = spark.sparkContext.broadcast((runs[:, 0] * span + runs[:, 1], runs))
    order = ["doc_id", "piece", "start", "ids_crc32"]
    if "_place" in pieces.columns:
        salted = pieces.withColumn("_salt", F.shiftright("_place", BLOCK_BITS))
        order = ["_place", *order]
    else:
        salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    ranked = salted_rank(salted, ["length"], "_salt", order, "_rank").drop("_salt")
    fields = [f for f in ranked.schema.fields if f.name != "_rank"]
    names = [f.name for f in fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def place(batches):
        keys, table = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            run = np.searchsorted(keys, length * span + rank, "right") - 1
            k = rank - table[run, 1]
            sequence = table[run, 3] + k // table[run, 5] if len(run) else rank
            offset = table[run, 4] + length * (k % table[run, 5]) if len(run) else rank
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def numbered_by_place(packed: DataFrame) -> DataFrame:
    """``packed`` with its sequences numbered anew, by the smallest _place of their
    pieces; _place is dropped.  Reads ``packed`` twice: stage it first."""
    firsts = packed.groupBy("sequence_id").agg(F.min("_place").alias("_first")).withColumn("_salt", F.shiftright("_first", BLOCK_BITS))
    numbers = salted_rank(firsts, [], "_salt", ["_first", "sequence_id"], "_number").select(F.col("sequence_id").alias("_old"), "_number")
    joined = packed.join(numbers, packed.sequence_id == numbers._old)
    return joined.select(*[F.col("_number").alias(c) if c == "sequence_id" else packed[c] for c in packed.columns if c != "_place"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True, **columns) -> DataFrame:
    """Pieces of ``docs`` with their sequence and place; with ids unless switched off.

    With ``place`` (a BIGINT column of ``docs``) documents of a length are packed in
    its order, and sequences are numbered by their first piece's.

    A document of up to ``capacity`` ids (its end id included) stays whole.
    Empty input gives no rows; repeated rows are packed as often as they occur.
    """
    pieces = token_pieces(docs, tokenizer, capacity, with_ids=with_ids, **columns)
    packed = assign_sequences(stage(pieces, "pieces"), capacity)
    return packed if columns.get("place") is None else numbered_by_place(stage(packed, "packed"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (needs the ids)."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
