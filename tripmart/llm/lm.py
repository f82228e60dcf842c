"""Scoring documents with an n-gram model kept in Elias-Fano tries.

Words (A-Z lower-cased, one end token a document) are named by 64-bit hashes and
counted over all training documents, as are all their bigrams, without pruning:

    p(t)     = (c(t) + 1) / (N + V + 1), an unknown word being one more class
    p(t | h) = a * c(h, t) / c(h) + (1 - a) * p(t), or p(t) after an unknown word

Probabilities are kept as 8-bit quanta of their logarithm (:func:`quanta`); so are
those that a bigram backs off to where it was not seen.

1. Training words are counted by shard of their hash; a word's number is its place in
   its shard after all shards before.  V and N are sums over the shards.
2. A slice of documents asks for its distinct words once, and gets numbers and counts.
3. It then asks for its distinct bigrams, dealt by both numbers, so that the
   successors of a frequent context are spread over all shards: sorted numbers
   context * V + word, as packed differences, with their counts in the slice's
   training documents.
4. A shard adds these counts up, builds an :class:`NgramTrie` of the smoothed
   probabilities, maps its levels from a file and answers all slices by successor
   search; slices add up their documents.

Only what a slice needs travels, packed, and each part once: nothing is staged but
the words, nothing that grows with the corpus is collected or broadcast.
"""

from __future__ import annotations

import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import (
    LOWER, Roller, U, mix, pack_sorted, row_bounds, shuffle_partitions, slices, stage, text_bytes, unpack_sorted, word_hashes, word_spans,
)
from tripmart.llm.elias_fano import NgramTrie

MIX = 0.7
FOLDS, HELD_OUT = 7, 2
#: A quantum of a log10 probability: 255 of them reach down to 2e-11.
STEP = 1 / 24
_SLICE = 8 << 20
_FLUSH = 2_000_000
_END = U(0x9E3779B97F4A7C15)
#: Counts that the codes 1..255 of a word's count stand for.
LEVELS = np.r_[np.arange(25), np.rint(np.geomspace(25, 1 << 36, 231))]


def coded(counts: np.ndarray) -> np.ndarray:
    """Code of the level nearest to each count, by ratio."""
    middle = np.sqrt(LEVELS[1:-1] * LEVELS[2:])
    return np.searchsorted(middle, counts) + 1


def quanta(p: np.ndarray) -> np.ndarray:
    """Quanta (1..255) of -log10 of probabilities."""
    return np.clip(np.rint(-np.log10(p) / STEP), 1, 255).astype(np.uint8)


@lru_cache(maxsize=2)
def roller(seed: int) -> Roller:
    return Roller(seed)


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[head], np.add.reduceat(counts, head)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token keys of all texts one after another (each with its end), and the row of each."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    keys = word_hashes(data, starts, ends, roller(51))
    keys[keys == _END] += U(1)
    n = len(texts)
    out_row = np.sort(np.r_[row, np.arange(n)], kind="stable")
    out = np.full(len(keys) + n, _END)
    last = np.zeros(len(out), bool)
    last[row_bounds(out_row, n)[1:] - 1] = True
    out[~last] = keys
    return out, out_row


def _by_shard(shard: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    """Slices of entries sorted by shard."""
    cut = np.searchsorted(shard, np.arange(shards + 1))
    return [(i, slice(cut[i], cut[i + 1])) for i in np.flatnonzero(np.diff(cut)).tolist()]


def word_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _counts(docs: DataFrame, keys_of, shards: int, shard_of) -> DataFrame:
    """(shard, keys, counts) packed, partly summed, of the training rows."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            keys, counts = counted(*(np.concatenate(x) for x in zip(*held))) if held else (np.zeros(0, U), np.zeros(0, np.int64))
            held.clear()
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            for i, z in _by_shard(shard, shards):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pack_sorted(keys[z])], pa.binary()), pa.array([pack(counts[z].astype("<u4"))], pa.binary())], names=["shard", "keys", "counts"])

        for batch in slices(batches, limit=_SLICE):
            train = batch.filter(pa.compute.invert(batch.column("held_out")))
            keys = keys_of(train.column("text"))
            held.append(counted(keys, np.ones(len(keys), np.int64)))
            if sum(len(k) for k, _ in held) > _FLUSH:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "shard int, keys binary, counts binary")


def _summed(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    """Shard, keys and sums of a shard's packed counts."""
    keys = [unpack_sorted(x.as_py()) for x in table["keys"]]
    counts = [unpack(x.as_py(), "<u4").astype(np.int64) for x in table["counts"]]
    return table["shard"][0].as_py(), *counted(np.concatenate(keys), np.concatenate(counts))


def count_words(docs: DataFrame, shards: int) -> tuple[DataFrame, np.ndarray, int]:
    """(word counts by shard, staged; number of each shard's first word, and V; N) from
    the training rows of ``docs`` (text, held_out)."""

    def sums(table: pa.Table) -> pa.Table:
        shard, keys, counts = _summed(table)
        return pa.table({"shard": pa.array([shard], pa.int32()), "keys": pa.array([pack_sorted(keys)], pa.binary()), "counts": pa.array([pack(counts.astype("<u8"))], pa.binary()),
                         "n": pa.array([int(counts.sum())]), "distinct": pa.array([len(keys)])})

    parts = _counts(docs, lambda texts: tokens(texts)[0], shards, word_shard)
    words = stage(parts.groupBy("shard").applyInArrow(sums, "shard int, keys binary, counts binary, n long, distinct long"), "lm-words")
    distinct, total = np.zeros(shards + 1, np.int64), 0
    for r in words.select("shard", "n", "distinct").collect():  # a row a shard
        distinct[r["shard"] + 1] = r["distinct"]
        total += r["n"]
    return words.select("shard", "keys", "counts"), np.cumsum(distinct), total


def gram_shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bigram, by both words' numbers."""
    return word_shard(mix(mix(context.astype(U) + U(1)) + word.astype(U)), shards)


def trie_of(codes: np.ndarray, counts: np.ndarray, context_codes: np.ndarray, word_codes: np.ndarray, total: int, distinct: int) -> NgramTrie:
    """The smoothed probabilities of bigrams (sorted, context * V + word) in a trie, from
    their counts and the codes of their words' counts."""
    lower = (LEVELS[word_codes] + 1) / (total + distinct + 1)
    p = MIX * np.minimum(1.0, counts / LEVELS[context_codes]) + (1 - MIX) * lower
    return NgramTrie.build((codes // U(distinct)).astype(np.int64), (codes % U(distinct)).astype(np.int64), quanta(p) * NgramTrie.STEP, distinct)


_DOCS = "array<struct<doc_id:long,held_out:boolean,n_tokens:long,n_known:long,base:double>>"
_MESSAGE = f"slice long, shard int, a binary, b binary, c binary, d binary, docs {_DOCS}"
_NAMES = ["slice", "shard", "a", "b", "c", "d", "docs"]


def _message(name: int, shard: int, *blobs: bytes | None, docs=None) -> dict:
    return dict(zip(_NAMES, (name, shard, *blobs, *[None] * (4 - len(blobs)), docs)))


def _table(rows: list[dict]) -> pa.Table:
    docs = pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64())]))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, docs]
    return pa.table({n: pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, kinds)})


def score(docs: DataFrame, shards: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    NULL and empty texts are one end token.  A NULL id counts as an empty text in the
    fold rule.  Rows that repeat an id are scored each on its own, and learned from as
    often as they occur.  Without training tokens every word is unknown.  An empty table
    gives an empty table.  Other columns are ignored.  A very long text is one slice: its
    distinct words and bigrams must fit a task.
    """
    spark = docs.sparkSession
    shards = shards or max(16, 2 * shuffle_partitions(spark))
    fold = F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), fold.alias("held_out"))
    words, first, total = count_words(rows.select("text", "held_out"), shards)
    distinct = int(first[-1])

    def read(batches):
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(slices(batches, limit=_SLICE)):
            keys, row = tokens(batch.column("text"))
            names, number = np.unique(keys, return_inverse=True)
            sizes = np.diff(row_bounds(row, batch.num_rows))
            name = part << 32 | k  # the same when the task runs again
            about = [dict(doc_id=i, held_out=h) for i, h in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist())]
            out = [_message(name, -1, pack_sorted(names), pack(number.astype("<u4")), pack(sizes.astype("<u4")), docs=about)]
            out += [_message(name, i, pack_sorted(names[z])) for i, z in _by_shard(word_shard(names, shards), shards)]
            yield from _table(out).to_batches()

    def answer_words(table: pa.Table) -> pa.Table:
        own, counts = np.zeros(0, U), np.zeros(0, np.int64)
        for s, a, b in zip(table["slice"], table["a"], table["b"]):
            if not s.is_valid:
                own, counts = unpack_sorted(a.as_py()), unpack(b.as_py(), "<u8").astype(np.int64)
        out, shard = [], table["shard"][0].as_py()
        for s, a in zip(table["slice"], table["a"]):
            if s.is_valid:
                keys = unpack_sorted(a.as_py())
                at = np.minimum(np.searchsorted(own, keys), max(0, len(own) - 1))
                hit = own[at] == keys if len(own) else np.zeros(len(keys), bool)
                out.append(_message(s.as_py(), shard, np.packbits(hit).tobytes(), pack_sorted(at[hit].astype(U)), pack(counts[at[hit]].astype("<u8"))))
        return _table(out)

    def ask_grams(table: pa.Table) -> pa.Table:
        shard = table["shard"].to_numpy()
        mine = int(np.flatnonzero(shard < 0)[0])
        name, about = table["slice"][mine].as_py(), table["docs"][mine].as_py()
        keys = unpack_sorted(table["a"][mine].as_py())
        token, sizes = (unpack(table[c][mine].as_py(), "<u4").astype(np.int64) for c in ("b", "c"))
        number, count = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        places = dict(_by_shard(word_shard(keys, shards), shards))
        for i, a, b, c in zip(shard.tolist(), table["a"], table["b"], table["c"]):
            if i >= 0:
                z = places[i]
                hit = np.unpackbits(np.frombuffer(a.as_py(), np.uint8), count=z.stop - z.start).astype(bool)
                number[z][hit] = first[i] + unpack_sorted(b.as_py()).astype(np.int64)
                count[z][hit] = unpack(c.as_py(), "<u8")
        row = np.repeat(np.arange(len(sizes)), sizes)
        held = np.array([d["held_out"] for d in about], bool)
        ends = np.cumsum(sizes)
        context = np.r_[0, token[:-1]][: len(token)]
        context[ends - sizes] = np.searchsorted(keys, _END)  # a text begins after an end
        n = U(max(1, len(keys)))
        grams, gram = np.unique(context.astype(U) * n + token.astype(U), return_inverse=True)
        c, w = (grams // n).astype(np.int64), (grams % n).astype(np.int64)
        size = total + distinct + 1
        back = quanta(np.where(count[c] > 0, 1 - MIX, 1.0) * (count[w] + 1) / size)
        known = (number[c] >= 0) & (number[w] >= 0)
        code = np.where(known, number[c].astype(U) * U(max(1, distinct)) + number[w].astype(U), U(0))
        to = np.where(known, gram_shard(number[c], number[w], shards), shards)
        order = np.lexsort((code, to))
        trained = np.bincount(gram[~held[row]], minlength=len(grams))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_gram = np.argsort(place[gram], kind="stable")
        uses = np.bincount(gram, minlength=len(grams))[order]
        base = np.bincount(row, np.log10(count[token] + 1) - np.log10(size), len(sizes))
        found = np.bincount(row, count[token] > 0, len(sizes)).astype(int)
        full = [dict(d, n_tokens=int(t), n_known=int(f), base=float(x)) for d, t, f, x in zip(about, sizes.tolist(), found.tolist(), base.tolist())]
        out = [_message(name, -1, pack(uses.astype("<u4")), pack(row[by_gram].astype("<u4")), pack(back[order]), docs=full)]
        for i, z in _by_shard(to[order], shards):
            at = order[z]
            out.append(_message(name, i, pack_sorted(code[at]), pack(trained[at].astype("<u4")), pack(coded(count[c[at]]).astype(np.uint8)), pack(coded(count[w[at]]).astype(np.uint8))))
        return _table(out)

    def answer_grams(table: pa.Table) -> pa.Table:
        asked = [unpack_sorted(x.as_py()) for x in table["a"]]
        codes = np.concatenate(asked)
        counts, context, word = (np.concatenate([unpack(x.as_py(), t) for x in table[c]]) for c, t in (("b", "<u4"), ("c", np.uint8), ("d", np.uint8)))
        some = np.flatnonzero(counts)
        seen, at = np.unique(codes[some], return_index=True)
        sums = np.bincount(np.searchsorted(seen, codes[some]), counts[some], len(seen))
        built = trie_of(seen, sums, context[some][at], word[some][at], total, distinct)
        out = []
        with tempfile.TemporaryFile() as file:  # the levels, mapped while this task asks them
            file.write(built.to_bytes())
            file.flush()
            trie = NgramTrie.read(np.memmap(file, np.uint8, "r"))
            for name, shard, mine in zip(table["slice"].to_pylist(), table["shard"].to_pylist(), asked):
                q = trie.lookup((mine // U(distinct)).astype(np.int64), (mine % U(distinct)).astype(np.int64))
                out.append(_message(name, shard, pack(np.rint(q / NgramTrie.STEP).astype(np.uint8))))
        return _table(out)

    def finish(table: pa.Table) -> pa.Table:
        shard = table["shard"].to_numpy()
        mine = int(np.flatnonzero(shard < 0)[0])
        uses, row = (unpack(table[c][mine].as_py(), "<u4").astype(np.int64) for c in ("a", "b"))
        value = unpack(table["c"][mine].as_py(), np.uint8).astype(np.int64)
        answers = [unpack(table["a"][int(i)].as_py(), np.uint8) for i in np.argsort(shard, kind="stable") if shard[i] >= 0]
        if answers:
            q = np.concatenate(answers)
            value[: len(q)] = np.where(q > 0, q, value[: len(q)])
        about = table["docs"][mine].as_py()
        value = -STEP * np.bincount(row, np.repeat(value, uses), len(about))
        columns = {n: pa.array([d[k] for d in about], t) for n, k, t in (("doc_id", "doc_id", pa.int64()), ("held_out", "held_out", pa.bool_()), ("n_tokens", "n_tokens", pa.int64()), ("n_known", "n_known", pa.int64()))}
        return pa.table({**columns, "train_tokens": pa.array(np.full(len(about), total)), "base_score": pa.array([d["base"] for d in about], pa.float64()), "score": pa.array(value)})

    asked = rows.mapInArrow(read, _MESSAGE)
    null = lambda c, t: F.lit(None).cast(t).alias(c)
    held = words.select(null("slice", "long"), "shard", F.col("keys").alias("a"), F.col("counts").alias("b"), null("c", "binary"), null("d", "binary"), null("docs", _DOCS))
    numbers = asked.filter("shard >= 0").unionByName(held).groupBy("shard").applyInArrow(answer_words, _MESSAGE)
    middle = asked.filter("shard < 0").unionByName(numbers).groupBy("slice").applyInArrow(ask_grams, _MESSAGE)
    answers = middle.filter("shard >= 0").groupBy("shard").applyInArrow(answer_grams, _MESSAGE)
    parts = middle.filter("shard < 0").unionByName(answers)
    return parts.groupBy("slice").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
