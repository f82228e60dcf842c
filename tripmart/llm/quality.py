"""Quality rules as a short-circuit cascade.

Each rule is one Column: true rejects the document.  A bounded sample gives
every rule's cost (seconds, net of a job's start and of the split into words) and
selectivity (share rejected); the rules then run in the order of rejection per cost,
nested so that a rejected document meets no later rule.  A text is split once, for all
rules.  The order changes the work, never the verdict.

DataFrame functions only; whole texts; NULL is a text without words.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SAMPLE_ROWS = 2000
#: Characters that count as symbols (fixed value of the contract).
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    """The words of a text (array of strings)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.transform(F.array(lines), lambda v: F.size(v) - F.size(F.array_distinct(v)))[0].cast("long")


def n_symbols(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return (F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long")


def word_chars(ws: Column) -> Column:
    return F.char_length(F.array_join(ws, "")).cast("long")


def n_repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash.  Sorting (high bits of the hash, place)
    as one number brings equal windows together; neighbours count when their
    whole hashes agree.  n log n for any text.
    """

    def let(value: Column, body: Callable[[Column], Column]) -> Column:
        return F.transform(F.array(value), body)[0]

    def covered(keys: Column, low: Column) -> Column:
        place = lambda x: x.bitwiseAND(low).cast("int")
        high = lambda x: x.bitwiseAND(F.bitwise_not(low))
        equal = lambda s, x, i: F.coalesce((high(x) == high(F.get(s, i))) & (F.get(keys, place(x)) == F.get(keys, place(F.get(s, i)))), F.lit(False))
        packed = F.sort_array(F.transform(keys, lambda h, i: high(h).bitwiseOR(i.cast("long"))))
        twice = lambda s: F.filter(F.transform(s, lambda x, i: F.when(equal(s, x, i - 1) | equal(s, x, i + 1), place(x))), lambda x: x.isNotNull())
        spread = lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x)
        return let(packed, lambda s: let(F.sort_array(twice(s)), spread))

    def bits(keys: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(F.size(keys) + 1)).cast("int")) - 1

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    windows = lambda h: F.transform(F.slice(h, 1, F.greatest(F.lit(0), F.size(h) - 2)), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
    any_twice = lambda k: F.size(k) != F.size(F.array_distinct(k))
    count = lambda k: F.when(any_twice(k), let(bits(k), lambda low: covered(k, low))).otherwise(F.lit(0).cast("long"))
    return let(hashes, lambda h: let(windows(h), count))


def measures(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (a prefix keeps them apart from columns of the same name)."""
    split = docs.withColumn(f"{prefix}_words", words(F.col(text)))
    ws = F.col(f"{prefix}_words")
    return split.withColumns({
        f"{prefix}n_words": F.size(ws).cast("long"),
        f"{prefix}word_chars": word_chars(ws),
        f"{prefix}n_symbols": n_symbols(F.col(text)),
        f"{prefix}n_dup_lines": n_dup_lines(F.col(text)),
        f"{prefix}n_repeat_words": n_repeat_words(ws),
    }).drop(f"{prefix}_words")


@dataclass(frozen=True)
class Rule:
    """``reject(m)`` builds the condition from ``m``, a function giving the Column
    of a measure."""

    name: str
    reject: Callable[[Callable[[str], Column]], Column]


#: The contract's two rules, then mild ones that clean prose passes.
RULES = (
    Rule("few_words", lambda m: m("n_words") < 50),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
    Rule("repeated_lines", lambda m: (m("n_dup_lines") >= 5) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
)


def _lazy(text: Column, ws: Column | None = None) -> Callable[[str], Column]:
    """Measures as expressions over the text and its words."""
    ws = words(text) if ws is None else ws
    made = {
        "n_words": lambda: F.size(ws),
        "word_chars": lambda: word_chars(ws),
        "n_symbols": lambda: n_symbols(text),
        "n_dup_lines": lambda: n_dup_lines(text),
        "n_repeat_words": lambda: n_repeat_words(ws),
        "n_lines": lambda: F.size(F.split(F.coalesce(text, F.lit("")), "\n")),
    }
    return lambda name: made[name]()


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost on about ``sample_rows`` rows (a bounded sample
    by a hash of the text; it decides the order of work only).

    A rule's cost is the better of two runs over the sample, less that of a run
    without a rule, in steps of two, so that noise seldom changes the order; equal
    scores keep the order of ``rules``."""
    total = docs.count()
    if not total:
        return list(rules)
    every = max(1, total // sample_rows)
    sample = docs.select(F.col(text).alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(every)) == 0).limit(2 * sample_rows)
    sample = sample.withColumn("ws", words(F.col("t"))).persist()
    try:
        n, m = max(1, sample.count()), _lazy(F.col("t"), F.col("ws"))

        def timed(condition: Column) -> tuple[float, int]:
            began = time.perf_counter()
            hits = sample.agg(F.count_if(condition)).first()[0]
            return time.perf_counter() - began, hits

        start = min(timed(F.size("ws") < 0)[0] for _ in range(2))
        scores = []
        for rule in rules:
            runs = [timed(rule.reject(m)) for _ in range(2)]
            cost = max(1e-3, min(t for t, _ in runs) - start)
            scores.append(runs[0][1] / n / 2 ** round(math.log2(cost)))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(zip(scores, rules), key=lambda x: -x[0])]


def cascade(order: list[Rule], m: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, NULL for a document that is kept."""
    out = F.lit(None).cast("string")
    for rule in reversed(order):
        out = F.when(F.coalesce(rule.reject(m), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Documents that no rule rejects, with the columns of ``docs`` and no others.

    NULL and empty texts have no words and are rejected by the rule on few words; rows
    that repeat stay or go together; an empty table stays empty.  Only the column of the
    text is read, so names cannot clash."""
    order = rule_order(docs, rules, text)
    # the words are bound once; every branch of the cascade uses them
    why = F.transform(F.array(words(F.col(text))), lambda ws: cascade(order, _lazy(F.col(text), ws)))
    return docs.filter(F.get(why, F.lit(0)).isNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base measures, base_failed, kept.

    Empty and NULL texts have no words and fail ``few_words``.  Each row is
    judged alone, so ties and repeated rows get equal verdicts.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    order = rule_order(rows, rules, "_text")
    known = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    lazy = _lazy(F.col("_text"))
    m = lambda name: known[name] if name in known else lazy(name)
    measured = measures(rows, "_text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select("doc_id", *known, failed.alias("base_failed"), (~failed & cascade(order, m).isNull()).alias("kept"))
