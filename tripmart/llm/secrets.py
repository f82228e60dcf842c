"""Secret scan over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams
that any match must contain (lower-cased, so that one index serves rules with
and without case).  Documents are indexed block by block: postings of the
trigrams that the rules ask for.  A rule's postings are intersected and united
as its query says, and only the documents left are scanned by its expression.  A
rule without a mandatory trigram scans every document.

Blocks travel with their texts, so the scan needs no shuffle and a lost task is
simply run again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from re import _parser as sre

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import LOWER, SMALL_SLICE, slices, text_bytes

_MANY = 64  # strings kept apart while deriving a query


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False


#: Kinds of the contract, in its order (fixed values).  A run of 32 hex digits or
#: more is what is left of `[0-9a-f]+` after shorter matches are dropped.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 16),
    SecretRule("hex", r"[0-9a-f]{32,}", 32),
)
#: A private key with its body: to its END line, or, where that is missing, over its
#: header fields and the base64 after them.  Line breaks may be written as \\n, lines
#: be quoted; a short piece counts where it fills its line.
_BREAK = r"(?:[\n\r]|\\[nr])"
_BASE64 = r"[A-Za-z0-9+/=]"
_KEY_BODY = (
    r"(?:(?:(?!-----)[\x00-\U0010FFFF])*+-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:{_BREAK}++[A-Za-z-]+:\x20(?:(?!\\[nr])[^\n\r])*+)*+"
    rf"""(?:(?:\s|\\[nrt]|["',+>\#])*+(?:{_BASE64}{{16,}}+|(?:(?<=[\n\r])|(?<=\\[nr])|(?<=[\n\r"'>\#\x20][\x20"'>\#])){_BASE64}++(?=["',\x20\t]*+(?:{_BREAK}|\Z))))*+)"""
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----" + _KEY_BODY),
    SecretRule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("live_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# --- Boolean trigram queries: None (no condition), a trigram, ("and"|"or", parts) ----


def _join(kind: str, parts: list):
    if kind == "or" and any(p is None for p in parts):
        return None
    parts = sorted({p for p in parts if p is not None}, key=repr)
    return None if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _of_strings(strings: set[str]):
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(nodes) -> tuple[set[str] | None, object]:
    """(all strings it can match, or None; query)."""
    run, found, whole = {""}, [], True
    for op, value in nodes:
        exact, query = _node(str(op), value)
        if exact is not None and len(run) * len(exact) <= _MANY:
            run = {a + b for a in run for b in exact}
            continue
        found += [_of_strings(run), query if exact is None else _of_strings(exact)]
        run, whole = {""}, False
    if whole:
        return run, None
    return None, _join("and", [*found, _of_strings(run)])


def _node(op: str, value) -> tuple[set[str] | None, object]:
    if op == "LITERAL":
        return {chr(value).lower()}, None
    if op == "IN":
        chars: set[str] = set()
        for kind, x in value:
            if str(kind) == "LITERAL":
                chars.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < _MANY:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None, None
        return (chars, None) if len(chars) <= 6 else (None, None)
    if op == "SUBPATTERN":
        return _walk(value[-1])
    if op == "BRANCH":
        parts = [_walk(x) for x in value[1]]
        if all(e is not None for e, _ in parts):
            return set().union(*(e for e, _ in parts)), None
        return None, _join("or", [q if e is None else _of_strings(e) for e, q in parts])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = value
        exact, query = _walk(body)
        if high == 1 and exact is not None:
            return exact | {""}, None
        if exact is not None and low == high and len(exact) == 1:
            return {next(iter(exact)) * low}, None
        return None, None if low == 0 else query if exact is None else _of_strings(exact)
    if op == "AT":
        return {""}, None
    return None, None


def trigram_query(pattern: str):
    """The query that every match of ``pattern`` satisfies; None: scan fully."""
    exact, query = _walk(sre.parse(pattern))
    return query if exact is None else _of_strings(exact)


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(p) for p in query[1]))


class BlockIndex:
    """Postings of one block of texts for a fixed set of trigrams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: tuple[str, ...]):
        self.rows = len(offsets) - 1
        self.number = {t: i for i, t in enumerate(vocabulary)}
        low = LOWER[data].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        known = trigram_table(vocabulary)[code]
        at = np.flatnonzero(known)
        self.postings = np.zeros((len(vocabulary), self.rows), bool)
        self.postings[known[at] - 1, np.searchsorted(offsets, at, "right") - 1] = True

    def select(self, query) -> np.ndarray:
        """Rows that satisfy the query (a superset of the rows with a match)."""
        if query is None:
            return np.ones(self.rows, bool)
        if isinstance(query, str):
            return self.postings[self.number[query]]
        parts = [self.select(p) for p in query[1]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


@lru_cache(maxsize=4)
def trigram_table(vocabulary: tuple[str, ...]) -> np.ndarray:
    """Number (from 1) of each trigram of the vocabulary, by its three bytes."""
    table = np.zeros(1 << 24, np.uint8 if len(vocabulary) < 256 else np.uint16)
    for i, t in enumerate(vocabulary):
        a, b, c = t.encode("latin-1")
        table[a << 16 | b << 8 | c] = i + 1
    return table


def spans_of(text: str, rule: SecretRule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Code-point spans of a rule's matches, leftmost and non-overlapping."""
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _compile(rule: SecretRule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))


def scan_batch(texts: pa.Array, rules: tuple[SecretRule, ...]) -> list[list[tuple[int, int, int]]]:
    """For every text the spans (start, number of the rule, end), sorted."""
    queries = [trigram_query(r.pattern) for r in rules]
    vocabulary = tuple(sorted(set().union(*map(trigrams_of, queries))))
    index = BlockIndex(*text_bytes(texts), vocabulary)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    decoded: dict[int, str] = {}
    for n, (rule, query) in enumerate(zip(rules, queries)):
        compiled = _compile(rule)
        for i in np.flatnonzero(index.select(query)).tolist():
            if i not in decoded:
                decoded[i] = texts[i].as_py() or ""
            found[i] += [(a, n, b) for a, b in spans_of(decoded[i], rule, compiled)]
    return [sorted(x) for x in found]


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans array<struct<start, rule, end, kind>> in code points, by start
    and then by the rules' order.  NULL and empty texts have none."""
    schema = "doc_id long, spans array<struct<start:int,rule:int,end:int,kind:string>>"
    kind = pa.struct([("start", pa.int32()), ("rule", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches):
        for batch in slices(batches, limit=SMALL_SLICE):
            found = scan_batch(batch.column("text"), rules)
            spans = [[{"start": a, "rule": n, "end": b, "kind": rules[n].kind} for a, n, b in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def redacted(batches, rules: tuple[SecretRule, ...], text: str):
    """The batches with every secret span of ``text`` replaced, slice by slice."""
    for batch in slices(batches, text, SMALL_SLICE):
        at = batch.schema.get_field_index(text)
        values = batch.column(at)
        changed = {}
        for i, spans in enumerate(scan_batch(values, rules)):
            if spans:
                whole, out, end = values[i].as_py(), [], 0
                for a, n, b in spans:
                    if a >= end:
                        out += [whole[end:a], f"[{rules[n].kind}]"]
                    end = max(end, b)
                changed[i] = "".join([*out, whole[end:]])
        if changed:
            mask = np.zeros(len(values), bool)
            mask[list(changed)] = True
            values = pa.compute.replace_with_mask(values, pa.array(mask), pa.array(list(changed.values()), values.type))
        yield batch.set_column(at, batch.schema.field(at), values)


def redact(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with every secret span replaced by ``[kind]``; overlapping spans
    become one, named after the first.  All other columns pass unchanged.

    NULL and empty texts stay as they are; rows that repeat change alike; an empty table
    stays empty.  A text of any length is scanned whole."""
    return docs.mapInArrow(lambda batches: redacted(batches, rules, text), docs.schema)
