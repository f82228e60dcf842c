"""CSV whose quoted fields hold line breaks, read by many tasks a file (S1, trap 22).

Spark's ``multiLine`` reader gives a file to one task, because whether a line break
ends a record depends on all quotes before it.  Here the lines of a file are read in
ranges, as any text:

1. A range is reduced to where it leads: outside or inside a quoted field, once if it
   begins outside and once if it begins inside.  That is a function on two states; it
   holds them, swaps them or forgets them.
2. Such functions compose.  A window over the ranges of a file, one small row each,
   gives the state in which every range begins.
3. Ranges are read again from their true state and cut into records.  A record that
   lies across ranges leaves a fragment in each; the fragments are joined by place.
4. Records are parsed by ``from_csv``, the parser of Spark's own reader.

As there, a file's first line tells whether its records end in ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import staged

CORRUPT = "_corrupt_record"
WHOLE, HEAD, TAIL, THROUGH = "whole", "head", "tail", "through"


class Lines:
    """What a line does to the state, for one delimiter; quotes are ``"``, doubled to be
    meant."""

    def __init__(self, sep: str = ","):
        self.sep = sep
        s = re.escape(sep)
        # a line of well-formed fields, none left open
        self.closed = re.compile(rf'(?:"(?:[^"]|"")*"|[^"{s}][^{s}]*|)(?:{s}(?:"(?:[^"]|"")*"|[^"{s}][^{s}]*|))*\r?')

    def leads_inside(self, line: str, inside: bool) -> bool:
        """Whether the line break after ``line`` lies inside a quoted field."""
        if '"' not in line:
            return inside
        if not inside and self.closed.fullmatch(line):
            return False
        at, n = 0, len(line)
        while True:
            if not inside and (at >= n or line[at] != '"'):  # an unquoted field: quotes mean nothing
                at = line.find(self.sep, at)
                if at < 0:
                    return False
                at += len(self.sep)
                continue
            at += not inside
            while True:  # to the closing quote
                at = line.find('"', at)
                if at < 0:
                    return True
                if line[at + 1 : at + 2] != '"':
                    break
                at += 2
            inside = False
            # after it only a delimiter is in place; anything else makes the field an unquoted one
            at = line.find(self.sep, at + 1)
            if at < 0:
                return False
            at += len(self.sep)


def _text(spark: SparkSession, path, base_path: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if base_path:
        reader = reader.option("basePath", base_path)
    lines = reader.text(path)
    return lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """(file, start), lines of each piece of a range, in order."""
    for batch in batches:
        files, starts, values = (batch.column(n) for n in ("_file", "_start", "value"))
        places = list(zip(files.to_pylist(), starts.to_pylist()))
        cuts = [i for i in range(len(places)) if not i or places[i] != places[i - 1]]
        for a, b in zip(cuts, [*cuts[1:], len(places)]):
            yield places[a], values.slice(a, b - a).to_pylist()


def range_functions(lines: DataFrame, sep: str = ",") -> DataFrame:
    """_file, _start, whether a range leads inside a quoted field when it begins outside
    (``from_out``) or inside (``from_in``), and for the first range of a file whether
    its first line ends in ``\\r\\n`` (``returns``)."""

    def run(batches):
        rule, now, states, returns = Lines(sep), None, (False, True), None
        for place, texts in _ranges(batches):
            if place != now:
                if now is not None:
                    yield row(now, states, returns)
                now, states, returns = place, (False, True), texts[0].endswith("\r") if place[1] == 0 else None
            for line in texts:
                states = tuple(rule.leads_inside(line, s) for s in states)
        if now is not None:
            yield row(now, states, returns)

    def row(place, states, returns):
        values = (*place, *states, returns)
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, values))], schema=schema)

    schema = pa.schema([("_file", pa.string()), ("_start", pa.int64()), ("from_out", pa.bool_()), ("from_in", pa.bool_()), ("returns", pa.bool_())])
    return lines.select("_file", "_start", "value").mapInArrow(run, "_file string, _start long, from_out boolean, from_in boolean, returns boolean")


def begin_states(functions: DataFrame) -> DataFrame:
    """Adds ``begins_inside``: the functions of all ranges before, composed.

    A range that forgets its state leads to one place; from the last of them on only the
    swaps count."""
    by_place = Window.partitionBy("_file").orderBy("_start")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    forgets = F.col("from_out") == F.col("from_in")
    swaps = (F.col("from_out") & ~F.col("from_in")).cast("long")
    rows = functions.withColumns({"_forgets": forgets, "_swaps": F.sum(swaps).over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    last = lambda c: F.last(F.when(F.col("_forgets"), F.col(c)), ignorenulls=True).over(before)
    rows = rows.withColumns({"_led": F.coalesce(last("from_out"), F.lit(False)), "_at": F.coalesce(last("_swaps"), F.lit(0)), "_sum": F.coalesce(F.max("_swaps").over(before), F.lit(0))})
    odd = (F.col("_sum") - F.col("_at")) % 2 == 1
    return rows.withColumn("begins_inside", F.col("_led") != odd).drop("_forgets", "_swaps", "_led", "_at", "_sum")


def read_quoted(
    spark: SparkSession, path, base_path: str | None = None, sep: str = ",", keep_corrupt: bool = False, files: list[str] | None = None,
) -> DataFrame:
    """Header CSV as text columns, named by the first file's header, with the partition
    columns of the folders and ``_source_path``; every file has a header.  ``files``
    limits the read to some of the paths.

    Equal to ``spark.read`` with ``header``, ``multiLine`` and ``escape='"'``, but a large
    file is read by many tasks.  ``files`` limits the read to some of the paths.  Lines
    are read three times at most (the third time only files in which a range ends inside
    a field); the driver keeps the place and state of each range, as many as it lists to
    plan a scan.  A record must fit a task's memory, a header the first range.  Files,
    and the settings that cut them into ranges, must stay as they are until the result is
    read; a range that was not there before is an error."""
    options = {"header": True, "multiLine": True, "escape": '"', "sep": sep}
    reader = spark.read.options(**options)
    schema = (reader.option("basePath", base_path) if base_path else reader).csv(path).schema
    lines = _text(spark, path, base_path)
    if files is not None:
        lines = lines.filter(F.col("_file").isin(files))
    folders = [c for c in lines.columns if c not in ("value", "_file", "_start")]
    states = staged(begin_states(range_functions(lines, sep)), "csv-ranges")  # a small row a range
    known: dict[str, dict[int, int]] = {}
    torn = set()
    for r in states.collect():  # a row a range that Spark lists
        known.setdefault(r["_file"], {})[r["_start"]] = 2 * bool(r["returns"]) + r["begins_inside"]
        if r["begins_inside"] or r["from_out"]:
            torn.add(r["_file"])
    ranges = spark.sparkContext.broadcast(known)
    cut = lambda some, kinds: _records(some, folders, sep, ranges, kinds)
    records = cut(lines, (WHOLE,)).select("_file", *folders, "record")
    if torn:
        parts = cut(lines.filter(F.col("_file").isin(sorted(torn))), (HEAD, TAIL, THROUGH))
        by_place = Window.partitionBy("_file").orderBy("_start", F.col("kind") == TAIL)
        numbered = parts.withColumn("_n", F.count_if(F.col("kind") == TAIL).over(by_place))
        joined = numbered.groupBy("_file", *folders, "_n").agg(F.sort_array(F.collect_list(F.struct("_start", "record"))).alias("_p"))
        records = records.unionByName(joined.select("_file", *folders, F.array_join("_p.record", "\n").alias("record")))
    data = [f.name for f in schema.fields if f.name not in folders]
    fields = T.StructType([T.StructField(c, T.StringType()) for c in data] + ([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []))
    parse = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.filter("record <> ''").withColumn("_r", F.from_csv("record", F.lit(_ddl(fields)), parse))
    return parsed.select(*[F.col("_r")[f.name].alias(f.name) for f in fields.fields], *folders, F.col("_file").alias("_source_path"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def _records(lines: DataFrame, folders: list[str], sep: str, ranges, kinds: tuple[str, ...]) -> DataFrame:
    """Records of the ranges, or the fragments of those that lie across ranges; the
    first record of a file is its header."""
    types = {f.name: f.dataType for f in lines.schema.fields}
    out_schema = pa.schema([("_file", pa.string()), ("_start", pa.int64()), ("kind", pa.string()), ("record", pa.string())])

    def run(batches):
        rule, now, parts, found = Lines(sep), None, [], []
        state = begun = first = header = returns = False

        def flush(kind):
            nonlocal header
            text = "\n".join(parts)
            parts.clear()
            skipped, header = header and kind == WHOLE, False
            if kind in kinds and not skipped:
                found.append((*now, kind, text))

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), out_schema.types)], schema=out_schema)
            found.clear()
            return made

        for place, texts in _ranges(batches):
            if place != now:
                if parts:
                    flush(THROUGH if first and begun else TAIL)
                now, file = place, ranges.value.get(place[0], {})
                if place[1] not in file:
                    raise RuntimeError(f"{place[0]} is cut into other ranges than before: read it again")
                state, returns = file[place[1]] % 2 == 1, file[min(file)] >= 2
                begun, first, header = state, True, place[1] == 0
            for line in texts:
                state = rule.leads_inside(line, state)
                parts.append(line[:-1] if returns and line.endswith("\r") else line)
                if not state:
                    flush(HEAD if first and begun else WHOLE)
                    first = False
            if found:
                yield batch()
        if parts:
            flush(THROUGH if first and begun else TAIL)
        if found:
            yield batch()

    cut = lines.select("_file", "_start", "value").mapInArrow(run, "_file string, _start long, kind string, record string")
    if not folders:
        return cut
    # the folders' values come from the file's path, as Spark lists them
    pattern = lambda c: F.regexp_extract("_file", rf"/{re.escape(c)}=([^/]*)/", 1)
    value = lambda c: F.when(pattern(c) != "__HIVE_DEFAULT_PARTITION__", F.try_url_decode(pattern(c))).cast(types[c])
    return cut.select("*", *[value(c).alias(c) for c in folders])
