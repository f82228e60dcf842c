"""Deterministic natural-key deduplication.

The survivor per key is the smallest row under an explicit order: rows that
pass the quality rules first, then the newest ingestion, then every remaining
column ascending with NULLs last.  With all columns in the order the choice is
total, so a recomputation after a lost executor picks the same row.

It is computed as ``groupBy(key).agg(min(struct(order..., row...)))``: an
aggregate with a map-side partial step, so a key holding a third of all rows
is reduced to one row per map task before the shuffle.  A
``row_number()`` window would instead sort that whole key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import NATURAL_KEY
from tripmart.session import TASK_ROWS, tasks_for

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def dedup(
    df: DataFrame,
    keys=NATURAL_KEY,
    prefer: str | None = "_dq_passed",
    newest: str | None = "_ingestion_timestamp",
    copies: str | None = None,
) -> DataFrame:
    """One row per ``keys``; NULL key values group together.

    ``prefer``: boolean column, TRUE rows win (skipped if absent).
    ``newest``: ISO timestamp text or timestamp column, latest wins.
    ``copies``: adds a column with the number of rows each survivor stands for.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    fields, unorderable = order_fields(df, keys, prefer, newest)
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not unorderable:
        # The order struct already holds every value: rebuild the row from it.
        best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"), *counted)
        out = _row("_best", rest)
    else:
        row = F.struct(*[F.col(c) for c in rest])
        best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*fields)).alias("_best"), *counted)
        out = [F.col(f"_best.{c}").alias(c) for c in rest]
    return best.select(*[F.col(k) for k in keys], *out, *([copies] if copies else [])).select(*cols, *([copies] if copies else []))


#: Keys are counted in so many buckets; one with more rows than this, and many times
#: the mean, holds a hot key.
HOT_BUCKETS, HOT_ROWS, HOT_TIMES = 4096, 1_000_000, 8


def _bucket(keys):
    return F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS))


def bucket_rows(df: DataFrame, keys=NATURAL_KEY, **units) -> dict[str, dict[int, int]]:
    """Rows in each bucket of the keys (``"keys"``) and of each unit (a name and its
    column): one scan, which counts on the map side; at most HOT_BUCKETS rows each."""
    kinds = {"keys": keys, **{name: [unit] for name, unit in units.items()}}
    marks = [F.struct(F.lit(name).alias("kind"), _bucket(of).alias("bucket")) for name, of in kinds.items()]
    counts = df.select(F.explode(F.array(*marks)).alias("_m")).groupBy("_m.kind", "_m.bucket").count().collect()
    found: dict[str, dict[int, int]] = {name: {} for name in kinds}
    for r in counts:
        found[r["kind"]][r["bucket"]] = r["count"]
    return found


def hot_buckets(df: DataFrame, keys=NATURAL_KEY) -> list[int]:
    """Buckets of keys with so many rows that one task should not sort them."""
    return hot_of(bucket_rows(df, keys)["keys"])


def in_buckets(buckets, keys=NATURAL_KEY):
    return _bucket(keys).isin(list(buckets))


def hot_of(rows: dict[int, int]) -> list[int]:
    least = max(HOT_ROWS, HOT_TIMES * sum(rows.values()) // HOT_BUCKETS)
    return sorted(bucket for bucket, n in rows.items() if n > least)


PART = "_part"


def part_of(unit, rows: dict[int, int], keys=NATURAL_KEY):
    """A number for each ``unit`` (a function of the keys), so that its rows meet in one
    task.  Units in buckets with more than an eighth of the rows that a task takes
    (``rows``, from :func:`bucket_rows`) are dealt by key over several numbers, so that no
    task gets much more than the others."""
    most = max(1, TASK_ROWS // 8)
    large = [bucket for bucket, n in rows.items() if n > most]
    if not large:
        return F.xxhash64(unit)
    pieces = -(-max(rows.values()) // most)
    return F.xxhash64(unit, F.when(_bucket([unit]).isin(large), F.pmod(F.xxhash64(*keys), F.lit(pieces))))


_TEXT, _PLAIN = "_moved_text", "_moved_plain"
#: Bytes of a row's texts up to which they travel as one.
TEXT_BYTES = 1_000_000


def texts_in_one(df: DataFrame) -> DataFrame:
    """The text columns as one JSON array: a row to move has a word for each column and pads
    each text to words, which does not compress.  Texts that JSON would not give back (no
    valid UTF-8, very long) stay beside it."""
    texts = _texts(df)
    joined = F.concat_ws(" ", *texts)
    fit = F.is_valid_utf8(joined) & (F.octet_length(joined) < TEXT_BYTES)
    together = {_TEXT: F.when(fit, F.to_json(F.array(*texts))), _PLAIN: F.when(~fit, F.array(*texts))}
    return df.withColumns(together).drop(*texts) if texts else df


def texts_apart(moved: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` and those added since, from rows of :func:`texts_in_one`."""
    texts = _texts(df)
    if not texts:
        return moved
    listed = moved.withColumn(_TEXT, F.coalesce(_PLAIN, F.from_json(_TEXT, "array<string>")))
    back = {c: F.col(_TEXT)[i] for i, c in enumerate(texts)}
    added = [c for c in moved.columns if c not in (*df.columns, _TEXT, _PLAIN)]
    return listed.select(*[back[c].alias(c) if c in back else c for c in df.columns], *added)


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType == T.StringType()]


def dealt(df: DataFrame, part, rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` moved by ``part`` (:func:`part_of`), which becomes a column;
    their texts travel in one."""
    moved = texts_in_one(df.withColumn(PART, part)).repartition(tasks_for(df.sparkSession, rows), PART)
    return texts_apart(moved, df)


def dedup_moved(df: DataFrame, hot, keys=NATURAL_KEY, part=None, rows: int | None = None, **options) -> DataFrame:
    """D1 as :func:`dedup`, for large inputs with few copies: rows are moved by key first
    and sorted once, in small tasks.  There a partial aggregate before the shuffle merges
    next to nothing, sorts large tasks to disk, and moves wider rows.  Keys in ``hot``
    buckets go the other way, so a key with a third of all rows is no task of its own.

    With ``part`` (:func:`part_of`) the ``rows`` rows are moved by that, so that who writes
    the survivors by its unit need not move them again; their texts travel in one column."""
    where = in_buckets(hot, keys)
    plain = df.filter(~where) if hot else df
    if part is None:
        best = dedup(plain.repartition(*keys), keys, **options)
    else:
        best = dedup(dealt(plain, part, rows), [PART, *keys], **options).drop(PART)
    return best.unionByName(dedup(df.filter(where), keys, **options)) if hot else best


def order_fields(df: DataFrame, keys=NATURAL_KEY, prefer: str | None = "_dq_passed", newest: str | None = "_ingestion_timestamp") -> tuple[list, list[str]]:
    """Fields of the order struct, and the columns that have no order."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    fields = []
    if prefer and prefer in cols:
        fields.append((~F.coalesce(F.col(prefer), F.lit(False))).alias("_o_prefer"))
    if newest and newest in cols:
        micros = F.unix_micros(F.col(newest).try_cast("timestamp"))
        fields.append(micros.isNull().alias("_o_newest_null"))
        fields.append((-micros).alias("_o_newest"))
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    unorderable = [c for c in rest if isinstance(dtypes[c], _UNORDERABLE)]
    for i, c in enumerate(rest):
        if c in unorderable:
            continue
        fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(f"_v{i}"))
    return fields, unorderable


def _row(struct: str, rest: list[str]) -> list:
    return [F.col(f"{struct}._v{i}").alias(c) for i, c in enumerate(rest)]


#: What became of a key's winner when new rows came in.
KEPT, ADDED, RETRACTED = "kept", "added", "retracted"


def merge_winners(
    known: DataFrame, new: DataFrame, keys=NATURAL_KEY, prefer: str | None = "_dq_passed", newest: str | None = "_ingestion_timestamp",
    part=None, rows: int | None = None, hot=(),
) -> DataFrame:
    """D1 step by step: the winners so far (``known``, one row a key) and new rows give
    the winners now, in a column ``_role``: ``kept`` as before, or ``added`` with the
    row it replaces as ``retracted``.

    The least row of a union is the least of the least rows, so it does not matter how
    rows are cut into steps, in which order steps come, or whether one comes twice.

    With ``part`` the ``rows`` rows of both are moved by that, as in :func:`dedup_moved`;
    new copies of keys in ``hot`` buckets are reduced to one a key before."""
    cols = new.columns
    if hot:
        where = in_buckets(hot, keys)
        new = new.filter(~where).unionByName(dedup(new.filter(where), keys, prefer, newest))
    rest = [c for c in cols if c not in keys]
    both = known.select(*cols, F.lit(True).alias("_known")).unionByName(new.select(*cols, F.lit(False).alias("_known")))
    fields, unorderable = order_fields(new, keys, prefer, newest)
    if unorderable:
        raise ValueError(f"columns without an order: {unorderable}")
    order = F.struct(*fields)
    by = both.groupBy(*keys) if part is None else dealt(both, part, rows).groupBy(PART, *keys)
    best = by.agg(F.min(order).alias("_best"), F.min(F.when(F.col("_known"), order)).alias("_was"))
    same = F.col("_best").eqNullSafe(F.col("_was"))
    now = F.struct(F.when(same, F.lit(KEPT)).otherwise(F.lit(ADDED)).alias("_role"), F.col("_best").alias("_row"))
    before = F.struct(F.lit(RETRACTED).alias("_role"), F.col("_was").alias("_row"))
    states = best.select(*keys, F.explode(F.when(same | F.col("_was").isNull(), F.array(now)).otherwise(F.array(now, before))).alias("_s"))
    return states.select(*keys, *_row("_s._row", rest), "_s._role").select(*cols, "_role")


def dedup_fast(df: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """The arbitrary-survivor variant (``dropDuplicates``)."""
    return df.dropDuplicates(list(keys))
