"""Mixing sources to target weights by proportionate-fair scheduling.

Every source is cut into blocks of ``block_docs`` documents (in an order that a
hash of the key shuffles).  Weights are whole numbers w, so that in a period of
W = sum(w) slots a source is due w blocks.  Its i-th block of the period is
released at slot floor(i*W/w) and must be placed before slot ceil((i+1)*W/w);
earliest-deadline-first over the released blocks then keeps every source within
one block of its share after every slot.

A period is scheduled once and repeated: that is exact, since all sources are
even at its end.  When a source runs out the rest go on with the same weights
and a schedule of their own, so there are as many schedules as times a source
runs out, each bounded by W slots.  Documents get their slot by arithmetic and a
join with these small tables; nothing is dropped and nothing repeated.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import salted_rank, shuffle_partitions, stage

BLOCK_DOCS = 16
PERIOD = 1000
TEMPER = 0.7


def tempered_weights(sizes: DataFrame, temper: float = TEMPER, period: int = PERIOD) -> DataFrame:
    """(source, n, weight): weights in proportion to n^temper as whole numbers that
    sum to about ``period``, 1 at least."""
    total = sizes.agg(F.sum(F.pow(F.col("n").cast("double"), F.lit(temper))).alias("_sum"))
    share = F.round(F.lit(float(period)) * F.pow(F.col("n").cast("double"), F.lit(temper)) / F.col("_sum"), 3)
    joined = sizes.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one")
    return joined.select("source", "n", F.greatest(F.lit(1), F.floor(share + 0.5)).cast("long").alias("weight"))


def source_phases(weighted: DataFrame, block_docs: int) -> DataFrame:
    """(source, weight, phase, first_period, periods): the phases a source lives through.

    A phase ends when a source has no full or partial period left.  The windows
    here run over one row a source.
    """
    lives = weighted.withColumn("_periods", F.ceil(F.col("n") / (F.col("weight") * F.lit(block_docs))).cast("long"))
    ends = lives.select(F.col("_periods").alias("_end")).distinct()
    by_end = Window.orderBy("_end")
    phases = ends.select(
        (F.row_number().over(by_end) - 1).cast("long").alias("phase"),
        F.coalesce(F.lag("_end").over(by_end), F.lit(0)).cast("long").alias("first_period"),
        "_end",
    )
    alive = lives.join(phases, F.col("_periods") >= F.col("_end"))
    return alive.select("source", "weight", "phase", "first_period", (F.col("_end") - F.col("first_period")).alias("periods"))


def period_schedule(alive: DataFrame) -> DataFrame:
    """Earliest deadline first over one period of each phase.

    Rows (phase, source, turn, place, release, deadline, length): the source's
    ``turn``-th block of the period takes slot ``place`` of its ``length``.
    """
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce(F.col("source"), F.lit("")).alias("s"), F.col("source").isNull().alias("z"), F.col("weight").cast("long").alias("w"))))
    tasks = alive.groupBy("phase").agg(ordered.alias("tasks"), F.sum("weight").cast("long").alias("length"))

    def slot(state, t):
        # the released block with the earliest deadline; ties go to the first source
        best = F.array_min(
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.size("tasks") - 1),
                    lambda i: F.when(
                        F.floor(F.get(state["done"], i) * F.col("length") / F.get("tasks", i)["w"]) <= t,
                        F.struct(F.ceil((F.get(state["done"], i) + 1) * F.col("length") / F.get("tasks", i)["w"]).alias("d"), i.alias("i")),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        )
        return F.transform(
            F.array(best),
            lambda b: F.struct(
                F.transform(state["done"], lambda n, i: F.when(i == b["i"], n + 1).otherwise(n)).alias("done"),
                F.concat(state["picks"], F.array(F.struct(b["i"].alias("i"), F.get(state["done"], b["i"]).alias("turn"), b["d"].cast("long").alias("deadline")))).alias("picks"),
            ),
        )[0]

    none = F.struct(
        F.transform("tasks", lambda x: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<struct<i:int,turn:bigint,deadline:bigint>>").alias("picks"),
    )
    picks = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("length") - 1), none, slot, lambda s: s["picks"])
    placed = tasks.select("phase", "length", "tasks", F.posexplode(picks).alias("place", "p"))
    task = F.get("tasks", F.col("p.i"))
    return placed.select(
        "phase",
        F.when(~task["z"], task["s"]).alias("source"),
        F.col("p.turn").alias("turn"),
        F.col("place").cast("long").alias("place"),
        F.floor(F.col("p.turn") * F.col("length") / task["w"]).cast("long").alias("release"),
        F.col("p.deadline").alias("deadline"),
        "length",
    )


def mix(
    docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS, temper: float = TEMPER,
    period: int = PERIOD, doc_id: str = "doc_id", source: str = "source",
) -> DataFrame:
    """Slot of every document: (doc_id, source, block, slot, place_in_block, weight).

    Order by (slot, place_in_block) for the mixed corpus.  ``weights`` (source,
    weight as a whole number) or, by default, tempered weights by size; a source
    without a weight gets 1.  NULL sources form a source of their own; NULL ids
    come first inside their hash; repeated rows keep their number.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"))
    keyed = rows.withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = keyed.withColumn("_salt", F.substring("_md5", 1, 2))
    ranked = stage(salted_rank(keyed, ["source"], "_salt", ["_md5", "doc_id"], "_rank").drop("_salt", "_md5"), "mix")
    sizes = ranked.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weighted = tempered_weights(sizes, temper, period)
    else:
        w = weights.select(F.col("source").alias("_s"), "weight")
        weighted = sizes.join(w, sizes.source.eqNullSafe(w._s), "left").select("source", "n", F.greatest(F.lit(1), F.coalesce("weight", F.lit(1))).cast("long").alias("weight"))
    weighted = stage(weighted, "mix-weights")
    spans, plan = timetable(weighted, block_docs)
    return with_slots(ranked, spans, plan, block_docs).select("doc_id", "source", "block", "slot", "place_in_block", F.col("_w").alias("weight"))


def timetable(weighted: DataFrame, block_docs: int) -> tuple[DataFrame, DataFrame]:
    """From (source, n, weight): the spans of the sources' phases and the plan of a
    period of each phase, rows a source and phase and rows a slot."""
    alive = stage(source_phases(weighted, block_docs), "mix-phases")
    schedule = stage(period_schedule(alive), "mix-period")
    lengths = alive.groupBy("phase", "first_period", "periods").agg(F.sum("weight").cast("long").alias("_len"))
    run = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("phase", F.coalesce(F.sum(F.col("periods") * F.col("_len")).over(run), F.lit(0)).cast("long").alias("_start"))
    spans = alive.join(starts, "phase").select(F.col("source").alias("_s"), F.col("weight").alias("_w"), F.col("phase").alias("_phase"), "first_period", "periods", "_start")
    plan = schedule.select(F.col("source").alias("_ps"), F.col("phase").alias("_pp"), "turn", "place", "length")
    return spans, plan


def with_slots(ranked: DataFrame, spans: DataFrame, plan: DataFrame, block_docs: int) -> DataFrame:
    """``ranked`` (source, _rank, ...) with block, slot, place_in_block and _w."""
    mine = ranked.withColumn("block", F.floor(F.col("_rank") / F.lit(block_docs)).cast("long"))
    cut = mine.join(
        spans,
        mine.source.eqNullSafe(spans._s)
        & (F.floor(F.col("block") / F.col("_w")) >= F.col("first_period"))
        & (F.floor(F.col("block") / F.col("_w")) < F.col("first_period") + F.col("periods")),
    ).withColumn("_period", F.floor(F.col("block") / F.col("_w")).cast("long")).withColumn("_turn", (F.col("block") % F.col("_w")).cast("long"))
    return cut.join(plan, cut._s.eqNullSafe(plan._ps) & (cut._phase == plan._pp) & (cut._turn == plan.turn)).select(
        *[mine[c] for c in ranked.columns], "block",
        (F.col("_start") + (F.col("_period") - F.col("first_period")) * F.col("length") + F.col("place")).cast("long").alias("slot"),
        (F.col("_rank") % F.lit(block_docs)).cast("long").alias("place_in_block"),
        "_w",
    )


#: Rows of a table that may be broadcast to place documents.
SMALL_TABLE = 200_000


def in_mixed_order(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", source: str = "source", files: int | None = None) -> DataFrame:
    """``docs`` sorted as ``mixed`` says: written as files, their order is the order of
    the mixture.  All columns of ``docs`` and no others; NULL sources are a source, rows
    that repeat an id take its places one after the other, an empty table stays empty.

    A document's place among those of its source follows from a hash of its id, so the
    mixture says for each of ``files`` ranges of slots with which hash a source leaves
    it.  That table has a row a source and file and is broadcast; by it every text finds
    its file, travels there once, is counted there and gets its slot.  Where the table is
    not small, texts are joined with ``mixed`` by id and sorted."""
    files = files or shuffle_partitions(docs.sparkSession)
    mixed = stage(mixed.select("doc_id", "source", "block", "slot", "place_in_block", "weight"), "mixed")
    shape = mixed.agg(F.max("slot").alias("last"), F.max("place_in_block").alias("most"), F.count(F.lit(1)).alias("n")).first()
    if not shape["n"]:
        return docs
    block_docs = shape["most"] + 1
    spans, plan = timetable(mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")), block_docs)
    # a file for each range of slots; rows of one id go to that of its first slot
    file = F.floor(F.col("slot") * F.lit(files) / F.lit(shape["last"] + 1)).cast("int")
    ids = mixed.groupBy("source", F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(file).alias("file"), F.count(F.lit(1)).alias("n"))
    cuts = ids.groupBy("source", "file").agg(F.max(F.struct(_hash(F.col("doc_id")).alias("h"), "doc_id")).alias("until"), F.sum("n").alias("n"))
    cuts = stage(cuts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "mix-cuts")
    digits = 0 if files <= 64 else math.ceil(math.log(files / 16, 16))
    lists = _lookup(cuts, digits)
    if max(lists.count(), plan.count(), spans.count()) > SMALL_TABLE:
        return _joined_order(docs, mixed, doc_id)
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(source).cast("string").alias("_src"), F.struct(_hash(F.col(doc_id)).alias("h"), F.col(doc_id).cast("long").alias("doc_id")).alias("_key"))
    found = keyed.join(F.broadcast(lists), keyed._src.eqNullSafe(lists._ls) & (F.substring(F.col("_key.h"), 1, digits) == F.col("_prefix")))
    here = F.get(F.filter("_cuts", lambda c: c["until"] >= F.col("_key")), F.lit(0))["file"]
    filed = found.withColumn("_file", F.coalesce(here, F.col("_next"))).drop("_ls", "_prefix", "_cuts", "_next")
    dealt = filed.repartitionByRange(files, "_file")
    # ranges of files are clustered by file and source as they are: no further exchange
    inside = F.row_number().over(Window.partitionBy("_file", "_src").orderBy("_key")) - 1
    bases = F.broadcast(cuts.select(F.col("source").alias("_bs"), F.col("file").alias("_bf"), "base"))
    counted = dealt.withColumn("_in", inside).join(bases, F.col("_src").eqNullSafe(F.col("_bs")) & (F.col("_file") == F.col("_bf")))
    ranked = counted.select("_row", F.col("_src").alias("source"), (F.col("base") + F.col("_in")).alias("_rank"))
    placed = with_slots(ranked, F.broadcast(spans), F.broadcast(plan), block_docs)
    return placed.sortWithinPartitions("slot", "place_in_block").select("_row.*")


def _hash(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def _lookup(cuts: DataFrame, digits: int) -> DataFrame:
    """(_ls, _prefix, _cuts, _next): for a source and the leading digits of a hash, the
    files that the source leaves at such hashes, in order, and the next file after them."""
    all_prefixes = F.transform(F.sequence(F.lit(0), F.lit(16**digits - 1)), lambda i: F.substring(F.lpad(F.lower(F.hex(i)), 8, "0"), 9 - digits, digits))
    grid = cuts.select(F.col("source").alias("_ls")).distinct().select("_ls", F.explode(all_prefixes).alias("_prefix"))
    own = cuts.select(F.col("source").alias("_cs"), F.substring(F.col("until.h"), 1, digits).alias("_cp"), "until", "file")
    lists = own.groupBy("_cs", "_cp").agg(F.sort_array(F.collect_list(F.struct("until", "file"))).alias("_cuts"), F.min("file").alias("_first"))
    joined = grid.join(lists, F.col("_ls").eqNullSafe(F.col("_cs")) & (F.col("_prefix") == F.col("_cp")), "left")
    after = Window.partitionBy("_ls").orderBy("_prefix").rowsBetween(1, Window.unboundedFollowing)
    none = F.array().cast("array<struct<until:struct<h:string,doc_id:bigint>,file:int>>")
    return joined.select("_ls", "_prefix", F.coalesce("_cuts", none).alias("_cuts"), F.min("_first").over(after).alias("_next"))


def _joined_order(docs: DataFrame, mixed: DataFrame, doc_id: str) -> DataFrame:
    keys = mixed.groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.struct("slot", "place_in_block")).alias("_at"))
    joined = docs.join(keys, docs[doc_id].eqNullSafe(keys._id))
    return joined.orderBy(keys["_at"]).select(*[docs[c] for c in docs.columns])


def file_place() -> Column:
    """Place of each row of a table that Spark wrote in order: number of its file, then
    its row there.  For a DataFrame read from files."""
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    file = number(r"part-(\d+)") * 1000 + number(r"-c(\d+)\.")
    return F.shiftleft(file, 32) + F.col("_metadata.row_index")
