"""Fixity audit of web archives by hash trees.

Pages become WARC response records, dealt in a fixed order into archive files of
``per_file`` records.  Every replica hashes its own records (SHA-256 over the whole
record) and, level by level, ordered runs of ``fanout`` nodes up to one root a
file; a node also knows the byte range it covers.  An audit compares the roots
and descends only into nodes that differ, so agreeing files cost one row each.

No group is larger than ``fanout`` nodes or ``per_file`` records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import salted_rank, stage

PER_FILE, FANOUT = 1024, 16


def record(url: Column, html: Column) -> Column:
    """A WARC/1.0 response record (binary)."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def archive(pages: DataFrame, per_file: int = PER_FILE, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, file, seq, offset, length, record): records in archive order, which is
    that of a hash of the id.  NULL ids come by their hash, NULL texts are empty;
    rows that share an id stand next to each other, by their text."""
    made = pages.select(F.col(page_id).alias("page_id"), record(F.col(url).cast("string"), F.col(html).cast("string")).alias("record"))
    bodies = made.withColumn("_sha", F.sha2("record", 256))
    at = places(bodies.select("page_id", "_sha", F.octet_length("record").cast("long").alias("length")), per_file)
    # equal rows (id and record) are interchangeable: number them on both sides
    again = Window.partitionBy("page_id", "_sha").orderBy(F.lit(1))
    at = at.withColumn("_c", F.row_number().over(Window.partitionBy("page_id", "_sha").orderBy("file", "seq"))).withColumnsRenamed({"page_id": "_p", "_sha": "_s"})
    bodies = bodies.withColumn("_copy", F.row_number().over(again))
    joined = bodies.join(at, bodies.page_id.eqNullSafe(at._p) & (bodies._sha == at._s) & (bodies._copy == at._c))
    return joined.select("page_id", "file", "seq", "offset", "length", "record")


def places(records: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """``records`` (page_id, _sha, length, more columns) with their place in the
    archive (file, seq, offset).  Records themselves need not come along."""
    key = F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    light = stage(records.withColumns({"_key": key, "_salt": F.substring(key, 1, 3)}), "warc-keys")
    ranked = salted_rank(light, [], "_salt", ["_key", "page_id", "_sha"], "_rank").drop("_key", "_salt")
    placed = ranked.withColumns({"file": F.floor(F.col("_rank") / per_file).cast("long"), "seq": (F.col("_rank") % per_file).cast("long")}).drop("_rank")
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def leaves(replica: DataFrame) -> DataFrame:
    """Level 0 of a replica's trees: (file, level, node, start, size, hash)."""
    return replica.select("file", F.lit(0).alias("level"), F.col("seq").alias("node"), F.col("offset").alias("start"), F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("hash"))


def grow(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The level above: each node hashes its children's ranges and hashes in order."""
    child = F.struct("node", "start", "size", "hash")
    runs = level.groupBy("file", F.col("level") + 1, F.floor(F.col("node") / fanout).cast("long").alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["start"], x["size"], x["hash"])), ",")
    size = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["size"])
    return runs.select("file", F.col("(level + 1)").alias("level"), F.col("parent").alias("node"), F.col("c")[0]["start"].alias("start"), size.alias("size"), F.sha2(text, 256).alias("hash"))


def tree(replica: DataFrame, per_file: int = PER_FILE, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels of the trees of a replica (file, seq, offset, record), leaves first."""
    return tree_of(leaves(replica), per_file, fanout)


def tree_of(leaf: DataFrame, per_file: int = PER_FILE, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels above given leaves, which come first."""
    levels, width = [stage(leaf, "tree")], per_file
    while width > 1:
        levels.append(stage(grow(levels[-1], fanout), "tree"))
        width = -(-width // fanout)
    return levels


def audit(mine: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Leaves in which two replicas differ: (file, node, start, size, hash, other_hash).

    Roots are compared for all files; below, only children of nodes that differ.
    A record that one side lacks has a NULL hash there."""
    bad = None
    for a, b in zip(reversed(mine), reversed(other)):
        if bad is not None:
            parent = F.floor(F.col("node") / fanout)
            a, b = (x.join(bad, (x.file == bad._f) & (parent == bad._n), "left_semi") for x in (a, b))
        right = b.select(F.col("file").alias("_f2"), F.col("node").alias("_n2"), F.col("start").alias("_start2"), F.col("size").alias("_size2"), F.col("hash").alias("other_hash"))
        met = a.join(right, (a.file == right._f2) & (a.node == right._n2), "full")
        found = met.filter(~F.col("hash").eqNullSafe(F.col("other_hash"))).select(
            F.coalesce("file", "_f2").alias("file"), F.coalesce("node", "_n2").alias("node"), F.coalesce("start", "_start2").alias("start"),
            F.coalesce("size", "_size2").alias("size"), "hash", "other_hash")
        found = stage(found, "differ")
        bad = found.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    return found


def decayed(replica: DataFrame) -> DataFrame:
    """A replica with bit rot for trials: where a hash of the id says so (about one in
    64), the record's last byte before its end mark is replaced."""
    rot = F.substring(F.md5(F.concat(F.lit("rot"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))), 1, 2).isin("00", "01", "02", "03")
    text = F.col("record").cast("string")
    last = F.char_length(text) - 4
    changed = F.concat(F.substring(text, F.lit(1), last - 1), F.when(F.substring(text, last, F.lit(1)) == "~", F.lit("!")).otherwise(F.lit("~")), F.lit("\r\n\r\n"))
    return replica.withColumn("record", F.when(rot, changed.cast("binary")).otherwise(F.col("record")))


def fixity(pages: DataFrame, per_file: int = PER_FILE, fanout: int = FANOUT) -> DataFrame:
    """Archive ``pages``, let a replica decay, audit it: every record with its place,
    its digest and whether the audit found the replica's copy corrupt.

    NULL urls and texts are empty; a NULL page id counts as the empty string and comes
    first among records of one hash.  Repeated pages are records each; equal ones take
    places next to each other.  An empty table gives an empty archive.  Other columns are
    ignored.  A record of any length is hashed where it is."""
    made = pages.select("page_id", record(F.col("url").cast("string"), F.col("html").cast("string")).alias("record"))
    # both replicas hash their records where they are; only digests are moved
    rotten = decayed(made.select("page_id", "record", F.sha2("record", 256).alias("_sha"), F.octet_length("record").cast("long").alias("length")))
    digests = rotten.select("page_id", "_sha", "length", F.sha2("record", 256).alias("_other"), F.octet_length("record").cast("long").alias("_size"))
    placed = stage(places(digests, per_file), "warc-places")
    leaf = lambda size, sha: placed.select("file", F.lit(0).alias("level"), F.col("seq").alias("node"), F.col("offset").alias("start"), F.col(size).alias("size"), F.col(sha).alias("hash"))
    found = audit(tree_of(leaf("length", "_sha"), per_file, fanout), tree_of(leaf("_size", "_other"), per_file, fanout), fanout)
    found = found.select(F.col("file").alias("_f"), F.col("node").alias("_n"), F.lit(True).alias("_bad"))
    return placed.join(found, (F.col("file") == F.col("_f")) & (F.col("seq") == F.col("_n")), "left").select(
        "page_id", "file", "seq", "offset", "length", F.col("_sha").alias("sha256"), F.coalesce("_bad", F.lit(False)).alias("corrupt"))
