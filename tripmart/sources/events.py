"""File-arrival events and idempotent ingest.

S5: notification bodies (JSON text) -> one row per record: parse with an
explicit schema, explode, URL-decode the key ('+' is a space; a key that does
not decode is taken as it is).  Every record is either accepted (key under the
prefix, with the suffix) or rejected with a reason, bodies that do not parse
included.  S7: a missing ETag falls back to the first 20 characters of the
request id, a missing size to 0; the execution name then also holds a hash of
the key, so that files of one event stay apart.

S6: "the same content is not processed twice", in two levels.  A file whose path,
length and modification time are in the ledger is known from the file listing and
never opened.  The others are judged by content, not by names or wall-clock time: per
file, the row count and two order-independent sums of NULL-safe row hashes.  Files
whose fingerprint is in the ledger are skipped, one file for each content goes
through, and the ledger is appended only after the ingest succeeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "Records array<struct<eventTime:string,s3:struct<bucket:struct<name:string>,"
    "object:struct<key:string,size:bigint,eTag:string>>>>"
)
IDENTITY = ["_source_path", "file_size", "modified"]
CONTENT = ["rows", "content_hash", "content_check"]
LEDGER_SCHEMA = (
    "_source_path string, file_size bigint, modified timestamp, "
    "rows bigint, content_hash decimal(38,0), content_check decimal(38,0), ingested boolean"
)


def event_records(
    events: DataFrame,
    body: str = "body",
    request_id: str = "request_id",
    prefix: str = "freight/",
    suffix: str = ".csv",
    environment: str = "dev",
) -> DataFrame:
    """S5 + S7: all records with bucket, key, etag, size, time, execution name, and
    ``rejected`` (NULL when accepted)."""
    parsed = events.select(
        F.col(request_id).alias("request_id"), F.col(body).alias("_body"),
        F.from_json(F.col(body), EVENT_SCHEMA).getField("Records").alias("_records"),
    )
    recs = parsed.select("request_id", (F.size("_records") < 0).alias("_broken"), F.explode_outer("_records").alias("r"), F.col("_records").alias("_all"))
    # an event with an empty list of records has nothing to report
    recs = recs.filter(F.col("_all").isNull() | (F.size("_all") > 0))
    raw = F.col("r.s3.object.key")
    key = F.coalesce(F.try_url_decode(raw), raw)
    own = F.nullif(F.regexp_replace(F.col("r.s3.object.eTag"), '"', ""), F.lit(""))
    out = recs.select(
        "request_id",
        F.col("r.s3.bucket.name").alias("bucket"),
        key.alias("key"),
        F.coalesce(own, F.substring("request_id", 1, 20)).alias("etag"),
        F.coalesce(F.col("r.s3.object.size"), F.lit(0).cast("bigint")).alias("size_bytes"),
        F.col("r.eventTime").alias("event_time"),
        own.isNull().alias("_shared"),
        F.col("_all").isNull().alias("_broken"),
    )
    name = F.concat(F.lit(f"{environment}-"), F.substring(F.regexp_replace("etag", "-", ""), 1, 20))
    apart = F.when(F.col("_shared"), F.concat(F.lit("-"), F.substring(F.md5(F.coalesce("key", F.lit(""))), 1, 8))).otherwise(F.lit(""))
    reason = (
        F.when(F.col("_broken"), F.lit("unreadable event"))
        .when(F.col("key").isNull(), F.lit("no key"))
        .when(~F.col("key").startswith(prefix), F.lit("other prefix"))
        .when(~F.col("key").endswith(suffix), F.lit("other suffix"))
    )
    return out.select("request_id", "bucket", "key", "etag", "size_bytes", "event_time", F.concat(name, apart).alias("execution_name"), reason.alias("rejected"))


def file_arrivals(events: DataFrame, **options) -> DataFrame:
    """S5 + S7: accepted files (same content -> same execution name)."""
    return event_records(events, **options).filter(F.col("rejected").isNull()).select("bucket", "key", "etag", "size_bytes", "execution_name")


def rejected_records(events: DataFrame, **options) -> DataFrame:
    """What was not accepted, with the reason."""
    return event_records(events, **options).filter(F.col("rejected").isNotNull()).select("request_id", "bucket", "key", "rejected")


def started_counts(events: DataFrame, **options) -> DataFrame:
    """Executions started for each event."""
    return event_records(events, **options).groupBy("request_id").agg(F.count_if(F.col("rejected").isNull()).alias("executions_started"))


def file_identities(spark: SparkSession, path: str, suffix: str = ".csv", compressed: bool = True) -> DataFrame:
    """S6, first level: path, length and modification time of every file below
    ``path``, ``compressed`` ones too.  Only the listing is used; no file is opened."""
    glob = f"*{suffix}" + ("{,.gz,.bz2}" if compressed else "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("_source_path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def unlisted_files(identities: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """S6, first level: files that the ledger does not list as they are now."""
    return identities if ledger is None else identities.join(ledger.select(*IDENTITY).distinct(), IDENTITY, "left_anti")


def judged_files(identities: DataFrame, fingerprints: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """S6, second level: ledger rows for the files of this run; ``ingested`` is TRUE for
    the one file of each content that no earlier run took in.  A file without rows has
    no content to take in."""
    fresh = unseen_files(fingerprints, ledger).select("_source_path", F.lit(True).alias("ingested"))
    judged = identities.join(fingerprints, "_source_path", "left").join(fresh, "_source_path", "left")
    return judged.withColumns({"rows": F.coalesce("rows", F.lit(0)), "ingested": F.coalesce("ingested", F.lit(False))}).select(*IDENTITY, *CONTENT, "ingested")


def content_fingerprints(df: DataFrame, columns, path_col: str = "_source_path") -> DataFrame:
    """Per source file, row count and two order-independent content sums.

    Each value is hashed with its position and whether it is there, so NULLs and
    swapped columns change the sums."""
    parts = [F.struct(F.lit(i).alias("i"), F.col(c).isNull().alias("n"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    one = F.xxhash64(*parts)
    two = F.xxhash64(F.lit("second"), *reversed(parts))
    return df.groupBy(path_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(one.cast("decimal(38,0)")).alias("content_hash"),
        F.sum(two.cast("decimal(38,0)")).alias("content_check"),
    )


def unseen_files(fingerprints: DataFrame, ledger: DataFrame | None, path_col: str = "_source_path") -> DataFrame:
    """Files whose content is not in the ledger, the first by name of those
    with equal content in this run."""
    fresh = fingerprints.groupBy(*CONTENT).agg(F.min(path_col).alias(path_col)).select(path_col, *CONTENT)
    if ledger is not None:
        fresh = fresh.join(ledger.select(*CONTENT).distinct(), CONTENT, "left_anti").select(path_col, *CONTENT)
    return fresh


def record(new: DataFrame, ledger_path: str) -> None:
    """Remember files and their content (append after a successful ingest)."""
    new.write.mode("append").parquet(ledger_path)
