"""Registered queries of the corpus operators, with DuckDB SQL where SQL can
express them.  Each reads its whole table and returns the operator's full result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import compress, infill, lm, minhash, mixing, packing, quality, recompress, resample, secrets, suffix, vectors, warc
from tripmart.llm.common import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["rule"] < len(secrets.BASE_RULES))
    of_kind = lambda r: F.filter("spans", lambda s: s["kind"] == r.kind)
    counts = [F.size(of_kind(r)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.fixity(read_table(spark, sf_dir, "pages"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(read_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = compress.fit(docs, labels.filter(~compress.held_out(F.col("doc_id"))))
    return compress.score(docs, model).select("doc_id", compress.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(read_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_embedding_dedup,
        op3_mix_sources,
        op4_quality_rules,
        op5_secret_scan,
        op6_warc_fixity,
        op7_minhash,
        op8_substring_dedup,
        op9_lm_scoring,
        op10_suffix_dedup,
        op11_importance_resampling,
        op12_quality_classifier,
        op13_fill_in_middle,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op3_mix_sources": f"""
WITH RECURSIVE ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(cast(doc_id AS varchar), '')), doc_id NULLS FIRST) - 1 AS k
  FROM documents),
sizes AS (SELECT source, count(*) AS n FROM ranked GROUP BY source),
weighted AS (
  SELECT source, n, greatest(1, cast(floor(round({mixing.PERIOD}.0 * pow(n, {mixing.TEMPER}) / sum(pow(n, {mixing.TEMPER})) OVER (), 3) + 0.5) AS bigint)) AS w FROM sizes),
lives AS (SELECT *, cast(ceil(n / (w * {mixing.BLOCK_DOCS})) AS bigint) AS p FROM weighted),
phases AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS phase, coalesce(lag(e) OVER (ORDER BY e), 0) AS f FROM (SELECT DISTINCT p AS e FROM lives)),
alive AS (
  SELECT source, w, phase, f, e - f AS periods, sum(w) OVER (PARTITION BY phase) AS len,
    row_number() OVER (PARTITION BY phase ORDER BY coalesce(source, ''), source IS NULL) AS i
  FROM lives JOIN phases ON p >= e),
starts AS (
  SELECT phase, coalesce(sum(periods * len) OVER (ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT DISTINCT phase, periods, len FROM alive)),
tasks AS (SELECT phase, cast(len AS bigint) AS len, list(cast(w AS bigint) ORDER BY i) AS ws FROM alive GROUP BY phase, len),
run AS (
  SELECT phase, len, ws, cast(0 AS bigint) AS t, [cast(0 AS bigint) FOR x IN ws] AS done, cast(NULL AS bigint) AS pick, cast(NULL AS bigint) AS turn FROM tasks
  UNION ALL
  SELECT phase, len, ws, t + 1, [done[j] + CASE WHEN j = best THEN 1 ELSE 0 END FOR j IN range(1, len(ws) + 1)], best, done[best]
  FROM (SELECT *, list_sort([{{'d': cast(ceil((done[j] + 1) * run.len / ws[j]) AS bigint), 'j': j}} FOR j IN range(1, len(ws) + 1) IF floor(done[j] * run.len / ws[j]) <= t])[1].j AS best
    FROM run WHERE t < run.len)),
plan AS (SELECT phase, pick AS i, turn, t - 1 AS place FROM run WHERE pick IS NOT NULL),
mine AS (SELECT doc_id, source, k, k // {mixing.BLOCK_DOCS} AS block FROM ranked)
SELECT m.doc_id, m.source, cast(block AS bigint) AS block, cast(start + (block // w - f) * len + place AS bigint) AS slot,
  cast(k % {mixing.BLOCK_DOCS} AS bigint) AS place_in_block, cast(w AS bigint) AS weight
FROM mine m JOIN alive a ON m.source IS NOT DISTINCT FROM a.source AND block // w >= f AND block // w < f + periods
JOIN starts s ON s.phase = a.phase JOIN plan p ON p.phase = a.phase AND p.i = a.i AND p.turn = block % w""",
    "op4_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
win AS (SELECT r, i, ws[i] || chr(1) || ws[i+1] || chr(1) || ws[i+2] AS k FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (SELECT r, unnest([i, i+1, i+2]) AS j FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM twice GROUP BY r),
lines AS (SELECT r, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{_WORD}')] AS ls, len(string_split(t, chr(10))) AS n_lines FROM w),
m AS (SELECT w.doc_id, cast(len(ws) AS bigint) AS n_words, cast(length(array_to_string(ws, '')) AS bigint) AS word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
  cast(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines, cast(coalesce(rep.n, 0) AS bigint) AS n_repeat_words, n_lines
  FROM w JOIN lines USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR n_dup_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines) AS kept
FROM b""",
    "op6_warc_fixity": f"""
WITH c AS (SELECT chr(13) || chr(10) AS nl),
r AS (SELECT page_id, 'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl || 'Content-Type: text/html' || nl
  || 'Content-Length: ' || strlen(coalesce(html, '')) || nl || nl || coalesce(html, '') || nl || nl AS rec FROM pages, c),
k AS (SELECT page_id, sha256(rec) AS sha256, cast(strlen(rec) AS bigint) AS length,
  row_number() OVER (ORDER BY md5(coalesce(cast(page_id AS varchar), '')), page_id NULLS FIRST, sha256(rec)) - 1 AS rk FROM r),
f AS (SELECT *, cast(rk // {warc.PER_FILE} AS bigint) AS file, cast(rk % {warc.PER_FILE} AS bigint) AS seq FROM k)
SELECT page_id, file, seq, cast(coalesce(sum(length) OVER (PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS "offset",
  length, sha256, substring(md5('rot' || coalesce(cast(page_id AS varchar), '')), 1, 2) IN ('00', '01', '02', '03') AS corrupt
FROM f""",
    "op11_importance_resampling": rf"""
WITH table_of AS (SELECT list(c ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([cast(i AS bigint)] || [cast(0 AS bigint) FOR x IN range(8)], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {resample.POLYNOMIAL}) ELSE c >> 1 END) AS c
  FROM range(256) AS g(i))),
low AS (SELECT 'd' AS side, doc_id, text, row_number() OVER () AS r FROM documents UNION ALL SELECT 'b', NULL, text, NULL FROM benchmark),
split AS (SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
words AS (SELECT side, r, unnest(ws) AS w FROM split),
vocabulary AS (SELECT w, xor(list_reduce([cast(4294967295 AS bigint)] || [cast('0x' || substr(hex(w), 2 * k - 1, 2) AS bigint) FOR k IN range(1, strlen(w) + 1)],
    lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) % {resample.BUCKETS} AS bucket
  FROM (SELECT DISTINCT w FROM words), table_of),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN vocabulary USING (w) GROUP BY bucket),
totals AS (SELECT cast(coalesce(sum(s), 0) AS double) AS sa, cast(coalesce(sum(t), 0) AS double) AS ta FROM counts),
gain AS (SELECT bucket, cast(floor(1000 * ln((t + 1.0::double) * (sa + {resample.BUCKETS}) / ((s + 1.0::double) * (ta + {resample.BUCKETS})))) AS bigint) AS g FROM counts, totals),
sums AS (SELECT r, sum(g) AS weight FROM words JOIN vocabulary USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
noise AS (SELECT r, doc_id, len(ws) AS n_features, cast('0x' || substr(sha256('{resample.SEED}:' || coalesce(cast(doc_id AS varchar), '')), 1, 8) AS bigint) AS h FROM split WHERE side = 'd'),
scored AS (SELECT doc_id, cast(n_features AS bigint) AS n_features, cast(coalesce(weight, 0) AS bigint) AS weight,
  cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) AS bigint) AS score FROM noise LEFT JOIN sums USING (r)),
placed AS (SELECT *, n_features >= {resample.MIN_WORDS} AS able, row_number() OVER (PARTITION BY n_features >= {resample.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
  count(*) FILTER (n_features >= {resample.MIN_WORDS}) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {resample.SHARE_PCT} * n // 100 THEN place END AS rank FROM placed""",
    "op13_fill_in_middle": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{infill.SEED}:' || coalesce(cast(doc_id AS varchar), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS us, [cast('0x' || substr(h, 8 * k + 1, 8) AS bigint) FOR k IN range(4)] AS hs FROM d),
c AS (SELECT *, len(us) AS n, least(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS a, greatest(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR hs[3] % 100 >= {infill.RATE_PCT} THEN 'plain' WHEN hs[4] % 100 < {infill.SPM_PCT} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(us[1:a], ''), '') AS prefix, coalesce(array_to_string(us[a + 1:b], ''), '') AS middle, coalesce(array_to_string(us[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, cast(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN cast(length(prefix) AS bigint) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN cast(length(middle) AS bigint) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
}
