"""The subpackage's queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import bpe, divergence, factorisation, lattice, mixing, naming, packing, quality, repair, secrets, shards, simhash, substrings


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(_documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    ledger = secrets.Ledger(spark)
    ledger.scan(docs)
    found = ledger.findings(docs)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = secrets.spans_text(F.col("spans"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


OP2_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (
  SELECT doc_id, t, 0 AS k, 'assign' AS kind, 8 AS least,
         '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS re FROM docs
  UNION ALL SELECT doc_id, t, 1, 'access', 16, 'AKIA[A-Z0-9]+' FROM docs
  UNION ALL SELECT doc_id, t, 2, 'hex', 32, '[0-9a-f]+' FROM docs),
found AS (
  SELECT doc_id, k, kind, least,
         CASE k WHEN 0 THEN regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
                WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS ms,
         CASE k WHEN 0 THEN regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
                WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS gs,
         CASE k WHEN 0 THEN regexp_split_to_array(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
                WHEN 1 THEN regexp_split_to_array(t, 'AKIA[A-Z0-9]+') ELSE regexp_split_to_array(t, '[0-9a-f]+') END AS ps
  FROM raw),
each AS (SELECT doc_id, k, kind, least, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[1:len(ms)]) AS p, generate_subscripts(ms, 1) AS i FROM found WHERE len(ms) > 0),
placed AS (
  SELECT doc_id, k, kind, least, g,
         sum(length(p) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) AS e, length(m) AS n FROM each),
spans AS (SELECT doc_id, k, kind, (e - n)::BIGINT AS s, e::BIGINT AS e FROM placed WHERE length(g) >= least),
joined AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
                  count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2 FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j USING (doc_id)
"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return plan.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
named AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM docs GROUP BY source),
weighed AS (SELECT source, source_size, 3 * source_size AS most, CASE (k - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
                   (SELECT sum(source_size) FROM named)::BIGINT AS total FROM named),
levels AS (SELECT *, most / w <= (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                     / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
           FROM weighed WINDOW o AS (ORDER BY most / w, source NULLS LAST)),
last AS (SELECT (max(total) - coalesce(sum(most) FILTER (capped), 0))::DOUBLE / sum(w) FILTER (NOT capped) AS level FROM levels),
targets AS (SELECT source, source_size, CASE WHEN capped THEN most::DOUBLE ELSE level * w END AS target FROM levels, last),
rates AS (SELECT d.doc_id, d.size, t.source_size, t.target,
                 CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0.0 END AS rate,
                 ('0x' || md5('mix-1:' || coalesce(d.doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS u
          FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rates
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = naming.exact_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


#: Arrivals that the table of documents is taken for.
ARRIVALS = 8


def op8_compacted_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it stands in the compacted store: the file of its shard, and its text's sum."""
    store = shards.ShardStore(spark)
    store.append_all(_documents(spark, sf_dir), F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)).cast("int"), ARRIVALS)
    store.compact()
    rows = store.read().select("doc_id", "text", F.col("_metadata.file_name").alias("shard"))
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "shard", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf_dir)).drop("spans")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM starts),
least AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
hits AS (SELECT doc_id, i FROM windows JOIN least USING (g) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(0, 13) AS r(k)),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(_documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    crf = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_rules(docs, crf, carry=["doc_id"])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
each AS (SELECT k, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM each GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
counts AS (SELECT e.lang, e.source, e.term, count(*) AS n FROM each e JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS group_n FROM counts GROUP BY lang, source),
groups AS (SELECT d.lang, d.source, coalesce(s.group_n, 0)::HUGEINT AS group_n, coalesce(v, 0)::HUGEINT AS v, coalesce(lang_n, 0)::HUGEINT AS lang_n
           FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN sums s USING (lang, source) LEFT JOIN langs USING (lang)),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.group_n + 5 * g.v) AS p,
                  1 + (1000000000::HUGEINT * (k.total + 5)) // (g.lang_n + 5 * g.v) AS q
           FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    machine = factorisation.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = factorisation.score(docs, machine, carry=["doc_id"])
    return scored.select("doc_id", F.coalesce(~factorisation.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice_score": op1_lattice_score,
    "op2_secret_scan": op2_secret_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_source_mix": op4_source_mix,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_compacted_shards": op8_compacted_shards,
    "op9_simhash": op9_simhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_source_divergence": op11_source_divergence,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES: dict[str, str] = {
    "op2_secret_scan": OP2_SQL,
    "op4_source_mix": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op11_source_divergence": OP11_SQL,
}
