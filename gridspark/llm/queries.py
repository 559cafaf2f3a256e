"""The opN_ queries over the given tables, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from gridspark.llm import alignment, bpe, capfilters, chat, divergence, linededup, mixing, omh, quality, secrets, simhash, tokencounts, warc


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality.resample(docs, labels)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = linededup.dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    return docs.select("doc_id", "lines_removed", lines.alias("lines_left"), F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = simhash.near_groups(docs)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.order_minhash(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    clash = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias("role"), F.lit(clash).alias("text"))
    rows = chat.read_back(chat.formatted(turns.unionByName(more)))
    turn = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))
    return rows.select(
        "conv_id",
        F.size("texts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = secrets.scan(docs, secrets.train(docs))
    base = tuple(x[0] for x in secrets.BASE)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, base), F.sha2(secrets.joined("spans", base), 256).alias("base_sha256"), secrets.joined("spans", (*base, "crf")).alias("spans"))


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_quality_resample": op2_quality_resample,
    "op3_line_dedup": op3_line_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_mix_sources": op6_mix_sources,
    "op7_chat_format": op7_chat_format,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc_round_trip": op9_warc_round_trip,
    "op10_bpe_encode": op10_bpe_encode,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_counts": op12_token_counts,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
c AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS x FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
l AS (SELECT a, b FROM c WHERE isfinite(x) AND x >= 0.9),
r(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id AND r.root < l.b),
m AS (SELECT id, min(root) AS root FROM r GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, root AS component_id, vec_id = root AS kept FROM v JOIN m ON id = vec_id""",
    "op6_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY (3 * source_size) / w, source NULLS LAST) AS k FROM s),
l AS (
  SELECT source, w, source_size,
         CAST(CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS DOUBLE)
           / CAST(sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM o),
t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * (SELECT max(level) FROM l)) AS target FROM l),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r""",
    "op7_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(t, '(\\*)(<s>|</s>|\[INST\]|\[/INST\]|\[OUT\]|\[/TURN\]|\[TURN:[^\]\[]*\])', '\\\1\2', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 ELSE 16 + length(url_encode(role)) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op9_warc_round_trip": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM m""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (
  SELECT d.lang, d.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 5)) // (v.total + 5 * v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50""",
}
