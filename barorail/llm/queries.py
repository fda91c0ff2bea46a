"""The operators' queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import BpeAutomaton, round_trip_digests
from .chat import chat_digests
from .clusters import cluster_vectors
from .common import table
from .compression import classify
from .minhash import near_duplicates
from .packing import pack_documents, packed_digests
from .pieces import piece_digests
from .resampling import resampled
from .rules import quality_rules
from .secrets import secret_digests
from .suffixes import repeated_passages
from .urls import judge_urls
from .vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("word_bpe_49k.json")
    return packed_digests(pack_documents(table(spark, sf_dir, "documents"), file, keep_ids=True, as_coded=True))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = BpeAutomaton.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return round_trip_digests(table(spark, sf_dir, "documents"), automaton)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat_digests(turns.unionByName(extra))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_url_filters": op2_url_filters,
        "op3_minhash_near_dedup": op3_minhash_near_dedup,
        "op4_embedding_near_dedup": op4_embedding_near_dedup,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_bpe": op7_bpe,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_secret_scans": op9_secret_scans,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_centroid_clustering": op13_centroid_clustering,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": OP2_SQL,
        "op8_chat_formatting": OP8_SQL,
        "op12_importance_resampling": OP12_SQL,
        "op13_centroid_clustering": OP13_SQL,
    }


OP2_SQL = r"""
WITH rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rests
), named AS (
    SELECT page_id, path,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM parts
), ruled AS (
    SELECT n.page_id, n.host, n.path, r.rule, r.verdict
    FROM named n LEFT JOIN (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow'))
        AS r(rule, rule_host, rule_path, verdict)
    ON (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host)) AND starts_with(n.path, r.rule_path)
), best AS (
    SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM ruled GROUP BY page_id, host, path
), globbed AS (
    SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
        WHEN contains(host, 'casino') AND starts_with(path, '/') THEN '*casino*/**'
        WHEN contains(host, 'porn') AND starts_with(path, '/') THEN '*porn*/**'
        WHEN contains(host, 'viagra') AND starts_with(path, '/') THEN '*viagra*/**'
        WHEN contains(path, '/wp-login.php') THEN '**/wp-login.php**'
        WHEN contains(path, '/cgi-bin/') THEN '**/cgi-bin/**'
        WHEN ends_with(host || path, '.exe') THEN '**.exe' END AS blocked_by
    FROM best
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN blocked_by IS NULL THEN 'allow' ELSE 'block' END) AS verdict, blocked_by
FROM globbed
"""

OP8_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), follow AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS earlier FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       sum(17 + length(replace(replace(replace(role, '%', '%25'), '>', '%3E'), chr(10), '%0A'))
           + length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')))::BIGINT AS formatted_chars,
       bool_and(CASE role WHEN 'system' THEN earlier IS NULL
                          WHEN 'user' THEN earlier IS NULL OR earlier IN ('system', 'assistant')
                          WHEN 'assistant' THEN coalesce(earlier = 'user', false) ELSE false END) AS valid
FROM follow GROUP BY conv_id
"""

OP12_SQL = r"""
WITH tab AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
        FROM (SELECT unnest(range(256)) AS i))
), texts AS (
    SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS MATERIALIZED (
    SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), found AS MATERIALIZED (
    SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
        || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM words
), hexed AS (
    SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM found)
), hashed AS MATERIALIZED (
    SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2),
        lambda i: 16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, tab
), placed AS MATERIALIZED (
    SELECT side, id, bucket FROM found JOIN hashed USING (f)
), counts AS (
    SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts
), weighed AS (
    SELECT id, count(*) AS n, sum(gain) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
    SELECT id AS doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, len(w) >= 20 AS fits,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM words LEFT JOIN weighed USING (id) WHERE side = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fits) OVER () AS total FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= 5 * total // 100 THEN place END AS rank FROM ranked
"""

_ROUND = """a{r} AS MATERIALIZED (
    SELECT vec_id, c, distance FROM (
        SELECT vec_id, c, distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) AS place FROM (
            SELECT x.vec_id, k.c, sum((x.x - k.x) * (x.x - k.x)) AS distance FROM x JOIN c{r} k USING (d) GROUP BY ALL))
    WHERE place = 1
)"""
_MOVE = """c{n} AS MATERIALIZED (
    SELECT k.c, k.d, CASE WHEN m.n > 0 THEN (m.s - (m.s % m.n + m.n) % m.n) // m.n ELSE k.x END AS x
    FROM c{r} k LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{r} JOIN x USING (vec_id) GROUP BY c, d) m
    ON m.c = k.c AND m.d = k.d
)"""
OP13_SQL = (
    """
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), x AS MATERIALIZED (
    SELECT vec_id, unnest(range(64)) AS d, unnest(v) AS x FROM kept
), c0 AS MATERIALIZED (
    SELECT c, d, x FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept) USING (vec_id)
    WHERE c < 8
), """
    + ", ".join(_ROUND.format(r=r) + (", " + _MOVE.format(r=r, n=r + 1) if r < 10 else "") for r in range(11))
    + """, named AS (
    SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c10 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    centroid_sha256
FROM a10 JOIN named USING (c)
"""
)
