"""The named queries of this package, each over a whole table, and the SQL that checks them.

`public_tokenizers` names the vocabulary files; their paths are parameters of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import alignment, anchors, archive, clustering, exact, inner_search, languages
from tiffin.llm import mixing, pieces, simhash, suffixes, token_counts, urls
from tiffin.llm.common import documents, small_batches, stored
from tiffin.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def sha256(text) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encode(
        documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), decoded=True
    )
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT
      AS hash
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    coalesce(sum(source_size * 2.0::DOUBLE) OVER below, 0) AS clamped,
    sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS open_weight,
    1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sources
  WINDOW below AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  -- the level at which the source itself is open and all with a lower ratio are clamped
  SELECT max((total - clamped) / open_weight) FILTER (
    WHERE (total - clamped) / open_weight * weight <= cap) AS level FROM filled
), plan AS (
  SELECT source, source_size,
    CASE WHEN level IS NULL OR level * weight > cap THEN cap ELSE level * weight END AS target
  FROM filled, levels
), repeats AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
  FROM plan
), running AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
    2 * coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size AS middle
  FROM sized d JOIN repeats p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN middle < 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT
    AS taken
FROM running
"""


@query("op2_mix_sources", OP2_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = mixing.mixing_plan(documents(spark, sf_dir))
    return mixing.copies(rows, plan).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


OP3_SQL = """
WITH usable AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), parts AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scores)
WHERE rank <= 10
"""


@query("op3_top_k", OP3_SQL)
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return inner_search.top_k(vectors, F.col("id") % 100 == 0).withColumnRenamed("id", "vec_id")


OP4_SQL = r"""
WITH found AS (
  SELECT doc_id, len(ws) AS n_words, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents)
), windows AS (
  SELECT *, CASE WHEN i + 49 <= n_words THEN sha256(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS w
  FROM found
), judged AS (
  SELECT *, w IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY w) AS starts FROM windows
), marked AS (
  SELECT *, coalesce(bool_or(starts) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM judged
), cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
  coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut c ON c.doc_id = d.doc_id
"""


@query("op4_substring_dedup", OP4_SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.remove_repeats(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", sha256(F.col("kept")).alias("kept_sha256")
    )


OP5_SQL = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""


@query("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("sha256").alias("text_sha256"),
    )


#: (verdict, host, start of the path)
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

OP6_SQL = r"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), split AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), paths AS (SELECT host, path, count(*) AS n FROM split GROUP BY host, path
), ruled AS (
  SELECT host, path, any_value(n) AS n,
    arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(r.verdict, length(rule_host || rule_path)) AS verdict
  FROM paths LEFT JOIN rules r
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
), seeds AS (
  SELECT host, sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) / sum(n) AS trust,
    sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) / sum(n) AS distrust
  FROM ruled WHERE host <> '' GROUP BY host
), found AS (
  SELECT host AS src, unnest(regexp_extract_all(html,
    '(?i)href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)) AS target
  FROM split
), links AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, regexp_replace(translate(target, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '^[^@]*@|:[0-9]*$', '', 'g') AS dst FROM found)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), flows AS (
  SELECT src, dst, 1 AS along, 0.85 * n / sum(n) OVER (PARTITION BY src) AS share FROM links
  UNION ALL
  SELECT dst, src, 0, 0.85 * n / sum(n) OVER (PARTITION BY dst) FROM links
), reached AS (
  SELECT host, trust, distrust, 0 AS step FROM seeds
  UNION ALL
  SELECT dst, sum(along * trust * share), sum((1 - along) * distrust * share), step + 1
  FROM reached JOIN flows ON host = src WHERE step < 50 GROUP BY dst, step
), scores AS (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM reached GROUP BY host
)
SELECT page_id, s.host, s.path, r.rule,
  CASE WHEN r.verdict IS NOT NULL THEN r.verdict
    WHEN c.distrust >= 0.5 AND c.distrust > c.trust THEN 'block' ELSE 'allow' END AS verdict
FROM split s JOIN ruled r ON s.host = r.host AND s.path = r.path
LEFT JOIN scores c ON c.host = s.host
"""


@query("op6_url_filter", OP6_SQL)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.judge(pages, URL_RULES).withColumnRenamed("id", "page_id")


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    )
    return rows.withColumnRenamed("id", "doc_id")


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = languages.train(docs, ~languages.held_out(F.col("doc_id")))
    return languages.identify(docs, model).select(
        F.col("id").alias("doc_id"),
        languages.held_out(F.col("id")).alias("held_out"),
        "lang_pred",
        "score",
    )


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    aligned = alignment.align(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    digest = F.when(F.col("n_a") > 0, sha256(F.col("groups"))).otherwise("")
    rows = stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.weigh_links(rows).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256",
    )


def _op12_sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """The rounds one after the other; c0, c1, ... are the centroids, a0, a1, ... the clusters."""
    steps = [
        f"""kept AS (
  SELECT vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dims}
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS cluster, v AS c
  FROM (SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h LIMIT {k})
)"""
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS (
  SELECT vec_id, v, cluster, distance FROM (
    SELECT vec_id, v, cluster, distance,
      row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place
    FROM (SELECT vec_id, v, cluster,
        list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, {dims + 1})])::BIGINT AS distance
      FROM kept, c{turn}))
  WHERE place = 1
)""")
        if turn < rounds:
            steps.append(f"""c{turn + 1} AS (
  SELECT old.cluster, coalesce(fresh.c, old.c) AS c FROM c{turn} old LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS c FROM (
      SELECT cluster, i, sum(v[i]) AS s, count(*) AS n
      FROM a{turn}, range(1, {dims + 1}) t(i) GROUP BY cluster, i)
    GROUP BY cluster) fresh ON fresh.cluster = old.cluster
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT a.vec_id, a.cluster, a.distance,
  sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(a.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster"""


@query("op12_centroid_clustering", _op12_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return clustering.clusters(vectors).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        sha256(F.col("centroid")).alias("centroid_sha256"),
    )


@query("op13_token_archive")
def op13_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = archive.archived(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
        work_path(spark, "token-archive"), end_id=2,
    )
    return rows.select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
