"""The registered queries of this folder and their SQL, where SQL has them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import secrets as secret_scan
from tideline.llm.ann_forest import nearest
from tideline.llm.centroids import cluster, with_inertia
from tideline.llm.common import keep
from tideline.llm.embedding_dedup import embedding_near_dups
from tideline.llm.language_id import fit, predict
from tideline.llm.mixing import mix
from tideline.llm.packing import pack
from tideline.llm.resampling import importance_resample
from tideline.llm.simhash_dedup import simhash_components
from tideline.llm.substring_dedup import every_passage
from tideline.llm.token_counts import token_counts
from tideline.llm.token_files import read_tokens, write_tokens
from tideline.llm.url_filter import url_verdicts
from tideline.sources.scratch import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_near_dups(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def secret_model(docs: DataFrame) -> secret_scan.Model:
    return secret_scan.train(secret_scan.weak_labels(docs), secret_scan.dictionary(docs))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.findings(docs, secret_model(docs))
    return found.withColumn("candidate", F.sha2("candidate", 256)).withColumnRenamed("candidate", "candidate_sha256")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = predict(docs, fit(docs, ~held_out(F.col("doc_id"))))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


#: The rules of op9's contract. The SQL below and the operator's own example rules have net/de/ and example.net/de/8 the other way round.
OP9_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), OP9_RULES)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_passage(table(spark, sf_dir, "documents")).drop("row")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    return with_inertia(keep(assigned), centroids)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-files/{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder, with_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_counts, op2_embedding_dedup, op3_ann, op4_secret_scan, op5_simhash_dedup, op6_language_id, op7_packing, op8_mixing, op9_url_filter, op10_substring_dedup,
        op11_importance_resampling, op12_centroid_clustering, op13_token_files,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": OP2, "op9_url_filter": OP9, "op12_centroid_clustering": _clustering_sql()}


#: Exact links by a join of all vectors of a label, and their components.
OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
per AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(least(vec_id, coalesce(m, vec_id)) AS BIGINT) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN per ON per.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id
"""

def _name_sql(url: str) -> str:
    """The one name of a url, as in the operator; up to 8 ``..`` segments are resolved."""
    of = lambda k: f"regexp_extract({url}, '(?s)^(.*?)://([^/?#]*)([^?#]*)', {k})"
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    place = f"regexp_replace({of(3)}, '/(\\./)+', '/', 'g')"
    for _ in range(8):
        place = f"regexp_replace(regexp_replace({place}, '^/\\.\\.(/|$)', '/'), '/[^/]+/\\.\\.(/|$)', '/')"
    place = f"coalesce(nullif(regexp_replace({place}, '/\\.$', '/'), ''), '/')"
    bare = f"regexp_replace(CASE {lower(of(1))} WHEN 'http' THEN regexp_replace({lower(of(2))}, ':0*80$', '') WHEN 'https' THEN regexp_replace({lower(of(2))}, ':0*443$', '') ELSE {lower(of(2))} END, ':$', '')"
    return f"CASE WHEN contains({url}, '://') THEN {lower(of(1))} || '://' || {bare} || {place} || regexp_extract({url}, '(?s)^[^?#]*(\\?[^#]*)', 1) ELSE regexp_replace({url}, '(?s)#.*$', '') END"


#: Rules as a table; links from html as in the operator; what blocks and allows reach.
OP9 = rf"""
WITH RECURSIVE rules(verdict, rule) AS (VALUES ('block', 'com/en/'), ('allow', 'example.com/en/7'), ('block', 'net/de/'), ('allow', 'example.net/de/8'), ('block', 'org/es/')),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE contains(url, '://')),
targets AS (
  SELECT url, CASE WHEN regexp_matches(tag, '(?is)rel\s*=\s*["'']?[^"''>]*canonical') THEN regexp_extract(tag, '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''>]+)', 1) END AS t FROM tags),
whole AS (
  SELECT url AS a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t END AS b FROM targets WHERE t <> ''),
links AS (SELECT DISTINCT {_name_sql("a")} AS a, {_name_sql("b")} AS b FROM whole),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
page_names AS (SELECT page_id, url, {_name_sql("url")} AS name FROM pages),
parts(url, host, path) AS (
  SELECT u, translate(regexp_extract(u, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), regexp_extract(u, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3)
  FROM (SELECT a AS u FROM ways UNION SELECT url FROM pages)),
own AS (
  SELECT url, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts LEFT JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY ALL),
reach(name, verdict) AS (SELECT a, verdict FROM ways JOIN own ON url = a WHERE verdict IS NOT NULL UNION SELECT b, verdict FROM reach JOIN ways ON a = name),
carried AS (SELECT name, bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow') AS blocked FROM reach GROUP BY name)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM page_names LEFT JOIN own ON own.url = page_names.url LEFT JOIN carried ON carried.name = page_names.name
"""


def _clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """Every distance of every vector in every round; floors of sums by the remainder."""
    nearest = """SELECT id, v, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT row AS id, a.v, cluster, list_sum(list_transform(list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept a, {c} c) GROUP BY id, v"""
    parts = [
        """kept AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS cluster, v FROM kept QUALIFY cluster < {k})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS ({nearest.format(c=f'c{r}')})")
        parts.append(f"""c{r + 1} AS (
  SELECT cluster, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster))""")
    parts.append(f"last AS ({nearest.format(c=f'c{rounds}')})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(last.cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY last.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM last JOIN kept ON kept.row = last.id JOIN c{rounds} USING (cluster)"""
