"""The registered queries of this package: every operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontamination, exact_dedup, filter_audit, html_text, language, near_dedup, packing, secret_scan,
               token_count, toxicity, url_filter, va_clusters)
from .batches import small_batches

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


@query
def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.clustered(table(spark, sf_dir, "embeddings")).drop("n_candidates")


#: Rules of the URL query.
RULES = [url_filter.Rule("block", "net"), url_filter.Rule("allow", "example.net", "/en/"),
         url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), RULES)


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
     g AS (SELECT norm, first(doc_id ORDER BY points DESC, doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256,
       d.points AS n_points
FROM d JOIN g USING (norm)
"""


def _cluster_sql(rounds: int) -> str:
    """Floors, the first centroids, ``rounds`` of assignment and update, and the last assignment."""
    parts = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id,
                     list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS x FROM embeddings
              WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
     c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS c, x
              FROM (SELECT x, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, x LIMIT 16))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT i, min(struct_pack(d := d, c := c)) AS best FROM (
                SELECT v.i, c.c, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
                FROM v CROSS JOIN c{r} AS c) GROUP BY i)""")
        if r < rounds:
            parts.append(f"""s{r} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::HUGEINT ORDER BY k) AS x FROM (
                SELECT c, k, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
                    SELECT best.c AS c, unnest(x) AS e, unnest(range(64)) AS k FROM a{r} JOIN v USING (i)) GROUP BY c, k) GROUP BY c),
     c{r + 1} AS MATERIALIZED (SELECT c, coalesce(s{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN s{r} USING (c))""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (i) JOIN c{rounds} AS c ON c.c = best.c
"""


ORACLE["op11_centroid_clusters"] = _cluster_sql(3)

ORACLE["op12_url_filter"] = """
WITH rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
     rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     u AS (SELECT row_number() OVER () AS i, page_id,
                  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
     best AS (SELECT i, max_by(struct_pack(rule := r.host || r.path, verdict := verdict), length(r.host || r.path)) AS b
              FROM u JOIN rules r ON ends_with('.' || u.host, '.' || r.host) AND starts_with(u.path, r.path) GROUP BY i)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (i)
"""

ORACLE["op13_filter_audit"] = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                  min(doc_id) OVER (PARTITION BY text) AS first FROM d),
     f AS (SELECT doc_id, part, concat(
               CASE WHEN len(words) < 200 THEN 'A' END,
               CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 'B' END,
               CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' END,
               CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
               CASE WHEN doc_id > first THEN 'E' END) AS fails FROM w),
     l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
     cells AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
               FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
     letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
                WHERE list_unique([a.x, b.x, c.x, d.x, e.x]) = 5),
     steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
               FROM orders, (SELECT unnest(range(1, 6)) AS step)),
     met AS (SELECT *, contains(fails, f) AS failing, length(translate(before, fails, '')) < length(before) AS gone FROM cells, steps),
     r AS (SELECT part, filter_order, step::INTEGER AS step, f,
                  coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept,
                  coalesce(sum(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
                  coalesce(sum(n) FILTER (gone AND failing), 0)::BIGINT AS redundant,
                  coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
                  coalesce(sum(good) FILTER (NOT gone AND failing), 0)::BIGINT AS good_lost,
                  coalesce(sum(toxic) FILTER (NOT gone AND failing), 0)::BIGINT AS toxic_lost
           FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""
