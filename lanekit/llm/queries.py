"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanekit.llm import (ann, bpe, divergence, html, langid, mixing, prefixtrie, quality, simhash, substring, toxicity,
                         urlfilter, warc)
from lanekit.llm.common import WORD, table

QUERIES = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.judged(docs, "q")
    return q.select("doc_id", *[f"q.{m}" for m in quality.MEASURES[:5]], "q.base_failed", "q.kept",
                    F.col("q.good").alias("good_probability"))


MIX_SQL = rf"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         (source_size * 3)::DOUBLE AS cap
  FROM sources),
levels AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place
  FROM weighted),
targets AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT arg_min(level, place) FROM levels WHERE level <= ratio)) AS target
  FROM levels),
placed AS (
  SELECT r.doc_id, r.source, r.key, r.size, t.source_size, t.target,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + bool_or(size > 0 AND before + size / 2.0 <= target - epochs * source_size)
                         OVER (PARTITION BY source, key, doc_id, size)::BIGINT))::BIGINT AS taken
FROM placed
"""

DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurrences AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (
  SELECT g.lang, g.source, coalesce(any_value(l.v), 0) AS v, coalesce(any_value(l.total), 0) AS lang_total,
         coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM groups g LEFT JOIN langs l USING (lang) LEFT JOIN counted c USING (lang, source) GROUP BY g.lang, g.source),
filled AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.total + 2 * s.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (s.lang_total + 2 * s.v) AS q
  FROM sizes s JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
             FROM filled x JOIN filled y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM filled WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS place FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS place FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR place <= 10
"""


TRIE_SQL = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS pos, code, words
  FROM (SELECT conv_id, turn,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
               coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS words
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
whole AS (
  SELECT c.conv_id, b.pos, b.code, b.words FROM convs c JOIN own b ON b.conv_id = c.base AND b.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos + 10, o.code, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
sequences AS (
  SELECT c.conv_id, coalesce(list(w.code ORDER BY w.pos) FILTER (w.pos IS NOT NULL), []::VARCHAR[]) AS codes,
         coalesce(list(w.words ORDER BY w.pos) FILTER (w.pos IS NOT NULL), []::BIGINT[]) AS words
  FROM convs c LEFT JOIN whole w USING (conv_id) GROUP BY c.conv_id),
steps AS (
  SELECT conv_id, d, array_to_string(codes[1:d], '') AS prefix, array_to_string(codes[1:d - 1], '') AS above,
         CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, len(codes) = d AS ends
  FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS d FROM sequences)),
nodes AS (
  SELECT d, prefix, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY d, prefix),
children AS (SELECT d - 1 AS d, above AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (d, prefix)),
totals AS (
  SELECT a.d, a.prefix, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
  FROM counted a JOIN counted b ON b.d >= a.d AND starts_with(b.prefix, a.prefix) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves,
       t.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.d = n.d AND t.prefix = n.prefix
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.above AND n.d > 0
"""


URL_SQL = r"""
WITH rules(host_part, path_part, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parsed AS (
  SELECT row_number() OVER () AS page, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
matches AS (
  SELECT p.page, r.host_part || r.path_part AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page ORDER BY length(r.host_part || r.path_part) DESC, length(r.host_part) DESC) AS place
  FROM parsed p JOIN rules r ON (p.host = r.host_part OR ends_with(p.host, '.' || r.host_part)) AND starts_with(p.path, r.path_part)),
ruled AS (
  SELECT p.*, m.rule, m.verdict AS found FROM parsed p LEFT JOIN matches m ON m.page = p.page AND m.place = 1),
named AS (
  SELECT host, regexp_replace(host, '(?s)^.*@|:[0-9]*$|\.$', '', 'g') AS name, count(found) AS n,
         count(*) FILTER (found = 'block') AS blocked
  FROM ruled GROUP BY host),
suffixed AS (
  SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                 WHEN regexp_matches(name, '^(.*\.)?(ac|co|com|edu|go|gov|mil|ne|net|nom|or|org|sch)\.[a-z]{2}$')
                 THEN array_to_string(string_split(name, '.')[-2:], '.')
                 ELSE string_split(name, '.')[-1] END AS suffix
  FROM named),
hosts AS (
  SELECT *, CASE WHEN length(name) > length(suffix) + 1
                 THEN string_split(left(name, length(name) - length(suffix) - 1), '.')[-1] || '.' || suffix
                 ELSE suffix END AS domain
  FROM suffixed),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(blocked) AS blocked FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(blocked) AS blocked FROM hosts GROUP BY ALL),
start AS (SELECT (sum(blocked) + 0.5::DOUBLE) / (sum(n) + 1) AS mean FROM suffixes),
level_s AS (SELECT s.*, mean FROM suffixes s, start),
fit_s AS (
  SELECT (sum(power(blocked - n * mean, 2)) - sum(n * mean * (1 - mean))) / nullif(sum(n * mean * (1 - mean) * (n - 1)), 0) AS rho
  FROM level_s WHERE n > 0),
weight_s AS (
  SELECT CASE WHEN rho IS NULL THEN 0.5 WHEN rho <= 1.0::DOUBLE / 1001 THEN 1000 ELSE greatest(0.5, 1 / rho - 1) END::DOUBLE AS w FROM fit_s),
rate_s AS (SELECT suffix, (w * mean + blocked) / (w + n) AS rate FROM level_s, weight_s),
level_d AS (SELECT d.*, s.rate AS mean FROM domains d JOIN rate_s s USING (suffix)),
fit_d AS (
  SELECT (sum(power(blocked - n * mean, 2)) - sum(n * mean * (1 - mean))) / nullif(sum(n * mean * (1 - mean) * (n - 1)), 0) AS rho
  FROM level_d WHERE n > 0),
weight_d AS (
  SELECT CASE WHEN rho IS NULL THEN 0.5 WHEN rho <= 1.0::DOUBLE / 1001 THEN 1000 ELSE greatest(0.5, 1 / rho - 1) END::DOUBLE AS w FROM fit_d),
rate_d AS (SELECT suffix, domain, (w * mean + blocked) / (w + n) AS rate FROM level_d, weight_d),
level_h AS (SELECT h.host, h.n, h.blocked, d.rate AS mean FROM hosts h JOIN rate_d d USING (suffix, domain)),
fit_h AS (
  SELECT (sum(power(blocked - n * mean, 2)) - sum(n * mean * (1 - mean))) / nullif(sum(n * mean * (1 - mean) * (n - 1)), 0) AS rho
  FROM level_h WHERE n > 0),
weight_h AS (
  SELECT CASE WHEN rho IS NULL THEN 0.5 WHEN rho <= 1.0::DOUBLE / 1001 THEN 1000 ELSE greatest(0.5, 1 / rho - 1) END::DOUBLE AS w FROM fit_h),
rate_h AS (SELECT host, w, n, (w * mean + blocked) / (w + n) AS rate FROM level_h, weight_h)
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.found, CASE WHEN h.rate - 2 * sqrt(h.rate * (1 - h.rate) / (h.w + h.n + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r JOIN rate_h h USING (host)
"""


# ------------------------------------------------------------------ queries

@register("op8_mix_sources", MIX_SQL)
def op8_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_substring_dedup")
def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs, "q").select("doc_id", "q.n_words", "q.n_removed", "q.kept_sha256")


@register("op7_bpe_round_trip")
def op7_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@register("op3_html_main_text")
def op3_html_main_text(spark, sf_dir):
    return html.main_text(table(spark, sf_dir, "pages"))


@register("op4_warc_archive")
def op4_warc_archive(spark, sf_dir):
    return warc.archived(spark, table(spark, sf_dir, "pages"))


@register("op5_language_id")
def op5_language_id(spark, sf_dir):
    return langid.predictions(table(spark, sf_dir, "documents"))


@register("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, sf_dir):
    return ann.nearest_in_table(table(spark, sf_dir, "embeddings"))


@register("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark, sf_dir):
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


@register("op13_url_filter", URL_SQL)
def op13_url_filter(spark, sf_dir):
    return urlfilter.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
