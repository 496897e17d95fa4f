"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfwise.llm.alignment import cross_tokenizer_counts
from shelfwise.llm.bpe import digest_documents
from shelfwise.llm.collocations import collocations
from shelfwise.llm.common import table
from shelfwise.llm.decontaminate import find_leaks
from shelfwise.llm.exact_dedup import exact_dedup
from shelfwise.llm.jaccard import jaccard_components
from shelfwise.llm.language_model import score_texts
from shelfwise.llm.pii import digests, find_pii
from shelfwise.llm.quality import quality_scores
from shelfwise.llm.quality_rules import quality_rules
from shelfwise.llm.substring_dedup import repeated_passages
from shelfwise.llm.toxicity import toxicity_scores
from shelfwise.llm.url_filter import UrlRule, url_filter

#: The rules of the contract.
RULES = (
    UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), RULES)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_pii(table(spark, sf_dir, "documents")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("piece_bpe_32k.model"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: fn for name, fn in globals().items() if name.startswith("op")}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0]))) | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = {"op1_url_filter": OP1, "op5_jaccard_join": OP5, "op9_exact_dedup": OP9, "op11_collocations": OP11, "op13_quality_rules": OP13}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


OP1 = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""

OP5 = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.b, r.c FROM reach r JOIN both_ways l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""

OP9 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""

OP11 = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
sizes AS MATERIALIZED (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, gram, count(*) AS f FROM (
    SELECT lang, w[i:i + k - 1] AS gram FROM starts, range(1, 6) AS t(k) WHERE i + k - 1 <= len(w))
  GROUP BY lang, gram HAVING count(*) >= 100),
candidates AS MATERIALIZED (SELECT lang, gram, f AS a FROM f WHERE len(gram) > 1),
inside AS (
  SELECT DISTINCT lang, part FROM (
    SELECT c.lang, c.a, unnest(list_transform(range(1, len(gram) - k + 2), lambda i: gram[i:i + k - 1])) AS part
    FROM candidates c, range(2, 5) AS t(k) WHERE k < len(gram)) x
  JOIN candidates y USING (lang) WHERE y.gram = x.part AND 100 * x.a >= 100 * y.a),
kept AS (SELECT c.* FROM candidates c LEFT JOIN inside s ON s.lang = c.lang AND s.part = c.gram WHERE s.part IS NULL),
cuts AS (
  SELECT kept.lang, kept.gram, a, k, x.f AS l, y.f AS r, n, 1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(gram))) AS k FROM kept) AS kept
  JOIN f x ON x.lang = kept.lang AND x.gram = kept.gram[1:k]
  JOIN f y ON y.lang = kept.lang AND y.gram = kept.gram[k + 1:]
  JOIN sizes ON sizes.lang = kept.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
  FROM (SELECT *, array_to_string(gram, ' ') AS phrase FROM best))
SELECT * FROM ranked WHERE rank <= 2000
"""

OP13 = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
words AS MATERIALIZED (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists),
lines AS (
  SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup_lines AS (
  SELECT r, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS dup_line_chars
  FROM lines WHERE again GROUP BY r),
windows AS (
  SELECT r, n, i, row_number() OVER (PARTITION BY r, n, gram ORDER BY i) > 1 AS later, count(*) OVER (PARTITION BY r, n, gram) > 1 AS twice
  FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lists, (VALUES (3), (5), (6), (7), (8), (9), (10)) AS t(n)
              WHERE len(w) >= n))),
covered AS (
  SELECT n, r, i FROM (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS i FROM windows WHERE CASE WHEN n = 3 THEN twice ELSE later END)),
dup_words AS (
  SELECT r, count(*) FILTER (n = 3) AS n_repeat_words, {sums}
  FROM covered JOIN words USING (r, i) GROUP BY r),
sizes AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r),
all_of AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {names}
  FROM docs LEFT JOIN sizes USING (r) LEFT JOIN dup_lines USING (r) LEFT JOIN dup_words USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * dup_line_chars > 20 * word_chars OR {limits}) AS kept
FROM all_of
""".replace("{sums}", ", ".join(f"sum(length(word)) FILTER (n = {n}) AS d{n}" for n in range(5, 11))) \
    .replace("{names}", ", ".join(f"coalesce(d{n}, 0)::BIGINT AS dup_chars_{n}" for n in range(5, 11))) \
    .replace("{limits}", " OR ".join(f"100 * dup_chars_{n} > {20 - n} * word_chars" for n in range(5, 11)))
