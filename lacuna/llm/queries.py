"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lacuna.llm.bpe import round_trip
from lacuna.llm.conversations import repair_damaged
from lacuna.llm.decontaminate import find_contaminated
from lacuna.llm.divergence import source_divergence
from lacuna.llm.exact_dedup import exact_dedup
from lacuna.llm.html_extract import extract_main_text
from lacuna.llm.minhash import near_duplicates
from lacuna.llm.ngram_join import ngram_components
from lacuna.llm.quality import score_quality, train
from lacuna.llm.secrets import find_secrets
from lacuna.llm.suffix_dedup import drop_repeats
from lacuna.llm.tables import table
from lacuna.llm.token_counts import count_tokens
from lacuna.llm.url_filter import filter_urls, host_glob, host_rule

#: The fixed rules, and hosts whose names say what they are, for URLs that no fixed rule fits.
URL_RULES = (
    host_rule("net/", "block"), host_rule("example.net/en/", "allow"), host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
    *(host_glob(g, "block") for g in ("*adult-*", "*casino-*", "*pills*", "*spam-*")),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_quality(documents, train(documents, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_html_extract, op3_exact_dedup, op4_ngram_join, op5_quality, op6_decontaminate, op7_token_counts,
                            op8_secrets, op9_bpe, op10_suffix_dedup, op11_conversation_repair, op12_minhash, op13_source_divergence)
}

ORACLE: dict[str, str] = {
    "op1_url_filter": r"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') OR fallback IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, fallback
FROM (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL WHEN host LIKE '%casino-%' THEN '*casino-*' WHEN host LIKE '%adult-%' THEN '*adult-*'
                     WHEN host LIKE '%pills%' THEN '*pills*' WHEN host LIKE '%spam-%' THEN '*spam-*' END AS fallback FROM judged)""",
    "op3_exact_dedup": r"""
WITH rows_ AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM rows_""",
    "op4_ngram_join": r"""
WITH RECURSIVE low AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') AS gram
  FROM low, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM low UNION SELECT doc_id, y FROM reach JOIN links ON other = x),
least_ AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least_ LEFT JOIN sizes USING (doc_id)""",
    "op6_decontaminate": r"""
WITH low AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
places AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM low, (SELECT DISTINCT m FROM wins), unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m),
hits AS (SELECT doc_id, i, m, item_id FROM places JOIN wins USING (m, win)),
words_ AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, m)) AS t(k) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
          FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN words_ USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_conversation_repair": r"""
WITH RECURSIVE
bytes_ AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(
               concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda x: ascii(x)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, bytes_),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM named)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_
  FROM damaged),
marked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM ordered),
flagged AS (
  SELECT *, last_ = '' AS blank, seen AND last_ <> '' AS dup, NOT seen AND last_ NOT IN ('', '.', '!', '?') AS cut,
         i > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM marked),
convs AS (SELECT DISTINCT conv_id FROM conversations),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(dup) AS duplicate, count_if(cut) AS truncated, count_if(illegal) AS illegal
  FROM flagged GROUP BY conv_id),
due(s, t, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
inserts AS (
  SELECT s, s AS t, 0 AS cost, '' AS audit, '' AS added FROM due
  UNION ALL SELECT s, t, 2, 'I', chr(10) || role || ':' FROM due
  UNION ALL SELECT a.s, b.t, 4, 'II', chr(10) || a.role || ':' || chr(10) || b.role || ':' FROM due a JOIN due b ON a.t = b.s),
keeps(initial, s, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': ''} AS w, '' AS made FROM convs
  UNION ALL
  SELECT conv_id, i, s, min(w), arg_min(made, w) FROM (
    SELECT d.conv_id, f.i, e.t AS s, {'cost': d.w.cost + n.cost + e.cost + CASE WHEN e.letter <> 'D' AND f.cut THEN 1 ELSE 0 END,
                                      'audit': d.w.audit || n.audit || e.letter} AS w,
           d.made || n.added || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
                                ELSE chr(10) || e.role || ':' || f.text END AS made
    FROM dp d JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1 JOIN inserts n ON n.s = d.s
    JOIN (SELECT 'D' AS letter, NULL AS initial, s, s AS t, 3 AS cost, NULL AS role FROM due
          UNION ALL SELECT 'R', NULL, s, t, 2, role FROM due UNION ALL SELECT 'K', initial, s, t, 0, NULL FROM keeps) e
      ON e.s = n.t AND (e.letter = 'D' OR NOT (f.blank OR f.dup)) AND (e.letter <> 'K' OR e.initial = f.initial)) AS ways
  GROUP BY conv_id, i, s),
closed AS (
  SELECT d.conv_id, min({'cost': d.w.cost + n.cost, 'audit': d.w.audit || n.audit}) AS w,
         arg_min(d.made || n.added, {'cost': d.w.cost + n.cost, 'audit': d.w.audit || n.audit}) AS made
  FROM dp d LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM d.conv_id JOIN inserts n ON n.s = d.s
  WHERE d.i = coalesce(t.n, 0) AND n.t IN (0, 3) GROUP BY d.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, c.w.cost AS cost, c.w.audit AS audit,
       sha256(made[2:]) AS repaired_sha256
FROM closed c LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op12_minhash": r"""
WITH RECURSIVE low AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS gram
  FROM low, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM low UNION SELECT doc_id, y FROM reach JOIN links ON other = x),
least_ AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least_ LEFT JOIN sizes USING (doc_id)""",
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words_ AS (SELECT rid, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words_ GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
vocab AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words_ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (v.total + v.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocab v USING (lang) LEFT JOIN totals t USING (lang, source)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (
  SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
