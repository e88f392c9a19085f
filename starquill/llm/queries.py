"""The registered queries of these operators on the test tables, with DuckDB SQL where it can
express them.  Each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquill.llm import (chat, collocations, decontaminate, html_text, language, merkle,
                            near_duplicates, packing, scoring, sharding, tokens, top_k, url_rules)
from starquill.llm.common import fold, table

VOCABULARY = "byte_bpe_50k.json"


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(*chat.with_foreign_reply(table(spark, sf_dir, "conversations")))


def op1_preference_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(*chat.with_next_reply(table(spark, sf_dir, "conversations")))


def _formatted(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    rows = chat.format_preferences(chosen, rejected)

    def told(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return rows.withColumns({"chosen_spans": told("chosen_spans"),
                             "rejected_spans": told("rejected_spans")})


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op2_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, members = near_duplicates.links(table(spark, sf_dir, "documents"), words=4, percent=85)
    return members.select("doc_id", "n_shingles", "n_links")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                        capacity=1024)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10,
                       scale=1024)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "html")).withColumns({
        "n_chars": F.length("text"), "n_lines": F.size(F.split("text", "\n"))})


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = language.fit(docs.filter(~F.col("held_out")))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               fold(F.col("doc_id"), 7) == 2)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(16)
    grown = sharding.add_shard(tree, sharding.Leaf(16, "region0", "rack0"))
    return sharding.shard_documents(table(spark, sf_dir, "documents"), tree, grown)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), least=100, first=2000)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(touched, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), {"text": text})


QUERIES = {f.__name__: f for f in (
    op1_preference_format, op1_preference_all, op2_ngram_jaccard, op2_ngram_links,
    op3_decontamination, op4_token_counts, op5_best_fit_packing, op6_exact_top_k, op7_html_text, op8_language_id, op9_lm_scores,
    op10_sharding, op11_collocations, op12_url_filters, op13_merkle_manifest)}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS g
  FROM doc_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common_runs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common_runs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reached AS (
  SELECT doc_id, doc_id AS other FROM doc_words
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op2_ngram_links": r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS g
  FROM doc_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common_runs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
degrees AS (
  SELECT a AS doc_id, count(*) AS n_links
  FROM common_runs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both) GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.n_links, 0) AS n_links
FROM doc_words d LEFT JOIN sizes s USING (doc_id) LEFT JOIN degrees l USING (doc_id)
""",
    "op3_decontamination": r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS size
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s)
  WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM doc_words, (SELECT DISTINCT size FROM windows),
       LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS s)),
hits AS (
  SELECT p.doc_id, p.s, p.size, x.item_id
  FROM places p JOIN windows x ON p.win = x.win AND p.size = x.size),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
""",
    "op6_exact_top_k": r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank, vec_id, score
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op1_preference_format": r"""
WITH last AS (
  SELECT conv_id, max(turn) AS ends, arg_max(coalesce(text, ''), turn) AS reply
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
  SELECT a.conv_id AS pair_id, a.ends, b.reply FROM last a JOIN last b ON b.conv_id = a.conv_id + 1),
turns AS (
  SELECT pair_id, 'chosen' AS side, turn, role, text
  FROM conversations JOIN pairs ON conv_id = pair_id
  UNION ALL
  SELECT pair_id, 'rejected', turn, role, text
  FROM conversations JOIN pairs ON conv_id = pair_id WHERE turn < ends
  UNION ALL
  SELECT pair_id, 'rejected', ends, 'assistant', reply FROM pairs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS place,
         '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS header,
         replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM turns),
met AS (
  SELECT pair_id, place, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same
  FROM placed GROUP BY pair_id, place),
splits AS (
  SELECT pair_id, coalesce(min(place) FILTER (NOT same) - 1, max(place)) AS shared
  FROM met GROUP BY pair_id),
parts AS (
  SELECT p.*, s.shared, CASE WHEN place <= shared THEN 'prompt' ELSE side END AS part
  FROM placed p JOIN splits s USING (pair_id)),
measured AS (
  SELECT *, sum(length(header) + length(body)) OVER (
           PARTITION BY pair_id, side, part ORDER BY place) AS stop
  FROM parts)
SELECT pair_id, CAST(0 AS INTEGER) AS segment,
       coalesce(string_agg(header || body, '' ORDER BY place)
                FILTER (part = 'prompt' AND side = 'chosen'), '') AS prompt,
       coalesce(string_agg(header || body, '' ORDER BY place) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(header || body, '' ORDER BY place) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY place)
                FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY place)
                FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_spans,
       any_value(shared) AS prompt_turns, count(*) FILTER (part = 'chosen') AS chosen_turns,
       count(*) FILTER (part = 'rejected') AS rejected_turns
FROM measured GROUP BY pair_id
""",
}

# all conversations: pairs by order of ids; what follows is as above
ORACLES["op1_preference_all"] = r"""
WITH last AS (
  SELECT conv_id, max(turn) AS ends, arg_max(coalesce(text, ''), turn) AS reply
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
  SELECT conv_id AS pair_id, ends, coalesce(lead(reply) OVER (ORDER BY conv_id),
                                            first_value(reply) OVER (ORDER BY conv_id)) AS reply
  FROM last),
turns AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
  UNION ALL
  SELECT conv_id, 'rejected', turn, role, text
  FROM conversations LEFT JOIN pairs ON conv_id = pair_id WHERE ends IS NULL OR turn < ends
  UNION ALL
  SELECT pair_id, 'rejected', ends, 'assistant', reply FROM pairs),
""" + ORACLES["op1_preference_format"][ORACLES["op1_preference_format"].index("placed AS ("):]

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(regexp_split_to_array(t, '[\x20\x09]+'),
                                                          lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]+')) AS t FROM documents)),
grams AS (
  SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM pieces, (SELECT unnest(range(1, 6)) AS m)) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
frequent AS (SELECT * FROM grams WHERE f >= 100),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w
               FROM frequent WHERE m >= 2),
covers AS (
  SELECT lang, a, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS s
        FROM candidates, (SELECT unnest(range(2, 5)) AS k) WHERE k < m)),
covered AS (SELECT lang, phrase, max(a) AS most FROM covers GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN covered v USING (lang, phrase)
         WHERE v.most IS NULL OR 100 * v.most < 100 * c.a),
cuts AS (
  SELECT c.lang, c.phrase, a, n, x.f AS l, y.f AS r, k,
         CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.m], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM cuts),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM lowest WHERE pick = 1)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES["op12_url_filters"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END
                  AS t FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT arg_max(rule, len(rule)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
          AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(verdict, len(rule)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
          AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""

# A row per node and level; the lowest level of the upper tree has the subroots, by source.
ORACLES["op13_merkle_manifest"] = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS tree, lang, n_chars, text, text AS shown,
         false AS is_touched
  FROM documents
  UNION ALL
  SELECT doc_id, source, coalesce('s' || source, 'n'), lang, n_chars, text,
         replace(text, chr(10), ''), true FROM documents),
hashed AS (
  SELECT doc_id, tree, is_touched, text, sha256(concat(
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
    coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-'),
    coalesce(strlen(shown) || ':' || shown, '-'))) AS h
  FROM given),
leaves AS (
  SELECT a.doc_id, a.tree, a.h AS leaf, b.h AS touched,
         row_number() OVER (PARTITION BY a.tree ORDER BY a.doc_id NULLS FIRST, a.h) - 1 AS pos,
         count(*) OVER (PARTITION BY a.tree) AS total
  FROM hashed a JOIN hashed b ON a.doc_id = b.doc_id AND NOT a.is_touched AND b.is_touched),
nodes AS (
  SELECT tree, 0 AS level, pos, total, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, (any_value(total) + 2) // 3,
         sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE total > 1 GROUP BY tree, level, pos // 3),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total
  FROM nodes WHERE total = 1),
upper AS (
  SELECT 0 AS level, pos, total, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(total) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper WHERE total > 1 GROUP BY level, pos // 3),
crcs AS (  -- a byte at a time, eight steps each, by the reversed polynomial
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                            lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents)),
climb AS (
  SELECT doc_id, l.tree, l.leaf, 0 AS level, l.pos, l.total, '' AS proof, false AS is_top,
         CASE WHEN crc % 2 = 0 THEN touched ELSE l.leaf END AS folded
  FROM leaves l JOIN crcs USING (doc_id)
  UNION ALL
  (WITH below AS (
     SELECT c.doc_id, c.tree, c.leaf, c.level, c.pos, c.total, c.proof, c.is_top, c.folded
     FROM climb c WHERE c.total > 1),
   met AS (
     SELECT b.doc_id, b.leaf, any_value(b.tree) AS tree, any_value(b.level) AS level,
            any_value(b.pos) AS pos, any_value(b.total) AS total, any_value(b.proof) AS proof,
            any_value(b.is_top) AS is_top, any_value(b.folded) AS folded,
            coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos < b.pos), '') AS before,
            coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos > b.pos), '') AS after
     FROM below b JOIN (
       SELECT false AS is_top, tree, level, pos, h FROM nodes
       UNION ALL SELECT true, '', level, pos, h FROM upper) x
       ON x.is_top = b.is_top AND x.tree = CASE WHEN b.is_top THEN '' ELSE b.tree END
          AND x.level = b.level AND x.pos // 3 = b.pos // 3
     GROUP BY b.doc_id, b.leaf)
   SELECT doc_id, tree, leaf, level + 1, pos // 3, (total + 2) // 3, proof || before || after,
          is_top, sha256(before || folded || after)
   FROM met
   UNION ALL
   SELECT c.doc_id, c.tree, c.leaf, 0, s.pos, s.total, c.proof, true, c.folded
   FROM climb c JOIN subroots s ON s.tree = c.tree WHERE c.total = 1 AND NOT c.is_top))
SELECT c.doc_id, c.leaf, s.h AS subroot, u.h AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = u.h AS verified
FROM climb c JOIN subroots s ON s.tree = c.tree JOIN upper u ON u.total = 1
WHERE c.is_top AND c.total = 1
"""
