"""Registered queries of the operators, and their DuckDB SQL.

``QUERIES`` maps a name to ``(function, sql)``; ``sql`` is ``None`` where SQL
cannot express the operator (those are tested against brute force instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from . import collocations, decontaminate, imatch, jaccard_join, line_dedup, packing, prefix_trie, quality_classifier, quality_rules, secret_scan, substring_dedup, token_counts, warc

QUERIES: dict = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), length=1024, end_id=0)


def _line_report(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    out = line_dedup.dedup_lines(docs, before="input", min_words=min_words)
    n = line_dedup.n_lines(F.col("input"))
    return out.select("doc_id", n.alias("n_lines"), (n - line_dedup.n_lines(F.col("text"))).alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("op1_line_dedup", """
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has FROM raw
), worded AS (
  SELECT doc_id, i, line, row_number() OVER d AS pos,
         lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3
  FROM lines WHERE has WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) AS occurrence
  FROM worded WHERE l3 IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM windows WHERE occurrence > 1
), marked AS (
  SELECT w.doc_id, w.i, g.pos IS NOT NULL AS deleted FROM worded w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos
), kept AS (
  SELECT l.doc_id, count(*) FILTER (WHERE l.has) AS n_lines, count(*) FILTER (WHERE m.deleted) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE NOT coalesce(m.deleted, false)), '') AS kept
  FROM lines l LEFT JOIN marked m ON m.doc_id = l.doc_id AND m.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _line_report(docs)


@_query("op1_passage_dedup", """
WITH lines AS (
  SELECT doc_id, line, i, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)
), worded AS (
  SELECT doc_id, i, line, n, row_number() OVER d AS pos, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3, lead(n, 1) OVER d AS n2
  FROM lines WHERE has WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
  SELECT doc_id, pos, [line, l2, l3] AS w FROM worded WHERE l3 IS NOT NULL
  UNION ALL SELECT doc_id, pos, [line, l2] FROM worded WHERE l2 IS NOT NULL AND n + n2 > 50
  UNION ALL SELECT doc_id, pos, [line] FROM worded WHERE n > 50
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + len(w) - 1)) AS pos
  FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS occurrence FROM windows) WHERE occurrence > 1
), marked AS (
  SELECT w.doc_id, w.i, g.pos IS NOT NULL AS deleted FROM worded w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos
), kept AS (
  SELECT l.doc_id, count(*) FILTER (WHERE l.has) AS n_lines, count(*) FILTER (WHERE m.deleted) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE NOT coalesce(m.deleted, false)), '') AS kept
  FROM lines l LEFT JOIN marked m ON m.doc_id = l.doc_id AND m.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
""")
def op1_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the pipeline's stage: also repeated passages of one or two lines of more than 50 words."""
    return _line_report(table(spark, sf_dir, "documents").select("doc_id", "text"), 50)


@_query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=50256)


@_query("op3_substring_dedup", """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, p, words[p:p + 12] AS win FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS p FROM w WHERE len(words) >= 13)
), owner AS (
  SELECT win, min(doc_id) AS first FROM win GROUP BY win
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS i FROM win JOIN owner USING (win) WHERE first < doc_id
), one AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM w
), kept AS (
  SELECT o.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY o.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM one o LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.i = o.i GROUP BY o.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


@_query("op5_quality_rules", """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents
), g AS (
  SELECT doc_id, p, words[p:p + 2] AS gram FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS p FROM d WHERE len(words) >= 3)
), twice AS (
  SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS i FROM twice) GROUP BY doc_id
), f AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 10 * n_symbols <= n_words AND word_chars BETWEEN 3 * n_words AND 10 * n_words
       AND 2 * n_dup_lines <= n_lines AND upper <= 0.3 * (upper + lower) AS kept
FROM f
""")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@_query("op6_decontamination", """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, k, w[p:p + k - 1] AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p FROM b WHERE len(w) > 0)
), pos AS (
  SELECT doc_id, k, p, w[p:p + k - 1] AS win
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
), hit AS (
  SELECT doc_id, p, pos.k, item_id FROM pos JOIN win ON win.k = pos.k AND win.win = pos.win
), words AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS i FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
""")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


@_query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _secrets_sql() -> str:
    """Matches are marked with chr(1) and chr(2) in the text; the lengths of
    the parts between the marks give their positions."""
    letters = lambda word: "".join(f"[{c}{c.upper()}]" for c in word)
    keys = "|".join([*map(letters, ("password", "passwd", "secret", "token")), letters("api") + "_?" + letters("key")])
    quote = "[\"'']?"             # a single quote, doubled for the SQL literal
    assign = f"({keys}){quote}\\x20*[:=]\\x20*{quote}([A-Za-z0-9+/_.=-]+)"
    kinds = [("assign", assign, f"length(regexp_extract(hit, '{assign}', 2)) >= 12"), ("access", "AKIA[A-Z0-9]+", "length(hit) >= 18"), ("hex", "[0-9a-f]+", "length(hit) >= 16"),
             ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"), ("web_token", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", "true"),
             ("url_login", "[a-z][a-z0-9+.-]{1,15}://[^\\s:/@]{1,64}:[^\\s:/@]{1,64}@", "true"), ("host_token", "gh[pousr]_[A-Za-z0-9]{36,}", "true")]
    spans = []
    for rank, (kind, pattern, keep) in enumerate(kinds):
        spans.append(f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, CAST(start AS BIGINT) AS start, CAST(start + length(hit) AS BIGINT) AS stop FROM (
  SELECT doc_id, i, CASE WHEN i > 1 THEN part[1:strpos(part, chr(2)) - 1] END AS hit,
         coalesce(sum(length(part) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
        FROM (SELECT doc_id, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS parts FROM d)))
  WHERE i > 1 AND {keep}""")
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(spans)}),
a AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id"""


@_query("op9_secret_scan", _secrets_sql())
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


@_query("op10_warc", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS largest FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN largest IS NOT NULL AND largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN largest IS NOT NULL AND largest <> page_id THEN largest END AS refers_to
FROM g
""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@_query("op11_phrase_collocations", """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, x, CAST(count(*) AS BIGINT) AS f FROM (
    SELECT lang, unnest([[y] for y in w]) AS x FROM w
    UNION ALL SELECT lang, unnest([w[i:i + 1] for i in generate_series(1, len(w) - 1)]) FROM w
    UNION ALL SELECT lang, unnest([w[i:i + 2] for i in generate_series(1, len(w) - 2)]) FROM w) GROUP BY lang, x
), c AS (
  SELECT lang, x, f AS a FROM f WHERE len(x) > 1 AND f >= 10
), parts AS MATERIALIZED (
  SELECT lang, x, a, k, x[1:k] AS head, x[k + 1:] AS rest FROM (SELECT lang, x, a, unnest(generate_series(1, len(x) - 1)) AS k FROM c)
), cut AS (
  SELECT c.lang, c.x, c.a, c.k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM parts c JOIN f l ON l.lang = c.lang AND l.x = c.head JOIN f r ON r.lang = c.lang AND r.x = c.rest
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1
), longer AS (
  SELECT lang, s, max(a) AS a FROM (SELECT lang, unnest([x[1:2], x[2:3]]) AS s, a FROM c WHERE len(x) = 3) GROUP BY lang, s
), kept AS (
  SELECT b.lang, array_to_string(b.x, ' ') AS phrase, b.a, b.l, b.r, CAST(b.score AS BIGINT) AS score
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.s = b.x WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, share=50)


@_query("op12_imatch_fingerprints")
def op12_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_report(table(spark, sf_dir, "documents"))


# CRC-32 by its bits (reversed polynomial 0xEDB88320), as DuckDB has no function for it.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), "
          "lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)")


@_query("op13_prefix_trie", f"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT c, turns, {_CRC32} % 9 AS h FROM own
), new AS (
  SELECT h.c, list_concat(CASE WHEN o.c IS NULL THEN [] ELSE o.turns[1:h.h] END, h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN own o ON o.c = h.c - h.c % 5
), path AS (
  SELECT c, d, turns[1:d] AS node, len(turns) = d AS ends FROM (SELECT c, turns, unnest(generate_series(0, len(turns))) AS d FROM new)
), node AS (
  SELECT node, d, min(c) AS c, count(*) AS n, count(*) FILTER (WHERE ends) AS n_ends, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends) AS ends FROM path GROUP BY node, d
), shares AS (
  SELECT c, d, CASE WHEN n = n_ends THEN 1 ELSE 0 END AS leaf, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(node[d].t) END AS saved FROM node
), below AS (
  SELECT p.node, sum(s.leaf) AS n_leaves, sum(s.saved) AS saved, count(*) FILTER (WHERE s.d = p.d + 1) AS n_children FROM path p JOIN shares s ON s.c = p.c AND s.d >= p.d GROUP BY p.node
)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, u.c AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs, CAST(b.n_children AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM node v JOIN below b ON b.node = v.node LEFT JOIN node u ON u.d = v.d - 1 AND u.node = v.node[1:v.d - 1]
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.opening_report(table(spark, sf_dir, "conversations"), every=5, most=9)
