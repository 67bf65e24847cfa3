"""Charset queries (X1-X5) over the words of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.pytext import PY_WS, py_split
from ..operators import charset as X
from .registry import query, table

_W = "[^" + PY_WS[1:] + "+"


@query("x1_script_flags", f"""SELECT doc_id, regexp_matches(text, '[İıĞğÜüŞşÖöÇç]') AS turkish,
  regexp_matches(text, '[\\x{{0370}}-\\x{{03FF}}\\x{{1F00}}-\\x{{1FFF}}]') AS greek, regexp_matches(text, '[а-яА-Я]') AS russian
  FROM documents""")
def x1(spark, sf):
    return X.script_flags(table(spark, sf, "documents"), "text", ["doc_id"])


def words(spark, sf):
    return table(spark, sf, "documents").select(F.explode(py_split("text")).alias("token"))


def _sql_decoded(encoding: str) -> str:
    """DuckDB: Latin-1 text ``t`` decoded with ``encoding`` (independent of
    the Spark expression: UTF-8 goes through hex)."""
    if encoding == "utf-8":
        return ("decode(unhex(array_to_string(list_transform(string_split(t, ''), lambda c: lpad(lower(hex(unicode(c))), 2, '0')), '')), 'ignore')")
    pairs = [(chr(b), bytes([b]).decode(encoding, "ignore")) for b in range(128, 256)]
    have = "".join(a for a, c in pairs if c and a != c) + "".join(a for a, c in pairs if not c)
    want = "".join(c for a, c in pairs if c and a != c)
    return f"translate(t, '{have}', '{want}')"


def _x2_sql() -> str:
    first = ["utf-8", "iso-8859-9", "cp1254", "cp857"]
    groups = [("turkish", ["utf-8", "iso-8859-9", "cp857", "cp1254"]), ("greek", ["utf-8", "iso-8859-7", "cp1253", "cp737"]),
              ("cyrillic", ["utf-8", "windows-1251", "cp1251", "koi8-r", "cp866"]), ("latin", ["utf-8", "latin1", "iso-8859-1", "cp1252"])]
    rows = [f"SELECT token, text, {i} AS k, 'turkish' AS lang_group, '{e}' AS encoding, {_sql_decoded(e)} AS decoded FROM latin" for i, e in enumerate(first)]
    n = len(first)
    for g, encodings in groups:
        for e in encodings:
            rows.append(f"SELECT token, text, {n}, '{g}', '{e}', {_sql_decoded(e)} FROM latin")
            n += 1
    return rf"""WITH toks AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{_W}')) AS token FROM documents),
  texts AS (SELECT token, CASE WHEN token[1] = 'Ġ' THEN token[2:] ELSE token END AS text FROM toks),
  latin AS (SELECT token, text, regexp_replace(text, '[^\x{{00}}-\x{{FF}}]', '', 'g') AS t FROM texts),
  cands AS ({' UNION ALL '.join(rows)}),
  foremost AS (SELECT token, min(k) AS k FROM cands WHERE k < 4 AND regexp_matches(decoded, '[İıĞğÜüŞşÖöÇç]') GROUP BY token),
  kept AS (SELECT c.* FROM cands c LEFT JOIN foremost l ON l.token = c.token
    WHERE (c.k < 4 AND c.k = l.k) OR (c.k >= 4 AND decoded <> '' AND decoded <> c.text AND regexp_matches(decoded, '[^?□]'))),
  placed AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY k) - 1 AS pos FROM kept),
  once AS (SELECT *, row_number() OVER (PARTITION BY token, decoded ORDER BY pos) AS rn FROM placed)
  SELECT token, CAST(pos AS BIGINT) AS cand_pos, lang_group, encoding, decoded,
  CASE WHEN regexp_matches(decoded, '[İıĞğÜüŞşÖöÇç]') THEN 'T' ELSE ' ' END ||
  CASE WHEN regexp_matches(decoded, '[\x{{0370}}-\x{{03FF}}\x{{1F00}}-\x{{1FFF}}]') THEN 'G' ELSE ' ' END ||
  CASE WHEN regexp_matches(decoded, '[а-яА-Я]') THEN 'R' ELSE ' ' END AS marker,
  trim(regexp_replace(lower(hex(encode(decoded))), '(..)', '\1 ', 'g')) AS utf8_hex FROM once WHERE rn = 1"""


@query("x2_x4_decode_candidates", _x2_sql())
def x2(spark, sf):
    cands = X.decode_candidates(words(spark, sf))
    return X.report(cands).select("token", F.col("cand_pos").cast("long").alias("cand_pos"), "lang_group", "encoding", "decoded", "marker", "utf8_hex")


@query("x5_report_words", f"""SELECT DISTINCT token,
  CASE WHEN regexp_matches(token, '[İıĞğÜüŞşÖöÇç]') THEN 'T' ELSE ' ' END ||
  CASE WHEN regexp_matches(token, '[\\x{{0370}}-\\x{{03FF}}\\x{{1F00}}-\\x{{1FFF}}]') THEN 'G' ELSE ' ' END ||
  CASE WHEN regexp_matches(token, '[а-яА-Я]') THEN 'R' ELSE ' ' END AS marker,
  trim(regexp_replace(lower(hex(encode(token))), '(..)', '\\1 ', 'g')) AS utf8_hex
  FROM (SELECT unnest(regexp_extract_all(text, '{_W}')) AS token FROM documents)""")
def x5(spark, sf):
    return X.report(words(spark, sf).distinct(), "token").select("token", "marker", "utf8_hex")
