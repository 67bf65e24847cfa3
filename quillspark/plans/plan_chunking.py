"""Chunking queries (T1-T6) over ``documents``.

The test corpus has no law texts, so ``law_text`` turns every document into
one: a preamble, an article header from the id, a real header before every
line starting with ``The `` and a dotted, non-header number before every
line starting with ``El ``. The same expression is written in SQL, so both
sides split identical input. ``t6_split_the`` runs the splitter on the raw
text with marker ``\\nThe``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.pytext import PY_WS
from ..operators import chunking as C
from .registry import query, table


def law_text(df):
    num = lambda m: (F.col("doc_id") % m).cast("string")
    body = F.replace(F.col("text"), F.lit("\nThe "), F.concat(F.lit("\nСтатья "), num(997), F.lit("\nThe ")))
    body = F.replace(body, F.lit("\nEl "), F.concat(F.lit("\nСтатья "), num(991), F.lit(".\nEl ")))
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                     F.concat(F.lit("Преамбула "), F.col("source"), F.lit("\nСтатья "), num(1000),
                              F.lit("\n"), body).alias("text"))


LAW_SQL = ("'Преамбула ' || source || '\nСтатья ' || CAST(doc_id % 1000 AS VARCHAR) || '\n' || "
           "replace(replace(text, '\nThe ', '\nСтатья ' || CAST(doc_id % 997 AS VARCHAR) || '\nThe '), "
           "'\nEl ', '\nСтатья ' || CAST(doc_id % 991 AS VARCHAR) || '.\nEl ')")

_W = "[^" + PY_WS[1:] + "+"


def _strip(x):
    return f"regexp_replace({x}, '\\A{PY_WS}+|{PY_WS}+\\z', '', 'g')"


def _pieces_sql(text_sql, marker, stem, source="documents"):
    m = marker.replace("'", "''")
    hdr = " ".join(
        f"WHEN starts_with(ws[{i}], '{stem}') AND regexp_full_match(ws[{i + 1}], '\\p{{Nd}}+') "
        f"AND length(ws[{i + 1}]) <= 3 THEN ws[{i}] || ' ' || ws[{i + 1}]" for i in (1, 2, 3))
    return f"""
d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, {text_sql} AS t FROM {source}),
sp AS (SELECT doc_id, string_split(t, '{m}') AS parts FROM d),
dp AS (SELECT doc_id, CASE WHEN parts[1] = '' THEN parts[2:] ELSE parts END AS parts FROM sp),
pc AS (SELECT doc_id, unnest(parts) AS raw, unnest(generate_series(0, len(parts) - 1)) AS pi FROM dp),
p AS (SELECT doc_id, pi, CASE WHEN pi >= 1 THEN '{stem}' || raw ELSE raw END AS piece FROM pc),
w AS (SELECT *, regexp_extract_all(piece, '{_W}') AS ws FROM p),
h AS (SELECT *, CASE {hdr} ELSE '' END AS header FROM w),
c AS (SELECT *, coalesce(last_value(nullif(header, '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pi
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS carried FROM h)"""


def _split_sql(text_sql, marker, stem, size=2000, source="documents"):
    return "WITH " + _pieces_sql(text_sql, marker, stem, source) + f""",
small AS (SELECT doc_id, pi, 1 AS k, piece AS chunk FROM c WHERE length(piece) <= {size} AND {_strip('piece')} <> ''),
big AS (SELECT doc_id, pi, piece, carried, ws,
        list_reduce(list_transform(ws, lambda x: length(x)),
          lambda acc, n: CASE WHEN acc.cur + n + 1 > {size}
               THEN {{'cur': n + 1, 'i': acc.i + 1,
                      'starts': CASE WHEN acc.cur > 0 THEN list_append(acc.starts, acc.i) ELSE acc.starts END}}
               ELSE {{'cur': acc.cur + n + 1, 'i': acc.i + 1, 'starts': acc.starts}} END,
          {{'cur': 0::BIGINT, 'i': 0::BIGINT, 'starts': [0::BIGINT]}}).starts AS starts
        FROM c WHERE length(piece) > {size} AND len(ws) > 0),
bg AS (SELECT *, unnest(starts) AS s, unnest(generate_series(1, len(starts))) AS k FROM big),
sub AS (SELECT doc_id, pi, k, piece, carried,
        array_to_string(ws[s + 1 : coalesce(starts[k + 1], len(ws))], ' ') AS sub FROM bg),
subl AS (SELECT doc_id, pi, k, CASE WHEN sub <> {_strip('piece')} AND carried <> ''
         THEN carried || ' (продолжение)\n' || sub ELSE sub END AS chunk FROM sub),
allc AS (SELECT * FROM small UNION ALL SELECT * FROM subl)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pi, k) - 1 AS BIGINT) AS chunk_idx, chunk
FROM allc"""


@query("t6_split_law", _split_sql(LAW_SQL, C.DEFAULT_MARKER, C.DEFAULT_STEM), bench=True)
def t6_split_law(spark, sf):
    return C.split_documents(law_text(table(spark, sf, "documents")), keys=["doc_id"])


@query("t6_split_the", _split_sql("text", "\nThe", "The"))
def t6_split_the(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return C.split_documents(docs, keys=["doc_id"], marker="\nThe", stem="The")


@query("t1_t3_pieces_headers", "WITH " + _pieces_sql(LAW_SQL, C.DEFAULT_MARKER, C.DEFAULT_STEM)
       + "\nSELECT doc_id, CAST(pi AS BIGINT) AS piece_idx, piece, header, carried FROM c")
def t1_t3(spark, sf):
    return C.pieces_with_headers(law_text(table(spark, sf, "documents")), keys=["doc_id"])


@query("t4_pack_small_size", _split_sql("text", "\nThe", "The", size=300))
def t4_pack_small(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return C.split_documents(docs, keys=["doc_id"], marker="\nThe", stem="The", size=300)


SEP = "␞"


@query("t6_split_result_arrays", f"""WITH r AS ({_split_sql(LAW_SQL, C.DEFAULT_MARKER, C.DEFAULT_STEM)}),
g AS (SELECT doc_id, list(chunk ORDER BY chunk_idx) AS chunks FROM r GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(coalesce(len(g.chunks), 0) AS BIGINT) AS n_chunks,
       coalesce(array_to_string(g.chunks, '{SEP}'), '') AS chunks
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""")
def t6_arrays(spark, sf):
    """The split result in the reference's shape (one chunk list per
    document), compared as the chunks joined by a separator symbol."""
    arr = C.split_documents_arrays(law_text(table(spark, sf, "documents")), keys=["doc_id"])
    return arr.select("doc_id", F.size("chunks").cast("bigint").alias("n_chunks"),
                      F.array_join("chunks", SEP).alias("chunks"))
