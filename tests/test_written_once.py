"""Steps that several consumers read are written once."""

import pytest

from quillspark.operators import assemble as A
from quillspark.operators import generate as G
from quillspark.plans import plan_assemble as PA
from quillspark.plans import plan_generate as PG
from quillspark.sources import sinks as S


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, scratch):
    docs = [(i, f"First line {i}.\nThe second. " + "word " * 900, "src", "en", 20) for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{scratch}/once/documents.parquet")
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c}") for c in range(4) for t in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{scratch}/once/conversations.parquet")
    spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/once/labels.parquet")
    return f"{scratch}/once"


def test_a_resumed_run_is_made_once(spark, tables):
    out = PG.p3(spark, tables)
    assert "MapInPandas" not in _plan(out)
    _, chunks = PG.store(spark, tables)
    assert [r.answers for r in out.collect()] == [chunks.count()]


def test_nothing_is_held_against_an_empty_table(spark):
    new = spark.createDataFrame([("c", "v", "a", 1, 1, None), ("d", "v", None, 0, 0, "failed")], G.ANSWER_SCHEMA)
    first = G.record_answers(PG.empty_answers(spark), new)
    assert "LeftAnti" not in _plan(first) and [r.chunk_id for r in first.collect()] == ["c"]
    assert [r.chunk_id for r in G.record_answers(first, new).collect()] == ["c"]


def test_export_moves_an_answer_once(spark, tables):
    lines = PG.s6(spark, tables)
    assert "MapInPandas" not in _plan(lines)
    names = "file_name string, chunk_idx long, chunk_id string, text string"
    docs = spark.createDataFrame([("a.txt",), ("b.md",)], "file_name string")
    chunks = spark.createDataFrame([("a.txt", 0, "c0", ""), ("a.txt", 1, "c1", ""), ("b.md", 0, "d0", "")], names)
    variants = spark.createDataFrame([("a.txt", 0, "v"), ("a.txt", 1, "w"), ("b.md", 0, "v")], "file_name string, variant_idx long, variant_id string")
    answers = spark.createDataFrame([("c0", "v", "A"), ("c1", "v", None), ("c0", "w", "C"), ("d0", "v", "D"), ("d0", "w", "none")], "chunk_id string, variant_id string, answer string")
    out = S.variant_export_lines(docs, variants, answers, chunks, docs)
    assert "Union" not in _plan(out)
    assert sorted(((*r[:2], r[2] or "-") for r in out.collect())) == sorted(
        [("a_variant_0.txt", 0, "A"), ("a_variant_0.txt", 1, "-"), ("a_variant_0.txt", 2, "-"), ("a_variant_0.txt", 3, "-"),
         ("a_variant_1.txt", 0, "C"), ("a_variant_1.txt", 1, "-"), ("b.txt", 0, "D"), ("b.txt", 1, "-")])


def test_steps_are_counted_on_stored_ids(spark, tables):
    out = PA.d11(spark, tables)
    assert "doc_id#" not in _plan(out)
    counts = {r.step: r.rows for r in out.collect()}
    assert counts["qa_pairs"] == 8 and counts["test"] + counts["train"] == counts["dataset"] > 8


def test_tokens_are_looked_up_in_slices(spark, monkeypatch):
    rows = [(i, " ".join(["a", "b", "zz"][: i % 4]) if i % 5 else None) for i in range(23)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("<unk>", 0)], "token string, token_id int")
    whole = {r.id: (r.length, r.ids) for r in A.encode_ids(df, "text", ["id"], vocab).collect()}
    monkeypatch.setattr(A, "LOOKUP_ROWS", 3)
    assert {r.id: (r.length, r.ids) for r in A.encode_ids(df, "text", ["id"], vocab).collect()} == whole
    assert whole[3] == (3, [3, 4, 0]) and whole[6] == (2, [3, 4])
