"""Python-compatible text helpers and the splitter (T1-T6): chunks worked out
by hand, and invariants on random texts."""

import random

from pyspark.sql import functions as F

from quillspark.functions.pytext import py_split, py_strip
from quillspark.operators import chunking as C

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_py_strip_split(spark):
    texts = [WS + "a" + WS + "b c" + WS, "", "   ", "x\n", " y z\u001cq", "no-ws"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(py_strip("t").alias("s"), py_split("t").alias("w")).collect()
    for t, r in zip(texts, rows):
        assert r["s"] == t.strip()
        assert list(r["w"]) == t.split()


def words(n, w="слово"):
    return " ".join([w] * n)


# Texts and the chunks that the rules give, worked out by hand. A long piece
# takes words while they and a space each fit: 333 words of five letters are
# 1998 characters, 285 of six are 1995.
CASES = [
    ("\nСтатья 1\nТекст первой статьи.\nСтатья 2\nВторая.", ["ья 1\nТекст первой статьи.", "Статья 2\nВторая."]),
    ("Преамбула.\nСтатья 5\n" + words(500), ["Преамбула.", "Статья 5 (продолжение)\nСтатья 5 " + words(331), "Статья 5 (продолжение)\n" + words(169)]),
    # The header of the last article that had one stays in force.
    ("Статья 5 а\nСтатья 6. нет\nСтатьи " + words(400), ["Статья 5 а", "Статья 6. нет", "Статья 5 (продолжение)\nСтатьи " + words(332), "Статья 5 (продолжение)\n" + words(68)]),
    # No header so far: no label.
    ("Статья 124. с точкой " + words(400), ["Статья 124. с точкой " + words(329), words(71)]),
    ("Статья 1234 четыре " + words(340), ["Статья 1234 четыре " + words(330), words(10)]),
    # A word longer than a chunk stands alone, over the bound.
    ("Статья 7\n" + "а" * 2500 + " хвост", ["Статья 7 (продолжение)\nСтатья 7", "Статья 7 (продолжение)\n" + "а" * 2500, "Статья 7 (продолжение)\nхвост"]),
    ("   \n  \t ", []),
    ("", []),
    ("x" * 2000, ["x" * 2000]),
    ("x" * 2001, ["x" * 2001]),
    # Short pieces keep their white space; U+001C separates words as in Python.
    (" а \x1cб ", [" а \x1cб "]),
    ("Статья 12 текст с\x1cчастями " + "w " * 1000, ["Статья 12 (продолжение)\nСтатья 12 текст с частями " + " ".join("w" * 987), "Статья 12 (продолжение)\n" + " ".join("w" * 13)]),
    ("\nСтат", ["Стат"][:0]),
    # The header may be among the first four words only.
    ("один два Статья 3 " + words(340), ["Статья 3 (продолжение)\nодин два Статья 3 " + words(330), "Статья 3 (продолжение)\n" + words(10)]),
    ("раз два три Статья 3 " + words(340), ["раз два три Статья 3 " + words(329), words(11)]),
]


def _run(spark, texts, size=2000):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string")
    rows = C.split_documents(df, keys=["id"], size=size).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["chunk_idx"])):
        got.setdefault(r["id"], []).append(r["chunk"])
    return [got.get(i, []) for i in range(len(texts))]


def test_splitter_hand_cases(spark):
    got = _run(spark, [t for t, _ in CASES])
    for (text, want), have in zip(CASES, got):
        assert have == want, text[:60]


def test_splitter_invariants_on_random_texts(spark):
    rnd = random.Random(7)
    vocab = ["Статья", "Стат", "12", "7", "123", "1234", "слово", "длинноеслово" * 3, "\n", "\nСтат", "ья 3",
             " ", "  ", " ", "a" * 60]
    texts = ["".join(rnd.choice(vocab) + rnd.choice([" ", "", "\n"]) for _ in range(rnd.randint(0, 400)))
             for _ in range(60)]
    for text, chunks in zip(texts, _run(spark, texts, size=120)):
        bare = [c.split(C.CONTINUATION, 1)[-1] for c in chunks]
        # Every word comes out once and in order; only a leading marker loses its stem.
        kept = text[len("\nСтат"):] if text.startswith("\nСтат") else text
        assert "".join("".join(bare).split()) == "".join(kept.split())
        for c, b in zip(chunks, bare):
            assert len(b) <= 120 or len(b.split()) == 1
            if c != b:
                stem, number = c[:c.index(C.CONTINUATION)].split()
                assert stem.startswith("Стат") and number.isdigit() and len(number) <= 3 and number in text


def test_splitter_is_linear_in_articles(spark):
    """Twice the articles of one document take about twice the time."""
    import time

    def seconds(n):
        df = spark.createDataFrame([(0, "".join(f"\nСтатья {i % 900} коротко" for i in range(n)))], "id bigint, text string")
        t0 = time.perf_counter()
        assert C.split_documents(df, keys=["id"]).count() == n
        return time.perf_counter() - t0

    seconds(1000)
    assert seconds(80_000) < 6 * seconds(20_000) + 2


def test_first_article_stem_option(spark):
    df = spark.createDataFrame([(0, "\nСтатья 1 текст\nСтатья 2 ещё")], "id bigint, text string")
    plain = [r["chunk"] for r in C.split_documents(df, keys=["id"]).orderBy("chunk_idx").collect()]
    fixed = [r["chunk"] for r in C.split_documents(df, keys=["id"], restore_first=True).orderBy("chunk_idx").collect()]
    assert plain[0].startswith("ья 1")
    assert fixed[0].startswith("Статья 1")


def test_splitter_is_narrow(spark):
    df = spark.createDataFrame([(0, "a b c")], "id bigint, text string")
    plan = C.split_documents(df, keys=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert F is not None


def test_array_form_equals_rows(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id bigint, text string")
    arr = {r["id"]: list(r["chunks"]) for r in C.split_documents_arrays(df, keys=["id"]).collect()}
    assert [arr[i] for i in range(len(CASES))] == [want for _, want in CASES]
    plan = C.split_documents_arrays(df, keys=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
