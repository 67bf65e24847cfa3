"""Readers that split one large file, against the whole-file readers."""

import json
import os

import pytest

from quillspark.operators import chatlog as CL
from quillspark.operators import chunking as C
from quillspark.sources import large_export as LE
from quillspark.sources import large_text as LT


@pytest.fixture()
def small_ranges(spark):
    """Files are cut into ranges of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _messages(n):
    odd = ['quote " brace } { bracket ] [ comma , "messages": [', "back\\slash \\\" }", "line\nbreak\ttab", "é ☃ 𝄞 }" * 30, "", "}}}}", '"', "\\"]
    out = []
    for i in range(n):
        text = [odd[i % len(odd)], [odd[(i + 1) % len(odd)], {"type": "link", "text": "}"}], None, 7][i % 4]
        out.append({"type": "message", "date": f"2024-05-01T12:{i % 60:02d}:00", "from": f"u{i % 5}" if i % 7 else None, "text": text,
                    "text_entities": [{"type": "plain", "text": "x"}], "more": {"messages": [{"type": "inner"}], "deep": [[1, {"a": "]"}]]}})
    return out


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def _rows(df):
    return sorted(map(str, df.drop("file").collect()))


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_large_export_equals_the_whole_file_reader(spark, tmp, small_ranges, layout):
    msgs = _messages(60)
    chat = {"name": "messages", "list": [1, {"messages": [{"type": "no"}]}], "messages": msgs, "after": {"messages": [{"type": "no"}], "x": "]}"}}
    _write(tmp, "a.json", json.dumps(chat, **layout))
    _write(tmp, "b.json", json.dumps({"messages": []}) + "\n")
    _write(tmp, "c.json", json.dumps({"messages": [1, "two", None, {"type": "message"}, [3]]}, **layout))
    raw = spark.read.option("lineSep", "}").text(tmp)
    assert raw.rdd.getNumPartitions() > 10
    got, want = LE.read_large_chat_export(spark, tmp), CL.read_chat_export(spark, tmp)
    assert _rows(got) == _rows(want) and got.columns == want.columns and got.count() == 65


def test_large_export_for_any_range_size(spark, tmp, small_ranges):
    _write(tmp, "a.json", json.dumps({"id": 1, "messages": _messages(12)}))
    want = _rows(CL.read_chat_export(spark, tmp))
    for size in (64, 257, 100_000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        assert _rows(LE.read_large_chat_export(spark, tmp)) == want, size


def test_large_export_errors(spark, tmp, small_ranges):
    good = json.dumps({"messages": _messages(20)})
    for name, bad, what in (("cut.json", good[:len(good) // 2], "invalid JSON"), ("none.json", '{"other": [{"messages": 1}]}', "no messages list"),
                            ("quote.json", good[:-30] + '"}]}', "invalid JSON")):
        folder = os.path.join(tmp, name)
        _write(folder, "good.json", good)
        _write(folder, name, bad)
        with pytest.raises(ValueError, match=f"{name}: {what}"):
            LE.read_large_chat_export(spark, folder)
        assert LE.read_large_chat_export(spark, folder, skip_bad=True).count() == 20


def test_large_export_items_that_are_not_json(spark, tmp, small_ranges):
    _write(tmp, "a.json", '{"messages": [{"type": "message"}, oops, {"type": "x"}]}')
    with pytest.raises(Exception, match="item 1 isn't JSON"):
        LE.read_large_chat_export(spark, tmp).collect()
    assert LE.read_large_chat_export(spark, tmp, skip_bad=True).count() == 2


def test_scan_follows_strings_across_parts():
    text = '{"a": "x}y\\"}", "messages": [{"k": "}"}, 2]}'
    whole = LE.Scan()
    marks = list(whole.marks(text))
    for cut in [i + 1 for i, c in enumerate(text) if c == "}"]:
        s = LE.Scan()
        parts = [*s.marks(text[:cut])] + [(p + cut, c, d) for p, c, d in s.marks(text[cut:])]
        assert parts == marks and (s.depth, s.string, s.opened) == (0, False, whole.opened)


def _law(n):
    words = "право обязан суд x\u00a0y закон, статья \t срок"
    out = ["Преамбула " + words * 3]
    for i in range(n):
        head = [f"ья {i}", f"ья {i}.", "ус", f"ья {i} {'дл' * 40}", "ья", " \n "][i % 6]
        out.append(head + "\n" + (words + " ") * (i * 7 % 60))
    return "\nСтат".join(out)


TEXTS = {"plain": _law(80), "starts": "\nСтатья 5\n" + _law(30), "ends": _law(9) + "\nСтат", "twice": "\nСтат\nСтат" + _law(3) + "\nСтат\nСтат",
         "only": "\nСтат", "only_twice": "\nСтат\nСтат", "empty": "", "blank": " \n\t ", "none": "слово " * 700, "one_word": "ж" * 5000,
         "near": "а\n\nСтатья 1\nСта\nСтатья 2 " + "\n\n" * 900, "far": "Статья 7 " + "\nСтатус" * 200 + "\nСтат " + "слово " * 900}


@pytest.mark.parametrize("restore", [False, True])
@pytest.mark.parametrize("size", [16, 700, 10**6])
def test_large_documents_equal_the_row_form(spark, tmp, small_ranges, size, restore):
    for name, text in TEXTS.items():
        _write(tmp, name + ".txt", text)
    whole = spark.createDataFrame([(n + ".txt", t) for n, t in TEXTS.items()], "file string, text string")
    want = C.split_documents(whole, keys=["file"], size=300, restore_first=restore)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    got = LT.split_large_documents(spark, tmp, size=300, restore_first=restore)
    rows = {(r["file"].rsplit("/", 1)[1], r["chunk_idx"]): r["chunk"] for r in got.collect()}
    assert rows == {(r["file"], r["chunk_idx"]): r["chunk"] for r in want.collect()}
    assert len(rows) == got.count() > 400


def test_large_documents_refuse_what_they_cannot_split(spark, tmp):
    for marker in ("", "aa", "\n\n", "aba"):
        with pytest.raises(ValueError, match="overlaps"):
            LT.split_large_documents(spark, tmp, marker=marker)
    _write(tmp, "a.txt", "\ufeffone The two The")
    with pytest.raises(Exception, match="byte order mark"):
        LT.split_large_documents(spark, tmp, marker="The", stem="The").collect()
    got = LT.split_large_documents(spark, tmp, marker=" The", stem="The").orderBy("chunk_idx").collect()
    assert [r["chunk"] for r in got] == ["one", "The two", "The"]
