"""Templates (V5-V12, F9), QA parsing (F5, Q1-Q4), chat logs."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators import chatlog as CL
from quillspark.operators import qa as QA
from quillspark.operators import templates as TP

SAMPLE = [("system", " You are a friendly chatbot."), ("user", "What is 2+2?"), ("assistant", "It's 4."),
          ("user", "  But 2+2 is equal to 5. "), ("assistant", "No I'm sure its 4."), ("user", "  No it's 100% 5! ")]
MSG_T = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))


def render(spark, msgs, name, **kw):
    df = spark.createDataFrame([(msgs,)], T.StructType([T.StructField("m", MSG_T)]))
    return df.select(TP.render("m", name, messages_type=MSG_T, **kw).alias("t")).first()["t"]


def test_chatml_and_zephyr(spark):
    out = render(spark, SAMPLE, "chatml", add_generation_prompt=True)
    exp = "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in SAMPLE) + "<|im_start|>assistant\n"
    assert out == exp
    z = render(spark, SAMPLE, "zephyr", eos_token="</s>")
    assert z == "".join(f"<|{r}|>\n{c}</s>\n" for r, c in SAMPLE)


def test_llama3_trims_and_llama31_does_not(spark):
    out = render(spark, SAMPLE, "llama-3", bos_token="<|begin_of_text|>")
    exp = "<|begin_of_text|>" + "".join(
        f"<|start_header_id|>{r}<|end_header_id|>\n\n{c.strip()}<|eot_id|>" for r, c in SAMPLE)
    assert out == exp
    out31 = render(spark, SAMPLE, "llama-3.1", bos_token="<B>")
    assert out31.startswith("<B><|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: December 2023\n"
                            "Today Date: 26 July 2024\n\n You are a friendly chatbot.<|eot_id|>")
    assert "  But 2+2 is equal to 5. <|eot_id|>" in out31


def test_mistral_llama_gemma_first_message_rules(spark):
    m = render(spark, SAMPLE, "mistral", bos_token="<s>", eos_token="</s>")
    assert m.startswith("<s>[INST]  You are a friendly chatbot. What is 2+2? [/INST]It's 4.</s>")
    ll = render(spark, SAMPLE, "llama", bos_token="<s>", eos_token="</s>")
    assert ll.startswith("<s>[INST] <<SYS>>\n You are a friendly chatbot.\n<</SYS>>\n\nWhat is 2+2? [/INST] It's 4. </s>")
    assert "<s>[INST] But 2+2 is equal to 5. [/INST]" in ll
    g = render(spark, SAMPLE, "gemma", bos_token="<bos>")
    assert g.startswith("<bos><start_of_turn>user\nYou are a friendly chatbot. What is 2+2?<end_of_turn>\n"
                        "<start_of_turn>model\nIt's 4.<end_of_turn>\n")


def test_default_and_override_system(spark):
    no_sys = SAMPLE[1:3]
    v = render(spark, no_sys, "vicuna_old", bos_token="", eos_token="</s>")
    assert v.startswith(TP.SYS_VICUNA_OLD + "\n### Human: What is 2+2?\n")
    assert "human's" in v
    o = render(spark, no_sys, "alpaca", bos_token="", eos_token="", system_message="Be brief.")
    assert o.startswith("Be brief.\n\n### Instruction:")
    # chatml has no default: an override is ignored
    c = render(spark, no_sys, "chatml", system_message="ignored")
    assert "ignored" not in c


def test_error_paths(spark):
    with pytest.raises(Exception, match="other than user and assistant"):
        render(spark, [("user", "a"), ("tool", "b")], "unsloth")
    with pytest.raises(Exception, match="messages\\[1\\]"):
        render(spark, [("system", "s")], "mistral")
    with pytest.raises(Exception, match="messages\\[0\\]"):
        render(spark, [], "vicuna")
    assert render(spark, [], "chatml") == ""


def test_qwen_tool_results_joined(spark):
    msgs = [("user", "q"), ("tool", "r1"), ("tool", "r2"), ("assistant", "a")]
    out = render(spark, msgs, "qwen-2.5")
    assert out == ("<|im_start|>system\n" + TP.SYS_QWEN25 + "<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
                   "<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response>"
                   "<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n")


def test_llama31_tool_call_and_result(spark):
    tc_t = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType()),
                                     T.StructField("tool_calls", T.ArrayType(T.StructType([
                                         T.StructField("name", T.StringType()),
                                         T.StructField("arguments", T.StringType())])))]))
    msgs = [("user", "weather?", None), ("assistant", None, [("get", '{"city": "Oslo"}')]),
            ("tool", 'sunny "warm"', None)]
    df = spark.createDataFrame([(msgs,)], T.StructType([T.StructField("m", tc_t)]))
    out = df.select(TP.render("m", "llama-3.1", bos_token="", messages_type=tc_t).alias("t")).first()["t"]
    assert '{"name": "get", "parameters": {"city": "Oslo"}}<|eot_id|>' in out
    assert '<|start_header_id|>ipython<|end_header_id|>\n\n"sunny \\"warm\\""<|eot_id|>' in out


def test_parts_trainer_plain_bos(spark):
    df = spark.createDataFrame([(SAMPLE,)], T.StructType([T.StructField("m", MSG_T)]))
    r = df.select(TP.render_parts("m").alias("a"), TP.render_trainer_v2("m").alias("b"),
                  TP.render_plain("m").alias("c")).first()
    assert r["a"].startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n You are a friendly")
    assert r["b"].startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>You are a helpful AI "
                             "assistant<|eot_id|><|start_header_id|>user<|end_header_id|>What is 2+2?")
    assert r["c"].splitlines()[0] == "System:  You are a friendly chatbot."
    t = spark.createDataFrame([("<s><s>x",), ("y",)], "t string").select(TP.remove_bos("t", "<s>").alias("t"))
    assert [x["t"] for x in t.collect()] == ["<s>x", "y"]


QA_TEXT = ("Вопрос: Что такое \"закон\"?\nОтвет: Это \"норма\".\n\n\n"
           "вопрос: нижний регистр?\nответ: да\n\n"
           "Вопрос: два ответа\nОтвет: первый\nОтвет: второй\n\n"
           "Вопрос: только вопрос\n\n"
           "Вопрос: первая пара\nОтвет: один\nВопрос: вторая\nОтвет: два")


def test_qa_parsing_rules(spark):
    df = spark.createDataFrame([(1, QA_TEXT)], "f int, text string")
    b = QA.blocks(df, keys=["f"])
    pairs = [(r["question"], r["answer"]) for r in QA.qa_pairs(b).orderBy("block_idx").collect()]
    assert pairs == [("Вопрос: Что такое закон?", "Ответ: Это норма."),
                     ("Вопрос: два ответа", "Ответ: первый"),
                     ("Вопрос: первая пара", "Ответ: один\nВопрос: вторая")]
    ci = QA.qa_pairs(b, ignore_case=True).orderBy("block_idx").collect()
    assert len(ci) == 4 and ci[1]["question"] == "вопрос: нижний регистр?"
    msgs = QA.qa_messages(b).orderBy("block_idx").first()["messages"]
    assert msgs[0]["content"] == 'Что такое "закон"?' and msgs[1]["content"] == 'Это "норма".'
    q4 = spark.createDataFrame([("question: a\n\nanswer: b",)], "t string").select(
        QA.collapse_blank_line("t").alias("t")).first()["t"]
    assert q4 == "question: a\nanswer: b"


def test_read_qa_files(spark, tmp):
    with open(os.path.join(tmp, "a.qa"), "w", encoding="utf-8") as f:
        f.write("Вопрос: x\r\nОтвет: y\r\n")
    with open(os.path.join(tmp, "b.txt"), "w", encoding="utf-8") as f:
        f.write("Вопрос: skip\nОтвет: me")
    files = QA.read_qa_files(spark, tmp)
    assert files.count() == 1
    assert QA.qa_pairs(QA.blocks(files, keys=["file"])).first()["answer"] == "Ответ: y"


EXPORT = {"messages": [
    {"type": "message", "date": "2024-03-01T23:59:00", "from": "Ann", "text": "  hi ",
     "text_entities": [{"type": "plain", "text": "hi"}]},
    {"type": "message", "date": "2024-03-01T23:59:30", "from": "Ann", "text": ["a", {"type": "link"}, " b "],
     "text_entities": [{"type": "plain"}, {"type": "link"}]},
    {"type": "message", "date": "2024-03-02T00:00:10", "from": "Ann", "text": "after midnight",
     "text_entities": [{"type": "plain"}]},
    {"type": "service", "date": "2024-03-02T00:01:00", "from": "Bob", "text": "joined",
     "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "2024-03-02T00:02:00", "from": None, "text": 42,
     "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "2024-03-02T00:02:00", "from": "", "text": "tie",
     "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "2024", "from": "Bob", "text": "bare year", "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "bad", "from": "Bob", "text": "x", "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "2024-03-02", "from": "Bob", "text": "only link", "text_entities": [{"type": "link"}]},
    {"type": "message", "date": "2024-03-02T00:03:00", "text": "", "text_entities": [{"type": "plain"}]},
    {"type": "message", "date": "2024-03-02T00:04:00", "from": "Bob", "text": True,
     "text_entities": [{"type": "plain"}]},
]}


def test_chat_export_pipeline(spark, tmp):
    with open(os.path.join(tmp, "export.json"), "w", encoding="utf-8") as f:
        json.dump(EXPORT, f, ensure_ascii=False)
    with open(os.path.join(tmp, "other.json"), "w", encoding="utf-8") as f:
        json.dump({"no_messages": []}, f)
    with pytest.raises(Exception, match="no messages list"):
        CL.read_chat_export(spark, tmp).count()
    with open(os.path.join(tmp, "damaged.json"), "w", encoding="utf-8") as f:
        f.write('{"messages": [')
    errors = {os.path.basename(r["file"]): r["error"] for r in CL.export_errors(spark, tmp).collect()}
    assert errors == {"other.json": "no messages list", "damaged.json": "invalid JSON"}
    msgs = CL.read_chat_export(spark, tmp, skip_bad=True)
    assert msgs.count() == len(EXPORT["messages"])
    kept = CL.filter_messages(msgs)
    texts = [r["text"] for r in kept.orderBy("pos").collect()]
    assert texts == ["hi", "a b", "after midnight", "42", "tie", "True"]
    runs = CL.sender_runs(kept, partition_key=["file"], num_partitions=3)
    lines = CL.day_file_lines(runs, ["file"]).orderBy("day", "line_no").collect()
    got = [(str(r["day"]), r["line"]) for r in lines]
    assert got == [("2024-03-01", "Date: 2024-03-01"), ("2024-03-01", ""), ("2024-03-01", "User: Ann Msg: hi a b"),
                   ("2024-03-02", "Date: 2024-03-02"), ("2024-03-02", ""),
                   ("2024-03-02", "User: Ann Msg: after midnight"),
                   ("2024-03-02", "User: Unknown User Msg: 42 tie"), ("2024-03-02", "User: Bob Msg: True")]


def test_runs_stitch_across_partitions(spark):
    import random
    rnd = random.Random(3)
    rows, t = [], 0
    for i in range(3000):
        t += rnd.choice([0, 1, 30, 4000])
        rows.append((i, t, rnd.choice("ABBBBC")))
    df = spark.createDataFrame(rows, "pos bigint, sec bigint, sender string").select(
        "pos", F.timestamp_seconds("sec").cast("timestamp_ntz").alias("date"), "sender",
        F.col("pos").cast("string").alias("text"))
    runs = CL.sender_runs(df, num_partitions=37).orderBy("day", "run_idx").collect()
    # plain Python restatement
    import itertools
    from datetime import datetime, timezone
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    exp = []
    for day, grp in itertools.groupby(ordered, key=lambda r: datetime.fromtimestamp(r[1], timezone.utc).date()):
        for who, g in itertools.groupby(grp, key=lambda r: r[2]):
            exp.append((str(day), who, " ".join(str(r[0]) for r in g)))
    assert [(str(r["day"]), r["sender"], r["text"]) for r in runs] == exp


TOOLS = [{"type": "function", "function": {"name": "get", "parameters": {"city": "string"}}}]
TC_T = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType()),
                                 T.StructField("tool_calls", T.ArrayType(T.StructType([
                                     T.StructField("name", T.StringType()),
                                     T.StructField("arguments", T.StringType())])))]))


def _render_tc(spark, msgs, name, **kw):
    df = spark.createDataFrame([(msgs,)], T.StructType([T.StructField("m", TC_T)]))
    return df.select(TP.render("m", name, messages_type=TC_T, **kw).alias("t")).first()["t"]


def test_qwen_tools_block_and_calls(spark):
    msgs = [("user", "weather?", None), ("assistant", "", [("get", '{"city": "Oslo"}'), ("get", '{"city": "Rome"}')]),
            ("tool", "sunny", None)]
    out = _render_tc(spark, msgs, "qwen-2.5", tools=TOOLS)
    assert out.startswith("<|im_start|>system\n" + TP.SYS_QWEN25 + "\n\n# Tools\n\nYou may call one or more functions")
    assert '\n{"type": "function", "function": {"name": "get", "parameters": {"city": "string"}}}\n</tools>' in out
    assert ('<|im_start|>assistant\n<tool_call>\n{"name": "get", "arguments": {"city": "Oslo"}}\n</tool_call>'
            '\n<tool_call>\n{"name": "get", "arguments": {"city": "Rome"}}\n</tool_call><|im_end|>\n') in out
    assert out.endswith("<|im_start|>user\n<tool_response>\nsunny\n</tool_response><|im_end|>\n")


def test_llama31_tools_in_first_user_message(spark):
    msgs = [("system", "sys", None), ("user", "weather?", None), ("assistant", "ok", None)]
    out = _render_tc(spark, msgs, "llama-3.1", bos_token="", tools=TOOLS)
    assert "Environment: ipython\nCutting Knowledge Date" in out
    assert ("<|start_header_id|>user<|end_header_id|>\n\nGiven the following functions, please respond with a JSON "
            "for a function call with its proper arguments") in out
    import json as _json
    assert _json.dumps(TOOLS[0], indent=4) + "\n\nweather?<|eot_id|>" in out
    with pytest.raises(Exception, match="one tool call only"):
        _render_tc(spark, [("user", "a", None), ("assistant", None, [("x", "{}"), ("y", "{}")])], "llama-3.1")
    with pytest.raises(Exception, match="there is none"):
        _render_tc(spark, [("system", "s", None)], "llama-3.1", tools=TOOLS)


def test_all_template_names_render(spark):
    for name in TP.TEMPLATE_NAMES:
        assert render(spark, SAMPLE, name)


def test_iso_dates_and_offsets(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00",), ("2024-03-01 10:00",), ("2024-03-01",), ("2024",),
                                ("2024-03-01T10:00:00+02:00",), ("bad",), (None,)], "d string")
    naive = [r["x"] for r in df.select(CL.parse_iso_date(F.col("d")).alias("x")).collect()]
    assert [x is not None for x in naive] == [True, True, True, False, False, False, False]
    utc = [r["x"] for r in df.select(CL.parse_iso_date(F.col("d"), normalize_utc=True).alias("x")).collect()]
    assert str(utc[4]) == "2024-03-01 08:00:00"


def test_iso_dates_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10T02:30:00",), ("2024-03-01T10:00:00+02:00",)], "d string")
        r = df.select(CL.parse_iso_date(F.col("d"), normalize_utc=True).alias("x")).collect()
        assert str(r[0]["x"]) == "2024-03-10 02:30:00"       # inside a DST gap of the session zone
        assert str(r[1]["x"]) == "2024-03-01 08:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_large_export_loses_no_message(spark, tmp):
    """A file beyond the 128 MiB that one VARIANT value may hold."""
    path = os.path.join(tmp, "large.json")
    filler = "x" * 100_000
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"messages": [')
        for i in range(1400):
            f.write((", " if i else "") + json.dumps({"type": "message", "date": "2024-03-01T10:00:00", "from": "A", "text": f"{i} {filler}"}))
        f.write("]}")
    assert os.path.getsize(path) > 128 << 20
    assert CL.read_chat_export(spark, path).select("pos").distinct().count() == 1400


def test_one_qa_file_of_any_name(spark, tmp):
    path = os.path.join(tmp, "blocks.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Вопрос: a\nОтвет: b")
    assert QA.read_qa_files(spark, path).count() == 1
    assert QA.read_qa_files(spark, tmp).count() == 0
    with open(os.path.join(tmp, "x.qa"), "w", encoding="utf-8") as f:
        f.write("Вопрос: a\nОтвет: b")
    assert QA.read_qa_files(spark, tmp).count() == 1


def test_a_message_without_content_is_an_error(spark):
    t = "m array<struct<role:string,content:string>>"
    bad = spark.createDataFrame([([("user", "q"), ("assistant", None)],)], t)
    for col in [TP.render("m", n) for n in ("chatml", "unsloth", "qwen-2.5")] + [TP.render_trainer_v2("m"), TP.render_plain("m"), TP.render_parts("m")]:
        with pytest.raises(Exception, match="no content"):
            bad.select(col).collect()
    with pytest.raises(Exception, match="no content"):
        spark.createDataFrame([([("system", None), ("user", "q")],)], t).select(TP.render("m", "qwen-2.5")).collect()
    none = spark.createDataFrame([(None,)], t).select(TP.render("m", "chatml").alias("t")).first()
    assert none["t"] is None


def test_parts_template_begin_token_and_generation_prompt(spark):
    t = "m array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("user", "q"), ("assistant", "a")],)], t)

    def text(**kw):
        return df.select(TP.render_parts("m", "<B>S:{SYSTEM};", "U:{INPUT};", "A:{OUTPUT};", "sys", **kw).alias("t")).first()["t"]

    assert text() == "<B>S:sys;U:q;A:a;"
    assert text(bos_token="<B>") == "<B>S:sys;U:q;A:a;"                       # once, though the part holds it
    assert text(bos_token="<X>") == "<X><B>S:sys;U:q;A:a;"
    assert text(add_generation_prompt=True) == "<B>S:sys;U:q;A:a;A:"
    assert df.select(TP.render_parts("m", "", "U:{INPUT};", "A:{OUTPUT};", bos_token="<B>", add_generation_prompt=True).alias("t")).first()["t"] == "<B>U:q;A:a;A:"


def test_builtin_tool_calls(spark):
    rows = [([("assistant", None, [("web", '{"query": "a b", "n": "2"}')]), ("assistant", None, [("get", '{"city": "X"}')]), ("user", "q", None)],)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("m", TC_T)]))
    col = TP.render("m", "llama-3.1", bos_token="", builtin_tools=["web", "code_interpreter"], system_message="", messages_type=TC_T)
    text = df.select(col.alias("t")).first()["t"]
    assert "Environment: ipython\nTools: web\n\nCutting Knowledge Date" in text
    assert '<|python_tag|>web.call(query="a b", n="2")<|eom_id|>' in text
    assert '{"name": "get", "parameters": {"city": "X"}}<|eom_id|>' in text
