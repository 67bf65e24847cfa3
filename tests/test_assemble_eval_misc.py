"""Assembly (D*), evaluation (E*), charset (X*), similarity (M*), generation
(P*/F1-F3), sources/sinks (S*), streaming (T7) and the driver entry."""

import math
import os
import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillspark.operators import assemble as A
from quillspark.operators import charset as X
from quillspark.operators import convo as CV
from quillspark.operators import evaluate as E
from quillspark.operators import generate as G
from quillspark.operators import similarity as M
from quillspark.sources import readers as R
from quillspark.sources import sinks as S

SF = "/root/testdata/sf0.001"


def test_split_and_shuffle_independent_of_partitioning(spark):
    df = spark.range(0, 997).select(F.col("id").cast("string").alias("id"))
    a = A.split_exact(df.repartition(3), ["id"], 0.05, 42)
    b = A.split_exact(df.repartition(11), ["id"], 0.05, 42)
    ta = {r["id"] for r in a.filter("split = 'test'").collect()}
    tb = {r["id"] for r in b.filter("split = 'test'").collect()}
    assert ta == tb and len(ta) == math.ceil(0.05 * 997)
    r1 = [r["id"] for r in A.seeded_order(df, ["id"], 7).orderBy("rank").collect()]
    r2 = [r["id"] for r in A.seeded_order(df.repartition(5), ["id"], 7).orderBy("rank").collect()]
    assert r1 == r2 and sorted(r1) == sorted(str(i) for i in range(997))


def test_encode_truncate_pad_and_batches(spark):
    df = spark.createDataFrame([("a", "x y z x"), ("b", ""), ("c", "<s>x q</s>")], "id string, text string")
    vocab = A.build_vocab(df, "text", 2)
    enc = {r["id"]: r for r in A.encode(df, "text", ["id"], vocab, 3, mask_padding=True).collect()}
    # counts x=3, q=y=z=1: top-2 vocabulary is x (3), then q (4) by token order
    assert list(enc["a"]["input_ids"]) == [3, 0, 0] and enc["a"]["length"] == 3
    assert list(enc["b"]["input_ids"]) == [2, 2, 2] and list(enc["b"]["labels"]) == [-100, -100, -100]
    assert list(enc["c"]["input_ids"]) == [1, 3, 4]
    lens = spark.createDataFrame([(i, list(range(10, 10 + n))) for i, n in enumerate([3, 9, 0, 17, 2])], "rank bigint, ids array<int>")
    rows = {r["rank"]: r for r in A.batch_padding(lens, "rank", "ids", 2).collect()}
    assert {k: r["padded_len"] for k, r in rows.items()} == {0: 16, 1: 16, 2: 24, 3: 24, 4: 8}
    assert list(rows[0]["input_ids"]) == [10, 11, 12] + [2] * 13 and list(rows[0]["labels"]) == [10, 11, 12] + [-100] * 13
    assert all(len(r["input_ids"]) == len(r["labels"]) == r["padded_len"] for r in rows.values())


def test_encode_ids_by_lookup_and_by_join(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x y z x"), ("b", ""), ("c", None), ("d", "q " * 50)], "id string, text string")
    vocab = A.build_vocab(df, "text", 3)
    looked = {r["id"]: (r["length"], list(r["ids"] or [])) for r in A.encode_ids(df, "text", ["id"], vocab, 5).collect()}
    assert looked["a"][0] == 4 and looked["d"] == (50, looked["d"][1]) and len(looked["d"][1]) == 5
    monkeypatch.setattr(A, "MAX_VOCABULARY", 2)
    assert looked == {r["id"]: (r["length"], list(r["ids"] or [])) for r in A.encode_ids(df, "text", ["id"], vocab, 5).collect()}
    plan = A.encode(df, "text", ["id"], vocab, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    monkeypatch.undo()
    plan = A.encode(df, "text", ["id"], vocab, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_histogram_and_classes(spark):
    df = spark.createDataFrame([("x" * n,) for n in (1, 500, 1000, 1001, 2000)], "t string")
    h = {r["bin"]: r["n"] for r in A.length_histogram(df, "t", 4).collect()}
    assert h == {0: 2, 1: 1, 2: 1, 3: 1}
    c = {r["length_class"]: r["n"] for r in A.length_classes(df, "t").collect()}
    assert c == {"less_than_500": 1, "500_to_1000": 2, "more_than_1000": 2}


def test_metrics_against_numpy(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(6):
        n = 5
        logits = rnd.normal(size=(n, 4)).round(3).tolist()
        labels = rnd.integers(0, 4, size=n).tolist()
        labels[0] = -100
        labels[-1] = -100
        rows.append((i, logits, labels))
    df = spark.createDataFrame(rows, "row_id bigint, logits array<array<float>>, labels array<int>")
    pos = E.with_predictions(E.positions(df, keys=["row_id"]))
    got = {r["metric"]: r["value"] for r in E.metrics_row(pos).collect()}
    lg = np.array([r[1] for r in rows], dtype=np.float32)
    lb = np.array([r[2] for r in rows])
    pred = lg.argmax(-1)
    mask = lb != -100
    y, p = lb[mask], pred[mask]
    classes = sorted(set(y) | set(p))
    prec = [((p == c) & (y == c)).sum() / max((p == c).sum(), 1) if (p == c).sum() else 0 for c in classes]
    rec = [((p == c) & (y == c)).sum() / max((y == c).sum(), 1) if (y == c).sum() else 0 for c in classes]
    f1 = [2 * a * b / (a + b) if a + b else 0 for a, b in zip(prec, rec)]
    x = lg[mask].astype(np.float64)
    ce = (np.log(np.exp(x - x.max(1, keepdims=True)).sum(1)) + x.max(1) - x[np.arange(len(y)), y]).mean()
    assert got["eval_token_accuracy"] == pytest.approx((y == p).mean())
    assert got["eval_precision"] == pytest.approx(np.mean(prec))
    assert got["eval_recall"] == pytest.approx(np.mean(rec))
    assert got["eval_f1"] == pytest.approx(np.mean(f1))
    assert got["eval_ce_loss"] == pytest.approx(ce, rel=1e-6)


TOKENS = ["Ð¾Ð¿", "ÑĢÐ¾Ñģ", ":", "ĠÐļÐ°Ðº", "Ð¸Ð¼Ð¸", "ĠÑģÑĢÐµÐ´ÑģÑĤÐ²", "Ð°Ð¼Ð", "plain", "", "Ġ", "αβγ",
          "ÄŁ", "Ã¼ber", "ё", "ü"]


def test_decode_latin1_equals_the_codecs(spark):
    """Every codec, on each single byte and on byte strings with damaged sequences."""
    import random
    r = random.Random(3)
    raws = [bytes([b]) for b in range(256)] + [bytes(r.randint(0, 255) for _ in range(r.randint(0, 8))) for _ in range(300)]
    raws += ["ğüé€😀".encode()[:n] for n in range(13)] + [b"\xe0\xa0A", b"\xf0\x80\x80\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xc3\xc3\xa9"]
    df = spark.createDataFrame([(i, b.decode("latin1") + "Ļ") for i, b in enumerate(raws)], "i bigint, t string")
    encodings = sorted({e for _, group in X.ENCODING_GROUPS for e in group})
    rows = df.select("i", *[X.decode_latin1("t", e).alias(e) for e in encodings]).collect()
    for row in rows:
        for e in encodings:
            assert row[e] == raws[row["i"]].decode(e, errors="ignore"), (raws[row["i"]], e)


def test_decode_candidates_of_known_tokens(spark):
    df = spark.createDataFrame([(t,) for t in TOKENS], "token string")
    got = {}
    for r in X.decode_candidates(df).orderBy("cand_pos").collect():
        got.setdefault(r["token"], []).append((r["lang_group"], r["encoding"], r["decoded"]))
    assert got["Ð¾Ð¿"][0] == ("turkish", "iso-8859-9", "Ğ¾Ğ¿") and ("turkish", "utf-8", "оп") in got["Ð¾Ð¿"]
    assert got["Ã¼ber"][0] == ("turkish", "utf-8", "über")
    assert got["ü"][0] == ("turkish", "iso-8859-9", "ü") and ("greek", "iso-8859-7", "ό") in got["ü"]
    # "ü" as utf-8 is empty, as Latin-1 the text itself: neither is a candidate.
    assert all(enc not in ("utf-8", "latin1", "cp1252") for _, enc, _ in got["ü"])
    assert all(t not in got for t in (":", "plain", "", "Ġ"))
    for cands in got.values():
        decoded = [c[2] for c in cands]
        assert len(decoded) == len(set(decoded)) and "" not in decoded
    rep = X.report(spark.createDataFrame([("оп",), ("ğ",)], "decoded string")).collect()
    assert rep[0]["marker"] == "  R" and rep[0]["utf8_hex"] == "d0 be d0 bf"
    assert rep[1]["marker"] == "T  "


def _dp_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ch == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ref_score(a, b):
    import re
    def toks(s):
        return sorted(set(t for t in re.sub(r"[^\w]+|_", lambda m: " " if m.group(0) != "_" else "_",
                                            s.lower()).split(" ") if t))
    ta, tb = set(toks(a)), set(toks(b))
    if not ta or not tb:
        return 0
    t0 = " ".join(sorted(ta & tb))
    t1 = (t0 + " " + " ".join(sorted(ta - tb))).strip()
    t2 = (t0 + " " + " ".join(sorted(tb - ta))).strip()
    return max(M.py_ratio(t0, t1), M.py_ratio(t0, t2), M.py_ratio(t1, t2))


def test_lcs_and_token_set_ratio(spark):
    rnd = random.Random(5)
    for _ in range(200):
        a = "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abce ") for _ in range(rnd.randint(0, 30)))
        assert M.lcs_len(a, b) == _dp_lcs(a, b)
        p = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 10)))
        assert _dp_lcs(p + a, p + b) == len(p) + _dp_lcs(a, b)     # common-prefix lemma
    pairs = [("the cat sat", "sat the cat"), ("a b c", "a b"), ("colour", "color"), ("", "x"), ("!!", "..."),
             ("Привет мир", "мир привет"), ("café au lait", "cafe au lait"), ("one two three four", "one two five six")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r["score"] for r in M.with_token_set_ratio(df, "a", "b").orderBy("a", "b").collect()]
    exp = [ref_score(a, b) for a, b in sorted(pairs)]
    assert got == exp
    assert got[sorted(pairs).index(("the cat sat", "sat the cat"))] == 100


def test_near_duplicates_vs_brute_force(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rnd.sample(words, rnd.randint(3, 12))) for _ in range(30)]
    docs = base + [b + " " + rnd.choice(words) for b in base[:10]] + [" ".join(b.split()[:-1]) for b in base[10:15]]
    left = spark.createDataFrame(list(enumerate(docs)), "lid bigint, lt string")
    right = spark.createDataFrame(list(enumerate(docs)), "rid bigint, rt string")
    got = {(r["lid"], r["rid"]): r["score"] for r in M.near_duplicates(left, "lid", "lt", right, "rid", "rt").collect()}
    exp = {}
    for i, a in enumerate(docs):
        for j, b in enumerate(docs):
            ta, tb = set(a.split()), set(b.split())
            t0 = " ".join(sorted(ta & tb))
            t1 = (t0 + " " + " ".join(sorted(ta - tb))).strip()
            t2 = (t0 + " " + " ".join(sorted(tb - ta))).strip()
            if max(M.py_ratio(t0, t1), M.py_ratio(t0, t2)) >= 90:   # the containment route is exact
                exp[(i, j)] = ref_score(a, b)
    assert set(got) == set(exp)                  # exact for M2's overlap criterion
    for k, v in exp.items():
        assert got[k] == v, k


def test_generation_lineage_resume_and_errors(spark):
    chunks = spark.createDataFrame([("a.txt", i, f"text {i}") for i in range(5)] + [("b.md", 0, "boom")],
                                   "file_name string, chunk_idx bigint, chunk string")
    ch = G.chunks_table(chunks)
    docs = spark.createDataFrame([("a.txt", 10), ("b.md", 5), ("empty.txt", 0)], "file_name string, size bigint")

    def responder(texts, variant):
        return pd.DataFrame({"answer": [f"{variant['prompt']}:{t}" for t in texts], "input_tokens": [1] * len(texts),
                             "output_tokens": [2] * len(texts), "error": ["model failed" if "boom" in t else None for t in texts]})
    v1 = {"variant_id": "v1", "provider": "p", "model": "m", "prompt": "ask"}
    empty = spark.createDataFrame([], "chunk_id string, variant_id string, answer string, input_tokens bigint, "
                                      "output_tokens bigint")
    todo = G.first_pending(ch, empty, 3, "v1")
    assert todo.count() == 4
    new = G.generate_answers(todo, v1, responder, calls_per_period=1000)
    res = new.collect()
    assert sum(r["error"] is not None for r in res) == 1
    answers = G.record_answers(G.record_answers(empty, new), new)
    assert answers.count() == 3
    assert all(r["answer"].startswith("ask:text ") for r in answers.collect())
    broken = G.generate_answers(todo, v1, lambda texts, variant: 1 / 0).collect()
    assert len(broken) == 4 and all("division" in r["error"] and r["answer"] is None for r in broken)
    assert {r["file_name"] for r in G.documents_with_pending(ch, answers, "v1").collect()} == {"a.txt", "b.md"}
    assert {r["file_name"] for r in G.fully_processed(docs, ch, answers, "v1").collect()} == {"empty.txt"}
    nxt = G.first_pending(ch, answers, 3, "v1").filter("file_name = 'a.txt'").orderBy("chunk_idx")
    assert [r["chunk_idx"] for r in nxt.collect()] == [3, 4]
    nested = G.nested_view(docs, ch, spark.createDataFrame([("a.txt", 0, "v1", "p", "m", "x")],
                                                         "file_name string, variant_idx bigint, variant_id string, "
                                                         "provider string, model string, prompt string"), answers)
    a = nested.filter("file_name = 'a.txt'").first()
    assert [c["processed"] for c in a["original_text"]] == [True, True, True, False, False]
    assert len(a["variants"][0]["llm_answers"]) == 3
    assert nested.filter(G.all_processed_nested(F.col("original_text"))).first()["file_name"] == "empty.txt"


def test_export_names_and_collision(spark):
    ch = G.chunks_table(spark.createDataFrame([("a.txt", 0, "t"), ("a.md", 0, "u")],
                                              "file_name string, chunk_idx bigint, chunk string"))
    docs = spark.createDataFrame([("a.txt", 1), ("a.md", 1)], "file_name string, size bigint")
    var = spark.createDataFrame([("a.txt", 0, "v", "p", "m", "x"), ("a.md", 0, "v", "p", "m", "x")],
                                "file_name string, variant_idx bigint, variant_id string, provider string, "
                                "model string, prompt string")
    ans = ch.select("chunk_id", F.lit("v").alias("variant_id"), F.lit("ans").alias("answer"),
                    F.lit(1).cast("bigint").alias("input_tokens"), F.lit(1).cast("bigint").alias("output_tokens"))
    with pytest.raises(ValueError, match="collision"):
        S.variant_export_lines(docs, var, ans, ch, docs)
    ok = S.variant_export_lines(docs.filter("file_name = 'a.txt'"), var.filter("file_name = 'a.txt'"), ans, ch, docs)
    assert sorted((r["output_name"], r["line"]) for r in ok.collect()) == [("a.txt", ""), ("a.txt", "ans")]


def test_text_directory_publish_and_day_files(spark, tmp):
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    for name, text in (("one.txt", "Статья 1\nтекст"), ("two.md", "другое")):
        with open(os.path.join(src, name), "w", encoding="utf-8") as f:
            f.write(text)
    docs = R.read_text_documents(spark, src)
    assert {r["file_name"]: r["file_size"] for r in docs.collect()} == {"one.txt": 25, "two.md": 12}
    with pytest.raises(FileNotFoundError):
        R.read_text_documents(spark, src, require_glob="*.pdf")
    path = S.publish(docs, os.path.join(tmp, "pub"), "model/", datetime(2025, 2, 10, 20, 37))
    assert path.endswith("2025-02-10-20-37/model")
    with pytest.raises(Exception):
        S.publish(docs, os.path.join(tmp, "pub"), "model/", datetime(2025, 2, 10, 20, 37))
    assert R.read_published(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        R.read_published(spark, os.path.join(tmp, "nothing"))
    os.makedirs(os.path.join(tmp, "hollow", "below"))
    open(os.path.join(tmp, "hollow", "_SUCCESS"), "w").close()
    with pytest.raises(FileNotFoundError):
        R.read_published(spark, os.path.join(tmp, "hollow"))
    lines = spark.createDataFrame([("2024-03-02", 0, "Date: 2024-03-02"), ("2024-03-02", 1, ""),
                                   ("2024-03-02", 2, "User: a Msg: b")], "day string, line_no bigint, line string") \
                 .withColumn("day", F.to_date("day"))
    out = os.path.join(tmp, "days")
    S.write_day_files(lines, out)
    both = lines.withColumn("export", F.lit("x/a.json")).unionByName(lines.withColumn("export", F.lit("x/b.json")))
    S.write_day_files(both, os.path.join(tmp, "two"))
    again = spark.read.text(os.path.join(tmp, "two"), recursiveFileLookup=True)
    assert again.where("value like 'Date%'").count() == 2
    assert len([d for d in os.listdir(os.path.join(tmp, "two")) if d.startswith("export_")]) == 2
    d = os.path.join(out, "year=2024", "month=03", "file=02_03_2024")
    content = "".join(open(os.path.join(d, f), encoding="utf-8").read() for f in sorted(os.listdir(d))
                      if f.startswith("part-"))
    assert content == "Date: 2024-03-02\n\nUser: a Msg: b\n"


def test_streaming_ingest_available_now(spark, tmp):
    from quillspark.streaming import start_ingest
    src, store, ck = (os.path.join(tmp, x) for x in ("in", "store", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w", encoding="utf-8") as f:
        f.write("Статья 1\nпервый")
    start_ingest(spark, src, store, ck).awaitTermination()
    with open(os.path.join(src, "b.txt"), "w", encoding="utf-8") as f:
        f.write("Статья 2\nвторой\nСтатья 3\nтретий")
    start_ingest(spark, src, store, ck).awaitTermination()
    docs = spark.read.parquet(os.path.join(store, "documents"))
    chunks = spark.read.parquet(os.path.join(store, "chunks"))
    assert sorted(r["file_name"] for r in docs.collect()) == ["a.txt", "b.txt"]
    assert chunks.count() == 3


def test_convo_merge_and_standardize(spark):
    df = spark.createDataFrame([(1, "x", 0, None, True), (2, "", 5, "o", False)],
                               "k int, a string, n int, out string, flag boolean")
    col = CV.merged_prompt(df, "A={a}[[ n={n}]][[ a={a}!]][[ f={flag}]]")
    got = [r["p"] for r in df.select(col.alias("p")).orderBy("k").collect()]
    assert got == ["A=x a=x! f=True", "A= n=5"]
    with pytest.raises(KeyError):
        CV.merged_prompt(df, "{missing}")
    sg = CV.to_sharegpt(df, "{a}", "out", keep=["k"]).orderBy("k").collect()
    assert sg[0]["conversations"][1]["value"] == "None"


def test_entry_and_queries_smoke(spark):
    import importlib
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["conv_id", "text"]
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    for name in ("t6_split_law", "c3_runs_by_user", "d5_encode", "m1_turn_similarity"):
        assert qs[name](spark, SF).count() >= 0


def test_rate_limit_holds_over_many_partitions(spark, tmp):
    """16 partitions, 6 calls a second: no second holds more."""
    chunks = G.chunks_table(spark.createDataFrame([("a.txt", i, f"t{i}") for i in range(24)],
                                                  "file_name string, chunk_idx bigint, chunk string")).repartition(16)

    def responder(texts, variant):
        import time
        with open(os.path.join(tmp, f"call-{texts[0]}"), "w") as f:
            f.write(repr(time.time()))
        return pd.DataFrame({"answer": list(texts), "input_tokens": [1] * len(texts), "output_tokens": [1] * len(texts)})

    v = {"variant_id": "v", "provider": "p", "model": "m", "prompt": "x"}
    for lanes in (8, 2):
        out = G.generate_answers(chunks, v, responder, calls_per_period=6, period_s=1.0, lanes=lanes)
        assert out.where("error is null").collect() and len(os.listdir(tmp)) == 24
        at = sorted(float(open(os.path.join(tmp, f)).read()) for f in os.listdir(tmp))
        assert all(b - a > 0.97 for a, b in zip(at, at[6:])), [round(b - a, 2) for a, b in zip(at, at[6:])]
    assert G.limiter_lanes(49, 8) == (8, 6) and G.limiter_lanes(3, 8) == (3, 1)


def test_a_broken_run_resumes_without_repeating_a_call(spark, tmp):
    from quillspark.sources import store as ST
    src, store, log = (os.path.join(tmp, x) for x in ("src", "store", "log"))
    os.makedirs(src)
    os.makedirs(log)
    with open(os.path.join(src, "a.txt"), "w", encoding="utf-8") as f:
        f.write("".join(f"\nСтатья {i} текст" for i in range(40)))
    ST.ingest_directory(spark, src, store)

    def responder(ts, variant):
        import uuid
        for t in ts:
            with open(os.path.join(log, uuid.uuid4().hex), "w", encoding="utf-8") as f:
                f.write(t)
        if len(os.listdir(log)) > 25 and not os.path.exists(os.path.join(tmp, "mended")):
            os._exit(1)                               # the worker dies in the middle of the run
        return pd.DataFrame({"answer": list(ts), "input_tokens": [1] * len(ts), "output_tokens": [1] * len(ts)})

    with pytest.raises(Exception):
        ST.process_chunks(spark, store, "local", "m", "p", responder, calls_per_period=None, commit_every=5)
    done = [r["answer"] for r in spark.read.parquet(os.path.join(store, "answers")).collect()]
    assert 10 <= len(done) < 40
    for f in os.listdir(log):
        os.remove(os.path.join(log, f))
    open(os.path.join(tmp, "mended"), "w").close()
    ST.process_chunks(spark, store, "local", "m", "p", responder, calls_per_period=None, commit_every=5)
    sent = [open(os.path.join(log, f), encoding="utf-8").read() for f in os.listdir(log)]
    assert len(sent) == 40 - len(done) and not set(sent) & set(done)
    answers = spark.read.parquet(os.path.join(store, "answers"))
    assert answers.count() == 40 == answers.select("chunk_id").distinct().count()


def test_hot_day_is_spread_over_partitions(spark):
    from quillspark.functions.runs import BUCKET, with_time_bucket
    from quillspark.operators import chatlog as CL
    n = 20000
    df = spark.range(n).select(F.col("id").alias("pos"),
                               (F.lit(1_704_067_200) + F.col("id")).cast("timestamp").cast("timestamp_ntz").alias("date"),
                               (F.col("id") % 3).cast("string").alias("sender"), F.col("id").cast("string").alias("text"))
    df = df.withColumn("day", F.lit("2024-01-01").cast("date"))          # every message on one day
    sizes = [r["count"] for r in with_time_bucket(df, "date", 8).groupBy(BUCKET).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 0.3 * n                    # not one task
    runs = CL.sender_runs(df.drop("day"), num_partitions=8)
    assert runs.count() == n                                          # senders alternate: every message is a run
    assert runs.agg(F.max("run_idx")).first()[0] == n - 1


def test_hot_document_first_pending(spark):
    rows = [("big.txt", i, f"t{i}") for i in range(3000)] + [("small.txt", i, "s") for i in range(3)]
    ch = G.chunks_table(spark.createDataFrame(rows, "file_name string, chunk_idx bigint, chunk string"))
    empty = spark.createDataFrame([], "chunk_id string, variant_id string, answer string, input_tokens bigint, "
                                      "output_tokens bigint")
    got = G.first_pending(ch, empty, 2500, "v")
    per = {r["file_name"]: r["count"] for r in got.groupBy("file_name").count().collect()}
    assert per == {"big.txt": 2500, "small.txt": 3}
    assert got.filter("file_name = 'big.txt'").agg(F.max("chunk_idx")).first()[0] == 2499


def test_store_ingest_and_process_chunks(spark, tmp):
    from quillspark.sources import store as ST
    src, store = os.path.join(tmp, "src"), os.path.join(tmp, "store")
    os.makedirs(src)
    texts = {"a.txt": "Статья 1\n" + "слово " * 700, "b.txt": "Статья 2\nкоротко\nСтатья 3\nещё", "c.txt": "boom"}
    for n, t in texts.items():
        with open(os.path.join(src, n), "w", encoding="utf-8") as f:
            f.write(t)
    ST.ingest_directory(spark, src, store)
    ST.ingest_directory(spark, src, store)            # second run: nothing new
    docs = spark.read.parquet(os.path.join(store, "documents"))
    assert docs.count() == 3

    def responder(ts, variant):
        return pd.DataFrame({"answer": ["A " + t for t in ts], "input_tokens": [1] * len(ts),
                             "output_tokens": [1] * len(ts), "error": ["failed" if t == "boom" else None for t in ts]})
    run1 = ST.process_chunks(spark, store, "local", "m", "p", responder, chunk_process_limit=1, calls_per_period=None)
    assert run1.count() == 3 and run1.filter("error IS NOT NULL").count() == 1
    run2 = ST.process_chunks(spark, store, "local", "m", "p", responder, chunk_process_limit=0, calls_per_period=None)
    answers = spark.read.parquet(os.path.join(store, "answers"))
    n_chunks = spark.read.parquet(os.path.join(store, "chunks")).count()
    assert answers.count() == n_chunks - 1                   # only the failing chunk is still pending
    assert answers.select("chunk_id").distinct().count() == answers.count()
    variants = spark.read.parquet(os.path.join(store, "variants"))
    assert variants.count() == 3                              # one variant per document, not duplicated
    assert run2.count() == n_chunks - 2


def test_empty_inputs(spark):
    from quillspark.functions.indexing import with_global_index
    from quillspark.operators import chatlog as CL
    empty = spark.createDataFrame([], "pos bigint, date timestamp_ntz, sender string, text string")
    assert with_global_index(empty, ["date", "pos"]).count() == 0
    assert CL.sender_runs(empty).count() == 0
    ids = spark.createDataFrame([], "id string")
    assert A.split_exact(ids, ["id"]).count() == 0
    assert A.seeded_order(ids, ["id"], 1).count() == 0


def test_standardize_roles_and_errors(spark):
    from pyspark.sql import types as T
    conv_t = T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("conversations", conv_t)])
    ok = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")]), (2, [("system", "s"), ("human", "x")])], schema)
    std = CV.standardize_sharegpt(ok, order=["k"]).orderBy("k").collect()
    assert [(m["role"], m["content"]) for m in std[0]["conversations"]] == [("user", "q"), ("assistant", "a")]
    bad_sample = spark.createDataFrame([(1, [("robot", "q"), ("gpt", "a")])], schema)
    with pytest.raises(Exception, match="role not in aliases"):
        CV.standardize_sharegpt(bad_sample, order=["k"]).collect()
    # Ten rows would take "value" for the role key; all rows don't.
    skewed = spark.createDataFrame([(i, [("human" if i % 2 else "gpt", "same")]) for i in range(10)] + [(50 + i, [("human", f"v{i}")]) for i in range(9)], schema)
    assert CV.infer_role_key(skewed) == ("from", "value")
    assert CV.infer_role_key(skewed, order=["k"], first_rows=10) == ("value", "from")
    rows = [(i, [("human", f"q{i}"), ("gpt", f"a{i}")]) for i in range(12)] + [(99, [("robot", "q"), ("gpt", "a")])]
    later = CV.standardize_sharegpt(spark.createDataFrame(rows, schema), order=["k"])
    with pytest.raises(Exception, match="role not in aliases"):
        later.collect()


def test_variant_export_write_order(spark, tmp):
    ch = G.chunks_table(spark.createDataFrame([("law.txt", i, f"c{i}") for i in range(30)],
                                              "file_name string, chunk_idx bigint, chunk string"))
    docs = spark.createDataFrame([("law.txt", 1)], "file_name string, size bigint")
    var = spark.createDataFrame([("law.txt", 0, "v", "p", "m", "x")],
                                "file_name string, variant_idx bigint, variant_id string, provider string, "
                                "model string, prompt string")
    ans = ch.select("chunk_id", F.lit("v").alias("variant_id"), F.concat(F.lit("answer "), "chunk_idx").alias("answer"),
                    F.lit(1).cast("bigint").alias("input_tokens"), F.lit(1).cast("bigint").alias("output_tokens"))
    lines = S.variant_export_lines(docs, var, ans, ch, docs)
    out = os.path.join(tmp, "export")
    S.write_variant_exports(lines, out)
    d = os.path.join(out, "output_name=law.txt")
    content = "".join(open(os.path.join(d, f), encoding="utf-8").read() for f in sorted(os.listdir(d))
                      if f.startswith("part-"))
    assert content == "".join(f"answer {i}\n\n" for i in range(30))
