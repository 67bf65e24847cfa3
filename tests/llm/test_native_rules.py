"""Quality rules and decontamination against brute force."""
import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute
from conftest import ODD, prose  # noqa: E402

from quillspark.llm import decontaminate, quality_rules


def key(row):
    return tuple((x is None, x) for x in row)


def quality_rows():
    r = random.Random(4)
    words = ["the", "of", "and", "a", "cat", "Dog!", "x|y", "#tag", "naïve", "日本"]
    rows = [(1000 + i, "".join(r.choice(words) + r.choice([" ", " ", " ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(r.randint(0, 90)))) for i in range(150)]
    rows += [(200, "go " * 400), (201, "SHOUT ING WORDS " + " ".join(f"WORD{i}X" for i in range(80))), (202, " | ".join(prose(i, 1) for i in range(90))),
             (203, "a b c " + prose(3, 60) + " a b c"), (204, "x y x y x"), (205, "\n".join(["same line here"] * 40 + [prose(5, 60)]))]
    return rows + ODD


def test_quality_report(make_docs):
    rows = quality_rows()
    got = quality_rules.quality_report(make_docs(rows)).collect()
    assert sorted((key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got)) == sorted(
        key((i, *brute.quality(t))) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    by = {r.doc_id: r.kept for r in got}
    assert by[1] and by[7] and not any(by[i] for i in (200, 201, 205))


def test_cascade_order_does_not_change_what_is_kept(make_docs):
    docs = make_docs(quality_rows())
    rules = quality_rules.default_rules()
    a = quality_rules.apply_rules(docs, rules, "why")
    b = quality_rules.apply_rules(docs, rules[::-1], "why")
    assert a.columns == docs.columns + ["why"]
    kept = [sorted(((r.doc_id is None, r.doc_id), r.text or "") for r in x.where("why is null").collect()) for x in (a, b)]
    assert kept[0] == kept[1] and kept[0]
    with pytest.raises(ValueError):
        quality_rules.apply_rules(docs, verdict="fp")


def test_rules_are_ordered_by_rejections_per_cost(spark):
    df = spark.range(100).select(F.col("id").alias("x"))
    rule = lambda name, fails, cost: quality_rules.Rule(name, fails, F.lit(float(cost)))
    rules = [rule("rare", F.col("x") < 5, 1), rule("dear", F.col("x") < 90, 100), rule("cheap", F.col("x") < 50, 1), rule("same", F.col("x") < 49, 1)]
    # After "cheap" has gone, "same" rejects nothing more.
    assert [r.name for r in quality_rules.order_rules(df, rules, fraction=1.0)] == ["cheap", "dear", "rare", "same"]
    assert [r.name for r in quality_rules.order_rules(df.limit(0), rules)] == [r.name for r in rules]


def bench_rows():
    items = [(1, prose(50, 30)), (2, prose(51, 30)), (2, prose(51, 30)), (3, "Short item, only four"), (4, None), (5, " -- "), (6, prose(50, 12)), (None, prose(52, 14))]
    w = prose(50, 30).split()
    rows = [(1, "lead " + " ".join(w[3:17]).upper() + " tail"), (2, ", ".join(w)), (3, " ".join(w[:9])), (4, prose(51, 30) + " x " + prose(50, 30)),
            (5, "a SHORT-item; only\nfour words, short item only four"), (6, prose(52, 14)), (10, prose(60, 200))]
    rows += [(100 + i, f"{prose(70 + i, 20)} {prose(51, 30)}") for i in range(40)]
    return rows + [(i if i is None else 1000 + i, t) for i, t in ODD], items


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, dkey string")


@pytest.mark.parametrize("bound", [300_000, 7])
def test_contamination(make_docs, spark, monkeypatch, bound):
    rows, items = bench_rows()
    docs = make_docs(rows)
    found = decontaminate.hit_words(docs, bench(spark, [x for x in items if x[0] is not None]), max_broadcast=bound)
    report = decontaminate.contamination_report(docs, bench(spark, [x for x in items if x[0] is not None]))
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in report.collect()]
    want = brute.contamination(rows, [x for x in items if x[0] is not None])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sorted(len(r.hit) for r in found.collect()) == sorted(w[2] for w in {(i, t): w for (i, t), w in zip(rows, want)}.values() if w[2])


def test_an_item_without_an_id_hits_but_is_not_counted(make_docs, spark):
    docs = make_docs([(1, prose(52, 14)), (2, prose(53, 14))])
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in decontaminate.contamination_report(docs, bench(spark, [(None, prose(52, 14))])).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (14, 0, nothing, True), 2: (0, 0, nothing, False)}


def test_removal(make_docs, spark):
    rows, items = bench_rows()
    docs = make_docs(rows)
    want = brute.contamination(rows, items)
    kept = decontaminate.decontaminate(docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert sorted(key((r.doc_id, r.text)) for r in kept.collect()) == sorted(key(x) for x, w in zip(rows, want) if not w[5])
    cleaned = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench(spark, items), remove="spans").collect()}
    assert cleaned[1] == "lead tail" and cleaned[10] == prose(60, 200) and cleaned[5] == "a words, " and cleaned[2] == ""
    again = decontaminate.contamination_report(decontaminate.decontaminate(docs, bench(spark, items), remove="spans"), bench(spark, items))
    assert again.where("contaminated").count() == 0


def test_empty_tables(make_docs, spark):
    none, rows = make_docs([]), make_docs(ODD)
    assert quality_rules.quality_report(none).count() == 0
    assert quality_rules.apply_rules(none).count() == 0
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination_report(none, nothing).count() == 0
    assert decontaminate.contamination_report(rows, nothing).where("contaminated").count() == 0
    assert decontaminate.decontaminate(rows, nothing).count() == len(ODD)
