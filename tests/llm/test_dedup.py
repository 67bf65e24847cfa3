"""Line dedup, substring dedup and the Jaccard join against brute force."""
import os
import random
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import brute
from conftest import ODD, prose  # noqa: E402

from quillspark.llm import jaccard_join, line_dedup, substring_dedup


def key(row):
    return tuple((x is None, x) if not isinstance(x, bool) else x for x in row)


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def line_rows():
    r = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(12)]
    rows = [(i, "\n".join(r.choice(pool + ["", " "]) for _ in range(r.randint(0, 14)))) for i in range(60)]
    hot = "\n".join(f"boiler plate {i}" for i in range(5))
    return rows + [(100 + i, f"own {i}\n{hot}\nend {i}") for i in range(90)] + ODD


def test_line_dedup(make_docs):
    rows = line_rows()
    docs = make_docs(rows)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    same([(r.doc_id, r.text) for r in out.collect()], brute.line_dedup(rows))


def test_line_dedup_keeps_the_first_run_and_rejects_a_clash(make_docs):
    rows = [(2, "a\nb\nc\nd"), (1, "x\na\nb\nc")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(make_docs(rows)).collect()}
    assert got == {1: "x\na\nb\nc", 2: "d"}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(make_docs(rows), before="fp")


def test_line_dedup_of_short_passages(make_docs):
    half, short, long = prose(71, 26), prose(72, 50), prose(73, 51)
    rows = [(1, f"a\n{long}\nb"), (2, f"{long}"), (3, f"c\n \n{long} "), (4, f"d\n{half}\n{half}x\ne"), (5, f"{half}\n\n{half}x\nf"),
            (6, f"g\n{short}"), (7, f"h\n{short}"), (8, f"{long}\ni"), (None, f"{half}\n{half}x")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(make_docs(rows), min_words=50).collect()}
    assert got == dict(rows) | {2: "", 5: "\nf", 8: "i", None: ""}
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(make_docs(rows)).collect()} == dict(rows)


def word_rows():
    r = random.Random(5)
    base = [f"t{i}" for i in range(40)]
    rows = [(i, " ".join(base[a:a + r.randint(5, 35)] * r.choice([1, 1, 2])) + " " + prose(i, r.randint(0, 20))) for i in range(80) for a in [r.randint(0, 20)]]
    passage = prose(999, 55)
    rows += [(200 + i, f"{prose(3000 + i, 15)} {passage}\n{prose(5000 + i, 15)}") for i in range(100)]
    return rows + [(400, "go " * 300), (401, "go\t" * 200)] + ODD


@pytest.mark.parametrize("hot", [2, 64, 10**6])
def test_substring_dedup(make_docs, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows = word_rows()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(make_docs(rows)).collect()]
    same(got, brute.substring_dedup(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=14), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton_first_owners(texts, window):
    auto, seen = substring_dedup.FirstOwners(), {}
    for owner, words in enumerate(texts):
        want = [seen.get(tuple(words[p:p + window])) for p in range(len(words) - window + 1)]
        assert auto.stream(words, window) == want
        auto.add(words, owner)
        for p in range(len(words) - window + 1):
            seen.setdefault(tuple(words[p:p + window]), owner)


def near_rows():
    r = random.Random(9)

    def edited(words, k):
        words = list(words)
        for p in r.sample(range(len(words)), k):
            words[p] = f"e{r.randint(0, 10**9)}"
        return " ".join(words)

    rows = []
    for g in range(6):
        base = prose(g, 80).split()
        rows += [(1000 * g + i, edited(base, r.randint(0, 3))) for i in range(12)]
    passage = prose(777, 30)
    rows += [(9000 + i, f"{prose(100 + i, 40)} {passage}") for i in range(40)]
    rows += [(9500, "one two"), (9501, "one two"), (9502, "one two three"), (9503, "na " * 50), (9504, "na " * 70)]
    return rows + ODD


@pytest.mark.parametrize("small,block", [(64, 1024), (2, 3)])
def test_similar_classes(make_docs, monkeypatch, small, block):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_rows()
    got = [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard_join.similar_classes(make_docs(rows)).collect()]
    same(got, brute.classes(rows))


def template_pairs(groups, members, share, n=300):
    """Sets of one template a group (``share`` of each set), in pairs at a
    similarity of just over 0.8 that are linked to nothing else by design;
    words that run on are put so that a set is as many 5-word runs."""
    rows, pairs = [], []
    for g in range(groups):
        own = n - int(share * n)
        template = [f"g{g}t{i}" for i in range(n - own)]
        for p in range(members // 2):
            i = len(rows)
            common = [f"g{g}p{p}c{j}" for j in range(int(own - n * 0.106))]
            for side in "ab":
                rest = [f"g{g}p{p}{side}{j}" for j in range(own - len(common))]
                rows.append((len(rows), " ".join(template + common + rest)))
            pairs.append((i, i + 1))
    return rows, pairs


def missed(make_docs, rows, pairs):
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.similar_classes(make_docs(rows, 8)).collect()}
    return sum(got[a] != (a, 1) or got[b] != (a, 1) for a, b in pairs)


def test_similar_classes_recall_in_large_buckets(make_docs):
    rows, pairs = template_pairs(4, 1000, 0.7)
    a, b = (set(zip(*(rows[i][1].split()[k:] for k in range(5)))) for i in pairs[0])
    assert 0.8 <= len(a & b) / len(a | b) < 0.82
    assert missed(make_docs, rows, pairs) == 0


def test_large_buckets_of_near_copies_stay_whole(make_docs, monkeypatch):
    r = random.Random(4)
    base = prose(31, 300).split()

    def edited():
        words = list(base)
        words[r.randrange(300)] = f"e{r.randint(0, 10**9)}"
        return " ".join(words)

    rows = [(i, edited()) for i in range(300)] + [(1000 + i, prose(500 + i, 60)) for i in range(40)]
    seen, keep = {}, jaccard_join.stored

    def counted(df, name):
        out = keep(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    got = [(x.doc_id, x.class_id, x.n_links, x.n_copies) for x in jaccard_join.similar_classes(make_docs(rows)).collect()]
    same(got, brute.classes(rows))
    # Every large bucket is the group's: all become parts, no member goes on.
    assert seen["large-0"] > 3000 and seen["whole-0"] > 10 and seen["paths-1"] == 0 and seen["edges"] < 3 * 300


def test_rows_without_an_id_fetch_their_own_texts_only(make_docs, monkeypatch):
    fetched, wanted = [], jaccard_join._wanted

    def counted(src, want):
        out = wanted(src, want)
        fetched.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_wanted", counted)
    rows = [(i, t) for i in (None, 5) for g in range(10) for t in (prose(g + 20 * (i or 0)), prose(g + 20 * (i or 0)) + " more")]
    got = [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard_join.similar_classes(make_docs(rows)).collect()]
    same(got, brute.classes(rows))
    assert fetched == [len(rows)]


def test_one_per_class(make_docs):
    rows = near_rows()
    docs = make_docs(rows)
    out = jaccard_join.one_per_class(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    want, seen = [], set()
    for (i, t), (_, c, links, copies) in zip(rows, brute.classes(rows)):
        if (links + copies == 1 or i == c) and (i, t) not in seen:
            seen.add((i, t))
            want.append((i, t))
    # Of several texts of one id in a class one stays; the brute force keeps all that carry the id.
    assert {g[0] for g in got} == {w[0] for w in want} and set(got) <= set(want) and len(got) == len(set(got))


def test_empty_tables(make_docs):
    empty = make_docs([])
    assert line_dedup.dedup_lines(empty).count() == 0
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert jaccard_join.similar_classes(empty).count() == 0
    assert jaccard_join.one_per_class(empty).count() == 0


def test_line_dedup_keeps_a_dotted_column(spark):
    from quillspark.llm import line_dedup
    same = "one line here\ntwo lines here\nthree lines here"
    docs = spark.createDataFrame([(1, same, "x"), (2, same, "y")], "doc_id long, text string, `a.b` string")
    got = {r["doc_id"]: (r["text"], r["a.b"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1] == (same, "x") and got[2][1] == "y" and got[2][0] != same
