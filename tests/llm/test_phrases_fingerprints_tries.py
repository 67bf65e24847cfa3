"""Phrase collocations, I-Match fingerprints and the prefix trie against plain restatements."""

import hashlib

import numpy as np
import pytest

from quillspark.llm import collocations, imatch, prefix_trie
from tests.llm import brute_new

DOC = "doc_id long, text string, lang string, `a.b` string, n long"
TURN = "conv_id long, turn long, role string, text string, `a.b` string, n long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in rows], DOC)


# --------------------------------------------------------------- collocations

def _phrases(df, **kw):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, **kw).collect()}


def test_collocations_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["new", "york", "City", "of", "the", "é", "a.b", "x;", "\tq", "the\nend", "", "  "]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60))), ["en", "de", None, "und"][i % 4]) for i in range(80)]
    rows += [(1, "hot pair " * 400, "en")] * 3 + [(None, None, "en"), (None, "", None), (5, "hot pair " + "z " * 3000, "en")]
    want = brute_new.collocations([(t, lang) for _, t, lang in rows])
    assert _phrases(_docs(spark, rows)) == want and len(want) > 50
    want = brute_new.collocations([(t, lang) for _, t, lang in rows], least=3, top=7, share=80)
    assert _phrases(_docs(spark, rows), least=3, top=7, share=80) == want


def test_collocations_when_no_word_is_hot_or_filtered(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.6, 80) % 50), "en") for i in range(60)]
    want = brute_new.collocations([(t, lang) for _, t, lang in rows])
    monkeypatch.setattr(collocations, "HOT", 1)                   # pairs are routed by two words
    monkeypatch.setattr(collocations, "BITS", (64, 64))           # a full bitmap lets all words pass
    monkeypatch.setattr(collocations, "FOLD", 100)
    assert _phrases(_docs(spark, rows)) == want


def test_collocations_of_nothing(spark):
    assert _phrases(_docs(spark, [])) == {}
    assert _phrases(_docs(spark, [(1, None, None), (2, "a b", "en")])) == {}


def test_collocation_scores_are_exact(spark):
    a, left, right = 123_456_789_012, 987_654_321_098, 123_456_789_013
    df = spark.createDataFrame([(a, left, right)], "n long, f1 long, f2 long").select(collocations._score("n", "f1", "f2").alias("s"))
    assert df.first()["s"] == 10**6 * a * a // (left * right)


def test_multikey_quicksort_counts_and_abandons():
    rng = np.random.default_rng(7)
    keys = [rng.integers(1, 8, 3000).astype(np.uint64), rng.integers(1, 30, 3000).astype(np.uint64), rng.integers(0, 9, 3000).astype(np.uint64)]
    n = rng.integers(1, 4, 3000)
    want = {}
    for d in (1, 2, 3):
        for row, w in zip(zip(*(k.tolist() for k in keys[:d])), n.tolist()):
            if row[-1]:
                want[row] = want.get(row, 0) + w
    got = {}
    for d, rows, sizes in collocations.multikey_quicksort(keys, n, 12):
        for i, s in zip(rows.tolist(), sizes.tolist()):
            key = tuple(int(k[i]) for k in keys[:d])
            assert key not in got
            got[key] = s
    assert got == {k: v for k, v in want.items() if v >= 12}
    assert list(collocations.multikey_quicksort([k[:0] for k in keys], n[:0], 1)) == []


# --------------------------------------------------------------- fingerprints

def _edited(rows):
    """(doc_id, n_chars, sha) by the order of ids; null ids first, equal ids by nothing but one text here."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (k, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        out.append((k, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]).encode()).hexdigest()))
    return out


def test_edited_texts_and_likeness(spark):
    rng = np.random.default_rng(8)
    words = [f"wörd{i}" for i in range(20_000)]
    rows = [(i * 3, " ".join(rng.choice(words, rng.integers(80, 400))), "en") for i in range(300)]
    rows += [(None, None, None), (5000, "", "en"), (5001, "é" * 7, "en"), (5002, "é" * 7, "de"), (5003, "same text here", "en"), (5004, "same text here", "en"), (9000, "word " * 60_000, "en")]
    got = imatch.edited_report(_docs(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(_edited(rows), key=key)
    by = {r.doc_id: r for r in got}
    assert by[5001].fingerprint == by[5002].fingerprint != by[5003].fingerprint and by[5003].near_next == 1.0
    assert by[None].fingerprint == by[5000].fingerprint
    long = [r for r in got if r.n_chars > 500 and r.doc_id != 9000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.97
    assert 0.2 < np.mean([r.near_edited for r in long]) < 0.5
    assert all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next)) and all(len(r.fingerprint) == imatch.WIDTH for r in got)


def test_fingerprints_and_likeness_functions(spark):
    import pyarrow as pa
    texts = ["alpha beta gamma delta", "delta, gamma; BETA alpha alpha", "alpha beta gamma other", "", None, "??"]
    got = [r.fingerprint for r in sorted(imatch.fingerprints(_docs(spark, [(i, t, "en") for i, t in enumerate(texts)]), band=(0.0, 1.0)).collect(), key=lambda r: r.doc_id)]
    assert got[0] == got[1] != got[2] and got[3] == got[4] == got[5]
    near = imatch.likeness(pa.array([got[0]] * 4), pa.array([got[1], got[2], got[3], got[0]]))
    assert near[0] == near[3] == 1 and 0 < near[1] < 1 and near[2] == 0


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(["all"] + (["half"] if i % 2 else []) + [f"own{i}", f"own{i}"]), "en") for i in range(40)]
    import pyarrow as pa
    _, h = imatch._distinct(pa.array(["half"], pa.large_string()))
    assert imatch.lexicon(_docs(spark, rows), (0.1, 0.6)).tolist() == h.tolist()


def test_every_fingerprint_by_hand(spark):
    """The vectorised subset hashes against a loop over terms."""
    import pyarrow as pa
    texts = pa.array(["one two three four five", "six", "one six seven"], pa.large_string())
    whole, short = imatch._hashes(texts, np.zeros(0, np.uint64))
    for i, t in enumerate(texts.to_pylist()):
        _, h = imatch._distinct(pa.array([t], pa.large_string()))
        want = np.zeros(short.shape[1], np.uint64)
        for level, parts in enumerate(imatch.PARTS):
            rounds = -(-imatch.SUBSETS // parts)
            take = imatch.SUBSETS // rounds
            for k in range(rounds):
                for r in imatch.ts.mix(h ^ np.uint64((1 + level * 1000 + k) * 0x9E3779B97F4A7C15 % 2**64)).tolist():
                    if r % parts < take:
                        want[level * imatch.SUBSETS + k * take + r % parts] += np.uint64(((r >> 20) | 1) & 0xFFFFFFFF)
        assert ((short[i] > 0) == (want > 0)).all()


@pytest.mark.parametrize("rows", [[], [(1, "only one", "en")], [(None, None, None)]])
def test_reports_of_tiny_tables(spark, rows):
    got = imatch.edited_report(_docs(spark, rows)).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == _edited(rows)


def test_repeated_rows_and_ids(spark):
    rows = [(7, "same words in this text", "en")] * 500 + [(8, "after them", "en")]
    got = imatch.edited_report(_docs(spark, rows)).collect()
    assert len(got) == 501 and sum(r.near_next == 1.0 for r in got) == 499


# ----------------------------------------------------------------------- trie

def _turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURN)


def _nodes(df):
    rows = df.collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def _conversations(seed=9, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 10 == 5:
            continue                                              # an absent opener
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, None if t == 0 and c % 7 == 0 else t, rng.choice(["user", "assistant", None]), rng.choice(["é", "hi", None, f"own {c} {t}"])))
    rows += [(c, t, "user", f"turn {t}") for c in (1000, 1001, 1005, 1006, 70_000, 140_001) for t in range(9)]
    rows += [(3, 2, "user", "hi")] * 3 + [(None, 1, "user", "lost")]
    rows += [(2001, t, "user", f"t{t}") for t in range(1500)] + [(2002, t, "user", f"t{t}") for t in range(1400)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = [r for r in _conversations() if r[0] is None or r[0] < 2000]
    # Equal turn numbers of different rows have no order of their own: keep one of each.
    seen, plain = set(), []
    for r in rows:
        if r in plain or (r[0], r[1]) not in seen:
            plain.append(r)
        seen.add((r[0], r[1]))
    assert _nodes(prefix_trie.opening_report(_turns(spark, plain))) == brute_new.trie(plain)


def test_trie_of_long_conversations_and_a_full_sketch(spark, monkeypatch):
    rows = [(c, t, "user", "a" if t < 30 else f"{c}") for c in (1, 2) for t in range(40)] + [(6, t, "user", "a") for t in range(25)]
    want = brute_new.trie(rows)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)             # blocks of eight turns
    assert _nodes(prefix_trie.opening_report(_turns(spark, rows))) == want
    monkeypatch.setattr(prefix_trie, "CELLS", (64, 64))           # estimates of one are rare
    assert _nodes(prefix_trie.opening_report(_turns(spark, rows))) == want
    monkeypatch.setattr(prefix_trie, "ID_BITS", 0)
    assert _nodes(prefix_trie.opening_report(_turns(spark, rows))) == want


def test_plain_trie_and_its_ends(spark):
    rows = [(1, 1, "u", "a"), (1, 2, "u", "b"), (2, 1, "u", "a"), (3, 5, "u", "a"), (3, 9, "u", "b"), (3, 10, "u", "c")]
    nodes, ends = prefix_trie.prefix_trie(_turns(spark, rows))
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.n_ends) for r in nodes.collect()}
    assert got == {(1, 0): (None, 3, 1, 1, 3, 0), (1, 1): (1, 3, 1, 1, 3, 1), (1, 2): (1, 2, 1, 1, 1, 1), (3, 3): (1, 1, 0, 1, 0, 1)}
    assert {(r.conv_id, r.node, r.depth) for r in ends.collect()} == {(1, 1, 2), (2, 1, 1), (3, 3, 3)}


def test_trie_of_nothing(spark):
    assert _nodes(prefix_trie.opening_report(_turns(spark, []))) == {}
    assert _nodes(prefix_trie.opening_report(_turns(spark, [(None, 1, "user", "x")]))) == {}


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 40) if c % 5]   # openers are absent: first turns are cut off
    want = brute_new.trie(rows)
    assert _nodes(prefix_trie.opening_report(_turns(spark, rows))) == want and want[1, 0][2] <= 1
