"""Token counts and packing against the tokenizer itself."""
import os
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from conftest import ODD, prose  # noqa: E402

from quillspark.llm import packing, token_counts
from quillspark.llm.common import fresh_folder, publishing
from quillspark.llm.encode import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = ODD + [(i, prose(i, 30 * (i % 90))) for i in range(20, 140)] + [(500, "an <|endoftext|> mark"), (501, "x" * 30000)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("plain", [False, True])
def test_encoder_equals_the_tokenizer(plain):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = plain
    r = random.Random(1)
    parts = [" ", "  ", "\n", "a", "Bc", "é", "ß", "'s", "'", "9", "!", ".", ",", "\t", "\r", "\x1c", "\x85", " ", " ", "　", "😀", "<|endoftext|>", "中"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(4000)] + ["", "x" * 5000]
    flat, first = Encoder(PATH, plain).ids(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert flat[first[i]:first[i + 1]].tolist() == own.encode(t, add_special_tokens=False).ids


def counts(rows):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return sorted((str(i), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)


@pytest.mark.parametrize("block,group", [(8 << 20, 1024), (64, 3)])
def test_token_counts(make_docs, spark, monkeypatch, block, group):
    monkeypatch.setattr(token_counts, "SCAN_GROUP", group)
    rows = ROWS[:60] if block == 64 else ROWS
    rows = [x for x in rows if x[0] != 7] if block == 64 else rows
    manifest = token_counts.write_token_files(make_docs(rows), PATH, 50256, fresh_folder(spark, "t"))
    got = manifest.join(token_counts.scan_token_files(manifest, 50256, block_bytes=block), ["file", "ordinal"]).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == counts(rows)
    assert all(r.complete for r in got)


def test_rows_of_documents_are_never_broadcast(make_docs, spark):
    """Neither side of the join of documents and counts, however small its files are, may go through the driver."""
    out = token_counts.token_counts(make_docs(ROWS[:40]), PATH, 50256)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "[file#" in plan and re.findall(r"(\w+Join) \[file#\d+, ordinal#\d+L?\]", plan) == ["SortMergeJoin"]
    assert sorted((str(r.doc_id), r.n_tokens) for r in out.collect()) == counts(ROWS[:40])


def test_scan_of_damaged_and_empty_files(spark):
    folder = fresh_folder(spark, "t")
    files = {"a": [7, 8, 0, 0, 9], "b": [], "c": [0], "d": [1, 2, 3], "e": [5] * 20 + [0] + [6] * 20}
    for name, ids in files.items():
        with publishing(f"{folder}/{name}") as out:
            out.write(np.array(ids, "<u2").tobytes())
    df = spark.createDataFrame([(f"{folder}/{n}",) for n in list(files) * 2], "file string")
    got = {(r.file[-1], r.ordinal): (r.start, r.n_tokens, r.complete) for r in token_counts.scan_token_files(df, 0, block_bytes=4).collect()}
    assert got == {("a", 0): (0, 2, True), ("a", 1): (3, 0, True), ("a", 2): (4, 1, False), ("c", 0): (0, 0, True),
                   ("d", 0): (0, 3, False), ("e", 0): (0, 20, True), ("e", 1): (21, 20, False)}


def test_pack(make_docs, tokenizer):
    got = packing.pack(make_docs(ROWS), PATH, length=256, end_id=0, group_documents=50, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        assert 0 < r.length <= 256 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    pad = sum(0 if (n & (n - 1)) == 0 else 256 - n for n in (sum(r.length for r in p) for p in by_seq.values()))
    assert pad < 0.1 * sum(r.length for r in got)
    # Every id once: of each document, and of repeated rows as often as they occur.
    want = {}
    for i, t in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 256):
            k = (i, at, tuple(ids[at:at + 256]), len(ids))
            want[k] = want.get(k, 0) + 1
    have = {}
    for r in got:
        k = (r.doc_id, r.start, tuple(r.ids), r.doc_tokens)
        have[k] = have.get(k, 0) + 1
    assert have == want


def test_pack_deals_equal_pieces_to_many_groups(make_docs):
    rows = [(None, None)] * 3000 + [(i, prose(i, 30)) for i in range(200)]
    got = packing.pack(make_docs(rows), PATH, length=256, group_documents=100).collect()
    assert len(got) == len(rows) and len({(r.sequence_id, r.offset) for r in got}) == len(rows)
    groups = {}
    for r in got:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert max(groups.values()) < 600 and len(groups) > 15


def test_first_fit_decreasing():
    r = random.Random(2)
    sizes = sorted((r.randint(1, 100) for _ in range(500)), reverse=True)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room = []
    for s, b, o in zip(sizes, bins, offsets):
        want = next((i for i, x in enumerate(room) if x + s <= 100), len(room))
        if want == len(room):
            room.append(0)
        assert (b, o) == (want, room[want])
        room[want] += s


def test_empty_tables(make_docs):
    assert packing.pack(make_docs([]), PATH).count() == 0
    assert token_counts.token_counts(make_docs([]), PATH, 50256).count() == 0


def test_blocks_are_read_by_many_tasks(spark, monkeypatch):
    folder = fresh_folder(spark, "wide")
    with publishing(f"{folder}/a") as out:
        out.write(np.arange(1, 3001, dtype="<u2").tobytes())
    made = {}
    keep = token_counts.stored
    monkeypatch.setattr(token_counts, "stored", lambda df, name: made.setdefault(name, keep(df, name)))
    df = spark.createDataFrame([(f"{folder}/a",)], "file string")
    assert token_counts.scan_token_files(df, 0, block_bytes=30).count() == 1
    assert made["blocks"].count() == 200 and len(made["token-blocks"].inputFiles()) > 50


def test_a_repeated_attempt_names_its_own_file(make_docs, spark):
    folder = fresh_folder(spark, "twice")
    rows = [(i, f"text {i}") for i in range(20)]
    first = token_counts.write_token_files(make_docs(rows, 1), PATH, 50256, folder)
    again = token_counts.write_token_files(make_docs(rows[::-1], 1), PATH, 50256, folder)      # the same task in another row order
    for manifest in (first, again):
        got = manifest.join(token_counts.scan_token_files(manifest, 50256), ["file", "ordinal"]).collect()
        assert len(got) == 20 and len({r.file for r in got}) == 1
    assert first.first()["file"] != again.first()["file"]
