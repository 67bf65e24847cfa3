"""S2 for one large export: a JSON object read in byte ranges by many tasks.

Spark's text source splits a file at any byte range when lines end at ``}``,
so a file is read as pieces between closing braces, whatever its layout. What
a range means depends on what stands before it: whether it begins inside a
string, how deep, and inside which top-level list. Each range says how it
changes these, for both cases of the string; the ranges' summaries (a few
numbers each) are put together in file order, and a second pass cuts the items
of the ``messages`` list out of every range. An item that crosses ranges is
joined from its fragments. A task holds a batch of pieces and one item at a
time, never a file.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.indexing import stored_table
from ..operators.chatlog import parse_messages
from ..session import ship_package

LIST = "messages"
NESTED = 1000                  # levels of a file, as many as JSON readers take by default
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)("|\Z)|[\[\]{},:]', re.S)
_TO_QUOTE = re.compile(r'(?:[^"\\]|\\.)*("|\Z)', re.S)


class Scan:
    """Structure of a text that arrives in parts. ``string``: inside a string;
    ``depth``: open brackets; ``listed``: the open bracket at depth 2 is the
    wanted list (None: not known here)."""

    def __init__(self, string: bool = False, depth: int = 0, listed: bool | None = None):
        self.string, self.depth, self.listed = string, depth, listed
        self.word, self.key = "", None
        self.opened: dict[int, bool] = {}        # by depth: whether the last bracket opened there is the wanted list

    def marks(self, text: str):
        """Positions of ``, [ ] { }`` outside strings, the depth before each
        and after; follows keys and opened brackets."""
        at = 0
        if self.string:
            m = _TO_QUOTE.match(text)
            at, self.string = m.end(), m[1] == ""
            self.word += text[:m.start(1)]
        for m in _TOKEN.finditer(text, at):
            c = text[m.start()]
            if c == '"':
                self.word, self.string = m[1], m[2] == ""
                continue
            if c == ":":
                self.key = self.word
                continue
            before = self.depth
            if c in "[{":
                if -NESTED < before <= 1:        # only depth 1 of the file is asked for, at most so far up
                    self.opened[before] = c == "[" and self.key == LIST
                self.depth += 1
            elif c in "]}":
                self.depth -= 1
            yield m.start(), c, before
            self.key = None


def _ranges(batches):
    """Pieces of a batch as one text for each byte range: (file, start, text)."""
    for batch in batches:
        now, parts = None, []
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value"))):
            if (file, start) != now:
                if parts:
                    yield *now, "".join(parts)
                now, parts = (file, start), []
            parts.append(value + "}")
        if parts:
            yield *now, "".join(parts)


def _summarise(batches):
    """One row for each range and case of its beginning."""
    now, scans, blank = None, [], False

    def out():
        rows = []
        for first, s in enumerate(scans):
            rows.append((*now, bool(first), s.string, s.depth, [d for d in s.opened], list(s.opened.values()), blank))
        names = ["file", "start", "string_in", "string_out", "depth", "levels", "listed", "blank"]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for file, start, text in _ranges(batches):
        if (file, start) != now:
            if now is not None:
                yield out()
            now, scans = (file, start), [Scan(False), Scan(True)]
        for s in scans:
            for _ in s.marks(text):
                pass
        blank = not text[:-1].rpartition("}")[2].strip()
    if now is not None:
        yield out()


def _cut(begins):
    """``file, start, i, whole, item``: the items of each range's wanted list,
    ``i`` counting those that end in it. The first and the last item of a
    range may be fragments (``whole`` false); a last row without an item has
    the range's count."""
    def run(batches):
        now, scan, parts, i, rows = None, None, [], 0, []

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()])],
                                             names=["file", "start", "i", "whole", "item"])
            rows.clear()
            return got

        def close(whole: bool):
            rows.append((*now, i, whole, "".join(parts)))
            parts.clear()

        def leave():
            if inside:
                close(False)
            rows.append((*now, i, None, None))

        for file, start, text in _ranges(batches):
            if (file, start) != now:
                if now is not None:
                    leave()
                now, i, head = (file, start), 0, True
                string, depth, listed = begins.value[now]
                scan, inside = Scan(string, depth, listed), bool(listed) and depth >= 2
            begin = 0
            for at, c, before in scan.marks(text):
                if inside and (before == 2 and c == "," or scan.depth == 1):
                    parts.append(text[begin:at])
                    close(not head)
                    begin, i, head, inside = at + 1, i + 1, False, scan.depth != 1
                elif before == 1 and scan.depth == 2:
                    inside, begin, head = scan.opened[1], at + 1, False
            if inside:
                parts.append(text[begin:])
            if len(rows) > 1000:
                yield out()
        if now is not None:
            leave()
        yield out()
    return run


def _begins(summaries: list) -> tuple[dict, dict]:
    """How each range begins (in a string, depth, in the wanted list), from
    the summaries in file order; and the files that aren't whole objects."""
    by_file = defaultdict(dict)
    for r in summaries:
        by_file[r["file"]].setdefault(r["start"], {})[r["string_in"]] = r
    begins, errors = {}, {}
    for file, ranges in by_file.items():
        string, depth, listed, found, blank = False, 0, None, False, False
        for start in sorted(ranges):
            begins[file, start] = (string, depth, listed)
            r = ranges[start][string]
            opened = dict(zip((x + depth for x in r["levels"]), r["listed"]))
            listed = opened.get(1, listed)
            found = found or bool(opened.get(1))
            string, depth, blank = r["string_out"], depth + r["depth"], r["blank"]
        # A brace is added to every piece, so also after a file's last one.
        if string or depth not in ((0, -1) if blank else (0,)):
            errors[file] = "invalid JSON"
        elif not found:
            errors[file] = "no messages list"
    return begins, errors


def read_large_chat_export(spark: SparkSession, path: str, normalize_utc: bool = False, skip_bad: bool = False) -> DataFrame:
    """S2 + F7 as :func:`quillspark.operators.chatlog.read_chat_export`, the
    same columns and rows, for files too large for a task: each is read in
    byte ranges of ``spark.sql.files.maxPartitionBytes``.

    A file is one JSON object whose top-level ``messages`` list is wanted.
    Brackets and quotes are checked over the whole file, the values of other
    keys no further. An item that isn't JSON, brackets that don't match and
    a missing list are errors; with ``skip_bad`` the file's rows or the item
    are left out. Two reads of the file; the driver sees a few numbers for
    each range.
    """
    ship_package(spark)
    raw = spark.read.option("lineSep", "}").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    shape = "file string, start bigint, string_in boolean, string_out boolean, depth bigint, levels array<bigint>, listed array<boolean>, blank boolean"
    begins, errors = _begins(raw.mapInArrow(_summarise, shape).collect())
    if errors and not skip_bad:
        raise ValueError("; ".join(f"{f}: {e}" for f, e in sorted(errors.items())))
    known = spark.sparkContext.broadcast(begins)
    items = raw.mapInArrow(_cut(known), "file string, start bigint, i bigint, whole boolean, item string")
    items = stored_table(items, "export-items")
    if errors:
        items = items.where(~F.col("file").isin(sorted(errors)))
    # How many items end in the ranges before each one: a row for each range.
    ended = defaultdict(dict)
    for r in items.where("whole is null").select("file", "start", "i").collect():
        ended[r["file"]][r["start"]] = r["i"]
    offsets = []
    for file, ranges in ended.items():
        n = 0
        for start in sorted(ranges):
            offsets.append((file, start, n))
            n += ranges[start]
    places = spark.createDataFrame(offsets, "file string, start bigint, before bigint")
    items = items.join(F.broadcast(places), ["file", "start"]).where("whole is not null").withColumn("pos", F.col("before") + F.col("i"))
    pieces = items.where("not whole").groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("start", "item"))).alias("p"))
    joined = items.where("whole").select("file", "pos", "item").unionByName(pieces.select("file", "pos", F.array_join(F.transform("p", lambda x: x["item"]), "").alias("item")))
    joined = joined.where(F.length(F.trim(F.regexp_replace("item", "[\\t\\r\\n]", " "))) > 0)
    parsed = joined.withColumn("m", F.expr("try_parse_json(item)"))
    if skip_bad:
        parsed = parsed.where("m is not null")
    else:
        parsed = parsed.withColumn("m", F.when(F.col("m").isNotNull(), F.col("m")).otherwise(F.raise_error(F.concat("file", F.lit(": item "), F.col("pos").cast("string"), F.lit(" isn't JSON")))))
    return parse_messages(parsed, "m", keep=["file", "pos"], normalize_utc=normalize_utc)
