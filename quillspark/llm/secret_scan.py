"""Secret scans with an incremental blob ledger.

Every version of a text is a blob named by its SHA-256. The ledger is a
Parquet table of blobs, the rule versions they were scanned with and the
spans found. A run scans only pairs of blob and rule version that the ledger
lacks, each blob once however many documents hold it, appends its findings,
and joins them back to every document with that content.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import documents, fresh_folder, id_key, stored


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters.
    ``hint`` is an RE2 pattern that finds every text with such a match."""

    kind: str
    version: int
    pattern: str
    least: int
    hint: str
    group: int = 0
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost non-overlapping matches, too short ones dropped (code points)."""
        found = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0)).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# The patterns of the kinds that every scan has.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12,
         r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""", group=2, any_case=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]+", 16, r"[0-9a-f]{16}"),
)
EXTRA = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8}"),
    Rule("url_login", 1, r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{1,64}@", 1, r"://[^\s:/@]{1,64}:[^\s:/@]{1,64}@"),
    Rule("host_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 1, r"gh[pousr]_[A-Za-z0-9]{36}"),
)
RULES = BASE + EXTRA
_SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"


def _scan(rules: tuple[Rule, ...]):
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("two rules of one name")

    def run(batches):
        for batch in batches:
            blobs, texts, todo = batch.column(0), ts.plain(batch.column(1)), batch.column(2).to_pylist()
            found = [[] for _ in todo]
            for rule in rules:
                for i in pc.indices_nonzero(pc.match_substring_regex(texts, rule.hint)).to_pylist():
                    if rule.name in todo[i]:
                        found[i] += [{"kind": rule.kind, "start": a, "stop": b} for a, b in rule.spans(texts[i].as_py())]
            yield pa.RecordBatch.from_arrays(
                [blobs, batch.column(2), pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))],
                names=["blob", "rules", "spans"])

    return run


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one where nothing was written yet."""
    schema = f"blob string, rules array<string>, spans {_SPANS}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_new(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scans the pairs of blob and rule version that ``ledger`` lacks and
    appends one row per scanned blob. Returns how many blobs were scanned."""
    spark = docs.sparkSession
    src = documents(spark, docs)
    names = F.array(*[F.lit(r.name) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    # A holder is told by id and text hash, so rows without an id, or of one id, don't meet each other's blobs.
    place = [id_key().alias("key"), F.xxhash64("text").alias("th")]
    blobs = src.select(blob_id(F.col("text")).alias("blob"), *place).groupBy("blob").agg(F.min(F.struct("key", "th")).alias("place"))
    todo = (blobs.join(known, "blob", "left")
            .select("blob", "place.key", "place.th", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("rules"))
            .where("size(rules) > 0"))
    # One holder of each blob brings its text; the others' texts stay where they are.
    texts = (src.select(*place, "text").join(todo, ["key", "th"]).where(blob_id(F.col("text")) == F.col("blob"))
             .select("blob", "text", "rules"))
    fresh = stored(texts.mapInArrow(_scan(rules), f"blob string, rules array<string>, spans {_SPANS}").dropDuplicates(["blob"]), "scanned")
    fresh.write.mode("append").parquet(ledger)
    return fresh.count()


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, blob, spans`` of every row: what the ledger has for its blob
    under the current rule versions, by start and then rule order."""
    spark = docs.sparkSession
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    names = F.array(*[F.lit(r.name) for r in rules])
    entries = (read_ledger(spark, ledger).where(F.arrays_overlap("rules", names)).groupBy("blob")
               .agg(F.flatten(F.collect_list(F.filter("spans", lambda s: F.array_contains(
                   F.transform(F.array_intersect("rules", names), lambda r: F.split_part(r, F.lit("@"), F.lit(1))), s["kind"])))).alias("spans")))
    ordered = F.array_sort(F.transform(F.array_distinct("spans"), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    entries = entries.select("blob", ordered.alias("spans"))
    return (documents(spark, docs).select("doc_id", blob_id(F.col("text")).alias("blob")).join(entries.where("size(spans) > 0"), "blob", "left")
            .select("doc_id", "blob", F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>)")).alias("spans")))


def secret_scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, a row per row.

    Scans what ``ledger`` (a folder; a fresh one by default) lacks, then
    joins its findings to all documents. ``spans`` is ``kind:start:end`` of
    all spans by start and then rule order, comma-joined; ``base_sha256``
    digests the same of the base kinds. Positions are code points.

    Null text is empty. A null ``doc_id``, repeated rows and copies get the
    findings of their content; an empty table gives an empty result; other
    columns are ignored.
    """
    ledger = ledger or fresh_folder(docs.sparkSession, "ledger")
    scan_new(docs, ledger, rules)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    count = [F.size(F.expr(f"filter(spans, s -> s.kind = '{r.kind}')")).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return findings(docs, ledger, rules).select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
