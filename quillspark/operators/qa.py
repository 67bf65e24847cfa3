"""Question/answer blocks.

A QA file is blocks separated by an empty line; a block is
``Вопрос: ...`` newline ``Ответ: ...``. Reference semantics (SURVEY 2.9):

* blocks: ``text.strip().split('\\n\\n')``, each block stripped;
* F5: both marks must be present ignoring case, then the case-sensitive split
  on ``\\nОтвет:`` must give at least two parts (so lower-case marks pass the
  test and are then rejected, unless ``ignore_case``);
* only ``parts[1]`` is kept: a block with two answers loses the second, and a
  block with two pairs keeps the second question inside the first answer;
* Q1 (pair form) removes ``"`` and re-adds ``Ответ: `` in front of the answer;
  Q2 (messages form) removes every occurrence of both marks and keeps quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pytext import literal_split, py_strip
from ..session import is_file

# The block marks of the QA format.
Q_MARK = "Вопрос:"
A_MARK = "Ответ:"
A_SPLIT = "\nОтвет:"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def read_qa_files(spark: SparkSession, path: str, glob: str = "*.qa") -> DataFrame:
    """S3: one file of any name, or every ``*.qa`` file of a directory, as
    whole texts ``(file, text)``; ``\\r\\n`` is normalised as text-mode
    reading does."""
    reader = spark.read.option("pathGlobFilter", glob) if glob and not is_file(spark, path) else spark.read
    raw = reader.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("file"),
                      F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def split_blocks(text) -> Column:
    """``[b.strip() for b in text.strip().split('\\n\\n')]``."""
    return F.transform(literal_split(py_strip(_c(text)), "\n\n"), lambda b: py_strip(b))


def blocks(df: DataFrame, text: str = "text", keys: list | None = None) -> DataFrame:
    keys = keys if keys is not None else [c for c in df.columns if c != text]
    return df.select(*keys, F.posexplode(split_blocks(text)).alias("block_idx", "block")) \
             .withColumn("block_idx", F.col("block_idx").cast("bigint"))


def has_marks(block) -> Column:
    """F5 presence test, case-insensitive (Unicode folding)."""
    b = _c(block)
    return b.rlike("(?iu)Вопрос:") & b.rlike("(?iu)\nОтвет:")


def answer_parts(block, ignore_case: bool = False) -> Column:
    b = _c(block)
    if ignore_case:
        return F.split(b, "(?iu)\nОтвет:", -1)
    return literal_split(b, A_SPLIT)


def qa_pairs(blocks_df: DataFrame, block: str = "block", ignore_case: bool = False,
             keep: list | None = None) -> DataFrame:
    """Q1 (with F5): ``question`` keeps its mark, quotes removed; ``answer`` is
    ``Ответ: `` + the first answer, quotes removed."""
    keep = keep if keep is not None else [c for c in blocks_df.columns if c != block]
    parts = answer_parts(block, ignore_case)
    ok = has_marks(block) & (F.size(parts) >= 2)
    return (blocks_df.filter(ok)
            .select(*keep,
                    py_strip(F.replace(F.get(parts, 0), F.lit('"'), F.lit(""))).alias("question"),
                    F.concat(F.lit(A_MARK + " "),
                             py_strip(F.replace(F.get(parts, 1), F.lit('"'), F.lit("")))).alias("answer")))


def qa_messages(blocks_df: DataFrame, block: str = "block", ignore_case: bool = False,
                keep: list | None = None) -> DataFrame:
    """Q2: ``messages = [user: question, assistant: answer]`` with both marks
    removed everywhere, quotes kept."""
    keep = keep if keep is not None else [c for c in blocks_df.columns if c != block]
    parts = answer_parts(block, ignore_case)
    ok = has_marks(block) & (F.size(parts) >= 2)
    q = py_strip(F.replace(F.get(parts, 0), F.lit(Q_MARK), F.lit("")))
    a = py_strip(F.replace(F.get(parts, 1), F.lit(A_MARK), F.lit("")))
    msgs = F.array(F.struct(F.lit("user").alias("role"), q.alias("content")),
                   F.struct(F.lit("assistant").alias("role"), a.alias("content")))
    return blocks_df.filter(ok).select(*keep, msgs.alias("messages"))


def training_text(question, answer, bos: str = "<s>", eos: str = "</s>") -> Column:
    """Q3: ``bos q eos bos a eos``."""
    return F.concat(F.lit(bos), _c(question), F.lit(eos), F.lit(bos), _c(answer), F.lit(eos))


def collapse_blank_line(text, q_mark: str = "question:", a_mark: str = "answer:",
                        ignore_case: bool = True) -> Column:
    """Q4: the documented editor replacement ``(question:.+?\\n)\\n(answer:.+?)``
    -> ``$1$2`` (removes the blank line between a question and its answer);
    ``.`` does not cross lines, as in the editor."""
    flags = "(?iu)" if ignore_case else ""
    pat = flags + "(" + _quote(q_mark) + r"[^\n]+?\n)\n(" + _quote(a_mark) + r"[^\n]+?)"
    return F.regexp_replace(_c(text), pat, "$1$2")


def _quote(s: str) -> str:
    return r"\Q" + s + r"\E"
