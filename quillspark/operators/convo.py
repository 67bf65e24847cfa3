"""Conversation formats (V1-V4, V8).

* V1 merge prompt: ``{col}`` placeholders and optional ``[[...]]`` parts are
  parsed once on the driver into a ``concat`` Column; an optional part is
  kept when its first column is truthy (null, empty text, 0 and false are
  not). Values print as Python ``str`` (null -> ``None``).
* V2 two columns -> ``[{from: human, value}, {from: gpt, value}]``.
* V3 extension: each row's conversation is concatenated with the rows at the
  same position of ``k-1`` seeded shuffles (md5 order, seeds ``random_state +
  j``); positions are global indexes, the concatenation an equi-join.
* V4 standardize: role vs content key inferred from all rows (the key with
  fewer distinct values is the role, the second on a tie); roles
  mapped through the alias lists, unknown roles raise.
* V8 key mapping for templates (``from/value/human/gpt`` -> ``role/content``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.indexing import key_index
from ..functions.pytext import py_str
from .assemble import seeded_order

# Default role aliases of the standardizer.
ALIASES_SYSTEM = ["system"]
ALIASES_USER = ["user", "human", "input"]
ALIASES_ASSISTANT = ["gpt", "assistant", "output"]
EXTENSION_SEED = 3407


# ---------------------------------------------------------------- V1

def _enclosed(text: str, opening: str, closing: str, one_line: bool) -> Iterator[tuple[str, str | None]]:
    """``(literal, inner)`` pairs in order: text up to an ``opening`` and the
    non-empty part up to the next ``closing``; ``inner`` is None for the tail."""
    rest = text
    literal = ""
    while True:
        before, found, after = rest.partition(opening)
        end = after.find(closing, 1) if found else -1
        if not found:
            yield literal + before, None
            return
        if end < 0 or (one_line and "\n" in after[:end]):
            literal += before + opening[0]          # not an opening; go on behind its first character
            rest = (opening + after)[1:]
            continue
        yield literal + before, after[:end]
        literal, rest = "", after[end + len(closing):]


def parse_merged_prompt(prompt: str, columns: list[str]) -> list:
    """A merged prompt as nodes: ``("text", s)``, ``("column", name)`` and
    ``("optional", nodes)``. Unknown columns raise ``KeyError``."""
    def fields(text: str) -> list:
        out = []
        for literal, name in _enclosed(text, "{", "}", one_line=True):
            if literal:
                out.append(("text", literal))
            if name is not None:
                if name not in columns:
                    raise KeyError(f"no column {name!r} for the prompt's placeholder (have: {', '.join(columns)})")
                out.append(("column", name))
        return out

    nodes = []
    for literal, optional in _enclosed(prompt, "[[", "]]", one_line=False):
        nodes += fields(literal)
        if optional is not None:
            nodes.append(("optional", fields(optional)))
    return nodes


def _truthy(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return c.isNotNull() & (c != 0)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def _filled(nodes: list, schema: T.StructType) -> Column:
    def one(kind, value):
        if kind == "text":
            return F.lit(value)
        return py_str(F.col(value), "boolean" if isinstance(schema[value].dataType, T.BooleanType) else None)
    return F.concat(*[one(*n) for n in nodes]) if nodes else F.lit("")


def merged_prompt(df: DataFrame, prompt: str) -> Column:
    """V1: the merged-prompt Column for ``df``. An optional part depends on
    its first column; one without columns always stays."""
    pieces = []
    for kind, value in parse_merged_prompt(prompt, df.columns):
        if kind != "optional":
            pieces.append(_filled([(kind, value)], df.schema))
            continue
        body = _filled(value, df.schema)
        first = next((v for k, v in value if k == "column"), None)
        pieces.append(body if first is None else
                      F.when(_truthy(F.col(first), df.schema[first].dataType), body).otherwise(F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


# ---------------------------------------------------------------- V2 / V3

_SHAREGPT = T.ArrayType(T.StructType([T.StructField("from", T.StringType()),
                                      T.StructField("value", T.StringType())]))


def to_sharegpt(df: DataFrame, merged_prompt_text: str, output_column: str, keep: list | None = None) -> DataFrame:
    """V2: ``conversations`` in human/gpt form (plus ``keep`` columns)."""
    if "conversations" in df.columns and isinstance(df.schema["conversations"].dataType, T.ArrayType):
        raise TypeError("dataset is probably already in ShareGPT format")
    user = merged_prompt(df, merged_prompt_text)
    out_dtype = df.schema[output_column].dataType
    assistant = py_str(F.col(output_column), "boolean" if isinstance(out_dtype, T.BooleanType) else None)
    conv = F.array(F.struct(F.lit("human").alias("from"), F.coalesce(user, F.lit("None")).alias("value")),
                   F.struct(F.lit("gpt").alias("from"), assistant.alias("value")))
    return df.select(*(keep or []), conv.alias("conversations"))


def extend_conversations(df: DataFrame, order: list, k: int, random_state: int = EXTENSION_SEED,
                         conversations: str = "conversations") -> DataFrame:
    """V3: concatenate each row's conversation with the rows at the same
    position of ``k-1`` seeded shuffles; the row count stays ``n``. The
    positions are paired on the ``order`` keys alone (which must be unique);
    each shuffle's conversations join the pairs once."""
    if k <= 1:
        return df
    pairs = key_index(df, order, "_qs_pos")
    for j in range(1, k):
        theirs = seeded_order(df.select(*order), order, random_state + j, "_qs_pos")
        pairs = pairs.join(theirs.select("_qs_pos", *[F.col(c).alias(f"_qs_{j}_{c}") for c in order]), "_qs_pos")
    out = df.join(pairs.drop("_qs_pos"), order)
    for j in range(1, k):
        other = df.select(*[F.col(c).alias(f"_qs_{j}_{c}") for c in order], F.col(conversations).alias(f"_qs_c{j}"))
        out = out.join(other, [f"_qs_{j}_{c}" for c in order])
    merged = F.concat(F.col(conversations), *[F.col(f"_qs_c{j}") for j in range(1, k)])
    return out.withColumn(conversations, merged).select(*df.columns)


# ---------------------------------------------------------------- V4 / V8

def infer_role_key(df: DataFrame, conversations: str = "conversations", order: list | None = None,
                   first_rows: int | None = None) -> tuple[str, str]:
    """Role and content keys: the key with fewer distinct values over all rows
    is the role (the second key on a tie). ``first_rows`` looks only at that
    many rows in ``order``, which the reference does with ten."""
    fields = df.schema[conversations].dataType.elementType.fieldNames()
    if len(fields) != 2:
        raise AssertionError("messages must have exactly two keys")
    if first_rows is not None:
        if not order:
            raise ValueError("first_rows needs an order")
        df = df.orderBy(*order).limit(first_rows)
    first, second = fields
    counts = (df.select(F.explode(conversations).alias("m"))
              .agg(*[F.approx_count_distinct(F.col("m")[f], 0.01).alias(f) for f in fields]
                   if first_rows is None else [F.countDistinct(F.col("m")[f]).alias(f) for f in fields]).first())
    if counts[first] < counts[second]:
        return first, second
    return second, first


def standardize_sharegpt(df: DataFrame, conversations: str = "conversations", order: list | None = None,
                         aliases_for_system=None, aliases_for_user=None, aliases_for_assistant=None,
                         keys: tuple[str, str] | None = None, first_rows: int | None = None) -> DataFrame:
    """V4: messages -> ``{role: system|user|assistant, content}``. ``keys``
    names the role and content keys; by default they are inferred from all
    rows (:func:`infer_role_key`). A role outside the aliases, in any row, is
    an error when that row is computed."""
    sys_a = aliases_for_system or ALIASES_SYSTEM
    usr_a = aliases_for_user or ALIASES_USER
    ast_a = aliases_for_assistant or ALIASES_ASSISTANT
    role_key, content_key = keys or infer_role_key(df, conversations, order, first_rows)

    def role(r):
        return (F.when(r.isin(*sys_a), F.lit("system")).when(r.isin(*usr_a), F.lit("user"))
                 .when(r.isin(*ast_a), F.lit("assistant"))
                 .otherwise(F.raise_error(F.concat(F.lit("role not in aliases: "), F.coalesce(r, F.lit("null"))))))
    std = F.transform(conversations, lambda m: F.struct(role(m[role_key]).alias("role"),
                                                        m[content_key].alias("content")))
    return df.withColumn(conversations, std)


DEFAULT_MAPPING = {"role": "role", "content": "content", "user": "user", "assistant": "assistant"}


def apply_mapping(df: DataFrame, messages: str, mapping: dict[str, str]) -> DataFrame:
    """V8: messages with ``role`` keep their keys; otherwise the mapped keys
    become role/content and the mapped user / assistant values become
    ``user``/``assistant`` (other values, e.g. ``system``, pass unchanged)."""
    fields = df.schema[messages].dataType.elementType.fieldNames()
    if "role" in fields or mapping == DEFAULT_MAPPING:
        return df
    rk, ck, u, a = mapping["role"], mapping["content"], mapping["user"], mapping["assistant"]
    conv = F.transform(messages, lambda m: F.struct(
        F.when(m[rk] == u, F.lit("user")).when(m[rk] == a, F.lit("assistant")).otherwise(m[rk]).alias("role"),
        m[ck].alias("content")))
    return df.withColumn(messages, conv)
