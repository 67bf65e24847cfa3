"""Conversation-format queries (V1-V4, V8) over ``part``, ``customer`` and
``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import convo as CV
from ..operators import templates as T
from . import plan_templates as PT
from .registry import query, table

PART_PROMPT = "Describe {p_name}[[, a {p_type} item]][[ of size {p_size}]] by {p_brand}."
CUST_PROMPT = "Customer {c_name}[[ of nation {c_nationkey}]][[ with balance {c_acctbal}]] in {c_mktsegment}"


def _s(x):
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


PART_SQL = (f"'Describe ' || {_s('p_name')} || CASE WHEN p_type IS NOT NULL AND p_type <> '' THEN ', a ' || "
            f"{_s('p_type')} || ' item' ELSE '' END || CASE WHEN p_size IS NOT NULL AND p_size <> 0 THEN "
            f"' of size ' || {_s('p_size')} ELSE '' END || ' by ' || {_s('p_brand')} || '.'")
CUST_SQL = (f"'Customer ' || {_s('c_name')} || CASE WHEN c_nationkey IS NOT NULL AND c_nationkey <> 0 THEN "
            f"' of nation ' || {_s('c_nationkey')} ELSE '' END || CASE WHEN c_acctbal IS NOT NULL AND c_acctbal <> 0 "
            f"THEN ' with balance ' || {_s('c_acctbal')} ELSE '' END || ' in ' || {_s('c_mktsegment')}")


@query("v1_merge_prompt_part", f"SELECT p_partkey, {PART_SQL} AS instruction FROM part")
def v1_part(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", CV.merged_prompt(p, PART_PROMPT).alias("instruction"))


@query("v1_merge_prompt_customer", f"SELECT c_custkey, {CUST_SQL} AS instruction FROM customer")
def v1_cust(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", CV.merged_prompt(c, CUST_PROMPT).alias("instruction"))


def _flat(df, key):
    return df.select(key, F.posexplode("conversations").alias("msg_idx", "m")).select(
        key, F.col("msg_idx").cast("bigint"), F.col("m.from").alias("from"), F.col("m.value").alias("value"))


V2_SQL = (f"SELECT p_partkey, CAST(0 AS BIGINT) AS msg_idx, 'human' AS \"from\", {PART_SQL} AS value FROM part "
          f"UNION ALL SELECT p_partkey, CAST(1 AS BIGINT), 'gpt', {_s('p_retailprice')} FROM part")


@query("v2_to_sharegpt", V2_SQL)
def v2(spark, sf):
    p = table(spark, sf, "part")
    return _flat(CV.to_sharegpt(p, PART_PROMPT, "p_retailprice", keep=["p_partkey"]), "p_partkey")


@query("v3_conversation_extension", f"""WITH m AS ({V2_SQL}),
base AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part),
s1 AS (SELECT p_partkey AS src, row_number() OVER (ORDER BY md5('3408|' || p_partkey), p_partkey) - 1 AS pos FROM part),
s2 AS (SELECT p_partkey AS src, row_number() OVER (ORDER BY md5('3409|' || p_partkey), p_partkey) - 1 AS pos FROM part),
parts AS (SELECT base.p_partkey, 0 AS j, base.p_partkey AS src FROM base
          UNION ALL SELECT base.p_partkey, 1, s1.src FROM base JOIN s1 USING (pos)
          UNION ALL SELECT base.p_partkey, 2, s2.src FROM base JOIN s2 USING (pos))
SELECT parts.p_partkey, CAST(j * 2 + m.msg_idx AS BIGINT) AS msg_idx, m."from", m.value
FROM parts JOIN m ON m.p_partkey = parts.src""")
def v3(spark, sf):
    p = table(spark, sf, "part")
    conv = CV.to_sharegpt(p, PART_PROMPT, "p_retailprice", keep=["p_partkey"])
    return _flat(CV.extend_conversations(conv, ["p_partkey"], 3), "p_partkey")


def sharegpt_conversations(spark, sf):
    """``conversations`` rows as ShareGPT ``from/value`` messages."""
    turns = table(spark, sf, "conversations")
    frm = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    packed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", frm.alias("from"),
                                                                               F.col("text").alias("value")))).alias("_m"))
    return packed.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                         F.transform("_m", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
                         .alias("conversations"))


@query("v4_standardize_sharegpt", """SELECT CAST(conv_id AS BIGINT) AS conv_id,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS msg_idx, role, text AS content
  FROM conversations""")
def v4(spark, sf):
    std = CV.standardize_sharegpt(sharegpt_conversations(spark, sf), order=["conv_id"])
    return std.select("conv_id", F.posexplode("conversations").alias("msg_idx", "m")).select(
        "conv_id", F.col("msg_idx").cast("bigint"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query("v8_mapping_chatml", PT.SQL_CHATML)
def v8(spark, sf):
    mapping = {"role": "from", "content": "value", "user": "human", "assistant": "gpt"}
    df = CV.apply_mapping(sharegpt_conversations(spark, sf), "conversations", mapping)
    return df.select("conv_id", T.render("conversations", "chatml").alias("text"))
