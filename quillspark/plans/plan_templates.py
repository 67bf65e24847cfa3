"""Template rendering queries (V5-V11, F9) over ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import templates as T
from .registry import q, query, table

BOS, EOS = "<s>", "</s>"
NL = "\n"


def _convs(spark, sf):
    return T.conversations_from_turns(table(spark, sf, "conversations"))


def _render(name, **kw):
    def fn(spark, sf):
        df = _convs(spark, sf)
        return df.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                         T.render("messages", name, bos_token=BOS, eos_token=EOS,
                                  messages_type=df.schema["messages"].dataType, **kw).alias("text"))
    return fn


# Per-message context for the oracle: position, first / second message,
# neighbours.
_CTX = """WITH m AS (
  SELECT conv_id, turn, role, text AS content,
         row_number() OVER w - 1 AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         first_value(role) OVER wa AS r0, first_value(text) OVER wa AS c0,
         nth_value(role, 2) OVER wa AS r1, nth_value(text, 2) OVER wa AS c1,
         lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn),
         wa AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
"""

# Python str.strip() whitespace class (same text as the Spark side).
_WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}"
       r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _strip(x):
    return f"regexp_replace({x}, '\\A{_WS}+|{_WS}+\\z', '', 'g')"


def _agg(piece, prefix="''", suffix="''"):
    return (_CTX + f"SELECT CAST(conv_id AS BIGINT) AS conv_id, {prefix} || "
            f"coalesce(string_agg({piece}, '' ORDER BY turn), '') || {suffix} AS text "
            f"FROM m GROUP BY conv_id, r0, c0, r1, c1")


def _sys_loop_sql(default, sep, user_pre, user_post, asst_pre, asst_post, gen=""):
    prefix = f"{q(BOS)} || CASE WHEN r0 = 'system' THEN c0 || {q(sep)} ELSE {q(default + sep)} END"
    piece = (f"CASE WHEN r0 = 'system' AND i = 0 THEN NULL "
             f"WHEN role = 'user' THEN {q(user_pre)} || content || {q(user_post)} "
             f"WHEN role = 'assistant' THEN {q(asst_pre)} || content || {q(asst_post)} "
             f"ELSE error('role') END")
    return _agg(piece, prefix, q(gen))


SQL_UNSLOTH = _sys_loop_sql(T.SYS_UNSLOTH, NL, ">>> User: ", NL, ">>> Assistant: ", EOS + NL)
SQL_VICUNA = _sys_loop_sql(T.SYS_VICUNA, " ", "USER: ", " ", "ASSISTANT: ", EOS)
SQL_VICUNA_SYS = _sys_loop_sql("You are a careful assistant.", " ", "USER: ", " ", "ASSISTANT: ", EOS)
SQL_VICUNA_OLD = _sys_loop_sql(T.SYS_VICUNA_OLD, NL, "### Human: ", NL, "### Assistant: ", EOS + NL)
SQL_ALPACA = _sys_loop_sql(T.SYS_ALPACA, NL + NL, "### Instruction:\n", NL + NL, "### Response:\n",
                           EOS + NL + NL)

SQL_ZEPHYR = _agg(f"CASE role WHEN 'user' THEN '<|user|>\n' WHEN 'assistant' THEN '<|assistant|>\n' "
                  f"ELSE '<|system|>\n' END || content || {q(EOS + NL)}")
_CHATML_PIECE = ("'<|im_start|>' || CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' "
                 "ELSE 'system' END || '\n' || content || '<|im_end|>\n'")
SQL_CHATML = _agg(_CHATML_PIECE)
SQL_CHATML_GEN = _agg(_CHATML_PIECE, suffix=q("<|im_start|>assistant\n"))
SQL_GEMMA_CHATML = _agg(_CHATML_PIECE, prefix=q(BOS))

SQL_MISTRAL = _agg(
    "CASE WHEN r0 = 'system' AND r1 = 'user' AND i < 2 THEN NULL "
    "WHEN r0 = 'system' AND i = 0 THEN NULL "
    "WHEN role = 'user' THEN '[INST] ' || content || ' [/INST]' "
    f"WHEN role = 'assistant' THEN content || {q(EOS)} ELSE error('role') END",
    prefix=(f"{q(BOS)} || CASE WHEN r0 = 'system' AND r1 = 'user' THEN '[INST] ' || c0 || ' ' || c1 || ' [/INST]' "
            "WHEN r0 = 'system' THEN '[INST] ' || c0 || ' [/INST]' ELSE '' END"))

SQL_LLAMA = _agg(
    "CASE WHEN r0 = 'system' AND r1 = 'user' AND i < 2 THEN NULL "
    "WHEN r0 = 'system' AND i = 0 THEN NULL "
    f"WHEN role = 'user' THEN {q(BOS + '[INST] ')} || {_strip('content')} || ' [/INST]' "
    f"WHEN role = 'assistant' THEN ' ' || {_strip('content')} || {q(' ' + EOS)} ELSE error('role') END",
    prefix=(f"CASE WHEN r0 = 'system' AND r1 = 'user' THEN {q(BOS + '[INST] <<SYS>>' + NL)} || c0 || "
            f"{q(NL + '<</SYS>>' + NL + NL)} || c1 || ' [/INST]' "
            f"WHEN r0 = 'system' THEN {q(BOS + '[INST] ')} || c0 || ' [/INST]' ELSE '' END"))

SQL_GEMMA = _agg(
    "CASE WHEN r0 = 'system' AND i < 2 THEN NULL "
    f"WHEN role = 'user' THEN '<start_of_turn>user\n' || {_strip('content')} || '<end_of_turn>\n' "
    f"WHEN role = 'assistant' THEN '<start_of_turn>model\n' || {_strip('content')} || '<end_of_turn>\n' "
    "ELSE error('role') END",
    prefix=(f"{q(BOS)} || CASE WHEN r0 = 'system' THEN '<start_of_turn>user\n' || {_strip('c0')} || ' ' || "
            f"{_strip('c1')} || '<end_of_turn>\n' ELSE '' END"))

SQL_LLAMA3 = _agg(f"'<|start_header_id|>' || role || '<|end_header_id|>\n\n' || {_strip('content')} || '<|eot_id|>'",
                  prefix=q(BOS))
SQL_PHI3 = _agg("'<|' || role || '|>\n' || content || '<|end|>\n'")
SQL_PHI4 = _agg("CASE WHEN role IN ('system', 'user', 'assistant') THEN "
                "'<|im_start|>' || role || '<|im_sep|>' || content || '<|im_end|>' END")
SQL_LLAMA31 = _agg(
    "CASE WHEN r0 = 'system' AND i = 0 THEN NULL "
    "WHEN role IN ('tool', 'ipython') THEN '<|start_header_id|>ipython<|end_header_id|>\n\n' || "
    "to_json(content) || '<|eot_id|>' "
    "ELSE '<|start_header_id|>' || role || '<|end_header_id|>\n\n' || content || '<|eot_id|>' END",
    prefix=(f"{q(BOS)} || '<|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: December 2023\n"
            f"Today Date: {T.LLAMA31_DATE}\n\n' || CASE WHEN r0 = 'system' THEN c0 ELSE '' END || '<|eot_id|>'"))
SQL_QWEN25 = _agg(
    "CASE WHEN role = 'user' OR (role = 'system' AND i > 0) OR role = 'assistant' THEN "
    "'<|im_start|>' || role || '\n' || content || '<|im_end|>\n' "
    "WHEN role = 'tool' THEN CASE WHEN i = 0 OR prev_role <> 'tool' THEN '<|im_start|>user' ELSE '' END || "
    "'\n<tool_response>\n' || content || '\n</tool_response>' || "
    "CASE WHEN i = n - 1 OR next_role <> 'tool' THEN '<|im_end|>\n' ELSE '' END END",
    prefix=(f"CASE WHEN r0 = 'system' THEN '<|im_start|>system\n' || c0 || '<|im_end|>\n' "
            f"ELSE {q('<|im_start|>system' + NL + T.SYS_QWEN25 + '<|im_end|>' + NL)} END"))

SQL_V9 = _agg(
    "CASE WHEN r0 = 'system' AND i = 0 THEN NULL "
    "WHEN role = 'user' THEN '<|start_header_id|>user<|end_header_id|>\n\n' || content || '<|eot_id|>' "
    "WHEN role = 'assistant' THEN '<|start_header_id|>assistant<|end_header_id|>\n\n' || content || '<|eot_id|>' "
    "ELSE error('role') END",
    prefix=("CASE WHEN r0 = 'system' THEN '<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n' || c0 "
            f"|| '<|eot_id|>' ELSE {q(T.V9_SYSTEM_PART.replace('{SYSTEM}', T.V9_DEFAULT_SYSTEM))} END"))
SQL_V10 = _agg(
    "CASE WHEN role IN ('user', 'assistant') THEN '<|start_header_id|>' || role || '<|end_header_id|>' || "
    "content || '<|eot_id|>' END",
    prefix=q("<|begin_of_text|><|start_header_id|>system<|end_header_id|>" + T.V10_SYSTEM + "<|eot_id|>"))
SQL_V11 = _agg("CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: ' WHEN 'assistant' THEN "
               "'Assistant: ' END || content || '\n'")

query("v5_unsloth", SQL_UNSLOTH, bench=True)(_render("unsloth"))
query("v5_zephyr", SQL_ZEPHYR)(_render("zephyr"))
query("v5_chatml", SQL_CHATML, bench=True)(_render("chatml"))
query("v5_mistral", SQL_MISTRAL)(_render("mistral"))
query("v5_llama", SQL_LLAMA)(_render("llama"))
query("v5_vicuna", SQL_VICUNA)(_render("vicuna"))
query("v5_vicuna_old", SQL_VICUNA_OLD)(_render("vicuna old"))
query("v5_alpaca", SQL_ALPACA)(_render("alpaca"))
query("v5_gemma", SQL_GEMMA)(_render("gemma2"))
query("v5_gemma_chatml", SQL_GEMMA_CHATML)(_render("gemma_chatml"))
query("v5_llama3", SQL_LLAMA3, bench=True)(_render("llama-3"))
query("v5_phi3", SQL_PHI3)(_render("phi-3.5"))
query("v5_llama31", SQL_LLAMA31)(_render("llama-3.2"))
query("v5_qwen25", SQL_QWEN25, bench=True)(_render("qwen2.5"))
query("v5_phi4", SQL_PHI4)(_render("phi-4"))
query("v6_chatml_generation_prompt", SQL_CHATML_GEN)(_render("chatml", add_generation_prompt=True))
query("v7_vicuna_system_override", SQL_VICUNA_SYS)(
    _render("vicuna", system_message="You are a careful assistant."))


@query("v9_parts_template", SQL_V9)
def v9(spark, sf):
    df = _convs(spark, sf)
    return df.select(F.col("conv_id").cast("bigint").alias("conv_id"), T.render_parts("messages").alias("text"))


@query("v10_trainer_template", SQL_V10)
def v10(spark, sf):
    df = _convs(spark, sf)
    return df.select(F.col("conv_id").cast("bigint").alias("conv_id"), T.render_trainer_v2("messages").alias("text"))


@query("v11_plain_prompt", SQL_V11)
def v11(spark, sf):
    df = _convs(spark, sf)
    return df.select(F.col("conv_id").cast("bigint").alias("conv_id"), T.render_plain("messages").alias("text"))


@query("f9_remove_bos", "SELECT conv_id, CASE WHEN starts_with(text, '<s>') THEN substr(text, 4) ELSE text END "
                        "AS text FROM (" + SQL_UNSLOTH + ")")
def f9(spark, sf):
    return _render("unsloth")(spark, sf).select("conv_id", T.remove_bos("text", BOS).alias("text"))
