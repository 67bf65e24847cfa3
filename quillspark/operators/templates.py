"""Chat-template rendering (V5-V12, F9) as Column expressions.

A conversation is ``array<struct<role:string, content:string>>`` (optionally
with ``tool_calls: array<struct<name:string, arguments:string>>``). Every named
body is written directly as ``transform`` + ``array_join`` over that array, so
rendering is a narrow projection: no shuffle for the array form, one
``groupBy(conversation)`` for the long ``(conv_id, turn, role, text)`` form.

Error paths of the templates (unknown role, reading a message that does not
exist) are ``raise_error`` inside a lazily evaluated ``when`` branch, so they
fire only for rows that take them.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pytext import py_strip

ONLY_UA = "a role other than user and assistant has no place in this template"

# Default system messages of the named templates.
SYS_UNSLOTH = "You are a helpful assistant to the user"
SYS_VICUNA = ("A chat between a curious user and an artificial intelligence assistant. "
              "The assistant gives helpful, detailed, and polite answers to the user's questions.")
SYS_VICUNA_OLD = ("A chat between a curious human and an artificial intelligence assistant. "
                  "The assistant gives helpful, detailed, and polite answers to the human's questions.")
SYS_ALPACA = ("Below are some instructions that describe some tasks. "
              "Write responses that appropriately complete each request.")
SYS_QWEN25 = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
LLAMA31_DATE = "26 July 2024"
# The inline template of the v2 trainer and its system text.
V10_SYSTEM = "You are a helpful AI assistant"

L = F.lit


def _raise(msg: str) -> Column:
    return F.raise_error(L(msg))


def _role(m: Column) -> Column:
    return F.coalesce(m["role"], _raise("a message has no role"))


def _content(m: Column) -> Column:
    """A NULL content is an error: no turn may drop out of a training text."""
    return F.coalesce(m["content"], _raise("a message has no content"))


def _join(arr: Column, fn) -> Column:
    """Pieces in order; a NULL piece is a message the template skips, a NULL
    conversation gives NULL."""
    return F.array_join(F.transform(arr, fn), "")


def _rest(msgs: Column, k: int) -> Column:
    """messages[k:]"""
    return F.slice(msgs, k + 1, F.greatest(F.size(msgs), L(1)))


def _is_sys(m: Column) -> Column:
    return F.coalesce(m["role"] == "system", L(False))


def _need_first(msgs: Column, body: Column) -> Column:
    return F.when(F.size(msgs) == 0, _raise("messages[0] is undefined")).otherwise(body)


def _ua(m: Column, user: Column, assistant: Column, other: Column | None = None) -> Column:
    r = _role(m)
    other = _raise(ONLY_UA) if other is None else other
    return F.when(r == "user", user).when(r == "assistant", assistant).otherwise(other)


def _tojson_str(c: Column) -> Column:
    """``json.dumps(str)`` of a string Column (quoted, escaped)."""
    j = F.to_json(F.array(c))
    return F.regexp_replace(j, r"\A\[|\]\z", "")


@dataclass
class Ctx:
    bos: str
    eos: str
    system: str | None
    gen: bool
    tools: list | None = None
    date_string: str = LLAMA31_DATE
    tools_in_user_message: bool = True
    builtin_tools: list | None = None


# --------------------------------------------------------------------------
# Bodies. Each takes (messages Column, Ctx) and returns the rendered text.
# --------------------------------------------------------------------------

def _sys_then_loop(msgs, ctx: Ctx, sep: str, user_fn, asst_fn, gen_text: str) -> Column:
    m0 = F.get(msgs, 0)
    head = F.when(_is_sys(m0), F.concat(_content(m0), L(sep))).otherwise(L((ctx.system or "") + sep))
    loop = F.when(_is_sys(m0), _rest(msgs, 1)).otherwise(msgs)
    body = _join(loop, lambda m: _ua(m, user_fn(_content(m)), asst_fn(_content(m))))
    out = F.concat(L(ctx.bos), head, body, L(gen_text if ctx.gen else ""))
    return _need_first(msgs, out)


def body_unsloth(msgs, ctx):
    return _sys_then_loop(msgs, ctx, "\n",
                          lambda c: F.concat(L(">>> User: "), c, L("\n")),
                          lambda c: F.concat(L(">>> Assistant: "), c, L(ctx.eos + "\n")),
                          ">>> Assistant: ")


def body_vicuna(msgs, ctx):
    return _sys_then_loop(msgs, ctx, " ",
                          lambda c: F.concat(L("USER: "), c, L(" ")),
                          lambda c: F.concat(L("ASSISTANT: "), c, L(ctx.eos)),
                          "ASSISTANT:")


def body_vicuna_old(msgs, ctx):
    return _sys_then_loop(msgs, ctx, "\n",
                          lambda c: F.concat(L("### Human: "), c, L("\n")),
                          lambda c: F.concat(L("### Assistant: "), c, L(ctx.eos + "\n")),
                          "### Assistant:")


def body_alpaca(msgs, ctx):
    return _sys_then_loop(msgs, ctx, "\n\n",
                          lambda c: F.concat(L("### Instruction:\n"), c, L("\n\n")),
                          lambda c: F.concat(L("### Response:\n"), c, L(ctx.eos + "\n\n")),
                          "### Response:\n")


def body_zephyr(msgs, ctx):
    def piece(m):
        r, c = _role(m), _content(m)
        tag = F.when(r == "user", L("<|user|>\n")).when(r == "assistant", L("<|assistant|>\n")) \
               .otherwise(L("<|system|>\n"))
        return F.concat(tag, c, L(ctx.eos + "\n"))
    return F.concat(_join(msgs, piece), L("<|assistant|>\n" if ctx.gen else ""))


def _chatml_loop(msgs):
    def piece(m):
        r, c = _role(m), _content(m)
        tag = F.when(r == "user", L("user")).when(r == "assistant", L("assistant")).otherwise(L("system"))
        return F.concat(L("<|im_start|>"), tag, L("\n"), c, L("<|im_end|>\n"))
    return _join(msgs, piece)


def body_chatml(msgs, ctx):
    return F.concat(_chatml_loop(msgs), L("<|im_start|>assistant\n" if ctx.gen else ""))


def body_gemma_chatml(msgs, ctx):
    return F.concat(L(ctx.bos), _chatml_loop(msgs), L("<|im_start|>assistant\n" if ctx.gen else ""))


def _merged_first(msgs, ctx, two: Callable[[Column, Column], Column], one: Callable[[Column], Column]):
    """mistral / llama: a leading system message merges with message 1 when
    that one is a user turn; reading a missing message 1 is an error."""
    m0, m1 = F.get(msgs, 0), F.get(msgs, 1)
    sys_first = _is_sys(m0)
    m1_user = _role(m1) == "user"
    head = F.when(sys_first & (F.size(msgs) < 2), _raise("messages[1] is undefined")) \
            .when(sys_first & m1_user, two(_content(m0), _content(m1))) \
            .when(sys_first, one(_content(m0))).otherwise(L(""))
    loop = F.when(sys_first & m1_user, _rest(msgs, 2)).when(sys_first, _rest(msgs, 1)).otherwise(msgs)
    return head, loop


def body_mistral(msgs, ctx):
    head, loop = _merged_first(
        msgs, ctx,
        lambda s, u: F.concat(L("[INST] "), s, L(" "), u, L(" [/INST]")),
        lambda s: F.concat(L("[INST] "), s, L(" [/INST]")))
    body = _join(loop, lambda m: _ua(m, F.concat(L("[INST] "), _content(m), L(" [/INST]")),
                                     F.concat(_content(m), L(ctx.eos))))
    return _need_first(msgs, F.concat(L(ctx.bos), head, body))


def body_llama(msgs, ctx):
    head, loop = _merged_first(
        msgs, ctx,
        lambda s, u: F.concat(L(ctx.bos + "[INST] <<SYS>>\n"), s, L("\n<</SYS>>\n\n"), u, L(" [/INST]")),
        lambda s: F.concat(L(ctx.bos + "[INST] "), s, L(" [/INST]")))
    body = _join(loop, lambda m: _ua(
        m, F.concat(L(ctx.bos + "[INST] "), py_strip(_content(m)), L(" [/INST]")),
        F.concat(L(" "), py_strip(_content(m)), L(" " + ctx.eos))))
    return _need_first(msgs, F.concat(head, body))


def body_gemma(msgs, ctx):
    m0, m1 = F.get(msgs, 0), F.get(msgs, 1)
    sys_first = _is_sys(m0)
    head = F.when(sys_first & (F.size(msgs) < 2), _raise("messages[1] is undefined")) \
            .when(sys_first, F.concat(L("<start_of_turn>user\n"), py_strip(_content(m0)), L(" "),
                                      py_strip(_content(m1)), L("<end_of_turn>\n"))).otherwise(L(""))
    loop = F.when(sys_first, _rest(msgs, 2)).otherwise(msgs)
    body = _join(loop, lambda m: _ua(
        m, F.concat(L("<start_of_turn>user\n"), py_strip(_content(m)), L("<end_of_turn>\n")),
        F.concat(L("<start_of_turn>model\n"), py_strip(_content(m)), L("<end_of_turn>\n"))))
    return _need_first(msgs, F.concat(L(ctx.bos), head, body,
                                      L("<start_of_turn>model\n" if ctx.gen else "")))


def body_llama3(msgs, ctx):
    body = _join(msgs, lambda m: F.concat(L("<|start_header_id|>"), _role(m), L("<|end_header_id|>\n\n"),
                                          py_strip(_content(m)), L("<|eot_id|>")))
    return F.concat(L(ctx.bos), body,
                    L("<|start_header_id|>assistant<|end_header_id|>\n\n" if ctx.gen else ""))


def body_phi3(msgs, ctx):
    body = _join(msgs, lambda m: F.concat(L("<|"), _role(m), L("|>\n"), _content(m), L("<|end|>\n")))
    return F.concat(body, L("<|assistant|>\n" if ctx.gen else ""))


def body_phi4(msgs, ctx):
    def piece(m):
        r = _role(m)
        return F.when(r.isin("system", "user", "assistant"),
                      F.concat(L("<|im_start|>"), r, L("<|im_sep|>"), _content(m), L("<|im_end|>")))
    return F.concat(_join(msgs, piece), L("<|im_start|>assistant<|im_sep|>" if ctx.gen else ""))


def _has_field(msgs_type, name: str) -> bool:
    try:
        return name in msgs_type.elementType.fieldNames()
    except AttributeError:
        return False


# Tool-use guidance texts of the llama-3.1 and qwen-2.5 bodies.
LLAMA31_TOOLS_USER = ("Given the following functions, please respond with a JSON for a function call "
                      "with its proper arguments that best answers the given prompt.\n\n"
                      'Respond in the format {"name": function name, "parameters": dictionary of '
                      'argument name and its value}.Do not use variables.\n\n')
LLAMA31_TOOLS_SYS = ("You have access to the following functions. To call a function, please respond "
                     "with JSON for a function call."
                     'Respond in the format {"name": function name, "parameters": dictionary of '
                     'argument name and its value}.Do not use variables.\n\n')
QWEN_TOOLS_HEAD = ("\n\n# Tools\n\nYou may call one or more functions to assist with the user query."
                   "\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>")
QWEN_TOOLS_TAIL = ("\n</tools>\n\nFor each function call, return a json object with function name and "
                   "arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
                   '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call><|im_end|>\n')


def body_llama31(msgs, ctx, has_tool_calls: bool = False):
    builtin = ctx.builtin_tools
    m0 = F.get(msgs, 0)
    sys_first = _is_sys(m0)
    system_text = F.when(sys_first, _content(m0)).otherwise(L(ctx.system or ""))
    rest = F.when(sys_first, _rest(msgs, 1)).otherwise(msgs)
    tools_json = "".join(json.dumps(t, ensure_ascii=False, indent=4) + "\n\n" for t in (ctx.tools or []))
    head = L(ctx.bos + "<|start_header_id|>system<|end_header_id|>\n\n"
             + ("Environment: ipython\n" if ctx.tools is not None or builtin is not None else "")
             + ("Tools: " + ", ".join(t for t in builtin if t != "code_interpreter") + "\n\n" if builtin is not None else "")
             + "Cutting Knowledge Date: December 2023\n"
             + "Today Date: " + ctx.date_string + "\n\n"
             + (LLAMA31_TOOLS_SYS + tools_json if ctx.tools is not None and not ctx.tools_in_user_message else ""))
    parts = [head, system_text, L("<|eot_id|>")]
    if ctx.tools is not None and ctx.tools_in_user_message:
        first = F.get(rest, 0)
        parts.append(F.when(F.size(rest) == 0, _raise(
            "tools go into the first user message, and there is none"))
            .otherwise(F.concat(L("<|start_header_id|>user<|end_header_id|>\n\n" + LLAMA31_TOOLS_USER
                                  + tools_json), _content(first), L("<|eot_id|>"))))
        rest = _rest(rest, 1)

    def piece(m):
        r, c = _role(m), _content(m)
        plain = F.concat(L("<|start_header_id|>"), r, L("<|end_header_id|>\n\n"), c, L("<|eot_id|>"))
        tool = F.concat(L("<|start_header_id|>ipython<|end_header_id|>\n\n"), _tojson_str(c), L("<|eot_id|>"))
        is_tool = r.isin("tool", "ipython")
        if not has_tool_calls:
            return F.when(is_tool, tool).otherwise(plain)
        tc = m["tool_calls"]
        name, arguments = F.get(tc, 0)["name"], F.get(tc, 0)["arguments"]
        body = F.concat(L('{"name": "'), name, L('", "parameters": '), arguments, L("}"))
        if builtin:
            # Built-in tools are called in code: name.call(argument="value", ...)
            values = F.map_entries(F.from_json(arguments, "map<string,string>"))
            code = F.concat(L("<|python_tag|>"), name, L(".call("),
                            F.array_join(F.transform(values, lambda e: F.concat(e["key"], L('="'), e["value"], L('"'))), ", "), L(")"))
            body = F.when(name.isin(*builtin), code).otherwise(body)
        end = L("<|eot_id|>" if builtin is None else "<|eom_id|>")
        call = F.when(F.size(tc) != 1, _raise("a message may hold one tool call only")) \
                .otherwise(F.concat(L("<|start_header_id|>assistant<|end_header_id|>\n\n"), body, end))
        return F.when(tc.isNotNull(), call).when(is_tool, tool).otherwise(plain)

    parts.append(_join(rest, piece))
    if ctx.gen:
        parts.append(L("<|start_header_id|>assistant<|end_header_id|>\n\n"))
    return _need_first(msgs, F.concat(*parts))


def body_qwen25(msgs, ctx, has_tool_calls: bool = False):
    m0 = F.get(msgs, 0)
    sys_first = _is_sys(m0)
    if ctx.tools:
        tools = "".join("\n" + json.dumps(t, ensure_ascii=False) for t in ctx.tools)
        head = F.concat(L("<|im_start|>system\n"),
                        F.when(sys_first, _content(m0)).otherwise(L(SYS_QWEN25)),
                        L(QWEN_TOOLS_HEAD + tools + QWEN_TOOLS_TAIL))
    else:
        head = F.when(sys_first, F.concat(L("<|im_start|>system\n"), _content(m0), L("<|im_end|>\n"))) \
                .otherwise(L("<|im_start|>system\n" + (ctx.system or "") + "<|im_end|>\n"))
    n = F.size(msgs)

    def piece(m, i):
        r, c = _role(m), _content(m)
        tc = m["tool_calls"] if has_tool_calls else None
        no_calls = L(True) if tc is None else (tc.isNull() | (F.size(tc) == 0))
        plain = F.concat(L("<|im_start|>"), r, L("\n"), c, L("<|im_end|>\n"))
        prev_tool = F.coalesce(_role(F.get(msgs, i - 1)) == "tool", L(False))
        next_tool = F.coalesce(_role(F.get(msgs, i + 1)) == "tool", L(False))
        tool = F.concat(F.when((i == 0) | ~prev_tool, L("<|im_start|>user")).otherwise(L("")),
                        L("\n<tool_response>\n"), c, L("\n</tool_response>"),
                        F.when((i == n - 1) | ~next_tool, L("<|im_end|>\n")).otherwise(L("")))
        out = F.when((r == "user") | ((r == "system") & (i > 0)) | ((r == "assistant") & no_calls), plain)
        if tc is not None:
            calls = F.array_join(F.transform(tc, lambda t: F.concat(
                L('\n<tool_call>\n{"name": "'), t["name"], L('", "arguments": '), t["arguments"],
                L("}\n</tool_call>"))), "")
            out = out.when(r == "assistant", F.concat(
                L("<|im_start|>assistant"),
                F.when(F.coalesce(c, L("")) != "", F.concat(L("\n"), c)).otherwise(L("")),
                calls, L("<|im_end|>\n")))
        return out.when(r == "tool", tool)

    body = F.coalesce(F.array_join(F.transform(msgs, piece), ""), L(""))
    return _need_first(msgs, F.concat(head, body, L("<|im_start|>assistant\n" if ctx.gen else "")))


@dataclass(frozen=True)
class Template:
    body: Callable
    default_system: str | None
    tool_aware: bool = False


_BODIES = {
    "unsloth": Template(body_unsloth, SYS_UNSLOTH),
    "zephyr": Template(body_zephyr, None),
    "chatml": Template(body_chatml, None),
    "mistral": Template(body_mistral, None),
    "llama": Template(body_llama, None),
    "vicuna": Template(body_vicuna, SYS_VICUNA),
    "vicuna_old": Template(body_vicuna_old, SYS_VICUNA_OLD),
    "alpaca": Template(body_alpaca, SYS_ALPACA),
    "gemma": Template(body_gemma, None),
    "gemma_chatml": Template(body_gemma_chatml, None),
    "llama-3": Template(body_llama3, None),
    "phi-3": Template(body_phi3, None),
    "llama-3.1": Template(body_llama31, "", tool_aware=True),
    "qwen-2.5": Template(body_qwen25, SYS_QWEN25, tool_aware=True),
    "phi-4": Template(body_phi4, None),
}

# Template names and the body each one selects.
TEMPLATE_NAMES = {
    "unsloth": "unsloth", "zephyr": "zephyr", "chatml": "chatml", "mistral": "mistral",
    "llama": "llama", "vicuna": "vicuna", "vicuna_old": "vicuna_old", "vicuna old": "vicuna_old",
    "alpaca": "alpaca", "gemma": "gemma", "gemma2": "gemma", "gemma_chatml": "gemma_chatml",
    "gemma2_chatml": "gemma_chatml", "llama-3": "llama-3", "llama3": "llama-3",
    "phi-3": "phi-3", "phi-35": "phi-3", "phi-3.5": "phi-3",
    "llama-3.1": "llama-3.1", "llama-31": "llama-3.1", "llama-3.2": "llama-3.1",
    "llama-3.3": "llama-3.1", "llama-32": "llama-3.1", "llama-33": "llama-3.1",
    "qwen-2.5": "qwen-2.5", "qwen-25": "qwen-2.5", "qwen25": "qwen-2.5", "qwen2.5": "qwen-2.5",
    "phi-4": "phi-4",
}


def resolve_system_message(name: str, system_message: str | None) -> str | None:
    """V7: a template without a default ignores an override (the reference
    only warns); otherwise the override wins over the default."""
    tpl = _BODIES[TEMPLATE_NAMES[name]]
    if tpl.default_system is None:
        if system_message is not None:
            warnings.warn(f"template {name!r} has no default system message; the override is ignored "
                          "(put the system message into the data instead)", stacklevel=3)
        return None
    return system_message if system_message is not None else tpl.default_system


def render(messages: Column | str, name: str, *, bos_token: str = "<s>", eos_token: str = "</s>",
           add_generation_prompt: bool = False, system_message: str | None = None,
           tools: list | None = None, date_string: str = LLAMA31_DATE,
           tools_in_user_message: bool = True, builtin_tools: list | None = None, messages_type=None) -> Column:
    """Render a conversation Column with a named template.
    ``builtin_tools`` (names, llama-3.1) are called in code form and end
    tool-call messages with ``<|eom_id|>``."""
    if name not in TEMPLATE_NAMES:
        raise KeyError(f"unknown chat template {name!r}; known: {sorted(TEMPLATE_NAMES)}")
    key = TEMPLATE_NAMES[name]
    tpl = _BODIES[key]
    msgs = F.col(messages) if isinstance(messages, str) else messages
    ctx = Ctx(bos=bos_token, eos=eos_token, system=resolve_system_message(name, system_message),
              gen=add_generation_prompt, tools=tools, date_string=date_string,
              tools_in_user_message=tools_in_user_message, builtin_tools=builtin_tools)
    if tpl.tool_aware:
        return tpl.body(msgs, ctx, has_tool_calls=_has_field(messages_type, "tool_calls"))
    return tpl.body(msgs, ctx)


def render_df(df: DataFrame, messages: str, name: str, out: str = "text", **kw) -> DataFrame:
    return df.withColumn(out, render(messages, name, messages_type=df.schema[messages].dataType, **kw))


# ---------------------------------------------------------------- V9 / V10 / V11 / F9

# The default parts of the part-based template (a llama-3 style
# system / input / output triple) and its default system text.
V9_SYSTEM_PART = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{SYSTEM}<|eot_id|>"
V9_INPUT_PART = "<|start_header_id|>user<|end_header_id|>\n\n{INPUT}<|eot_id|>"
V9_OUTPUT_PART = "<|start_header_id|>assistant<|end_header_id|>\n\n{OUTPUT}<|eot_id|>"
V9_DEFAULT_SYSTEM = SYS_ALPACA


def _fill(part: str, placeholder: str, c: Column) -> Column:
    pieces = part.split(placeholder)
    out = [L(pieces[0])]
    for p in pieces[1:]:
        out += [c, L(p)]
    return F.concat(*out)


def render_parts(messages: Column | str, system_part: str = V9_SYSTEM_PART,
                 input_part: str = V9_INPUT_PART, output_part: str = V9_OUTPUT_PART,
                 default_system_message: str | None = V9_DEFAULT_SYSTEM,
                 eos_token: str | None = None, bos_token: str | None = None,
                 add_generation_prompt: bool = False) -> Column:
    """V9: render with caller-given system / input / output parts.

    ``bos_token`` comes first exactly once, whether or not the system part
    holds it. ``add_generation_prompt`` ends with the output part up to its
    placeholder.

    A first system message fills ``{SYSTEM}``; otherwise the default is used.
    Other roles than user / assistant raise. When ``eos_token`` is given and
    the output part does not contain it, it is appended (as the reference
    does when no end token follows ``{OUTPUT}``). Unlike the reference, a part
    that starts with its placeholder is substituted normally.
    """
    msgs = F.col(messages) if isinstance(messages, str) else messages
    tail = [L(output_part.partition("{OUTPUT}")[0])] if add_generation_prompt else []
    if eos_token and eos_token not in output_part:
        output_part = output_part + eos_token
    lead = [L(bos_token)] if bos_token else []
    if bos_token:
        system_part = system_part.replace(bos_token, "", 1)
    body_of = lambda arr: _join(arr, lambda m: _ua(m, _fill(input_part, "{INPUT}", _content(m)),
                                                   _fill(output_part, "{OUTPUT}", _content(m))))
    if not system_part:
        return F.concat(*lead, body_of(msgs), *tail)
    if "{SYSTEM}" in system_part and default_system_message is None:
        raise ValueError("a default system message is needed for a {SYSTEM} part")
    m0 = F.get(msgs, 0)
    default_head = system_part.replace("{SYSTEM}", default_system_message or "")
    head = F.when(_is_sys(m0), _fill(system_part, "{SYSTEM}", _content(m0))).otherwise(L(default_head))
    loop = F.when(_is_sys(m0), _rest(msgs, 1)).otherwise(msgs)
    return _need_first(msgs, F.concat(*lead, head, body_of(loop), *tail))


def render_trainer_v2(messages: Column | str) -> Column:
    """The fixed inline template of the v2 trainer: the default system
    block always, user / assistant turns, every other role skipped, no
    newline after the headers."""
    msgs = F.col(messages) if isinstance(messages, str) else messages
    head = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>" + V10_SYSTEM + "<|eot_id|>"

    def piece(m):
        r = _role(m)
        return F.when(r.isin("user", "assistant"),
                      F.concat(L("<|start_header_id|>"), r, L("<|end_header_id|>"), _content(m), L("<|eot_id|>")))
    return F.concat(L(head), _join(msgs, piece))


def render_plain(messages: Column | str) -> Column:
    """``System:/User:/Assistant: content`` one line per message; other
    roles dropped."""
    msgs = F.col(messages) if isinstance(messages, str) else messages

    def piece(m):
        r = _role(m)
        label = F.when(r == "system", L("System: ")).when(r == "user", L("User: ")) \
                 .when(r == "assistant", L("Assistant: "))
        return F.when(label.isNotNull(), F.concat(label, _content(m), L("\n")))
    return _join(msgs, piece)


def remove_bos(text: Column | str, bos_token: str) -> Column:
    """strip one leading begin-of-sequence token."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.startswith(L(bos_token)), F.substring(t, len(bos_token) + 1, 1 << 30)).otherwise(t)


# ---------------------------------------------------------------- long form

def conversations_from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                             role: str = "role", content: str = "text") -> DataFrame:
    """Long ``(conv, turn, role, text)`` rows to one row per conversation with
    an ordered ``messages`` array: one shuffle by conversation, with partial
    (map-side) collection; each group is one conversation."""
    packed = turns.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                                             F.col(content).alias("content")))).alias("_m"))
    return packed.select(conv, F.transform("_m", lambda x: F.struct(x["role"].alias("role"),
                                                                    x["content"].alias("content"))
                                           ).alias("messages"))
