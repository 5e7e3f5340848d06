"""Conversations: folding turns into message lists, system prompts, chat-template rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------------------
# System prompt used when neither the requested prompt file nor default.txt exists.
FALLBACK_SYSTEM_PROMPT = "あなたは親切で知識豊富なAIアシスタントです。ユーザーの質問に丁寧に答えてください。"
DEFAULT_PROMPT_NAME = "default"
# Plain-text chat template: the system text as is, then "\n\nUser: ..." and "\n\nAssistant: ...";
# the generation prompt is "\n\nAssistant:".
PLAIN_TEMPLATE = {
    "roles": {
        "system": ("", ""),
        "user": ("\n\nUser: ", ""),
        "assistant": ("\n\nAssistant: ", ""),
    },
    "generation_prompt": "\n\nAssistant:",
}
# ChatML-style template.
CHATML_TEMPLATE = {
    "roles": {
        "system": ("<|im_start|>system\n", "<|im_end|>\n"),
        "user": ("<|im_start|>user\n", "<|im_end|>\n"),
        "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n"),
    },
    "generation_prompt": "<|im_start|>assistant\n",
}
# ---------------------------------------------------------------------------------------------


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    c = F.lit(content) if isinstance(content, str) else content
    return F.struct(r.cast("string").alias("role"), c.cast("string").alias("content"))


def fold_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """``(key, messages)``: each conversation's turns as an ordered list of {role, content}.

    One conversation becomes one row (one JSONL example); the list is sorted by ``order``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("r"), F.col(text).alias("c"))))
    return turns.groupBy(key).agg(
        F.transform(ordered, lambda x: F.struct(x["r"].alias("role"), x["c"].alias("content"))).alias("messages"))


def explode_messages(convs: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """``(key, pos, role, content)``: one row per message, ``pos`` counted from 0."""
    return convs.select(key, F.posexplode(messages).alias("pos", "m")).select(
        key, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def inject_system_prompt(convs: DataFrame, prompt, messages: str = "messages") -> DataFrame:
    """Start every conversation with the system prompt unless it already starts with a system message."""
    p = F.lit(prompt) if isinstance(prompt, str) else prompt
    m = F.col(messages)
    has = F.coalesce((F.size(m) > 0) & (m.getItem(0).getField("role") == "system"), F.lit(False))
    return convs.withColumn(messages, F.when(has, m).otherwise(F.concat(F.array(message("system", p)), m)))


def resolve_system_prompt(requests: DataFrame, catalog: DataFrame, name_col: str = "prompt_name",
                          out: str = "system_prompt", default_name: str = DEFAULT_PROMPT_NAME,
                          fallback: str = FALLBACK_SYSTEM_PROMPT) -> DataFrame:
    """The requested prompt if that prompt exists in the catalog (an existing empty prompt wins
    with ''), else the catalog's default prompt, else the built-in fallback.

    The catalog is a directory of prompt files; the default prompt is one value, read once."""
    default_rows = catalog.filter(F.col("name") == default_name).select("prompt").limit(1).collect()
    default_prompt = default_rows[0]["prompt"] if default_rows else None
    cat = catalog.select(F.col("name").alias("_pname"), F.col("prompt").alias("_custom"))
    joined = requests.join(cat, F.col(name_col) == F.col("_pname"), "left")
    return joined.withColumn(
        out, F.coalesce(F.col("_custom"), F.lit(default_prompt).cast("string"), F.lit(fallback))
    ).drop("_pname", "_custom")


def render_chat(messages: str | Column = "messages", template: dict | None = None,
                add_generation_prompt: bool = False) -> Column:
    """Render a message list to one string with a chat template given as data.

    A message whose role the template does not know, or whose content is NULL, makes the whole
    result NULL (the example is then dropped, like a template error)."""
    template = template or PLAIN_TEMPLATE
    m = F.col(messages) if isinstance(messages, str) else messages
    roles = template["roles"]
    prefix = F.create_map(*[x for r, (p, _) in roles.items() for x in (F.lit(r), F.lit(p))])
    suffix = F.create_map(*[x for r, (_, s) in roles.items() for x in (F.lit(r), F.lit(s))])
    known = list(roles)
    bad = F.exists(m, lambda x: x["role"].isNull() | ~x["role"].isin(*known) | x["content"].isNull())
    body = F.array_join(
        F.transform(m, lambda x: F.concat(F.element_at(prefix, x["role"]), x["content"], F.element_at(suffix, x["role"]))),
        "",
    )
    if add_generation_prompt:
        body = F.concat(body, F.lit(template.get("generation_prompt", "")))
    return F.when(m.isNull() | F.coalesce(bad, F.lit(True)), F.lit(None).cast("string")).otherwise(body)
