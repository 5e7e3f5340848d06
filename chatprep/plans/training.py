"""End-to-end plans: chat JSONL / turns -> validated, rendered, encoded, fixed-length examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ensure_eos
from ..operators.messages import PLAIN_TEMPLATE, fold_messages, render_chat
from ..operators.tokens import (
    DEFAULT_MAX_LENGTH,
    EOS_TOKEN,
    PAD_ID,
    build_vocabulary,
    causal_labels,
    encode_tokens,
    truncate_and_pad,
)
from ..operators.ranking import checked_broadcast, running_sums
from ..session import checkpoint_dir
from ..operators.validate import drop_invalid_examples

# White space of the tokenizer's pattern: no token reaches over it.
_WS = r"\x{9}-\x{D} "


def _piece(template: dict) -> Column:
    """A message as the template renders it; NULL for an unknown role or NULL content."""
    out = F.lit(None).cast("string")
    for role, (prefix, suffix) in template["roles"].items():
        out = F.when(F.col("role") == role, F.concat(F.lit(prefix), F.col("text"), F.lit(suffix))).otherwise(out)
    return out


def fold_for_examples(turns: DataFrame, max_length: int, template: dict | None = None) -> DataFrame:
    """``fold_messages`` for training examples, with long conversations cut *before* the fold.

    Exact: of a conversation with more than ``max_length + 1`` messages, every message adds the runs of non-space
    characters that begin after white space of its own, and those that end before it; sums of both are
    carried along the conversation. Where one exceeds ``max_length``, so many tokens are complete, so the
    conversation is cut after that message, and messages that render to nothing are left out; of a longer
    message only the first ``max_length + 1`` runs stay. The cut text then begins with the same ``max_length`` tokens,
    whatever the template and the roles. So what a task folds is bounded by tokens, except for a single run
    that goes on over many messages without white space, which is one value of the output in any case. A
    conversation with an unknown role or NULL content keeps its first bad message, so it still renders NULL.
    The cut table lists long conversations only and is measured before it is broadcast; the sums are carried
    by range partition, so no long conversation is gathered."""
    template = template or PLAIN_TEMPLATE
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    long_ids = checked_broadcast(sizes.filter(F.col("_n") > max_length + 1).select("conv_id"))
    if long_ids.isEmpty():  # nothing to cut: the plain fold is already bounded by max_length + 1 messages
        return fold_messages(_shortened(turns, max_length))
    piece = F.col("_piece")
    lt = turns.select("conv_id", "turn", _piece(template).alias("_piece")).join(long_ids, "conv_id", "left_semi")
    lt = lt.select("conv_id", "turn", piece.isNull().alias("_bad"), (piece == "").alias("_empty"),
                   F.regexp_count(piece, F.lit(f"[{_WS}][^{_WS}]")).alias("_s"), F.regexp_count(piece, F.lit(f"[^{_WS}][{_WS}]")).alias("_e"))
    lt = running_sums(lt, ["conv_id"], "turn", {"_starts": "_s", "_ends": "_e"})
    full = (F.col("_starts") > max_length) | (F.col("_ends") > max_length)
    cut = checked_broadcast(lt.groupBy("conv_id").agg(
        F.min("turn").alias("_first"), F.min(F.when(full, F.col("turn"))).alias("_cut"), F.min(F.when(F.col("_bad"), F.col("turn"))).alias("_bad_turn")))
    t = F.col("turn")
    within = (F.col("_cut").isNull() | (t <= F.col("_cut"))) & (F.col("_first").isNull() | (t == F.col("_first")) | F.coalesce(_piece(template) != "", F.lit(True)))
    kept = turns.join(cut, "conv_id", "left").filter(within | (t == F.col("_bad_turn"))).drop("_first", "_cut", "_bad_turn")
    return fold_messages(_shortened(kept, max_length))


def _shortened(turns: DataFrame, max_length: int) -> DataFrame:
    """Messages of more than ``max_length + 1`` runs of non-space characters end after so many."""
    t, n = F.col("text"), max_length + 1
    many = (F.length(t) > 2 * n) & (F.regexp_count(t, F.lit(f"[^{_WS}]+")) > n)
    return turns.withColumn("text", F.when(many, F.regexp_extract(t, f"^(?:[{_WS}]*+[^{_WS}]++){{{n}}}", 0)).otherwise(t))


def tokens_apart(turns: DataFrame, template: dict | None = None) -> DataFrame:
    """``(conv_id, turn, text)``: texts that together hold the tokens of all rendered conversations, in rows of one
    message each, so that tokens can be counted without folding a conversation.

    Where every message after the first begins with white space, the rendered messages are those texts. In other
    conversations, the run of non-space characters at the edge of one message goes on in the next one: there
    the inner part of a message is a row, and the edges are glued; which edges belong together follows from
    two counts carried along the conversation (breaks before an edge and after it), so only the pieces of one
    run ever meet. Conversations that the template cannot render are left out."""
    template = template or PLAIN_TEMPLATE
    x = turns.select("conv_id", "turn", _piece(template).alias("text"))
    open_start = F.col("text").rlike(f"^[^{_WS}]")
    seen = x.groupBy("conv_id").agg(F.max(F.col("text").isNull()).alias("_bad"), F.min(F.when(F.col("text") != "", F.col("turn"))).alias("_first"),
                                    F.max(F.when(open_start, F.col("turn"))).alias("_open"))
    odd = checked_broadcast(seen.filter(F.col("_bad") | (F.col("_open") > F.col("_first"))).select("conv_id", "_bad"))
    plain = x.join(odd, "conv_id", "left_anti")
    glued = x.join(odd.filter(~F.col("_bad")).drop("_bad"), "conv_id", "left_semi").filter("text <> ''")
    if odd.filter(~F.col("_bad")).isEmpty():
        return plain
    head, tail = F.regexp_extract("text", f"^[^{_WS}]+", 0), F.regexp_extract("text", f"[^{_WS}]+\\z", 0)
    solid = ~F.col("text").rlike(f"[{_WS}]")
    first = F.struct(F.lit(0).alias("side"), head.alias("run"), (head == "").alias("before"), (~solid).alias("after"))
    last = F.struct(F.lit(1).alias("side"), tail.alias("run"), F.lit(True).alias("before"), (tail == "").alias("after"))
    edges = glued.select("conv_id", "turn", F.inline(F.when(solid, F.array(first)).otherwise(F.array(first, last))))
    edges = edges.withColumn("place", F.struct("turn", "side"))
    edges = running_sums(edges, ["conv_id"], "place", {"_b": F.col("before").cast("long"), "_a": F.col("after").cast("long")})
    chain = edges.withColumn("_chain", F.col("_b") + F.col("_a") - F.col("after").cast("long")).filter("run <> ''")
    runs = chain.groupBy("conv_id", "_chain").agg(F.array_sort(F.collect_list(F.struct("turn", "side", "run"))).alias("l"))
    runs = runs.select("conv_id", F.col("l")[0]["turn"].alias("turn"), F.array_join(F.transform("l", lambda e: e["run"]), "").alias("text"))
    inner = F.expr("substring(text, length(h) + 1, length(text) - length(h) - length(t))")
    inside = glued.filter(~solid).select("conv_id", "turn", "text", head.alias("h"), tail.alias("t")).select("conv_id", "turn", inner.alias("text"))
    return plain.unionByName(inside).unionByName(runs)


def rendered_texts(convs: DataFrame, id_col: str = "conv_id", template: dict | None = None,
                   eos: str = EOS_TOKEN) -> DataFrame:
    """``(example_id, text)``: each conversation through the chat template, EOS ensured at the end
    (a conversation the template cannot render stays NULL)."""
    rendered = convs.select(F.col(id_col).alias("example_id"), render_chat("messages", template or PLAIN_TEMPLATE).alias("_r"))
    # separate projection: the rendered text is computed once, not once per CASE branch
    return rendered.select("example_id", ensure_eos("_r", eos).alias("text"))


def examples_from_texts(texts: DataFrame, vocab: DataFrame | None = None, max_length: int = DEFAULT_MAX_LENGTH,
                        max_vocab: int | None = None, pad_id: int = PAD_ID,
                        id_col: str | list[str] = "example_id") -> DataFrame:
    """Encode, cut/pad to ``max_length``, add labels, drop examples without tokens.

    Without a vocabulary, one is built from all tokens of the texts that could be rendered, wherever they stand,
    so ids do not depend on ``max_length``, and no token is unknown unless ``max_vocab`` asks for a top-k. The texts
    are then pinned, since they are read twice."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if vocab is None:
        checkpoint_dir(texts.sparkSession)
        texts = texts.checkpoint(eager=True)
        vocab = build_vocabulary(texts.filter(F.col("text").isNotNull()), "text", max_vocab)
    encoded = encode_tokens(texts, vocab, ids, "text", max_length=max_length)
    ex = causal_labels(truncate_and_pad(encoded, "token_ids", max_length, pad_id))
    return drop_invalid_examples(ex).select(
        *ids, F.size("token_ids").alias("n_tokens"), "input_ids", "attention_mask", "labels")


def training_examples(turns: DataFrame, vocab: DataFrame | None = None, max_length: int = DEFAULT_MAX_LENGTH,
                      max_vocab: int | None = None, template: dict | None = None) -> DataFrame:
    """Turns ``(conv_id, turn, role, text)`` -> ``(example_id, n_tokens, input_ids,
    attention_mask, labels)``: fold (long conversations cut first) -> render -> EOS -> encode ->
    pad -> labels -> drop empty. Without a vocabulary, one is built from every token of the rendered
    conversations, counted message by message (``tokens_apart``), so a conversation of any length is counted by
    many tasks and none is gathered."""
    if vocab is None:
        vocab = build_vocabulary(tokens_apart(turns, template), "text", max_vocab)
    texts = rendered_texts(fold_for_examples(turns, max_length, template), "conv_id", template)
    return examples_from_texts(texts, vocab, max_length)


def training_examples_from_lines(lines: DataFrame, vocab: DataFrame | None = None,
                                 max_length: int = DEFAULT_MAX_LENGTH, max_vocab: int | None = None,
                                 template: dict | None = None) -> DataFrame:
    """Validated JSONL lines ``(file, line_no, line)`` -> examples keyed by ``(file, line_no)``."""
    from ..sources.jsonl import parse_chat_lines

    rendered = parse_chat_lines(lines).select("file", "line_no", render_chat("messages", template or PLAIN_TEMPLATE).alias("_r"))
    texts = rendered.select("file", "line_no", ensure_eos("_r", EOS_TOKEN).alias("text"))
    return examples_from_texts(texts, vocab, max_length, max_vocab, id_col=["file", "line_no"])
