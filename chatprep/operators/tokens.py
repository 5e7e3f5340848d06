"""Vocabulary, encoding, fixed-length padding and labels.

The tokenizer is a vocabulary table, not a model: a text is cut into tokens by one regular
expression (a ``<...>`` tag without white space, a run of other non-space characters, or a lone
``<``), each token is looked up in the vocabulary (unknown -> ``<unk>``). A real sub-word
tokenizer can be plugged in through ``operators.udf.map_examples`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import checked_broadcast, global_row_number

# --- fixed values ----------------------------------------------------------------------------
SPECIAL_TOKENS = ["<pad>", "<unk>", "<bos>", "<eos>"]  # ids 0, 1, 2, 3
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
EOS_TOKEN = "<eos>"
DEFAULT_MAX_LENGTH = 512
TOKEN_PATTERN = r"<[^<>\x{9}-\x{D} ]+>|[^<\x{9}-\x{D} ]+|<"
# ---------------------------------------------------------------------------------------------


def tokenize(c) -> Column:
    """Array of token strings of a text column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), 0)


def build_vocabulary(texts: DataFrame, text_col: str = "text", max_size: int | None = None,
                     max_length: int | None = None) -> DataFrame:
    """``(token, token_id)``: the special tokens (ids 0-3) and every token of the corpus, by count
    descending then token, numbered from 4.

    ``max_length`` counts the first so many tokens of each text (those that examples of that length
    hold); ``max_size`` keeps the most frequent tokens only. Both are off unless asked for. Counts are
    partial (map-side) aggregates, the numbering is by range partitions: no task sees the vocabulary."""
    spark = texts.sparkSession
    toks = tokenize(text_col)
    if max_length is not None:
        toks = F.slice(toks, 1, max_length)
    counts = (
        texts.select(F.explode(toks).alias("token"))
        .filter(~F.col("token").isin(*SPECIAL_TOKENS))
        .groupBy("token").agg((-F.count(F.lit(1))).alias("_neg"))
    )
    if max_size is not None:
        counts = counts.orderBy("_neg", "token").limit(max_size)
    numbered = global_row_number(counts, ["_neg", "token"], out="_rn")
    numbered = numbered.select("token", (F.col("_rn") + len(SPECIAL_TOKENS)).cast("int").alias("token_id"))
    return special_vocabulary(spark).unionByName(numbered)


def special_vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(SPECIAL_TOKENS)], "token string, token_id int")


def encode_tokens(texts: DataFrame, vocab: DataFrame, id_col: str | list[str] = "example_id", text_col: str = "text",
                  max_length: int | None = None, unk_id: int = UNK_ID, out: str = "token_ids") -> DataFrame:
    """``(id columns, out)``: token ids of each text, cut to ``max_length`` tokens *before* the lookup.

    The lookup is an explode + join with the vocabulary (broadcast when its measured rows and bytes are
    small) and a regroup of at most ``max_length`` ids per text. A text is known by its id columns and
    its hash, so different texts with one id stay apart; rows that repeat both give one row. The rows
    are dealt by that key before they are exploded, so the regroup moves nothing. A NULL text gives
    NULL, a text without tokens an empty list."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    toks = tokenize(text_col)
    if max_length is not None:
        toks = F.slice(toks, 1, max_length)
    key = [*ids, "_h"]
    keyed = texts.select(*ids, F.xxhash64(text_col).alias("_h"), F.col(text_col).isNull().alias("_null"), toks.alias("_t"))
    exploded = keyed.repartition(*key).select(*key, "_null", F.posexplode_outer("_t").alias("_pos", "token"))
    joined = exploded.join(checked_broadcast(vocab.select("token", "token_id")), "token", "left")
    item = F.when(F.col("_pos").isNotNull(), F.struct(F.col("_pos"), F.coalesce("token_id", F.lit(unk_id)).alias("i")))
    grouped = joined.groupBy(*key).agg(F.max("_null").alias("_null"), F.array_sort(F.collect_set(item)).alias("_ids"))
    return grouped.select(
        *ids, F.when(F.col("_null"), F.lit(None)).otherwise(F.transform("_ids", lambda x: x["i"])).alias(out))


def truncate_and_pad(df: DataFrame, ids: str = "token_ids", max_length: int = DEFAULT_MAX_LENGTH,
                     pad_id: int = PAD_ID) -> DataFrame:
    """``input_ids`` of exactly ``max_length`` (cut, then padded on the right) and the matching
    ``attention_mask`` (1 for real tokens, 0 for padding)."""
    n = F.size(ids)
    fill = F.greatest(F.lit(0), F.lit(max_length) - n)
    real = F.least(n, F.lit(max_length))
    padded = F.slice(F.concat(F.col(ids), F.array_repeat(F.lit(pad_id), fill)), 1, max_length)
    mask = F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), fill))
    return (
        df.withColumn("input_ids", F.when(F.col(ids).isNull(), F.lit(None)).otherwise(padded))
        .withColumn("attention_mask", F.when(F.col(ids).isNull(), F.lit(None)).otherwise(mask))
    )


def causal_labels(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Causal LM labels: a copy of ``input_ids`` (padding included)."""
    return df.withColumn("labels", F.col(ids))


def resolve_special_ids(vocab: DataFrame, candidates: list[str] | None = None, eos_token: str = EOS_TOKEN,
                        unk_id: int = UNK_ID, pad_token: str | None = "<pad>") -> DataFrame:
    """One row: ``eos_ids`` (the own EOS first if the vocabulary has it, then every candidate EOS string
    present and not mapped to unk, without repeats, in candidate order) and ``pad_id`` (the pad
    token's id, else the own EOS id, else NULL)."""
    from ..functions.text import EOS_CANDIDATES

    spark = vocab.sparkSession
    cands = [eos_token] + list(candidates if candidates is not None else EOS_CANDIDATES)
    rows = [("eos", i, t) for i, t in enumerate(cands)] + ([("pad", 0, pad_token)] if pad_token else [])
    cand_df = spark.createDataFrame(rows, "kind string, pos int, token string")
    hits = F.broadcast(cand_df).join(vocab.select("token", "token_id"), "token", "inner")
    own = (F.col("kind") == "eos") & (F.col("pos") == 0)
    is_eos = (F.col("kind") == "eos") & (own | (F.col("token_id") != unk_id))
    # One aggregate over at most len(cands) + 1 rows; array_distinct keeps first occurrences.
    eos_ids = F.array_distinct(F.transform(
        F.array_sort(F.collect_list(F.when(is_eos, F.struct("pos", "token_id")))), lambda x: x["token_id"]))
    pad = F.min(F.when(F.col("kind") == "pad", F.col("token_id")))
    return hits.agg(eos_ids.alias("eos_ids"), pad.alias("_pad"), F.min(F.when(own, F.col("token_id"))).alias("_own")).select(
        "eos_ids", F.coalesce(F.col("_pad"), F.col("_own")).cast("int").alias("pad_id"))
