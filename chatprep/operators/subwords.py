"""Sub-word vocabulary: byte-pair merges learned from a corpus, encoding and decoding with them.

A text is cut into *pieces* that together are the whole text: a special token, a space with up to ``PIECE_CHARS``
other characters behind it (the space may be missing), or a single white-space character or ``<``. A
piece is the list of its UTF-8 bytes, and merges join neighbouring symbols, so the vocabulary is bounded (special
tokens, 256 bytes, the merges), nothing is unknown and decoding gives the text back byte for byte.

Symbols are written in hexadecimal, a list of them as ``<74><68>``: a merge is then one string replacement, which
goes through a piece from left to right, and stays in generated code. The corpus is read once, to count distinct
pieces; after that every round reads distinct pieces and pair counts only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .ranking import checked_broadcast
from .tokens import SPECIAL_TOKENS

# --- fixed values ----------------------------------------------------------------------------
PIECE_CHARS = 64
PIECE_PATTERN = "|".join(SPECIAL_TOKENS) + r"| ?[^<\x{9}-\x{D} ]{1,64}|[<\x{9}-\x{D} ]"
FIRST_BYTE_ID = len(SPECIAL_TOKENS)      # bytes follow the special tokens
FIRST_MERGE_ID = FIRST_BYTE_ID + 256
MERGES_SCHEMA = "rank int, left string, right string, n long"
# ---------------------------------------------------------------------------------------------
BATCH = 64             # merges applied in one round, at most
STORE_EVERY = 8        # rounds between two written tables of pieces


def pieces(c) -> Column:
    """Array of the pieces of a text column; joined, they are the text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(PIECE_PATTERN), 0)


def byte_symbols(c) -> Column:
    """A piece as its bytes: ``<74><68><65>``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-8"))), "(..)", "<$1>")


def learn_merges(texts: DataFrame, text_col: str = "text", n_merges: int = 1000, min_count: int = 2) -> DataFrame:
    """``(rank, left, right, n)``: the first ``n_merges`` byte-pair merges of the corpus (symbols in hexadecimal,
    ``n`` the pair's count when it was merged), fewer if no pair is left that occurs ``min_count`` times.

    The order is the sequential one: always the pair with the highest count, of equal ones the shorter in bytes,
    then by its symbols. A round takes as many of the leading pairs as cannot change one another's counts
    (``independent_prefix``), so a round is a batch and the result is that of one merge at a time. Pair counts are
    kept as a table and corrected by the pieces that a batch changed. The driver sees at most ``BATCH`` pairs a round and
    the merges. NULL and empty texts hold no piece; a table without pairs gives no merges."""
    spark = texts.sparkSession
    store = _Store(spark)
    counted = texts.select(F.explode(pieces(text_col)).alias("piece")).filter(~F.col("piece").isin(*SPECIAL_TOKENS))
    counted = counted.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter(F.octet_length("piece") > 1)
    words = store.put("pieces", counted.select(byte_symbols("piece").alias("seq"), "n"))
    pairs = store.put("pairs", _pair_counts(words))
    learned: list[tuple] = []
    known: set[str] = set()
    rounds = 0
    while len(learned) < n_merges:
        top = pairs.filter(F.col("n") >= min_count).orderBy(
            F.desc("n"), F.length("left") + F.length("right"), "left", "right").limit(min(BATCH, n_merges - len(learned))).collect()
        batch = independent_prefix([(r["left"], r["right"]) for r in top], known)
        if not batch:
            break
        learned += [(len(learned) + i, r["left"], r["right"], r["n"]) for i, r in enumerate(top[:len(batch)])]
        if len(learned) >= n_merges:
            break
        known |= {left + right for left, right in batch}
        merged = words.select("seq", _merged(F.col("seq"), batch).alias("new"), "n")
        minus, plus = F.struct("seq", (-F.col("n")).alias("n")), F.struct(F.col("new").alias("seq"), "n")
        moved = _pair_counts(merged.filter("new <> seq").select(F.inline(F.array(minus, plus))))
        pairs = store.put("pairs", pairs.unionByName(moved).groupBy("left", "right").agg(F.sum("n").alias("n")).filter("n > 0"))
        words = merged.select(F.col("new").alias("seq"), "n")
        rounds += 1
        if rounds % STORE_EVERY == 0:  # a piece of one symbol has no pairs any more
            words = store.put("pieces", words.filter(F.instr("seq", "><") > 0))
    store.drop()
    return spark.createDataFrame(learned, MERGES_SCHEMA)


def independent_prefix(pairs: list[tuple[str, str]], known: set[str]) -> list[tuple[str, str]]:
    """The longest head of ``pairs`` (highest count first) that merging one by one would take in the same order.

    Merging (a, b) lowers counts only of pairs that end in a or begin with b, so the head ends before the first such
    pair. A new pair (x, ab) occurs at most as often as (x, a) did and is longer, so it comes after it, and (x, a) is
    such a pair itself. Two cases end the head after their merge: (a, a), which can leave (aa, aa) above the next pair,
    and a merge whose symbol another merge has made before, whose pairs already have counts."""
    firsts: set[str] = set()
    seconds: set[str] = set()
    made: set[str] = set()
    out = []
    for left, right in pairs:
        if right in firsts or left in seconds:
            break
        out.append((left, right))
        firsts.add(left)
        seconds.add(right)
        if left == right or left + right in known or left + right in made:
            break
        made.add(left + right)
    return out


def subword_vocabulary(merges: DataFrame) -> DataFrame:
    """``(token_id, token, bytes)``: the special tokens (ids 0-3), the 256 bytes, then each merged symbol in rank
    order (``token`` in hexadecimal but for special tokens; a symbol that two merges make has the id of the first)."""
    rows = [(i, t, bytearray(t.encode())) for i, t in enumerate(SPECIAL_TOKENS)]
    rows += [(FIRST_BYTE_ID + b, f"{b:02x}", bytearray([b])) for b in range(256)]
    rows += [(i, s, bytearray.fromhex(s)) for s, i in _merge_ids(_merge_list(merges)).items()]
    return merges.sparkSession.createDataFrame(rows, "token_id int, token string, bytes binary")


def encode_subwords(texts: DataFrame, merges: DataFrame, id_col: str | list[str] = "example_id", text_col: str = "text",
                    max_length: int | None = None, out: str = "token_ids") -> DataFrame:
    """``(id columns, out)``: the sub-word ids of each text, merges applied in rank order, cut to ``max_length`` ids.

    Each distinct piece is encoded once (Arrow batches; the merges go along as a table of ``n_merges`` entries), and
    the ids are joined back to the pieces of the texts (broadcast when measured small). Texts are dealt by their key
    before they are cut into pieces, so the regroup moves nothing. A text is known by its id columns and its hash: rows
    that repeat both give one row. A NULL text gives NULL, an empty one an empty list."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    cut = pieces(text_col)
    if max_length is not None:
        cut = F.slice(cut, 1, max_length)  # a piece has at least one id
    key = [*ids, "_h"]
    keyed = texts.select(*ids, F.xxhash64(text_col).alias("_h"), F.col(text_col).isNull().alias("_null"), cut.alias("_p"))
    exploded = keyed.repartition(*key).select(*key, "_null", F.posexplode_outer("_p").alias("_pos", "piece"))
    distinct = texts.select(F.explode(cut).alias("piece")).distinct()
    joined = exploded.join(checked_broadcast(encode_pieces(distinct, merges)), "piece", "left")
    item = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "ids"))
    grouped = joined.groupBy(*key).agg(F.max("_null").alias("_null"), F.array_sort(F.collect_set(item)).alias("_l"))
    flat = F.flatten(F.transform("_l", lambda x: x["ids"]))
    flat = flat if max_length is None else F.slice(flat, 1, max_length)
    return grouped.select(*ids, F.when(F.col("_null"), F.lit(None)).otherwise(flat).alias(out))


def encode_pieces(distinct: DataFrame, merges: DataFrame) -> DataFrame:
    """``(piece, ids)`` of a column ``piece``."""
    listed = _merge_list(merges)
    ranks = {pair: i for i, pair in enumerate(listed)}
    ids = _merge_ids(listed) | {f"{b:02x}": FIRST_BYTE_ID + b for b in range(256)}
    special = {t: [i] for i, t in enumerate(SPECIAL_TOKENS)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = [special.get(p) or [ids[s] for s in merge_symbols([f"{b:02x}" for b in p.encode()], ranks)] for p in batch["piece"]]
            yield pd.DataFrame({"piece": batch["piece"], "ids": coded})

    return distinct.select("piece").mapInPandas(run, "piece string, ids array<int>")


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols of a piece after all merges, applied in rank order, each from left to right."""
    done = -1
    while True:
        later = [r for r in map(ranks.get, zip(symbols, symbols[1:])) if r is not None and r > done]
        if not later:
            return symbols
        done, out, i = min(later), [], 0
        while i < len(symbols):
            joins = i + 1 < len(symbols) and ranks.get((symbols[i], symbols[i + 1])) == done
            out.append(symbols[i] + symbols[i + 1] if joins else symbols[i])
            i += 2 if joins else 1
        symbols = out


def decode_subwords(encoded: DataFrame, merges: DataFrame, id_col: str | list[str] = "example_id",
                    ids: str = "token_ids", out: str = "text") -> DataFrame:
    """``(id columns, out)``: the text of each list of ids (special tokens as their text, bytes that are no valid UTF-8 as
    U+FFFD, as at a cut; an id outside the vocabulary gives nothing). Arrow batches with the vocabulary beside them,
    no shuffle. NULL stays NULL, an empty list gives an empty text."""
    known = {r["token_id"]: bytes(r["bytes"]) for r in subword_vocabulary(merges).collect()}  # 260 and one per merge
    keys = [id_col] if isinstance(id_col, str) else list(id_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [None if row is None else b"".join(known.get(i, b"") for i in row).decode("utf-8", "replace") for row in batch["_ids"]]
            yield batch[keys].assign(**{out: texts})

    schema = T.StructType([encoded.schema[k] for k in keys] + [T.StructField(out, T.StringType())])
    return encoded.select(*keys, F.col(ids).alias("_ids")).mapInPandas(run, schema)


def _merged(seq: Column, batch: list[tuple[str, str]]) -> Column:
    for left, right in batch:
        seq = F.replace(seq, F.lit(f"<{left}><{right}>"), F.lit(f"<{left}{right}>"))
    return seq


def _pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)`` over neighbouring symbols of ``(seq, n)``."""
    cut = words.select("n", F.split(F.expr("substring(seq, 2, length(seq) - 2)"), "><").alias("_s"))
    each = cut.select("n", F.inline(F.arrays_zip(F.expr("slice(_s, 1, size(_s) - 1)").alias("left"), F.expr("slice(_s, 2, size(_s) - 1)").alias("right"))))
    return each.toDF("n", "left", "right").groupBy("left", "right").agg(F.sum("n").alias("n"))


def _merge_list(merges: DataFrame) -> list[tuple[str, str]]:
    """The merges in rank order: as many rows as were asked for in ``learn_merges``."""
    return [(r["left"], r["right"]) for r in merges.orderBy("rank").collect()]


def _merge_ids(listed: list[tuple[str, str]]) -> dict[str, int]:
    symbols = dict.fromkeys(left + right for left, right in listed)
    return {s: FIRST_MERGE_ID + i for i, s in enumerate(symbols)}


class _Store:
    """Written tables of the learning rounds; a kind's table is deleted when the next one stands."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/tables/merges-{uuid.uuid4().hex}"
        self.last: dict[str, str] = {}

    def put(self, kind: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{kind}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if kind in self.last:
            self._delete(self.last[kind])
        self.last[kind] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
