"""SimHash fingerprints and an exact search in Hamming distance, in DataFrame operations only.

* A term is a pair of neighbouring words; its weight grows with its letters, so pairs of short,
  common words count little. Each term's 64-bit hash votes with its weight on every bit, for 1 or
  for 0, and the fingerprint holds the majority of each bit.
* The votes are packed: bits k and k + 32 of a hash fall into the two halves of one long, so a row
  adds 32 longs. They are summed inside the task that reads the text, and only one row of sums per
  text and task is shuffled.
* Search: fingerprints within radius r differ in at most r of the b blocks, so they agree in some
  choice of b - r blocks. There is one table per choice, keyed by those bits; candidates from equal
  keys are checked exactly, and no match within the radius is missed.

Defined cases: null text counts as empty; a text without words has fingerprint 0; the last word of a
text also stands alone as a term, so one-word texts have a fingerprint; rows with equal id and text
count as one document in the order, and each gets that document's result; null ids come first in the
order; a single document is its own next document; an empty table gives an empty result. The sums hold
texts of up to about a billion characters. Only the id and the text column are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .shared import materialize

BITS = 64
SPACE = " \t\n\x0b\x0c\r"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
HEAVIEST = 12  # letters of a word beyond which its weight does not grow
LANE = 0x0000000100000001


def votes(texts: DataFrame, keys: list[str], body: str) -> DataFrame:
    """One row per ``keys``: 32 packed vote sums and the total weight of the terms of ``body``."""
    words = F.split(F.btrim(F.coalesce(F.col(body), F.lit("")), F.lit(SPACE)), WORD_BREAK, -1)
    listed = texts.select(*keys, words.alias("_w"))
    pairs = listed.select(*keys, F.explode(F.arrays_zip(
        F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.size("_w")).alias("b"))).alias("_t"))
    first, second = F.col("_t.a"), F.col("_t.b")
    # (least() skips nulls: the missing second word of the last term weighs nothing)
    weight = F.least(F.length(first), F.lit(HEAVIEST)) + F.least(F.length(F.coalesce(second, F.lit(""))), F.lit(HEAVIEST))
    terms = pairs.select(*keys, F.xxhash64(first, second).alias("_term"), weight.cast("long").alias("_n"))
    sums = [F.sum(F.shiftrightunsigned("_term", k).bitwiseAND(F.lit(LANE)) * F.col("_n")).alias(f"v{k}") for k in range(32)]
    return terms.groupBy(*keys).agg(F.sum("_n").alias("total"), *sums)


def majority() -> Column:
    """The fingerprint (a long) of a row of vote sums."""
    out = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{k}", 32)
        for bit, votes_for in ((k, low), (k + 32, high)):
            mask = (1 << bit) if bit < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(votes_for * 2 > F.col("total"), F.lit(mask)).otherwise(F.lit(0)).cast("long"))
    return out


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hexed(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))


def block_tables(radius: int, blocks: int) -> list[int]:
    """The bit masks of the tables: every choice of ``blocks - radius`` of the blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(blocks)]
    out = [sum(chosen) for chosen in combinations(masks, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def within_radius(queries: DataFrame, fingerprints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All (fingerprint, other, distance) with distance at most ``radius``. Both inputs are distinct
    longs in a column ``fingerprint``; equal ones match at distance 0. Pairs are those of different
    fingerprints, so any number of equal documents adds nothing."""
    masks = F.array(*[F.lit(m).cast("long") for m in block_tables(radius, blocks)])

    def tabled(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col("fingerprint").alias(name), F.posexplode(masks).alias("table", "mask"))
        return rows.select(name, "table", F.col(name).bitwiseAND(F.col("mask")).alias("key"))

    near = tabled(queries, "fingerprint").join(tabled(fingerprints, "other"), ["table", "key"])
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")))
    return near.filter(distance <= radius).select("fingerprint", "other", distance.alias("distance")).distinct()


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3, blocks: int = 6,
                          query_step: int = 20) -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near):
    one row per row of ``docs``. ``n_near`` counts the other documents within ``radius``, for the ids
    divisible by ``query_step`` (null for the rest); all documents are searched."""
    kind = docs.schema[key].dataType
    body = F.coalesce(F.col(text), F.lit(""))
    # A document is known by (id known, id or 0, hash of its text): never null, so every join and
    # every aggregate below deals rows by the same three columns.
    doc = ["_known", "_id", "_h"]
    plain = docs.select(F.col(key).isNotNull().alias("_known"), F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("_id"),
                        F.xxhash64(body).alias("_h"), body.alias("_text"))

    def renamed(df: DataFrame, prefix: str, *more: str) -> DataFrame:
        return df.select(*[F.col(c).alias(prefix + c) for c in doc], *more)

    def same(prefix: str) -> list[Column]:
        return [F.col(c) == F.col(prefix + c) for c in doc]

    # Order of the documents: narrow rows only.
    narrow = plain.groupBy(*doc).agg(F.count("*").alias("copies"), F.max(F.length("_text")).cast("long").alias("n_chars"))
    order = materialize(global_row_number(materialize(narrow, "ids"), doc, out="rn"), "order")
    count = F.lit(max(order.count(), 1))
    ahead = renamed(order, "next", F.pmod(F.col("rn") - 1, count).alias("rn"))
    behind = renamed(order, "prev", F.col("n_chars").alias("prev_chars"), F.pmod(F.col("rn") + 1, count).alias("rn"))
    chain = materialize(order.join(ahead, "rn").join(behind, "rn").drop("rn"), "chain")
    # Texts meet the first part of the next text; each text is shuffled once by its own key.
    texts = plain.groupBy(*doc).agg(F.first("_text").alias("_text"))
    heads = texts.join(chain.select(*doc, "prev_known", "prev_id", "prev_h", "prev_chars"), doc).select(
        "prev_known", "prev_id", "prev_h",
        F.substring("_text", F.lit(1), F.floor(F.col("prev_chars") / 2).cast("int")).alias("head"))
    own = texts.join(heads, same("prev"))
    n = F.length("_text")
    edited = F.concat(F.substring("_text", F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("head"))
    both = own.select(*doc, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("_text").alias("body"), F.lit(None).cast("string").alias("sha")),
        F.struct(F.lit(1).alias("which"), edited.alias("body"), F.sha2(edited, 256).alias("sha")))).alias("_v"))
    summed = votes(both.select(*doc, "_v.which", "_v.sha", "_v.body"), [*doc, "which", "sha"], "body")
    prints = materialize(summed.select(*doc, "which", "sha", majority().alias("f")), "prints")
    pair = prints.groupBy(*doc).agg(
        F.max(F.when(F.col("which") == 0, F.col("f"))).alias("f"), F.max(F.when(F.col("which") == 1, F.col("f"))).alias("ef"),
        F.max("sha").alias("edited_sha256"))
    asked = F.col("_known") & (F.col("_id") % query_step == 0)
    pair = materialize(chain.join(pair, doc).withColumn("asked", asked), "pairs")
    # Search over distinct fingerprints.
    distinct = materialize(pair.groupBy(F.col("f").alias("fingerprint")).agg(
        F.sum("copies").alias("n"), F.max("asked").alias("asked")), "fingerprints")
    found = within_radius(distinct.filter("asked").select("fingerprint"), distinct.select("fingerprint"), radius, blocks)
    sizes = distinct.select(F.col("fingerprint").alias("other"), "n")
    near = found.join(sizes, "other").groupBy("fingerprint").agg((F.sum("n") - 1).alias("n_near"))
    # Results per document, then per row.
    follow = renamed(pair, "f", F.col("f").alias("next_f"))
    out = pair.join(follow, [F.col("next" + c) == F.col("f" + c) for c in doc])
    out = out.join(near, F.col("f") == F.col("fingerprint"), "left")
    return out.select(
        F.when(F.col("_known"), F.col("_id")).alias(key), "n_chars", "edited_sha256", hexed(F.col("f")).alias("print"),
        hexed(F.col("ef")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("ef")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f")).alias("near_next"), F.when(F.col("asked"), F.col("n_near")).alias("n_near"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("col").withColumnRenamed("print", "fingerprint")
