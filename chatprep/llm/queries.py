"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import (chat_collapse, chosen_path, hard_negatives, jump_shards, line_dedup, merkle, mixing, packing, pii_labelers, quality_rff,
               quality_rules, simhash, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


def logged_snapshots(turns: DataFrame) -> DataFrame:
    """``conversations`` as a log would hold them: a conversation is written whenever its number of turns reaches a
    power of two, and at its end, under a new id each time; every third one is written twice at its end."""
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    ends = F.filter(F.sequence(F.lit(0), F.lit(40)), lambda k: (F.call_function("shiftleft", F.lit(1).cast("long"), k) > F.col("turn"))
                    & ((k == 0) | (F.call_function("shiftleft", F.lit(1).cast("long"), k - 1) <= F.col("last"))))
    twice = F.when(F.col("conv_id") % 3 == 0, F.array(F.lit(50))).otherwise(F.array().cast("array<int>"))
    joined = turns.join(last, "conv_id").select("conv_id", "turn", "role", "text", F.explode(F.concat(ends, twice)).alias("k"))
    return joined.select((F.col("conv_id") * 64 + F.col("k")).alias("conv_id"), "turn", "role", "text")


@query("op1_chat_collapse", sql="""
WITH ends AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
log AS (
  SELECT conv_id * 64 + k AS conv_id, turn, role, text FROM (
    SELECT c.conv_id, turn, role, text, unnest(list_concat(
      list_filter(range(41), lambda k: (1::BIGINT << k) > turn AND (k = 0 OR (1::BIGINT << greatest(k - 1, 0)) <= last)),
      CASE WHEN c.conv_id % 3 = 0 THEN [50::BIGINT] ELSE [] END)) AS k
    FROM conversations c JOIN ends USING (conv_id))),
t AS (SELECT DISTINCT conv_id, turn, role, text FROM log),
c AS (SELECT conv_id, list({'r': role, 'x': text} ORDER BY turn NULLS FIRST) AS l, count(*) AS n FROM t GROUP BY conv_id),
kept AS (
  SELECT a.conv_id, a.n, a.l FROM c a
  WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.n > a.n AND b.l[1] = a.l[1] AND b.l[1:a.n] = a.l)
    AND NOT EXISTS (SELECT 1 FROM c b WHERE b.l[1] = a.l[1] AND b.l = a.l AND b.conv_id < a.conv_id)),
turns AS (SELECT conv_id, n, unnest(l) AS m, unnest(range(n)) AS pos FROM kept)
SELECT conv_id, n AS n_turns, pos, m.r AS role,
       '<|im_start|>' || coalesce(m.r, 'unknown') || chr(10) || coalesce(m.x, '') || '<|im_end|>' || chr(10) AS piece
FROM turns""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.collapse_snapshots(logged_snapshots(table(spark, sf_dir, "conversations")))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rff.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_pii_weak_supervision")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_labelers.find_personal_data(table(spark, sf_dir, "documents"))


@query("op4_chosen_path")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_jump_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.shard_documents(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_temperature_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(table(spark, sf_dir, "documents"), min_words=1)


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op11_toxicity_trees")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_hard_negatives", sql="""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
      WHERE place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_negatives(table(spark, sf_dir, "embeddings"), label=hard_negatives.planted_label())


@query("op13_merkle_manifest", sql="""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, '' || coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS mid, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS mid2,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(head || mid || tail) AS leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(head || mid2 || tail) ELSE sha256(head || mid || tail) END AS used,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || mid || tail)) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM d),
t AS (
  SELECT lang, 0 AS lvl, idx, leaf AS digest, n FROM l
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, lvl, idx // 2, n),
s AS (SELECT lang, lvl AS depth, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, idx, subroot AS digest, n FROM s
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, idx // 2, n),
p AS (
  SELECT l.doc_id, l.leaf, l.used, s.subroot, s.idx AS place, s.depth, l.lang, l.idx, 0 AS lvl, l.used AS acc, '' AS proof
  FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT p.doc_id, p.leaf, p.used, p.subroot, p.place, p.depth, p.lang, p.idx, p.lvl + 1,
         CASE WHEN o.digest IS NULL THEN sha256(acc) WHEN (CASE WHEN p.lvl < depth THEN p.idx >> p.lvl ELSE p.place >> (p.lvl - depth) END) % 2 = 1 THEN sha256(o.digest || acc)
              ELSE sha256(acc || o.digest) END, proof || coalesce(o.digest, '')
  FROM p LEFT JOIN (SELECT lang, false AS high, lvl, idx, digest FROM t UNION ALL SELECT NULL, true, lvl, idx, digest FROM u) o
    ON o.high = (p.lvl >= depth) AND (o.high OR o.lang IS NOT DISTINCT FROM p.lang)
       AND o.lvl = CASE WHEN p.lvl < depth THEN p.lvl ELSE p.lvl - depth END
       AND o.idx = xor(CASE WHEN p.lvl < depth THEN p.idx >> p.lvl ELSE p.place >> (p.lvl - depth) END, 1)
  WHERE p.lvl < depth + (SELECT max(lvl) FROM u))
SELECT doc_id, leaf, subroot, (SELECT digest FROM u WHERE n = 1) AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
       acc = (SELECT digest FROM u WHERE n = 1) AS verified
FROM p WHERE lvl = depth + (SELECT max(lvl) FROM u)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))
