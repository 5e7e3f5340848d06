"""Registered queries of the sub-word vocabulary, over every message of ``conversations``, and their SQL: one merge at a
time, each a string replacement, where the library takes batches of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import subwords
from ..session import table
from . import checks

CHECK_MERGES = 24
KEY = ["conv_id", "turn"]


def _merges(spark, d):
    return subwords.learn_merges(table(spark, d, "conversations"), n_merges=CHECK_MERGES)


def q_learn_merges(spark, d):
    return _merges(spark, d)


def q_subword_vocabulary(spark, d):
    return subwords.subword_vocabulary(_merges(spark, d)).select("token_id", "token", F.lower(F.hex("bytes")).alias("bytes"))


def q_encode_subwords(spark, d):
    x = subwords.encode_subwords(table(spark, d, "conversations"), _merges(spark, d), KEY)
    return x.select(*KEY, F.size("token_ids").alias("n_tokens"), checks._ids("token_ids").alias("token_ids"))


def q_decode_subwords(spark, d):
    merges = _merges(spark, d)
    return subwords.decode_subwords(subwords.encode_subwords(table(spark, d, "conversations"), merges, KEY), merges, KEY)


QUERIES = {"learn_merges": q_learn_merges, "subword_vocabulary": q_subword_vocabulary, "encode_subwords": q_encode_subwords,
           "decode_subwords": q_decode_subwords}

_PIECE = "|".join(checks.SPECIALS_SQL) + r"| ?[^<\x09-\x0D ]{1,64}|[<\x09-\x0D ]"


def _merges_sql(n: int) -> str:
    steps = [f"""w0 AS MATERIALIZED (SELECT piece, regexp_replace(lower(hex(encode(piece))), '(..)', '<\\1>', 'g') AS seq, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(text, '{_PIECE}')) AS piece FROM conversations WHERE text IS NOT NULL)
  WHERE piece NOT IN ({checks.SPECIAL_LIST}) GROUP BY piece)"""]
    for i in range(n):
        steps.append(f"""m{i} AS MATERIALIZED (SELECT a, b, sum(n) AS n FROM (
    SELECT n, unnest(s[1:len(s) - 1]) AS a, unnest(s[2:len(s)]) AS b
    FROM (SELECT n, string_split(substr(seq, 2, length(seq) - 2), '><') AS s FROM w{i}) WHERE len(s) > 1)
  GROUP BY a, b HAVING sum(n) > 1 ORDER BY n DESC, length(a) + length(b), a, b LIMIT 1)""")
        steps.append(f"""w{i + 1} AS MATERIALIZED (SELECT w.piece, w.n,
    CASE WHEN a IS NULL THEN seq ELSE replace(seq, '<' || a || '><' || b || '>', '<' || a || b || '>') END AS seq
  FROM w{i} w LEFT JOIN m{i} ON true)""")
    steps.append("merges AS (" + " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS rank, a AS \"left\", b AS \"right\", n::BIGINT AS n FROM m{i}" for i in range(n)) + ")")
    steps.append(f"""symbols AS (
  SELECT token_id, token, lower(hex(encode(token))) AS bytes FROM ({checks.SPECIALS})
  UNION ALL SELECT (4 + i)::INTEGER, printf('%02x', i), printf('%02x', i) FROM range(256) t(i)
  UNION ALL SELECT (259 + row_number() OVER (ORDER BY r))::INTEGER, h, h
    FROM (SELECT "left" || "right" AS h, min(rank) AS r FROM merges GROUP BY h))""")
    return "WITH " + ",\n".join(steps)


_LEARNED = _merges_sql(CHECK_MERGES)

ORACLE_SQL = {
    "learn_merges": _LEARNED + "\nSELECT * FROM merges",
    "subword_vocabulary": _LEARNED + "\nSELECT * FROM symbols",
    "encode_subwords": _LEARNED + f""",
coded AS (SELECT piece, list(token_id ORDER BY pos) AS ids FROM (
    SELECT piece, unnest(s) AS h, generate_subscripts(s, 1) AS pos
    FROM (SELECT piece, string_split(substr(seq, 2, length(seq) - 2), '><') AS s FROM w{CHECK_MERGES})) x
  JOIN symbols v ON v.token_id > 3 AND v.token = x.h GROUP BY piece
  UNION ALL SELECT token, [token_id] FROM symbols WHERE token_id < 4),
cut AS (SELECT conv_id, turn, unnest(p) AS piece, generate_subscripts(p, 1) AS pos
  FROM (SELECT conv_id, turn, regexp_extract_all(text, '{_PIECE}') AS p FROM conversations WHERE text IS NOT NULL)),
whole AS (SELECT conv_id, turn, flatten(list(ids ORDER BY pos)) AS ids FROM cut JOIN coded USING (piece) GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, CAST(CASE WHEN c.text IS NULL THEN NULL ELSE coalesce(len(ids), 0) END AS INTEGER) AS n_tokens,
  CASE WHEN c.text IS NULL THEN NULL ELSE coalesce({checks._ids_sql('ids')}, '') END AS token_ids
FROM (SELECT DISTINCT conv_id, turn, text FROM conversations) c LEFT JOIN whole w ON w.conv_id = c.conv_id AND w.turn = c.turn""",
    "decode_subwords": "SELECT DISTINCT conv_id, turn, text FROM conversations",
}
