"""Toxicity trees, hard negatives, Merkle manifest: brute force, held-out labels, defined cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from chatprep.llm import hard_negatives, merkle, toxicity
from chatprep.llm import words as W
from tools.compare import compare

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


# ---- 11: toxicity -----------------------------------------------------------------------------

def plain_tokens(text):
    """Tokens as read, one character at a time."""
    read = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch.isascii() and not (ch.isalnum() or ch == "@"):
            out += [word] if word else []
            word = ""
            continue
        low = chr(ord(ch) + 32) if 0xC0 <= ord(ch) <= 0xDE and ord(ch) != 0xD7 else ch.lower() if ch.isascii() else ch
        word += read.get(low, low)
    return out


def test_toxic_features_equal_plain_python():
    rng = random.Random(2)
    parts = ["you ", "idiot ", "ID1OT", "É", "é", "ß", " ", "\n", "!", "!!", "?", "st*pid", "7rash", "x", "dich ", "...", "×", "日"]
    texts = [None, "", "!!!", "You idiot!!", "i@m L0SER"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["word " * 30_000 + "you moron"]
    import pyarrow as pa
    data, offsets = W.text_buffer(pa.array(texts, pa.string()))
    got = toxicity.features(data, offsets, np.zeros(len(texts), np.int64), toxicity.EMPTY)
    col = {c: got[:, i] for i, c in enumerate(toxicity.FEATURES)}
    read = toxicity.normalised(data)
    starts, ends = W.spans(read, offsets)
    found = [bytes(read[s:e]).decode() for s, e in zip(starts, ends)]
    assert found == [t for x in texts for t in plain_tokens(x)]
    for i, x in enumerate(texts):
        tokens = plain_tokens(x)
        n = max(len(tokens), 1)
        insult = [j for j, t in enumerate(tokens) if t in toxicity.INSULTS]
        you = [j for j, t in enumerate(tokens) if t in toxicity.SECOND_PERSON]
        near = sum(any(abs(a - b) <= toxicity.NEAR for b in you) for a in insult)
        assert col["fixed_hits"][i] == pytest.approx(math.log1p(len(insult))) and col["you_rate"][i] == pytest.approx(len(you) / n)
        assert col["near_you"][i] == pytest.approx(near / n) and col["log_tokens"][i] == pytest.approx(math.log1p(len(tokens)))
        assert col["bang_rate"][i] == pytest.approx((x or "").count("!") / n)


def test_lexicon_counts_equal_plain_python(spark):
    rows = [(1 + i % 4, int(i % 3 == 0), t) for i, t in enumerate(["bad bad word", "good word", "bad thing", None, "", "word word", "badly done", "bad"] * 3)]
    sample = spark.createDataFrame(rows, "fold int, label int, text string")
    got = {r.h: r.asDict() for r in toxicity.term_counts(sample).collect()}
    import pyarrow as pa
    for term in ("bad", "word", "good", "thing"):
        data, offsets = W.text_buffer(pa.array([term]))
        h = int(toxicity.terms(data, *W.spans(data, offsets))[0].view(np.int64)[0])
        for f in range(1, 5):
            for y in (0, 1):
                assert got[h][f"n{f}{y}"] == sum(1 for a, b, t in rows if a == f and b == y and term in (t or "").split())


def test_toxicity_held_out_and_unread_labels(spark):
    r = entry_mod.queries()["op11_toxicity_trees"](spark, SF1).toPandas()
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    assert len(r) == 10_000 and r.score.between(0, 1).all() and (r.predicted == (r.score >= 0.5)).all()
    assert (r.held_out == r.doc_id.map(lambda k: zlib.crc32(str(k).encode()) % 5 == 0)).all()
    held = r[r.held_out].merge(labels.toPandas(), on="doc_id")
    caught, wrong = held[held.toxic == 1].predicted.mean(), held[held.toxic == 0].predicted.mean()
    assert caught > 0.9 and wrong < 0.01
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = spark.read.parquet(f"{SF1}/documents.parquet").withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})
    again = toxicity.score_documents(docs, turned).toPandas().set_index("doc_id").score
    assert np.allclose(r.set_index("doc_id").score, again.loc[r.doc_id])


def test_toxicity_defined_cases(spark):
    texts = [None, "", "you idiot", "you idiot", "a " * 40_000, "nice day"] * 4
    docs = spark.createDataFrame([(i if i != 5 else None, t, None, None, 0) for i, t in enumerate(texts)], DOCS).withColumns(
        {c: F.lit(1) for c in ("label", "fold", "score", "_k", "h")})
    some = spark.createDataFrame([(i, None, int(t == "you idiot")) for i, t in enumerate(texts)] + [(2, 1, None), (None, 1, 1)], LABELS)
    out = toxicity.score_documents(docs, some, max_rows=10)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows) and sum(r.doc_id is None for r in rows) == 1
    none, one = spark.createDataFrame([], LABELS), spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.score_documents(docs, one).collect()} == {1.0}
    assert toxicity.score_documents(docs.limit(0), some).count() == 0


# ---- 12: hard negatives -----------------------------------------------------------------------

def mined(rows, positives=5, k=10, low=30, high=90, scale=256):
    """All pairs in plain Python integers."""
    use = [(key, label, [math.floor(x * scale) for x in v]) for key, label, v in rows
           if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (key, label, v) in enumerate(use):
        if key is None or key % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), other is None, other or 0, same, b) for b, (other, same, w) in enumerate(use))
        best = [(-s, None if none else o) for s, none, o, same, b in scored if same == label and b != a][:positives]
        for p, other in best:
            window = [(-s, None if none else o) for s, none, o, same, _ in scored if same != label and low * p <= 100 * -s <= high * p][:k]
            out += [(key, other, i + 1, o, p, s) for i, (s, o) in enumerate(window)]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, rid long, slot string, cell string"


@pytest.mark.parametrize("setting", [{}, {"anchor_block": 2, "tasks": 5}, {"k": 2, "positives": 3, "anchor_block": 3, "cell_pairs": 20}])
def test_negatives_equal_brute_force(spark, setting):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 2), [rng.uniform(-0.2, 1) for _ in range(4)]) for i in range(0, 900, 3)]
    rows += [(5000 + i, 1, [0.5, 0.5, 0.5, 0.5]) for i in range(150)]                  # one vector of a third of all rows
    rows += [(100, 0, [1.0, 0.1, 0.0, 0.2]), (100, 0, [1.0, 0.1, 0.0, 0.2]), (100, 2, [0.0, 0.0, 0.0, 0.0])]  # repeated ids
    rows += [(None, 0, [1.0, 1.0, 1.0, 1.0]), (200, None, [1.0] * 4), (300, 1, None), (400, 1, [1.0, None, 1.0, 1.0]),
             (700, 1, [float("nan"), 1.0, 1.0, 1.0]), (800, 0, [float("inf"), 0.0, 0.0, 0.0]), (1000, 1, [0.3]), (1100, 2, []), (-100, 0, [-1.0] * 4)]
    df = spark.createDataFrame([(k, v, y, 1, "x", "y") for k, y, v in rows], VECTORS)
    got = hard_negatives.mine_negatives(df, **setting)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = {k: v for k, v in setting.items() if k in ("k", "positives")}
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows, **want)


def test_negatives_large_components(spark):
    rows = [(100 * i, i % 2, [float(10**9 + i), float(-i * 10**6), 3.0]) for i in range(12)]  # scores beyond 2**53
    df = spark.createDataFrame([(k, v, y, 1, "x", "y") for k, y, v in rows], VECTORS)
    got = hard_negatives.mine_negatives(df, scale=1, high=100)
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows, scale=1, high=100)


def test_negatives_empty(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine_negatives(empty).count() == 0
    assert hard_negatives.mine_negatives(spark.createDataFrame([(1, [1.0], 1, 1, "x", "y")], VECTORS)).count() == 0


# ---- 13: Merkle manifest ----------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of plain rows (doc_id, text, lang, source, n_chars)."""
    def leaf(d, t, lang, s, n):
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, s, lang, n, t)])
    trees = {}
    for lang in {r[2] for r in rows}:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = own, levels_of([leaf(*r) for r in own])
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    upper = levels_of([trees[x][1][-1][0] for x in langs])
    out = []
    for place, lang in enumerate(langs):
        own, tree = trees[lang]
        for i, r in enumerate(own):
            d, t, _, s, n = r
            fake = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
            node, proof = leaf(d, t, lang, s, n + 1) if fake else tree[0][i], []
            for at, nodes in [(i >> j, x) for j, x in enumerate(tree[:-1])] + [(place >> j, x) for j, x in enumerate(upper[:-1])]:
                run = nodes[at // 2 * 2:at // 2 * 2 + 2]
                proof += [x for j, x in enumerate(run) if j != at % 2]
                node = h(*[node if j == at % 2 else x for j, x in enumerate(run)])
            out.append((d, tree[0][i], tree[-1][0], upper[-1][0], h(*proof), node, node == upper[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [1, 2, 3, 10])
def test_manifest_equals_plain_python(spark, monkeypatch, segment):
    rng = random.Random(segment)
    langs = [None, "", "de", "en", "é", "zz"]
    rows = [(i, rng.choice(["x", "", None, "日本", "long " * 2000]), rng.choice(langs[:5]) if i % 3 else "en", rng.choice([None, "s"]), rng.choice([None, i])) for i in range(75)]
    rows += [rows[3]] * 5 + [(None, "a", "en", None, 1), (None, "b", "en", None, 1), (7, "alone", "zz", None, 2)]
    monkeypatch.setattr(merkle, "SEGMENT", segment)
    for part in (rows, rows[-1:], rows[:2]):
        df = spark.createDataFrame(part, DOCS).withColumns({c: F.lit(1) for c in ("g", "k", "leaf", "rank", "rn", "path", "digest")})
        got = merkle.verify_documents(df)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert sorted(map(tuple, got.collect()), key=repr) == manifest(part)


def test_manifest_many_equal_rows(spark):
    rows = [(7, "copy", "en", "s", 1)] * 3000 + [(8, "other", "en", "s", 1)]
    got = merkle.verify_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == manifest(rows)


def test_manifest_empty(spark):
    assert merkle.verify_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_new_queries_match_sql(spark):
    names = ["op12_hard_negatives", "op13_merkle_manifest"]
    assert all(v.startswith("ok") for v in compare(spark, SF01, names, verbose=False).values())
