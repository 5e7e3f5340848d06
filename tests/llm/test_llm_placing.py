"""Sharding, packing, mixing, chat collapse and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_brute import near_components, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_mod
from chatprep.llm import chat_collapse, jump_shards, mixing, packing

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def test_shards(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    r = jump_shards.shard_documents(docs).toPandas()
    texts = {x.doc_id: (x.text or "").encode() for x in docs.collect()}
    assert len(r) == len(texts) and set(r.law) == {"key"}
    for x in r.itertuples():
        assert (x.size, x.text_crc32) == (len(texts[x.doc_id]) + 16, zlib.crc32(texts[x.doc_id]))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in r.groupby("shard"))
    moved = r[r["shard"] != r.grown_shard]
    assert set(moved.grown_shard) == {40} and 0 < len(moved) < 3 * len(r) / 41


def test_jump_path_is_consistent_and_even(spark):
    keys = spark.range(20000)
    shards = {n: [r[0] for r in keys.select(jump_shards.jump_path(F.col("id"), n)["shard"]).collect()] for n in (1, 2, 7, 8, 100, 101)}
    grown = {n: [r[0] for r in keys.select(jump_shards.jump_path(F.col("id"), n)["grown"]).collect()] for n in (1, 7, 100)}
    assert set(shards[1]) == {0} and grown[1] == shards[2] and grown[7] == shards[8] and grown[100] == shards[101]
    for n, got in shards.items():
        count = Counter(got)
        assert set(count) == set(range(n)) and max(count.values()) < 20000 / n + 6 * (20000 / n) ** 0.5 + 1
    assert all(a == b or b == 100 for a, b in zip(shards[100], shards[101]))


def spark_hash(*values):
    """Spark's xxhash64 in plain Python: each value is hashed with the hash before it as seed; null changes nothing."""
    h = 42
    for v, size in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v).to_bytes(size, "little", signed=True), seed=h)
    return h


def test_jump_path_equals_a_plain_loop(spark):
    keys = [0, 1, -5, 7, 10**12, None] + list(range(50, 400))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 64):
        got = df.select(jump_shards.jump_path(F.col("k"), n).alias("p")).collect()
        for k, r in zip(keys, got):
            want = []
            for shards in (n, n + 1):
                shard = at = 0
                step = 1
                while True:
                    at = math.floor((at + 1) / (((spark_hash((k, 8), (0, 4), (step, 4)) >> 33) + 1) / 2**31))
                    if at >= shards:
                        break
                    shard, step = at, step + 1
                want.append(shard)
            assert [r.p["shard"], r.p.grown] == want, (k, n)


def test_shards_defined_cases(spark):
    rows = [(None, "x", None, None, None), (None, "x", None, None, None), (1, None, None, None, None), (1, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("q")).withColumn("slot", F.lit(3))
    got = jump_shards.shard_documents(docs).collect()
    assert len(got) == 4 and len({r["shard"] for r in got if r.doc_id is None}) == 1
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 1} == {(16, 0)}
    assert jump_shards.shard_documents(docs.limit(0)).count() == 0


def test_encoder_equals_tokenizers(tokenizer):
    rng = random.Random(3)
    enc = packing.encoder(None)
    cases = ["", "<|endoftext|> a", "\x00\x1c \x85  \n\n x", "é　ü ", "'s 'S it's", "😀 नमस्ते 你好", " " * 3000 + "x", "a" * 5000, "\n" * 999, "!?" * 900]
    end = "<|endoftext|>"
    cases += [end, f"a {end} b", f"{end}{end}", f" {end} ", f"a{end}", f"{end}a", f"<|endof{end}text|>", "<|endoftext", "<| endoftext|>", f"x\n{end}\n\n{end}y" * 40]
    cases += ["".join(rng.choice("ab 1'st\n\t\r 　é漢.,!<|>") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for c in cases:
        assert list(enc.ids(c)) == tokenizer.encode(c, add_special_tokens=False).ids, c


def test_plan_is_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(120):
        cap = rng.choice([8, 16, 64, 1024])
        h = {rng.randint(1, cap): rng.randint(1, rng.choice([3, 50])) for _ in range(rng.randint(1, min(cap, 60)))}
        plan = packing.plan_slots(h, cap)
        length = np.concatenate([np.full(c, n) for n, c in h.items()])
        rank = np.concatenate([np.arange(c) for c in h.values()])
        seq, off = plan.place(length, rank)
        bins = []
        for x in sorted(length, reverse=True):
            fit = [b for b in range(len(bins)) if bins[b] >= x]
            if fit:
                bins[min(fit, key=lambda b: bins[b])] -= x
            else:
                bins.append(cap - x)
        assert plan.sequences == len(bins) == len(set(seq))
        by = defaultdict(list)
        for s, o, n in zip(seq, off, length):
            by[s].append((o, n))
        for parts in by.values():
            parts.sort()
            assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1]) and sum(n for _, n in parts) <= cap


def check_packed(rows, texts, tokenizer):
    """Every id of every document is in its place; sequences have no gaps."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        assert all(p.length == 1024 for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1]) and sum(n for _, n in parts) <= 1024


def test_packing_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "word " * 30000)], "doc_id long, text string")
    docs = docs.unionByName(extra).withColumn("rank", F.lit("x")).withColumn("length", F.lit(1))
    rows = packing.pack_documents(docs).collect()
    check_packed(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= total / 1024 * 1.02 + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a b c"), (2, "hello " * 1500), (2, "hello " * 1500)], "doc_id long, text string")
    placed = packing.pack_documents(docs)
    with_ids = packing.tokenize_pieces(docs, with_ids=True).dropDuplicates(["doc_id", "piece"]).select("doc_id", "piece", "ids")
    sequences = packing.assemble_sequences(placed.join(with_ids, ["doc_id", "piece"])).collect()
    assert sum(len(r.ids) for r in sequences) == sum(r.length for r in placed.collect()) and max(len(r.ids) for r in sequences) <= 1024


def mixed(docs, **more):
    plan = mixing.plan_mixture(docs, **more)
    return plan, [tuple(r) for r in mixing.mixed_rows(docs, plan).collect()]


def test_mixture_meets_the_repetition_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    skewed = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").otherwise(F.col("source"))).withColumn("_mixed", F.lit(1))
    weight = {r.doc_id: len(words(r.text)) + 1 for r in docs.collect()}
    source = {r.doc_id: r.source for r in skewed.collect()}
    plan, rows = mixed(skewed, max_repetition=1.5)
    assert plan.alpha == pytest.approx(0.8, abs=0.25) and plan.repetition == pytest.approx(1.5, rel=1e-4)
    read, own = Counter(), Counter()
    for r in rows:
        read[source[r[0]]] += weight[r[0]]
    for i, s in source.items():
        own[s] += weight[i]
    assert {r[0] for r in rows} == set(weight)  # nothing is left out
    quota = {r.source: r.quota for r in plan.plan.collect()}
    for s in own:
        assert quota[s] - max(weight.values()) <= read[s] <= quota[s]
    share = {s: n / sum(own.values()) for s, n in own.items()}
    z = sum(p ** plan.alpha for p in share.values())
    total = sum(quota.values())
    assert all(quota[s] / total == pytest.approx(share[s] ** plan.alpha / z, abs=1e-4) for s in own)


def test_mixture_meets_the_entropy_and_the_budget(spark):
    docs = spark.createDataFrame([(i, "a b c", None, "big" if i % 10 else f"s{i % 50}", 1) for i in range(1000)], DOCS)
    plan, _ = mixed(docs, max_repetition=None, target_entropy=1.0)
    assert plan.entropy == pytest.approx(1.0, abs=1e-3)
    plan, rows = mixed(docs, max_repetition=None, budget_tokens=400, block_rows=16)
    assert plan.alpha == 0 and abs(len(rows) * 4 - 400) <= 6 * 4  # six sources, each within one document
    assert max(Counter(rows).values()) <= 4


def test_mixed_stream_is_a_block_permutation(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7), None, "big" if i % 10 else "small", 1) for i in range(3000)], DOCS)
    rows = mixing.mix_documents(docs, block_rows=64, max_repetition=4.0).collect()
    plan = mixing.plan_mixture(docs, block_rows=64, max_repetition=4.0)
    assert sorted((r.doc_id for r in rows)) == sorted(r[0] for r in mixing.mixed_rows(docs, plan).collect())
    start = {}
    for r in rows:
        assert 0 <= r.start < 1 and start.setdefault((r.source, r["pass"], r.block), r.start) == r.start
    assert len(set(start.values())) == len(start) or len(start) - len(set(start.values())) <= 2
    orders = defaultdict(list)
    for (s, p, b), at in sorted(start.items(), key=lambda x: x[1]):
        orders[s, p].append(b)
    assert orders["small", 0] != orders["small", 1]


def test_mixing_defined_cases(spark):
    rows = [(1, None, None, None, 1), (1, None, None, "", 1), (None, "a", None, "x", 1), (None, "a", None, "x", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("tokens", F.lit(1)).withColumn("block", F.lit(1)).withColumn("place", F.lit("x"))
    _, got = mixed(docs)
    assert len(got) >= 4 and len(got[0]) == len(docs.columns)
    assert {r.source for r in mixing.mix_documents(docs).collect()} == {"", "x"}
    empty = docs.limit(0)
    assert mixed(empty)[1] == [] and mixing.mix_documents(empty).count() == 0


def plain_collapse(turns):
    """{conversation: [(role, text)]} that stay, comparing all conversations."""
    by = defaultdict(set)
    for c, t, r, x in turns:
        by[c].add((t, r, x))
    lists = {c: [(r, x) for _, r, x in sorted(s, key=lambda y: (y[0] is not None, y[0] or 0))] for c, s in by.items()}

    def first(c):
        return (c is not None, c or 0)

    return {c: v for c, v in lists.items() if not any(
        d != c and w[:len(v)] == v and (len(w) > len(v) or first(d) < first(c)) for d, w in lists.items())}


def test_snapshots_collapse(spark):
    rng = random.Random(8)
    turns, n = [], 0
    for _ in range(40):
        body = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "ok", "", None, "long answer " * 5])) for _ in range(rng.randint(1, 9))]
        for cut in range(rng.randint(1, len(body)), len(body) + 1):
            turns += [(n, k * 3, r, x) for k, (r, x) in enumerate(body[:cut])]
            n += 1
    turns += [(None, 0, "user", "null id"), (None, None, "user", "first")] + turns[:5]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1)).withColumn("n", F.lit("q"))
    got = defaultdict(dict)
    for r in chat_collapse.collapse_snapshots(df).collect():
        got[r.conv_id][r.pos] = (r.role, r.piece, r.n_turns)
    expected = plain_collapse(turns)
    assert set(got) == set(expected)
    for c, pieces in got.items():
        assert sorted(pieces) == list(range(len(expected[c])))
        for k, (role, text) in enumerate(expected[c]):
            assert pieces[k] == (role, f"<|im_start|>{role or 'unknown'}\n{text or ''}<|im_end|>\n", len(expected[c]))
    folded = chat_collapse.fold_rendered(chat_collapse.collapse_snapshots(df)).collect()
    assert {r.conv_id: r.text for r in folded} == {c: "".join(p[k][1] for k in sorted(p)) for c, p in got.items()}
    assert chat_collapse.collapse_snapshots(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tokenizer):
    import corpus_pipeline

    docs = entry_mod.queries() and spark.read.parquet(f"{SF01}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (5000, "", None, "", 0), (5001, "same text here for two", "en", "x", 22),
                                   (5001, "same text here for two", "en", "x", 22)], DOCS)
    docs = docs.unionByName(extra).withColumn("kept", F.lit("c")).withColumn("sid", F.lit(1))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF01)
        after = after.persist()
        if name == "best_fit_packing":
            break
        assert after.columns == columns, name
        a, b = [r.doc_id for r in before.collect()], [r.doc_id for r in after.collect()]
        assert set(b) <= set(a)
        if name == "quality_classifier":
            lost = set(a) - set(b)
            assert all(labels.get(i, 0) == 0 for i in lost) and len(lost) > 50
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").distinct().collect() if r.doc_id is not None]
            near = near_components(rows)
            assert sorted(i for i in b if i is not None) == sorted(i for i, (_, c) in near.items() if c == i)
        if name == "source_mixing":
            assert set(a) == set(b) and len(b) > len(a)
        before = after
    texts = Counter(r.doc_id for r in before.collect())
    assert set(texts) == {r.doc_id for r in after.collect()}
    assert corpus_pipeline.run(spark, SF001).count() > 100


def test_registration():
    names = entry_mod.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
