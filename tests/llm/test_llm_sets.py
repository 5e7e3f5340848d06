"""Near-duplicates, line dedup, fingerprints: against versions that compare everything."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from llm_brute import near_components, removed_lines
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
import corpus_pipeline
from chatprep.llm import chosen_path, components, line_dedup, simhash

SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def variants(seed, groups=12, most=40, alphabet=400, copies=True):
    """Groups of texts that differ in a few words from one text; some copies; some unrelated."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(alphabet)]
    texts = [None, "", "  \n", "one two", "One TWO", "one two three four", "a b c d e", "A B C D E"]
    for _ in range(groups):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, most)):
            own = list(body)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append("\n".join(" ".join(own[i:i + 15]) for i in range(0, len(own), 15)))
            if copies and rng.random() < 0.3:
                texts.append(texts[-1])
    rng.shuffle(texts)
    return list(enumerate(texts))


def near(spark, rows):
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_near_duplicates_equal_all_pairs(spark):
    rows = variants(1)
    assert near(spark, rows) == near_components(rows)


def test_near_duplicates_in_large_nodes(spark, monkeypatch):
    """Small node limit: pivots, branching and blocks all run."""
    rows = variants(2, groups=4, most=120)
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 16)
    assert near(spark, rows) == near_components(rows)


def test_large_nodes_end_in_blocks(spark, monkeypatch):
    """Unbranched blocks alone find every link."""
    rows = variants(3, groups=3, most=80)
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 16)
    plain = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.coalesce("text", F.lit("")))
    classes = chosen_path.shingled(plain).filter("n > 0").groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("cid"), F.first(F.struct("tokens", "signature")).alias("f")).select("cid", "n", "f.*")
    links = chosen_path.near_duplicate_links(plain, classes, max_depth=0)
    got = {r.v: r.root for r in components.components(links).collect()}
    firsts = {r.cid for r in classes.collect()}
    expected = near_components([r for r in rows if r[0] in firsts])
    assert {i: got.get(i, i) for i in firsts} == {i: expected[i][1] for i in firsts}


def test_near_duplicates_on_the_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert near(spark, rows) == near_components(rows)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4999), (7, 7)]
    got = {r.v: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300)) and got[5000] == 4999
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_that_have_not_converged_are_an_error(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="rounds"):
        components.components(links, rounds=1)
    assert {r.root for r in components.components(links).collect()} == {0}


def test_near_duplicates_defined_cases(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(3, text), (3, text), (9, text), (None, text), (5, None), (6, ""), (7, "alone"), (8, "alone"), (10, "other text that is its own one here"), (10, text)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1)).withColumn("cid", F.lit("x")).withColumn("root", F.lit(2))
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.component_id, r.n_shingles, r.kept) for r in chosen_path.near_duplicates(docs).collect())
    assert got == [(-1, None, 8, True), (3, 3, 8, True), (3, 3, 8, True), (5, 5, 0, True), (6, 6, 0, True), (7, 7, 1, True),
                   (8, 7, 1, False), (9, 3, 8, False), (10, 3, 4, False), (10, 3, 8, False)]
    kept = chosen_path.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 3, 5, 6, 7]
    assert chosen_path.near_duplicates(docs.limit(0)).count() == 0 and chosen_path.deduplicated(docs.limit(0)).count() == 0


def gone(spark, rows, **more):
    return {r.doc_id: [int(x) for x in r.removed.split(",") if x] for r in line_dedup.removed_lines(spark.createDataFrame(rows, SCHEMA), **more).collect()}


@pytest.mark.parametrize("seed,alphabet", [(11, 400), (12, 40), (13, 9)])
def test_removed_lines_equal_all_pairs(spark, seed, alphabet):
    rows = variants(seed, groups=8, most=25, alphabet=alphabet)
    expected = removed_lines(rows)
    assert gone(spark, rows) == {i: expected[i] for i, _ in rows}


def test_removed_lines_with_frequent_words_in_blocks(spark, monkeypatch):
    rows = variants(14, groups=30, most=30, alphabet=12)
    expected = removed_lines(rows)
    monkeypatch.setattr(line_dedup, "GROUP", 50)
    assert gone(spark, rows) == {i: expected[i] for i, _ in rows}


@pytest.mark.parametrize("named", [0, 2])
def test_removed_lines_with_large_groups_found_in_tasks(spark, monkeypatch, named):
    rows = variants(15, groups=20, most=25, alphabet=14)
    called, large = [], line_dedup.large_groups
    monkeypatch.setattr(line_dedup, "large_groups", lambda *a: called.append(1) or large(*a))
    monkeypatch.setattr(line_dedup, "NAMED", named)
    monkeypatch.setattr(line_dedup, "GROUP", 4)
    expected = removed_lines(rows)
    assert gone(spark, rows) == {i: expected[i] for i, _ in rows} and called


def test_words_that_agree_in_44_bits_are_different_words(spark):
    rows = [(1, "w13811188"), (2, "w03821880"), (3, "alpha beta gamma w11487113"), (4, "alpha beta gamma w05237401"), (5, "alpha beta gamma other"),
            (6, "w13811188 w03821880"), (7, "w03821880 w13811188"), (8, "w13811188 w13811188")]
    tokens = [line_dedup.line_words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[1][0] for _, t in rows[:2]]
    assert int(tokens[0]) >> 20 == int(tokens[1]) >> 20 and tokens[0] != tokens[1]  # the case is the one meant
    assert gone(spark, rows, min_words=1) == {1: [], 2: [], 3: [], 4: [], 5: [], 6: [], 7: [0], 8: [0]}


def test_a_text_of_very_many_lines(spark):
    text = "\n".join(f"line number {i // 2} of a long text" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, "line number 7 of a long text\nfresh words only here")], SCHEMA)
    kept = {r.doc_id: r.text for r in line_dedup.deduplicated(docs, percent=100).collect()}
    assert kept[1] == "\n".join(f"line number {i} of a long text" for i in range(30_000)) and kept[2] == "fresh words only here"


def test_removed_lines_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    expected = removed_lines(rows)
    assert gone(spark, rows) == {i: expected[i] for i, _ in rows}


def test_line_dedup_defined_cases(spark):
    a, b = "alpha beta gamma delta", "one two three four five"
    rows = [(1, f"{a}\n\nx y\n{b}"), (2, f"{b}\nx y\n{a} epsilon"), (3, a), (4, None), (5, ""), (6, f"{a}\n{a}"), (None, a), (7, "x y"), (8, b.upper())]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("line_no", F.lit(1)).withColumn("sid", F.lit("x")).withColumn("gone", F.lit(2))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in line_dedup.removed_lines(docs).collect()}
    assert got == {1: (4, 0, ""), 2: (3, 2, "0,2"), 3: (1, 1, "0"), 4: (1, 0, ""), 5: (1, 0, ""), 6: (2, 2, "0,1"), None: (1, 0, ""), 7: (1, 0, ""),
                   8: (1, 1, "0")}
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: f"{a}\n\nx y\n{b}", 2: "x y", 4: None, 5: "", None: a, 7: "x y"}
    assert line_dedup.removed_lines(docs.limit(0)).count() == 0 and line_dedup.deduplicated(docs.limit(0)).count() == 0


def test_short_lines_match_equal_sets(spark):
    wide = "文" * 400
    texts = ["Thanks.\nalpha beta gamma", "thanks.\nThanks. \nThanks. you", f"{wide}\nhm hm hm", f"you THANKS.\n\n{wide}\nhm", "alpha beta\nalpha beta gamma delta"]
    rows = list(enumerate(texts))
    expected = removed_lines(rows, 1)
    assert expected == {1: [0, 1], 3: [0, 2, 3], 4: [1]}
    assert gone(spark, rows, min_words=1) == {i: expected[i] for i, _ in rows}
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_dedup_stage(spark, docs, "").collect()}
    assert kept == {0: texts[0], 1: "Thanks. you", 2: texts[2], 4: "alpha beta"}


@pytest.mark.parametrize("seed,alphabet", [(15, 400), (16, 5)])
def test_removed_lines_of_any_length_equal_all_pairs(spark, seed, alphabet):
    rows = variants(seed, groups=8, most=25, alphabet=alphabet)
    expected = removed_lines(rows, 1)
    assert gone(spark, rows, min_words=1) == {i: expected[i] for i, _ in rows}


def test_line_dedup_query_leaves_no_equal_line(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    expected = removed_lines(rows, 1)
    got = {r.doc_id: [int(x) for x in r.removed.split(",") if x] for r in entry_mod.queries()["op9_line_dedup"](spark, SF01).collect()}
    assert got == {i: expected[i] for i, _ in rows}


def test_fingerprints_equal_plain_python(spark):
    rows = variants(21, groups=6, most=20) + [(100000 + i, t) for i, t in enumerate(["é😀" * 7, "x" * 4000, "same", "same"])]
    got = {r.doc_id: r for r in simhash.fingerprint_documents(spark.createDataFrame(rows, SCHEMA).withColumn("_h", F.lit(1))).collect()}
    rows = sorted((i, t or "") for i, t in rows)
    prints = {}
    for k, (i, t) in enumerate(rows):
        r, other, half = got[i], rows[(k + 1) % len(rows)], len(t) // 2
        edited = t[:len(t) - half] + other[1][:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        f = [int(x, 16) for x in (r.fingerprint, r.edited_fingerprint, got[other[0]].fingerprint)]
        assert r.near_edited == 1 - (f[0] ^ f[1]).bit_count() / 64 and r.near_next == 1 - (f[0] ^ f[2]).bit_count() / 64
        if i % 20:
            assert r.n_near is None
        else:
            assert r.n_near == sum((f[0] ^ int(x.fingerprint, 16)).bit_count() <= 3 for x in got.values()) - 1


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 6), (6, 8)])
def test_radius_search_is_exact(spark, radius, blocks):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(4):
            for _ in range(rng.randint(1, radius + 2)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {(r.fingerprint, r.other): r.distance for r in simhash.within_radius(df, df, radius, blocks).collect()}
    u = np.array(signed, np.int64).view(np.uint64)
    d = np.bitwise_count(u[:, None] ^ u[None, :])
    assert got == {(signed[i], signed[j]): int(d[i, j]) for i, j in zip(*np.nonzero(d <= radius))}


def test_fingerprints_defined_cases(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c d e"), (2, None), (1, "other")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.fingerprint_documents(docs).collect()
    assert len(got) == 5 and sorted(r.n_chars for r in got) == [0, 3, 3, 5, 5]
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 16}
    one = simhash.fingerprint_documents(docs.filter("doc_id = 2")).collect()
    assert [(r.near_edited, r.near_next, r.n_near) for r in one] == [(1.0, 1.0, None)]
    assert simhash.fingerprint_documents(docs.limit(0)).count() == 0


def plain_fingerprint(text):
    """Signed votes of all terms, bit by bit."""
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", text) if w]
    score = [0] * 64
    for i, a in enumerate(words):
        b = words[i + 1] if i + 1 < len(words) else None
        h = xxhash.xxh64_intdigest(a.encode(), seed=42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), seed=h)
        weight = min(len(a), 12) + min(len(b or ""), 12)
        for bit in range(64):
            score[bit] += weight if h >> bit & 1 else -weight
    return f"{sum(1 << bit for bit in range(64) if score[bit] > 0):016x}"


def test_fingerprints_equal_signed_votes(spark):
    rng = random.Random(9)
    texts = ["", None, "one", "one two", "two one", " \t\x0b spaced\n out ", "é 日本 ß", "x" * 30 + " " + "y" * 12, "same same same"]
    texts += [" ".join(rng.choice(["alpha", "be", "gammagammagamma", "d", "日本語"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["word " * 30_000 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumns({c: F.lit(1) for c in ("v0", "total", "which", "rn", "copies")})
    got = {r.doc_id: r for r in simhash.fingerprint_documents(docs).collect()}
    for i, t in enumerate(texts):
        t, follow = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        assert got[i].fingerprint == plain_fingerprint(t) and got[i].edited_fingerprint == plain_fingerprint(edited), t[:50]
