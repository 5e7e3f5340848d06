"""Learned merges equal one merge at a time; encoding and decoding are exact."""

import random
import re
from collections import Counter

import pytest

from chatprep.operators import subwords
from chatprep.operators.tokens import SPECIAL_TOKENS

PIECE = re.compile("|".join(SPECIAL_TOKENS) + r"| ?[^<\t-\r ]{1,64}|[<\t-\r ]")


def joined(symbols, pair):
    out, i = [], 0
    while i < len(symbols):
        hit = tuple(symbols[i:i + 2]) == pair
        out.append("".join(pair) if hit else symbols[i])
        i += 2 if hit else 1
    return out


def plain_merges(texts, n, min_count=2):
    words = Counter(p for t in texts if t for p in PIECE.findall(t) if p not in SPECIAL_TOKENS)
    state = [([f"{b:02x}" for b in p.encode()], c) for p, c in words.items()]
    out = []
    while len(out) < n:
        counts = Counter()
        for s, c in state:
            for pair in zip(s, s[1:]):
                counts[pair] += c
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], len(p[0] + p[1]), p))
        if counts[best] < min_count:
            break
        out.append((len(out), *best, counts[best]))
        state = [(joined(s, best), c) for s, c in state]
    return out


TEXTS = [
    "the theatre there, the other <eos> then <b>bold</b>  \n\n two\tlines ",
    "aaaa aaaaaaa aa aaaaaaaaaaaaaaa abababab babab", "質問です。質問の答えです。　<eos>", "é́ 🙂🙂🙂🙂 a🙂",
    "", None, " ", "<", "<eos><eos><pad", "x" * 300, "word " * 400, "abcabcabcab bcabc cabcab aabcc",
]


def random_texts(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab c<") for _ in range(rng.randrange(60))) for _ in range(30)]


@pytest.mark.parametrize("texts,n", [(TEXTS, 120), (random_texts(1), 60), (random_texts(2), 60), (["abc" * 9] * 3 + ["a"], 500)])
def test_merges_equal_one_at_a_time(spark, texts, n):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [tuple(r) for r in subwords.learn_merges(df, n_merges=n).orderBy("rank").collect()]
    assert got == plain_merges(texts, n)


def test_batches_hold_more_than_one_merge():
    assert subwords.independent_prefix([("a", "b"), ("c", "d"), ("b", "x")], set()) == [("a", "b"), ("c", "d")]
    assert subwords.independent_prefix([("a", "b"), ("x", "a")], set()) == [("a", "b")]
    assert subwords.independent_prefix([("a", "a"), ("c", "d")], set()) == [("a", "a")]
    assert subwords.independent_prefix([("a", "bc"), ("ab", "c"), ("d", "e")], set()) == [("a", "bc"), ("ab", "c")]


def test_encode_equals_plain_and_decodes(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1])], "example_id int, text string")
    merges = subwords.learn_merges(df, n_merges=50)
    listed = [(r["left"], r["right"]) for r in merges.orderBy("rank").collect()]
    number = {s: 260 + i for i, s in enumerate(dict.fromkeys(a + b for a, b in listed))}
    number |= {f"{b:02x}": 4 + b for b in range(256)}
    encoded = subwords.encode_subwords(df, merges)
    got = {r["example_id"]: r["token_ids"] for r in encoded.collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        if text is None:
            assert got[i] is None
            continue
        want = []
        for p in PIECE.findall(text):
            symbols = [f"{b:02x}" for b in p.encode()]
            if p in SPECIAL_TOKENS:
                want.append(SPECIAL_TOKENS.index(p))
                continue
            for pair in listed:
                symbols = joined(symbols, pair)
            want += [number[s] for s in symbols]
        assert got[i] == want, text
    texts = {r["example_id"]: r["text"] for r in subwords.decode_subwords(encoded, merges).collect()}
    assert texts == dict(enumerate(TEXTS))
    short = {r["example_id"]: r["token_ids"] for r in subwords.encode_subwords(df, merges, max_length=7).collect()}
    assert short == {i: None if v is None else v[:7] for i, v in got.items()}


def test_ids_are_bounded_and_unique(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    vocab = subwords.subword_vocabulary(subwords.learn_merges(df, n_merges=40)).collect()
    assert sorted(r["token_id"] for r in vocab) == list(range(len(vocab))) and len(vocab) <= 300
    assert len({r["token"] for r in vocab}) == len(vocab)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "example_id int, text string")
    merges = subwords.learn_merges(none)
    assert merges.count() == 0
    assert subwords.encode_subwords(none, merges).count() == 0
    some = spark.createDataFrame([(1, "é")], "example_id int, text string")
    assert subwords.encode_subwords(some, merges).first()["token_ids"] == [4 + 0xC3, 4 + 0xA9]
    cut = subwords.encode_subwords(some, merges, max_length=1)
    assert subwords.decode_subwords(cut, merges).first()["text"] == "�"
