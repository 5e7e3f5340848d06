"""Vocabulary and cut of long conversations without folding them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatprep.operators import tokens
from chatprep.operators.messages import CHATML_TEMPLATE, PLAIN_TEMPLATE, fold_messages
from chatprep.plans.training import examples_from_texts, fold_for_examples, rendered_texts, tokens_apart, training_examples

# Roles without white space or tokens of their own: neighbouring messages run into each other.
BARE = {"roles": {"system": ("", ""), "user": ("", ""), "assistant": ("<a>", "")}, "generation_prompt": ""}
TEMPLATES = [PLAIN_TEMPLATE, CHATML_TEMPLATE, BARE]


def turns_of(spark, seed=4):
    rng = random.Random(seed)
    parts = ["alpha", "beta ", " gamma", "<tag>", "x<y", "<b", ">", "  ", "\n", "", "end.\n", "　z"]
    rows = []
    for conv in range(60):
        roles = ["system"] if conv % 4 == 0 else ["system", "user", "assistant"]
        for i in range(rng.choice([1, 2, 4, 30, 120])):
            rows.append((conv, i * 2, rng.choice(roles), "".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))))
    rows += [(100, i, "system", "s") for i in range(200)]                                  # one run over all messages
    rows += [(101, i, "system", "") for i in range(200)]                                   # nothing at all
    rows += [(102, i, "system", f"w{i} ") for i in range(400)]                             # only system messages
    rows += [(103, i, "user", None if i == 150 else "u") for i in range(200)]              # cannot be rendered
    rows += [(104, i, "robot" if i == 180 else "user", "u v") for i in range(200)]
    rows += [(105, 0, "user", "long " * 5000), (105, 1, "assistant", "x" * 5000), (106, 0, "system", "a"), (106, 1, "system", " "), (106, 2, "system", "b")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


@pytest.fixture(scope="module")
def turns(spark):
    return turns_of(spark).checkpoint()


@pytest.mark.parametrize("template", TEMPLATES)
def test_tokens_apart_are_the_tokens_of_whole_texts(turns, template):
    apart = tokens_apart(turns, template).select(F.explode(tokens.tokenize("text")).alias("t"))
    whole = rendered_texts(fold_messages(turns), "conv_id", template, eos="").select(F.explode(tokens.tokenize("text")).alias("t"))
    want = Counter(r.t for r in whole.collect())
    assert Counter(r.t for r in apart.collect()) == want and want


@pytest.mark.parametrize("template", TEMPLATES)
@pytest.mark.parametrize("length", [2, 7, 40])
def test_cut_fold_gives_the_same_examples(turns, template, length):
    vocab = tokens.build_vocabulary(tokens_apart(turns, template), "text", 60)
    got = training_examples(turns, vocab=vocab, max_length=length, template=template)
    want = examples_from_texts(rendered_texts(fold_messages(turns), "conv_id", template), vocab, length)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_conversation_is_folded_whole(turns):
    """A conversation of any length and any roles reaches the fold as a bounded number of messages and runs."""
    length = 7
    folded = fold_for_examples(turns, length, PLAIN_TEMPLATE).select("conv_id", F.size("messages").alias("n"), F.expr("aggregate(messages, 0, (a, m) -> a + coalesce(length(m.content), 0))").alias("chars")).collect()
    sizes = {r.conv_id: (r.n, r.chars) for r in folded}
    assert sizes[102][0] <= length + 2 and sizes[101][0] == 1 and sizes[104][0] <= length + 3
    assert sizes[105][1] < 5100 and sizes[100][0] == 200  # the one run that goes on over all messages is one token


def test_ids_do_not_depend_on_the_length(spark):
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    short, long = ({r.example_id: list(r.input_ids) for r in training_examples(conv, max_length=n).collect()} for n in (16, 4096))
    assert set(short) == set(long) and all(long[k][:16] == short[k] for k in short)
    vocab = {r.token for r in tokens.build_vocabulary(tokens_apart(conv), "text").collect()}
    whole = rendered_texts(fold_messages(conv)).select(F.explode(tokens.tokenize("text")).alias("t")).distinct().collect()
    assert {r.t for r in whole} <= vocab
