"""Properties of the text functions and the example pipeline, checked against small stdlib models."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chatprep.functions import text as tx
from chatprep.operators import batches, messages, ranking, tokens, validate
from chatprep.plans.training import training_examples
from conftest import SF001, SF01

PY_WS = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_whitespace_class_is_pythons(spark):
    assert len(PY_WS) == 29
    probes = [f"x{c}x" for c in PY_WS] + [f"{c}x{c}" for c in PY_WS] + ["x\u200bx", "\u200bx", "\ufeffx"]
    df = spark.createDataFrame([(s,) for s in probes], "s string")
    got = [r[0] for r in df.select(tx.py_strip("s")).collect()]
    assert got == [s.strip() for s in probes]


def _random_strings(n, seed=7):
    rnd = random.Random(seed)
    alphabet = list("ab *\n<>/|") + PY_WS + ["終", "了", "é", "<end_of_turn>", "</s>", "<|im_end|>", "<|endoftext|>", "**"]
    out = []
    for _ in range(n):
        out.append("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))))
    out += ["exit", "EXIT", " exit", "Quit", "終了", "clear", "Clear ", "history", "SAVE", "", "   ", "　", "hello"]
    return out


def py_cut_at_eos(s):
    for e in tx.EOS_CANDIDATES:
        if e in s:
            return s.split(e)[0].strip()
    return s


def py_bold(s):
    return re.sub(r"\*\*(.*?)\*\*", "\x1b[1m\\1\x1b[0m", s)


def py_command(s):
    low = s.lower()
    if low in tx.EXIT_WORDS:
        return "exit"
    if low in ("clear", "history", "save"):
        return low
    if not s.strip():
        return "blank"
    return "message"


def test_text_functions_match_python(spark):
    data = _random_strings(600)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    got = df.select(
        "i", tx.py_strip("s").alias("strip"), tx.cut_at_eos("s").alias("cut"), tx.bold_to_ansi("s").alias("bold"),
        tx.classify_command("s").alias("cmd"), tx.ensure_eos("s", "</s>").alias("eos"),
        tx.preview("s", 5).alias("pv"),
    ).orderBy("i").collect()
    for r in got:
        s = data[r.i]
        assert r.strip == s.strip(), repr(s)
        assert r.cut == py_cut_at_eos(s), repr(s)
        # Python's "." excludes only "\n"; so does our class
        assert r.bold == py_bold(s), repr(s)
        assert r.cmd == py_command(s), repr(s)
        assert r.eos == (s if s.endswith("</s>") else s + "</s>")
        assert r.pv == (s[:5] + "..." if len(s) > 5 else s)


def test_idempotent(spark):
    data = _random_strings(200, seed=3)
    df = spark.createDataFrame([(s,) for s in data], "s string")
    r = df.select(
        (tx.py_strip(tx.py_strip("s")) == tx.py_strip("s")).alias("a"),
        (tx.ensure_eos(tx.ensure_eos("s", "<eos>"), "<eos>") == tx.ensure_eos("s", "<eos>")).alias("b"),
    ).agg(F.min("a"), F.min("b")).collect()[0]
    assert r[0] and r[1]


def test_fold_explode_roundtrip(spark):
    turns = spark.read.parquet(f"{SF01}/conversations.parquet")
    back = messages.explode_messages(messages.fold_messages(turns))
    a = {(r.conv_id, r.role, r.text) for r in turns.collect()}
    b = {(r.conv_id, r.role, r.content) for r in back.collect()}
    assert a == b
    assert back.count() == turns.count()


def test_training_examples_shape(spark):
    L = 64
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    ex = training_examples(turns, max_length=L, max_vocab=300).collect()
    assert ex
    for r in ex:
        assert len(r.input_ids) == L and len(r.attention_mask) == L and r.labels == r.input_ids
        assert sum(r.attention_mask) == min(r.n_tokens, L)
        assert r.attention_mask == sorted(r.attention_mask, reverse=True)
        assert all(i == tokens.PAD_ID for i, m in zip(r.input_ids, r.attention_mask) if m == 0)


def test_unknown_role_is_dropped(spark):
    convs = spark.createDataFrame(
        [(1, [("user", "hi"), ("assistant", "yo")]), (2, [("robot", "x")]), (3, [])],
        "conv_id long, messages array<struct<role:string,content:string>>")
    from chatprep.plans.training import examples_from_texts, rendered_texts

    texts = rendered_texts(convs)
    got = {r.example_id: r.text for r in texts.collect()}
    assert got[2] is None and got[1] == "\n\nUser: hi\n\nAssistant: yo<eos>" and got[3] == "<eos>"
    ex = validate.drop_invalid_examples(examples_from_texts(texts, max_length=8, max_vocab=10))
    assert sorted(r.example_id for r in ex.collect()) == [1, 3]


def test_plan_batches_properties(spark):
    ex = spark.range(0, 1001).withColumnRenamed("id", "example_id")
    plan = batches.plan_batches(ex, batch_size=4, accumulation=3, epochs=3, seed=5).collect()
    by_epoch = {}
    for r in plan:
        by_epoch.setdefault(r.epoch, []).append(r)
    assert sorted(by_epoch) == [0, 1, 2]
    for e, rows in by_epoch.items():
        ids = [r.example_id for r in rows]
        assert len(ids) == len(set(ids)) == 1000  # 1001 // 4 * 4, incomplete last batch dropped
        assert sorted(r.position for r in rows) == list(range(1000))
        assert all(r.batch == r.position // 4 and r.step == r.batch // 3 for r in rows)
    assert [r.example_id for r in sorted(by_epoch[0], key=lambda r: r.position)] != \
        [r.example_id for r in sorted(by_epoch[1], key=lambda r: r.position)]


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = ranking.global_row_number(df, ["k"], group_col="g", num_partitions=13).collect()
    for g in range(3):
        ks = sorted(r.k for r in got if r.g == g)
        rn = {r.k: r.rn for r in got if r.g == g}
        assert [rn[k] for k in ks] == list(range(len(ks)))


def test_running_sum_with_hot_key(spark):
    rnd = random.Random(1)
    rows = []
    for seq in range(3000):
        key = 0 if rnd.random() < 0.6 else rnd.randint(1, 20)  # one key holds most rows
        rows.append((key, seq, rnd.randint(0, 3)))
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    got = {(r.k, r.seq): r.acc for r in ranking.running_sum(df, ["k"], "seq", "v", "acc", num_partitions=13).collect()}
    acc = {}
    for k, seq, v in rows:
        acc[k] = acc.get(k, 0) + v
        assert got[(k, seq)] == acc[k]


def test_running_sum_sparse_and_null_order_and_key(spark):
    """Order values far apart, missing keys and missing orders: exact, and a hot key is spread over tasks."""
    rnd = random.Random(2)
    rows = [(None if rnd.random() < 0.1 else (7 if rnd.random() < 0.5 else rnd.randint(0, 9)), seq * 10**9 + seq, rnd.randint(0, 3))
            for seq in range(4000)]
    rows += [(k, None, 5) for k in (None, 7, 3)]
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    out = ranking.running_sum(df, ["k"], "seq", "v", "acc", num_partitions=16).withColumn("pid", F.spark_partition_id()).collect()
    acc, want = {}, {}
    for k, seq, v in sorted(rows, key=lambda r: -1 if r[1] is None else r[1]):
        acc[k] = acc.get(k, 0) + v
        want[(k, seq)] = acc[k]
    assert {(r.k, r.seq): r.acc for r in out} == want
    assert ranking.position_in_group(df.limit(0), ["k"], "seq").count() == 0


def test_hot_key_is_cut_into_pieces(spark, monkeypatch):
    """No (partition, key) piece of the running sums holds more than a few partitions' share."""
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 10**7).alias("seq"))
    seen = {}
    plain = ranking.Window.partitionBy

    def watched(*cols):
        seen["window"] = cols
        return plain(*cols)

    monkeypatch.setattr(ranking.Window, "partitionBy", watched)
    out = ranking.running_sum(df, ["k"], "seq", F.lit(1), "acc", num_partitions=20)
    assert seen["window"][0] == "_pid"  # the row windows are dealt by range partition and key
    assert out.filter("k = 0").agg(F.max("acc")).first()[0] == df.filter("k = 0").count()


def test_checked_broadcast_measures_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "s string")

    def hinted(d):
        return "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()

    assert hinted(ranking.checked_broadcast(df))
    assert not hinted(ranking.checked_broadcast(df, max_rows=49))
    assert not hinted(ranking.checked_broadcast(df, max_bytes=40_000))


def test_checkpoint_folder_is_required_on_a_cluster():
    from chatprep.session import checkpoint_dir, is_local_master

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    assert is_local_master("local[8]") and is_local_master("local") and not is_local_master("local-cluster[2,1,1024]")


def _long_turns(spark):
    """Conversations of many sizes, some longer than the cut, with late system messages, an
    unknown role far beyond the cut, a NULL content, and sparse turn numbers."""
    rnd = random.Random(11)
    rows = []
    words = ["alpha", "beta", "gamma", "<tag>", "x<y", "  ", "", "end."]

    def text():
        return " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 4)))

    for conv in range(40):
        n = rnd.choice([1, 2, 5, 9, 10, 11, 30, 300])
        start = rnd.choice([0, 1])
        for i in range(n):
            role = "system" if (i == 0 and start == 1) else ("user" if (i + start) % 2 == 0 else "assistant")
            rows.append((conv, i * rnd.choice([1, 3]) if conv % 5 == 0 else i, role, text()))
    rows.append((100, 0, "system", "sys"))
    rows += [(100, i, "user" if i % 2 else "assistant", "w") for i in range(1, 50)]
    rows.append((100, 50, "robot", "late unknown role"))
    rows += [(101, i, "user" if i % 2 == 0 else "assistant", "v v") for i in range(60)]
    rows.append((101, 3, "system", "late system in the prefix"))  # duplicate turn number is avoided below
    rows = [r for r in rows if not (r[0] == 101 and r[1] == 3 and r[2] != "system")]
    rows += [(102, i, "user" if i % 2 == 0 else "assistant", None if i == 40 else "z") for i in range(60)]
    # make (conv, turn) unique after the sparse numbering
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            out.append(r)
    return spark.createDataFrame(out, "conv_id long, turn long, role string, text string")


def test_cut_before_fold_is_exact(spark):
    from chatprep.operators.messages import CHATML_TEMPLATE, PLAIN_TEMPLATE, fold_messages
    from chatprep.plans.training import examples_from_texts, rendered_texts

    turns = _long_turns(spark)
    for template in (PLAIN_TEMPLATE, CHATML_TEMPLATE):
        vocab = tokens.build_vocabulary(rendered_texts(fold_messages(turns), "conv_id", template).dropna(), "text", 50)
        for L in (3, 8, 16):
            got = training_examples(turns, vocab=vocab, max_length=L, template=template)
            want = examples_from_texts(rendered_texts(fold_messages(turns), "conv_id", template), vocab, L)
            g = sorted(tuple(r) for r in got.collect())
            w = sorted(tuple(r) for r in want.collect())
            assert g == w, (template["generation_prompt"], L)
    assert 100 not in {r.example_id for r in got.collect()}  # unknown role beyond the cut still drops it


def test_chat_format_report_turns_equals_array_form(spark):
    turns = _long_turns(spark)
    a = {r.conv_id: (list(r.violations), r.is_valid) for r in
         validate.chat_format_report(messages.fold_messages(turns)).collect()}
    b = {r.conv_id: (list(r.violations), r.is_valid) for r in validate.chat_format_report_turns(turns).collect()}
    assert a == b


def test_resolve_special_ids_rules(spark):
    # own EOS first, then candidates in list order, unk-mapped and repeated ids skipped
    vocab = spark.createDataFrame(
        [("<pad>", 0), ("<unk>", 1), ("<eos>", 3), ("</s>", 9), ("<|im_end|>", 7), ("<|endoftext|>", 3)],
        "token string, token_id int")
    r = tokens.resolve_special_ids(vocab).collect()[0]
    assert list(r.eos_ids) == [3, 7, 9] and r.pad_id == 0
    # an EOS candidate mapped to unk is not an EOS id; without a pad token, pad falls back to EOS
    vocab2 = spark.createDataFrame([("<unk>", 1), ("<eos>", 5), ("<end_of_turn>", 1)], "token string, token_id int")
    r2 = tokens.resolve_special_ids(vocab2).collect()[0]
    assert list(r2.eos_ids) == [5] and r2.pad_id == 5


def test_special_ids_without_own_eos(spark):
    vocab = spark.createDataFrame([("<unk>", 1), ("</s>", 9)], "token string, token_id int")
    r = tokens.resolve_special_ids(vocab).collect()[0]
    assert list(r.eos_ids) == [9] and r.pad_id is None  # no pad token and no own EOS: nothing to pad with
    vocab = spark.createDataFrame([("<unk>", 1), ("<eos>", 1), ("</s>", 9)], "token string, token_id int")
    r = tokens.resolve_special_ids(vocab).collect()[0]
    assert list(r.eos_ids) == [1, 9] and r.pad_id == 1  # the own EOS stays whatever its id


def test_no_token_of_the_corpus_is_unknown(spark):
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    ids = [i for r in training_examples(turns, max_length=64).collect() for i, m in zip(r.input_ids, r.attention_mask) if m]
    assert tokens.UNK_ID not in ids


def test_texts_with_one_id_stay_apart(spark):
    texts = spark.createDataFrame([(1, "a b"), (1, "c d"), (1, "c d"), (2, None), (3, "")], "example_id long, text string")
    vocab = tokens.build_vocabulary(texts, "text")
    got = sorted((r.example_id, r.token_ids) for r in tokens.encode_tokens(texts, vocab).collect() if r.token_ids is not None)
    assert [(i, len(t)) for i, t in got] == [(1, 2), (1, 2), (3, 0)] and got[0][1] != got[1][1]


def test_chat_format_report_keeps_null_keys_and_orders(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "robot", "x"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: list(r.violations) for r in validate.chat_format_report_turns(turns).collect()}
    assert got == {None: [], 1: ["bad_role", "not_alternating"]}


def test_map_examples_keeps_types(spark):
    from chatprep.operators.udf import map_examples

    big = 9007199254740993
    df = spark.createDataFrame([(big, "a"), (None, "b"), (3, "bad")], "id long, t string")

    def fn(r):
        if r["t"] == "bad":
            raise ValueError("no")
        return {"twice": None if r["id"] is None else r["id"] * 2, "wrong": r["t"]}

    good, errors = map_examples(df, fn, "twice long, wrong string", on_error="split", keep=["id"])
    assert {(r.id, r.twice) for r in good.collect()} == {(big, big * 2), (None, None)}
    assert [(r.id, r.error) for r in errors.collect()] == [(3, "ValueError: no")]
    kept = map_examples(df, lambda r: {"n": r["t"]}, "n long", on_error="keep", keep=["id"]).collect()
    assert len(kept) == 3 and all(r.error for r in kept)


def test_history_view_edges(spark):
    from chatprep.operators import sessions

    convs = spark.createDataFrame(
        [(1, [("system", "s")]), (2, []), (3, [("user", "first is skipped"), ("user", "u" * 150), ("tool", "t")])],
        "conv_id long, messages array<struct<role:string,content:string>>")
    rows = sessions.history_view(convs).orderBy("conv_id", "idx").collect()
    assert [(r.conv_id, r.line) for r in rows] == [(3, "1. User: " + "u" * 100 + "..."), (3, "2. Assistant: t")]
