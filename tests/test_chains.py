"""Chains of links by doubling equal a walk, link by link."""

import random

import pytest

from chatprep.operators import registry


def walk(links, stops):
    out = {}
    for node in links | {s: None for s in stops if s not in links}:
        at, seen = node, [node]
        while True:
            if at in stops:
                out[node] = (at, len(seen) - 1, "found")
            elif links.get(at) is None:
                out[node] = (at, len(seen) - 1, "end")
            elif links[at] in seen:
                out[node] = (None, None, "cycle")
            else:
                at = links[at]
                seen.append(at)
                continue
            break
    return out


def shapes():
    rng = random.Random(3)
    chain = {f"n{i}": f"n{i + 1}" for i in range(100)} | {"n100": None}
    circle = {f"c{i}": f"c{(i + 1) % 17}" for i in range(17)} | {"into": "c3", "self": "self", "to_self": "self"}
    star = {f"s{i}": "hub" for i in range(200)} | {"hub": "outside/model"}
    loose = {f"r{i}": f"r{rng.randrange(60)}" if rng.random() < 0.8 else None for i in range(60)}
    return [(chain, set()), (chain, {"n50", "n3", "elsewhere"}), (circle, set()), (circle, {"c9", "self"}), (star, set()), (star, {"outside/model"}),
            (loose, set()), (loose, {"r1", "r7", "r30"}), ({**chain, **circle, **star, **loose}, {"n99", "r2"})]


@pytest.mark.parametrize("links,stops", shapes())
def test_follow_links(spark, links, stops):
    df = spark.createDataFrame(list(links.items()) + [(None, "x")], "node string, next string")
    s = spark.createDataFrame([(x,) for x in stops], "node string")
    got = {r["node"]: (r["end"], r["steps"], r["outcome"]) for r in registry.follow_links(df, s if stops else None).collect()}
    assert got == walk(links, stops)


def test_several_links_and_no_links(spark):
    df = spark.createDataFrame([("a", "c"), ("a", "b"), ("a", None), ("b", None)], "node string, next string")
    assert {tuple(r) for r in registry.follow_links(df).collect()} == {("a", "b", 1, "end"), ("b", "b", 0, "end")}
    assert registry.follow_links(df.limit(0)).count() == 0


def test_model_links_take_the_origin_then_the_adapter_then_the_base(spark):
    merges = spark.createDataFrame([("m1", "base", "ad/"), ("m2", "base", " "), ("file:/x/m3", "b3", None), ("m4", None, None)],
                                   "dir string, base_model string, lora_adapter string")
    configs = spark.createDataFrame([("m1/", '{"_name_or_path": "origin"}'), ("m2", "{}"), ("c", "no json")], "dir string, content string")
    links = {r["node"]: r["next"] for r in registry.model_links(merges, configs).collect()}
    assert links == {"m1": "origin", "m2": "base", "/x/m3": "b3", "m4": None, "c": None}
    listing = spark.createDataFrame([("./base", "tokenizer.model"), ("m4", "tokenizer.model")], "dir string, file string")
    got = {r["dir"]: (r["source_dir"], r["hops"]) for r in registry.resolve_artifact_chain(listing, registry.model_links(merges, configs)).collect()}
    assert got == {"m1": (None, None), "m2": ("base", 1), "/x/m3": (None, None), "m4": ("m4", 0), "c": (None, None)}
    assert {r["dir"]: (r["root"], r["depth"], r["cyclic"]) for r in registry.model_lineage(registry.model_links(merges)).collect()}["m1"] == ("ad", 1, False)
