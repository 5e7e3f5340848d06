"""Merkle manifest of a data set, and every document's proof by descent through a content-addressed store.

A digest is the lower-case hex SHA-256 of its inputs' text. Per group (language), leaves ascend by key; every
two consecutive nodes become the digest of both (a last one alone becomes the digest of itself) until one
is left, the group's subroot; the subroots in order of their groups give the root in the same way.

* Building: leaves are numbered per group by range partitions, and cut into runs of 2**SEGMENT
  consecutive ranks. A run is a bounded group whose inner nodes one task computes; the runs' tops
  are numbered already and are cut into runs again, so N leaves take log(N) / SEGMENT rounds, each
  1,024 times smaller than the one before. A group that holds a third of all documents is as many
  runs as any other rows.
* Store: a run is kept under its top digest, as the digests that lie ``height`` levels below it; inside a
  task that gives one record per inner digest, with its children. Equal runs are one entry.
* Descent: a request starts at the root and is joined with the store by the digest it stands at. Requests
  that still share their path are one request, so the root's entry is read once, not once per document. In
  an entry the request goes down by the binary digits of its rank, and the child that it does not take at
  each level is collected; at the end the collected segments are reversed, leaf to root.
* Every document's leaf, or a changed one, is folded with its collected siblings to a root again.

Defined cases: null group is a group of its own and comes first, null keys come first; rows with equal keys
are ordered by leaf digest, rows that are equal throughout are leaves of their own; a null or empty text is a
leaf like any other (null and empty differ); a lone leaf is its group's subroot, a lone subroot the root; an
empty table gives an empty result; other columns are never read. Texts of any length are hashed whole where
they are read and never moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import checked_broadcast, global_row_number
from .shared import materialize, trimmed

SEGMENT = 10  # levels of a run: at most 2**SEGMENT digests are ever gathered
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def entry(children: list[str], height: int) -> tuple[str, dict[str, tuple[str, ...]]]:
    """(top digest, record of children per inner digest) of a run that is ``height`` levels high."""
    records: dict[str, tuple[str, ...]] = {}
    row = children
    for _ in range(height):
        runs = [tuple(row[i:i + 2]) for i in range(0, len(row), 2)]
        row = [_hash(*r) for r in runs]
        records.update(zip(row, runs))
    return row[0], records


def descend(top: str, records: dict[str, tuple[str, ...]], height: int, digits: int) -> tuple[str, list[str]]:
    """Go down ``height`` levels by the binary digits of ``digits``: the digest reached, and what was not
    taken at each level, top first (empty where a node was alone)."""
    path = []
    for level in range(height - 1, -1, -1):
        children = records[top]
        taken = digits >> level & 1
        path.append(children[1 - taken] if len(children) == 2 else "")
        top = children[taken]
    return top, path


def fold_up(leaf: str, path: list[str], places: list[int]) -> str:
    """The root from a leaf, its siblings (leaf level first) and its place (0 or 1) at each level."""
    for other, place in zip(path, places):
        leaf = _hash(leaf) if not other else _hash(other, leaf) if place else _hash(leaf, other)
    return leaf


def _height(n: int, level: int) -> int:
    return min(SEGMENT, depth(n) - SEGMENT * level)


def _tops(runs: DataFrame, level: int) -> DataFrame:
    """(g, n, rank, digest, height, children) of runs (g, n, rank, children) that lie at ``level``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_pylist()
            heights = [_height(x, level) for x in n]
            tops = [entry(c.as_py(), h)[0] for c, h in zip(batch.column(3), heights)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tops, pa.string()), pa.array(heights, pa.int32()), batch.column(3)],
                                             names=["g", "n", "rank", "digest", "height", "children"])

    kind = runs.schema["g"].dataType.simpleString()
    return runs.select("g", "n", "rank", "children").mapInArrow(
        trimmed(run), f"g {kind}, n long, rank long, digest string, height int, children array<string>")


def build_up(nodes: DataFrame, most: int, level: int) -> tuple[DataFrame, list[DataFrame]]:
    """(tops (g, n, digest), store per level) of trees whose nodes at ``level`` are ``nodes`` (g, n, rank, digest);
    ``most`` is the number of leaves of the largest tree. A tree that is down to one node waits as it is."""
    done, stores = [], []
    while True:
        width = F.lit(1 << (SEGMENT * level))  # leaves under a node
        done.append(nodes.filter(F.col("n") <= width).select("g", "n", "digest"))
        if most <= 1 << (SEGMENT * level):
            return reduce(DataFrame.unionByName, done), stores
        runs = nodes.filter(F.col("n") > width).groupBy("g", "n", F.shiftright("rank", SEGMENT).alias("rank")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), "digest"))), lambda x: x["digest"]).alias("children"))
        built = materialize(_tops(runs, level), "runs")
        stores.append(built.select("digest", "height", "children").dropDuplicates(["digest"]))
        nodes, level = built.select("g", "n", "rank", "digest"), level + 1


def descend_once(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Requests one entry further down: (rank, digest, path and whatever else they carry)."""
    own = [c for c in requests.columns if c not in ("rank", "digest", "path")]
    joined = requests.join(store, "digest").select(*own, "rank", "path", "digest", "height", "children")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one entry's requests at a time: a run is the most that is held
                rank, path, top, height, children = (batch.column(c)[i].as_py() for c in ("rank", "path", "digest", "height", "children"))
                _, records = entry(children, height)
                ends = [descend(top, records, height, place) for place in range(len(children))]
                index = pa.array([i] * len(children), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(c).take(index) for c in own] + [
                    pa.array([(rank << height) + place for place in range(len(children))], pa.int64()), pa.array([d for d, _ in ends], pa.string()),
                    pa.array([path + more for _, more in ends], pa.list_(pa.string()))], names=[*own, "rank", "digest", "path"])

    schema = "".join(f"{c} {requests.schema[c].dataType.simpleString()}, " for c in own)
    return joined.mapInArrow(trimmed(run), schema + "rank long, digest string, path array<string>")


def prove_documents(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
                    tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``. On rows that
    fulfil ``where``, the columns of ``tampered`` replace those of the leaf that is folded."""
    kind, group_kind = docs.schema[key].dataType.simpleString(), docs.schema[group].dataType.simpleString()
    plain = docs.select(*dict.fromkeys([*fields, key, group]))
    changed = digest([(tampered or {}).get(c, F.col(c)) for c in fields])
    leaves = plain.select(F.col(group).alias("g"), F.col(key).alias("k"), digest([F.col(c) for c in fields]).alias("leaf"),
                          (F.when(where, changed) if where is not None else F.lit(None).cast("string")).alias("changed"))
    numbered = global_row_number(materialize(leaves, "leaves"), ["g", "k", "leaf"], out="rn")
    bounds = materialize(numbered.groupBy("g").agg(F.min("rn").alias("start"), F.count("*").alias("n")), "groups")
    most = bounds.agg(F.max("n").alias("n"), F.count("*").alias("g")).first()
    near = checked_broadcast(bounds.select(F.col("g").alias("b"), "start", "n"))
    placed = numbered.join(near, F.col("g").eqNullSafe(F.col("b"))).withColumn("r", F.col("rn") - F.col("start"))
    rows = placed.groupBy("g", "n", F.shiftright("r", SEGMENT).alias("rank")).agg(F.sort_array(F.collect_list(F.struct("r", "k", "leaf", "changed"))).alias("rows"))
    rows = materialize(rows, "segments")
    bottom = _tops(rows.withColumn("children", F.col("rows.leaf")), 0).select("g", "n", "rank", "digest")
    subroots, stores = build_up(materialize(bottom, "bottom"), most["n"] or 0, 1)

    # The tree over the subroots; its one group is called 0.
    ordered = global_row_number(subroots, ["g"], out="rank").select(F.lit(0).alias("g"), F.lit(most["g"]).cast("long").alias("n"), "rank", "digest",
                                                                    F.col("g").alias("of"), F.col("n").alias("size"))
    ordered = materialize(ordered, "subroots")
    top, upper = build_up(ordered.select("g", "n", "rank", "digest"), most["g"], 0)
    path = F.array().cast("array<string>").alias("path")
    requests = top.select(F.col("digest").alias("root"), F.lit(0).cast("long").alias("rank"), "digest", path)
    for store in reversed(upper):
        requests = materialize(descend_once(requests, store), "requests")

    # From each subroot down to the lowest runs. A tree enters the descent at the level of its own top.
    requests = requests.withColumnsRenamed({"rank": "place"}).join(ordered.select(F.col("rank").alias("place"), F.col("of").alias("g"), F.col("size").alias("n")), "place")
    requests = requests.withColumns({"subroot": F.col("digest"), "rank": F.lit(0).cast("long")})
    for level in range(len(stores), 0, -1):
        enters = F.col("n") > (1 << (SEGMENT * level))
        deeper = descend_once(requests.filter(enters), stores[level - 1])
        requests = materialize(requests.filter(~enters).unionByName(deeper), "requests")
    requests = requests.select(F.col("g").alias("g2"), F.col("rank").alias("rank2"), "place", "root", "subroot", "digest", "path")
    joined = rows.join(requests, F.col("g").eqNullSafe(F.col("g2")) & (F.col("rank") == F.col("rank2"))).select(
        "n", "place", "root", "subroot", "digest", "path", F.col("rows.k").alias("k"), F.col("rows.leaf").alias("leaf"), F.col("rows.changed").alias("changed"), F.col("rows.r").alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, place, root, subroot, top, path = (batch.column(c)[i].as_py() for c in range(6))
                leaves, fakes, ranks = (batch.column(c)[i].as_py() for c in (7, 8, 9))
                height, levels = _height(n, 0), depth(n)
                _, records = entry(leaves, height)
                proofs, folded = [], []
                for at, (leaf, fake, r) in enumerate(zip(leaves, fakes, ranks)):
                    _, more = descend(top, records, height, at)
                    siblings = (path + more)[::-1]
                    proofs.append(_hash(*siblings))
                    places = [r >> j & 1 for j in range(levels)] + [place >> j & 1 for j in range(len(siblings) - levels)]
                    folded.append(fold_up(leaf if fake is None else fake, siblings, places))
                m = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(6).slice(i, 1).flatten(), pa.array(leaves), pa.array([subroot] * m), pa.array([root] * m),
                     pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded])],
                    names=["k", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    out = joined.mapInArrow(trimmed(run), f"k {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumnRenamed("k", key)


def verify_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, with one more character claimed in every seventh (by crc32 of the id)."""
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return prove_documents(docs, tampered={"n_chars": F.col("n_chars") + 1}, where=F.coalesce(where, F.lit(False)))
