"""Near-duplicates by a chosen-path set similarity join over 5-word shingles.

* A document is the set of its distinct shingles (whole text, A-Z in lower case). Documents with
  equal sets are one class from the start, so copies never meet each other.
* Trees: a class enters the nodes given by a few minwise tokens per tree, with functions of their own
  for every tree. Classes of one node share a path of minwise tokens; nodes with one class end.
* Small nodes are compared exhaustively on short signatures (one byte of each of ``SIGNATURE``
  further minwise values). In a large node every class is first compared with the node's pivot. A
  class linked to the pivot can link to a class at similarity below 2t - 1 to the pivot only if that
  lies nearer (1 - similarity is a metric), so linked classes leave a node that has no class in
  between; what stays branches on further tokens, 1/t of them per level, chosen by the node's path. A node
  that is still large after ``max_depth`` levels is compared exhaustively in blocks.
* Recall: a pair at similarity t shares each of the first tokens with probability t, so with ``trees`` x
  ``tokens`` = 18 it misses all nodes with probability 0.25**18. Below a large node each level keeps it in
  1/t x t = 1 child on average; what one tree loses there, the others and the pivots find again.
  Signatures drop a pair only if its estimate lies 3.5 deviations under t.
* Classes that possible links connect form a cluster (a large one is dealt into blocks). Within it, pairs
  are bounded by shortened sets; the pairs that span what these bounds connect are confirmed on full
  sets, and then every pair that the bounds allow across the confirmed components. No quadratic number
  of pairs is written out. Components are alternating stars.

Defined cases: null text counts as empty; an empty document has size 0 and is linked to nothing; a null
id is linked to nothing, has a null component and is kept; an id that repeats is one vertex (all its
texts' links count), and each of its rows is returned; an empty table gives an empty result. Only the
id and the text column are read. Shingles are held as 64-bit hashes and sets as two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .components import components
from .shared import materialize, trimmed, whole_groups

SHINGLE = 5
TREES, TOKENS = 6, 3
SIGNATURE = 128
SMALL_NODE = 8192
SHORT = 4096  # sets up to this size are shortened to four bytes per shingle; larger ones keep eight
SMALL_ROWS = 500_000  # a table of ids or pivots is broadcast only after it was counted to have at most this many rows
_rng = np.random.Generator(np.random.PCG64(975))
_TOKEN = _rng.integers(1, 1 << 63, TREES * TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGN = _rng.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes): the distinct shingles of text i are hashes[starts[i]:starts[i + 1]], ascending."""
    n = len(offsets) - 1
    data = W.LOWER[data]
    starts, ends = W.spans(data, offsets)
    hashes = W.hash_spans(data, starts, ends)
    doc = W.owner(offsets, starts)
    win, at = W.windows(hashes, doc, SHINGLE)
    owner = doc[at]
    count = np.bincount(doc, minlength=n)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):  # a text with fewer words is one shingle, told apart by its number of words
        first = np.searchsorted(doc, short)
        h = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            more = k < count[short]
            h[more] = W.mix(h[more] + hashes[first[more] + k], k)
        win, owner = np.concatenate([win, W.mix(h, 100)]), np.concatenate([owner, short])
    owner, win = W.distinct_per(owner, win)
    return np.searchsorted(owner, np.arange(n + 1)), win


def _minima(hashes: np.ndarray, starts: np.ndarray, factor: np.uint64) -> np.ndarray:
    return W.mix(np.minimum.reduceat(hashes * factor, starts))


def shingled(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, tokens, signature) of ``docs`` (doc_id, text): size and hashes of the set."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        "n long, s1 long, s2 long, tokens array<long>, signature binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(1))
            for lo, hi in W.slices(offsets):
                part = offsets[lo:hi + 1]
                starts, hashes = shingle_sets(data[part[0]:part[-1]], part - part[0])
                n = np.diff(starts)
                full = np.flatnonzero(n)
                s1, s2 = np.zeros((2, hi - lo), np.int64)
                tokens = np.zeros((hi - lo, len(_TOKEN)), np.int64)
                sign = np.zeros((hi - lo, SIGNATURE), np.uint8)
                if len(full):
                    at = starts[:-1][full]
                    s1[full] = np.add.reduceat(W.mix(hashes, 1), at).view(np.int64)
                    s2[full] = np.add.reduceat(W.mix(hashes, 2), at).view(np.int64)
                    for j, f in enumerate(_TOKEN):
                        tokens[full, j] = _minima(hashes, at, f).view(np.int64)
                    for j, f in enumerate(_SIGN):
                        sign[full, j] = (_minima(hashes, at, f) >> np.uint64(56)).astype(np.uint8)
                width = len(_TOKEN)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * width, width), pa.int32()), pa.array(tokens.ravel()))
                blobs = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(np.arange(0, (hi - lo + 1) * SIGNATURE, SIGNATURE, dtype=np.int32)), pa.py_buffer(sign)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2), lists, blobs], names=schema.names)

    return docs.mapInArrow(trimmed(run), schema)


def _small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """A written table with a broadcast hint if it was counted to be small, else as it is (a plain join).
    ``weight`` counts what a row holds where that is not one value per column."""
    rows = df.count() if weight is None else df.agg(F.sum(weight + 1)).first()[0] or 0
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def _signs(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[column.offset * SIGNATURE:(column.offset + len(column)) * SIGNATURE].reshape(-1, SIGNATURE)


def _close(n: np.ndarray, m: np.ndarray, share: float) -> np.ndarray:
    """Sizes that allow a similarity of ``share``."""
    return np.minimum(n, m) >= share * np.maximum(n, m)


def _meetings(group: np.ndarray, n: np.ndarray, sign: np.ndarray, share: float, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): all pairs within groups whose sizes and signatures allow a link, by distance in the order."""
    last = np.searchsorted(group, group, side="right")
    at, shift = np.arange(len(group)), 1
    while True:
        at = at[at + shift < last[at]]
        if not len(at):
            return
        i = at[_close(n[at], n[at + shift], share)]
        i = i[(sign[i] == sign[i + shift]).mean(axis=1) >= least]
        yield i, i + shift
        shift += 1


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the labels of linked rows (labels are row numbers that point at smaller ones)."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not (label[label] == label).all():
            label = label[label]


def _pair_batch(cid: pa.Array, left: list, right: list) -> pa.RecordBatch:
    x, y = (np.concatenate(s) if s else np.zeros(0, np.int64) for s in (left, right))
    return pa.RecordBatch.from_arrays([cid.take(pa.array(x)), cid.take(pa.array(y))], names=["a", "b"])


def _pair_schema(rows: DataFrame) -> T.StructType:
    kind = rows.schema["cid"].dataType
    return T.StructType([T.StructField("a", kind), T.StructField("b", kind)])


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()


def candidate_forest(rows: DataFrame, share: float, least: float) -> DataFrame:
    """Compare each node of ``rows`` (node, cid, n, signature) exhaustively; return pairs (a, b) that connect
    what possible links connect (as stars). A node is bounded, so is a task's memory."""
    ordered = rows.select("node", "cid", "n", "signature").repartition("node").sortWithinPartitions("node", "cid")

    def forest(table: pa.Table) -> pa.RecordBatch:
        sign = _signs(table.column("signature"))
        label = np.arange(table.num_rows)
        for i, j in _meetings(table.column("node").to_numpy(), table.column("n").to_numpy(), sign, share, least):
            if (label[i] != label[j]).any():
                label = _merge(label, i, j)
        member = np.flatnonzero(label != np.arange(len(label)))  # stars around the smallest id of each group
        return _pair_batch(table.column("cid").combine_chunks(), [label[member]], [member])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from whole_groups(batches, "node", forest)

    return _unordered(ordered.mapInArrow(trimmed(run), _pair_schema(rows)))


def _most_common(values: list[np.ndarray], i: int, j: np.ndarray) -> np.ndarray:
    """Upper bounds of the shingles that row i shares with rows j, from shortened hashes."""
    own, out = values[i], np.zeros(len(j), np.int64)
    if any(values[k].dtype != own.dtype for k in j):  # one has four bytes per shingle, the other eight
        short = [v >> np.uint64(32) if v.itemsize == 8 else v for v in (own, *(values[k] for k in j))]
        own, others = short[0].astype(np.uint32), [v.astype(np.uint32) for v in short[1:]]
    else:
        others = [values[k] for k in j]
    at = 0
    while at < len(j):  # about a million shingles at a time
        stop, size = at, 0
        while stop < len(j) and (size < 1 << 20 or stop == at):
            size += len(others[stop])
            stop += 1
        every = np.concatenate(others[at:stop])
        place = np.minimum(np.searchsorted(own, every), len(own) - 1)
        of = np.repeat(np.arange(stop - at), [len(v) for v in others[at:stop]])
        out[at:stop] = np.bincount(of[own[place] == every], minlength=stop - at)
        at = stop
    return out


def cluster_links(rows: DataFrame, percent: int, least: float, every: bool) -> DataFrame:
    """Pairs (a, b) of ``rows`` (node, cid, n, signature, compact, label) whose shortened sets allow a link.

    ``every`` False: pairs that span what is connected by such pairs. ``every`` True: all such pairs
    with different labels."""
    share = percent / 100
    ordered = rows.select("node", "cid", "n", "signature", "compact", "label").repartition("node").sortWithinPartitions("node", "cid")

    def links(table: pa.Table) -> pa.RecordBatch:
        n, sign = table.column("n").to_numpy(), _signs(table.column("signature"))
        node = table.column("node").to_numpy()
        given = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        values = [np.frombuffer(v, "<u4" if size <= SHORT else "<u8") for v, size in zip(table.column("compact").to_pylist(), n)]
        label = given if every else np.arange(table.num_rows)
        ends = np.searchsorted(node, node, side="right")
        left, right = [], []
        for i, end in enumerate(ends):  # each row against the later ones: links come as stars around small ids
            j = np.arange(i + 1, end)
            j = j[label[j] != label[i]]
            j = j[_close(n[i], n[j], share)]
            j = j[(sign[j] == sign[i]).mean(axis=1) >= least] if len(j) else j
            if not len(j):
                continue
            j = j[(100 + percent) * _most_common(values, i, j) >= percent * (n[i] + n[j])]
            if len(j):
                own = np.full(len(j), i)
                left.append(own), right.append(j)
                if not every:
                    label = _merge(label, own, j)
        return _pair_batch(table.column("cid").combine_chunks(), left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from whole_groups(batches, "node", links)

    return _unordered(ordered.mapInArrow(trimmed(run), _pair_schema(rows)))


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, shingles, compact) of the documents whose ids are in ``wanted`` (cid): their texts are read
    again. ``compact`` holds the leading half of each hash for sets up to ``SHORT``, else the hashes."""
    schema = T.StructType([T.StructField("cid", docs.schema["doc_id"].dataType), T.StructField("shingles", T.ArrayType(T.LongType())),
                           T.StructField("compact", T.BinaryType())])
    rows = docs.join(_small(wanted.withColumnRenamed("cid", "doc_id")), "doc_id", "left_semi")
    rows = rows.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(1))
            for lo, hi in W.slices(offsets):
                part = offsets[lo:hi + 1]
                starts, hashes = shingle_sets(data[part[0]:part[-1]], part - part[0])
                sets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(hashes.view(np.int64)))
                half = (hashes >> np.uint64(32)).astype("<u4")
                compact = [(half if b - a <= SHORT else hashes)[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets, pa.array(compact, pa.binary())], names=schema.names)

    return rows.mapInArrow(trimmed(run), schema)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    x = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    met = pairs.join(x, "a").join(y, "b").filter(100 * common >= percent * (F.size("x") + F.size("y") - common))
    return met.select("a", "b").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "ends")


def _estimates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``estimate``: the share of equal bytes of ``signature`` and ``p_signature``."""
    keep = [c for c in rows.columns if c != "p_signature"]
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("estimate", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = (_signs(batch.column(len(keep) - 1)) == _signs(batch.column(len(keep)))).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(e)], names=[*keep, "estimate"])

    assert keep[-1] == "signature"
    return rows.select(*keep, "p_signature").mapInArrow(trimmed(run), schema)


def _sized(rows: DataFrame) -> DataFrame:
    """``rows`` of nodes with two classes or more, with the node's size ``c``."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1")
    return rows.drop("c").join(materialize(sizes, "sizes"), "node")


def _children(rows: DataFrame, share: float) -> DataFrame:
    """Branch: every node continues on one of its signature's tokens, or on two, 1 / share on average."""
    second = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(10_000)) < F.lit(int(10_000 * (1 / share - 1)))
    at = F.explode(F.filter(F.array(F.lit(1), F.when(second, F.lit(3))), lambda i: i.isNotNull()))
    picked = rows.select("*", at.alias("_i")).withColumn("_at", (F.pmod(F.xxhash64("node", F.col("_i")), F.lit(SIGNATURE)) + 1).cast("int"))
    token = F.substring("signature", F.col("_at"), F.lit(1))
    return picked.select(F.xxhash64("node", "_at", token).alias("node"), "cid", "n", "signature")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` of groups of size ``c``: small groups as they are, large ones dealt into block pairs, so
    that any two members of a group meet in one ``node`` of bounded size."""
    count = F.when(F.col("c") <= SMALL_NODE, 1).otherwise(F.ceil(F.col("c") / F.lit(SMALL_NODE // 2))).cast("int")
    own = rows.withColumn("_n", count).withColumn("_b", F.pmod(F.xxhash64("cid"), F.col("_n")).cast("int"))
    pair = own.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o"))
    node = F.xxhash64(F.col(group), F.least("_b", "_o"), F.greatest("_b", "_o"))
    return pair.withColumn("node", node).drop("_n", "_b", "_o", "c")


def path_leaves(docs: DataFrame, classes: DataFrame, percent: int, least: float, max_depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """Grow the trees: (rows (node, cid, n, signature) of small nodes, links to pivots found on the way)."""
    share = percent / 100
    between = max(2 * share - 1, 0)
    far = between - 4 * (max(between * (1 - between), 0.05) / SIGNATURE) ** 0.5
    entered = classes.select("cid", F.posexplode("tokens").alias("i", "t")).select(F.xxhash64("i", "t").alias("node"), "cid")
    shared = _sized(entered)
    rows = materialize(shared.join(classes.select("cid", "n", "signature"), "cid").select("node", "c", "cid", "n", "signature"), "nodes")
    small, links = [rows.filter(F.col("c") <= SMALL_NODE).select("node", "cid", "n", "signature")], []
    large = rows.filter(F.col("c") > SMALL_NODE)
    for depth in range(max_depth):
        if large.isEmpty():
            break
        rank = F.xxhash64(F.lit(depth), F.col("cid"))
        first = large.groupBy("node").agg(F.min(rank).alias("_r"))
        pivots = large.withColumn("_r", rank).join(first, ["node", "_r"]).groupBy("node").agg(
            F.first(F.struct(F.col("cid").alias("p_cid"), F.col("n").alias("p_n"), F.col("signature").alias("p_signature"))).alias("p"))
        met = large.join(_small(materialize(pivots.select("node", "p.*"), "pivots")), "node")
        met = materialize(_estimates(met.select("node", "c", "cid", "n", "p_cid", "p_n", "signature", "p_signature")), "met")
        likely = met.filter((F.col("estimate") >= least) & (F.least("n", "p_n") >= share * F.greatest("n", "p_n")) & (F.col("cid") != F.col("p_cid")))
        pairs = materialize(likely.select(F.least("cid", "p_cid").alias("a"), F.greatest("cid", "p_cid").alias("b")).distinct(), "star")
        found = materialize(confirm(pairs, materialize(full_sets(docs, _ends(pairs)), "sets"), percent), "links")
        links.append(found)
        tied = found.select(F.col("a").alias("cid"), F.col("b").alias("p_cid")).unionByName(
            found.select(F.col("b").alias("cid"), F.col("a").alias("p_cid"))).withColumn("tied", F.lit(True))
        met = met.join(tied, ["cid", "p_cid"], "left").withColumn("tied", F.coalesce("tied", F.col("cid") == F.col("p_cid")))
        met = materialize(met, "tied")
        middle = met.filter(~F.col("tied") & (F.col("estimate") >= far)).select("node").distinct().withColumn("open", F.lit(True))
        stay = met.join(materialize(middle, "open"), "node", "left").filter(F.col("open") | ~F.col("tied"))
        stay = materialize(_sized(stay.select("node", "cid", "n", "signature")), "stay")
        small.append(stay.filter(F.col("c") <= SMALL_NODE).select("node", "cid", "n", "signature"))
        child = materialize(_sized(_children(stay.filter(F.col("c") > SMALL_NODE), share)), "children")
        small.append(child.filter(F.col("c") <= SMALL_NODE).select("node", "cid", "n", "signature"))
        large = child.filter(F.col("c") > SMALL_NODE)
    else:
        small.append(_blocks(large, "node").select("node", "cid", "n", "signature"))
    leaves = small[0]
    for s in small[1:]:
        leaves = leaves.unionByName(s)
    return leaves, links


def near_duplicate_links(docs: DataFrame, classes: DataFrame, percent: int = 75, max_depth: int = 16) -> DataFrame:
    """Pairs (a, b) that connect every component of similar classes: stars of confirmed links, and what the
    last comparison adds; see the module text."""
    share = percent / 100
    least = share - 3.5 * (share * (1 - share) / SIGNATURE) ** 0.5
    leaves, links = path_leaves(docs, classes, percent, least, max_depth)
    forest = materialize(candidate_forest(leaves, share, least), "forest")
    clusters = components(forest).withColumnsRenamed({"v": "cid", "root": "cluster"})
    sizes = materialize(clusters.groupBy("cluster").agg(F.count("*").alias("c")), "clusters")
    sets = materialize(full_sets(docs, materialize(clusters.select("cid"), "ends")), "sets")
    members = clusters.join(sizes, "cluster").join(classes.select("cid", "n", "signature"), "cid").join(sets.select("cid", "compact"), "cid")
    rows = materialize(_blocks(members, "cluster"), "members")
    # An id that repeats has several classes and sets: only the set that fits a class's size is its own.
    rows = rows.filter(F.octet_length("compact") == F.when(F.col("n") <= SHORT, F.col("n") * 4).otherwise(F.col("n") * 8))
    spanning = materialize(cluster_links(rows.withColumn("label", F.col("cid")), percent, least, every=False), "spanning")
    links.append(materialize(confirm(spanning, sets, percent), "links"))
    known = links[0]
    for s in links[1:]:
        known = known.unionByName(s)
    roots = components(known)
    labelled = rows.join(roots, rows["cid"] == roots["v"], "left").withColumn("label", F.coalesce("root", "cid"))
    rest = materialize(cluster_links(labelled, percent, least, every=True), "rest")
    more = materialize(confirm(rest, sets, percent), "links")
    return roots.filter("v != root").select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(more)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    plain = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = materialize(shingled(plain), "shingled")
    linkable = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = linkable.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("cid"), F.first(F.struct("tokens", "signature")).alias("f"))
    classes = materialize(classes.select("cid", "n", "s1", "s2", "f.*"), "classes")
    links = near_duplicate_links(plain, classes, percent)
    # An id with several texts is one vertex: tie the classes its rows belong to.
    members = linkable.select("doc_id", "n", "s1", "s2").distinct().join(classes.select("n", "s1", "s2", "cid"), ["n", "s1", "s2"])
    members = materialize(members.select("doc_id", "cid"), "members")
    split = members.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).filter("a != b")
    split = members.join(split.select("doc_id", "a"), "doc_id").select("a", F.col("cid").alias("b")).filter("a != b")
    roots = components(links.unionByName(split))
    placed = members.groupBy("doc_id").agg(F.min("cid").alias("cid"))
    placed = materialize(placed.join(roots, placed["cid"] == roots["v"], "left").select("doc_id", F.coalesce("root", "cid").alias("root")), "placed")
    out = rows.select("doc_id", "n").join(placed, "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``docs``, all columns as they are, with one document of each group: the rows of its smallest
    id, and of rows that repeat id and text, one."""
    found = materialize(near_duplicates(docs, key, text, percent), "found")
    gone = found.filter(~F.col("kept")).select(F.col(key).alias("_path_id")).distinct()
    rest = docs.join(_small(materialize(gone, "gone")), F.col(key) == F.col("_path_id"), "left_anti")
    hashed = rest.select("*", *[F.xxhash64(F.lit(i), F.col(key), F.col(text)).alias(f"_path_{i}") for i in range(2)])
    again = hashed.filter(F.col(key).isNotNull()).groupBy("_path_0", "_path_1").count().filter("count > 1").select("_path_0", "_path_1")
    again = _small(materialize(again, "again"))
    own = ["_path_0", "_path_1"]
    once = hashed.join(again, own, "left_semi").dropDuplicates(own)
    return hashed.join(again, own, "left_anti").unionByName(once).select(*docs.columns)
