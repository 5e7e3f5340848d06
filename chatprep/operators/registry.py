"""Run registry: which directories are adapters or local models, which artifacts are missing,
where a missing tokenizer file can be taken from, how merges relate to trainings, and what a model was made from in the
end, through chains of merges and base models.

The input is a listing ``(dir, file, path, length, ...)`` (``sources.list_artifacts``) and the
manifests read by ``sources.read_run_manifests``. Everything is aggregates and joins keyed by
directory; per-directory flags are partial aggregates (``max`` of a boolean), never collected sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .ranking import checked_broadcast, shuffle_partitions

# --- fixed values ----------------------------------------------------------------------------
ADAPTER_MARKER = "adapter_config.json"   # a directory is a LoRA adapter iff it holds this file
MODEL_MARKER = "config.json"             # a model directory is "local" iff it holds this file
TOKENIZER_MODEL = "tokenizer.model"      # the file the converters need and warn about
REQUIRED_FILES = [TOKENIZER_MODEL]
# Priority of the places a missing tokenizer file is taken from.
SOURCE_PRIORITY = ["own", "base_model", "adapter"]
# ---------------------------------------------------------------------------------------------


def normal_path(path: Column | str, base: str | None = None) -> Column:
    """One spelling per directory: no ``file:`` scheme, no ``.`` steps, single slashes, no slash at the
    end; a relative path is taken below ``base`` if one is given. Other schemes are kept."""
    p = F.col(path) if isinstance(path, str) else path
    p = F.regexp_replace(p, r"^file:/+", "/")
    if base is not None:
        p = F.when(p.rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:)"), p).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), p))
    p = F.regexp_replace(p, r"(?<!:)/{2,}", "/")
    p = F.regexp_replace(p, r"(?<=/)(\./)+|^(\./)+|/\.$", "")
    return F.when(F.length(p) > 1, F.regexp_replace(p, "/+$", "")).otherwise(p)


def valid_adapters(listing: DataFrame) -> DataFrame:
    """Per directory: ``is_adapter``, ``model_source`` (local / hub), ``n_files``, ``total_bytes``."""
    f = F.col("file")
    return listing.groupBy("dir").agg(
        F.max(f == ADAPTER_MARKER).alias("is_adapter"),
        F.max(f == MODEL_MARKER).alias("_local"),
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("total_bytes"),
    ).select("dir", "is_adapter", F.when(F.col("_local"), F.lit("local")).otherwise(F.lit("hub")).alias("model_source"),
             "n_files", "total_bytes")


def missing_artifacts(listing: DataFrame, required: list[str] | None = None,
                      dirs: DataFrame | None = None) -> DataFrame:
    """``(dir, file)`` for every required file a directory lacks. The expected pairs come from
    exploding the (fixed, small) required list per directory; an anti join removes present files."""
    req = F.array(*[F.lit(x) for x in (required or REQUIRED_FILES)])
    d = dirs if dirs is not None else listing.select("dir").distinct()
    expected = d.select("dir", F.explode(req).alias("file"))
    return expected.join(listing.select("dir", "file"), ["dir", "file"], "left_anti")


def resolve_artifact_source(listing: DataFrame, requests: DataFrame, model_configs: DataFrame | None = None,
                            file: str = TOKENIZER_MODEL, base: str | None = None) -> DataFrame:
    """For each request ``(out_dir, base_model, adapter_dir)`` (paths compared by ``normal_path``): the first of own dir, base model,
    adapter dir that holds ``file`` (``source``, ``source_dir``; NULL if none). A local base
    model's name is taken from its ``config.json`` ``_name_or_path`` when present.

    ``model_configs``: ``(dir, content)`` with the text of each ``config.json``."""
    req = requests
    if model_configs is not None:
        cfg = model_configs.select(normal_path("dir", base).alias("_cfg"),
                                   F.get_json_object("content", "$._name_or_path").alias("_origin"))
        req = req.join(cfg, normal_path("base_model", base) == F.col("_cfg"), "left").drop("_cfg")
    else:
        req = req.withColumn("_origin", F.lit(None).cast("string"))
    origin = F.coalesce(F.col("_origin"), F.col("base_model"))
    cands = req.select(
        "out_dir",
        F.posexplode(F.array(F.col("out_dir"), origin, F.col("adapter_dir"))).alias("_prio", "_dir"),
    )
    cands = cands.withColumn("_at", normal_path("_dir", base))
    have = listing.filter(F.col("file") == file).select(normal_path("dir", base).alias("_at")).distinct()
    hits = cands.join(have, "_at", "left_semi")
    best = hits.groupBy("out_dir").agg(F.min("_prio").alias("_prio"), F.min_by("_dir", "_prio").alias("source_dir"))
    names = F.array(*[F.lit(s) for s in SOURCE_PRIORITY])
    return req.drop("_origin").join(best, "out_dir", "left").withColumn(
        "source", F.when(F.col("_prio").isNotNull(), F.element_at(names, F.col("_prio") + 1))).drop("_prio")


def run_lineage(merges: DataFrame, trainings: DataFrame, base: str | None = None) -> DataFrame:
    """Merge manifests with the training manifest of their adapter nested as ``training_info``
    (NULL when the adapter has none). The adapter's path and the manifest's directory are compared by
    ``normal_path``, relative ones below ``base`` if it is given."""
    fields = [c for c in trainings.columns if c not in ("dir", "path")]
    t = trainings.select(normal_path("dir", base).alias("_at"), F.struct(*fields).alias("_ti"))
    m = merges.drop("training_info") if "training_info" in merges.columns else merges
    return m.join(t, normal_path("lora_adapter", base) == F.col("_at"), "left").drop("_at").withColumnRenamed("_ti", "training_info")


def follow_links(links: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """``(node, end, steps, outcome)``: where each node's chain of links ``(node, next)`` leads, at any depth.

    outcome ``found``: the first node of the chain, itself included, that is in ``stops`` (a column ``node``); ``end``: no stop,
    and the chain ends there (a node without a next one, or a name that is no node, such as a model of the hub); ``cycle``:
    neither, the chain runs into a circle (``end``, ``steps`` NULL). Of several links of one node the smallest ``next`` counts;
    NULL nodes are left out; a stop without a link is a node.

    Pointer doubling: each round joins the chains still open with the table of all nodes and doubles their steps, so a chain of
    length n takes log2(n) rounds, and circles show after log2(number of nodes). Every round is a written checkpoint; its
    table of nodes has one row each, so a node that a third of all chains lead to is a hot key of the other side only,
    which is broadcast to when measured small and split by AQE otherwise."""
    checkpoint_dir(links.sparkSession)
    x = links.select("node", "next", F.lit(False).alias("stop"))
    if stops is not None:
        x = x.unionByName(stops.select("node", F.lit(None).cast("string").alias("next"), F.lit(True).alias("stop")))
    nodes = x.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("next").alias("next"), F.max("stop").alias("stop"))
    closed = F.col("stop") | F.col("next").isNull()
    state = nodes.select(
        "node", F.when(closed, F.col("node")).otherwise(F.col("next")).alias("end"), F.when(closed, 0).otherwise(1).cast("long").alias("steps"),
        F.when(F.col("stop"), F.lit("found")).when(closed, F.lit("end")).alias("outcome"))
    state = state.checkpoint(eager=True)
    count, reach, parts = state.count(), 1, shuffle_partitions(links.sparkSession)
    while reach <= count and not state.filter("outcome IS NULL").isEmpty():
        there = checked_broadcast(state.select(F.col("node").alias("end"), F.col("end").alias("_end"), F.col("steps").alias("_steps"),
                                               F.col("outcome").alias("_outcome"), F.lit(True).alias("_node")))
        further = state.filter("outcome IS NULL").join(there, "end", "left").select(
            "node", F.coalesce("_end", "end").alias("end"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.when(F.col("_node").isNull(), F.lit("end")).otherwise(F.col("_outcome")).alias("outcome"))
        # the two parts together have the partitions of both: without the limit their number would double every round
        state = state.filter("outcome IS NOT NULL").unionByName(further).coalesce(parts).checkpoint(eager=True)
        reach *= 2
    open_still = F.col("outcome").isNull()
    return state.select("node", F.when(~open_still, F.col("end")).alias("end"), F.when(~open_still, F.col("steps")).alias("steps"),
                        F.coalesce("outcome", F.lit("cycle")).alias("outcome"))


def model_links(merges: DataFrame | None = None, model_configs: DataFrame | None = None, base: str | None = None) -> DataFrame:
    """``(node, next)``, one per directory: what a model was made from. A ``config.json`` text ``(dir, content)`` that names its origin
    (``_name_or_path``) goes before a merge manifest ``(dir, base_model, lora_adapter)``, whose adapter goes before its base
    model. Paths by ``normal_path``; blank names are none."""
    parts = []
    if model_configs is not None:
        parts.append(model_configs.select("dir", F.lit(0).alias("_prio"), F.get_json_object("content", "$._name_or_path").alias("_to")))
    if merges is not None:
        named = F.posexplode(F.array("lora_adapter", "base_model")).alias("_prio", "_to")
        parts.append(merges.select("dir", named).select("dir", (F.col("_prio") + 1).alias("_prio"), "_to"))
    if not parts:
        raise ValueError("merge manifests or model configs are needed")
    x = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    to = normal_path("_to", base)
    x = x.select(normal_path("dir", base).alias("node"), F.when(F.trim("_to") != "", F.struct("_prio", to.alias("to"))).alias("_l"))
    return x.groupBy("node").agg(F.min("_l").alias("_l")).select("node", F.col("_l")["to"].alias("next"))


def model_lineage(links: DataFrame) -> DataFrame:
    """Per directory of ``model_links``: ``root`` (what the whole chain was made from), ``depth`` (links to it) and ``cyclic``."""
    return follow_links(links).select(F.col("node").alias("dir"), F.col("end").alias("root"), F.col("steps").alias("depth"),
                                      (F.col("outcome") == "cycle").alias("cyclic"))


def resolve_artifact_chain(listing: DataFrame, links: DataFrame, file: str = TOKENIZER_MODEL, base: str | None = None) -> DataFrame:
    """Per directory of ``links``: the nearest one along its chain, itself first, that holds ``file`` (``source_dir``, ``hops``;
    NULL if none does, also where the chain is a circle)."""
    holders = listing.filter(F.col("file") == file).select(normal_path("dir", base).alias("node"))
    reached = follow_links(links, holders).join(links.select("node").distinct(), "node", "left_semi")
    held = F.col("outcome") == "found"
    return reached.select(F.col("node").alias("dir"), F.when(held, F.col("end")).alias("source_dir"), F.when(held, F.col("steps")).alias("hops"))


def adapter_config_scan(configs: DataFrame) -> DataFrame:
    """One row per (adapter, target module): rank, alpha (``alpha`` or ``lora_alpha``) and the
    effective LoRA scale alpha / r."""
    alpha = F.coalesce(F.col("alpha"), F.col("lora_alpha"))
    return configs.select(
        "dir", "r", alpha.alias("alpha"), (alpha.cast("double") / F.col("r")).alias("scale"),
        F.explode_outer("target_modules").alias("module"),
    )
