"""Personal data by weak supervision, in DataFrame and SQL functions only.

1. Base patterns (email, ip, card, phone) run over whole texts, leftmost and non-overlapping; what
   fails its check (octets, Luhn sum, digit counts) is dropped without another try. Base spans stay.
2. Wider patterns find more candidates: cards and phones inside runs that the base patterns lost,
   spelled-out mail addresses, identity numbers, and credentials (kind ``secret``).
3. Labelers vote 1, 0 or -1 on every match: the shape, the checksum, a gazetteer (known prefixes and
   endings), the words around it, and its edges.
4. Expectation-maximisation over the counts of vote patterns estimates each labeler's accuracy and
   each kind's prior. The pattern table has at most kinds x 3**labelers rows, whatever the input.
5. The posteriors are the soft labels of a span classifier (log-odds of bounded span features, one
   aggregate). Candidates that it accepts and that touch no base span are added.

Positions: a text is split at a pattern, so gaps and matches alternate; the running sum of their
lengths over one text gives code-point offsets. All patterns are possessive where they can be, so
long runs cost linear time.

Defined cases: null text counts as empty; texts without matches have zero counts, the hash of the
empty string and no spans; rows are treated one by one, so repeated or null ids are kept as they are;
if no candidate exists nothing is added; an empty table gives an empty result. Only the id and the
text column are read.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialize

BASE = {
    # After an unmatched run, or at the end of the last match, a match can only start at the run's first character.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[a-z0-9-]{1,63}+(?: ?[\[(] ?dot ?[\])] ?[a-z0-9-]{2,63}+){1,4}+",
    "card": r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"\+[0-9]{1,3}+[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"\b(?:AKIA[0-9A-Z]{16}+(?![0-9A-Za-z])|(?i:password|passwd|pwd|api[_-]?key|token|secret) ?[=:] ?\"?[A-Za-z0-9_/+.-]{8,}+)",
}
# A cheap test that a text can hold a match at all.
HINT = {
    ("email", True): "%@%", ("phone", True): "%+%", ("phone", False): "%+%",
}
HINT_REGEX = {
    ("ip", True): r"[0-9]\.[0-9]", ("card", True): r"[0-9][\x20-]?[0-9]", ("card", False): r"[0-9]{4}[\x20-]?[0-9]{4}",
    ("email", False): r"(?i)[\[(] ?at ?[\])]", ("id", False): r"[0-9]-[0-9]{2}-[0-9]",
    ("secret", False): r"AKIA|[=:]",
}
KINDS = ["email", "ip", "card", "phone", "id", "secret"]
BEFORE, AFTER = 32, 12  # characters of context on each side
POSITIVE = r"(?i)\b(?:mail|e-?mail|phone|tel|call|fax|card|visa|contact|address|ip|host|server|ssn|login|user|password|token|key)\W*$"
NEGATIVE = r"(?i)\b(?:version|v|license|licence|chapter|section|page|isbn|figure|table|release|cc by-nc)\W*$"
LABELERS = ["shape", "check", "gazetteer", "context", "edges"]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a non-empty string of digits pass the Luhn check? (Every second digit from the right is doubled.)"""
    places = F.sequence(F.lit(1), F.length(number))
    back = F.reverse(number)
    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
        F.substring(F.translate(back, "0123456789", "0246813579"), i, F.lit(1)).cast("int")))
    return total % 10 == 0


def passes(kind: Column, value: Column) -> Column:
    """The check of a base match."""
    d = digits(value)
    octet = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", value.rlike(rf"^{octet}(?:\.{octet}){{3}}$"))
            .when(kind == "card", F.length(d).between(16, 19) & luhn(F.when(F.length(d).between(16, 19), d).otherwise("0")))
            .when(kind == "phone", F.length(d).between(8, 15)).otherwise(F.lit(True)))


def _matches(text: Column, kind: str, base: bool) -> Column:
    """array<struct<gap, value, before, after>>: each match with the length of the gap before it and its context."""
    pattern = (BASE if base else WIDE)[kind]
    hint = text.like(HINT[kind, base]) if (kind, base) in HINT else text.rlike(HINT_REGEX[kind, base])
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.transform(F.arrays_zip(gaps.alias("g"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("n"), found.alias("m")), lambda x: F.struct(
        F.length(x["g"]).alias("gap"), x["m"].alias("value"),
        F.substring(x["g"], F.lit(-BEFORE), F.lit(BEFORE)).alias("before"), F.substring(x["n"], F.lit(1), F.lit(AFTER)).alias("after")))
    return F.when(hint, F.filter(rows, lambda x: x["value"].isNotNull()))


def _positions(rows: DataFrame) -> DataFrame:
    upto = Window.partitionBy("_row", "kind", "base").orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(upto).cast("long")
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("gap", "i")


def votes() -> dict[str, Column]:
    kind, value, d = F.col("kind"), F.col("value"), digits(F.col("value"))

    def sign(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(F.lit(True) if no is None else no, -1).otherwise(0)

    shape = (F.when(kind == "email", sign(value.rlike(r"(?i)^[a-z0-9][a-z0-9._%+-]*+@(?:[a-z0-9-]++\.)++[a-z]{2,24}$") | ~value.contains("@")))
             .when(kind == "ip", sign(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")))
             .when(kind == "card", sign(value.rlike(r"^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3})$")))
             .when(kind == "phone", sign(value.rlike(WIDE["phone"].replace("(?![0-9])", "$"))))
             .when(kind == "secret", sign(value.rlike("[0-9]"))).otherwise(sign(value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"))))
    check = (F.when(kind == "card", sign(F.col("passed") & F.length(d).between(13, 19)))
             .when(kind.isin("ip", "phone"), sign(F.col("passed")))
             .when(kind == "secret", sign(value.rlike("^[^0-9]*+[0-9][^A-Za-z]*+[A-Za-z][^0-9]*+[0-9]|AKIA")))
             .otherwise(0))
    gazetteer = (F.when(kind == "email", sign(value.rlike(r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|example)$"), F.lit(False)))
                 .when(kind == "ip", sign(~value.rlike(r"^(0|127|255)\."), value.rlike(r"^(0|255)\.")))
                 .when(kind == "card", sign(d.rlike("^[3-6]"), d.rlike("^0")))
                 .when(kind == "phone", sign(d.rlike("^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), F.lit(False)))
                 .when(kind == "secret", sign(value.rlike("(?i)^(AKIA|password|token|api)"), F.lit(False))).otherwise(0))
    before = F.col("before")
    context = F.when(before.rlike(NEGATIVE), -1).when(before.rlike(POSITIVE), 1).otherwise(0)
    edges = sign(~before.rlike(r"[\p{L}0-9]$") & ~F.col("after").rlike(r"^[\p{L}0-9]"))
    return dict(zip(LABELERS, (shape, check, gazetteer, context, edges)))


def estimate_reliability(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 60) -> tuple[dict[str, float], list[float]]:
    """EM for independent labelers that are right with one probability each: (log-odds of the prior by
    kind, log-odds of each labeler's accuracy) from the counts of (kind, votes)."""
    accuracy = [0.8] * len(LABELERS)
    prior = {k: 0.7 for k, _, _ in counts}
    for _ in range(rounds):
        right, cast = [1.0] * len(LABELERS), [1.25] * len(LABELERS)  # a weak prior keeps both off 0 and 1
        truth, seen = {k: 0.7 for k in prior}, {k: 1.0 for k in prior}
        for kind, vote, n in counts:
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(
                v * math.log(a / (1 - a)) for v, a in zip(vote, accuracy))
            p = 1 / (1 + math.exp(-max(min(odds, 50), -50)))
            truth[kind] += n * p
            seen[kind] += n
            for j, v in enumerate(vote):
                if v:
                    right[j] += n * (p if v > 0 else 1 - p)
                    cast[j] += n
        accuracy = [min(max(r / c, 0.51), 0.99) for r, c in zip(right, cast)]
        prior = {k: min(max(truth[k] / seen[k], 0.01), 0.99) for k in prior}
    return ({k: math.log(p / (1 - p)) for k, p in prior.items()}, [math.log(a / (1 - a)) for a in accuracy])


def span_features() -> Column:
    """Names of the classifier's features that a match has; every part has a bounded set of values."""
    value, kind = F.col("value"), F.col("kind")
    share = F.floor(4 * F.length(digits(value)) / F.greatest(F.length(value), F.lit(1))).cast("string")

    def edge(c: Column) -> Column:
        return F.when(c == "", "end").when(c.rlike(r"^\s$"), "space").when(c.rlike("^[0-9]$"), "digit").when(
            c.rlike(r"^\p{L}$"), "letter").otherwise("mark")

    return F.array(
        F.concat(kind, F.lit(" length "), F.least(F.floor(F.length(value) / 4), F.lit(12)).cast("string")),
        F.concat(kind, F.lit(" digits "), share),
        F.concat(kind, F.lit(" before "), edge(F.substring("before", -1, 1))),
        F.concat(kind, F.lit(" after "), edge(F.substring("after", 1, 1))),
        F.concat(kind, F.lit(" passed "), F.col("passed").cast("string")),
        F.concat(kind, F.lit(" negative "), F.col("before").rlike(NEGATIVE).cast("string")))


def _lookup(table: dict[str, float], key: Column) -> Column:
    if not table:
        return F.lit(0.0)
    names = sorted(table)
    map_ = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(float(table[n])) for n in names]))
    return F.coalesce(F.try_element_at(map_, key), F.lit(0.0))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row of ``docs``.

    The counts and the hash are those of the base spans; ``spans`` lists base and added ones as
    kind:start:end, by kind in the order of KINDS, then start."""
    plain = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # One pass over the texts; everything after it works on ids and matches.
    arrays = [F.struct(F.lit(k).alias("kind"), F.lit(b).alias("base"), _matches(F.col("_text"), k, b).alias("rows"))
              for b, table in ((True, BASE), (False, WIDE)) for k in table]
    scanned = materialize(plain.select("_row", "_key", F.filter(F.array(*arrays), lambda p: F.size(p["rows"]) > 0).alias("found")), "scanned")
    rows = scanned.select("_row", F.explode("found").alias("p")).select("_row", "p.kind", "p.base", F.posexplode("p.rows").alias("i", "m"))
    located = _positions(rows.select("_row", "kind", "base", "i", "m.*"))
    located = located.withColumn("passed", passes(F.col("kind"), F.col("value")))
    voted = materialize(located.withColumns(votes()), "voted")
    counts = voted.groupBy("kind", *LABELERS).count().collect()  # at most kinds x 3**labelers rows
    prior, accuracy = estimate_reliability([(r["kind"], tuple(r[x] for x in LABELERS), r["count"]) for r in counts])
    odds = _lookup(prior, F.col("kind"))
    for name, w in zip(LABELERS, accuracy):
        odds = odds + F.col(name) * F.lit(w)
    soft = voted.withColumn("p", 1 / (1 + F.exp(-odds)))
    # The classifier: smoothed log-odds of each feature, relative to its kind, from the soft labels.
    weights = soft.select("kind", "p", F.explode(span_features()).alias("feature")).groupBy("kind", "feature").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    totals = {r["kind"]: (r["yes"], r["no"]) for r in soft.groupBy("kind").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()}
    of_kind = {k: math.log((y + 1) / (n + 1)) for k, (y, n) in totals.items()}
    of_feature = {r["feature"]: math.log((r["yes"] + 1) / (r["no"] + 1)) - of_kind[r["kind"]] for r in weights}
    margin = F.aggregate(F.transform(span_features(), lambda f: _lookup(of_feature, f)), _lookup(of_kind, F.col("kind")), lambda a, x: a + x)
    judged = soft.withColumn("accepted", (1 / (1 + F.exp(-margin)) >= threshold) & (F.col("p") >= threshold))
    # Candidates that touch no valid base span, earlier ones first where candidates of a kind touch.
    is_base = F.col("base") & F.col("passed")
    kept = judged.filter(is_base | (~F.col("base") & F.col("accepted"))).select("_row", "kind", "base", "start", "end")
    ahead = Window.partitionBy("_row").orderBy("start", F.col("base").desc(), "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("_row").orderBy(F.col("start").desc(), F.col("base").asc(), F.col("end").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before_end = F.max(F.when(F.col("base"), F.col("end"))).over(ahead)
    next_start = F.min(F.when(F.col("base"), F.col("start"))).over(behind)
    free = (F.coalesce(before_end, F.lit(0)) <= F.col("start")) & (F.coalesce(next_start, F.col("end")) >= F.col("end"))
    kept = kept.withColumn("free", free).filter(F.col("base") | F.col("free"))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    listed = kept.groupBy("_row").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.count(F.when(~F.col("base"), 1)).alias("n_added"),
        F.array_sort(F.collect_list(F.when(F.col("base"), F.struct(place.alias("k"), "start", name.alias("s"))))).alias("own"),
        F.array_sort(F.collect_list(F.struct(place.alias("k"), "start", name.alias("s")))).alias("all"))
    joined = scanned.select("_row", "_key").join(listed, "_row", "left")

    def spelled(c: str) -> Column:
        return F.coalesce(F.array_join(F.transform(F.col(c), lambda x: x["s"]), ","), F.lit(""))

    return joined.select(
        F.col("_key").alias(key), *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(spelled("own"), 256).alias("base_sha256"), spelled("all").alias("spans"),
        F.coalesce(F.col("n_added"), F.lit(0)).cast("long").alias("n_added"))
