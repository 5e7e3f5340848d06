"""Strict JSON checks on text columns, with one parse per line.

``try_parse_json`` (VARIANT) alone is too lenient (it accepts trailing text such as
``{"a":1} x``). A line ``l`` is exactly one JSON value when ``[l]`` parses, has an element 0 and no
element 1 (``1,2`` gives two elements, an empty line none); element 0 is then the value itself, so
the line class is read from it without parsing again. Python's ``json.loads`` also accepts the
bare values ``NaN``, ``Infinity`` and ``-Infinity``; a line that fails and holds one of them is
parsed once more with those bare values replaced by ``0`` (a number in the same place, so the
structure is unchanged).

The JVM parsers have limits that Python's has not (strings of about 20 million characters, numbers
of 1000 digits, 1000 nested levels). Only a line longer than ``LIMIT_FREE_LENGTH`` can reach one of
them; such a line, if the JVM refuses it, is checked by ``json.loads`` in an Arrow-batched function
that gets NULL for every other line.
"""

from __future__ import annotations

import json as _json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import ensure_conf
from .text import py_strip

# Status classes of one line of chat JSONL.
STATUS_OK = "ok"
STATUS_INVALID_JSON = "invalid_json"
STATUS_NOT_OBJECT = "not_object"
STATUS_MISSING = "missing_messages"
STATUS_NOT_LIST = "messages_not_list"
STATUSES = [STATUS_OK, STATUS_INVALID_JSON, STATUS_NOT_OBJECT, STATUS_MISSING, STATUS_NOT_LIST]

# Shorter texts cannot reach a limit of the JVM parsers.
LIMIT_FREE_LENGTH = 900
_NONFINITE = r"NaN|Infinity"
# A bare NaN / Infinity / -Infinity value: not preceded or followed by anything but JSON
# punctuation or white space (inside a string the replacement is harmless: a string stays a string).
_NONFINITE_VALUE = r"(?<![^\[:,\s])(?:NaN|-?Infinity)(?![^\]},\s])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _closes_early_safe(c: Column) -> Column:
    """The parsers stop after the first complete value and ignore what follows, so ``[l]`` alone
    accepts ``1],[2``. Such a line closes the array early with a stray ``]``, and then fails as
    the value of ``{"w": l}`` (and vice versa for a stray ``}``). This second check only needs
    to tokenize, so it uses the streaming ``json_object_keys`` (no value is built)."""
    return F.json_object_keys(F.concat(F.lit('{"w":'), c, F.lit("}"))).isNotNull()


def _single_value(c: Column) -> Column:
    """The JSON value the text holds (as VARIANT), or NULL unless it is exactly one value."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    first = F.try_variant_get(wrapped, "$[0]", "variant")
    second = F.try_variant_get(wrapped, "$[1]", "variant")
    return F.when(second.isNull() & _closes_early_safe(c), first)


def python_status(text: str | None) -> str | None:
    """Status of one line as Python's json.loads plus the trainer's checks see it."""
    if text is None:
        return None
    try:
        data = _json.loads(text)
    except (ValueError, RecursionError):
        return STATUS_INVALID_JSON
    if isinstance(data, dict):
        if "messages" not in data:
            return STATUS_MISSING
        return STATUS_OK if isinstance(data["messages"], list) else STATUS_NOT_LIST
    if isinstance(data, (list, str)) and "messages" not in data:
        return STATUS_MISSING
    return STATUS_NOT_OBJECT


@F.pandas_udf(StringType())
def _python_status(text: pd.Series) -> pd.Series:
    return text.map(python_status, na_action="ignore")


def _or_python(status: Column, text: Column) -> Column:
    """``status``, or what ``json.loads`` says of a long text that the JVM parsers refused."""
    refused = (status == STATUS_INVALID_JSON) & (F.length(text) > LIMIT_FREE_LENGTH)
    return F.coalesce(_python_status(F.when(refused, text)), status)


def _session() -> None:
    """Apply the settings the parse needs to the session the expression will run in."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ensure_conf(spark)


def _parsed(c: Column) -> Column:
    """The value of the line as the JVM parsers read it (VARIANT), NULL when they fail."""
    _session()
    direct = _single_value(c)
    patched = _single_value(F.regexp_replace(c, _NONFINITE_VALUE, "0"))
    return F.coalesce(direct, F.when(c.rlike(_NONFINITE), patched))


def is_valid_json(c, strip: bool = False) -> Column:
    """``json.loads`` succeeds on the text (optionally after Python's strip)."""
    c = _col(c)
    if strip:
        c = py_strip(c)
    native = F.when(_parsed(c).isNotNull(), F.lit("valid")).otherwise(F.lit(STATUS_INVALID_JSON))
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(_or_python(native, c) != STATUS_INVALID_JSON)


def _variant_status(v: Column) -> Column:
    """Status of a parsed JSON value (VARIANT)."""
    kind = F.schema_of_variant(v)
    msgs = F.try_variant_get(v, "$.messages", "variant")
    as_string = F.try_variant_get(v, "$", "string")
    elems = F.try_variant_get(v, "$", "array<variant>")
    array_has = F.exists(
        elems,
        lambda x: (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == "messages"),
    )
    return (
        F.when(kind.startswith("OBJECT"),
               F.when(msgs.isNull(), F.lit(STATUS_MISSING))
               .when(F.schema_of_variant(msgs).startswith("ARRAY"), F.lit(STATUS_OK))
               .otherwise(F.lit(STATUS_NOT_LIST)))
        # `"messages" in x` on a list or string without it: reported as missing by the trainer;
        # with it (and for numbers, booleans, null) the trainer crashes; we report not_object.
        .when(kind.startswith("ARRAY"),
              F.when(F.coalesce(array_has, F.lit(False)), F.lit(STATUS_NOT_OBJECT)).otherwise(F.lit(STATUS_MISSING)))
        .when(kind == "STRING",
              F.when(as_string.contains("messages"), F.lit(STATUS_NOT_OBJECT)).otherwise(F.lit(STATUS_MISSING)))
        .otherwise(F.lit(STATUS_NOT_OBJECT))
    )


def with_status(df, line_col: str = "line", out: str = "status", strip: bool = True):
    """Add ``out``: the class of each JSONL line, ok / invalid_json / not_object / missing_messages /
    messages_not_list (NULL for a NULL line). ``strip=True`` is the trainer's gate (it strips first).

    The wrapped parse is its own projection, so each line is parsed once (the NaN/Infinity re-parse
    only runs for lines that fail and contain one of those words)."""
    ensure_conf(df.sparkSession)
    text = py_strip(_col(line_col)) if strip else _col(line_col)
    w = df.withColumn("_w", F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))
    direct = F.when(F.try_variant_get("_w", "$[1]", "variant").isNull() & _closes_early_safe(text),
                    F.try_variant_get("_w", "$[0]", "variant"))
    patched = _single_value(F.regexp_replace(text, _NONFINITE_VALUE, "0"))
    w = w.withColumn("_v", F.coalesce(direct, F.when(text.rlike(_NONFINITE), patched)))
    native = F.when(F.col("_v").isNotNull(), _variant_status(F.col("_v"))).otherwise(F.lit(STATUS_INVALID_JSON))
    w = w.withColumn("_n", F.when(_col(line_col).isNotNull(), native))
    return w.withColumn(out, _or_python(F.col("_n"), text)).drop("_w", "_v", "_n")


def line_status(c, strip: bool = True) -> Column:
    """The class of one JSONL line as an expression (see ``with_status``)."""
    c = _col(c)
    if strip:
        c = py_strip(c)
    v = _parsed(c)
    native = F.when(v.isNotNull(), _variant_status(v)).otherwise(F.lit(STATUS_INVALID_JSON))
    return F.when(c.isNotNull(), _or_python(native, c))
