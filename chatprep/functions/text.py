"""Column -> Column text functions (all JVM-side, inside whole-stage codegen).

Regular expressions here are written so that Java (Spark) and RE2 read them the same way:
explicit character classes with ``\\x{...}`` escapes, ``\\z`` for end of text, ``[^\\n]`` for "any
character but newline".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the chat program's behaviour) ---------------------------------
# End-of-sequence strings, in the order they are tried.
EOS_CANDIDATES = ["<end_of_turn>", "<|im_end|>", "</s>", "<|endoftext|>"]
# Words that end a chat session (compared after lower-casing).
EXIT_WORDS = ["exit", "quit", "終了"]
# Other commands of the chat loop.
COMMANDS = ["clear", "history", "save"]
# Characters Python's str.strip() removes: U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000 (29 in all).
PY_WHITESPACE_CLASS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
PY_STRIP_PATTERN = rf"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+\z"
# The same 29 characters as a string, built from their code points.
PY_WHITESPACE_CODEPOINTS = (
    list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
PY_WHITESPACE_CHARS = "".join(chr(cp) for cp in PY_WHITESPACE_CODEPOINTS)
# Markdown bold, not across a newline, shortest match.
BOLD_PATTERN = r"\*\*([^\n]*?)\*\*"
ESC = "\x1b"
# Length after which the history view shortens a message, and the marker it appends.
HISTORY_PREVIEW_CHARS = 100
HISTORY_ELLIPSIS = "..."
# -------------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove Unicode white space at both ends.

    ``trim(BOTH chars FROM s)`` with the 29 white-space characters as the set (plain ``trim``
    only removes spaces); it walks in from both ends, so its cost does not grow with the text."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def is_blank(c) -> Column:
    """True when the text is empty after ``py_strip`` (NULL stays NULL)."""
    return F.length(py_strip(c)) == 0


def ensure_eos(c, eos: str | Column) -> Column:
    """Append ``eos`` unless the text already ends with it."""
    c = _col(c)
    eos_c = eos if isinstance(eos, Column) else F.lit(eos)
    return F.when(c.endswith(eos_c), c).otherwise(F.concat(c, eos_c))


def cut_at_eos(c, extra_eos: str | None = None) -> Column:
    """Walk the EOS strings in list order; the first one that occurs anywhere in the text cuts it
    at its first occurrence and the rest is stripped. Without any EOS the text is returned as is."""
    c = _col(c)
    eos_list = list(EOS_CANDIDATES) + ([extra_eos] if extra_eos else [])
    out = None
    for eos in eos_list:
        cut = py_strip(F.substring_index(c, eos, 1))
        out = F.when(c.contains(eos), cut) if out is None else out.when(c.contains(eos), cut)
    return out.otherwise(c)


def bold_to_ansi(c) -> Column:
    """``**x**`` -> ESC[1m x ESC[0m (shortest match, never across a newline)."""
    return F.regexp_replace(_col(c), BOLD_PATTERN, f"{ESC}[1m$1{ESC}[0m")


def clean_response(c, extra_eos: str | None = None, ansi_bold: bool = True) -> Column:
    """Post-process a generated response: EOS cut, then bold markup to terminal escapes."""
    cut = cut_at_eos(c, extra_eos)
    return bold_to_ansi(cut) if ansi_bold else cut


def classify_command(c) -> Column:
    """What one line typed into the chat loop means: exit, clear, history, save, blank or message.

    Commands are compared lower-cased but *not* stripped (``" exit"`` is a message)."""
    c = _col(c)
    low = F.lower(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(low.isin(*EXIT_WORDS), F.lit("exit"))
        .when(low == "clear", F.lit("clear"))
        .when(low == "history", F.lit("history"))
        .when(low == "save", F.lit("save"))
        .when(is_blank(c), F.lit("blank"))
        .otherwise(F.lit("message"))
    )


def history_path(requested, ts, base: str = "history") -> Column:
    """Where a history record goes: an absolute path is kept, a relative one goes under ``base``,
    none or empty gives ``base/chat_YYYYmmdd_HHMMSS.json`` from ``ts``."""
    req = _col(requested)
    stamp = F.date_format(_col(ts), "yyyyMMdd_HHmmss")
    return (
        F.when(req.isNull() | (req == ""), F.concat(F.lit(f"{base}/chat_"), stamp, F.lit(".json")))
        .when(req.startswith("/"), req)
        .otherwise(F.concat(F.lit(f"{base}/"), req))
    )


def preview(c, n: int = HISTORY_PREVIEW_CHARS) -> Column:
    """First ``n`` code points plus "..." when the text is longer than ``n``."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(HISTORY_ELLIPSIS))).otherwise(c)
