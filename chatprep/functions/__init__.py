"""Column -> Column functions."""

from .json import STATUSES, is_valid_json, line_status, python_status, with_status
from .text import (
    EOS_CANDIDATES,
    EXIT_WORDS,
    bold_to_ansi,
    classify_command,
    clean_response,
    cut_at_eos,
    ensure_eos,
    history_path,
    is_blank,
    preview,
    py_strip,
)

__all__ = [
    "STATUSES", "is_valid_json", "line_status", "python_status", "with_status",
    "EOS_CANDIDATES", "EXIT_WORDS", "bold_to_ansi", "classify_command", "clean_response",
    "cut_at_eos", "ensure_eos", "history_path", "is_blank", "preview", "py_strip",
]
