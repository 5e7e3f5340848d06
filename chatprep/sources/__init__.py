"""Readers and writers."""

from .encoding import first_undecodable
from .files import list_artifacts, read_prompt_catalog, read_run_manifests
from .gate import read_gated_lines, write_gated
from .jsonl import (
    CHAT_SCHEMA,
    MESSAGES_TYPE,
    list_input_files,
    parse_chat_lines,
    read_chat_jsonl,
    read_jsonl_lines,
    read_unnumbered_lines,
)
from .sinks import run_manifest, write_history, write_run_manifest, write_training_set

__all__ = [
    "first_undecodable", "read_gated_lines", "write_gated", "list_artifacts", "read_prompt_catalog", "read_run_manifests",
    "CHAT_SCHEMA", "MESSAGES_TYPE", "parse_chat_lines", "read_chat_jsonl", "read_jsonl_lines",
    "list_input_files", "read_unnumbered_lines",
    "run_manifest", "write_history", "write_run_manifest", "write_training_set",
]
