"""DataFrame -> DataFrame operators."""

from . import batches, messages, ranking, registry, sessions, tokens, udf, validate

__all__ = ["batches", "messages", "ranking", "registry", "sessions", "tokens", "udf", "validate"]
