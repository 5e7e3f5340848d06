"""chatprep: the data side of chat-model fine-tuning, expressed as Spark jobs.

Subpackages:
  functions  Column -> Column expressions (strip, JSON checks, EOS handling, commands)
  sources    readers (JSONL lines, chat JSONL, prompt catalog, manifests, listings) and sinks
  operators  DataFrame -> DataFrame operators (validation, messages, tokens, batches,
             sessions, run registry, the per-example Python hook)
  plans      end-to-end plans built from operators, and data sets derived from the driver tables
  streaming  the session replay as a Structured Streaming query
"""

import sys as _sys

try:  # ship this package's functions to Python workers by value when it is not installed there
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
