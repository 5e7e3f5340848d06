"""The per-example Python hook: a user function applied to every example, in Arrow batches.

``map_examples(df, fn, schema)`` calls ``fn(row_dict) -> dict`` for each row inside ``mapInArrow`` (batches of
``spark.sql.execution.arrow.maxRecordsPerBatch`` rows); values keep their types, so a NULL does not turn
integers into floats. An exception makes the example an error row: ``on_error="drop"`` leaves it out, "keep"
keeps it with the message in ``error``, "split" returns the good examples and the errors apart.
Nothing is sent to the driver. This is the place to plug a real sub-word tokenizer or chat template in
instead of the table-driven ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_examples(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType | str,
                 on_error: str = "drop", keep: list[str] | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Apply ``fn`` to every row; output = ``keep`` columns (copied) + ``schema`` fields + ``error``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    keep = list(keep or [])
    out_schema = T.StructType([df.schema[k] for k in keep] + list(schema.fields) + [T.StructField("error", T.StringType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(schema)
        for batch in batches:
            results, errors = [], []
            for record in batch.to_pylist():
                try:
                    result, error = fn(record), None
                    for n in names:  # a value that does not fit its type is this example's error
                        pa.scalar(result.get(n), kinds.field(n).type)
                except Exception as ex:  # noqa: BLE001 - the example is reported, not fatal
                    result, error = {}, f"{type(ex).__name__}: {ex}"
                results.append(result)
                errors.append(error)
            made = [pa.array([r.get(n) for r in results], kinds.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *made, pa.array(errors, pa.string())],
                                             names=[*keep, *names, "error"])

    mapped = df.mapInArrow(run, out_schema)
    if on_error == "split":
        return mapped.filter(F.col("error").isNull()).drop("error"), mapped.filter(F.col("error").isNotNull()).select(*keep, "error")
    return mapped.filter(F.col("error").isNull()) if on_error == "drop" else mapped
