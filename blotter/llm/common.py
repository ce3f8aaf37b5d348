"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch may hold, so that a worker's memory is bounded by this many texts.
BATCH_ROWS = 500

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches for long texts, and this package's modules on the
    executors (the functions below refer to them by name)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_blotter_shipped", None):
        return
    import tempfile

    # the archive is read from the driver by Spark's own file service
    path = os.path.join(tempfile.mkdtemp(prefix="blotter-zip-"), "blotter_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._blotter_shipped = True


def smallest(docs: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``rows`` rows, those of the smallest hash of id and text: the same on every run,
    null and hot ids with the others, chosen by their hash before any is gathered."""
    return docs.orderBy(F.xxhash64(id_col, text_col), id_col, text_col).limit(rows)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null becomes the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


#: What this worker process keeps for its next tasks of the same kind; one entry at most.
_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """The worker's state under ``key``, made anew if its last task was of another kind."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop what the worker keeps: it serves all stages of a job, and their states must not add up."""
    _KEPT.clear()


def map_docs(
    docs: DataFrame,
    columns: list[str],
    rows: Callable[..., dict],
    schema: str,
    start: Callable[[], object] | None = None,
    keeps: bool = False,
) -> DataFrame:
    """One output row per input row, without a shuffle.

    Only ``columns`` are read; ``rows(state, *column lists)`` gets the lists of
    a batch and returns one list per output column after the first ``columns``
    entry, which is passed through. ``start`` builds a task's state once; with
    ``keeps`` it may take what the worker has ``kept``, which goes otherwise."""
    prepare(docs.sparkSession)
    target = _arrow_schema(docs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        state = start() if start else None
        for batch in batches:
            out = rows(state, *[batch.column(i).to_pylist() for i in range(len(columns))])
            first = batch.column(0)
            arrays = [
                first.cast(f.type) if i == 0 else _column(out[f.name], f.type) for i, f in enumerate(target)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.select(*[docs[c] for c in columns]).mapInArrow(run, schema)


def _column(values: list | pa.Array, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _arrow_schema(docs: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def rewrite_docs(
    docs: DataFrame,
    text_col: str,
    change: Callable[[object, pa.RecordBatch, list[str]], pa.RecordBatch],
    start: Callable[[], object] | None = None,
) -> DataFrame:
    """A filtering or rewriting stage: whole rows pass through Arrow and keep
    the input's schema, so no join brings columns back and no name clashes."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        state = start() if start else None
        for batch in batches:
            yield change(state, batch, texts_of(batch.column(at)))

    return docs.mapInArrow(run, docs.schema)


def replace_column(batch: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    """The batch with one column's values replaced; a missing column is left out."""
    if name not in batch.schema.names:
        return batch
    i = batch.schema.names.index(name)
    arrays = list(batch.columns)
    arrays[i] = pa.array(values, batch.schema.field(i).type)
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def code_points(text: str) -> np.ndarray:
    """The text's code points as uint32."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
