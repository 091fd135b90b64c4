"""Helpers shared by the operators: reading, shared-folder tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType

from streetflow.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    The written table cuts the lineage, so a lost executor re-reads files
    instead of re-running what made them.
    """
    path = work_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of up to four numbers that may be broadcast once counted: some 16 MB.
BROADCAST_ROWS = 250_000


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of few narrow columns), marked for broadcast if it has at most
    ``most`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def column(name: str) -> Column:
    """The column called exactly ``name`` (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` only; a null text is the empty text."""
    return df.select(
        column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text")
    )


def crc32_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as decimal text, modulo ``m``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or a variant that no column in ``taken`` has (case aside)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column_name: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Zero-copy row slices of about ``max_bytes`` of one string column; one row at least."""
    arr = batch.column(batch.schema.get_field_index(column_name))
    import numpy as np

    ends = string_offsets(arr)[1:]
    start, n = 0, len(arr)
    base = int(string_offsets(arr)[0]) if n else 0
    while start < n:
        stop = int(np.searchsorted(ends, base + max_bytes, side="right"))
        stop = min(n, max(start + 1, stop))
        yield batch.slice(start, stop - start)
        base = int(ends[stop - 1])
        start = stop


def string_offsets(arr: pa.Array):
    """Byte offsets of a string or binary array's values in its data buffer."""
    import numpy as np

    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if len(arr) == 0:
        return np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)
    return offs[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def string_bytes(arr: pa.Array):
    """(uint8 data, offsets from 0) of a string array without copying each value."""
    import numpy as np

    offs = string_offsets(arr)
    buf = arr.buffers()[2] if len(arr) else None
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


#: What this worker process keeps between tasks: the stage it serves, and that stage's objects by key.
_HELD: tuple[str, dict] = ("", {})


def held(stage: str, key, make: Callable):
    """An object that a worker keeps over the tasks of one stage (a tokenizer with its caches,
    a model unpacked for use).

    Workers are used again by later stages: when a task of another stage asks, everything kept
    for the former one is dropped and the freed memory goes back to the system.  ``key`` tells
    apart what one stage may hold at once; a key made by ``fresh_key`` belongs to one broadcast."""
    global _HELD
    if _HELD[0] != stage:
        _HELD = (stage, {})
        release()
    if key not in _HELD[1]:
        if len(_HELD[1]) >= 4:
            _HELD[1].clear()
        _HELD[1][key] = make()
        release()
    return _HELD[1][key]


def fresh_key() -> str:
    """A key for what is made of one broadcast value, drawn on the driver."""
    return uuid.uuid4().hex


def release() -> None:
    """Give memory that is free inside the process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def as_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


STRING, LONG = StringType(), LongType()
