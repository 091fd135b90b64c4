"""Packing: concatenate and cut, with global offsets from partition totals.

Pass 1 encodes every document in its input partition and writes its ids with
the number of ids before it *in that partition*.  The totals of the partitions
(one row each) give, by a prefix sum, the global offset at which each partition
starts.  Pass 2 needs no order and no shuffle: a document's global offset is its
partition's start plus its local one, and the windows ``[k * size, (k + 1) * size)``
cut it.  Every sequence but the last is full.

Defined cases: a null or empty text is a document of the end id alone; a null
document id is kept as null; repeated ids are packed row by row; an empty table
gives no pieces; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.bpe import encoder
from streetflow.llm.common import id_and_text, keep, slices

#: Bytes of texts or ids that a task turns into Python objects at once.
SLICE_BYTES = 4 << 20
ENCODED = "part int, local long, doc_id long, n long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def encode_partitions(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """One row per document: its partition, the ids before it there, and its ids as uint16."""
    end = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids = [enc.ids16(t) + end for t in rows.column(1).to_pylist()]
                n = np.fromiter((len(x) // 2 for x in ids), np.int64, len(ids))
                local = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), pa.array(local), rows.column(0), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "local", "doc_id", "n", "ids"],
                )

    return docs.mapInArrow(run, ENCODED)


def partition_starts(encoded: DataFrame) -> DataFrame:
    """``(part, base)``: the ids in all partitions before this one.

    One row per written partition, i.e. bounded by the number of input splits,
    not by documents; the prefix sum over those few rows is taken on the driver.
    """
    totals = encoded.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    rows, base = [], 0
    for r in totals:
        rows.append((r["part"], base))
        base += r["n"]
    return encoded.sparkSession.createDataFrame(rows, "part int, base long")


def cut(placed: DataFrame, size: int) -> DataFrame:
    """Pieces of documents with a global offset (``at``), cut at multiples of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "ids", SLICE_BYTES)):
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, at, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                n, start = len(ids), 0
                while start < n:
                    seq, offset = divmod(at + start, size)
                    stop = min(n, start + size - offset)
                    for c, v in zip(out, (doc, start, stop - start, n, seq, offset, ids[start:stop].tobytes()), strict=True):
                        c.append(v)
                    start = stop
            types = [pa.int64()] * 6 + [pa.binary()]
            names = [f.split()[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return placed.select("doc_id", "at", "ids").mapInArrow(run, PIECES)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``.

    ``ids`` are the piece's ids as little-endian uint32; a sequence's pieces lie
    gapless from offset 0, and a consumer pads the last sequence to ``size``.
    """
    encoded = keep(encode_partitions(id_and_text(docs, id_col, text_col), tokenizer, end_id), "packing", compression="zstd")
    starts = F.broadcast(partition_starts(encoded))  # one row per input split
    placed = encoded.join(starts, "part").select("doc_id", (F.col("base") + F.col("local")).alias("at"), "ids")
    return cut(placed, size)
