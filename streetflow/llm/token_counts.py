"""Token counts: map-side two-tier lookup, without shuffling pre-tokens.

A pre-token here is a white-space piece, in which every finer piece of the
tokenizer lies whole.  One pass counts pre-tokens over all documents; each task
keeps a bounded table (lossy counting) and passes on its most frequent ones.
The token lengths of the ``table_size`` most frequent are broadcast; a miss goes
to the worker's bounded cache, and only a miss there to the library.  Counts
never depend on the table: it only saves work.

Defined cases: null or empty text has 0 bytes and 0 tokens; null and repeated ids
are kept row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.bpe import CACHE_BYTES, ENTRY_BYTES, encoder
from streetflow.llm.common import fresh_key, held, id_and_text, slices

#: Pre-tokens in the broadcast table: about 100 bytes each in a worker.
TABLE_SIZE = 100_000
#: Pre-tokens a task counts at once, and pre-tokens a task passes on.
TASK_ENTRIES, TASK_SENDS = 300_000, 60_000
#: Longest pre-token of the table, so it has at most TABLE_SIZE * TABLE_PIECE letters; longer ones are misses.
TABLE_PIECE = 64
#: Bytes of text that a task turns into Python objects at once.
SLICE_BYTES = 4 << 20

COUNTS = "doc_id long, n_bytes long, n_tokens long"


def frequent_lengths(docs: DataFrame, tokenizer: str, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """Token length of the most frequent pre-tokens; at most ``table_size`` entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(tokenizer), Counter()
        for part in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            for text in part.column(0).to_pylist():
                seen.update(p for p in enc.cut(text) or () if len(p) <= TABLE_PIECE)
            if len(seen) > TASK_ENTRIES:  # lossy counting: what is rare here goes
                seen = Counter(dict(seen.most_common(TASK_ENTRIES // 2)))
        top = seen.most_common(TASK_SENDS)
        yield pa.RecordBatch.from_pydict({"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    top = (
        docs.select("text").mapInArrow(count, "piece string, n long")
        .groupBy("piece").agg(F.sum("n").alias("n")).filter("n > 1")
        .orderBy(F.desc("n"), "piece").limit(table_size)
    )  # a top-k of fixed size: what the driver gets is bounded
    split = encoder(tokenizer)._split
    return {r["piece"]: len(split(r["piece"])) // 2 for r in top.select("piece").toLocalIterator()}


class _Lengths(dict):
    """The broadcast tier, with the worker's bounded cache behind it."""

    def __init__(self, frequent: dict[str, int], enc):
        super().__init__(frequent)
        self.enc, self.misses, self.size = enc, {}, 0

    def __missing__(self, piece: str) -> int:
        n = self.misses.get(piece)
        if n is None:
            self.size += len(piece) + ENTRY_BYTES
            if self.size > CACHE_BYTES:
                self.misses.clear()
                self.size = 0
            n = self.misses[piece] = len(self.enc._split(piece)) // 2
        return n


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE_SIZE
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every whole text."""
    docs = id_and_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer, table_size))

    key = fresh_key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        look = held("bpe", key, lambda: _Lengths(shared.value, enc))
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                n_bytes.append(len(text) if text.isascii() else len(text.encode()))
                cut = enc.cut(text)
                n_tokens.append(len(enc._library(text)) // 2 if cut is None else sum(map(look.__getitem__, cut)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, COUNTS)
