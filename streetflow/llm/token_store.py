"""Token-id files: an adaptive context-mixing range coder in independent blocks.

Documents are put in ascending id order by a range partition, encoded, and cut into
segments of whole documents; a table of segments is the file format.  A segment's ids
are coded in blocks of ``BLOCK`` ids.  Each block starts from an empty model and has
checksums of its code and of its ids, so blocks decode alone, and all blocks of a segment are coded side by
side, one array element each.

The model predicts an id from the last two ids (order 2) and the last one (order 1) of
its block, each with a confidence, and from the segment's id counts (order 0).  For
each state of both confidences it learns how often order 2 is right, and how often
order 1 is right where order 2 isn't; these shares mix the three predictions into one
distribution, which drives a range coder of 64 bits that puts out 32-bit words.

Defined cases: a null or empty text is a document of the end id alone; null ids sort
first; rows that repeat an id are ordered by the hash of their texts and stay apart; an
empty table gives an empty table of segments; other columns are not read.  A block whose
checksum fails raises an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.bpe import encoder
from streetflow.llm.common import id_and_text, slices

BLOCK, SEGMENT = 2048, 1 << 22
MAGIC = b"TIDS\x01"

#: Bytes of text that a task turns into Python objects at once.
SLICE_BYTES = 4 << 20
SEGMENTS = "part int, segment int, before long, n_ids long, doc_ids array<long>, doc_tokens array<long>, data binary"
DECODED = "doc_id long, start long, n_tokens long, ids binary"

U = np.uint64
#: Bits of the order-0 scale and of the mixing scale; slots of the order-1 and order-2 tables.
ZERO_BITS, MIX_BITS, SLOTS_1, SLOTS_2 = 18, 10, 1024, 2048
TOTAL_BITS = ZERO_BITS + MIX_BITS
#: Confidences run from 0 to 3; shares of 2**16 move by 1/2**RATE.
STATES, RATE = 16, 4


class Zero:
    """Order 0: the ids of a segment on a scale of ``2 ** ZERO_BITS``, every one of them at least 1."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        self.symbols, self.sizes = symbols, sizes
        top = int(symbols[-1]) + 1
        self.size, self.first = np.zeros(top, np.int32), np.zeros(top, np.int32)
        self.size[symbols] = sizes
        self.first[symbols] = np.cumsum(sizes) - sizes

    def at(self) -> np.ndarray:
        """The id at each place of the scale."""
        return np.repeat(self.symbols.astype(np.uint16), self.sizes)

    @classmethod
    def of(cls, ids: np.ndarray) -> Zero:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        sizes = 1 + counts[symbols] * ((1 << ZERO_BITS) - len(symbols)) // len(ids)
        sizes[sizes.argmax()] += (1 << ZERO_BITS) - sizes.sum()
        return cls(symbols, sizes)

    def packed(self) -> bytes:
        return zlib.compress(np.diff(self.symbols, prepend=0).astype("<u2").tobytes() + self.sizes.astype("<u4").tobytes())

    @classmethod
    def unpacked(cls, data: bytes, n: int) -> Zero:
        raw = zlib.decompress(data)
        return cls(np.cumsum(np.frombuffer(raw, "<u2", n).astype(np.int64)), np.frombuffer(raw, "<u4", n, 2 * n).astype(np.int64))


class Mixer:
    """The models of many blocks: one row each, all taking a step at once.

    The arrays of a step are kept and written over: a step makes no new ones.
    """

    def __init__(self, lanes: int, zero: Zero):
        self.zero = zero
        self.row1, self.row2, self.rows = (np.arange(lanes) * k for k in (SLOTS_1, SLOTS_2, STATES))
        self.one, self.two = np.zeros(lanes * SLOTS_1, np.int32), np.zeros(lanes * SLOTS_2, np.int32)
        self.share2, self.share1 = np.full(lanes * STATES, 1 << 12, np.int32), np.full(lanes * STATES, 1 << 12, np.int32)
        self.slot1, self.slot2, self.state, self.x, self.last, self.mix1, self.mix2 = np.zeros((7, lanes), np.int64)
        self.e1, self.e2, self.id1, self.id2, self.s1, self.s2, self.f1, self.f2, self.f12, self.rest = np.zeros((10, lanes), np.int32)
        self.first, self.size, self.part, self.new, self.up = np.zeros((5, lanes), np.int32)
        self.mask = np.zeros(lanes, bool)

    def predict(self) -> None:
        """Order 2's and order 1's ids, and the parts of the mixing scale that they get."""
        np.copyto(self.slot1, self.mix1)
        np.add(self.mix1, self.mix2, out=self.slot2)
        for table, slot, row, top, entry, known in (
            (self.one, self.slot1, self.row1, SLOTS_1 - 1, self.e1, self.id1),
            (self.two, self.slot2, self.row2, SLOTS_2 - 1, self.e2, self.id2),
        ):
            slot >>= 5
            slot &= top
            slot += row
            table.take(slot, out=entry, mode="clip")
            np.bitwise_and(entry, 0xFFFF, out=known)
        np.right_shift(self.e2, 16, out=self.new)
        self.new <<= 2
        np.right_shift(self.e1, 16, out=self.up)
        self.new += self.up
        np.add(self.rows, self.new, out=self.state)
        self.share2.take(self.state, out=self.s2, mode="clip")
        self.share1.take(self.state, out=self.s1, mode="clip")
        f1, f2 = self.f1, self.f2
        np.multiply(self.s2, 999, out=f2)
        f2 >>= 16
        f2 += 1
        np.subtract(1015, f2, out=f1)
        f1 *= self.s1
        f1 >>= 16
        f1 += 1
        np.putmask(f1, np.equal(self.id1, self.id2, out=self.mask), 1)
        np.add(f2, f1, out=self.f12)
        np.subtract(1 << MIX_BITS, self.f12, out=self.rest)

    def interval(self, ids: np.ndarray, hit2: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids lie on the whole scale, and their sizes; ``hit``: order 2 or order 1 was right."""
        np.copyto(self.x, ids)
        first, size, part = self.first, self.size, self.part
        self.zero.first.take(self.x, out=first, mode="clip")
        self.zero.size.take(self.x, out=size, mode="clip")
        first *= self.rest
        size *= self.rest
        np.left_shift(self.f12, ZERO_BITS, out=part)
        first += part
        np.left_shift(self.f1, ZERO_BITS, out=part)
        np.putmask(size, hit, part)
        np.left_shift(self.f2, ZERO_BITS, out=part)
        np.putmask(first, hit, part)
        np.putmask(size, hit2, part)
        np.putmask(first, hit2, 0)
        return first, size

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take the ids that ``interval`` had; ``hit1``: order 1 was right, whether order 2 was or not."""
        new, up, mask = self.new, self.up, self.mask
        for shares, share, hit in ((self.share2, self.s2, hit2), (self.share1, self.s1, hit1)):
            np.copyto(new, hit)
            new *= 65535
            new -= share
            new >>= RATE
            new += share
            if hit is hit1:  # order 1 isn't asked where order 2 was right
                np.putmask(new, hit2, share)
            shares[self.state] = new
        fresh = np.add(ids, 1 << 16, out=self.part)
        for table, slot, entry, hit in ((self.two, self.slot2, self.e2, hit2), (self.one, self.slot1, self.e1, hit1)):
            np.subtract(entry, 1 << 16, out=new)  # one down; at 0 another id
            np.putmask(new, np.less(entry, 2 << 16, out=mask), fresh)
            np.add(entry, 1 << 16, out=up)  # one up, to 3
            np.putmask(up, np.greater_equal(up, 4 << 16, out=mask), entry)
            np.putmask(new, hit, up)
            table[slot] = new
        np.multiply(self.last, 30011, out=self.mix2)
        self.x, self.last = self.last, self.x
        np.multiply(self.last, 40503, out=self.mix1)


class Range:
    """The intervals of many range coders."""

    def __init__(self, lanes: int):
        self.low, self.span = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
        self.unit, self.wide, self.mask = np.zeros(lanes, U), np.zeros(lanes, U), np.zeros(lanes, bool)

    def units(self) -> np.ndarray:
        return np.right_shift(self.span, U(TOTAL_BITS), out=self.unit)

    def narrow(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go to the part of the interval, by ``units``; the lanes that put out a word, and their words."""
        np.copyto(self.wide, first, casting="unsafe")
        self.wide *= self.unit
        self.low += self.wide
        np.copyto(self.wide, size, casting="unsafe")
        np.multiply(self.wide, self.unit, out=self.span)
        out = np.flatnonzero(np.less(self.span, U(1 << 32), out=self.mask))
        low, span = self.low[out], self.span[out]
        cut = (low ^ (low + span)) >= U(1 << 32)  # the top words differ though the span is short: it ends where they do
        np.putmask(span, cut, (U(0) - low) & U(0xFFFFFFFF))
        self.low[out] = low << U(32)
        self.span[out] = span << U(32)
        return out, low >> U(32)


def encode_segment(ids: np.ndarray) -> bytes:
    """The ids (uint16, one at least) as one segment."""
    n, steps = len(ids), min(BLOCK, len(ids))
    lanes = -(-n // BLOCK)
    zero = Zero.of(ids)
    grid = np.full(lanes * BLOCK if lanes > 1 else steps, ids[-1], np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, -1).T)
    model, coder = Mixer(lanes, zero), Range(lanes)
    words, sent = np.zeros((lanes, steps + 2), "<u4"), np.arange(lanes) * (steps + 2)
    flat, start = words.reshape(-1), sent.copy()
    hit2, hit1, hit = np.zeros((3, lanes), bool)
    with np.errstate(over="ignore"):
        for x in grid:
            model.predict()
            np.equal(x, model.id2, out=hit2)
            np.equal(x, model.id1, out=hit1)
            first, size = model.interval(x, hit2, np.logical_or(hit2, hit1, out=hit))
            coder.units()
            out, word = coder.narrow(first, size)
            at = sent[out]
            flat[at] = word
            sent[out] = at + 1
            model.learn(x, hit2, hit1)
    flat[sent] = coder.low >> U(32)
    flat[sent + 1] = coder.low & U(0xFFFFFFFF)
    sent += 2 - start
    raw, table = ids.astype("<u2"), zero.packed()
    coded = [words[i, : sent[i]].tobytes() for i in range(lanes)]
    index = [(sent[i], zlib.crc32(coded[i]), zlib.crc32(raw[i * BLOCK : (i + 1) * BLOCK].tobytes())) for i in range(lanes)]
    head = MAGIC + struct.pack("<QIII", n, BLOCK, len(zero.symbols), len(table))
    return head + table + np.array(index, "<u4").tobytes() + b"".join(coded)


def decode_segment(data: bytes, blocks: slice = slice(None)) -> np.ndarray:
    """The ids of a segment, or of some of its blocks, as uint16."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment of token ids")
    n, block, n_symbols, n_table = struct.unpack_from("<QIII", data, len(MAGIC))
    at = len(MAGIC) + 20
    zero = Zero.unpacked(data[at : at + n_table], n_symbols)
    at += n_table
    lanes = -(-n // block)
    index = np.frombuffer(data, "<u4", 3 * lanes, at).reshape(lanes, 3).astype(np.int64)
    words = np.frombuffer(data, "<u4", offset=at + 12 * lanes)
    if index[:, 0].sum() != len(words):
        raise ValueError("a segment of token ids is cut short")
    begin = np.cumsum(index[:, 0]) - index[:, 0]
    chosen = np.arange(lanes)[blocks]
    for lane in chosen:
        if zlib.crc32(words[begin[lane] : begin[lane] + index[lane, 0]].tobytes()) != index[lane, 1]:
            raise ValueError(f"block {lane} of a segment of token ids is damaged")
    grid = _decode(words, begin[blocks], min(block, n), zero)
    out = []
    for row, lane in zip(grid.T, chosen, strict=True):
        ids = row[: min(block, n - lane * block)].astype("<u2")
        if zlib.crc32(ids.tobytes()) != index[lane, 2]:
            raise ValueError(f"block {lane} of a segment of token ids was not decoded rightly")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, "<u2")


def _decode(words: np.ndarray, begin: np.ndarray, steps: int, zero: Zero) -> np.ndarray:
    lanes = len(begin)
    model, coder, ids_at = Mixer(lanes, zero), Range(lanes), zero.at()
    words = np.append(words, np.zeros(2, "<u4"))
    code = (words[begin].astype(U) << U(32)) | words[begin + 1]
    at = begin + 2
    grid = np.zeros((steps, lanes), np.int32)
    last = U((1 << TOTAL_BITS) - 1)
    above, where, bound, place = np.zeros(lanes, U), np.zeros(lanes, np.int32), np.zeros(lanes, np.int32), np.zeros(lanes, np.int64)
    rare, (hit2, hit1, hit) = np.zeros(lanes, np.uint16), np.zeros((3, lanes), bool)
    with np.errstate(over="ignore"):
        for x in grid:
            model.predict()
            np.subtract(code, coder.low, out=above)
            above //= coder.units()
            np.minimum(above, last, out=above)
            np.copyto(where, above, casting="unsafe")
            np.less(where, np.left_shift(model.f2, ZERO_BITS, out=bound), out=hit2)
            np.less(where, np.left_shift(model.f12, ZERO_BITS, out=bound), out=hit)
            where -= bound
            np.maximum(where, 0, out=where)
            where //= model.rest
            np.copyto(place, where)
            ids_at.take(place, out=rare, mode="clip")
            np.copyto(x, rare)
            np.putmask(x, hit, model.id1)
            np.putmask(x, hit2, model.id2)
            first, size = model.interval(x, hit2, hit)
            out, _ = coder.narrow(first, size)
            next_at = at[out]
            code[out] = (code[out] << U(32)) | words[next_at]
            at[out] = next_at + 1
            model.learn(x, hit2, np.equal(x, model.id1, out=hit1))
    return grid


def _segment(part: int, number: int, before: int, docs: list, texts: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(texts), "<u2")
    sizes = [len(t) // 2 for t in texts]
    columns = [[part], [number], [before], [len(ids)], [docs], [sizes], [encode_segment(ids)]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = [f.split()[0] for f in SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def segments(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' segments in ascending order of (part, segment)."""
    end = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        held, texts, size, number, before = [], [], 0, 0, 0
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = enc.ids16(text) + end
                if texts and size + len(ids) // 2 > SEGMENT:
                    yield _segment(part, number, before, held, texts)
                    number, before = number + 1, before + size
                    held, texts, size = [], [], 0
                held.append(doc)
                texts.append(ids)
                size += len(ids) // 2
        if texts:
            yield _segment(part, number, before, held, texts)

    rows = id_and_text(docs, id_col, text_col)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents' ids as token-id files under ``path``."""
    segments(docs, tokenizer, end_id, id_col, text_col).write.option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from token-id files; ids as little-endian uint32."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, at = [], 0
    for r in totals:  # one row a written partition
        base.append((r["part"], at))
        at += r["n"]
    starts = F.broadcast(spark.createDataFrame(base, "part int, base long"))
    placed = files.join(starts, "part").select((F.col("base") + F.col("before")).alias("at"), "doc_ids", "doc_tokens", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, docs, sizes, data = (c[i].as_py() for c in batch.columns)
                ids = decode_segment(data).astype("<u4")
                ends = np.cumsum(sizes)
                texts = [ids[b - n : b].tobytes() for n, b in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(at + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(run, DECODED)
