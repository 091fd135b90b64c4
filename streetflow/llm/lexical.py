"""Ranked lexical search with norm buckets (in the manner of LEMP).

A document is a sparse vector of impacts, one for each term that some item has:
``impact = (10^9 * tf) div (1000 * tf + 8 * m)``, weighted by the term's ``w``; an item is
the vector of its terms' counts, and a score is their inner product.

1. One narrow pass counts each document's terms and keeps those of the items' vocabulary;
   the document counts (N, L, df) come from these counts.
2. The vectors get their length and are written in order of length, longest first.  No
   text or vector is shuffled: each written part has its own order.
3. The documents are searched in two turns: first the longest sixteenth, which gives a
   lower bound of every item's k-th score, then the rest, of which the scan already skips
   what is too short for all items.
4. A task takes its vectors in buckets of ``BUCKET`` and goes through the items:
   *Cauchy-Schwarz* skips the bucket, or its shorter documents, where
   |item| * |document| can't reach the item's k-th score so far.  *Coordinate bounds*: the
   bucket's greatest impact of each term, by which the terms are ordered; those whose
   bounds together stay below the k-th score can't carry a document alone, so only
   documents that hold one of the other terms are met; of these go those whose partial
   score plus the bound (or plus |rest of the item| * |document|) stays below.
5. Survivors are rescored exactly, in 64-bit integers; all bounds are strict, so ties stay.

Items travel in batches of at most ``ITEM_TERMS`` (item, term) entries, or one item;
results are exact, and a task gives on its ``k`` best for each item.

Defined cases: a null or empty text, or one without terms, is no document of N and is
never found; rows that repeat a document id are documents of their own, told apart by
nothing in the result; a null document id comes after all others of its score; items
without terms, or whose terms no document holds, have no rows; rows that repeat an item id
are one item with the terms of all; a null item id has no rows; equal scores go to the
smaller document id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.common import column, keep, slices
from streetflow.llm.vectors import dealt

#: Lower-cased runs of ASCII letters and digits and of all bytes of other characters.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")
WINDOW_BYTES, SLICE_BYTES = 1 << 20, 4 << 20
#: (item, term) entries of one pass, and vectors of a bucket.
ITEM_TERMS, BUCKET = 250_000, 4096
#: Part of the documents, by length, that the first turn searches.
FIRST_PART = 1 / 16

COUNTED = "doc_id long, n long, terms array<int>, tfs array<long>"
VECTORS = "doc_id long, length double, terms array<int>, impacts array<int>"
FOUND = "item int, doc_id long, score long"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term; a long text is read in windows that end between terms."""
    low = text.lower()  # of bytes: A-Z only
    if len(low) <= WINDOW_BYTES:
        return Counter(TERM.findall(low))
    out: Counter = Counter()
    at = 0
    while at < len(low):
        cut = BETWEEN.search(low, at + WINDOW_BYTES)
        end = cut.end() if cut else len(low)
        out.update(TERM.findall(low, at, end))
        at = end
    return out


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, term, times)`` of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = term_counts(bytes(text))
                cols = [pa.array([i] * len(counts), batch.schema.field(0).type), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["item_id", "term", "times"])

    named = items.select(column(id_col).alias("item_id"), column(text_col).cast("binary").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")
    kind = named.schema["item_id"].dataType.simpleString()
    return named.mapInArrow(run, f"item_id {kind}, term binary, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Every document's number of terms, and the occurrences of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                n, terms, tfs, sizes = [], [], [], [0]
                for text in part.column(1):
                    counts = term_counts(text.as_py() or b"")
                    mine = sorted((known[t], c) for t, c in counts.items() if t in known)
                    n.append(counts.total())
                    terms += [t for t, _ in mine]
                    tfs += [c for _, c in mine]
                    sizes.append(len(terms))
                ends = pa.array(sizes, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, k)) for v, k in ((terms, pa.int32()), (tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, COUNTED)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges) of a column of lists."""
    ends = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(), ends - ends[0]


def impact_vectors(counted: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """Impacts and length of each document's vector, longest first in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, edge = _flat(batch.column(2))
            tfs, _ = _flat(batch.column(3))
            m = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, np.diff(edge)))
            length = np.sqrt(np.add.reduceat((weights[terms] * impacts).astype(float) ** 2, edge[:-1]))
            lists = [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(v.astype(np.int32))) for v in (terms, impacts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), *lists], names=["doc_id", "length", "terms", "impacts"])

    return counted.filter("size(terms) > 0").mapInArrow(run, VECTORS).sortWithinPartitions(F.desc("length"))


class Items:
    """The items of one batch as sparse vectors, with a lower bound of each one's k-th score."""

    def __init__(self, rows: list, weights: np.ndarray, terms: dict[bytes, int]):
        by_item: dict = {}
        for r in rows:
            if weights[terms[bytes(r.term)]]:
                by_item.setdefault(r.item_id, []).append((terms[bytes(r.term)], r.times))
        self.ids = list(by_item)
        self.terms = [np.array([t for t, _ in v]) for v in by_item.values()]
        self.times = [np.array([c for _, c in v], np.int64) for v in by_item.values()]
        self.norms = [float(np.sqrt((c.astype(float) ** 2).sum())) for c in self.times]
        self.least = [0] * len(self.ids)


class Bucket:
    """Documents of one bucket, longest first, by row and by term."""

    def __init__(self, length: np.ndarray, terms: np.ndarray, impacts: np.ndarray, edge: np.ndarray, weights: np.ndarray):
        self.length, self.terms, self.edge = length, terms, edge
        self.value = weights[terms] * impacts.astype(np.int64)
        row = np.repeat(np.arange(len(length)), np.diff(edge))
        order = np.argsort(terms, kind="stable")
        self.rows, self.values = row[order], self.value[order]
        self.column = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, terms, self.value)
        self.dense = np.zeros(len(weights), np.int64)

    def survivors(self, terms: np.ndarray, times: np.ndarray, norm: float, least: int) -> np.ndarray:
        """Rows whose bounds reach ``least``; all that hold a term if that is 0."""
        long_enough = np.searchsorted(-self.length, -(least / norm) * (1 - 1e-9), side="right")
        bound = times * self.most[terms]
        if not long_enough or bound.sum() < least or not bound.any():
            return np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")
        terms, times, bound = terms[order], times[order], bound[order]
        rest = np.cumsum(bound[::-1])[::-1]  # of the terms from each on
        lead = int(np.count_nonzero((rest >= least) & (bound > 0)))
        got = np.zeros(len(self.length))
        held = np.zeros(len(self.length), bool)
        for t, c in zip(terms[:lead].tolist(), times[:lead].tolist(), strict=True):
            rows = self.rows[self.column[t] : self.column[t + 1]]
            got[rows] += c * self.values[self.column[t] : self.column[t + 1]]
            held[rows] = True
        rows = np.flatnonzero(held[:long_enough])
        if lead < len(terms):
            others = np.sqrt(float((times[lead:].astype(float) ** 2).sum())) * self.length[rows]
            rows = rows[(got[rows] + np.minimum(rest[lead], others)) * (1 + 1e-9) >= least]
        else:
            rows = rows[got[rows] * (1 + 1e-9) >= least]
        return rows

    def scores(self, rows: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        self.dense[terms] = times
        sizes = self.edge[rows + 1] - self.edge[rows]
        begin = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.edge[rows] - begin, sizes)
        out = np.add.reduceat(self.dense[self.terms[at]] * self.value[at], begin)
        self.dense[terms] = 0
        return out


def best_of(vectors: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """``(item, doc_id, score)``: for each item the ``k`` best documents of each task."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        none = np.zeros(0, np.int64)
        best = [(none, none, none)] * len(items.ids)  # scores, whether the id is null, ids
        least = list(items.least)
        for whole in batches:
            for s in range(0, whole.num_rows, BUCKET):
                batch = whole.slice(s, BUCKET)
                order = np.argsort(-batch.column(1).to_numpy(), kind="stable")  # already so, but where files meet
                batch = batch.take(pa.array(order))
                nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = batch.column(0).fill_null(0).to_numpy()
                terms, edge = _flat(batch.column(2))
                bucket = Bucket(batch.column(1).to_numpy(), terms, _flat(batch.column(3))[0], edge, weights)
                for q in range(len(items.ids)):
                    rows = bucket.survivors(items.terms[q], items.times[q], items.norms[q], least[q])
                    if not len(rows):
                        continue
                    got = bucket.scores(rows, items.terms[q], items.times[q])
                    rows, got = rows[got > 0], got[got > 0]
                    scores, null, who = (np.concatenate(p) for p in zip(best[q], (got, nulls[rows], ids[rows]), strict=True))
                    first = np.lexsort((who, null, -scores))[:k]
                    best[q] = scores[first], null[first], who[first]
                    if len(first) == k:
                        least[q] = max(least[q], int(scores[first[-1]]))
        of = np.repeat(np.arange(len(best)), [len(b[0]) for b in best]).astype(np.int32)
        scores, null, who = (np.concatenate([b[c] for b in best] or [none]) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(who, pa.int64(), mask=null > 0), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    docs = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("binary").alias("text")).filter("text IS NOT NULL")
    asked = keep(item_terms(items, item_col, item_text_col), "lexical-items")
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in dealt(asked, "item_id", ITEM_TERMS):
        rows = part.orderBy("item_id", "term").collect()
        if rows:
            out = out.union(_search(docs, rows, kind, k))
    return out


def _search(docs: DataFrame, rows: list, kind: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    counted = keep(count_terms(docs, vocabulary), "lexical-counts")
    total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the vocabulary
        weights[r.t] = weight(total.docs, r["count"])
    items = Items(rows, weights, vocabulary)
    empty = f"item_id {kind}, rank int, doc_id long, score long"
    if not items.ids:
        return spark.createDataFrame([], empty)
    vectors = keep(impact_vectors(counted, total.docs, total.terms, weights), "lexical-vectors")
    cut = vectors.agg(F.percentile_approx("length", 1 - FIRST_PART)).first()[0] or 0.0
    first = keep(best_of(vectors.filter(F.col("length") >= cut), items, weights, k), "lexical-first")
    for r in _ranked(first, k).filter(F.col("rank") == k).collect():  # one row an item
        items.least[r["item"]] = r["score"]
    short = min(b / n for b, n in zip(items.least, items.norms, strict=True)) * (1 - 1e-9)
    second = best_of(vectors.filter((F.col("length") < cut) & (F.col("length") >= short)), items, weights, k)
    names = spark.createDataFrame([(i, v) for i, v in enumerate(items.ids)], f"item int, item_id {kind}")
    ranked = _ranked(first.union(second), k).join(F.broadcast(names), "item")  # at most ITEM_TERMS items
    return ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
