"""Hard negatives by Fagin's threshold algorithm, over integer inner products.

Components become floor(256 * x), and a row's score for an anchor is their inner
product.  A task takes its candidates in blocks of at most ``BLOCK`` rows and keeps,
for each dimension, the block's rows in order of that component.  For an anchor it
reads each list from the end that its own component's sign asks for (*sorted access*),
scores each row met for the first time (*random access*), and adds up what the next
entries of all lists could give together: the *threshold*, which no row unseen so far
can pass.  Positives are sought in the lists of the anchor's label until the threshold
falls strictly below the ``POSITIVES``-th score; negatives in the lists of the whole
block until, for each positive's window of scores, it falls strictly below the window's
``NEGATIVES``-th score, or below the window.  Depths double from turn to turn.

Anchors go over the candidates in batches of at most ``ANCHORS``, broadcast; the
candidates aren't shuffled, and a task gives on the few best rows of each anchor (or
window), never pairs.  Results are exact.

Defined cases: rows without id or label, and vectors that are null or hold a null or
non-finite component, take no part; a zero vector does, with score 0, and so does an
empty one, among empty ones; vectors whose integers' squares add up to 2^62 or more
take no part, as their scores need not fit a long; vectors of different dimensions
have no score; of rows that repeat an id the least (by label, vector) counts; equal
scores go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.common import keep
from streetflow.llm.vectors import dealt, matrix, one_row_an_id, vector_rows

POSITIVES, NEGATIVES = 5, 3
#: Rows of a block, and anchors of one pass over the candidates (some 8 MB at 64 dimensions).
BLOCK, ANCHORS = 32_768, 16_384
#: Entries of each list in the first turn of sorted access.
FIRST_DEPTH = 8


def integers(lists: pa.Array, dims: int) -> np.ndarray:
    return np.floor(matrix(lists, dims) * 256).astype(np.int64)


class Lists:
    """Rows in order of each component, for anchors of one dimension."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.x, self.ids, self.labels = x, ids, labels
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(x.T, self.order, 1)
        self.longest = float(np.sqrt((x.astype(float) ** 2).sum(1)).max()) if x.size else 0.0
        self.real = x.astype(float)

    def _scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.longest * np.sqrt(float((anchor.astype(float) ** 2).sum())) < 2**52:  # exact in doubles
            return (self.real[rows] @ anchor.astype(float)).astype(np.int64)
        return self.x[rows] @ anchor

    def descend(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Turns of sorted access: rows met for the first time, their scores, and the threshold."""
        n, up, down = len(self.ids), np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, depth, done = np.zeros(n, bool), FIRST_DEPTH, 0
        while done < n and len(up) + len(down):
            depth = min(depth, n)
            met = np.zeros(n, bool)
            met[self.order[up, n - depth : n - done].ravel()] = True
            met[self.order[down, done:depth].ravel()] = True
            rows = np.flatnonzero(met & ~seen)
            seen |= met
            threshold = int(anchor[up] @ self.values[up, n - depth]) + int(anchor[down] @ self.values[down, depth - 1])
            yield rows, self._scores(rows, anchor), threshold if depth < n else float("-inf")
            depth, done = depth * 2, depth
        if not len(up) + len(down):  # a zero anchor: no list to read, every score is 0
            yield np.arange(n), np.zeros(n, np.int64), float("-inf")

    def positives(self, anchor: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best other rows; all rows have the anchor's label."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows, got, threshold in self.descend(anchor):
            other = self.ids[rows] != own
            ids, scores = np.concatenate([ids, self.ids[rows][other]]), np.concatenate([scores, got[other]])
            best = np.lexsort((ids, -scores))[:POSITIVES]
            ids, scores = ids[best], scores[best]
            if len(ids) == POSITIVES and threshold < scores[-1]:
                break
        return ids, scores

    def negatives(self, anchor: np.ndarray, label: int, own: int, windows: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (least, most score): (ids, scores) of its best rows of other labels."""
        none = np.zeros(0, np.int64)
        best, open_ = [(none, none)] * len(windows), {w for w, (lo, hi) in enumerate(windows) if lo <= hi}
        for rows, got, threshold in self.descend(anchor) if open_ else ():
            other = (self.labels[rows] != label) & (self.ids[rows] != own)
            rows, got = rows[other], got[other]
            for w in list(open_):
                lo, hi = windows[w]
                fit = (got >= lo) & (got <= hi)
                ids, scores = np.concatenate([best[w][0], self.ids[rows[fit]]]), np.concatenate([best[w][1], got[fit]])
                first = np.lexsort((ids, -scores))[:NEGATIVES]
                best[w] = ids[first], scores[first]
                if threshold < lo or (len(first) == NEGATIVES and threshold < scores[first[-1]]):
                    open_.discard(w)
            if not open_:
                break
        return best


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimensions, ids, labels, integers) of at most ``BLOCK`` rows at a time."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def joined(dims: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        ids, labels, xs = zip(*held.pop(dims), strict=True)
        return dims, np.concatenate(ids), np.concatenate(labels), np.concatenate(xs)

    for batch in batches:
        sizes = np.asarray(batch.column(2).value_lengths())
        for dims in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == dims))
            for s in range(0, part.num_rows, BLOCK // 2):
                some = part.slice(s, BLOCK // 2)
                held.setdefault(dims, []).append((some.column(0).to_numpy(), some.column(1).to_numpy(), integers(some.column(2), dims)))
                if sum(len(h[0]) for h in held[dims]) >= BLOCK // 2:
                    yield joined(dims)
    for dims in list(held):
        yield joined(dims)


def _anchors(rows: list) -> dict[int, list]:
    """Broadcast anchors by dimension: (id, label, integers, further values)."""
    by_dims: dict[int, list] = {}
    for r in rows:
        x = np.floor(np.array(r.embedding, float) * 256).astype(np.int64)
        by_dims.setdefault(len(x), []).append((r.vec_id, r.label, x, r.asDict().get("scores")))
    return by_dims


def _batch(schema: str, columns: list[list]) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns], names=names)


def _first(df: DataFrame, by: list[str], score: str, tie: str, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), tie))
    return df.withColumn("rank", place).filter(F.col("rank") <= most)


POSITIVE = "anchor_id long, positive_id long, positive_score long"


def positives(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(anchor_id, positive_id, positive_score, rank)`` over written tables of (vec_id, label, embedding)."""

    def seek(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_label: dict[tuple[int, int], list] = {}
            for dims, mine in shared.value.items():
                for a in mine:
                    by_label.setdefault((dims, a[1]), []).append(a)
            for dims, ids, labels, x in _blocks(batches):
                out: list[list] = [[], [], []]
                order = np.argsort(labels, kind="stable")
                edge = np.flatnonzero(np.append(True, np.diff(labels[order]) != 0))
                for at in np.split(order, edge[1:]):
                    wanted = by_label.get((dims, int(labels[at[0]])), [])
                    lists = Lists(x[at], ids[at], labels[at]) if wanted else None
                    for own, _, anchor, _ in wanted:
                        found, scores = lists.positives(anchor, own)
                        for column, got in zip(out, (np.full(len(found), own), found, scores), strict=True):
                            column.append(got)
                yield _batch(POSITIVE, out)

        return run

    found = _over_anchors(candidates, anchors, seek, POSITIVE)
    return _first(found, ["anchor_id"], "positive_score", "positive_id", POSITIVES)


NEGATIVE = "anchor_id long, positive_score long, negative_id long, negative_score long"


def windows_of(scores: list[int]) -> list[tuple[int, int]]:
    """The scores allowed beside each positive score: 50 * p <= 100 * s <= 95 * p."""
    return [(-(-50 * p // 100), 95 * p // 100) for p in scores]


def negatives(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(anchor_id, positive_score, negative_id, negative_score, rank)``; ``anchors`` also has ``scores``,
    the distinct scores of its positives."""

    def seek(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dims, ids, labels, x in _blocks(batches):
                out: list[list] = [[], [], [], []]
                lists = Lists(x, ids, labels) if dims in shared.value else None
                for own, label, anchor, scores in shared.value.get(dims, []):
                    for p, (found, got) in zip(scores, lists.negatives(anchor, label, own, windows_of(scores)), strict=True):
                        for column, v in zip(out, (np.full(len(found), own), np.full(len(found), p), found, got), strict=True):
                            column.append(v)
                yield _batch(NEGATIVE, out)

        return run

    found = _over_anchors(candidates, anchors, seek, NEGATIVE)
    return _first(found, ["anchor_id", "positive_score"], "negative_score", "negative_id", NEGATIVES)


def _over_anchors(candidates: DataFrame, anchors: DataFrame, seek, schema: str) -> DataFrame:
    spark = candidates.sparkSession
    found = spark.createDataFrame([], schema)
    for part in dealt(anchors, "vec_id", ANCHORS):
        shared = spark.sparkContext.broadcast(_anchors(part.collect()))
        found = found.union(candidates.mapInArrow(seek(shared), schema))
    return found


def mine(
    rows: DataFrame, is_anchor: str, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is SQL over ``vec_id``; ``label``: an expression over ``vec_id`` and ``label``
    in place of the label."""
    named = vector_rows(rows, id_col, vector_col, label_col).withColumnRenamed(label_col, "label")
    named = named.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").filter("label IS NOT NULL")
    fits = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x * 256).cast("double"), 2)) < float(2**62)
    candidates = keep(one_row_an_id(named.filter(fits), "vec_id").withColumn("label", F.col("label") if label is None else label), "negatives-rows")
    anchors = candidates.filter(is_anchor)
    best = keep(positives(candidates, anchors).select("anchor_id", "positive_id", "positive_score"), "negatives-positives")
    scores = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))  # POSITIVES at most
    found = negatives(candidates, keep(anchors.join(scores, "vec_id"), "negatives-anchors"))
    out = best.join(found, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
