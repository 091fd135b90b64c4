"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, and each half is quantised by its own k-means
centroids, fitted on at most ``SAMPLE`` rows (those of least id hash).  A vector's
cell is its pair of centroids; every row is indexed, and the entries are stored in
order of their cells, so a cell of any size is cut into as many pieces as it needs.
A query walks the pairs of centroids by ascending sum of its two squared distances
with a heap (the multi-sequence walk) until the cells taken hold ``depth`` entries.
As the sums ascend, the cells taken are those up to the last sum, the query's *reach*,
so a query travels as its vector and one number.  The entries of these cells are
reranked by their exact distance in double precision.

``depth`` isn't guessed: for ``PROBES`` queries the true neighbours are found by
comparing all rows, and the depth is where the walks reach ``RECALL`` of them.  On
clustered vectors that is a small part of the index, on shapeless ones a large part.

Queries go through the entries in batches of at most ``QUERIES``, broadcast; a task
gives on its ``k`` nearest for each query, never pairs.

Defined cases: vectors that are null, empty or zero, or hold a null or non-finite
component, take no part, nor do rows without id; of rows that repeat an id the least
vector counts; vectors of different dimensions have no distance, and each dimension
has an index of its own; fewer than ``k`` candidates give fewer rows, none give none;
equal distances go to the smaller id; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.common import keep
from streetflow.llm.vectors import NOT_ZERO, dealt, matrix, one_row_an_id, vector_rows

#: Rows that the centroids are fitted on, rounds of fitting, and queries that the depth is measured with.
SAMPLE, ROUNDS, PROBES = 16_384, 12, 128
#: Share of the true neighbours that the walks of those queries must reach.
RECALL = 0.97
#: Rows that a cell should get, and most centroids of a half.
CELL_ROWS, MOST_CENTROIDS = 16, 1024
#: Queries of one pass over the entries: some 16 MB at 64 dimensions.
QUERIES = 16_384

FOUND = "query_id long, vec_id long, score double"


def centroids_for(rows: int) -> int:
    """Centroids of a half: a power of two, so that cells get about ``CELL_ROWS`` rows."""
    return min(MOST_CENTROIDS, 1 << max(1, round(np.log2(max(rows, 1) / CELL_ROWS) / 2)))


def half_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, the same to the last bit for a vector and a centroid wherever they are computed."""
    out = np.empty((len(x), len(centroids)))
    for at, c in enumerate(centroids):
        out[:, at] = ((x - c) ** 2).sum(1)
    return out


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for s in range(0, len(x), 4096):
        part = x[s : s + 4096]
        out[s : s + 4096] = ((centroids**2).sum(1) - 2 * (part @ centroids.T)).argmin(1)
    return out


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` centroids (fewer if there are fewer distinct rows) by Lloyd's rounds from spread rows."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    centroids = x[np.random.default_rng(k).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = _nearest(x, centroids)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def fit(rows: DataFrame, dims: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The centroids of both halves, each fitted in a task of its own."""
    cut, k = (dims + 1) // 2, centroids_for(count)
    sample = rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    halves = sample.withColumn("half", F.explode(F.array(*map(F.lit, (0, 1) if dims > cut else (0,)))))

    def run(table: pa.Table) -> pa.Table:
        half = table.column("half")[0].as_py()
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        x = matrix(table.column("embedding").combine_chunks(), dims)[order]
        found = k_means(x[:, :cut] if half == 0 else x[:, cut:], k)
        return pa.table({"half": pa.array([half], pa.int32()), "centroids": pa.array([found.ravel()], pa.list_(pa.float64()))})

    made = {r.half: np.array(r.centroids) for r in halves.groupBy("half").applyInArrow(run, "half int, centroids array<double>").collect()}
    return made[0].reshape(-1, cut), made[1].reshape(-1, dims - cut) if dims > cut else np.zeros((1, 0))


class Index:
    """The entries of one dimension in order of their cells, with the centroids and the cells' sizes."""

    def __init__(self, rows: DataFrame, dims: int, count: int):
        self.dims, self.cut, self.count = dims, (dims + 1) // 2, count
        self.one, self.two = fit(rows, dims, count)
        one, two, cut, width = self.one, self.two, self.cut, len(self.two)

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(1), dims)
                cell = _nearest(x[:, :cut], one) * width + (_nearest(x[:, cut:], two) if dims > cut else 0)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *batch.columns], names=["cell", "vec_id", "embedding"])

        filed = rows.select("vec_id", "embedding").mapInArrow(cells, "cell int, vec_id long, embedding array<double>")
        self.entries = keep(filed.repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id"), "multi-index")
        self.sizes = np.zeros(len(one) * width, np.int64)
        filled = self.entries.groupBy("cell").count().toArrow()  # two numbers for each of at most MOST_CENTROIDS ** 2 cells
        self.sizes[filled["cell"].to_numpy()] = filled["count"].to_numpy()
        self.depth = self._measured_depth()

    def _sums(self, x: np.ndarray) -> np.ndarray:
        """Summed distance of each cell from each query."""
        a, b = half_distances(x[:, : self.cut], self.one), half_distances(x[:, self.cut :], self.two)
        return (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)

    def _measured_depth(self) -> int:
        """Entries up to which the walks of sampled queries have passed ``RECALL`` of their true neighbours."""
        some = self.entries.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(PROBES).select("vec_id", "embedding")
        probes = keep(some.withColumn("reach", F.lit(float("inf"))), "multi-index-probes")
        truth = self.rerank(probes, 10).join(self.entries.select("vec_id", "cell"), "vec_id")
        by_query: dict[int, list[int]] = {}
        for r in truth.select("query_id", "cell").collect():  # at most 10 * PROBES rows
            by_query.setdefault(r.query_id, []).append(r.cell)
        needed: list[int] = []
        for r in probes.collect():
            sums = self._sums(np.array([r.embedding]))[0]
            order = np.argsort(sums, kind="stable")
            passed = np.cumsum(self.sizes[order])
            for cell in by_query.get(r.vec_id, []):
                needed.append(int(passed[np.searchsorted(sums[order], sums[cell], side="right") - 1]))
        return int(np.quantile(needed, RECALL, method="higher")) if needed else self.count

    def reaches(self, queries: DataFrame) -> DataFrame:
        """``(vec_id, embedding, reach)``: how far each query's walk goes."""
        one, two, cut, dims, depth = self.one, self.two, self.cut, self.dims, self.depth
        sizes = queries.sparkSession.sparkContext.broadcast(self.sizes.reshape(len(one), -1))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(1), dims)
                a, b = half_distances(x[:, :cut], one), half_distances(x[:, cut:], two)
                reach = [walk(a[q], b[q], sizes.value, depth) for q in range(len(x))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach, pa.float64())], names=["vec_id", "embedding", "reach"])

        return queries.select("vec_id", "embedding").mapInArrow(run, "vec_id long, embedding array<double>, reach double")

    def rerank(self, queries: DataFrame, k: int) -> DataFrame:
        """``(query_id, vec_id, score)``: the ``k`` nearest entries in reach of each of ``queries`` (a written table)."""
        found = queries.sparkSession.createDataFrame([], FOUND)
        for part in dealt(queries, "vec_id", QUERIES):
            got = part.orderBy("vec_id").toArrow()
            if got.num_rows:
                found = found.union(self.entries.mapInArrow(self._rerank(got, k), FOUND))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return found.withColumn("rank", place).filter(F.col("rank") <= k)

    def _rerank(self, queries: pa.Table, k: int):
        one, two, cut, dims, width = self.one, self.two, self.cut, self.dims, len(self.two)
        shared = self.entries.sparkSession.sparkContext.broadcast(
            (queries["vec_id"].to_numpy(), matrix(queries["embedding"].combine_chunks(), dims), queries["reach"].to_numpy())
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, x, reach = shared.value
            best = Nearest(mine, x, k)
            first: tuple[int, np.ndarray] = (-1, reach)
            for batch in batches:
                cell, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                rows = matrix(batch.column(2), dims)
                edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
                for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(cell)], strict=True):
                    i, j = divmod(int(cell[s]), width)
                    if first[0] != i:
                        first = i, half_distances(x[:, :cut], one[i : i + 1])[:, 0]
                    within = first[1] + half_distances(x[:, cut:], two[j : j + 1])[:, 0] <= reach
                    best.offer(np.flatnonzero(within), ids[s:e], rows[s:e])
            yield best.batch()

        return run


def walk(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, depth: int) -> float:
    """The last sum of the pairs of centroids that a query with distances ``a`` and ``b``
    takes, by ascending sum, until they hold ``depth`` entries (infinite if all are taken)."""
    at, bt = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    da, db, at, bt = a[at].tolist(), b[bt].tolist(), at.tolist(), bt.tolist()
    taken = [0] * len(da)  # of each row of pairs, how many are taken
    heap, got, reach = [(da[0] + db[0], 0, 0)], 0, float("inf")
    while heap:
        reach, i, j = heapq.heappop(heap)
        got += sizes.item(at[i], bt[j])
        if got >= depth:
            return reach
        taken[i] = j + 1
        if i + 1 < len(da) and taken[i + 1] == j:
            heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
        if j + 1 < len(db) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
    return float("inf")


class Nearest:
    """The ``k`` nearest entries so far of each query, by (distance, id)."""

    def __init__(self, mine: np.ndarray, x: np.ndarray, k: int):
        self.mine, self.x, self.k = mine, x, k
        self.squares = (x * x).sum(1)
        self.d = np.full((len(x), k), np.inf)
        self.ids = np.full((len(x), k), np.iinfo(np.int64).max)

    def offer(self, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        for s in range(0, len(queries), 1024):
            for t in range(0, len(ids), 1024):
                self._offer(queries[s : s + 1024], ids[t : t + 1024], rows[t : t + 1024])

    def _offer(self, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """A product of matrices tells which entries may be near enough; their distances are exact."""
        if not len(queries):
            return
        size = self.squares[queries][:, None] + (rows * rows).sum(1)[None, :]
        near = size - 2 * (self.x[queries] @ rows.T)
        slack = 1e-11 * size
        near[self.mine[queries][:, None] == ids[None, :]] = np.inf
        most = self.d[queries, -1] ** 2
        if len(ids) > self.k + 1:
            kth = np.partition(near + slack, self.k - 1, axis=1)[:, self.k - 1]
            most = np.minimum(most, kth)
        q, e = np.nonzero((near - slack <= most[:, None] * (1 + 1e-12)) & (near < np.inf))
        if not len(q):
            return
        d = np.concatenate([np.sqrt(((self.x[queries[q[s : s + 65536]]] - rows[e[s : s + 65536]]) ** 2).sum(1)) for s in range(0, len(q), 65536)])
        met = np.unique(q)
        of = np.concatenate([q, np.repeat(met, self.k)])
        d = np.concatenate([d, self.d[queries[met]].ravel()])
        who = np.concatenate([ids[e], self.ids[queries[met]].ravel()])
        order = np.lexsort((who, d, of))
        of, d, who = of[order], d[order], who[order]
        starts = np.searchsorted(of, met)
        take = starts[:, None] + np.arange(self.k)[None, :]
        self.d[queries[met]], self.ids[queries[met]] = d[take], who[take]

    def batch(self) -> pa.RecordBatch:
        q, at = np.nonzero(self.d < np.inf)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.mine[q], pa.int64()), pa.array(self.ids[q, at], pa.int64()), pa.array(self.d[q, at], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )


def search(rows: DataFrame, is_query: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found, by Euclidean distance, of
    the rows for which ``is_query`` (SQL over ``vec_id``) holds, among all others."""
    usable = one_row_an_id(vector_rows(rows, id_col, vector_col).filter(NOT_ZERO), "vec_id")
    usable = keep(usable.withColumn("dims", F.size("embedding")), "multi-index-rows")
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in usable.groupBy("dims").count().orderBy("dims").collect():
        own = usable.filter(F.col("dims") == r["dims"])
        index = Index(own, r["dims"], r["count"])
        queries = keep(index.reaches(own.filter(is_query)), "multi-index-queries")
        out = out.union(index.rerank(queries, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
    return out
