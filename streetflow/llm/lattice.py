"""Embedding near-duplicates by lattice hashing.

Each of ``TABLES`` tables projects the unit vectors at random to eight dimensions,
scales them and decodes them to the nearest point of the E8 lattice.  A vector is
filed under its own cell and the ``PROBES`` neighbouring cells (lattice points one
minimal vector away) nearest to its projection, so a pair meets where any of their
cells agree.  Vectors of a cell are compared exactly, in double precision.  A pair
counts in the smallest cell that it shares, so no link counts twice, and cells give on
only the number of links and the local component of each vector, never pairs.  A cell
of more than ``BLOCK`` vectors is dealt into blocks, and each pair of blocks is one
group, so no task holds a whole hot cell.

Equal vectors are one representative with the number of its rows; representatives are
filed and linked, and their numbers count the links, so a vector repeated in a third of
all rows costs one entry a cell.

``SCALE`` holds for up to ``SCALE_ROWS`` representatives; beyond, the scale grows with the
eighth root of their number, so that cells don't fill up with the table.  How likely a
pair at the threshold meets in one table is measured on ``TRIALS`` drawn pairs (at SCALE, 64
dimensions and cosine 0.95: 0.86), and there are as many tables as make a miss in all of
them rarer than ``MISSED``, ``TABLES`` at least.

Defined cases: vectors that are null, empty or zero, or hold a null or a non-finite
component, link with nothing, as do those of different dimensions; rows that repeat an
id are one vertex, and have no links with each other; a null id has no links and a null
component, and is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.common import column, keep
from streetflow.llm.components import components
from streetflow.llm.shingles import U, mix, series

TABLES, PROBES, SCALE = 4, 2, 5.0
SCALE_ROWS, TRIALS, MISSED = 100_000, 2048, 0.005
BLOCK = 2048
#: Rows that a group of small cells should get.
GROUP_ROWS, LEAST_GROUPS = 10_000, 256

UNITS = "vec_id long, vector binary"
FILED = "vec_id long, vector binary, n long, cells array<long>"
FOUND = "vec_id long, links long, root long"


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minuses."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst entry."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by a half in every direction: the nearer of both points."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    first = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(first[:, None], a, b)


@lru_cache(maxsize=64)
def _projection(table: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([table, dims])
    basis = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, :8]
    return basis * np.sqrt(dims / 64.0), rng.uniform(0, 1, 8)


def cells(unit: np.ndarray, scale: float, tables: int) -> np.ndarray:
    """Cell numbers of unit vectors: one row each, ``tables * (1 + PROBES)`` columns."""
    n, dims = unit.shape
    if dims < 8:
        unit, dims = np.pad(unit, ((0, 0), (0, 8 - dims))), 8
    place = series(71, 8)
    out = []
    for t in range(tables):
        basis, offset = _projection(t, dims)
        x = unit @ (basis * scale) + offset
        own = nearest_e8(x)
        nearness = (x - own) @ minimal_vectors().T
        order = np.argsort(-nearness, axis=1, kind="stable")[:, :PROBES]
        for p in range(PROBES + 1):
            point = own if p == 0 else own + minimal_vectors()[order[:, p - 1]]
            with np.errstate(over="ignore"):
                code = (np.rint(point * 2).astype(np.int64).view(U) * place).sum(1, dtype=U) + U(t * 1_000_003 + unit.shape[1])
            out.append(mix(code).view(np.int64))
    return np.stack(out, 1)


def settings(rows: int, dims: int, least: float) -> tuple[float, int]:
    """(scale, number of tables) for so many representatives."""
    scale = SCALE * max(1.0, rows / SCALE_ROWS) ** 0.125
    rng = np.random.default_rng(dims)
    a = _unit(rng.normal(size=(TRIALS, max(dims, 2))))
    off = rng.normal(size=a.shape)
    off = _unit(off - (off * a).sum(1, keepdims=True) * a)
    one, two = cells(a, scale, 1), cells(least * a + np.sqrt(max(0.0, 1 - least * least)) * off, scale, 1)
    met = (one[:, :, None] == two[:, None, :]).any((1, 2)).mean()
    return scale, max(TABLES, math.ceil(math.log(MISSED) / math.log(max(1e-9, 1 - met))))


def unit_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: the usable vectors of ``rows`` (vec_id, embedding) at length 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            by_size: dict[int, tuple[list[int], list[np.ndarray]]] = {}
            for i, v in enumerate(batch.column(1)):
                flat = v.values
                if flat is None or len(flat) == 0 or flat.null_count:
                    continue
                x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any():
                    held = by_size.setdefault(len(x), ([], []))
                    held[0].append(i)
                    held[1].append(x)
            for at, vectors in by_size.values():
                unit = _unit(np.array(vectors))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array([v.tobytes() for v in unit], pa.binary())], names=["vec_id", "vector"])

    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInArrow(run, UNITS)


def representatives(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``(vec_id, vector, n)``: one row for equal vectors, with the least id and the number of
    rows; ``(vec_id, member)``: the rows behind each).  Rows whose id repeats stand for
    themselves, as rows of one id don't link with each other."""
    repeated = units.groupBy("vec_id").agg(F.count("*").alias("times")).filter("times > 1").select("vec_id", F.lit(True).alias("alone"))
    marked = units.join(repeated, "vec_id", "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
    marked = keep(marked.withColumn("same", F.sha2("vector", 256)), "lattice-units")
    one = marked.filter("NOT alone").groupBy("same").agg(F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"), F.count("*").alias("n"))
    one = keep(one, "lattice-representatives")
    lone = marked.filter("alone").select("vec_id", "vector", F.lit(1).cast("long").alias("n"))
    members = marked.filter("NOT alone").select(F.col("vec_id").alias("member"), "same").join(one.select("same", "vec_id"), "same")
    return one.select("vec_id", "vector", "n").union(lone), members.select("vec_id", "member")


def file_vectors(units: DataFrame, scale: float, tables: int) -> DataFrame:
    """``(vec_id, vector, n, cells)``: the cells of each representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                unit = np.frombuffer(b"".join([raw[i] for i in at])).reshape(len(at), -1)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(cells(unit, scale, tables)), pa.list_(pa.int64()))], names=["vec_id", "vector", "n", "cells"])

    return units.mapInArrow(run, FILED)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _compare(ids: np.ndarray, unit: np.ndarray, filed: np.ndarray, cell: int, left: np.ndarray, right: np.ndarray, same: bool, least: float):
    """(a, b, counts): linked pairs of rows, and which of them count in this cell."""
    close = unit[left] @ unit[right].T >= least
    if same:
        close = np.triu(close, 1)
    a, b = np.nonzero(close)
    a, b = left[a], right[b]
    other = ids[a] != ids[b]
    a, b = a[other], b[other]
    counts = np.zeros(len(a), bool)
    for s in range(0, len(a), 1 << 15):
        x, y = filed[a[s : s + (1 << 15)]], filed[b[s : s + (1 << 15)]]
        shared = (x[:, :, None] == y[:, None, :]).any(2)
        counts[s : s + (1 << 15)] = np.where(shared, x, np.iinfo(np.int64).max).min(1) == cell
    return a, b, counts


def _local_roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the least id that it reaches over the given links."""
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def link_cells(least: float):
    def run(table: pa.Table) -> pa.Table:
        cell, i, j, block = (table.column(c).to_numpy() for c in ("cell", "i", "j", "block"))
        ids = table.column("vec_id").to_numpy()
        raw = table.column("vector").to_pylist()
        filed, times = np.array(table.column("cells").to_pylist(), np.int64), table.column("n").to_numpy()
        order = np.lexsort((ids, j, i, cell))
        new = np.flatnonzero(np.append(True, (cell[order][1:] != cell[order][:-1]) | (i[order][1:] != i[order][:-1]) | (j[order][1:] != j[order][:-1])))
        out_id, out_n, out_root = [], [], []
        for s, e in zip(new, np.append(new[1:], len(order)), strict=True):
            rows = order[s:e]
            if len(rows) < 2 or len({len(raw[r]) for r in rows}) > 1:
                continue  # equal cells of different dimensions: a hash collision
            mine, unit = ids[rows], np.frombuffer(b"".join([raw[r] for r in rows])).reshape(len(rows), -1)
            one = i[rows[0]] == j[rows[0]]
            left = np.flatnonzero(block[rows] == i[rows[0]])
            right = left if one else np.flatnonzero(block[rows] == j[rows[0]])
            a, b, counts = _compare(mine, unit, filed[rows], cell[rows[0]], left, right, one, least)
            if len(a):
                n, mult = np.zeros(len(rows), np.int64), times[rows]
                np.add.at(n, a[counts], mult[b[counts]])
                np.add.at(n, b[counts], mult[a[counts]])
                met = np.unique(np.concatenate([a, b]))
                out_id.append(mine[met])
                out_n.append(n[met])
                out_root.append(_local_roots(len(rows), a, b, mine)[met])
        none = [np.zeros(0, np.int64)]
        return pa.table({k: pa.array(np.concatenate(v or none), pa.int64()) for k, v in (("vec_id", out_id), ("links", out_n), ("root", out_root))})

    return run


def near_duplicates(rows: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``rows``."""
    rows = rows.select(column(id_col).cast("long").alias("vec_id"), column(vector_col).alias("embedding"))
    units, members = representatives(unit_vectors(rows))
    size = units.agg(F.count("*").alias("rows"), F.max(F.octet_length("vector")).alias("bytes")).first()
    scale, tables = settings(size.rows, (size.bytes or 64) // 8, least)
    filed = keep(file_vectors(units, scale, tables), "lattice-filed")
    in_cells = filed.select("vec_id", "vector", "n", "cells", F.explode("cells").alias("cell"))
    sizes = in_cells.groupBy("cell").agg(F.count("*").alias("size"))
    large = sizes.filter(F.col("size") > BLOCK).select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    dealt = in_cells.join(large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    groups = max(LEAST_GROUPS, size.rows * tables * (1 + PROBES) // GROUP_ROWS)
    group = F.when(F.col("blocks") > 1, F.xxhash64("cell", "i", "j")).otherwise(F.pmod("cell", F.lit(groups)))
    met = met.select("vec_id", "vector", "n", "cells", "cell", "i", "j", "block", group.alias("g"))
    found = keep(met.groupBy("g").applyInArrow(link_cells(least), FOUND), "lattice-found")

    # from representatives to rows: equal rows link with each other and share all links
    links = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    roots = components(found.select("vec_id", "root"), "lattice").select(F.col("v").alias("vec_id"), F.col("m").alias("root"))
    classes = units.groupBy("vec_id").agg(F.max("n").alias("n")).join(links, "vec_id", "left").join(roots, "vec_id", "left")
    classes = classes.select("vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "vec_id").alias("root"))
    alone = units.join(members.select("vec_id").distinct(), "vec_id", "left_anti").select("vec_id", F.col("vec_id").alias("member")).distinct()
    by_row = members.union(alone).join(classes, "vec_id").select(F.col("member").alias("vec_id"), "n_links", "root")
    out = rows.select("vec_id").join(by_row, "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
