"""Connected components of a link table, as Spark joins (alternating stars).

Each round links every vertex's larger neighbours to its smallest one, then every
vertex and its smaller neighbours to the smallest of them, until nothing changes;
the rounds grow with the logarithm of a component's width.  A vertex with very
many links is reduced by a partial aggregate, and its links are joined back with
the one smallest neighbour, a join that Spark may split.  Every round is written
to the shared folder.

A table of at most ``FEW_LINKS`` links, some megabytes, is joined up by one task instead
of some ten jobs; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.common import keep

#: Links (two numbers each) that one task may hold.
FEW_LINKS = 250_000


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
    least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("w > u").select(F.col("w").alias("v"), "m").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("w"))
    least = down.groupBy("u").agg(F.min("w").alias("m"))
    hung = down.join(least, "u").filter("w <> m").select(F.col("w").alias("v"), "m")
    return hung.union(least.select(F.col("u").alias("v"), "m")).distinct()


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, the smallest vertex that each can reach) over the links ``a``-``b``."""
    vertices, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(vertices))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, root[side], low)  # hang the root below the smaller one
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            return vertices, vertices[root]


def _by_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]  # FEW_LINKS rows at most
        if held:
            v, m = least_reachable(*(np.concatenate(c) for c in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(v[v != m]), pa.array(m[v != m])], names=["v", "m"])

    return edges.coalesce(1).mapInArrow(run, "v long, m long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(v, m)``: every linked vertex but the roots, with the smallest vertex it can reach.

    ``links`` has two long columns; order, repeats and loops don't matter.
    """
    a, b = links.columns
    edges = keep(
        links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).filter("v <> m").distinct(), f"{name}-links"
    )
    before = _state(edges)
    if 0 < before[0] <= FEW_LINKS:
        return keep(_by_one_task(edges), f"{name}-round")
    while before[0]:
        edges = keep(_small_star(_large_star(edges)), f"{name}-round")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
