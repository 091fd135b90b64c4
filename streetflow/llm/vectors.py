"""Helpers of the vector searches: usable rows, Arrow batches as matrices, bounded batches of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.common import column

FINITE = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
NOT_ZERO = "exists(embedding, x -> x <> 0)"


def one_row_an_id(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with the least row (by all columns) of every id that repeats.

    Only rows of repeated ids are shuffled whole; without any, nothing but ids is."""
    repeated = rows.groupBy(id_col).agg(F.count("*").alias("times")).filter("times > 1").select(id_col)
    if repeated.isEmpty():
        return rows
    rest = [c for c in rows.columns if c != id_col]
    least = rows.join(repeated, id_col).groupBy(id_col).agg(F.min(F.struct(*rest)).alias("row"))
    return rows.join(repeated, id_col, "left_anti").unionByName(least.select(id_col, "row.*"))


def vector_rows(df: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """``(vec_id, embedding, *others)`` with doubles, of the rows that have an id and a finite vector."""
    named = df.select(
        column(id_col).cast("long").alias("vec_id"),
        column(vector_col).cast("array<double>").alias("embedding"),
        *(column(c).alias(c) for c in others),
    )
    return named.filter("vec_id IS NOT NULL").filter(FINITE)


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of ``dims`` doubles as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dims)


def dealt(rows: DataFrame, key: str, most: int) -> list[DataFrame]:
    """``rows`` dealt by a hash of ``key`` into parts of at most ``most`` rows each, or of one key."""
    parts = max(1, -(-rows.count() // most))
    while parts > 1:
        part = F.pmod(F.xxhash64(key), F.lit(parts))
        sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        if sizes.filter((F.col("n") > most) & (F.col("lo") != F.col("hi"))).isEmpty():
            return [rows.filter(part == p) for p in range(parts)]
        parts *= 2
    return [rows]
