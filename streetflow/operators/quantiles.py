"""Exact quantiles (linear interpolation, as ``percentile`` / ``quantile_cont``)
that never hold a whole group in one task.

Spark's ``percentile`` keeps, per group, a map of every distinct value and
merges it in one task; for a key holding a third of the rows that map is
unbounded.  Here every group, large or small, takes one path, all of it lazy:

1. one aggregate gives each group's least and greatest value code (``code``: an
   order-preserving whole number of a double) beside the caller's other aggregates;
2. equal values of a group are counted (partial aggregate);
3. the counts are summed into at most ``GRID`` cells between the group's own least and
   greatest code, and a running sum over them finds those that hold the ranks
   ``floor(q (n-1))`` and ``ceil(q (n-1))``;
4. those cells are cut once more, into ``GRID`` parts between their own least and
   greatest code, and the parts that hold the ranks are found alike;
5. only the values of those parts are ranked, each part a window of its own.

So a group's values are spread over up to ``GRID ** 2`` parts of its own range, however
narrow that is: of a million distinct values spread evenly, one or two meet in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRID = 4096
#: Binary digits of the mantissa that ``code`` keeps; codes and their differences fit a long.
CODE_BITS = 50


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` that treats null keys as equal (null groups are groups)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    lt, rt = left.alias("__L"), r.alias("__R")
    cond = [F.col(f"__L.{c}").eqNullSafe(F.col(f"__R.__r_{c}")) for c in on]
    return lt.join(rt, cond, how).drop(*[f"__r_{c}" for c in on])


def qname(q: float) -> str:
    return f"q{int(round(q * 100))}"


def quantile_columns(value: str, qs: list[float], names: list[str] | None = None) -> list[Column]:
    names = names or [qname(q) for q in qs]
    return [F.percentile(F.col(value), q).alias(n) for q, n in zip(qs, names)]


def code(v: Column) -> Column:
    """A whole number for a double by sign, binary exponent and ``CODE_BITS`` digits of its
    mantissa; larger values never get a smaller number, NaN the largest."""
    steps = 1 << CODE_BITS
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * steps)
    step = F.greatest(F.lit(0), F.least(F.lit(steps - 1), step))
    number = ((exponent + 1075) * steps + step).cast("bigint")
    ends = F.lit(2100 * steps)
    return (
        F.when(F.isnan(v) | (v == float("inf")), ends + F.isnan(v).cast("bigint"))
        .when(v == float("-inf"), -ends)
        .when(v == 0, F.lit(0))
        .when(v > 0, number)
        .otherwise(-number)
        .cast("bigint")
    )


def _cut(of: Column, least: Column, most: Column) -> Column:
    """Which of ``GRID`` equal parts of [least, most] holds the code ``of``."""
    return F.floor((of - least) / (F.floor((most - least) / F.lit(GRID)) + 1))


def _holding(parts: DataFrame, group: list[str], part: str, ranks: Column, before: Column) -> DataFrame:
    """Of the parts of each group (with a count ``_c``) those that hold one of the group's ``ranks``."""
    running = F.sum("_c").over(Window.partitionBy(*group).orderBy(part))
    parts = parts.withColumn("_before", before + running - F.col("_c"))
    inside = (F.col("_before"), F.col("_before") + F.col("_c"))
    return parts.where(F.exists(ranks, lambda r: (r >= inside[0]) & (r < inside[1])))


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    qs: list[float],
    names: list[str] | None = None,
    others: list[Column] | None = None,
) -> DataFrame:
    """One row per group of ``keys`` with one column per quantile in ``qs``, plus
    the aggregate columns ``others`` (computed in the same grouping)."""
    names = names or [qname(q) for q in qs]
    others = others or []
    if df.isStreaming:  # stateful aggregate; its groups are bounded by the watermark
        return df.groupBy(*keys).agg(*others, *quantile_columns(value, qs, names))
    number = code(F.col(value).cast("double"))
    base = df.groupBy(*keys).agg(*others, F.min(number).alias("_least"), F.max(number).alias("_most"))
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_code", code(F.col("_v")))
    counted = _join(counted, base.select(*keys, "_least", "_most"), keys)
    counted = counted.withColumn("_cell", _cut(F.col("_code"), F.col("_least"), F.col("_most"))).drop("_least", "_most")

    position = [F.lit(q) * (F.col("_n") - 1) for q in qs]
    ranks = F.array(*[f(p).cast("bigint") for p in position for f in (F.floor, F.ceil)])
    cells = counted.groupBy(*keys, "_cell").agg(F.sum("_c").alias("_c"), F.min("_code").alias("_least"), F.max("_code").alias("_most"))
    cells = cells.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    cells = _holding(cells, keys, "_cell", ranks, F.lit(0)).drop("_c")

    in_cell = [*keys, "_cell"]
    cut = _join(counted, cells, in_cell).withColumn("_part", _cut(F.col("_code"), F.col("_least"), F.col("_most")))
    parts = cut.groupBy(*in_cell, "_part").agg(F.sum("_c").alias("_c"), F.max("_n").alias("_n"), F.max("_before").alias("_start"))
    parts = _holding(parts, in_cell, "_part", ranks, F.col("_start")).drop("_c", "_start")

    in_part = [*in_cell, "_part"]
    values = _join(cut.select(*in_part, "_v", "_c"), parts, in_part)
    running = F.sum("_c").over(Window.partitionBy(*in_part).orderBy("_v"))
    values = values.withColumn("_before", F.col("_before") + running - F.col("_c"))

    def at(rank: Column) -> Column:
        here = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c"))
        return F.max(F.when(here, F.col("_v")))

    bounds = [c for i, p in enumerate(position) for c in (at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"))]
    found = values.groupBy(*keys).agg(F.max("_n").alias("_n"), *bounds)

    def between(i: int, p: Column) -> Column:  # the same arithmetic as Spark's percentile
        lo, hi = F.floor(p), F.ceil(p)
        mixed = (hi - p) * F.col(f"_lo{i}") + (p - lo) * F.col(f"_hi{i}")
        return F.when(lo == hi, F.col(f"_lo{i}")).otherwise(mixed)

    q = found.select(*keys, *[between(i, p).alias(n) for i, (p, n) in enumerate(zip(position, names, strict=True))])
    return _join(base.drop("_least", "_most"), q, keys, "left")
