"""Density clusters in one dimension (M15): the values of each bucket, such as one value
per series and time step, clustered by gaps; what lies in no cluster is an outlier.

A value is a *core* if at least ``min_points`` values of its bucket (itself included) lie
within ``eps`` of it; cores within ``eps`` of each other share a cluster; another value
within ``eps`` of a core belongs to the nearest core's cluster (of two equally near, the
lower one's); the rest are noise.

Nothing sorts a whole bucket.  Equal values are counted once, and a bucket is cut into
cells of ``eps / 2``.  A cell with ``min_points`` values has cores only; of every cell just
its ``min_points`` least and greatest distinct values, its edges, meet the values of the
sparse cells near by.  Clusters are found over the cells that hold cores, each with its
least and greatest core: in slices of ``SLICE`` cells, with one carried row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.operators.quantiles import _join
from streetflow.session import written

#: Cells of eps / 2 that a value within eps can lie away (one more than exact arithmetic needs).
REACH = 3
SLICE = 1024


def _near_by(cells: DataFrame) -> DataFrame:
    """Rows of cells, once for each cell that they can reach."""
    return cells.withColumn("cell", F.explode(F.sequence(F.col("cell") - REACH, F.col("cell") + REACH)))


def _core_cells(points: DataFrame, cells: DataFrame, by: list[str], eps: float, min_points: int) -> tuple[DataFrame, DataFrame]:
    """(least and greatest core of each cell that has any, values that aren't cores)."""
    low = F.row_number().over(Window.partitionBy(*by, "cell").orderBy("v"))
    high = F.row_number().over(Window.partitionBy(*by, "cell").orderBy(F.desc("v")))
    first = points.withColumn("_r", low).where(F.col("_r") <= min_points).drop("_r")
    last = points.withColumn("_r", high).where(F.col("_r") <= min_points).drop("_r")
    edges = first.unionByName(last).distinct().select(*by, "cell", F.col("v").alias("_v"), F.col("n").alias("_n"))
    sparse = _join(points, cells.where(F.col("size") < min_points).select(*by, "cell"), [*by, "cell"])
    met = _join(sparse, _near_by(edges), [*by, "cell"]).where(F.abs(F.col("v") - F.col("_v")) <= F.lit(eps))
    counted = met.groupBy(*by, "cell", "v").agg((F.sum("_n") >= min_points).alias("core"))
    counted = written(counted, "density-counts")
    dense = cells.where(F.col("size") >= min_points).select(*by, "cell", "least", "most")
    few = counted.where("core").groupBy(*by, "cell").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return dense.unionByName(few), counted.where("NOT core").select(*by, "cell", "v")


def _numbered(cores: DataFrame, by: list[str], eps: float) -> DataFrame:
    """``cluster``: number of each core cell's cluster in its bucket, from 0 at the lowest."""
    sliced = cores.withColumn("_slice", F.floor(F.col("cell") / SLICE))
    in_slice = Window.partitionBy(*by, "_slice").orderBy("cell")
    ends = sliced.groupBy(*by, "_slice").agg(F.max("most").alias("_end"))
    over_slices = Window.partitionBy(*by).orderBy("_slice")
    carried = ends.select(*by, "_slice", F.lag("_end").over(over_slices).alias("_end"))
    before = F.coalesce(F.lag("most").over(in_slice), F.col("_end"))
    gaps = _join(sliced, carried, [*by, "_slice"])
    gaps = gaps.withColumn("_gap", F.coalesce(F.col("least") - before > F.lit(eps), F.lit(False)).cast("int"))
    gaps = gaps.withColumn("_run", F.sum("_gap").over(in_slice))
    totals = gaps.groupBy(*by, "_slice").agg(F.sum("_gap").alias("_total"))
    totals = totals.select(*by, "_slice", (F.sum("_total").over(over_slices) - F.col("_total")).alias("_past"))
    numbered = _join(gaps, totals, [*by, "_slice"])
    return numbered.select(*by, "cell", "least", "most", (F.col("_run") + F.col("_past")).cast("int").alias("cluster"))


def density_clusters(df: DataFrame, by: list[str], value: str, eps: float, min_points: int) -> DataFrame:
    """``df`` with ``cluster`` (null for noise and for values that are null or NaN) and
    ``outlier`` (true for noise only)."""
    usable = df.select(*by, F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')")
    cell: Column = F.floor(F.col("v") / F.lit(eps / 2)).cast("bigint")
    points = usable.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n")).withColumn("cell", cell)
    points = written(points, "density-points")
    cells = points.groupBy(*by, "cell").agg(F.sum("n").alias("size"), F.min("v").alias("least"), F.max("v").alias("most"))
    cores, others = _core_cells(points, cells, by, eps, min_points)
    numbered = written(_numbered(cores, by, eps), "density-clusters")

    # a value that is no core: the nearest core is the near end of a cell near by
    ends = numbered.select(*by, "cell", "cluster", F.explode(F.array("least", "most")).alias("_core"))
    near = _join(others, _near_by(ends), [*by, "cell"]).withColumn("_far", F.abs(F.col("v") - F.col("_core"))).where(F.col("_far") <= F.lit(eps))
    border = near.groupBy(*by, "v").agg(F.min(F.struct("_far", "_core", "cluster"))["cluster"].alias("cluster"))

    core_values = _join(points.select(*by, "v", "cell"), numbered.select(*by, "cell", "cluster"), [*by, "cell"])
    core_values = core_values.join(others.select(*[F.col(c).alias(f"_o_{c}") for c in by], F.col("v").alias("_ov")), [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in by] + [F.col("v") == F.col("_ov")], "left_anti")
    placed = core_values.select(*by, "v", "cluster").unionByName(border).withColumnRenamed("v", "_v").withColumn("_in", F.lit(True))
    out = _join(df.withColumn("_v", F.col(value).cast("double")), placed, [*by, "_v"], "left")
    finite = F.col("_v").isNotNull() & ~F.isnan("_v")
    return out.withColumn("outlier", finite & F.col("_in").isNull()).drop("_v", "_in")
