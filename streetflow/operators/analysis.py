"""Batch-layer analysis: geometry flattening, daily statistics, windows, lines
(G1, P5, P6, A1-A4, P7, W1, R3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.schema import ARRIVAL


def flatten_points(archive: DataFrame, keep_seq: bool = True) -> DataFrame:
    """G1 + P5 + P6: one row per point of ``geo_shape.geometry.coordinates``.

    ``posexplode_outer`` keeps one row with null ``point_order`` for a null or
    empty line.  Point item 1 is the latitude and item 0 the longitude; ``get``
    returns null for a short point instead of raising under ANSI.  Narrow: no
    shuffle, and nested column pruning reads only the coordinates.
    """
    extra = [c for c in ARRIVAL if keep_seq and c in archive.columns]
    return archive.select(
        "date_time",
        "denomination",
        "traffic_status",
        "hierarchie",
        *extra,
        F.posexplode_outer("geo_shape.geometry.coordinates").alias("point_order", "coords"),
    ).select(
        "date_time",
        "denomination",
        "traffic_status",
        "point_order",
        F.get("coords", 1).alias("latitude"),
        F.get("coords", 0).alias("longitude"),
        "hierarchie",
        *extra,
    )


def speed_stats(df: DataFrame, keys: list[str], suffix: str = "today") -> DataFrame:
    """A1-A3 + P7: per group average speed, maximum limit and their ratio.

    Null group keys form their own group; averages ignore nulls; the ratio is
    null when the maximum is 0 or null (``try_divide``).  Partial aggregation
    runs before the shuffle, so hot streets are combined map-side.
    """
    avg_c, max_c = f"avg_speed_{suffix}", f"max_speed_{suffix}"
    return (
        df.groupBy(*keys)
        .agg(F.avg("avg_speed").alias(avg_c), F.max("max_speed").alias(max_c))
        .withColumn(f"speed_ratio_{suffix}", F.try_divide(F.col(avg_c), F.col(max_c)))
    )


def daily_analysis(day_rows: DataFrame) -> DataFrame:
    """The batch layer's daily table: rows of one day grouped by street and hierarchy."""
    return speed_stats(day_rows, ["denomination", "hierarchie"], "today")


def daily_stats_all_days(archive: DataFrame) -> DataFrame:
    """A4: the same statistics per day over the whole history."""
    return speed_stats(archive, ["date_partition", "denomination", "hierarchie"], "day")


def tumbling_average(
    df: DataFrame, ts: str, keys: list[str], width: str = "9 minutes", value: str = "avg_speed"
) -> DataFrame:
    """Event-time tumbling windows per key (epoch aligned), average and count.

    Works on a batch or a streaming DataFrame (add ``withWatermark`` upstream
    for append-mode streaming).
    """
    return (
        df.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.avg(value).alias("avg_speed"), F.count(F.lit(1)).alias("n_records"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *keys,
            "avg_speed",
            "n_records",
        )
    )


def _point_text(p: Column) -> Column:
    return F.format_string("%.6f %.6f", p["longitude"], p["latitude"])


def rebuild_lines(points: DataFrame, keys: list[str]) -> DataFrame:
    """Put the stored points of one line back in ``point_order``.

    The group is one source record (its keys plus its arrival order), so its
    size is bounded by the length of one geometry, never by a street's history.
    Output: point count and the line as ``lon lat`` pairs.
    """
    pts = points.where(F.col("point_order").isNotNull())
    return pts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("point_order", "longitude", "latitude"))),
                _point_text,
            ),
            ",",
        ).alias("line"),
    )
