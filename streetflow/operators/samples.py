"""Time-series sample operators (M1-M15): aggregation by labels, quantiles,
top-k, counters, range folds, offsets, histograms, label matching and set
operations on label sets.

Input is a long sample table ``(labels..., ts, value)``.  Everything is a
built-in expression: aggregates combine map-side before their shuffle, and
every window is partitioned by a series (or bucket) key, never global.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.functions.timeutil import bucket_start
from streetflow.operators.quantiles import _join, exact_quantiles, qname
from streetflow.session import written

# --- fixed values: metric-type rules by name ------------------------------------
COUNTER_SUFFIX = r"_(count|total|sum)$"
HISTOGRAM_SUFFIX = "_bucket"
AGE_SUFFIX = "_timestamp_seconds"
STATUS_NAME, STATUS_SUFFIX = "up", r"_up$"
INFO_SUFFIX = "_info"


def metric_type(name: Column) -> Column:
    """M1: counter / classic-histogram / age / status-updown / info / gauge from the name."""
    return (
        F.when(name.rlike(COUNTER_SUFFIX), F.lit("counter"))
        .when(name.endswith(HISTOGRAM_SUFFIX), F.lit("classic-histogram"))
        .when(name.endswith(AGE_SUFFIX), F.lit("age"))
        .when((name == STATUS_NAME) | name.rlike(STATUS_SUFFIX), F.lit("status-updown"))
        .when(name.endswith(INFO_SUFFIX), F.lit("info"))
        .otherwise(F.lit("gauge"))
    )


AGGREGATES = {
    "sum": lambda v: F.sum(v),
    "min": lambda v: F.min(v),
    "max": lambda v: F.max(v),
    "avg": lambda v: F.avg(v),
    "count": lambda v: F.count(v),
    "stddev": lambda v: F.stddev_pop(v),  # population form, as in the query language
    "stdvar": lambda v: F.var_pop(v),
    "group": lambda v: F.lit(1),
}


def aggregate(df: DataFrame, by: list[str], value: str, ops: list[str]) -> DataFrame:
    """M2 ``op by (labels)``: one row per label set (partial aggregation first)."""
    return df.groupBy(*by).agg(*[AGGREGATES[o](F.col(value)).alias(o) for o in ops])


def aggregate_without(df: DataFrame, labels: list[str], without: list[str], value: str, ops: list[str]) -> DataFrame:
    """M2 ``op without (labels)``: group by every label not listed."""
    return aggregate(df, [c for c in labels if c not in without], value, ops)


def count_values(df: DataFrame, by: list[str], value: str, label: str) -> DataFrame:
    """M2 ``count_values``: number of samples per distinct value, the value as a label."""
    return df.groupBy(*by, F.col(value).cast("string").alias(label)).agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, by: list[str], value: str, qs: list[float], exact: bool = True) -> DataFrame:
    """M3: quantiles with linear interpolation, exact and skew-safe
    (``operators.quantiles``); ``exact=False`` uses the ``percentile_approx`` sketch."""
    if exact:
        return exact_quantiles(df, by, value, qs)
    return df.groupBy(*by).agg(
        *[F.percentile_approx(F.col(value), q, 10000).alias(qname(q)) for q in qs]
    )


def topk(df: DataFrame, bucket: list[str], value: str, name: str, k: int, bottom: bool = False) -> DataFrame:
    """M4: k rows per bucket by value, ties by name.  ``row_number() <= k`` plans
    as a WindowGroupLimit below the shuffle, so each task ships at most k rows
    per bucket."""
    order = [F.col(value).asc() if bottom else F.col(value).desc(), F.col(name).asc()]
    w = Window.partitionBy(*bucket).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def counter_deltas(df: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """M5: reset-aware difference to the previous sample of the same series
    (a drop means the counter restarted, so the new value is the increase).

    A series is cut by day, so no task holds its whole history: the first sample of a
    day looks back at the last one of the series' previous day, from a table of one
    row per series and day."""
    df = df.withColumn("_day", F.to_date(ts))
    lasts = df.groupBy(*series, "_day").agg(F.max_by(F.struct(F.col(value).alias("v")), ts).alias("_l"))
    before = F.lag("_l").over(Window.partitionBy(*series).orderBy("_day"))
    df = _join(df, lasts.select(*series, "_day", before.alias("_carry")), [*series, "_day"])
    in_day = Window.partitionBy(*series, "_day").orderBy(ts)
    prev = F.when(F.row_number().over(in_day) == 1, F.col("_carry.v")).otherwise(F.lag(value).over(in_day))
    df = df.withColumn("_prev", prev)
    prev = F.col("_prev")
    delta = F.when(prev.isNull(), F.lit(None)).when(F.col(value) >= prev, F.col(value) - prev).otherwise(F.col(value))
    return df.withColumn("delta", delta).drop("_day", "_carry", "_prev")


def increase(df: DataFrame, series: list[str], by: list[str], ts: str, value: str, bucket_s: int) -> DataFrame:
    """M5: ``increase`` and ``rate`` per bucket: sum of deltas in the bucket (rate = / width).
    No extrapolation to the bucket edges."""
    d = counter_deltas(df, series, ts, value).withColumn("bucket", bucket_start(F.col(ts), bucket_s))
    return d.groupBy("bucket", *by).agg(F.sum("delta").alias("increase")).withColumn(
        "rate", F.col("increase") / F.lit(float(bucket_s))
    )


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(duration: str) -> int:
    """Seconds of a fixed duration such as ``6 hours``."""
    number, unit = duration.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def _merged_moment(panes: Column) -> Column:
    """The squared deviations of several parts ``(n, mean, m2)`` about their common mean."""

    def merge(a: Column, b: Column) -> Column:
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + d * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.filter(panes, lambda p: p["n"] > 0), start, merge)["m2"]


def over_time(
    df: DataFrame, series: list[str], ts: str, value: str, range_: str, step: str, order: list[str] | None = None,
    qs: tuple[float, ...] = (0.5,), names: tuple[str, ...] | None = ("median",)
) -> DataFrame:
    """M6: ``*_over_time`` folds per series over sliding windows of ``range_`` every ``step``;
    ``qs`` are the quantiles of ``quantile_over_time``, ``names`` their columns.

    A sample is folded once, into its pane (the widest that divides every window); the
    windows then merge the partial folds of their panes.  Only the quantiles, which have
    no partial form, see each sample in all windows that hold it."""
    last_key = F.struct(F.col(ts), *[F.col(c) for c in (order or [])])
    pane = math.gcd(_seconds(range_), _seconds(step))
    panes = df.groupBy(F.window(ts, f"{pane} seconds").start.alias("_pane"), *series).agg(
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.avg(value).alias("_mean"),
        (F.var_pop(value) * F.count(value)).alias("_m2"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.max_by(value, last_key).alias("_last"),
        F.max(last_key).alias("_last_at"),
    )
    part = F.struct(F.col("_n").alias("n"), F.col("_mean").alias("mean"), F.col("_m2").alias("m2"))
    folds = panes.withColumn("w", F.window("_pane", range_, step)).groupBy("w", *series).agg(
        F.sum("_sum").alias("sum"),
        F.sum("_n").alias("count"),
        F.max_by("_last", "_last_at").alias("last"),
        F.max("_max").alias("max"),
        F.min("_min").alias("min"),
        F.lit(1).alias("present"),
        F.collect_list(part).alias("_parts"),  # one for each pane of the window
    )
    stdvar = F.when(F.col("count") > 0, _merged_moment(F.col("_parts")) / F.col("count"))
    folds = folds.withColumns({"avg": F.try_divide("sum", "count"), "stdvar": stdvar}).withColumn("stddev", F.sqrt("stdvar"))
    samples = df.select(F.window(ts, range_, step).alias("w"), *series, value)
    ranked = exact_quantiles(samples, ["w", *series], value, list(qs), names=list(names) if names else None)
    out = _join(folds.drop("_parts"), ranked, ["w", *series], "left")
    kept = ["avg", "count", "last", "max", "min", "present", "stddev", "stdvar", "sum"]
    found = [c for c in ranked.columns if c not in ("w", *series)]
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *series, *kept, *found)


def offset(df: DataFrame, series: list[str], bucket: str, value: str, seconds: int) -> DataFrame:
    """M7: the same series' value ``seconds`` earlier, by an equi-join on the shifted bucket."""
    past = df.select(
        *series,
        F.timestamp_add("SECOND", F.lit(seconds), F.col(bucket)).alias(bucket),
        F.col(value).alias(f"{value}_offset"),
    )
    return df.join(past, [*series, bucket], "left")


def le_label(le: float) -> str:
    return "+Inf" if le == float("inf") else (str(int(le)) if float(le).is_integer() else str(le))


def cumulative_buckets(df: DataFrame, by: list[str], value: str, les: list[float]) -> DataFrame:
    """M8: classic-histogram cumulative counts ``c_<le>`` per group in one aggregate pass."""
    aggs = []
    for le in les:
        cond = F.col(value).isNotNull() if le == float("inf") else (F.col(value) <= F.lit(le))
        aggs.append(F.count_if(cond).alias(f"c_{le_label(le)}"))
    return df.groupBy(*by).agg(*aggs)


def counter_buckets(
    df: DataFrame, by: list[str], le: str, ts: str, value: str, bucket_s: int, les: list[float]
) -> DataFrame:
    """M8 from stored counters: ``(labels, le, ts, counter)`` samples, one series per bound
    label, -> per time bucket and labels the increase of each bound as ``c_<le>``, ready
    for ``histogram_quantile``.  Counter restarts are those of M5."""
    inc = increase(df, [*by, le], [*by, le], ts, value, bucket_s)
    counts = [
        F.coalesce(F.sum(F.when(F.col(le) == le_label(x), F.col("increase"))), F.lit(0)).alias(f"c_{le_label(x)}")
        for x in les
    ]
    return inc.groupBy("bucket", *by).agg(*counts)


def histogram_quantile(q: float, les: list[float]) -> Column:
    """M8: quantile from cumulative bucket counts with linear interpolation inside the
    first bucket reaching the rank; the +Inf bucket answers with the last finite bound."""
    total = F.col(f"c_{le_label(les[-1])}")
    rank = F.lit(q) * total
    expr = None
    prev_le, prev_c = F.lit(0.0), F.lit(0).cast("bigint")
    for i, le in enumerate(les):
        c = F.col(f"c_{le_label(le)}")
        if le == float("inf"):
            val = F.lit(float(les[i - 1])) if i > 0 else F.lit(None).cast("double")
        else:
            val = prev_le + F.try_divide((F.lit(float(le)) - prev_le) * (rank - prev_c), c - prev_c)
        expr = F.when(c >= rank, val) if expr is None else expr.when(c >= rank, val)
        prev_le, prev_c = F.lit(float(le)), c
    return F.when(total > 0, expr.otherwise(F.lit(None)))


def le_bin(value: Column, les: list[float]) -> Column:
    """M8 heatmap: label of the first bucket holding the value (non-cumulative)."""
    expr = None
    for le in les:
        cond = value.isNotNull() if le == float("inf") else (value <= F.lit(le))
        expr = F.when(cond, F.lit(le_label(le))) if expr is None else expr.when(cond, F.lit(le_label(le)))
    return expr


def matchers(rules: list[tuple[str, str, str]]) -> Column:
    """Label matchers ``=``, ``!=``, ``=~``, ``!~``; a missing label is the empty one
    for all four; regexes are fully anchored."""
    cond = F.lit(True)
    for label, op, pat in rules:
        c = F.coalesce(F.col(label).cast("string"), F.lit(""))
        anchored = f"^(?:{pat})$"
        m = {"=": c == F.lit(pat), "!=": c != F.lit(pat), "=~": c.rlike(anchored), "!~": ~c.rlike(anchored)}[op]
        cond = cond & m
    return cond


def finite(value: Column) -> Column:
    """``x and x > -Inf`` style guard: drop -Inf and NaN samples."""
    return (value > F.lit(float("-inf"))) & ~F.isnan(value)


def _null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    cond = None
    for c in on:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def set_and(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """M12 ``and``: left series whose label set also appears on the right."""
    return left.join(right.select(*on), _null_safe(left, right.select(*on), on), "left_semi")


def set_unless(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """M12 ``unless``: left series without a match on the right."""
    return left.join(right.select(*on), _null_safe(left, right.select(*on), on), "left_anti")


def set_or(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """M12 ``or``: all left series plus right series whose label set is not on the left."""
    extra = right.join(left.select(*on), _null_safe(right, left.select(*on), on), "left_anti")
    return left.unionByName(extra)


def label_replace(src: Column, regex: str, replacement: str, dst: Column | None = None) -> Column:
    """Full-match ``regex`` on ``src``; on a match the destination becomes the
    replacement (``$1`` groups), otherwise it keeps its current value."""
    anchored = f"^(?:{regex})$"
    keep = dst if dst is not None else F.lit(None).cast("string")
    return F.when(F.coalesce(src, F.lit("")).rlike(anchored), F.regexp_replace(F.coalesce(src, F.lit("")), anchored, replacement)).otherwise(keep)


def label_join(sep: str, *labels: Column) -> Column:
    """Concatenate label values with a separator (missing labels as empty)."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in labels])


def name_prefix(name: Column, sep: str = "_") -> Column:
    """First token of a metric name."""
    return F.substring_index(name, sep, 1)


def mad_outliers(df: DataFrame, bucket: str, value: str, k: float = 3.0) -> DataFrame:
    """``outlier``: whether a sample lies more than ``k * 1.4826 * MAD`` from its bucket's
    median.  Two grouped passes, each a small per-bucket table joined back on the bucket; the
    medians are written once, as the second pass reads them several times."""
    # med / mad hold one row per bucket; whether that is small enough to broadcast
    # is for the optimizer to see at run time
    med = written(exact_quantiles(df, [bucket], value, [0.5], names=["med"]), "medians")
    d = df.join(med, bucket).withColumn("dev", F.abs(F.col(value) - F.col("med")))
    mad = exact_quantiles(d, [bucket], "dev", [0.5], names=["mad"])
    return d.join(mad, bucket).withColumn("outlier", F.col("dev") > F.lit(k * 1.4826) * F.col("mad"))


def flag_runs(flagged: DataFrame, series: str, bucket: str, flag: str, slice_: Column) -> DataFrame:
    """Per series the number of buckets, of flagged ones, and of runs of consecutive
    flagged ones; score = -runs, the source's order by outliers.

    ``slice_`` cuts time into ordered pieces (a day, a month).  Runs are counted within a
    piece, and a piece is summed up as (first flag, last flag, runs); these few summaries
    merge into the series' runs, so no task sorts the history of a series."""
    in_slice = Window.partitionBy(series, "_slice").orderBy(bucket)
    sliced = flagged.withColumn("_slice", slice_).withColumn("_flag", F.coalesce(flag, F.lit(False)))
    starts = sliced.withColumn("_start", F.col("_flag") & ~F.coalesce(F.lag("_flag").over(in_slice), F.lit(False)))
    pieces = starts.groupBy(series, "_slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_flag").alias("flags"),
        F.count_if("_start").alias("runs"),
        F.min_by("_flag", bucket).alias("first"),
        F.max_by("_flag", bucket).alias("last"),
    )
    summary = F.array_sort(F.collect_list(F.struct("_slice", "first", "last", "runs")))
    merged = pieces.groupBy(series).agg(F.sum("n").alias("n_buckets"), F.sum("flags").alias("n_outliers"), summary.alias("_pieces"))

    def merge(a: Column, p: Column) -> Column:
        going_on = (a["last"] & p["first"]).cast("bigint")
        return F.struct((a["runs"] + p["runs"] - going_on).alias("runs"), p["last"].alias("last"))

    start = F.struct(F.lit(0).cast("bigint").alias("runs"), F.lit(False).alias("last"))
    runs = F.aggregate("_pieces", start, merge)["runs"]
    return merged.withColumn("n_runs", runs).drop("_pieces").withColumn("score", -F.col("n_runs"))
