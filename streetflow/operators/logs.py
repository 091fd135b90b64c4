"""Log-line operators (L1-L12): volumes, field parsing, unwrap, patterns,
series ordering, line filters and field profiles.

Whole lines are processed; parsing is done with built-in JSON / regex
expressions, and fields are exploded to rows (never built into a map with
possibly duplicate keys).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.operators.quantiles import _join
from streetflow.session import written


# --- fixed values: our pattern rule and the logfmt pair shape -------------------
HEX_RUN = r"[0-9a-fA-F]{16,}"
DIGIT_RUN = r"[0-9]+"
LOGFMT_PAIR = r"([A-Za-z_][A-Za-z0-9_.]*)=(\"[^\"]*\"|[^\s]+)"


def split_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Documents -> one row per line (0-based ``line_no``), every line kept."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def volume(df: DataFrame, keys: list[Column | str]) -> DataFrame:
    """L1: line count per bucket and label (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("volume"))


def label_volumes(df: DataFrame, labels: list[str], limit: int | None = None) -> DataFrame:
    """L2: total volume per (label, value) across several labels, largest first; all of them unless ``limit`` is given."""
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(lb).alias("label"), F.col(lb).cast("string").alias("value")) for lb in labels])
        ).alias("lv")
    ).select("lv.*")
    out = stacked.groupBy("label", "value").agg(F.count(F.lit(1)).alias("volume"))
    out = out.orderBy(F.col("volume").desc(), "label", "value")
    return out.limit(limit) if limit else out


def json_map(line: Column) -> Column:
    """L3 step 1: a JSON object line -> map of its top-level fields as text; null otherwise."""
    return F.from_json(line, "map<string,string>")


def logfmt_pairs(line: Column) -> Column:
    """L3 step 2: ``key=value`` pairs of a logfmt line (quoted values kept whole)."""
    return F.regexp_extract_all(line, F.lit(LOGFMT_PAIR), 0)


def parsed_fields(df: DataFrame, ids: list[str], line: str = "line", nth: bool = False) -> DataFrame:
    """L3: one row per parsed field, ``(ids..., parser, key, value)``, and with ``nth`` the
    field's number among those of its line that have its key.

    JSON lines give their top-level fields; other lines their logfmt pairs.
    A line with no field (or that fails to parse) is kept once with nulls --
    the parse error is not turned into a label.
    """
    j = json_map(F.col(line))
    pairs = F.transform(
        logfmt_pairs(F.col(line)),
        lambda p: F.struct(
            F.lit("logfmt").alias("parser"),
            F.substring_index(p, "=", 1).alias("key"),
            F.regexp_replace(F.substring(p, F.length(F.substring_index(p, "=", 1)) + 2, 1 << 30), '^"|"$', "").alias(
                "value"
            ),
        ),
    )
    from_json_ = F.transform(
        F.map_entries(j),
        lambda e: F.struct(F.lit("json").alias("parser"), e["key"].alias("key"), e["value"].alias("value")),
    )
    fields = F.when(j.isNotNull(), from_json_).otherwise(pairs)
    if not nth:
        return df.select(*ids, F.explode_outer(fields).alias("f")).select(*ids, "f.parser", "f.key", "f.value")
    keys = F.transform(F.col("fs"), lambda f: f["key"])
    numbered = F.transform(F.col("fs"), lambda f, i: F.struct(f["parser"].alias("parser"), f["key"].alias("key"), f["value"].alias("value"),
                           F.size(F.filter(F.slice(keys, 1, i + 1), lambda k: k == f["key"])).alias("nth")))
    rows = df.select(*ids, fields.alias("fs")).select(*ids, F.explode_outer(numbered).alias("f"))
    return rows.select(*ids, "f.parser", "f.key", "f.value", "f.nth")


def unwrap_avg(df: DataFrame, keys: list[Column | str], value: Column) -> DataFrame:
    """L4: average of a numeric field; values that are not numbers are skipped."""
    return (
        df.withColumn("_v", value.try_cast("double"))
        .where(F.col("_v").isNotNull())
        .groupBy(*keys)
        .agg(F.avg("_v").alias("avg_value"), F.count(F.lit(1)).alias("n"))
    )


def mask_pattern(line: Column) -> Column:
    """L5 (our rule): long hex runs -> ``<hex>``, then digit runs -> ``<num>``."""
    return F.regexp_replace(F.regexp_replace(line, HEX_RUN, "<hex>"), DIGIT_RUN, "<num>")


def patterns(df: DataFrame, line: str, bucket: str, level: str, limit: int | None = None) -> DataFrame:
    """Pattern roll-up: total, buckets seen, set of levels; with ``limit`` only
    the largest patterns (ties by pattern text).  One aggregation: counts combine
    map-side and the level set per pattern is bounded by the number of levels."""
    p = df.withColumn("pattern", mask_pattern(F.col(line)))
    out = p.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(bucket).alias("n_buckets"),
        F.array_join(F.array_sort(F.collect_set(level)), ",").alias("levels"),
    )
    out = out.orderBy(F.col("total").desc(), "pattern")
    return out.limit(limit) if limit else out


def pattern_samples(df: DataFrame, line: str, bucket: str) -> DataFrame:
    """L5 over time: samples of every pattern per bucket, ``(pattern, bucket, n)``."""
    return df.withColumn("pattern", mask_pattern(F.col(line))).groupBy("pattern", bucket).agg(F.count(F.lit(1)).alias("n"))


def series_stats(df: DataFrame, series: str, value: str) -> DataFrame:
    """One number per series for ordering: stdDev, sum, max, min, p50, p90.

    The input is one value per (series, bucket), so a series holds at most the
    number of buckets in the range; the plain ``percentile`` map stays bounded."""
    return df.groupBy(series).agg(
        F.stddev_pop(value).alias("stddev"),
        F.sum(value).alias("sum"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.percentile(F.col(value), 0.5).alias("p50"),
        F.percentile(F.col(value), 0.9).alias("p90"),
    )


def change_points(df: DataFrame, series: str, bucket: str, value: str, slice_: Column) -> DataFrame:
    """L6 "most relevant": per series how far its mean shifts at the best place to cut it in
    two, and that place.

    With S_k the sum of the first k of n values, the score is the largest
    ``|S_k - S_n k / n|`` over the standard deviation times sqrt(n), 0 for a constant series,
    and ``changed_at`` the bucket after the (first) largest.  ``slice_`` cuts time into
    ordered pieces: sums run within a piece and go on from the sums of the pieces before,
    one row each, so no task sorts the history of a series."""
    rows = df.where(F.col(value).isNotNull()).withColumn("_slice", slice_)
    pieces = rows.groupBy(series, "_slice").agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    past = Window.partitionBy(series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(series, "_slice", *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"{c}_before") for c in ("_sum", "_n")])
    whole = df.groupBy(series).agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.stddev_pop(value).alias("sd"))
    in_slice = Window.partitionBy(series, "_slice").orderBy(bucket)
    running = _join(rows, before, [series, "_slice"]).select(
        series,
        bucket,
        (F.row_number().over(in_slice) + F.col("_n_before")).alias("k"),
        (F.sum(value).over(in_slice) + F.col("_sum_before") - F.col(value)).alias("s_past"),
    )
    placed = _join(running, whole, [series])
    # the cut before this row: k - 1 values on the left
    shift = F.abs(F.col("s_past") * F.col("n") - F.col("total") * (F.col("k") - 1)).cast("double")
    cut = placed.where("k > 1").groupBy(series).agg(F.max(F.struct(shift.alias("shift"), (-F.col("k")).alias("k"), F.col(bucket).alias("at"))).alias("cut"))
    out = _join(whole, cut, [series], "left")
    score = F.col("cut.shift") / F.col("n") / (F.col("sd") * F.sqrt(F.col("n").cast("double")))
    return out.select(
        series,
        "n",
        F.when(F.col("sd") > 0, score).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("sd") > 0, F.col("cut.at")).alias("changed_at"),
    )


def rank_series(stats: DataFrame, by: str, name: str, descending: bool = True) -> DataFrame:
    """L6 ordering (desc by default, ties by name), without putting all series into one
    task: the series are range-partitioned in that order and written; a rank is the
    row number in its partition plus the sizes of the partitions before (one number
    each)."""
    order = [F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last(), F.col(name)]
    ranged = written(stats.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked-series")
    sizes, before = [], 0
    for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():
        sizes.append((r["_part"], before))
        before += r["n"]
    offsets = F.broadcast(stats.sparkSession.createDataFrame(sizes, "_part int, _before long"))  # a row per partition
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = ranged.withColumn("rank", inside).join(offsets, "_part")
    return ranked.withColumn("rank", (F.col("rank") + F.col("_before")).cast("int")).drop("_part", "_before")


def values_of(df: DataFrame, label: str, most: int = 64) -> list[str]:
    """The distinct values of a label, in order, where each is to become a column; raises
    beyond ``most`` of them, so none is left out without a word."""
    found = [r[0] for r in df.where(F.col(label).isNotNull()).select(label).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{label} has more than {most} values")
    return sorted(found)


def outer_join_series(frames: dict[str, DataFrame], time_col: str, value: str) -> DataFrame:
    """Full outer join of several series on time (union of timestamps)."""
    out = None
    for name, f in frames.items():
        f = f.select(time_col, F.col(value).alias(name))
        out = f if out is None else out.join(f, time_col, "full")
    return out


def line_filter(
    df: DataFrame,
    line: str = "line",
    contains: list[str] | None = None,
    not_contains: list[str] | None = None,
    regex: list[str] | None = None,
    not_regex: list[str] | None = None,
) -> DataFrame:
    """``|=``, ``!=``, ``|~``, ``!~`` line filters in order."""
    c = F.col(line)
    cond = F.lit(True)
    for s in contains or []:
        cond = cond & c.contains(s)
    for s in not_contains or []:
        cond = cond & ~c.contains(s)
    for r in regex or []:
        cond = cond & c.rlike(r)
    for r in not_regex or []:
        cond = cond & ~c.rlike(r)
    return df.where(cond)


_FIELD = re.compile(r"\{\{\s*\.([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def line_format(template: str) -> Column:
    """L8 ``line_format``: ``{{.field}}`` placeholders filled from columns."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        parts.append(F.coalesce(F.col(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def bytes_volume(df: DataFrame, keys: list[Column | str], line: str = "line") -> DataFrame:
    """UTF-8 bytes of the lines per bucket and label."""
    return df.groupBy(*keys).agg(F.sum(F.octet_length(line)).alias("bytes"))


def infer_type(value: Column) -> tuple[Column, Column]:
    """(is integer, is number) flags for one field value."""
    return value.try_cast("bigint").isNotNull(), value.try_cast("double").isNotNull()


def _type_of(is_int: Column, is_num: Column) -> Column:
    return F.when(F.every(is_int), F.lit("int")).when(F.every(is_num), F.lit("float")).otherwise(F.lit("string"))


def cardinality_sketches(fields: DataFrame, day: Column) -> DataFrame:
    """L10, mergeable: ``(day, key, values, lines)`` with a distinct sketch (HyperLogLog, 12 bits)
    of the values of every field and day.  Stored once, the sketches of any range of days
    merge without another look at the lines."""
    named = fields.where(F.col("key").isNotNull())
    return named.groupBy(day.alias("day"), "key").agg(F.hll_sketch_agg("value", 12).alias("values"), F.count(F.lit(1)).alias("n_fields"))


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """Distinct values of each field over the days of ``sketches``, by merging; the standard
    error of 2^12 registers is about 1.3 %."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("values"))
    return sketches.groupBy("key").agg(merged.alias("n_values"), F.sum("n_fields").alias("n_fields"), F.count(F.lit(1)).alias("n_days"))


def label_profile(labels: DataFrame, n_lines: DataFrame) -> DataFrame:
    """L10 + L11 for stream labels: ``labels`` = ``(key, value, weight)`` with one
    row per labelled unit (an event, a document) and ``weight`` = its lines.
    Every line of a unit carries the unit's labels, so lines = sum of weights."""
    is_int, is_num = infer_type(F.col("value"))
    prof = labels.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.count_distinct("value").alias("n_values"),
        _type_of(is_int, is_num).alias("type"),
        F.lit("label").alias("parsers"),
        F.sum("weight").cast("bigint").alias("n_lines"),
    )
    return prof.withColumn("pct_lines", F.try_divide(F.col("n_lines") * 100.0, n_lines.scalar()))


def field_profile(fields: DataFrame, line_id: list[str], n_lines: DataFrame) -> DataFrame:
    """L10 + L11: per field name: distinct values, inferred type, parsers that found it,
    lines carrying it and their share of all lines.

    ``fields`` = ``(line_id..., parser, key, value)`` rows, with ``nth`` (the field's number among
    its line's fields of that key, as ``parsed_fields`` gives it) unless it is to be found by
    a window; ``n_lines`` a one-row, one-column DataFrame with the line total, used as a
    scalar subquery.
    """
    is_int, is_num = infer_type(F.col("value"))
    f = fields.where(F.col("key").isNotNull()).withColumns({"_i": is_int, "_n": is_num})
    # a line counts for the first of its fields of a key, so one distinct is left, over values
    once = Window.partitionBy(*line_id, "key").orderBy(F.lit(1))
    if "nth" not in f.columns:
        f = f.withColumn("nth", F.row_number().over(once))
    prof = f.groupBy("key").agg(
        F.count_distinct("value").alias("n_values"),
        _type_of(F.col("_i"), F.col("_n")).alias("type"),
        F.array_join(F.array_sort(F.collect_set("parser")), ",").alias("parsers"),
        F.count_if(F.col("nth") == 1).alias("n_lines"),
    )
    return prof.withColumn("pct_lines", F.try_divide(F.col("n_lines") * 100.0, n_lines.scalar()))
