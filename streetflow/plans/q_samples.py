"""Time-series sample queries (Tier 3, M1-M15).

Stand-ins (FIXTURES §5): gauge samples = events (labels event_type, user_id;
value = value); counter samples = per (event_type, user_id) hourly running
count of events that restarts every day; histogram = lineitem quantities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.functions.rounding import rnd
from streetflow.functions.timeutil import bucket_start, day_of, epoch_micros
from streetflow.operators.density import density_clusters
from streetflow.operators.samples import (
    aggregate,
    aggregate_without,
    count_values,
    counter_buckets,
    cumulative_buckets,
    finite,
    flag_runs,
    histogram_quantile,
    increase,
    label_join,
    label_replace,
    le_bin,
    le_label,
    mad_outliers,
    matchers,
    metric_type,
    name_prefix,
    offset,
    over_time,
    quantiles,
    set_and,
    set_or,
    set_unless,
    topk,
)
from streetflow.registry import query
from streetflow.sources.standins import max_speed_of
from streetflow.sources.tables import read_table

HOUR_US = 3_600_000_000
DAY_SQL = "strftime(ts, '%Y-%m-%d')"


def gauges(spark: SparkSession, root: str) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.select("event_id", "event_type", "user_id", "ts", "value", max_speed_of(F.col("props")).alias("k"))


def counters(spark: SparkSession, root: str) -> DataFrame:
    """Hourly samples of a per-series counter that restarts each day.

    The hourly count is an aggregate (map-side combined), so the running-sum
    window afterwards sees at most 24 rows per (series, day), however hot a
    series is.
    """
    ev = read_table(spark, root, "events")
    hourly = ev.groupBy("event_type", "user_id", bucket_start(F.col("ts"), 3600).alias("ts")).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("event_type", "user_id", F.to_date("ts")).orderBy("ts")
    return hourly.withColumn("value", F.sum("n").over(w))


def r6(c):
    return rnd(c)


def r6_moment(name: str):
    return rnd(name)


ALL_OPS = ["sum", "min", "max", "avg", "count", "stddev", "stdvar", "group"]


@query(
    "series_aggregates",
    f"""
SELECT {DAY_SQL} AS day, event_type, R6(SUM(value)) AS "sum", MIN(value) AS "min", MAX(value) AS "max",
       R6(AVG(value)) AS "avg", COUNT(value) AS "count", R6(STDDEV_POP(value)) AS "stddev",
       R6(VAR_POP(value)) AS "stdvar", 1 AS "group"
FROM events GROUP BY 1, 2
""",
)
def q_series_aggregates(spark: SparkSession, root: str) -> DataFrame:
    """M2: sum/min/max/avg/count/stddev/stdvar/group by (day, event_type)."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    out = aggregate(g, ["day", "event_type"], "value", ALL_OPS)
    return out.withColumns(
        {"sum": r6(F.col("sum")), "avg": r6(F.col("avg")), "stddev": r6_moment("stddev"), "stdvar": r6_moment("stdvar")}
    )


@query(
    "count_values",
    f"""
SELECT {DAY_SQL} AS day, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS k,
       COUNT(*) AS n
FROM events GROUP BY 1, 2
""",
)
def q_count_values(spark: SparkSession, root: str) -> DataFrame:
    """M2 count_values: samples per distinct limit value and day."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    return count_values(g, ["day"], "k", "k")


@query(
    "series_quantiles",
    f"""
SELECT {DAY_SQL} AS day, event_type, R6(quantile_cont(value, 0.5)) AS q50,
       R6(quantile_cont(value, 0.9)) AS q90, R6(quantile_cont(value, 0.99)) AS q99
FROM events GROUP BY 1, 2
""",
)
def q_series_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """M3: 50/90/99th percentile across samples per (day, event_type)."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    out = quantiles(g, ["day", "event_type"], "value", [0.5, 0.9, 0.99])
    return out.withColumns({c: r6(F.col(c)) for c in ["q50", "q90", "q99"]})


@query(
    "topk_per_bucket",
    f"""
WITH t AS (SELECT {DAY_SQL} AS day, user_id, SUM(value) AS total FROM events GROUP BY 1, 2)
SELECT day, user_id, R6(total) AS total, CAST(row_number() OVER (PARTITION BY day ORDER BY total DESC, user_id) AS INTEGER) AS rank
FROM t QUALIFY rank <= 3
""",
)
def q_topk_per_bucket(spark: SparkSession, root: str) -> DataFrame:
    """M4: top 3 users by daily total per day, ties by user."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    totals = g.groupBy("day", "user_id").agg(F.sum("value").alias("total"))
    return topk(totals, ["day"], "total", "user_id", 3).withColumn("total", r6(F.col("total")))


COUNTER_SQL = f"""
h AS (SELECT event_type, user_id, make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US}) AS hour, COUNT(*) AS n
      FROM events GROUP BY 1, 2, 3),
c AS (SELECT event_type, user_id, hour,
             CAST(SUM(n) OVER (PARTITION BY event_type, user_id, CAST(hour AS DATE) ORDER BY hour) AS BIGINT) AS counter
      FROM h)"""


@query(
    "bottomk_per_bucket",
    f"""
WITH t AS (SELECT {DAY_SQL} AS day, user_id, SUM(value) AS total FROM events GROUP BY 1, 2)
SELECT day, user_id, R6(total) AS total, CAST(row_number() OVER (PARTITION BY day ORDER BY total ASC, user_id) AS INTEGER) AS rank
FROM t QUALIFY rank <= 3
""",
)
def q_bottomk_per_bucket(spark: SparkSession, root: str) -> DataFrame:
    """M4 bottomk: the 3 users with the smallest daily total per day, ties by user."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    totals = g.groupBy("day", "user_id").agg(F.sum("value").alias("total"))
    return topk(totals, ["day"], "total", "user_id", 3, bottom=True).withColumn("total", r6(F.col("total")))


@query(
    "sum_without",
    f"""
SELECT {DAY_SQL} AS day, event_type, R6(SUM(value)) AS "sum", COUNT(value) AS "count", 1 AS "group"
FROM events GROUP BY 1, 2
""",
)
def q_sum_without(spark: SparkSession, root: str) -> DataFrame:
    """M2 ``without``: sum/count/group over the samples dropping the user label."""
    g = gauges(spark, root).withColumn("day", day_of(F.col("ts")))
    out = aggregate_without(g, ["day", "event_type", "user_id"], ["user_id"], "value", ["sum", "count", "group"])
    return out.withColumn("sum", r6(F.col("sum")))


@query(
    "counter_increase",
    "WITH " + COUNTER_SQL + f""",
d AS (SELECT *, lag(counter) OVER (PARTITION BY event_type, user_id ORDER BY hour) AS prev FROM c),
e AS (SELECT event_type, make_timestamp((epoch_us(hour) // {6 * HOUR_US}) * {6 * HOUR_US}) AS bucket,
             CASE WHEN prev IS NULL THEN NULL WHEN counter >= prev THEN counter - prev ELSE counter END AS delta
      FROM d)
SELECT bucket, event_type, CAST(SUM(delta) AS BIGINT) AS increase, R6(SUM(delta) / 21600.0) AS rate
FROM e GROUP BY 1, 2
""",
)
def q_counter_increase(spark: SparkSession, root: str) -> DataFrame:
    """M5: reset-aware increase and rate of the daily-restarting counters per 6 hours."""
    out = increase(counters(spark, root), ["event_type", "user_id"], ["event_type"], "ts", "value", 21600)
    return out.withColumn("rate", r6(F.col("rate")))


@query(
    "over_time_sliding",
    f"""
WITH x AS (SELECT e.*, (epoch_us(ts) // {HOUR_US} - r.i) * {HOUR_US} AS ws FROM events e, range(6) r(i))
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {6 * HOUR_US}) AS window_end, event_type,
       R6(AVG(value)) AS "avg", COUNT(value) AS "count", last(value ORDER BY ts, event_id) AS "last",
       MAX(value) AS "max", MIN(value) AS "min", 1 AS present, R6(STDDEV_POP(value)) AS stddev,
       R6(VAR_POP(value)) AS stdvar, R6(SUM(value)) AS "sum", R6(quantile_cont(value, 0.5)) AS median
FROM x GROUP BY 1, 2, 3
""",
)
def q_over_time_sliding(spark: SparkSession, root: str) -> DataFrame:
    """M6: *_over_time folds per event type over 6-hour ranges every hour."""
    out = over_time(gauges(spark, root), ["event_type"], "ts", "value", "6 hours", "1 hour", order=["event_id"])
    return out.withColumns(
        {
            "avg": r6(F.col("avg")), "sum": r6(F.col("sum")), "median": r6(F.col("median")),
            "stddev": r6_moment("stddev"), "stdvar": r6_moment("stdvar"),
        }
    )


@query(
    "offset_compare",
    f"""
WITH h AS (SELECT event_type, make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US}) AS bucket, AVG(value) AS value
           FROM events GROUP BY 1, 2)
SELECT a.bucket, a.event_type, R6(a.value) AS value, R6(b.value) AS value_offset, R6(a.value - b.value) AS delta
FROM h a LEFT JOIN h b ON a.event_type = b.event_type AND b.bucket = a.bucket - INTERVAL 1 DAY
""",
)
def q_offset_compare(spark: SparkSession, root: str) -> DataFrame:
    """M7: hourly average next to the same hour one day earlier."""
    g = gauges(spark, root)
    h = g.groupBy("event_type", bucket_start(F.col("ts"), 3600).alias("bucket")).agg(F.avg("value").alias("value"))
    out = offset(h, ["event_type"], "bucket", "value", 86400)
    return out.select(
        "bucket", "event_type", r6(F.col("value")).alias("value"), r6(F.col("value_offset")).alias("value_offset"),
        r6(F.col("value") - F.col("value_offset")).alias("delta"),
    )


LES = [5.0, 10.0, 20.0, 30.0, 40.0, float("inf")]


def _hq_sql(q: float) -> str:
    parts, prev_le, prev_c = [], "0.0", "0"
    for i, le in enumerate(LES):
        c = f'"c_{le_label(le)}"'
        if le == float("inf"):
            val = f"{LES[i - 1]}"
        else:
            val = f"({prev_le} + ({le} - {prev_le}) * ({q} * \"c_+Inf\" - {prev_c}) / ({c} - {prev_c}))"
        parts.append(f"WHEN {c} >= {q} * \"c_+Inf\" THEN {val}")
        prev_le, prev_c = f"{le}", c
    return f"CASE WHEN \"c_+Inf\" > 0 THEN CASE {' '.join(parts)} END END"


def _cum_sql() -> str:
    out = []
    for le in LES:
        cond = "l_quantity IS NOT NULL" if le == float("inf") else f"l_quantity <= {le}"
        out.append(f'COUNT(*) FILTER (WHERE {cond}) AS "c_{le_label(le)}"')
    return ", ".join(out)


@query(
    "histogram_quantile",
    f"""
WITH b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, {_cum_sql()} FROM lineitem GROUP BY 1, 2)
SELECT year, l_returnflag, "c_+Inf" AS total, R6({_hq_sql(0.5)}) AS p50, R6({_hq_sql(0.9)}) AS p90,
       R6({_hq_sql(0.99)}) AS p99
FROM b
""",
)
def q_histogram_quantile(spark: SparkSession, root: str) -> DataFrame:
    """M8: quantiles of l_quantity from classic histogram buckets per (ship year, return flag)."""
    li = read_table(spark, root, "lineitem").withColumn("year", F.year("l_shipdate"))
    b = cumulative_buckets(li, ["year", "l_returnflag"], "l_quantity", LES)
    return b.select(
        "year", "l_returnflag", F.col("`c_+Inf`").alias("total"),
        *[r6(histogram_quantile(q, LES)).alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.99)],
    )


RATE_LES = [50.0, 100.0, 200.0, float("inf")]


def _rate_counters(spark: SparkSession, root: str) -> DataFrame:
    """Hourly samples of one counter per (event type, bound), restarting each day:
    events so far that day with a value up to the bound."""
    ev = read_table(spark, root, "events").where(F.col("value").isNotNull() & F.col("ts").isNotNull())
    hourly = cumulative_buckets(
        ev.withColumn("hour", bucket_start(F.col("ts"), 3600)), ["event_type", "hour"], "value", RATE_LES
    )
    pairs = F.array(*[F.struct(F.lit(le_label(x)).alias("le"), F.col(f"`c_{le_label(x)}`").alias("n")) for x in RATE_LES])
    long = hourly.select("event_type", "hour", F.explode(pairs).alias("p")).select("event_type", "hour", "p.le", "p.n")
    w = Window.partitionBy("event_type", "le", F.to_date("hour")).orderBy("hour")
    return long.select("event_type", "le", "hour", F.sum("n").over(w).alias("counter"))


def _rate_quantile_sql(q: float) -> str:
    parts, prev_le, prev_c = [], "0.0", "0"
    for i, le in enumerate(RATE_LES):
        c = f'"c_{le_label(le)}"'
        if le == float("inf"):
            val = str(RATE_LES[i - 1])
        else:
            val = f"{prev_le} + CASE WHEN {c} <> {prev_c} THEN ({le} - {prev_le}) * ({q} * total - {prev_c}) / ({c} - {prev_c}) END"
        parts.append(f"WHEN {c} >= {q} * total THEN {val}")
        prev_le, prev_c = str(le), c
    return f"CASE WHEN total > 0 THEN CASE {' '.join(parts)} END END"


@query(
    "histogram_rates",
    f"""
WITH b AS (SELECT event_type, make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US}) AS hour, le, lim
           FROM events, (VALUES ('50', 50.0), ('100', 100.0), ('200', 200.0), ('+Inf', 'inf'::DOUBLE)) l(le, lim)
           WHERE value IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
h AS (SELECT b.event_type, b.hour, b.le, COUNT(*) FILTER (WHERE e.value <= b.lim) AS n
      FROM b JOIN events e ON e.event_type IS NOT DISTINCT FROM b.event_type
       AND make_timestamp((epoch_us(e.ts) // {HOUR_US}) * {HOUR_US}) = b.hour AND e.value IS NOT NULL
      GROUP BY 1, 2, 3),
c AS (SELECT *, SUM(n) OVER (PARTITION BY event_type, le, hour::DATE ORDER BY hour) AS counter FROM h),
d AS (SELECT *, lag(counter) OVER (PARTITION BY event_type, le ORDER BY hour) AS prev FROM c),
i AS (SELECT event_type, le, make_timestamp((epoch_us(hour) // {6 * HOUR_US}) * {6 * HOUR_US}) AS bucket,
             SUM(CASE WHEN prev IS NULL THEN NULL WHEN counter >= prev THEN counter - prev ELSE counter END) AS inc
      FROM d GROUP BY 1, 2, 3),
p AS (SELECT bucket, event_type, coalesce(SUM(inc) FILTER (WHERE le = '50'), 0) AS "c_50",
             coalesce(SUM(inc) FILTER (WHERE le = '100'), 0) AS "c_100",
             coalesce(SUM(inc) FILTER (WHERE le = '200'), 0) AS "c_200",
             coalesce(SUM(inc) FILTER (WHERE le = '+Inf'), 0) AS "c_+Inf" FROM i GROUP BY 1, 2),
t AS (SELECT *, "c_+Inf" AS total FROM p)
SELECT bucket, event_type, CAST(total AS BIGINT) AS total, R6({_rate_quantile_sql(0.5)}) AS p50,
       R6({_rate_quantile_sql(0.9)}) AS p90 FROM t
""",
)
def q_histogram_rates(spark: SparkSession, root: str) -> DataFrame:
    """M8 from counters: value quantiles per event type and 6 hours, from the increases of
    one daily-restarting counter per bound."""
    b = counter_buckets(_rate_counters(spark, root), ["event_type"], "le", "hour", "counter", 21600, RATE_LES)
    return b.select(
        "bucket", "event_type", F.col("`c_+Inf`").alias("total"),
        *[r6(histogram_quantile(q, RATE_LES)).alias(f"p{int(q * 100)}") for q in (0.5, 0.9)],
    )


def _bin_sql() -> str:
    parts = []
    for le in LES:
        cond = "l_quantity IS NOT NULL" if le == float("inf") else f"l_quantity <= {le}"
        parts.append(f"WHEN {cond} THEN '{le_label(le)}'")
    return f"CASE {' '.join(parts)} END"


@query(
    "heatmap",
    f"SELECT strftime(l_shipdate, '%Y-%m') AS month, {_bin_sql()} AS le, COUNT(*) AS n FROM lineitem GROUP BY 1, 2",
)
def q_heatmap(spark: SparkSession, root: str) -> DataFrame:
    """M8 heatmap: sample count per (month, bucket)."""
    li = read_table(spark, root, "lineitem")
    return li.groupBy(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), le_bin(F.col("l_quantity"), LES).alias("le")
    ).agg(F.count(F.lit(1)).alias("n"))


AS_OF_EPOCH = 1706745600  # 2024-02-01T00:00:00Z


@query(
    "age_stats",
    f"""
SELECT event_type, R6(({AS_OF_EPOCH * 1_000_000} - MAX(epoch_us(ts))) / 1e6) AS age_min_s,
       R6(CAST(SUM({AS_OF_EPOCH * 1_000_000} - epoch_us(ts)) AS DOUBLE) / COUNT(ts) / 1e6) AS age_avg_s,
       R6(({AS_OF_EPOCH * 1_000_000} - MIN(epoch_us(ts))) / 1e6) AS age_max_s
FROM events GROUP BY 1
""",
)
def q_age_stats(spark: SparkSession, root: str) -> DataFrame:
    """M9: age of the newest, average and oldest sample per event type at a given instant."""
    # ages as exact integer microseconds; the mean is an exact bigint sum / count
    g = gauges(spark, root).withColumn("age_us", F.lit(AS_OF_EPOCH * 1_000_000) - epoch_micros(F.col("ts")))
    return g.groupBy("event_type").agg(
        r6(F.min("age_us") / 1e6).alias("age_min_s"),
        r6(F.sum("age_us") / F.count("ts") / 1e6).alias("age_avg_s"),
        r6(F.max("age_us") / 1e6).alias("age_max_s"),
    )


@query(
    "status_history",
    f"""
SELECT user_id, {DAY_SQL} AS day, MIN(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS status_min,
       last(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END ORDER BY ts, event_id) AS status_last
FROM events GROUP BY 1, 2
""",
)
def q_status_history(spark: SparkSession, root: str) -> DataFrame:
    """up/down history (min per day) and the latest status per user."""
    g = gauges(spark, root).withColumn("status", F.when(F.col("event_type") == "error", 0).otherwise(1))
    return g.groupBy("user_id", day_of(F.col("ts")).alias("day")).agg(
        F.min("status").alias("status_min"),
        F.max_by("status", F.struct("ts", "event_id")).alias("status_last"),
    )


MATCH_RULES = [("event_type", "=~", "click|view|purchase"), ("user_id", "!~", "1.*"), ("event_type", "!=", "view")]


@query(
    "label_match",
    """
SELECT event_id, event_type, user_id, value FROM events
WHERE regexp_full_match(coalesce(event_type, ''), 'click|view|purchase')
  AND NOT regexp_full_match(coalesce(CAST(user_id AS VARCHAR), ''), '1.*')
  AND (event_type IS NULL OR event_type <> 'view')
  AND value > CAST('-inf' AS DOUBLE) AND NOT isnan(value)
""",
)
def q_label_match(spark: SparkSession, root: str) -> DataFrame:
    """=~, !~, != matchers plus the finite-value guard."""
    g = gauges(spark, root)
    return g.where(matchers(MATCH_RULES) & finite(F.col("value"))).select("event_id", "event_type", "user_id", "value")


def _sides(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    g = gauges(spark, root)
    left = g.where(F.col("value") >= 100).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("value"))
    right = g.where(F.col("value") < 5).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("value"))
    return left, right


SIDES_SQL = """
WITH l AS (SELECT user_id, event_type, COUNT(*) AS value FROM events WHERE value >= 100 GROUP BY 1, 2),
     r AS (SELECT user_id, event_type, COUNT(*) AS value FROM events WHERE value < 5 GROUP BY 1, 2)
"""
MATCH = "r.user_id IS NOT DISTINCT FROM l.user_id AND r.event_type IS NOT DISTINCT FROM l.event_type"


@query("set_and", SIDES_SQL + f"SELECT * FROM l WHERE EXISTS (SELECT 1 FROM r WHERE {MATCH})")
def q_set_and(spark: SparkSession, root: str) -> DataFrame:
    """M12 and: series with values >= 100 that also had values < 5."""
    left, right = _sides(spark, root)
    return set_and(left, right, ["user_id", "event_type"])


@query(
    "set_or",
    SIDES_SQL + f"SELECT * FROM l UNION ALL SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE {MATCH})",
)
def q_set_or(spark: SparkSession, root: str) -> DataFrame:
    """M12 or: left series plus right series with no left match."""
    left, right = _sides(spark, root)
    return set_or(left, right, ["user_id", "event_type"])


@query("set_unless", SIDES_SQL + f"SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE {MATCH})")
def q_set_unless(spark: SparkSession, root: str) -> DataFrame:
    """M12 unless: left series with no right match."""
    left, right = _sides(spark, root)
    return set_unless(left, right, ["user_id", "event_type"])


@query(
    "label_rewrite",
    r"""
WITH s AS (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS user_id FROM events)
SELECT event_type, user_id,
       CASE WHEN regexp_full_match(coalesce(user_id, ''), '([1-9])\d')
            THEN regexp_replace(user_id, '^(?:([1-9])\d)$', '\1') END AS user_group,
       coalesce(event_type, '') || '/' || coalesce(user_id, '') AS series
FROM s
""",
)
def q_label_rewrite(spark: SparkSession, root: str) -> DataFrame:
    """label_replace (first digit of two-digit user ids) and label_join."""
    s = gauges(spark, root).select("event_type", F.col("user_id").cast("string").alias("user_id")).distinct()
    return s.select(
        "event_type",
        "user_id",
        label_replace(F.col("user_id"), r"([1-9])\d", "$1").alias("user_group"),
        label_join("/", F.col("event_type"), F.col("user_id")).alias("series"),
    )


# metric-name suffix of a part, chosen by p_size (stand-in catalogue rule)
NAME_SUFFIXES = ["total", "bucket", "timestamp_seconds", "up", "info", "value"]


def _suffix_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(NAME_SUFFIXES))
    return f"CASE ((p_size % {len(NAME_SUFFIXES)}) + {len(NAME_SUFFIXES)}) % {len(NAME_SUFFIXES)} {cases} END"


@query(
    "prefix_groups",
    f"""
WITH m AS (SELECT replace(p_name, ' ', '_') || '_' || {_suffix_sql()} AS name, p_brand FROM part),
t AS (SELECT name, split_part(name, '_', 1) AS prefix,
             CASE WHEN regexp_matches(name, '_(count|total|sum)$') THEN 'counter'
                  WHEN suffix(name, '_bucket') THEN 'classic-histogram'
                  WHEN suffix(name, '_timestamp_seconds') THEN 'age'
                  WHEN name = 'up' OR regexp_matches(name, '_up$') THEN 'status-updown'
                  WHEN suffix(name, '_info') THEN 'info' ELSE 'gauge' END AS metric_type, p_brand FROM m)
SELECT prefix, metric_type, COUNT(DISTINCT name) AS n_metrics, COUNT(DISTINCT p_brand) AS n_label_values,
       COUNT(*) AS n_rows
FROM t GROUP BY 1, 2
""",
)
def q_prefix_groups(spark: SparkSession, root: str) -> DataFrame:
    """M14 + M1: metrics grouped by name prefix and inferred type, label-value counts."""
    p = read_table(spark, root, "part")
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in NAME_SUFFIXES]), (F.pmod(F.col("p_size"), F.lit(len(NAME_SUFFIXES))) + 1).cast("int")
    )
    m = p.select(F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_"), suffix).alias("name"), "p_brand")
    t = m.select("name", name_prefix(F.col("name")).alias("prefix"), metric_type(F.col("name")).alias("metric_type"), "p_brand")
    return t.groupBy("prefix", "metric_type").agg(
        F.count_distinct("name").alias("n_metrics"),
        F.count_distinct("p_brand").alias("n_label_values"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query(
    "metric_catalog",
    f"""
WITH m AS (SELECT 'events_' || event_type || '_total' AS name, ts, user_id FROM events)
SELECT name, split_part(name, '_', 1) AS prefix,
       CASE WHEN regexp_matches(name, '_(count|total|sum)$') THEN 'counter' ELSE 'other' END AS metric_type,
       MIN(ts) AS first_seen, R6(({AS_OF_EPOCH * 1_000_000} - MIN(epoch_us(ts))) / 1e6) AS age_s,
       COUNT(DISTINCT user_id) AS n_label_values, COUNT(*) AS n_samples
FROM m GROUP BY name
""",
)
def q_metric_catalog(spark: SparkSession, root: str) -> DataFrame:
    """M14 + M1 + M9: metrics (one counter per event type) with prefix, type,
    first-seen time and age at a given instant, and label-value counts."""
    g = gauges(spark, root).withColumn("name", F.concat(F.lit("events_"), F.col("event_type"), F.lit("_total")))
    out = g.groupBy("name").agg(
        F.min("ts").alias("first_seen"),
        F.count_distinct("user_id").alias("n_label_values"),
        F.count(F.lit(1)).alias("n_samples"),
    )
    kind = metric_type(F.col("name"))
    return out.select(
        "name",
        name_prefix(F.col("name")).alias("prefix"),
        F.when(kind == "counter", kind).otherwise(F.lit("other")).alias("metric_type"),
        "first_seen",
        r6((F.lit(AS_OF_EPOCH * 1_000_000) - epoch_micros(F.col("first_seen"))) / 1e6).alias("age_s"),
        "n_label_values",
        "n_samples",
    )


MAD_K = 3.0 * 1.4826


@query(
    "outlier_series",
    f"""
WITH x AS (SELECT user_id, {DAY_SQL} AS day, AVG(value) AS v FROM events GROUP BY 1, 2),
m AS (SELECT day, quantile_cont(v, 0.5) AS med FROM x GROUP BY 1),
d AS (SELECT x.user_id, x.day, abs(v - med) AS dev FROM x JOIN m USING (day)),
md AS (SELECT day, quantile_cont(dev, 0.5) AS mad FROM d GROUP BY 1),
f AS (SELECT d.user_id, d.day, dev > CAST({MAD_K!r} AS DOUBLE) * mad AS o FROM d JOIN md USING (day)),
g AS (SELECT *, lag(o) OVER (PARTITION BY user_id ORDER BY day) AS p FROM f)
SELECT user_id, COUNT(*) AS n_buckets, COUNT(*) FILTER (WHERE o) AS n_outliers,
       COUNT(*) FILTER (WHERE o AND coalesce(NOT p, true)) AS n_runs,
       -COUNT(*) FILTER (WHERE o AND coalesce(NOT p, true)) AS score
FROM g GROUP BY 1
""",
)
def q_outlier_series(spark: SparkSession, root: str) -> DataFrame:
    """Users ranked by runs of days far from the cross-user median (MAD rule)."""
    g = gauges(spark, root)
    x = g.groupBy("user_id", day_of(F.col("ts")).alias("day")).agg(F.avg("value").alias("v"))
    return flag_runs(mad_outliers(x, "day", "v", k=3.0), "user_id", "day", "outlier", F.substring("day", 1, 7))


DENSITY_EPS, DENSITY_POINTS = 6.0, 4
DENSITY_SQL = f"""
WITH x AS (SELECT user_id, {DAY_SQL} AS day, MAX(value) AS v FROM events GROUP BY 1, 2),
c AS (SELECT a.user_id, a.day, a.v, COUNT(*) AS near
      FROM x a JOIN x b ON a.day = b.day AND abs(a.v - b.v) <= {DENSITY_EPS}::DOUBLE GROUP BY 1, 2, 3),
k AS (SELECT day, v, CASE WHEN v - lag(v) OVER (PARTITION BY day ORDER BY v) > {DENSITY_EPS}::DOUBLE THEN 1 ELSE 0 END AS gap
      FROM (SELECT DISTINCT day, v FROM c WHERE near >= {DENSITY_POINTS})),
n AS (SELECT day, v AS core, CAST(SUM(gap) OVER (PARTITION BY day ORDER BY v) AS INTEGER) AS cluster FROM k),
p AS (SELECT x.user_id, x.day, x.v, n.cluster
      FROM x LEFT JOIN n ON n.day = x.day AND abs(x.v - n.core) <= {DENSITY_EPS}::DOUBLE
      QUALIFY row_number() OVER (PARTITION BY x.user_id, x.day ORDER BY abs(x.v - n.core) NULLS LAST, n.core) = 1)"""


def _clustered_days(spark: SparkSession, root: str) -> DataFrame:
    g = gauges(spark, root)
    x = g.groupBy("user_id", day_of(F.col("ts")).alias("day")).agg(F.max("value").alias("v"))
    return density_clusters(x, ["day"], "v", DENSITY_EPS, DENSITY_POINTS)


@query(
    "density_clusters",
    DENSITY_SQL
    + """
SELECT day, cluster, COUNT(*) AS n, MIN(v) AS least, MAX(v) AS most FROM p WHERE v IS NOT NULL GROUP BY 1, 2
""",
)
def q_density_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Density clusters of the users' values of each day (null: noise)."""
    d = _clustered_days(spark, root).where("v IS NOT NULL")
    return d.groupBy("day", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))


@query(
    "density_outliers",
    DENSITY_SQL
    + """,
g AS (SELECT user_id, day, v IS NOT NULL AND cluster IS NULL AS o,
             lag(v IS NOT NULL AND cluster IS NULL) OVER (PARTITION BY user_id ORDER BY day) AS before FROM p)
SELECT user_id, COUNT(*) AS n_buckets, COUNT(*) FILTER (WHERE o) AS n_outliers,
       COUNT(*) FILTER (WHERE o AND coalesce(NOT before, true)) AS n_runs,
       -COUNT(*) FILTER (WHERE o AND coalesce(NOT before, true)) AS score
FROM g GROUP BY 1
""",
)
def q_density_outliers(spark: SparkSession, root: str) -> DataFrame:
    """Users by runs of days on which their value lies in no density cluster."""
    return flag_runs(_clustered_days(spark, root), "user_id", "day", "outlier", F.substring("day", 1, 7))
