"""Span queries (Tier 3, X1-X9) over orders (root spans) and lineitem (child spans)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.functions.rounding import rnd
from streetflow.functions.timeutil import bucket_start
from streetflow.operators.quantiles import exact_quantiles
from streetflow.operators.spans import (
    compare,
    duration_histogram,
    error_groups,
    path_rollup,
    recent,
    red,
    roots,
    structural_match,
)
from streetflow.registry import query
from streetflow.session import written
from streetflow.sources.standins import spans
from streetflow.sources.tables import read_table

WEEK_S = 604800
WEEK_US = WEEK_S * 1_000_000

SPANS_SQL = """
kids AS (
  SELECT l_orderkey AS trace_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
              l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST, l_quantity NULLS FIRST, l_discount NULLS FIRST,
              l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS BIGINT)
           AS span_id,
         CAST(0 AS BIGINT) AS parent_id, l_returnflag || l_linestatus AS name, l_linestatus AS service,
         CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END AS status,
         l_extendedprice AS duration, l_shipdate AS start_ts
  FROM lineitem
),
per AS (SELECT trace_id, COUNT(*) AS n, bool_or(status = 'error') AS any_error FROM kids GROUP BY 1),
spans AS (
  SELECT o_orderkey AS trace_id, CAST(0 AS BIGINT) AS span_id, CAST(-1 AS BIGINT) AS parent_id,
         o_orderpriority AS name, o_orderstatus AS service,
         CASE WHEN coalesce(any_error, false) THEN 'error' ELSE 'ok' END AS status,
         o_totalprice AS duration, o_orderdate AS start_ts, CAST(0 AS BIGINT) AS lft,
         CAST(coalesce(n, 0) * 2 + 1 AS BIGINT) AS rgt
  FROM orders LEFT JOIN per ON per.trace_id = o_orderkey
  UNION ALL
  SELECT *, span_id * 2 - 1 AS lft, span_id * 2 AS rgt FROM kids
)"""


def _stored_spans(spark: SparkSession, root: str) -> DataFrame:
    """The span stand-in written once into the shared checkpoint folder: the tree
    walks read it several times, as they would read a stored span table."""
    return written(spans(spark, root), "spans")


def W(body: str) -> str:
    return "WITH " + SPANS_SQL + "\n" + body


@query(
    "red_metrics",
    W(f"""
SELECT make_timestamp((epoch_us(start_ts) // {WEEK_US}) * {WEEK_US}) AS bucket, service, COUNT(*) AS n,
       R9(COUNT(*) / {float(WEEK_S)}) AS rate, R9(COUNT(*) FILTER (WHERE status = 'error') / {float(WEEK_S)}) AS error_rate,
       R6(quantile_cont(duration, 0.5)) AS p50, R6(quantile_cont(duration, 0.9)) AS p90
FROM spans WHERE service IS NOT NULL GROUP BY 1, 2
"""),
)
def q_red_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Weekly rate, error rate and p50/p90 duration per service."""
    out = red(spans(spark, root), "service", WEEK_S)
    return out.withColumns(
        {"rate": rnd("rate", 9), "error_rate": rnd("error_rate", 9), "p50": rnd("p50"), "p90": rnd("p90")}
    )


@query(
    "slow_services",
    W("""
SELECT service, COUNT(*) AS n_roots, COUNT(*) FILTER (WHERE status = 'error') AS n_errored,
       R6(quantile_cont(duration, 0.9)) AS p90
FROM spans WHERE parent_id < 0 GROUP BY 1
"""),
)
def q_slow_services(spark: SparkSession, root: str) -> DataFrame:
    """Root spans per service: count, errored count and p90 duration."""
    r = roots(spans(spark, root))
    out = exact_quantiles(
        r, ["service"], "duration", [0.9], names=["p90"],
        others=[F.count(F.lit(1)).alias("n_roots"), F.count_if(F.col("status") == "error").alias("n_errored")],
    )
    return out.withColumn("p90", rnd("p90"))


@query(
    "duration_heatmap",
    W("""
, b AS (SELECT strftime(start_ts, '%Y-%m') AS period, duration, CAST(ceil(log2(duration)) AS BIGINT) AS k0
        FROM spans WHERE duration > 0)
SELECT period, pow(2.0, CASE WHEN pow(2.0, k0 - 1) >= duration THEN k0 - 1
                             WHEN pow(2.0, k0) < duration THEN k0 + 1 ELSE k0 END) AS le, COUNT(*) AS n
FROM b GROUP BY 1, 2
UNION ALL
SELECT strftime(start_ts, '%Y-%m'), NULL, COUNT(*) FROM spans WHERE NOT (duration > 0) OR duration IS NULL GROUP BY 1
"""),
)
def q_duration_heatmap(spark: SparkSession, root: str) -> DataFrame:
    """Span counts per month and power-of-two duration bucket."""
    return duration_histogram(spans(spark, root), F.date_format("start_ts", "yyyy-MM"))


@query(
    "baseline_compare",
    W("""
, kv AS (SELECT status = 'error' AS sel, 'service' AS attribute, service AS value FROM spans
         UNION ALL SELECT status = 'error', 'name', name FROM spans),
c AS (SELECT attribute, value, COUNT(*) FILTER (WHERE sel) AS selection, COUNT(*) FILTER (WHERE NOT sel) AS baseline
      FROM kv GROUP BY 1, 2),
s AS (SELECT *, selection / SUM(selection) OVER (PARTITION BY attribute) AS sel_share,
             baseline / SUM(baseline) OVER (PARTITION BY attribute) AS base_share FROM c),
d AS (SELECT *, sel_share - base_share AS diff FROM s),
m AS (SELECT *, MAX(abs(diff)) OVER (PARTITION BY attribute) AS max_abs_diff FROM d)
SELECT attribute, value, selection, baseline, R6(sel_share) AS sel_share, R6(base_share) AS base_share,
       R6(diff) AS diff, R6(max_abs_diff) AS max_abs_diff,
       CAST(dense_rank() OVER (ORDER BY max_abs_diff DESC NULLS LAST, attribute) AS INTEGER) AS attr_rank
FROM m
"""),
)
def q_baseline_compare(spark: SparkSession, root: str) -> DataFrame:
    """Error spans vs the rest: share difference per attribute value, attributes ranked."""
    out = compare(spans(spark, root), F.col("status") == "error", ["service", "name"])
    return out.withColumns({c: rnd(c) for c in ["sel_share", "base_share", "diff", "max_abs_diff"]})


@query(
    "structural_join",
    W("""
, a AS MATERIALIZED (SELECT trace_id, span_id, lft, rgt FROM spans WHERE name = '1-URGENT'),
d AS MATERIALIZED (SELECT trace_id, span_id, name, duration, lft, rgt FROM spans WHERE status = 'error')
SELECT d.trace_id, a.span_id AS ancestor_id, d.span_id, d.name, d.duration
FROM d JOIN a ON a.trace_id = d.trace_id WHERE d.lft > a.lft AND d.rgt < a.rgt
"""),
)
def q_structural_join(spark: SparkSession, root: str) -> DataFrame:
    """Error spans below an urgent root span (ancestor-descendant match)."""
    m = structural_match(_stored_spans(spark, root), F.col("name") == "1-URGENT", F.col("status") == "error")
    return m.select("trace_id", "ancestor_id", "span_id", "name", "duration")


@query(
    "path_rollup",
    W("""
, p AS (
  SELECT d.trace_id, d.span_id,
         coalesce(string_agg(a.name, '/' ORDER BY a.lft) || '/', '') || d.name AS path,
         CAST(COUNT(a.span_id) AS INTEGER) AS depth
  FROM spans d LEFT JOIN spans a ON a.trace_id = d.trace_id AND a.lft < d.lft AND a.rgt > d.rgt
  GROUP BY d.trace_id, d.span_id, d.name
)
SELECT path, depth, COUNT(*) AS n_spans, COUNT(DISTINCT trace_id) AS n_traces FROM p GROUP BY 1, 2
"""),
)
def q_path_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Span trees of all traces merged by the path of names from the root."""
    return path_rollup(_stored_spans(spark, root))


@query(
    "error_groups",
    "SELECT props AS message, event_type AS type, COUNT(*) AS n, MAX(ts) AS last_seen FROM events "
    "WHERE event_type = 'error' GROUP BY 1, 2",
)
def q_error_groups(spark: SparkSession, root: str) -> DataFrame:
    """Exceptions table (message = props of error events): count and last seen."""
    ev = read_table(spark, root, "events").where(F.col("event_type") == "error")
    return error_groups(ev, "props", "event_type", "ts")


@query(
    "span_counts",
    W(f"""
SELECT make_timestamp((epoch_us(start_ts) // {WEEK_US}) * {WEEK_US}) AS bucket, service, COUNT(*) AS n
FROM spans GROUP BY 1, 2
"""),
)
def q_span_counts(spark: SparkSession, root: str) -> DataFrame:
    """Span counts over time by an attribute (service)."""
    s = spans(spark, root)
    return s.groupBy(bucket_start(F.col("start_ts"), WEEK_S).alias("bucket"), "service").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "recent_errors",
    W("""
SELECT start_ts, trace_id, span_id, name, service, duration FROM spans WHERE status = 'error'
ORDER BY start_ts DESC, trace_id DESC, span_id DESC LIMIT 20
"""),
)
def q_recent_errors(spark: SparkSession, root: str) -> DataFrame:
    """The 20 most recent error spans with chosen fields (newest first)."""
    return recent(
        spans(spark, root),
        F.col("status") == "error",
        ["start_ts", "trace_id", "span_id", "name", "service", "duration"],
        [F.col("start_ts").desc(), F.col("trace_id").desc(), F.col("span_id").desc()],
        20,
    )


CHAIN_SQL = """
WITH chain AS (
  SELECT o_custkey AS trace_id,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS BIGINT)
           AS span_id,
         o_orderpriority AS priority, coalesce(o_orderstatus, '') AS name
  FROM orders WHERE o_custkey IS NOT NULL
)
"""


def _order_chains(spark: SparkSession, root: str) -> DataFrame:
    """Deep traces: a customer's orders in time, each the parent of the next."""
    o = read_table(spark, root, "orders").where(F.col("o_custkey").isNotNull())
    rank = F.row_number().over(
        Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").asc_nulls_first(), F.col("o_orderkey").asc_nulls_first())
    )
    chain = o.select(
        F.col("o_custkey").alias("trace_id"),
        rank.cast("bigint").alias("span_id"),
        F.coalesce("o_orderstatus", F.lit("")).alias("name"),
        F.col("o_orderpriority").alias("priority"),
    )
    return chain.withColumn("parent_id", F.when(F.col("span_id") == 1, F.lit(-1)).otherwise(F.col("span_id") - 1).cast("bigint"))


@query(
    "deep_path_rollup",
    CHAIN_SQL
    + """
, p AS (SELECT trace_id, CAST(span_id - 1 AS INTEGER) AS depth,
               string_agg(name, '/') OVER (PARTITION BY trace_id ORDER BY span_id) AS path FROM chain)
SELECT path, depth, COUNT(*) AS n_spans, COUNT(DISTINCT trace_id) AS n_traces FROM p GROUP BY 1, 2
""",
)
def q_deep_path_rollup(spark: SparkSession, root: str) -> DataFrame:
    """X6 on deep traces (as many levels as a customer has orders)."""
    return path_rollup(written(_order_chains(spark, root), "chains"))


@query(
    "deep_structural_join",
    CHAIN_SQL
    + """
SELECT d.trace_id, a.span_id AS ancestor_id, d.span_id
FROM (SELECT * FROM chain WHERE name = 'P') d JOIN (SELECT * FROM chain WHERE priority = '1-URGENT') a
  ON a.trace_id = d.trace_id WHERE a.span_id < d.span_id
""",
)
def q_deep_structural_join(spark: SparkSession, root: str) -> DataFrame:
    """X5 on deep traces: pending orders below an urgent one."""
    chains = written(_order_chains(spark, root), "chains")
    return structural_match(chains, F.col("priority") == "1-URGENT", F.col("name") == "P").select(
        "trace_id", "ancestor_id", "span_id"
    )
