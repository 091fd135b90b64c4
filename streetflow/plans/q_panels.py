"""Dashboard panel queries (Tier 2) over the realtime traffic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.rounding import nudge_sql, rnd
from streetflow.functions.timeutil import bucket_start
from streetflow.operators.latest import latest_per_key
from streetflow.operators.panels import (
    alert_states,
    panel_query,
    alias_column,
    annotations,
    instant,
    labelled,
    epoch_range,
    long_to_wide,
    panel_sql,
    series,
    table_panel,
    unix_epoch,
    variable_values,
    with_epoch,
)
from streetflow.plans.sqlparts import TRAFFIC, with_
from streetflow.registry import query
from streetflow.schema import SEQ
from streetflow.sources.standins import traffic_archive
from streetflow.sources.tables import read_table

RANGE_FROM, RANGE_TO = "2024-01-03 00:00:00", "2024-01-28 00:00:00"
EPOCH_FROM, EPOCH_TO = "2024-01-05T00:00:00", "2024-01-25T12:00:00"
HIERARCHIES = ["click", "error", "purchase", "signup", "view"]


def _traffic(spark: SparkSession, root: str) -> DataFrame:
    return traffic_archive(spark, root)


@query(
    "panel_series",
    with_(TRAFFIC)
    + f"""
SELECT denomination AS id, avg_speed AS value, ts AS time FROM traffic
WHERE ts > TIMESTAMP '{RANGE_FROM}' AND ts < TIMESTAMP '{RANGE_TO}'
  AND denomination IN (SELECT denomination FROM traffic WHERE hierarchie = 'error')
""",
)
def q_panel_series(spark: SparkSession, root: str) -> DataFrame:
    """Q1 + Q2 + Q7: series of the streets picked by a chained variable, strict time range."""
    t = _traffic(spark, root)
    picked = variable_values(t, "denomination", {"hierarchie": "error"})
    return series(t, "ts", "avg_speed", "denomination", ids=picked, time_from=RANGE_FROM, time_to=RANGE_TO)


@query(
    "panel_epoch_range",
    with_(TRAFFIC)
    + f"""
SELECT hierarchie AS id, avg_speed AS value, epoch_us(ts) // 1000000 AS time FROM traffic
WHERE epoch_us(ts) // 1000000 > {unix_epoch(EPOCH_FROM)} AND epoch_us(ts) // 1000000 < {unix_epoch(EPOCH_TO)}
  AND hierarchie IN ('click', 'view', 'purchase')
""",
)
def q_panel_epoch_range(spark: SparkSession, root: str) -> DataFrame:
    """Q1 + Q2: integer epoch time column with ``$__unixEpochFrom/To``; ids as a csv list."""
    bounds = unix_epoch(EPOCH_FROM), unix_epoch(EPOCH_TO)
    t = with_epoch(_traffic(spark, root).where(epoch_range(F.col("ts"), *bounds)), "ts")
    return series(
        t, "time_epoch", "avg_speed", "hierarchie", ids="click,view,purchase",
        time_from=bounds[0], time_to=bounds[1],
    )


@query(
    "panel_instant",
    with_(TRAFFIC)
    + """
SELECT denomination AS id, avg_speed AS value, ts AS time FROM traffic
QUALIFY row_number() OVER (PARTITION BY denomination ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST,
                           avg_speed DESC NULLS LAST) = 1
""",
)
def q_panel_instant(spark: SparkSession, root: str) -> DataFrame:
    """Q3: instant query, the last point of every street."""
    return instant(_traffic(spark, root), "ts", "avg_speed", "denomination", order=[SEQ])


@query(
    "panel_alias",
    with_(TRAFFIC)
    + """
SELECT coalesce(hierarchie, '') || ':' || coalesce(denomination, '') AS alias, avg_speed AS value, ts AS time
FROM traffic
""",
)
def q_panel_alias(spark: SparkSession, root: str) -> DataFrame:
    """Q4: series named by the template ``{{ hierarchie }}:{{ denomination }}``."""
    t = _traffic(spark, root)
    return t.select(
        alias_column("{{ hierarchie }}:{{ denomination }}").alias("alias"),
        F.col("avg_speed").alias("value"),
        F.col("ts").alias("time"),
    )


@query(
    "panel_table",
    with_(TRAFFIC)
    + """
SELECT ts, denomination, hierarchie, avg_speed, traffic_status, seq FROM traffic
ORDER BY ts DESC, seq DESC LIMIT 100
""",
)
def q_panel_table(spark: SparkSession, root: str) -> DataFrame:
    """Q5: table mode, newest 100 rows (the row limit is the panel's setting)."""
    t = _traffic(spark, root)
    return table_panel(
        t, ["ts", "denomination", "hierarchie", "avg_speed", "traffic_status", SEQ],
        [F.col("ts").desc(), F.col(SEQ).desc()], limit=100,
    )


@query(
    "panel_annotations",
    f"""
SELECT ts AS time, event_type AS title, props AS text FROM events
WHERE event_type = 'error' AND ts > TIMESTAMP '{RANGE_FROM}' AND ts < TIMESTAMP '{RANGE_TO}'
""",
)
def q_panel_annotations(spark: SparkSession, root: str) -> DataFrame:
    """Q10: annotation rows (time, title, text) inside the range."""
    ev = read_table(spark, root, "events").where(F.col("event_type") == "error")
    return annotations(ev, "ts", F.col("props"), F.col("event_type"), RANGE_FROM, RANGE_TO)


@query(
    "long_to_wide",
    with_(TRAFFIC)
    + "SELECT make_timestamp((epoch_us(ts) // 3600000000) * 3600000000) AS bucket, "
    + ", ".join(f"R6(AVG(avg_speed) FILTER (WHERE hierarchie = '{h}')) AS {h}" for h in HIERARCHIES)
    + " FROM traffic GROUP BY 1",
)
def q_long_to_wide(spark: SparkSession, root: str) -> DataFrame:
    """Q6: labelled long rows -> one column per hierarchy, hourly average."""
    t = labelled(_traffic(spark, root), ["hierarchie"]).withColumn("bucket", bucket_start(F.col("ts"), 3600))
    wide = long_to_wide(
        t.withColumn("hierarchie", F.col("labels")["hierarchie"]), "bucket", "hierarchie", "avg_speed", HIERARCHIES
    )
    return wide.select("bucket", *[rnd(h).alias(h) for h in HIERARCHIES])


@query(
    "variable_values",
    with_(TRAFFIC) + "SELECT DISTINCT denomination AS value FROM traffic WHERE hierarchie = 'purchase'",
)
def q_variable_values(spark: SparkSession, root: str) -> DataFrame:
    """Q7: picker values of the street variable, filtered by the hierarchy variable."""
    return variable_values(_traffic(spark, root), "denomination", {"hierarchie": "purchase"})


PANEL_SQL_TEXT = f"""
SELECT denomination AS id, COUNT(*) AS n, ROUND({nudge_sql("AVG(avg_speed)")}, 6) AS avg_speed, MAX(ts) AS last_seen
FROM {{t}} WHERE hierarchie = :h AND ts > $__timeFrom AND ts < $__timeTo
  AND unix_millis(CAST(ts AS TIMESTAMP)) >= $__from
GROUP BY denomination
"""


@query(
    "panel_sql",
    with_(TRAFFIC)
    + f"""
SELECT denomination AS id, COUNT(*) AS n, R6(AVG(avg_speed)) AS avg_speed, MAX(ts) AS last_seen
FROM traffic WHERE hierarchie = 'error' AND ts > TIMESTAMP '{RANGE_FROM}' AND ts < TIMESTAMP '{RANGE_TO}'
GROUP BY denomination
""",
)
def q_panel_sql(spark: SparkSession, root: str) -> DataFrame:
    """Q8 + Q2: free query text with a bound parameter and time-range macros over a named DataFrame."""
    return panel_sql(
        spark, PANEL_SQL_TEXT, args={"h": "error"}, between=(RANGE_FROM, RANGE_TO), t=_traffic(spark, root)
    )


ALERT_BOUND = 250.0


@query(
    "alert_eval",
    with_(TRAFFIC)
    + f"""
SELECT denomination, hierarchie, ts AS time, avg_speed AS value,
       CASE WHEN avg_speed > {ALERT_BOUND} THEN 'alerting' ELSE 'ok' END AS state
FROM traffic
QUALIFY row_number() OVER (PARTITION BY denomination, hierarchie ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST) = 1
""",
)
def q_alert_eval(spark: SparkSession, root: str) -> DataFrame:
    """Q9: last value of each (street, hierarchy) series against a threshold."""
    t = _traffic(spark, root).select("denomination", "hierarchie", F.col("ts").alias("time"), SEQ,
                                     F.col("avg_speed").alias("value"))
    latest = latest_per_key(t, ["denomination", "hierarchie"], ["time", SEQ]).drop(SEQ)
    return alert_states(latest, ALERT_BOUND)


PANEL_SPEC = {
    "table": "traffic_realtime",
    "columnTime": "ts",
    "columnValue": "avg_speed",
    "columnId": "denomination",
    "instant": True,
    "alias": "{{ hierarchie }}:{{ denomination }}",
    "order": [SEQ],
}


@query(
    "panel_query",
    with_(TRAFFIC)
    + """
SELECT coalesce(hierarchie, '') || ':' || coalesce(denomination, '') AS alias, avg_speed AS value, ts AS time
FROM traffic
QUALIFY row_number() OVER (PARTITION BY denomination ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST,
                           avg_speed DESC NULLS LAST, date_time DESC NULLS LAST, travel_time DESC NULLS LAST,
                           traffic_status DESC NULLS LAST, hierarchie DESC NULLS LAST) = 1
""",
)
def q_panel_query(spark: SparkSession, root: str) -> DataFrame:
    """Q1 + Q3 + Q4 through one configured panel object (instant, aliased)."""
    t = _traffic(spark, root).drop("geo_shape")
    return panel_query({"traffic_realtime": t}, PANEL_SPEC)
