"""Traffic queries: the batch layer, ingest parsing, keyed tables (Tier 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.rounding import rnd
from streetflow.functions.parse import expand, is_rejected, project_archive, store_row
from streetflow.functions.status import status_colour
from streetflow.operators.analysis import (
    daily_analysis,
    daily_stats_all_days,
    flatten_points,
    rebuild_lines,
    tumbling_average,
)
from streetflow.operators.latest import latest_per_key, null_key_counts
from streetflow.plans.sqlparts import AS_OF_DAY, POINTS, SHAPES, TRAFFIC, with_
from streetflow.registry import query
from streetflow.schema import KEPT_WIRE, SEQ
from streetflow.session import work_dir
from streetflow.sources.keyed import KeyedTable
from streetflow.sources.lake import read_day, write_lake
from streetflow.sources.standins import messages_from_archive, traffic_archive, traffic_messages
from streetflow.sources.tables import read_table


def r6(c):
    return rnd(c)


def archive_day(a: DataFrame, day: str) -> DataFrame:
    """Rows of one calendar day.  The ts range is what reaches the Parquet scan
    (PushedFilters); the key equality keeps the exact day semantics."""
    start = F.lit(day).cast("timestamp_ntz")
    return a.where((F.col("ts") >= start) & (F.col("ts") < F.timestamp_add("DAY", F.lit(1), start))).where(
        F.col("date_partition") == day
    )


def _rounded_stats(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumns(
        {f"avg_speed_{suffix}": r6(F.col(f"avg_speed_{suffix}")), f"speed_ratio_{suffix}": r6(F.col(f"speed_ratio_{suffix}"))}
    )


# ---------------------------------------------------------------- batch layer
DAILY_SQL = with_(TRAFFIC) + f"""
SELECT denomination, hierarchie,
       R6(AVG(avg_speed)) AS avg_speed_today,
       MAX(max_speed) AS max_speed_today,
       R6(CASE WHEN MAX(max_speed) = 0 THEN NULL ELSE AVG(avg_speed) / MAX(max_speed) END) AS speed_ratio_today
FROM traffic WHERE date_partition = '{AS_OF_DAY}'
GROUP BY denomination, hierarchie
"""


@query("daily_analysis", DAILY_SQL)
def q_daily_analysis(spark: SparkSession, root: str) -> DataFrame:
    """A1-A3 + P7 + F1: today's statistics per (street, hierarchy)."""
    a = traffic_archive(spark, root)
    return _rounded_stats(daily_analysis(archive_day(a, AS_OF_DAY)), "today")


@query(
    "daily_stats_all_days",
    with_(TRAFFIC)
    + """
SELECT date_partition, denomination, hierarchie,
       R6(AVG(avg_speed)) AS avg_speed_day,
       MAX(max_speed) AS max_speed_day,
       R6(CASE WHEN MAX(max_speed) = 0 THEN NULL ELSE AVG(avg_speed) / MAX(max_speed) END) AS speed_ratio_day
FROM traffic GROUP BY date_partition, denomination, hierarchie
""",
)
def q_daily_stats_all_days(spark: SparkSession, root: str) -> DataFrame:
    """A4: the daily statistics for every day of the history."""
    return _rounded_stats(daily_stats_all_days(traffic_archive(spark, root)), "day")


@query(
    "geo_flatten",
    with_(TRAFFIC, SHAPES, POINTS)
    + "SELECT date_time, denomination, traffic_status, point_order, latitude, longitude, hierarchie, seq FROM points",
)
def q_geo_flatten(spark: SparkSession, root: str) -> DataFrame:
    """S2 + P5 + P6 + G1: every archive row exploded into its line points."""
    return flatten_points(traffic_archive(spark, root, with_shape=True))


ARCHIVE_COLS = [
    "date_time", "denomination", "avg_speed", "travel_time", "traffic_status",
    "hierarchie", "hierarchie_dv", "max_speed", "seq", "date_partition",
]


@query(
    "day_slice",
    with_(TRAFFIC) + f"SELECT {', '.join(ARCHIVE_COLS)} FROM traffic WHERE date_partition = '{AS_OF_DAY}'",
)
def q_day_slice(spark: SparkSession, root: str) -> DataFrame:
    """K1 (batch) + S3: archive to a day-partitioned lake, read one day back (PartitionFilters)."""
    base = work_dir(spark, "lake")
    write_lake(traffic_archive(spark, root).drop("ts"), base)
    return read_day(spark, base, AS_OF_DAY).select(*ARCHIVE_COLS)


# ---------------------------------------------------------------- ingest
WIRE_SCALARS = [
    "datetime", "predefinedlocationreference", "averagevehiclespeed", "traveltime",
    "traveltimereliability", "trafficstatus", "vehicleprobemeasurement", "gml_id",
    "id_rva_troncon_fcd_v1_1", "hierarchie", "hierarchie_dv", "denomination", "insee",
    "sens_circule", "vitesse_maxi",
]

JSON_PARSE_SQL = with_(TRAFFIC) + """
SELECT seq,
  CASE WHEN bad THEN NULL ELSE date_time END AS datetime,
  CASE WHEN bad THEN NULL ELSE CAST(seq AS VARCHAR) END AS predefinedlocationreference,
  CASE WHEN bad THEN NULL ELSE avg_speed END AS averagevehiclespeed,
  CAST(NULL AS INTEGER) AS traveltime,
  CAST(NULL AS INTEGER) AS traveltimereliability,
  CASE WHEN bad THEN NULL ELSE traffic_status END AS trafficstatus,
  CAST(NULL AS INTEGER) AS vehicleprobemeasurement,
  CAST(NULL AS VARCHAR) AS gml_id,
  CAST(NULL AS INTEGER) AS id_rva_troncon_fcd_v1_1,
  CASE WHEN bad THEN NULL ELSE hierarchie END AS hierarchie,
  CAST(NULL AS VARCHAR) AS hierarchie_dv,
  CASE WHEN bad THEN NULL ELSE denomination END AS denomination,
  CAST(NULL AS VARCHAR) AS insee,
  CAST(NULL AS VARCHAR) AS sens_circule,
  CASE WHEN bad THEN NULL ELSE max_speed END AS vitesse_maxi
FROM (SELECT *, seq % 97 = 0 AS bad FROM traffic)
"""


@query("json_parse", JSON_PARSE_SQL)
def q_json_parse(spark: SparkSession, root: str) -> DataFrame:
    """P1 + P2: permissive parse of every message (non-JSON -> all-null row)."""
    msgs = traffic_messages(spark, root)
    return expand(msgs, keep=[SEQ]).select(SEQ, *WIRE_SCALARS)


PROJECT_SQL = with_(TRAFFIC) + """
SELECT CASE WHEN bad THEN NULL ELSE date_time END AS date_time,
  CASE WHEN bad THEN NULL ELSE denomination END AS denomination,
  CASE WHEN bad THEN NULL ELSE avg_speed END AS avg_speed,
  travel_time,
  CASE WHEN bad THEN NULL ELSE traffic_status END AS traffic_status,
  CASE WHEN bad THEN NULL ELSE hierarchie END AS hierarchie,
  hierarchie_dv,
  CASE WHEN bad THEN NULL ELSE max_speed END AS max_speed,
  seq,
  CASE WHEN bad THEN NULL ELSE date_partition END AS date_partition
FROM (SELECT *, seq % 97 = 0 AS bad FROM traffic)
"""


def _parsed_archive(spark: SparkSession, root: str, with_shape: bool = False) -> DataFrame:
    msgs = traffic_messages(spark, root, with_shape=with_shape)
    return project_archive(expand(msgs, keep=[SEQ], schema=KEPT_WIRE), seq=F.col(SEQ))


@query("project_rename", PROJECT_SQL)
def q_project_rename(spark: SparkSession, root: str) -> DataFrame:
    """P3 + P4: 9 of 17 fields under archive names, plus the day key."""
    return _parsed_archive(spark, root).select(*ARCHIVE_COLS)


@query(
    "day_key",
    with_(TRAFFIC)
    + """
SELECT seq, CASE WHEN seq % 97 = 0 THEN NULL ELSE date_time END AS date_time,
       CASE WHEN seq % 97 = 0 THEN NULL ELSE date_partition END AS date_partition
FROM traffic""",
)
def q_day_key(spark: SparkSession, root: str) -> DataFrame:
    """Day key of each message's timestamp text (null when unparsable)."""
    return _parsed_archive(spark, root).select(SEQ, "date_time", "date_partition")


@query(
    "parse_rejects",
    with_(TRAFFIC) + "SELECT seq, 'corrupt:' || CAST(seq AS VARCHAR) AS value FROM traffic WHERE seq % 97 = 0",
)
def q_parse_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Messages whose key fields all came out null -> quarantine (raw text kept)."""
    msgs = traffic_messages(spark, root)
    parsed = expand(msgs, keep=[SEQ, "value"])
    return parsed.where(is_rejected(["datetime", "denomination", "hierarchie"])).select(
        SEQ, F.col("value").cast("string").alias("value")
    )


ROUNDTRIP_SQL = with_(TRAFFIC) + """
SELECT t.seq, t.date_time, t.denomination, t.avg_speed, t.traffic_status, t.hierarchie, t.max_speed,
       t.date_partition,
       CASE WHEN s.vec_id IS NULL THEN NULL
            WHEN ((s.label % 3) + 3) % 3 = 0 THEN NULL
            WHEN ((s.label % 3) + 3) % 3 = 1 THEN 0
            ELSE CAST(len(s.embedding) // 2 AS INTEGER) END AS n_points
FROM traffic t LEFT JOIN embeddings s ON s.vec_id = t.seq
"""


@query("json_roundtrip", ROUNDTRIP_SQL)
def q_json_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """S6 then P1-P4: encode archive rows as wire JSON and parse them back."""
    a = traffic_archive(spark, root, with_shape=True)
    msgs = messages_from_archive(a, corrupt_every=None)
    back = project_archive(expand(msgs, keep=[SEQ], schema=KEPT_WIRE), seq=F.col(SEQ))
    return back.select(
        SEQ, "date_time", "denomination", "avg_speed", "traffic_status", "hierarchie", "max_speed",
        "date_partition",
        F.when(F.col("geo_shape.geometry.coordinates").isNull(), F.lit(None))
        .otherwise(F.size("geo_shape.geometry.coordinates"))
        .cast("int")
        .alias("n_points"),
    )


@query(
    "status_color",
    """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'freeFlow' WHEN 'P' THEN 'congested' ELSE 'other' END AS traffic_status,
       CASE o_orderstatus WHEN 'F' THEN 'GREEN' WHEN 'P' THEN 'RED' ELSE NULL END AS color
FROM orders""",
)
def q_status_color(spark: SparkSession, root: str) -> DataFrame:
    """Map colour of a traffic status (orders' status plays the traffic status)."""
    o = read_table(spark, root, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "freeFlow")
        .when(F.col("o_orderstatus") == "P", "congested")
        .otherwise("other")
    )
    return o.select("o_orderkey", status.alias("traffic_status")).withColumn(
        "color", status_colour(F.col("traffic_status"))
    )


STORE_SQL = with_(TRAFFIC) + """
SELECT t.seq, t.ts AS date_time, t.denomination, CAST(t.max_speed AS DOUBLE) AS max_speed,
       CASE WHEN s.vec_id IS NULL THEN NULL
            WHEN ((s.label % 3) + 3) % 3 = 0 THEN NULL
            WHEN ((s.label % 3) + 3) % 3 = 1 THEN 0
            ELSE CAST(len(s.embedding) // 2 AS INTEGER) END AS geo_points
FROM traffic t LEFT JOIN embeddings s ON s.vec_id = t.seq
"""


@query("store_row", STORE_SQL)
def q_store_row(spark: SparkSession, root: str) -> DataFrame:
    """Store-boundary casts (text->timestamp, int->double, struct->JSON text)."""
    s = store_row(traffic_archive(spark, root, with_shape=True).drop("ts"))
    return s.select(
        SEQ,
        F.col("date_time").cast("timestamp_ntz").alias("date_time"),
        "denomination",
        "max_speed",
        F.json_array_length(F.get_json_object("geo_shape", "$.geometry.coordinates")).alias("geo_points"),
    )


NULL_KEYS_SQL = with_(TRAFFIC, SHAPES, POINTS) + """
SELECT 'traffic_realtime' AS table_name, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE denomination IS NULL OR date_time IS NULL) AS n_rejected FROM traffic
UNION ALL
SELECT 'traffic_daily_analysis', COUNT(*),
       COUNT(*) FILTER (WHERE denomination IS NULL OR hierarchie IS NULL) FROM traffic
UNION ALL
SELECT 'traffic_mapping', COUNT(*),
       COUNT(*) FILTER (WHERE denomination IS NULL OR hierarchie IS NULL OR date_time IS NULL
                        OR point_order IS NULL) FROM points
"""


@query("null_key_rejects", NULL_KEYS_SQL)
def q_null_key_rejects(spark: SparkSession, root: str) -> DataFrame:
    """P10: rows each keyed table would reject for a null key part."""
    a = traffic_archive(spark, root, with_shape=True)
    rows = null_key_counts(
        a,
        {
            "traffic_realtime": ["denomination", "date_time"],
            "traffic_daily_analysis": ["denomination", "hierarchie"],
        },
    )
    pts = null_key_counts(
        flatten_points(a), {"traffic_mapping": ["denomination", "hierarchie", "date_time", "point_order"]}
    )
    return rows.unionByName(pts)


@query(
    "tumbling_9min",
    with_(TRAFFIC)
    + """
SELECT make_timestamp(CAST(floor(epoch_us(ts) / 540000000) AS BIGINT) * 540000000) AS window_start,
       make_timestamp(CAST(floor(epoch_us(ts) / 540000000) AS BIGINT) * 540000000 + 540000000) AS window_end,
       denomination, R6(AVG(avg_speed)) AS avg_speed, COUNT(*) AS n_records
FROM traffic GROUP BY 1, 2, 3
""",
)
def q_tumbling_9min(spark: SparkSession, root: str) -> DataFrame:
    """W1 (batch): average speed per street in 9-minute event-time windows."""
    out = tumbling_average(traffic_archive(spark, root), "ts", ["denomination"], "9 minutes")
    return out.withColumn("avg_speed", r6(F.col("avg_speed")))


# ---------------------------------------------------------------- latest per key
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "latest_per_key",
    f"""
SELECT {', '.join(LINEITEM_COLS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
  l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""",
)
def q_latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    """One row per (l_orderkey, l_linenumber), newest ship date, all columns as tie-break."""
    li = read_table(spark, root, "lineitem").select(*LINEITEM_COLS)
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(*LINEITEM_COLS)


@query(
    "current_state",
    with_(TRAFFIC)
    + """
SELECT denomination, ts AS date_time, seq, avg_speed, traffic_status, hierarchie, max_speed FROM traffic
QUALIFY row_number() OVER (PARTITION BY denomination ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST) = 1
""",
)
def q_current_state(spark: SparkSession, root: str) -> DataFrame:
    """R2: newest row of every street."""
    a = traffic_archive(spark, root).select(
        "denomination", F.col("ts").alias("date_time"), SEQ, "avg_speed", "traffic_status", "hierarchie", "max_speed"
    )
    return latest_per_key(a, ["denomination"], ["date_time", SEQ])


@query(
    "rebuild_line",
    with_(TRAFFIC, SHAPES, POINTS)
    + """
SELECT denomination, hierarchie, date_time, seq, COUNT(*) AS n_points,
       string_agg(printf('%.6f %.6f', longitude, latitude), ',' ORDER BY point_order) AS line
FROM points WHERE point_order IS NOT NULL
GROUP BY denomination, hierarchie, date_time, seq
""",
)
def q_rebuild_line(spark: SparkSession, root: str) -> DataFrame:
    """The stored points of each line back in point order."""
    pts = flatten_points(traffic_archive(spark, root, with_shape=True))
    return rebuild_lines(pts, ["denomination", "hierarchie", "date_time", SEQ])


# ---------------------------------------------------------------- keyed tables
MAPPING_COLS = ["date_time", "denomination", "traffic_status", "point_order", "latitude", "longitude", "hierarchie", "seq"]


MAPPING_TABLE_SQL = with_(TRAFFIC, SHAPES, POINTS) + (
    """
SELECT ts AS date_time, denomination, traffic_status, point_order, latitude, longitude, hierarchie, seq
FROM points
WHERE denomination IS NOT NULL AND hierarchie IS NOT NULL AND ts IS NOT NULL AND point_order IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY denomination, hierarchie, ts, point_order
                           ORDER BY seq DESC, traffic_status DESC, latitude DESC, longitude DESC) = 1
"""
)


@query("mapping_table", MAPPING_TABLE_SQL)
def q_mapping_table(spark: SparkSession, root: str) -> DataFrame:
    """K3 + K5: flattened points upserted into the keyed mapping table, cycle replayed."""
    pts = flatten_points(traffic_archive(spark, root, with_shape=True)).withColumn(
        "date_time", F.try_to_timestamp("date_time").cast("timestamp_ntz")
    )
    t = KeyedTable(
        work_dir(spark, "traffic_mapping"),
        ["denomination", "hierarchie"],
        ["date_time", "point_order"],
        descending=["date_time"],
        order=[SEQ],
    )
    rows = pts.select(*MAPPING_COLS)
    t.upsert(rows, 1)
    t.upsert(rows, 1)  # a replayed cycle overwrites its own version
    t.upsert(rows, 2)  # the same snapshot polled again changes nothing
    return t.read(spark, rows.schema).select(*MAPPING_COLS)


@query(
    "daily_analysis_table",
    with_(TRAFFIC)
    + f"""
SELECT denomination, hierarchie,
       R6(AVG(avg_speed)) AS avg_speed_today,
       CAST(MAX(max_speed) AS DOUBLE) AS max_speed_today,
       R6(CASE WHEN MAX(max_speed) = 0 THEN NULL ELSE AVG(avg_speed) / MAX(max_speed) END) AS speed_ratio_today
FROM traffic WHERE date_partition = '{AS_OF_DAY}' AND denomination IS NOT NULL AND hierarchie IS NOT NULL
GROUP BY denomination, hierarchie
""",
)
def q_daily_analysis_table(spark: SparkSession, root: str) -> DataFrame:
    """K3: the daily table upserted by key; re-running the cycle is idempotent."""
    a = traffic_archive(spark, root)
    stats = _rounded_stats(daily_analysis(archive_day(a, AS_OF_DAY)), "today").withColumn(
        "max_speed_today", F.col("max_speed_today").cast("double")
    )
    t = KeyedTable(work_dir(spark, "traffic_daily_analysis"), ["denomination", "hierarchie"])
    t.upsert(stats, 1)
    t.upsert(stats, 1)
    return t.read(spark, stats.schema)
