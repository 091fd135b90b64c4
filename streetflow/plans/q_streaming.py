"""Streaming queries (speed layer, restart, windows, live alerts, incremental
cycles into files and into the keyed mapping table).

Each run writes to fresh folders under the shared work folder; the returned
DataFrame reads what the sinks committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.rounding import rnd
from streetflow.operators.analysis import flatten_points
from streetflow.plans.q_traffic import ARCHIVE_COLS, MAPPING_COLS, MAPPING_TABLE_SQL, PROJECT_SQL
from streetflow.plans.sqlparts import POINTS, SHAPES, TRAFFIC, with_
from streetflow.registry import query
from streetflow.schema import ARCHIVE, ARRIVAL, SEQ
from streetflow.session import work_dir
from streetflow.sources.keyed import KeyedTable
from streetflow.sources.lake import read_lake, write_lake
from streetflow.sources.standins import archive_from_events, messages_from_archive, traffic_archive
from streetflow.streaming.jobs import (
    alert_stream,
    file_sink,
    incremental_mapping,
    incremental_mapping_table,
    keyed_sink,
    landing_source,
    mapping_rows,
    parse_stream,
    realtime_rows,
    run_to_end,
    speed_layer,
    tumbling_stream,
)

REALTIME_COLS = [
    "date_time", "denomination", "avg_speed", "travel_time", "traffic_status",
    "hierarchie", "hierarchie_dv", "max_speed", "date_partition", SEQ,
]


def _events_stream(spark: SparkSession, root: str, path: str | None = None) -> DataFrame:
    """The events table read as a file stream (stand-in for the message topic)."""
    schema = spark.read.parquet(f"{root}/events.parquet").schema
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
    if path is None:
        return r.option("pathGlobFilter", "events.parquet").parquet(root)
    return r.parquet(path)


def _messages_stream(spark: SparkSession, root: str, path: str | None = None) -> DataFrame:
    return messages_from_archive(archive_from_events(_events_stream(spark, root, path)))


def _realtime_table(spark: SparkSession) -> KeyedTable:
    return KeyedTable(
        work_dir(spark, "traffic_realtime"), ["denomination"], ["date_time"], descending=["date_time"], order=ARRIVAL
    )


def _run_speed_layer(spark: SparkSession, root: str):
    lake = work_dir(spark, "lake")
    table = _realtime_table(spark)
    ckpt = work_dir(spark, "checkpoints")
    run_to_end(speed_layer(_messages_stream(spark, root), lake, table, ckpt))
    return lake, table


def _run_realtime_only(spark: SparkSession, root: str) -> KeyedTable:
    table = _realtime_table(spark)
    rows = parse_stream(_messages_stream(spark, root))
    run_to_end([keyed_sink(rows, table, work_dir(spark, "checkpoints"), prepare=realtime_rows)])
    return table


@query("stream_ingest_lake", PROJECT_SQL)
def q_stream_ingest_lake(spark: SparkSession, root: str) -> DataFrame:
    """S1/S5 + K1 + K4 + T1: messages stream into the day-partitioned lake."""
    lake, _ = _run_speed_layer(spark, root)
    return read_lake(spark, lake).select(*ARCHIVE_COLS)


REALTIME_SQL = with_(TRAFFIC) + """
SELECT ts AS date_time, denomination, avg_speed, travel_time, traffic_status, hierarchie, hierarchie_dv,
       CAST(max_speed AS DOUBLE) AS max_speed, date_partition, seq
FROM traffic WHERE seq % 97 <> 0
QUALIFY row_number() OVER (PARTITION BY denomination, ts ORDER BY seq DESC) = 1
"""


@query("stream_realtime_table", REALTIME_SQL)
def q_stream_realtime_table(spark: SparkSession, root: str) -> DataFrame:
    """K2: the message stream upserted per micro-batch into the realtime keyed table."""
    table = _run_realtime_only(spark, root)
    schema = realtime_rows(spark.createDataFrame([], ARCHIVE)).schema
    return table.read(spark, schema).select(*REALTIME_COLS)


RESTART_SQL = with_(TRAFFIC) + """
SELECT CASE WHEN bad THEN NULL ELSE date_time END AS date_time,
  CASE WHEN bad THEN NULL ELSE denomination END AS denomination,
  CASE WHEN bad THEN NULL ELSE avg_speed END AS avg_speed,
  travel_time,
  CASE WHEN bad THEN NULL ELSE traffic_status END AS traffic_status,
  CASE WHEN bad THEN NULL ELSE hierarchie END AS hierarchie,
  hierarchie_dv,
  CASE WHEN bad THEN NULL ELSE max_speed END AS max_speed,
  CASE WHEN bad THEN NULL ELSE seq END AS seq,
  CASE WHEN bad THEN NULL ELSE date_partition END AS date_partition
FROM (SELECT *, seq % 97 = 0 AS bad FROM traffic)
"""


@query("stream_restart", RESTART_SQL)
def q_stream_restart(spark: SparkSession, root: str) -> DataFrame:
    """S5 + T2: JSON-lines snapshots land in a folder; the speed layer runs, a later
    snapshot lands, and the restarted queries pick up only the new file from their
    checkpoints -> every message archived exactly once."""
    a = traffic_archive(spark, root)
    landing = work_dir(spark, "landing")
    lake = work_dir(spark, "lake")
    table = _realtime_table(spark)
    ckpt = work_dir(spark, "checkpoints")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    early = F.col("ts") < cut

    def land(rows: DataFrame, name: str) -> None:
        messages_from_archive(rows).select(F.col("value").cast("string")).write.text(f"{landing}/{name}")

    def run() -> None:
        msgs = landing_source(spark, f"{landing}/*", "text")
        run_to_end(speed_layer(msgs, lake, table, ckpt))

    land(a.where(early), "poll-1")
    run()
    land(a.where(~early | F.col("ts").isNull()), "poll-2")
    run()
    return read_lake(spark, lake).select(*ARCHIVE_COLS)


TUMBLING_STREAM_SQL = with_(TRAFFIC) + """
, w AS (
  SELECT make_timestamp(CAST(floor(epoch_us(ts) / 540000000) AS BIGINT) * 540000000) AS window_start,
         make_timestamp(CAST(floor(epoch_us(ts) / 540000000) AS BIGINT) * 540000000 + 540000000) AS window_end,
         denomination, avg_speed
  FROM traffic WHERE seq % 97 <> 0
)
SELECT window_start, window_end, denomination, R6(AVG(avg_speed)) AS avg_speed, COUNT(*) AS n_records
FROM w
WHERE window_end <= (SELECT MAX(ts) FROM traffic WHERE seq % 97 <> 0) - INTERVAL 9 MINUTE
GROUP BY 1, 2, 3
"""


@query("stream_tumbling", TUMBLING_STREAM_SQL)
def q_stream_tumbling(spark: SparkSession, root: str) -> DataFrame:
    """W1 streaming: 9-minute windows per street with a 9-minute watermark (closed windows)."""
    rows = parse_stream(_messages_stream(spark, root)).where(F.col("date_time").isNotNull())
    rows = rows.withColumn("ts", F.try_to_timestamp("date_time"))
    agg = tumbling_stream(rows, "ts", ["denomination"], "9 minutes", "9 minutes")
    out = work_dir(spark, "tumbling")
    run_to_end([file_sink(agg, out, work_dir(spark, "checkpoints"))])
    return spark.read.parquet(out).withColumn("avg_speed", rnd("avg_speed")).select(
        "window_start", "window_end", "denomination", "avg_speed", "n_records"
    )


@query(
    "incremental_mapping",
    with_(TRAFFIC, SHAPES, POINTS)
    + "SELECT date_time, denomination, traffic_status, point_order, latitude, longitude, hierarchie, seq FROM points",
)
def q_incremental_mapping(spark: SparkSession, root: str) -> DataFrame:
    """T4: two batch cycles; the second explodes only the lake files added since the first."""
    a = traffic_archive(spark, root, with_shape=True).drop("ts")
    lake = work_dir(spark, "lake")
    out = work_dir(spark, "mapping")
    ckpt = work_dir(spark, "checkpoints")
    early = F.col("date_partition") < "2024-01-16"
    write_lake(a.where(early), lake)
    run_to_end([incremental_mapping(spark, lake, out, ckpt)])
    write_lake(a.where(~early | F.col("date_partition").isNull()), lake)
    run_to_end([incremental_mapping(spark, lake, out, ckpt)])
    return spark.read.parquet(out).select(*MAPPING_COLS)


@query("incremental_mapping_table", MAPPING_TABLE_SQL)
def q_incremental_mapping_table(spark: SparkSession, root: str) -> DataFrame:
    """T4 + K3: two cycles over a growing lake; only new files are exploded and
    their points upserted into the keyed mapping table."""
    from streetflow.jobs import mapping_table

    a = traffic_archive(spark, root, with_shape=True).drop("ts")
    lake = work_dir(spark, "lake")
    table = mapping_table(work_dir(spark, "traffic_mapping"))
    ckpt = work_dir(spark, "checkpoints")
    early = F.col("date_partition") < "2024-01-16"
    write_lake(a.where(early), lake)
    run_to_end([incremental_mapping_table(spark, lake, table, ckpt)])
    write_lake(a.where(~early | F.col("date_partition").isNull()), lake)
    run_to_end([incremental_mapping_table(spark, lake, table, ckpt)])
    schema = mapping_rows(flatten_points(spark.createDataFrame([], ARCHIVE))).schema
    return table.read(spark, schema).select(*MAPPING_COLS)


ALERTS_SQL = with_(TRAFFIC) + """
SELECT denomination, hierarchie, ts AS time, avg_speed AS value,
       CASE WHEN avg_speed > 250.0 THEN 'alerting' ELSE 'ok' END AS state
FROM traffic WHERE seq % 97 <> 0
QUALIFY row_number() OVER (PARTITION BY denomination, hierarchie ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST) = 1
"""


@query("stream_alerts", ALERTS_SQL)
def q_stream_alerts(spark: SparkSession, root: str) -> DataFrame:
    """Q9 live: last value per (street, hierarchy) from the message stream against
    the threshold, as streaming state upserted into a keyed alerts table."""
    from streetflow.plans.q_panels import ALERT_BOUND

    rows = parse_stream(_messages_stream(spark, root)).where(F.col("date_time").isNotNull())
    rows = rows.withColumn("ts", F.try_to_timestamp("date_time").cast("timestamp_ntz"))
    table = KeyedTable(work_dir(spark, "alerts"), ["denomination", "hierarchie"])
    run_to_end([alert_stream(rows, ["denomination", "hierarchie"], "ts", "avg_speed", ALERT_BOUND, table,
                             work_dir(spark, "checkpoints"), order=[SEQ])])
    schema = "denomination string, hierarchie string, time timestamp_ntz, value double, state string"
    return table.read(spark, spark.createDataFrame([], schema).schema)
