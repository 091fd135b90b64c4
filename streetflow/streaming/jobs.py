"""The speed layer and incremental batch cycle on Structured Streaming
(S1, S5, K1, K2, K4, T1-T5, W1 streaming form).

Sources and sinks are arguments: the message source may be Kafka
(``format("kafka")`` where the package is installed) or any file source that
yields a ``value`` column; tests and the registered queries use a Parquet or
JSON-lines landing folder.  Every query has its own checkpoint folder under
the shared work folder, so a restart resumes exactly where the commit log
ends and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streetflow.functions.parse import expand, project_archive, store_row
from streetflow.operators.analysis import flatten_points, tumbling_average
from streetflow.operators.latest import latest_per_key
from streetflow.schema import ARCHIVE, ARRIVAL, KEPT_WIRE, SEQ
from streetflow.sources.keyed import KeyedTable
from streetflow.sources.lake import PARTITION


def kafka_source(spark: SparkSession, servers: str, topic: str, startingOffsets: str = "latest", **options: str) -> DataFrame:
    """One topic, no data-loss failure (offsets may expire between runs).  The option
    names are fixed values of the connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", startingOffsets)
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
    )


def landing_source(spark: SparkSession, path: str, fmt: str = "text", max_files: int | None = None) -> DataFrame:
    """A folder of landed snapshots (one message per line for ``text``)."""
    r = spark.readStream.format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def kafka_order() -> list[Column]:
    """Arrival order of Kafka rows: the broker's time, then the offset, then the partition
    (offsets count per partition, so time comes first)."""
    return [F.unix_micros("timestamp"), F.col("offset"), F.col("partition")]


def parse_stream(messages: DataFrame, seq_col: str = SEQ) -> DataFrame:
    """P1-P4 on a stream: value -> archive rows with the columns of ``ARRIVAL``.

    The arrival order is the source's own column when it has one, Kafka's time, offset
    and partition when those are there, else the record's location reference as written
    by the sender (null for a message that does not parse).
    """
    none = F.lit(None)
    if seq_col in messages.columns:
        order = [F.col(seq_col), none, none]
    elif {"timestamp", "partition", "offset"} <= set(messages.columns):
        order = kafka_order()
    else:
        parsed = expand(messages, schema=KEPT_WIRE)
        return project_archive(parsed, F.col("predefinedlocationreference").try_cast("bigint"), [none, none])
    messages = messages.select("value", *[c.cast("bigint").alias(name) for name, c in zip(ARRIVAL, order, strict=True)])
    return project_archive(expand(messages, keep=ARRIVAL, schema=KEPT_WIRE), *_first_and_rest(ARRIVAL))


def _first_and_rest(names: list[str]) -> tuple[Column, list[Column]]:
    return F.col(names[0]), [F.col(c) for c in names[1:]]


def kafka_sink(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Publish ``value`` (and ``key``, null here) to a topic.  Needs the Kafka
    package on the classpath, which this environment does not have (untested)."""
    w = (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return (w.trigger(availableNow=True) if available_now else w).start()


def lake_sink(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = True, name: str | None = None, files_per_day: int = 4
) -> StreamingQuery:
    """K1 + T1: append archive rows to the day-partitioned lake (exactly once via the sink log).

    The rows of a day are dealt to ``files_per_day`` tasks, so a micro-batch writes at
    most that many files into a day, however many tasks read it, and a hot day is shared."""
    part = F.pmod(F.xxhash64("date_time", "denomination", *ARRIVAL), F.lit(files_per_day))
    w = (
        rows.repartition(F.col(PARTITION), part)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(PARTITION)
    )
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def keyed_sink(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """K2: upsert each micro-batch into a keyed table, version = batch id.

    A batch re-run after a failure rewrites the same version, so the table never
    holds a batch twice.  Inside a batch, rows are first reduced to the latest
    per key (an aggregate with map-side combine).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        b = prepare(batch) if prepare else batch
        b = latest_per_key(b, table.key, table.order) if table.order else b
        table.upsert(b, batch_id)

    w = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def realtime_rows(archive_rows: DataFrame) -> DataFrame:
    """P9 casts for the realtime table (geo_shape as JSON text)."""
    s = store_row(archive_rows)
    return s.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


def await_any(spark: SparkSession) -> None:
    """T3 for long-running jobs: block until any query ends; on interrupt or failure
    stop every active query of the session."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in spark.streams.active:
            q.stop()


def run_to_end(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for every query; on failure or interrupt stop all and re-raise."""
    try:
        end = None if timeout_s is None else time.monotonic() + timeout_s
        while any(q.isActive for q in queries):
            for q in queries:  # in turns, so a failure of any is seen at once
                q.awaitTermination(0.2)
            if end is not None and time.monotonic() > end:
                raise TimeoutError(f"streaming queries still run after {timeout_s} seconds")
        for q in queries:
            if q.exception():
                raise q.exception()
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


def speed_layer(
    messages: DataFrame,
    lake_path: str,
    realtime: KeyedTable,
    checkpoint_root: str,
    available_now: bool = True,
) -> list[StreamingQuery]:
    """K4: one parsed stream, two independent sinks with separate checkpoints."""
    rows = parse_stream(messages)
    q1 = keyed_sink(rows, realtime, f"{checkpoint_root}/realtime", prepare=realtime_rows, available_now=available_now)
    q2 = lake_sink(rows, lake_path, f"{checkpoint_root}/lake", available_now=available_now)
    return [q1, q2]


def tumbling_stream(rows: DataFrame, ts: str, keys: list[str], width: str, delay: str) -> DataFrame:
    """W1 streaming: watermark on a TIMESTAMP column, closed windows only (append)."""
    ev = rows.withColumn("event_ts", F.col(ts).cast("timestamp")).withWatermark("event_ts", delay)
    out = tumbling_average(ev, "event_ts", keys, width)
    return out.withColumns(
        {
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz"),
        }
    )


def file_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    return (w.trigger(availableNow=True) if available_now else w).start()


def incremental_mapping(spark: SparkSession, lake_path: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """T4: explode only lake files not seen by the previous cycle into mapping rows."""
    lake = spark.readStream.schema(ARCHIVE).parquet(lake_path)
    return file_sink(flatten_points(lake), out_path, checkpoint)


def mapping_rows(points: DataFrame) -> DataFrame:
    """Store casts for the mapping table (date_time text -> timestamp)."""
    return points.withColumn("date_time", F.try_to_timestamp("date_time").cast("timestamp_ntz"))


def incremental_mapping_table(spark: SparkSession, lake_path: str, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """T4 + K3: each cycle explodes only the new lake files and upserts their
    points into the keyed mapping table (version = micro-batch id)."""
    lake = spark.readStream.schema(ARCHIVE).parquet(lake_path)
    return keyed_sink(flatten_points(lake), table, checkpoint, prepare=mapping_rows)


def alert_stream(
    rows: DataFrame,
    series: list[str],
    ts: str,
    value: str,
    bound: float,
    table: KeyedTable,
    checkpoint: str,
    order: list[str] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Q9 live: the last value of every series against a threshold, kept as
    streaming state (one row per series, update mode) and upserted per
    micro-batch into a keyed alerts table (version = batch id)."""
    last = F.max_by(F.struct(F.col(ts).alias("time"), F.col(value).alias("value")), F.struct(ts, *(order or [])))
    states = rows.groupBy(*series).agg(last.alias("_last")).select(*series, "_last.time", "_last.value")
    states = states.withColumn(
        "state", F.when(F.col("value") > F.lit(bound), F.lit("alerting")).otherwise(F.lit("ok"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id)

    w = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
