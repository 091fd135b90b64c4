"""Streaming semantics beyond the registered queries: late data past the
watermark, and restart from a checkpoint after new input lands."""

import json

from pyspark.sql import functions as F

from streetflow.session import work_dir
from streetflow.streaming.jobs import file_sink, landing_source, parse_stream, run_to_end, tumbling_stream


def _land(spark, folder, recs):
    lines = [(json.dumps({"datetime": t, "denomination": s, "hierarchie": "h", "averagevehiclespeed": v,
                          "predefinedlocationreference": str(i)}),) for i, (t, s, v) in recs]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(folder)


def _run(spark, landing, out, ckpt):
    rows = parse_stream(landing_source(spark, f"{landing}/*", "text"))
    rows = rows.withColumn("ts", F.try_to_timestamp("date_time"))
    agg = tumbling_stream(rows.where(F.col("ts").isNotNull()), "ts", ["denomination"], "9 minutes", "9 minutes")
    run_to_end([file_sink(agg, out, ckpt)])


def test_late_rows_behind_the_watermark_are_dropped(spark):
    landing, out, ckpt = work_dir(spark, "landing"), work_dir(spark, "out"), work_dir(spark, "ck")
    _land(spark, f"{landing}/b1", [(1, ("2024-01-01T10:00:00", "A", 10.0)), (2, ("2024-01-01T10:40:00", "A", 30.0))])
    _run(spark, landing, out, ckpt)
    # watermark is now 10:31; the 10:00 window closed and was emitted with one row
    _land(spark, f"{landing}/b2", [(3, ("2024-01-01T10:01:00", "A", 99.0)), (4, ("2024-01-01T11:30:00", "A", 50.0))])
    _run(spark, landing, out, ckpt)
    got = {str(r.window_start): (r.n_records, r.avg_speed) for r in spark.read.parquet(out).collect()}
    # the late 10:01 row (behind the watermark) does not reopen or change the 09:54 window
    assert got["2024-01-01 09:54:00"] == (1, 10.0)
    # the 10:39 window closes once the 11:30 row moves the watermark past it
    assert got["2024-01-01 10:39:00"] == (1, 30.0)
    # the newest window is still open (append mode emits closed windows only)
    assert all(not k.startswith("2024-01-01 11:2") for k in got)


def test_log_fields_and_quantiles_on_a_stream(spark):
    from streetflow.operators.logs import parsed_fields
    from streetflow.operators.quantiles import exact_quantiles

    landing, out, ckpt = work_dir(spark, "logs"), work_dir(spark, "fields"), work_dir(spark, "ck")
    spark.createDataFrame([('{"k": 1}',), ("a=1 b=2",), ("plain",)], "value string").coalesce(1).write.text(f"{landing}/b1")
    lines = landing_source(spark, f"{landing}/*", "text").withColumnRenamed("value", "line")
    run_to_end([file_sink(parsed_fields(lines, ["line"]), out, ckpt)])
    got = sorted((r.key or "", r.value or "") for r in spark.read.parquet(out).collect())
    assert got == [("", ""), ("a", "1"), ("b", "2"), ("k", "1")]

    nums = landing_source(spark, f"{landing}/*", "text").select(F.length("value").cast("double").alias("v"),
                                                                  F.lit("g").alias("g"))
    q = exact_quantiles(nums, ["g"], "v", [0.5])
    assert q.isStreaming
