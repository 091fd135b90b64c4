"""Physical-plan properties: no Python on the hot path, pruning and pushdown reach
the scan, no unpartitioned windows, top-k and latest-per-key stay partial."""

import pytest

from streetflow import registry
from streetflow.plans.inspect import (
    partition_filters,
    plan_text,
    pushed_filters,
    python_nodes,
    read_schemas,
    single_partition_exchanges,
)
from streetflow.registry import load_all
from streetflow.session import work_dir
from streetflow.sources.lake import read_day, write_lake
from streetflow.sources.standins import traffic_archive
from tests.conftest import SMOKE

load_all()
QUERIES = dict(registry.QUERIES)  # the optional subpackage has its own tests
# queries that run sinks (streams, lake or keyed-table writes) when called
SIDE_EFFECTS = {
    "stream_ingest_lake", "stream_realtime_table", "stream_restart", "stream_tumbling", "stream_alerts",
    "incremental_mapping", "incremental_mapping_table", "day_slice", "mapping_table", "daily_analysis_table", "stream_recording_rule",
}
# results that are global on purpose: top-N / ordered reports, ungrouped totals,
# ranks over a list of attributes given as a parameter, scalar subqueries
GLOBAL_OK = {
    "panel_table", "label_volume_topk", "log_patterns", "baseline_compare",
    "recent_errors", "flame_table", "profile_totals", "field_profile", "null_key_rejects",
}
PURE = sorted(set(QUERIES) - SIDE_EFFECTS)


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_stray_single_partition(spark, name):
    plan = plan_text(QUERIES[name](spark, SMOKE))
    assert python_nodes(plan) == []
    if name not in GLOBAL_OK:
        assert single_partition_exchanges(plan) == 0, plan


def test_daily_analysis_prunes_and_pushes(spark):
    plan = plan_text(QUERIES["daily_analysis"](spark, SMOKE))
    (schema,) = read_schemas(plan)
    assert schema == "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>"
    assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed_filters(plan))


def test_geo_flatten_reads_only_needed_columns(spark):
    plan = plan_text(QUERIES["geo_flatten"](spark, SMOKE))
    schemas = read_schemas(plan)
    assert any(s.startswith("struct<vec_id:bigint,embedding:array<float>,label:int>") for s in schemas)
    assert all("event_type" not in s or "props" in s for s in schemas)


def test_day_read_is_a_partition_filter(spark):
    base = work_dir(spark, "lake-plan")
    write_lake(traffic_archive(spark, SMOKE).drop("ts"), base)
    plan = plan_text(read_day(spark, base, "2024-01-15"))
    assert any("date_partition" in p for p in partition_filters(plan))


def test_topk_uses_group_limit_below_shuffle(spark):
    plan = plan_text(QUERIES["topk_per_bucket"](spark, SMOKE))
    assert "WindowGroupLimit" in plan


def test_latest_per_key_is_a_partial_aggregate_not_a_window(spark):
    # string fields in the winning row make it a (spillable) SortAggregate, but
    # it is still partial: each task ships one row per key to the shuffle
    plan = plan_text(QUERIES["latest_per_key"](spark, SMOKE))
    assert "partial_max_by" in plan
    assert "Window (" not in plan


def test_archive_read_prunes_nested_coordinates(spark):
    from streetflow.operators.analysis import flatten_points

    base = work_dir(spark, "lake-nested")
    write_lake(traffic_archive(spark, SMOKE, with_shape=True).drop("ts"), base)
    from streetflow.sources.lake import read_lake

    plan = plan_text(flatten_points(read_lake(spark, base)))
    (schema,) = read_schemas(plan)
    assert "geo_shape:struct<geometry:struct<coordinates:array<array<double>>>>" in schema
    assert "properties" not in schema


def test_panel_ids_push_into_scan(spark):
    from streetflow.operators.panels import series

    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    plan = plan_text(series(ev, "ts", "value", "event_type", ids="click,view"))
    assert any("In(event_type" in p for p in pushed_filters(plan))


def test_epoch_bounds_reach_the_scan(spark):
    plan = plan_text(QUERIES["panel_epoch_range"](spark, SMOKE))
    assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed_filters(plan))
