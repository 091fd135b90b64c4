"""Edge rows of FIXTURES.md §4, through the library functions."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from streetflow.functions.parse import expand, is_rejected, project_archive
from streetflow.operators.analysis import daily_analysis, flatten_points
from streetflow.schema import ARCHIVE, SEQ
from streetflow.session import work_dir
from streetflow.sources.keyed import KeyedTable
from streetflow.sources.lake import read_lake
from streetflow.streaming.jobs import realtime_rows


def rec(**kw):
    base = {
        "datetime": "2026-03-01T10:00:00+00:00",
        "denomination": "Rue A",
        "hierarchie": "primary",
        "averagevehiclespeed": 30.0,
        "vitesse_maxi": 50,
        "trafficstatus": "freeFlow",
        "geo_shape": {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[-1.6, 48.1], [-1.7, 48.2]]}},
    }
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def parse(spark, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq bigint")
    return project_archive(expand(df, keep=[SEQ]), seq=F.col(SEQ))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_good_line_two_points(spark):
    pts = flatten_points(parse(spark, [rec()])).orderBy("point_order").collect()
    assert [p.point_order for p in pts] == [0, 1]
    assert (pts[0].latitude, pts[0].longitude) == (48.1, -1.6)


def test_multilinestring_gives_null_line_and_keeps_row(spark):
    shape = {"type": "Feature", "geometry": {"type": "MultiLineString", "coordinates": [[[-1.6, 48.1]]]}}
    a = one(parse(spark, [rec(geo_shape=shape)]))
    assert a.geo_shape.geometry.coordinates is None and a.denomination == "Rue A"
    p = one(flatten_points(parse(spark, [rec(geo_shape=shape)])))
    assert p.point_order is None


def test_empty_line_one_null_point(spark):
    shape = {"type": "Feature", "geometry": {"type": "LineString", "coordinates": []}}
    assert one(flatten_points(parse(spark, [rec(geo_shape=shape)]))).point_order is None


def test_short_point_gives_null_latitude(spark):
    shape = {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[-1.6]]}}
    p = one(flatten_points(parse(spark, [rec(geo_shape=shape)])))
    assert p.longitude == -1.6 and p.latitude is None


def test_non_json_and_null_are_all_null_and_rejected(spark):
    df = spark.createDataFrame([("not json", 1), (None, 2)], "value string, seq bigint")
    parsed = expand(df, keep=[SEQ])
    assert parsed.where(is_rejected(["datetime", "denomination", "hierarchie"])).count() == 2


def test_bad_fields_become_null(spark):
    a = one(parse(spark, [rec(averagevehiclespeed="x", vitesse_maxi=50.0)]))
    assert a.avg_speed is None and a.max_speed is None and a.denomination == "Rue A"
    b = one(parse(spark, [rec(traveltime=4.7)]))
    assert b.travel_time is None


def test_unparsable_datetime_null_day(spark):
    assert one(parse(spark, [rec(datetime="oops")])).date_partition is None


def test_day_follows_session_zone(spark):
    values = [rec(datetime="2026-03-01T23:30:00+00:00")]
    assert one(parse(spark, values)).date_partition == "2026-03-01"
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert one(parse(spark, values)).date_partition == "2026-03-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_extra_fields_ignored_missing_fields_null(spark):
    a = one(parse(spark, [rec(extra_field=1, hierarchie=...)]))
    assert a.hierarchie is None and a.denomination == "Rue A"


def test_ratio_null_for_zero_or_null_limits(spark):
    rows = daily_analysis(
        parse(spark, [rec(vitesse_maxi=0), rec(denomination="B", vitesse_maxi=None), rec(denomination="C", averagevehiclespeed=None)])
    ).collect()
    by = {r.denomination: r for r in rows}
    assert by["Rue A"].speed_ratio_today is None
    assert by["B"].speed_ratio_today is None and by["B"].max_speed_today is None
    assert by["C"].avg_speed_today is None


def test_average_ignores_null_speeds(spark):
    r = one(daily_analysis(parse(spark, [rec(averagevehiclespeed=None), rec(averagevehiclespeed=40.0)])))
    assert r.avg_speed_today == 40.0


def test_null_street_own_group_rejected_at_write(spark):
    rows = daily_analysis(parse(spark, [rec(denomination=None), rec()])).collect()
    assert {r.denomination for r in rows} == {None, "Rue A"}
    t = KeyedTable(work_dir(spark, "t"), ["denomination", "hierarchie"])
    stats = daily_analysis(parse(spark, [rec(denomination=None), rec()]))
    t.upsert(stats, 0)
    assert [r.denomination for r in t.read(spark, stats.schema).collect()] == ["Rue A"]


def test_two_segments_same_key_one_keyed_row_by_arrival(spark):
    a = parse(spark, [rec(averagevehiclespeed=10.0), rec(averagevehiclespeed=20.0)])
    assert a.count() == 2
    rows = realtime_rows(a)
    t = KeyedTable(work_dir(spark, "rt"), ["denomination"], ["date_time"], descending=["date_time"], order=[SEQ])
    t.upsert(rows, 0)
    got = one(t.read(spark, rows.schema))
    assert got.avg_speed == 20.0  # later arrival wins


def test_replayed_snapshot_leaves_keyed_table_unchanged(spark):
    a = realtime_rows(parse(spark, [rec(), rec(denomination="B")]))
    t = KeyedTable(work_dir(spark, "rt"), ["denomination"], ["date_time"], descending=["date_time"], order=[SEQ])
    t.upsert(a, 0)
    before = sorted(map(tuple, t.read(spark, a.schema).collect()))
    t.upsert(a, 0)  # replay of the same batch
    t.upsert(a, 1)  # the same snapshot polled again
    assert sorted(map(tuple, t.read(spark, a.schema).collect())) == before


def test_absent_archive_is_empty_with_schema(spark):
    df = read_lake(spark, f"/tmp/does-not-exist-{uuid.uuid4().hex}")
    assert df.count() == 0 and df.schema == ARCHIVE


@pytest.mark.parametrize("bad", ["corrupt", "{", "[]"])
def test_garbage_never_raises(spark, bad):
    assert parse(spark, [bad]).count() == 1


def test_lake_compaction_keeps_rows_and_reduces_files(spark):
    import glob

    from streetflow.sources.lake import compact_lake, write_lake
    from streetflow.sources.standins import traffic_archive
    from tests.conftest import SMOKE

    base = work_dir(spark, "lake-small")
    rows = traffic_archive(spark, SMOKE).drop("ts")
    for part in range(4):  # four "micro-batches"
        write_lake(rows.where(F.pmod(F.col(SEQ), F.lit(4)) == part), base)
    new = compact_lake(spark, base, work_dir(spark, "lake-compact"))
    before, after = read_lake(spark, base), read_lake(spark, new)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    local = lambda p: p.replace("file:", "")
    assert len(glob.glob(f"{local(new)}/*/*.parquet")) < len(glob.glob(f"{local(base)}/*/*.parquet"))
