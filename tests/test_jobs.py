"""The two applications end to end: speed layer from a landing folder, then a
batch cycle over the lake it wrote, run twice (idempotent)."""

from pyspark.sql import functions as F

from streetflow.__main__ import main
from streetflow.jobs import batch_outputs, compact_tables, daily_table, mapping_table
from streetflow.session import work_dir
from streetflow.sources.lake import read_lake
from streetflow.sources.standins import messages_from_archive, traffic_archive
from tests.conftest import SMOKE


def test_speed_then_batch_cycle(spark):
    landing, lake = work_dir(spark, "landing"), work_dir(spark, "lake")
    rt, ck = work_dir(spark, "rt"), work_dir(spark, "ck")
    a = traffic_archive(spark, SMOKE)
    messages_from_archive(a).select(F.col("value").cast("string")).write.text(f"{landing}/poll-1")
    main(["speed", "--format", "text", "--path", f"{landing}/*", "--lake", lake, "--realtime", rt,
          "--checkpoints", ck, "--available-now"])
    n = a.count()
    assert read_lake(spark, lake).count() == n

    mp, dl = work_dir(spark, "mapping"), work_dir(spark, "daily")
    args = ["batch", "--lake", lake, "--mapping", mp, "--daily", dl, "--as-of", "2024-01-15",
            "--checkpoints", work_dir(spark, "batch-ck")]
    main(args + ["--cycle", "1"])
    out = batch_outputs(spark, lake, "2024-01-15")
    expected = out["traffic_daily_analysis"].where("denomination IS NOT NULL AND hierarchie IS NOT NULL").count()
    schema = out["traffic_daily_analysis"].schema
    first = sorted(map(tuple, daily_table(dl).read(spark, schema).collect()))
    assert len(first) == expected > 0
    main(args + ["--cycle", "1"])  # the same cycle again
    main(args + ["--cycle", "2"])  # next cycle over unchanged data
    compact_tables(spark, lake, "2024-01-15", {"traffic_daily_analysis": (daily_table(dl), f"{dl}-2")})
    assert sorted(map(tuple, daily_table(f"{dl}-2").read(spark, schema).collect())) == first
    assert sorted(map(tuple, daily_table(dl).read(spark, schema).collect())) == first
    pts = mapping_table(mp).read(spark, out["traffic_mapping"].schema)
    assert pts.where("point_order IS NULL").count() == 0


def test_batch_cycle_waits_for_the_archive(spark):
    from streetflow.jobs import batch_cycle

    missing = work_dir(spark, "no-lake")
    assert batch_cycle(spark, missing, work_dir(spark, "m"), work_dir(spark, "d"), "2024-01-15", 0) is False


def test_a_second_cycle_over_unchanged_data_writes_no_mapping_rows(spark):
    import os

    from streetflow.jobs import batch_cycle, mapping_table
    from streetflow.sources.lake import write_lake
    from streetflow.sources.standins import traffic_archive

    lake, mapping, daily, ck = (work_dir(spark, n) for n in ("t4-lake", "t4-map", "t4-daily", "t4-ck"))
    write_lake(traffic_archive(spark, SMOKE, with_shape=True).drop("ts"), lake)
    versions = lambda: sorted(os.listdir(f"{mapping}/batches"))
    assert batch_cycle(spark, lake, mapping, daily, "2024-01-15", 0, checkpoints=ck)
    first = versions()
    n = spark.read.parquet(mapping_table(mapping).batches).count()
    assert n > 0
    assert batch_cycle(spark, lake, mapping, daily, "2024-01-15", 1, checkpoints=ck)
    assert versions() == first and spark.read.parquet(mapping_table(mapping).batches).count() == n
