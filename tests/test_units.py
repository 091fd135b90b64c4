"""Small unit checks: panel macros and templates, keyed-table compaction,
metric types, histogram quantile, rounding nudge."""

import math

import pytest
from pyspark.sql import functions as F

from streetflow.functions.rounding import rnd
from streetflow.operators.panels import alias_column, expand_macros, macro_values, parse_ids
from streetflow.operators.samples import histogram_quantile, metric_type
from streetflow.plans.inspect import partition_filters, plan_text
from streetflow.session import work_dir
from streetflow.sources.keyed import KeyedTable


def test_macros():
    m = macro_values("2024-01-03 00:00:00", "2024-01-04 00:00:00")
    assert m["$__unixEpochFrom"] == "1704240000" and m["$__from"] == "1704240000000"
    assert m["$__to"] == "1704326400000"
    text = expand_macros("ts > $__timeFrom AND e < $__unixEpochTo AND ms >= $__from", "2024-01-03", "2024-01-04")
    assert text == "ts > TIMESTAMP_NTZ '2024-01-03 00:00:00' AND e < 1704326400 AND ms >= 1704240000000"
    assert parse_ids("a, b,,c") == ["a", "b", "c"]


def test_alias_template(spark):
    df = spark.createDataFrame([("x", 1), (None, 2)], "a string, b int")
    got = [r[0] for r in df.select(alias_column("{{ a }}:{{b}}!")).collect()]
    assert got == ["x:1!", ":2!"]


def test_metric_types(spark):
    names = ["http_requests_total", "rpc_count", "latency_bucket", "boot_timestamp_seconds", "up", "node_up",
             "build_info", "temperature"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(metric_type(F.col("name"))).collect()]
    assert got == ["counter", "counter", "classic-histogram", "age", "status-updown", "status-updown", "info", "gauge"]


def test_histogram_quantile_interpolates(spark):
    les = [1.0, 2.0, float("inf")]
    df = spark.createDataFrame([(2, 4, 4), (0, 0, 5), (0, 0, 0)], "`c_1` long, `c_2` long, `c_+Inf` long")
    got = [r[0] for r in df.select(histogram_quantile(0.5, les)).collect()]
    assert got[0] == 1.0  # rank 2 reached at the end of the first bucket
    assert got[1] == 2.0  # only the +Inf bucket holds values -> last finite bound
    assert got[2] is None  # no samples


def test_rounding_nudge_is_deterministic_at_midpoints(spark):
    df = spark.createDataFrame([(0.69 / 96,), (3.05 * 3.05,), (-0.0071875,)], "x double")
    got = [r[0] for r in df.select(rnd("x")).collect()]
    assert got == [0.007188, 9.3025, -0.007187]
    assert all(not math.isnan(x) for x in got)


def test_keyed_compaction_keeps_state(spark):
    rows = spark.createDataFrame(
        [("a", 1, 10.0, 1), ("a", 1, 11.0, 2), ("b", 1, 5.0, 3), (None, 1, 0.0, 4)],
        "k string, t int, v double, seq long",
    )
    t = KeyedTable(work_dir(spark, "kt"), ["k"], ["t"], descending=["t"], order=["seq"])
    t.upsert(rows, 0)
    t.upsert(rows.where("k = 'b'").withColumn("v", F.lit(6.0)).withColumn("seq", F.lit(9).cast("long")), 1)
    before = sorted(map(tuple, t.read(spark, rows.schema).collect()))
    assert before == [("a", 1, 11.0, 2), ("b", 1, 6.0, 9)]
    c = t.compact(spark, rows.schema, work_dir(spark, "kt-compact"))
    assert sorted(map(tuple, c.read(spark, rows.schema).collect())) == before


def test_parsed_fields_json_then_logfmt(spark):
    from streetflow.operators.logs import mask_pattern, parsed_fields

    lines = [
        (1, '{"k": 69, "msg": "hello"}'),
        (2, 'level=info user=42 msg="disk full" path=/var/x'),
        (3, "no fields here"),
        (4, None),
    ]
    df = spark.createDataFrame(lines, "id int, line string")
    got = sorted((r.id, r.parser, r.key, r.value) for r in parsed_fields(df, ["id"]).collect())
    assert got == sorted([
        (1, "json", "k", "69"), (1, "json", "msg", "hello"),
        (2, "logfmt", "level", "info"), (2, "logfmt", "user", "42"), (2, "logfmt", "msg", "disk full"),
        (2, "logfmt", "path", "/var/x"),
        (3, None, None, None), (4, None, None, None),
    ], key=lambda t: tuple("" if x is None else str(x) for x in t))
    masked = spark.createDataFrame([("id 12 token 1eb9c654e721b4f812088970",)], "l string")
    assert masked.select(mask_pattern(F.col("l"))).first()[0] == "id <num> token <hex>"


def test_keyed_versions_keep_every_state(spark):
    schema = "k string, v double, seq long"
    t = KeyedTable(work_dir(spark, "kt-versions"), ["k"], order=["seq"])
    assert t.read(spark, spark.createDataFrame([], schema).schema).count() == 0
    states = []
    for version in range(4):
        rows = spark.createDataFrame([("a", float(version), version), (f"k{version}", 1.0, version)], schema)
        t.upsert(rows, version)
        t.upsert(rows, version)  # a replay
        states.append(sorted(map(tuple, t.read(spark, rows.schema).collect())))
    assert states[-1] == sorted([("a", 3.0, 3)] + [(f"k{i}", 1.0, i) for i in range(4)])
    old = t.read(spark, rows.schema, through=1)
    assert sorted(map(tuple, old.collect())) == states[1]
    assert any("version" in p for p in partition_filters(plan_text(old)))


def test_pow2_ceiling_exact_at_powers_of_two(spark):
    from streetflow.operators.spans import pow2_ceiling

    vals = [0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 1023.0, 1024.0, 1025.0, 2.0**40, 2.0**40 + 1, 0.0, -3.0]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(pow2_ceiling(F.col("d"))).collect()]
    want = [0.5, 1.0, 2.0, 2.0, 4.0, 4.0, 1024.0, 1024.0, 2048.0, 2.0**40, 2.0**41, None, None]
    assert got == want


def test_bucket_start_matches_window_alignment(spark):
    from streetflow.functions.timeutil import bucket_start

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = ev.select(
        bucket_start(F.col("ts"), 540).alias("b"), F.window("ts", "9 minutes").start.alias("w")
    ).where(F.col("b") != F.col("w")).count()
    assert rows == 0


def _trees(rng, n_traces, sizes):
    """Random trees as rows, with each span's names from the root by brute force."""
    rows, paths = [], {}
    for t in range(n_traces):
        up = {}
        for s in range(rng.choice(sizes)):
            up[s] = -1 if s == 0 else rng.randrange(max(0, s - 3), s)
            rows.append((t, s, up[s], f"n{rng.randrange(3)}", rng.random()))
        names = {r[1]: r[3] for r in rows if r[0] == t}
        for s in up:
            chain, at = [], s
            while at >= 0:
                chain.append(at)
                at = up[at]
            paths[t, s] = ("/".join(names[c] for c in reversed(chain)), chain[1:])
    return rows, paths


@pytest.mark.parametrize("sizes", [[1, 2, 9, 10, 12, 20], [70, 100]])
def test_tree_walks_of_any_depth(spark, sizes):
    import random

    from streetflow.operators.spans import name_paths, structural_match

    rows, paths = _trees(random.Random(len(sizes)), 6, sizes)
    spans = spark.createDataFrame(rows, "trace_id int, span_id long, parent_id long, name string, v double")
    got = {(r.trace_id, r.span_id): (r.path, r.depth) for r in name_paths(spans).collect()}
    assert got == {k: (p, len(up)) for k, (p, up) in paths.items()}
    name = {(r[0], r[1]): r[3] for r in rows}
    pairs = structural_match(spans, F.col("name") == "n1", F.col("v") < 0.3).collect()
    want = [(t, a, s) for t, s, _, _, v in rows if v < 0.3 for a in paths[t, s][1] if name[t, a] == "n1"]
    assert sorted((r.trace_id, r.ancestor_id, r.span_id) for r in pairs) == sorted(want)


def test_a_chain_of_a_hundred_spans_and_cycles(spark):
    from streetflow.operators.spans import name_paths, path_rollup, structural_match

    chain = spark.createDataFrame([(0, s, s - 1, "x") for s in range(100)], "trace_id int, span_id long, parent_id long, name string")
    assert {r.depth: r.path for r in name_paths(chain).collect()} == {d: "/".join("x" * (d + 1)) for d in range(100)}
    assert path_rollup(chain).count() == 100
    assert structural_match(chain, F.lit(True), F.lit(True)).count() == 4950
    named = spark.createDataFrame([(0, 0, -1, "a"), (0, 1, 0, None), (0, 2, 1, "c")], chain.schema)
    assert [r.path for r in name_paths(named).orderBy("span_id").collect()] == ["a", "a/", "a//c"]
    cycle = spark.createDataFrame([(0, 0, 1, "a"), (0, 1, 0, "b"), (1, 0, -1, "c")], chain.schema)
    with pytest.raises(ValueError, match="cycle"):
        name_paths(cycle)
    with pytest.raises(ValueError, match="cycle"):
        structural_match(cycle, F.lit(True), F.lit(True))
    below = spark.createDataFrame([(0, 7, 0, "c")], chain.schema).union(cycle)
    with pytest.raises(ValueError, match="cycle"):
        structural_match(below, F.col("name") == "c", F.lit(True))
    orphan = spark.createDataFrame([(0, 5, 3, "a"), (0, 6, 5, "b")], chain.schema)
    assert sorted((r.span_id, r.path, r.depth) for r in name_paths(orphan).collect()) == [(5, "a", 0), (6, "a/b", 1)]


def test_a_chain_of_a_thousand_spans_takes_a_logarithm_of_rounds(spark, monkeypatch):
    """The n-th ancestor of every span, over a chain in which every third span matches."""
    from streetflow.operators import spans as op

    names, write = [], op.written
    monkeypatch.setattr(op, "written", lambda df, name: names.append(name) or write(df, name))
    chain = spark.range(1000).selectExpr("0 AS trace_id", "id AS span_id", "id - 1 AS parent_id", "IF(id % 3 = 0, 'a', 'b') AS name")
    got = op.structural_match(chain, F.col("name") == "a", F.col("span_id") >= 990)
    assert sorted((r.span_id, r.ancestor_id) for r in got.collect()) == [(d, a) for d in range(990, 1000) for a in range(0, d, 3)]
    assert len(names) <= 2 + 2 + 2 * 10
    star = spark.range(3000).selectExpr("1 AS trace_id", "id AS span_id", "IF(id = 0, -1, IF(id < 5, id - 1, 4)) AS parent_id", "'x' AS name")
    assert op.structural_match(star, F.col("span_id") <= 4, F.col("span_id") > 4).count() == 5 * 2995
    assert op.structural_match(star, F.col("span_id") > 4, F.col("span_id") <= 4).count() == 0


def _plans_of_tree_walk(spark, monkeypatch, walk):
    """The plans of all tables that a walk over 20 traces writes, and of its result."""
    from streetflow.operators import spans as op
    from streetflow.plans.inspect import plan_text

    plans, write = [], op.written
    monkeypatch.setattr(op, "written", lambda df, name: plans.append(plan_text(df)) or write(df, name))
    chains = write(spark.range(400).selectExpr("id DIV 20 AS trace_id", "id % 20 AS span_id", "id % 20 - 1 AS parent_id", "IF(id % 3 = 0, 'a', 'b') AS name"), "chains")
    result = plan_text(walk(chains))
    return [*plans, result]


def test_ancestor_matches_are_not_broadcast_by_the_size_of_files(spark, monkeypatch):
    from streetflow.operators.spans import structural_match

    plans = _plans_of_tree_walk(spark, monkeypatch, lambda s: structural_match(s, F.col("name") == "a", F.col("name") == "b"))
    assert len(plans) > 8 and not any("Broadcast" in p for p in plans)


def test_name_paths_are_not_broadcast_by_the_size_of_files(spark, monkeypatch):
    from streetflow.operators.spans import path_rollup

    plans = _plans_of_tree_walk(spark, monkeypatch, path_rollup)
    assert len(plans) > 5 and not any("Broadcast" in p for p in plans)


def test_kafka_rows_keep_arrival_order(spark):
    """Kafka-shaped frames: last write wins by broker time, then offset, then partition,
    however far apart partitions and offsets lie."""
    import datetime as dt

    from streetflow.functions.parse import encode_messages
    from streetflow.operators.latest import latest_per_key
    from streetflow.schema import ARRIVAL
    from streetflow.streaming.jobs import kafka_order, parse_stream

    t = dt.datetime(2024, 1, 15, 10, 0, 0)
    ms = dt.timedelta(milliseconds=1)
    rows = [(0, 900, t), (1, 5, t + ms), (0, 16_383, t + ms), (0, 16_384, t + ms), (64, 16_384, t + ms), (1, 6, t + 2 * ms)]
    df = spark.createDataFrame([(p, o, at, i) for i, (p, o, at) in enumerate(rows)], "partition int, offset long, timestamp timestamp, i int")
    assert [r.i for r in df.orderBy(*kafka_order()).collect()] == list(range(6))
    sent = df.selectExpr("*", "'2024-01-15T10:00:00' AS date_time", "'s' AS denomination", "CAST(i AS DOUBLE) AS avg_speed", "1 AS travel_time",
                         "'ok' AS traffic_status", "CAST(NULL AS STRING) AS geo_shape", "'h' AS hierarchie", "'h' AS hierarchie_dv", "50 AS max_speed", "i AS seq")
    wire = df.join(encode_messages(sent).selectExpr("value", "seq AS i"), "i").drop("i")
    archived = parse_stream(wire)
    assert set(ARRIVAL) <= set(archived.columns)
    assert [r.avg_speed for r in archived.orderBy(*ARRIVAL).collect()] == [float(i) for i in range(6)]
    assert latest_per_key(archived.drop("geo_shape"), ["denomination", "date_time"], ARRIVAL).first().avg_speed == 5.0
    early = archived.drop("geo_shape").where("avg_speed < 5")
    assert latest_per_key(early, ["denomination", "date_time"], ARRIVAL).first().avg_speed == 4.0


def test_a_key_lies_in_one_file(spark, tmp_path):
    from streetflow.sources.keyed import KeyedTable

    t = KeyedTable(str(tmp_path / "t"), ["k"], ["n"])
    rows = spark.range(4000).select((F.col("id") % 40).cast("string").alias("k"), F.col("id").alias("n")).repartition(8)
    t.upsert(rows, 0)
    files = spark.read.parquet(t.batches).select("k", F.input_file_name().alias("f")).distinct()
    assert files.count() == 40


def test_wide_form_refuses_unlisted_ids(spark):
    from streetflow.operators.panels import long_to_wide

    df = spark.createDataFrame([(1, "a", 1.0), (1, "new", 2.0)], "t int, id string, v double")
    with pytest.raises(Exception, match="id not listed: new"):
        long_to_wide(df, "t", "id", "v", ["a"]).collect()


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    import streetflow.session as session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_missing_labels_are_empty_ones(spark):
    from streetflow.operators.samples import matchers

    df = spark.createDataFrame([(0, None), (1, ""), (2, "x")], "i int, l string")
    got = {op + pat: [r.i for r in df.where(matchers([("l", op, pat)])).orderBy("i").collect()] for op in ("=", "!=", "=~", "!~") for pat in ("", "x")}
    assert got == {"=": [0, 1], "=x": [2], "!=": [2], "!=x": [0, 1], "=~": [0, 1], "=~x": [2], "!~": [2], "!~x": [0, 1]}


def test_label_values_become_columns_or_raise(spark):
    from streetflow.operators.logs import values_of

    df = spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "a"]], "l string")
    assert values_of(df, "l") == ["a", "b", "c"]
    with pytest.raises(ValueError, match="more than 2 values"):
        values_of(df, "l", 2)


def test_runs_across_slices(spark):
    """Runs of flags, whatever the slices: against a plain loop."""
    import random

    from streetflow.operators.samples import flag_runs

    rng = random.Random(9)
    rows = [(s, t, rng.choice([True, False, None])) for s in ("a", "b", None) for t in rng.sample(range(60), 40)]
    rows += [("c", t, True) for t in range(30)] + [("d", 1, False)]
    df = spark.createDataFrame(rows, "s string, t int, f boolean")
    want = {}
    for s in {r[0] for r in rows}:
        flags = [bool(f) for _, _, f in sorted((r for r in rows if r[0] == s), key=lambda r: r[1])]
        runs = sum(f and not p for p, f in zip([False, *flags], flags))
        want[s] = (len(flags), sum(flags), runs, -runs)
    for width in (1, 7, 100):
        got = flag_runs(df, "s", "t", "f", F.floor(F.col("t") / width)).collect()
        assert {r.s: (r.n_buckets, r.n_outliers, r.n_runs, r.score) for r in got} == want


def test_flame_sides_without_stacks(spark):
    from streetflow.operators.stacks import flame_diff

    df = spark.createDataFrame([(1, "f", "left"), (1, "g", "left"), (2, "f", "left")], "s int, f string, side string")
    got = sorted((r.function, r.left, r.right, r.left_share, r.right_share) for r in flame_diff(df, "s", "f", F.col("side")).collect())
    assert got == [("f", 2, 0, 1.0, None), ("g", 1, 0, 0.5, None)]
