"""Operators with algorithms of their own, against plain Python: density clusters, log
templates, change points, call trees, recording rules, mergeable cardinalities."""

import collections
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from streetflow.session import work_dir


def clustered(values, eps, points):
    """value -> cluster number or None, by comparing all values of a bucket."""
    cores = sorted(v for v in set(values) if sum(abs(v - x) <= eps for x in values) >= points)
    number, of = 0, {}
    for a, b in zip([None, *cores], cores):
        number += a is not None and b - a > eps
        of[b] = number
    out = {}
    for v in set(values):
        near = min(((abs(v - c), c) for c in cores if abs(v - c) <= eps), default=None)
        out[v] = None if near is None else of[near[1]]
    return out


@pytest.mark.parametrize("eps,points", [(1.0, 3), (0.25, 5), (3.0, 2), (0.5, 1)])
def test_density_clusters_equal_brute_force(spark, monkeypatch, eps, points):
    from streetflow.operators import density

    monkeypatch.setattr(density, "SLICE", 4)  # clusters run over many slices
    rng = random.Random(points)
    rows = [(b, round(rng.gauss(rng.choice([0, 4, 20]), 1.5) * 4) / 4) for b in ("x", "y", None) for _ in range(80)]
    rows += [("z", 7.0)] * 50 + [("z", None), ("z", float("nan")), ("z", 100.0), ("w", -3.0)]
    df = spark.createDataFrame(rows, "b string, v double")
    got = density.density_clusters(df, ["b"], "v", eps, points).collect()
    assert len(got) == len(rows)
    for b in ("x", "y", "z", "w", None):
        want = clustered([v for k, v in rows if k == b and v is not None and v == v], eps, points)
        for r in got:
            if r.b == b:
                usable = r.v is not None and r.v == r.v
                assert r.cluster == (want[r.v] if usable else None)
                assert r.outlier == (usable and want[r.v] is None)


def test_templates_of_a_planted_log_are_recovered(spark):
    from streetflow.operators.templates import mine_templates, template_rollup

    rng = random.Random(1)
    name = lambda: "".join(rng.choices("abcdefghijklmnop", k=8))
    planted = {
        "user <*> logged in from <*>": lambda: f"user {name()} logged in from {name()}",
        "connection to <*> failed after <num> ms": lambda: f"connection to {name()} failed after {rng.randrange(9999)} ms",
        "GET <*> took <num> ms": lambda: f"GET /{name()} took {rng.randrange(999)} ms",
        "cache flushed": lambda: "cache flushed",
    }
    lines = [(i, t, make()) for i in range(200) for t, make in planted.items()]
    lines += [(i, None, f"{name()} {name()} {name()}") for i in range(30)] + [(0, None, None)]
    df = spark.createDataFrame([(i % 5, "info" if i % 2 else None, t, line) for i, t, line in lines], "bucket int, level string, planted string, line string")
    found = {r.pattern: r.template for r in mine_templates(df, "line", min_lines=20, share=0.01).collect()}
    from streetflow.operators.logs import mask_pattern

    for r in df.where("line IS NOT NULL").select("planted", mask_pattern(F.col("line")).alias("p")).collect():
        assert found[r.p] == (r.planted or "<*> <*> <*>")
    rolled = {r.template: r for r in template_rollup(df, "line", "bucket", "level", min_lines=20, share=0.01).collect()}
    assert set(rolled) == {*planted, "<*> <*> <*>"}
    assert all(rolled[t].total == 200 and rolled[t].n_buckets == 5 and rolled[t].levels == "info" for t in planted)
    assert rolled["cache flushed"].n_patterns == 1 and rolled["GET <*> took <num> ms"].n_patterns > 150


def test_rare_branches_merge_into_the_wildcard(spark):
    from streetflow.operators.templates import mine_templates

    lines = ["a x"] * 10 + ["b x"] * 10 + ["b y"] * 2 + ["a y"] * 10
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    got = {r.pattern: r.template for r in mine_templates(df, "line", min_lines=5, share=0.0, depth=2).collect()}
    assert got == {"a x": "a x", "b x": "b x", "a y": "a y", "b y": "b <*>"}
    flat = {r.pattern: r.template for r in mine_templates(df, "line", min_lines=5, share=0.0, depth=0).collect()}
    assert flat["b y"] == "b y"


def _templates_by_hand(lines, min_lines, share, depth):
    """line -> template, over all lines at once."""
    of_size = collections.defaultdict(list)
    for line in lines:
        of_size[len(line.split(" "))].append(line.split(" "))
    found = {}
    for rows in of_size.values():
        support = max(min_lines, math.ceil(len(rows) * share))
        seen = collections.Counter((i, t) for row in rows for i, t in enumerate(row))
        rows = [(row, [t if seen[i, t] >= support else "<*>" for i, t in enumerate(row)]) for row in rows]
        for at in range(depth):
            taken = collections.Counter(tuple(t[: at + 1]) for _, t in rows)
            rows = [(row, [*t[:at], "<*>", *t[at + 1 :]] if at < len(t) and taken[tuple(t[: at + 1])] < support else t) for row, t in rows]
        found.update((" ".join(row), " ".join(t)) for row, t in rows)
    return found


@pytest.mark.parametrize("part_bytes,sorted_tokens", [(24 << 20, 1 << 20), (64, 8)])
def test_templates_move_lines_whole_and_equal_brute_force(spark, monkeypatch, part_bytes, sorted_tokens):
    from streetflow.operators import templates
    from streetflow.plans.inspect import plan_text

    monkeypatch.setattr(templates, "PART_BYTES", part_bytes)  # one part a length, or many
    monkeypatch.setattr(templates, "SORTED_TOKENS", sorted_tokens)
    plans, write = [], templates.written
    monkeypatch.setattr(templates, "written", lambda df, name: plans.append(plan_text(df)) or write(df, name))
    rng = random.Random(7)
    lines = [" ".join(rng.choices(["a", "b", "é", "", "<*>"], [8, 4, 1, 1, 1], k=rng.choice([1, 2, 3, 5]))) for _ in range(600)]
    lines += [f"{rng.choice('xyz')} only once {chr(97 + i)}" for i in range(20)] + ["", "", "seen once in a length of eight tokens"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    found = templates.mine_templates(df, "line", min_lines=4, share=0.05, depth=2).collect()
    assert len(found) == len(set(lines))
    assert {r.pattern: r.template for r in found} == _templates_by_hand(lines, 4, 0.05, 2)
    assert plans and not any("posexplode" in p for p in plans)  # a row for each token would carry the line as often


def test_change_points_find_the_planted_shift(spark):
    from streetflow.operators.logs import change_points

    rng = random.Random(4)
    series = {"flat": [5] * 30, "one": [3], "early": [9] * 8 + [1] * 40, "late": [rng.randrange(3) for _ in range(50)] + [rng.randrange(20, 25) for _ in range(20)]}
    series["noise"] = [rng.randrange(10) for _ in range(64)]
    df = spark.createDataFrame([(s, i, v) for s, vs in series.items() for i, v in enumerate(vs)] + [(None, 1, 2), ("flat", 99, None)], "s string, i int, v long")
    for width in (1, 7, 1000):
        got = {r.s: r for r in change_points(df, "s", "i", "v", F.floor(F.col("i") / width)).collect()}
        for s, vs in series.items():
            n, mean = len(vs), sum(vs) / len(vs)
            sd = math.sqrt(sum((v - mean) ** 2 for v in vs) / n)
            cuts = [(abs(sum(vs[:k]) - k * mean), -k) for k in range(1, n)]
            if sd == 0:
                assert (got[s].score, got[s].changed_at) == (0.0, None)
            else:
                assert got[s].score == pytest.approx(max(cuts)[0] / (sd * math.sqrt(n)))
                assert got[s].changed_at == next(k for k in range(1, n) if cuts[k - 1][0] == pytest.approx(max(cuts)[0]))
        assert got["early"].changed_at == 8 and got["late"].changed_at == 50 and got[None].score == 0.0


def test_call_trees_keep_their_weight_at_any_limit(spark):
    from streetflow.operators.stacks import OTHER, flame_tree

    rng = random.Random(7)
    stacks = {s: [rng.choice("abc") for _ in range(rng.randrange(1, 6))] for s in range(60)}
    stacks[99] = ["a", None, "c"]
    weight = {s: rng.randrange(1, 9) for s in stacks}
    rows = [(s, p, f, weight[s]) for s, fs in stacks.items() for p, f in enumerate(fs)]
    df = spark.createDataFrame(rows, "s int, p int, f string, w long").repartition(4)
    own, total = collections.Counter(), collections.Counter()
    for s, fs in stacks.items():
        path = tuple(f or "" for f in fs)
        own[path] += weight[s]
        for d in range(1, len(path) + 1):
            total[path[:d]] += weight[s]
    nodes = {r.id: r for r in flame_tree(df, "s", "p", "f", F.col("w")).collect()}

    def path(r):
        return (path(nodes[r.parent]) if r.parent else ()) + (r.function,)

    assert {path(r): (r.self, r.total, r.depth) for r in nodes.values()} == {p: (own[p], t, len(p)) for p, t in total.items()}
    whole = sum(weight.values())
    for limit in (1, 2, 5, 17, 10_000):
        kept = flame_tree(df, "s", "p", "f", F.col("w"), max_nodes=limit).collect()
        ids = {r.id for r in kept if r.id}
        assert len(ids) == min(limit, len(nodes)) and sum(r.self for r in kept) == whole
        assert all(not r.parent or r.parent in ids for r in kept)
        assert all((r.function == OTHER) == (r.id is None) for r in kept)
        assert max(nodes[i].total for i in nodes) == max(r.total for r in kept if r.id)


def test_recording_rule_stream_equals_batch(spark):
    """Samples land in several files, with repeated rows; closed windows equal the batch's."""
    from streetflow.operators.stacks import recorded_totals
    from streetflow.streaming.jobs import file_sink, run_to_end

    rng = random.Random(2)
    start = dt.datetime(2024, 1, 15)
    rows = []
    for s in range(200):
        at = start + dt.timedelta(seconds=s * 20)
        rows += [(s, rng.choice("abcd"), at, s % 5 + 1) for _ in range(rng.randrange(1, 6))]
    schema = "s long, f string, at timestamp, w long"
    folder = work_dir(spark, "rule-in")
    for k in range(4):  # a later file repeats rows of the one before
        spark.createDataFrame(rows[max(0, k * len(rows) // 4 - 5) : (k + 1) * len(rows) // 4], schema).coalesce(1).write.mode("append").parquet(folder)
    batch = recorded_totals(spark.read.schema(schema).parquet(folder), "s", "f", "at", "w", "10 minutes")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    stream = recorded_totals(source, "s", "f", "at", "w", "10 minutes", "2 minutes")
    out = work_dir(spark, "rule-out")
    run_to_end([file_sink(stream, out, work_dir(spark, "rule-ck"))])
    want = collections.Counter()
    for s, f in {(r[0], r[1]) for r in rows}:
        at = start + dt.timedelta(seconds=s * 20)
        want[at - dt.timedelta(minutes=at.minute % 10, seconds=at.second), f] += s % 5 + 1
    assert {(r.window_start, r.function): r.total for r in batch.collect()} == dict(want)
    got = {(r.window_start, r.function): r.total for r in spark.read.schema(stream.schema).parquet(out).collect()}
    closed = start + dt.timedelta(seconds=199 * 20) - dt.timedelta(minutes=12)
    assert got == {k: v for k, v in want.items() if k[0] <= closed} and len(got) > 8


def test_merged_cardinalities_stay_within_their_bound(spark):
    from streetflow.operators.logs import cardinality_sketches, merged_cardinality

    df = spark.range(200_000).selectExpr("CAST(id % 10 AS STRING) AS d", "IF(id % 3 = 0, 'a', 'b') AS key", "CAST(id % 50021 AS STRING) AS value")
    sketches = cardinality_sketches(df, F.col("d"))
    got = {r.key: r for r in merged_cardinality(sketches).collect()}
    exact = {r.key: r.n for r in df.groupBy("key").agg(F.count_distinct("value").alias("n")).collect()}
    assert all(abs(got[k].n_values - n) <= 0.05 * n and got[k].n_days == 10 for k, n in exact.items())
    some = merged_cardinality(sketches.where("day < '3'")).agg(F.sum("n_fields")).first()[0]
    assert some == 60_000


def test_a_line_counts_once_for_a_repeated_key(spark):
    from streetflow.operators.logs import field_profile, parsed_fields

    df = spark.createDataFrame([(1, "a=1 a=2 b=3"), (2, "a=2"), (3, "none")], "id int, line string")
    lines = df.agg(F.count("*").alias("n"))
    for nth in (True, False):
        got = {r.key: (r.n_values, r.n_lines) for r in field_profile(parsed_fields(df, ["id"], nth=nth), ["id"], lines).collect()}
        assert got == {"a": (2, 2), "b": (1, 1)}


def test_pane_folds_equal_a_plain_loop(spark):
    """Windows that are no multiple of their step, null values and a constant series."""
    from streetflow.operators.samples import over_time

    rng = random.Random(5)
    start = dt.datetime(2024, 1, 15)
    rows = [(s, start + dt.timedelta(seconds=rng.randrange(7200)), None if rng.random() < 0.1 else (4.5 if s == "c" else 1e6 + rng.random()), i) for i, s in enumerate(["a", "b", "c"] * 60)]
    df = spark.createDataFrame(rows, "s string, t timestamp, v double, i int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {(r.window_start, r.s): r for r in over_time(df, ["s"], "t", "v", "25 minutes", "10 minutes", order=["i"]).collect()}
    want = collections.defaultdict(list)
    for s, t, v, i in rows:
        k = math.floor((t - start).total_seconds() / 600)
        for w in (k, k - 1, k - 2):
            if (t - start).total_seconds() < w * 600 + 1500:
                want[start + dt.timedelta(seconds=w * 600), s].append((t, i, v))
    assert got.keys() == want.keys()
    for key, hits in want.items():
        r, vs = got[key], [v for _, _, v in hits if v is not None]
        assert r["count"] == len(vs) and r.present == 1 and r.last == max(hits, key=lambda h: h[:2])[2]
        if vs:
            mean = sum(vs) / len(vs)
            var = sum((v - mean) ** 2 for v in vs) / len(vs)
            assert (r.min, r.max) == (min(vs), max(vs))
            assert r.avg == pytest.approx(mean) and r["sum"] == pytest.approx(sum(vs)) and r.stdvar == pytest.approx(var, rel=1e-6, abs=1e-9)
            assert r.median == pytest.approx(sorted(vs)[len(vs) // 2] if len(vs) % 2 else sum(sorted(vs)[len(vs) // 2 - 1 : len(vs) // 2 + 1]) / 2)
