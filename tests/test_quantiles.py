"""Exact quantiles by grid cells equal Spark's percentile (and DuckDB's quantile_cont)."""

import pytest
from pyspark.sql import functions as F

from streetflow.operators.quantiles import exact_quantiles
from tests.conftest import SMALL

QS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def _cmp(a, b, keys):
    ra = {tuple(r[k] for k in keys): r for r in a.collect()}
    rb = {tuple(r[k] for k in keys): r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        for c in ["q0", "q25", "q50", "q90", "q99", "q100"]:
            assert ra[k][c] == pytest.approx(rb[k][c], rel=1e-12, abs=1e-9), (k, c)


@pytest.mark.parametrize("grid", [1, 2, 4096])
def test_refined_equals_percentile(spark, monkeypatch, grid):
    monkeypatch.setattr("streetflow.operators.quantiles.GRID", grid)
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet").withColumn("flag", F.col("l_returnflag"))
    # null keys, duplicate-heavy values and a hot group all present
    li = li.withColumn("flag", F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("flag")))
    want = li.groupBy("flag").agg(*[F.percentile("l_quantity", q).alias(f"q{int(round(q * 100))}") for q in QS])
    got = exact_quantiles(li, ["flag"], "l_quantity", QS)
    _cmp(got, want, ["flag"])
    got2 = exact_quantiles(li, ["flag"], "l_extendedprice", QS)
    want2 = li.groupBy("flag").agg(*[F.percentile("l_extendedprice", q).alias(f"q{int(round(q * 100))}") for q in QS])
    _cmp(got2, want2, ["flag"])


def test_no_job_runs_while_the_plan_is_built(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    sc = spark.sparkContext
    sc.setJobGroup("quantile-plan", "quantile-plan")
    try:
        got = exact_quantiles(ev, ["event_type"], "value", [0.5])
        assert list(sc.statusTracker().getJobIdsForGroup("quantile-plan")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got.count() == 5


def test_values_of_every_sign_and_size(spark):
    vals = [0.0, -0.0, 1.0, -1.0, 2.0**60, -(2.0**60), 1e-300, -1e-300, 5e-324, 1.7e308, -1.7e308, 0.1, 0.1000001, 3.0, None, float("inf"), float("-inf")]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", None), ("c", 7.0)], "g string, v double")
    n = len([v for v in vals if v is not None])
    qs = [i / (n - 1) for i in range(n)]
    names = [f"r{i}" for i in range(n)]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", qs, names=names).collect()}
    want = df.where("g = 'a'").agg(*[F.percentile("v", q).alias(x) for q, x in zip(qs, names)]).first()
    for x in names:
        a, b = got["a"][x], want[x]
        assert a == pytest.approx(b, rel=1e-9) or (a != a and b != b), (x, a, b)
    assert got["b"]["r0"] is None and got["c"]["r0"] == got["c"][names[-1]] == 7.0


def test_refined_with_struct_window_key(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    w = ev.select(F.window("ts", "1 day", "12 hours").alias("w"), "event_type", "value")
    want = w.groupBy("w", "event_type").agg(F.percentile("value", 0.5).alias("q50"))
    got = exact_quantiles(w, ["w", "event_type"], "value", [0.5])
    a = {(r.w.start, r.event_type): r.q50 for r in got.collect()}
    b = {(r.w.start, r.event_type): r.q50 for r in want.collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)


def test_a_million_seconds_of_a_day_are_not_ranked_together(spark, monkeypatch):
    """The narrowest realistic range: every ranking window stays tiny, whatever the group's size."""
    from streetflow.operators import quantiles

    joined, join = [], quantiles._join
    monkeypatch.setattr(quantiles, "_join", lambda *a, **k: joined.append(join(*a, **k)) or joined[-1])
    day = 1_705_276_800
    df = spark.range(1_000_000).selectExpr("'hot' AS g", f"{day} + (id * 7919 % 1000000) * 0.0864D AS v")
    got = exact_quantiles(df, ["g"], "v", [0.5, 0.99], names=["a", "b"]).first()
    want = sorted(day + (i * 7919 % 1_000_000) * 0.0864 for i in range(1_000_000))
    assert got.a == pytest.approx((want[499_999] + want[500_000]) / 2, rel=1e-12)
    at = 0.99 * 999_999
    assert got.b == pytest.approx(want[int(at)] + (at - int(at)) * (want[int(at) + 1] - want[int(at)]), rel=1e-12)
    ranked = next(d for d in joined if "_part" in d.columns and "_v" in d.columns and "_before" in d.columns)
    assert ranked.groupBy("_cell", "_part").count().agg(F.max("count")).first()[0] <= 8
    assert ranked.count() <= 32
