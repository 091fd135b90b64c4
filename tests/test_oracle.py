"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from streetflow import registry
from tests.compare import duck, rows
from tests.conftest import SMOKE

registry.load_all()
QUERIES, ORACLES = dict(registry.QUERIES), dict(registry.ORACLES)  # the optional subpackage has its own tests


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 70


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["denomination", "hierarchie", "avg_speed_today", "max_speed_today", "speed_ratio_today"]


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SMOKE)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    assert types == {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    got = sdf.toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


ANSI_SENSITIVE = ["daily_analysis", "geo_flatten", "json_parse", "store_row", "path_rollup", "counter_increase"]


@pytest.mark.parametrize("name", ANSI_SENSITIVE)
def test_matches_with_ansi_off(spark, con, name):
    """The null-on-error forms keep results identical when a session disables ANSI."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = QUERIES[name](spark, SMOKE).toPandas()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert rows(got) == rows(con.execute(ORACLES[name]).df())
