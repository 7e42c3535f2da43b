"""Every registered query vs its DuckDB oracle SQL on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from skywave.plans.oracle import ORACLE  # noqa: E402
from skywave.plans.registry import all_queries  # noqa: E402
from oracle_check import duck, normalize, type_diff  # noqa: E402

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_with_sql_or_documented():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:5] == ["tx_grid_4", "rx_grid_4", "band", "hour", "month"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    assert type_diff(sdf, con, ORACLE[name]) == {}
    sp = sdf.toPandas()
    dk = con.execute(ORACLE[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    a, b = normalize(sp), normalize(dk)
    assert len(a) == len(b)
    assert a.equals(b)


def test_flux_is_not_rounded_away(spark):
    for name in ("scan_solar", "solar_daily", "latest_by_key", "live_conditions", "live_enrich"):
        top = QUERIES[name](spark, SF_SMALL).agg({"xray_long": "max"}).first()[0]
        assert 0 < top < 1e-4, name
