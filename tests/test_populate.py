"""Warehouse population: dependency order, gates, outputs equal the registered queries."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from skywave.operators.tables import RowGateError
from skywave.plans import populate
from skywave.plans.catalog import FIXTURE_WINDOW
from skywave.session import scratch_path
from skywave.sources import fixtures as fx
from skywave.sources import schemas


def _warehouse(spark, gates=None):
    wh = populate.Warehouse(spark, scratch_path(spark, "test-warehouse"),
                            windows={"contest": FIXTURE_WINDOW, "rbn": FIXTURE_WINDOW, "gold": FIXTURE_WINDOW})
    wh.gates.update(gates or {"callsign_grid": 10, "flags": 1})
    cols = lambda df, s: df.select(*[f.name for f in s.fields])
    wh.load_bronze(cols(fx.spots(spark, SF_SMALL), schemas.WSPR_SPOT), "wspr.bronze")
    wh.load_bronze(cols(fx.rbn_raw(spark, SF_SMALL), schemas.RBN_SPOT), "rbn.bronze")
    wh.load_bronze(cols(fx.contest_raw(spark, SF_SMALL), schemas.CONTEST_QSO), "contest.bronze")
    wh.write(fx.solar_raw(spark, SF_SMALL), "solar.bronze")
    return wh


def test_build_order_adds_prerequisites():
    assert populate.build_order(["signatures_v2"]) == ["station_days", "callsign_grid", "balloon_flags", "signatures_v2"]
    assert populate.build_order(["gold_v6", "quality_test_paths"]) == ["signatures_v1", "gold_continuous", "gold_v6",
                                                                      "quality_test_paths"]


def test_populate_matches_registered_queries(spark):
    wh = _warehouse(spark)
    opts = {"gold_stratified": {"per_cell": 20}, "gold_continuous": {"per_band": 200, "density_limit": 2000},
            "quality_test_paths": {"per_band": 40, "min_spots": 8}}
    report = {r.step: r.rows for r in populate.run(wh, options=opts).collect()}
    q = E.queries()
    for step, key in [("callsign_grid", "callsign_grid"), ("balloon_flags", "balloon_flags_v2"),
                      ("signatures_v1", "signatures_v1"), ("signatures_v2", "signatures_v2"),
                      ("contest_signatures", "contest_signatures"), ("rbn_signatures", "rbn_signatures"),
                      ("gold_stratified", "gold_stratified"), ("gold_continuous", "gold_continuous"),
                      ("gold_v6", "gold_v6"), ("quality_test_paths", "quality_test_paths")]:
        assert report[step] == q[key](spark, SF_SMALL).count(), step
    # re-running a step overwrites instead of appending
    populate.run(wh, ["signatures_v1"])
    assert wh.read("wspr.signatures_v1").count() == report["signatures_v1"]


def test_gate_blocks_flagging_on_incomplete_dimension(spark):
    wh = _warehouse(spark, {"callsign_grid": 10})
    populate.run(wh, ["callsign_grid"])
    wh.gates["callsign_grid"] = 10_000_000
    with pytest.raises(RowGateError):
        populate.populate_balloon_flags(wh)
