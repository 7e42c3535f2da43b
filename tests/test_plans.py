"""Physical-plan properties of the registered queries."""

import pytest

from conftest import SF_SMALL
from skywave.plans.registry import all_queries

QUERIES = all_queries()
#: Queries that write files first: streams and raw files.
WRITING = {n for n in QUERIES if n.startswith("stream_")} | {"pskr_ingest", "scan_spots_csv", "scan_quarantine"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cartesian_no_python(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in p, f"{name}: {bad}"


def test_anti_joins_are_hash_joins(spark):
    for name in ("signatures_v2", "exclude_type2", "exclude_velocity_day", "type2_telemetry"):
        p = plan_of(QUERIES[name](spark, SF_SMALL))
        assert "LeftAnti" in p
        for line in p.splitlines():
            if "LeftAnti" in line:
                assert "BroadcastHashJoin" in line or "SortMergeJoin" in line or "ShuffledHashJoin" in line, line


def test_signature_plan_has_one_fact_exchange(spark):
    """Between the spots scan and the result of a v1 build there is one exchange,
    on the five keys, over a partial aggregate; the solar buckets are broadcast."""
    lines = plan_of(QUERIES["signatures_v1"](spark, SF_SMALL)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "reporter_grid" in line)
    depth = lambda line: next((i for i, c in enumerate(line) if c.isalpha()), 0)
    above, d = [], depth(lines[scan])
    for line in reversed(lines[:scan]):                 # the scan's ancestors, nearest first
        if depth(line) < d:
            above.append(line)
            d = depth(line)
    exchanges = [i for i, line in enumerate(above) if "Exchange" in line]
    assert len(exchanges) == 1 and not any("Window" in line or "Sort" in line.split("[")[0] for line in above)
    assert "partial_percentile" in above[exchanges[0] - 1] and above[exchanges[0]].split("hashpartitioning(")[1].split("ENSURE")[0].count("#") == 5
    assert any("BroadcastHashJoin" in line for line in above)


@pytest.mark.parametrize("name", ["signatures_v2", "rbn_signatures", "callsign_grid", "gold_continuous", "balloon_flags_v1"])
def test_building_a_query_runs_no_job(spark, name):
    """Queries over stored bronze are lazy: no count, checkpoint or write while they are built."""
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")   # files are listed by the driver
    try:
        QUERIES[name](spark, SF_SMALL)                  # stores the bronze tables
        spark.sparkContext.setJobGroup(f"build-{name}", "build")
        QUERIES[name](spark, SF_SMALL)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
    finally:
        spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.threshold")
        spark.sparkContext.setJobGroup("", "")


def test_joins_agree_without_broadcast(spark):
    from skywave.plans import catalog
    rows = lambda: sorted(map(tuple, QUERIES["rbn_signatures"](spark, SF_SMALL).collect()), key=str)
    with_broadcast = rows()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == with_broadcast and catalog is not None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scan_prunes_columns(spark):
    from skywave.sources import fixtures as fx
    from skywave.operators import signatures
    df = signatures.wspr_signatures(fx.spots(spark, SF_SMALL), None)
    p = plan_of(df)
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line][0]
    assert "callsign" not in scan.split("ReadSchema")[1] and "snr" in scan.split("ReadSchema")[1]
    assert "PushedFilters: [IsNotNull(distance), GreaterThanOrEqual(distance,500)" in scan


def test_time_windows_prune_month_partitions(spark):
    from skywave.operators import sampling
    from skywave.sources import fixtures as fx
    df = sampling.training_filter(fx.spots(spark, SF_SMALL), ("1999-01-01", "1999-03-01"))
    p = plan_of(df)
    scan = [line for line in p.splitlines() if "Scan parquet" in line or "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(ym" in scan and "199901" in scan and "199903" in scan


@pytest.mark.parametrize("name", ["callsign_grid", "velocity_day", "balloon_flags_v2", "signatures_v1", "spots_daily"])
def test_aggregations_combine_map_side(spark, name):
    """Every hash exchange directly under an aggregation sits on a partial
    aggregate (map-side combine), so a callsign holding a third of all spots is
    reduced in each task before it is shuffled."""
    df = QUERIES[name](spark, SF_SMALL)
    lines = plan_of(df).splitlines()
    checked = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i > 0 and "Aggregate" in lines[i - 1]:
            below = lines[i + 1]
            assert "Aggregate" in below and ("partial_" in below or "functions=[]" in below), below
            checked += 1
    assert checked >= 1
