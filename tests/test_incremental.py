"""Re-loads, signatures kept by months, station-days kept by loads, and top-k both ways."""

import gzip

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from skywave.operators import callsigns, incremental, signatures
from skywave.operators.sampling import top_k
from skywave.session import scratch_path
from skywave.sources import fixtures as fx
from skywave.sources.schemas import PSKR_SPOT
from skywave.sources.sinks import window_filter
from skywave.streaming import loads


def rows(spark, contents):
    """contents: {file: number of rows}, as the spots of named files."""
    data = [(f, i) for f, n in contents.items() for i in range(n)]
    return (spark.createDataFrame(data, "file string, i int")
            .selectExpr("timestamp'2024-01-31 23:00:00' + make_interval(0, 0, 0, 0, i) as timestamp", "concat(file, '-', i) as sender_call", "'JO62' as sender_grid",
                        "'K1ABC' as receiver_call", "'FN42' as receiver_grid", "14074000L as frequency", "107 as band", "'FT8' as mode", "i as snr", "file"))


def counts(spark, d):
    got = loads.read_current(spark, f"{d}/bronze", f"{d}/log")
    assert got.columns == PSKR_SPOT.fieldNames()
    return {r.f: r["count"] for r in got.groupBy(F.substring_index("sender_call", "-", 1).alias("f")).count().collect()}


def test_reload_replaces(spark, monkeypatch):
    d = scratch_path(spark, "test-reload")
    load = lambda: loads.load_pending(spark, f"{d}/src", f"{d}/bronze", f"{d}/log", max_files=2)
    loads.write_named_files(rows(spark, {"a": 3, "b": 5, "c": 4}), f"{d}/src")
    assert load() == 3 and counts(spark, d) == {"a": 3, "b": 5, "c": 4}
    assert load() == 0
    loads.write_named_files(rows(spark, {"a": 7, "b": 2, "d": 1}), f"{d}/src")          # grown, shrunk, new
    keep = loads._load
    monkeypatch.setattr(loads, "_load", lambda *a: (keep(*a[:4], f"{d}/other-log", *a[5:]), (_ for _ in ()).throw(RuntimeError("killed")))[0])
    with pytest.raises(RuntimeError):
        load()
    assert counts(spark, d) == {"a": 3, "b": 5, "c": 4}                                  # bronze written, not logged: not seen
    monkeypatch.setattr(loads, "_load", keep)
    assert load() == 3 and counts(spark, d) == {"a": 7, "b": 2, "c": 4, "d": 1}
    log = loads.newest_entries(loads.read_log(spark, f"{d}/log"))
    assert {r.file_path.rsplit("/", 1)[1]: r.row_count for r in log.collect()} == {"a.json.gz": 7, "b.json.gz": 2, "c.json.gz": 4, "d.json.gz": 1}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(d).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path(f"{d}/src/b.json.gz"), False)
    out = fs.create(path(f"{d}/src/b.json.gz"), True)                                    # rewritten without a row
    out.write(gzip.compress(b""))
    out.close()
    assert load() == 1 and counts(spark, d) == {"a": 7, "c": 4, "d": 1}


def test_signatures_by_months(spark):
    s, sol = fx.spots(spark, SF_SMALL), fx.solar_raw(spark, SF_SMALL)
    path = scratch_path(spark, "test-partials")
    want = signatures.wspr_signatures(s, sol, min_spots=1)
    half = s.agg(F.date_format(F.date_trunc("month", F.expr("timestamp_seconds(percentile(unix_seconds(timestamp), 0.5))")), "yyyy-MM-dd")).first()[0]
    new = window_filter(s, (half, "2100-01-01"))
    incremental.add_months(window_filter(s, ("1900-01-01", half)), sol, path)
    incremental.add_months(new.withColumn("snr", F.lit(1)), sol, path)                   # replaced by the replay below
    incremental.add_months(new, sol, path)
    got = incremental.signatures_of(spark.read.parquet(path), min_spots=1)
    floats = [c for c, t in want.dtypes if t == "double"]
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if c in floats else c for c in want.columns])
    assert rounded(got).exceptAll(rounded(want)).count() == 0 and got.count() == want.count()
    plan = incremental.signature_partials(new, sol)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and f"ym#" in plan                  # the new months only
    out = scratch_path(spark, "test-signatures")
    incremental.refresh_signatures(spark, path, out, min_spots=1)
    incremental.refresh_signatures(spark, path, out, months=[2, 3], min_spots=1)
    assert rounded(spark.read.parquet(out).select(*[F.col(c).cast(dict(want.dtypes)[c]) for c in want.columns])).exceptAll(rounded(want)).count() == 0


def test_station_days_by_loads(spark):
    s = fx.spots(spark, SF_SMALL)
    path = scratch_path(spark, "test-station-days")
    cut = s.agg(F.date_format(F.date_trunc("month", F.max("timestamp")), "yyyy-MM-dd")).first()[0]
    incremental.add_days(window_filter(s, ("1900-01-01", cut)), path, 0)
    incremental.add_days(window_filter(s, (cut, "2100-01-01")).withColumn("grid", F.lit("AA00")), path, 1)
    incremental.add_days(window_filter(s, (cut, "2100-01-01")), path, 2)
    got, want = callsigns.callsign_grid(summary=incremental.station_days_of(spark, path)), callsigns.callsign_grid(s)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("groups", [["g"], []])
@pytest.mark.parametrize("desc", [False, True])
def test_top_k_both_ways(spark, groups, desc):
    df = spark.range(5000).selectExpr("id", "nullif(id % 4, 3) as g", "case when id % 11 = 0 then null when id % 13 = 0 then double('NaN') else double(hash(id) % 300) / 7 end as v").repartition(7)
    for k in (1, 40, 1300, 6000):
        one, two = (sorted(map(tuple, top_k(df, k, "v", desc, groups, ["id"], by_counts=way).select("id", "sample_rank").collect())) for way in (False, True))
        assert one == two


def test_top_k_reads_its_input_once(spark):
    path = scratch_path(spark, "test-topk")
    spark.range(1000).selectExpr("id", "id % 3 as g", "rand(1) as v").write.parquet(path)
    df = spark.read.parquet(path)
    plan = top_k(df, 20, "v", group_cols=["g"], tie_cols=["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan.split("Exchange")[-1]
