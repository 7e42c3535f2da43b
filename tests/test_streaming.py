"""Stream restarts do not double count (checkpoint + batch-keyed sinks)."""

from skywave.session import scratch_path
from skywave.sources import fixtures as fx
from skywave.streaming import ingest, rollups
import pytest
from conftest import SF_SMALL


def test_ingest_restart_is_exactly_once(spark):
    base = scratch_path(spark, "test-ingest")
    d = {k: f"{base}/{k}" for k in ("src", "out", "log", "ckpt")}
    src = fx.pskr_spots(spark, SF_SMALL)
    ingest.write_jsonl_gz(src, d["src"], files=2)
    ingest.ingest_pskr(spark, d["src"], d["out"], d["log"], d["ckpt"])
    ingest.ingest_pskr(spark, d["src"], d["out"], d["log"], d["ckpt"])   # restart: nothing new
    assert ingest.read_bronze(spark, d["out"]).count() == src.count()
    log = ingest.read_log(spark, d["log"]).collect()
    assert len(log) == ingest.source_files(spark, d["src"]).count() and sum(r.row_count for r in log) == src.count()
    assert all(r.file_size > 0 for r in log)


def test_empty_files_are_logged(spark):
    base = scratch_path(spark, "test-empty")
    d = {k: f"{base}/{k}" for k in ("src", "out", "log", "ckpt")}
    src = fx.pskr_spots(spark, SF_SMALL).limit(50)
    ingest.write_files(src, d["src"], files=1)
    spark.createDataFrame([("",)], "value string").coalesce(1).write.mode("append").text(d["src"])
    ingest.ingest_pskr(spark, d["src"], d["out"], d["log"], d["ckpt"])
    log = ingest.read_log(spark, d["log"]).collect()
    assert sorted(r.row_count for r in log)[0] == 0 and sum(r.row_count for r in log) == 50
    assert len(log) == ingest.source_files(spark, d["src"]).count()


def test_rollups_lose_nothing_whatever_the_file_order(spark):
    from skywave.operators import features, reports
    from skywave.sources.schemas import SILVER, WSPR_SPOT
    cols = lambda df, s: df.select(*[f.name for f in s.fields])
    for newest_first in (False, True):
        base = scratch_path(spark, "test-order")
        ingest.write_files(cols(fx.silver(spark, SF_SMALL), SILVER), f"{base}/s", files=3, fmt="parquet", newest_first=newest_first)
        rollups.run_quality_rollup(spark, f"{base}/s", SILVER, f"{base}/so", f"{base}/sc", max_files_per_trigger=1)
        got = rollups.read_quality_rollup(spark, f"{base}/so")
        want = features.quality_distribution(fx.silver(spark, SF_SMALL))
        keep = ["hour_start", "band", "quality_bucket", "count", "sum_distance"]
        assert got.select(*keep).exceptAll(want.select(*keep)).count() == 0 and got.count() == want.count()
        ingest.write_files(cols(fx.spots(spark, SF_SMALL), WSPR_SPOT), f"{base}/d", files=3, fmt="parquet", newest_first=newest_first)
        rollups.run_spots_daily(spark, f"{base}/d", f"{base}/do", f"{base}/dc", max_files_per_trigger=2)
        rollups.run_spots_daily(spark, f"{base}/d", f"{base}/do", f"{base}/dc")           # restart: nothing new
        got, want = rollups.read_spots_daily(spark, f"{base}/do"), reports.spots_daily(fx.spots(spark, SF_SMALL))
        assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_compaction_and_replay(spark, monkeypatch):
    """A stream that compacts reads the same; killed between the compacted set and the switch to
    it, it reads the same before and after its restart, and no batch counts twice."""
    from skywave.sources.schemas import SILVER
    base = scratch_path(spark, "test-compact")
    silver = fx.silver(spark, SF_SMALL).select(*SILVER.fieldNames())
    keep = ["hour_start", "band", "quality_bucket", "count", "sum_distance"]
    want = sorted(map(tuple, features_of(silver).select(*keep).collect()), key=str)
    silver.repartition(12).write.parquet(f"{base}/s")

    def read():
        return sorted(map(tuple, rollups.read_quality_rollup(spark, f"{base}/o").select(*keep).collect()), key=str)

    keep_switch = rollups.switch

    def killed(session, path, upto):
        if upto >= 7:
            raise RuntimeError("killed")
        keep_switch(session, path, upto)

    monkeypatch.setattr(rollups, "switch", killed)
    with pytest.raises(Exception, match="killed"):
        rollups.run_quality_rollup(spark, f"{base}/s", SILVER, f"{base}/o", f"{base}/c", max_files_per_trigger=1, compact_every=4)
    assert rollups.compacted_upto(spark, f"{base}/o") == 3
    assert sum(r[3] for r in read()) < sum(r[3] for r in want)             # eight batches of twelve, each once
    assert spark.read.parquet(f"{base}/o/compacted/upto=7").count() > 0    # written, and not yet seen
    monkeypatch.setattr(rollups, "switch", keep_switch)
    rollups.run_quality_rollup(spark, f"{base}/s", SILVER, f"{base}/o", f"{base}/c", max_files_per_trigger=1, compact_every=4)
    assert rollups.compacted_upto(spark, f"{base}/o") == 7 and read() == want
    rollups.compact(spark, f"{base}/o", rollups.merge_quality, 7)          # a replay: nothing changes
    assert read() == want
    files = [r[0] for r in rollups.read_partials(spark, f"{base}/o").selectExpr("input_file_name()").distinct().collect()]
    assert {f.split("/o/")[1].split("/")[1] for f in files} <= {"upto=7", "batch_id=8", "batch_id=9", "batch_id=10", "batch_id=11"}


def features_of(silver):
    from skywave.operators import features
    return features.quality_distribution(silver)


def test_an_old_batch_does_not_replace_newer_conditions(spark):
    from skywave.operators import features
    from skywave.sources.schemas import SOLAR
    from skywave.streaming import live
    base = scratch_path(spark, "test-live-order")
    sol = fx.solar_raw(spark, SF_SMALL)
    ingest.write_files(sol.select(*SOLAR.fieldNames()), f"{base}/s", files=3, fmt="parquet", newest_first=True, ts_col="time")
    live.run_live_conditions(spark, f"{base}/s", f"{base}/o", f"{base}/c", max_files_per_trigger=1)
    assert live.read_live_conditions(spark, f"{base}/o").collect() == features.live_conditions(sol).collect()


def test_quality_rollup_restart(spark):
    from skywave.sources.schemas import SILVER
    base = scratch_path(spark, "test-quality")
    d = {k: f"{base}/{k}" for k in ("src", "out", "ckpt")}
    sil = fx.silver(spark, SF_SMALL)
    sil.coalesce(1).write.parquet(d["src"])
    rollups.run_quality_rollup(spark, d["src"], SILVER, d["out"], d["ckpt"])
    rollups.run_quality_rollup(spark, d["src"], SILVER, d["out"], d["ckpt"])
    got = rollups.read_quality_rollup(spark, d["out"])
    assert got.groupBy().sum("count").first()[0] == sil.count()


def test_live_conditions_snapshot_and_stream_static_join(spark):
    from pyspark.sql import functions as F
    from skywave.operators import features, solar
    from skywave.sources.schemas import SOLAR
    from skywave.streaming import live
    base = scratch_path(spark, "test-live")
    sol = fx.solar_raw(spark, SF_SMALL)
    sol.coalesce(1).write.parquet(f"{base}/src")
    live.run_live_conditions(spark, f"{base}/src", f"{base}/snap", f"{base}/ckpt")
    snap = live.read_live_conditions(spark, f"{base}/snap").collect()
    exp = features.live_conditions(sol).collect()
    assert len(snap) == 1 and snap[0].asDict() == exp[0].asDict()
    # stream-static enrichment equals the batch enrichment
    stream = spark.readStream.schema(SOLAR).parquet(f"{base}/src").select("time").withColumnRenamed("time", "timestamp")
    q = (live.enrich_stream(stream, solar.solar_latest(sol)).writeStream.format("memory").queryName("live_enrich_t")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("live_enrich_t").where(F.col("conditions").isNotNull()).count()
    assert got == sol.count()
