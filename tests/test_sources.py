"""Readers, quarantine and sinks."""

import datetime as dt

from pyspark.sql import functions as F

from skywave.session import scratch_path
from skywave.sources import readers, schemas, sinks


def test_csv_quarantine_and_conform(spark):
    base = scratch_path(spark, "test-csv")
    lines = ["1,2021-03-01 12:00:00,W1,FN42,-10,14097100,K1,DM79,23,0,1000,90,107,WSPR,2.0,0,17",
             "2,2021-03-01 12:02:00,W1\u0000\u0000,FN42,-12,14097100,K2,EN52,23,0,900,80,107,WSPR,2.0,0,17",
             "3,not-a-time,W1,FN42,xx,14097100,K3,DM79,23,0,1000,90,107,WSPR,2.0,0,17",
             "4,2021-03-01 12:04:00,W1,FN42,-9,14097100,K4,DM79,23,0,1000,90,107,2.0,0",     # 15 columns
             "5,2021-03-01 12:06:00,W1,FN42", "",
             "6,2021-03-01 12:08:00,W1,FN42,,14097100,K6,DM79,23,0,1000,90,107,WSPR,2.0,0,17"]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(base)
    good = {r.id: r for r in readers.load_wspr(spark, base, fmt="csv").collect()}
    assert sorted(good) == [1, 2, 4, 6]
    assert {r.reporter for r in good.values()} == {"W1"}                        # NUL padding stripped
    assert good[4].column_count == 15 and good[4].mode == "WSPR" and good[4].version == "2.0" and good[1].column_count == 17
    assert good[6].snr == 0                                                     # an empty field is the type's default
    bad = readers.quarantine(spark, base, schemas.WSPR_SPOT, readers.V1_ABSENT).collect()
    assert sorted((r.bad, r.columns) for r in bad) == [("columns", 4), ("value", 17)]


def test_write_fact_month_partitions_and_overwrite(spark):
    base = scratch_path(spark, "test-fact")
    rows = [(1, dt.datetime(2021, 1, 5), 107), (2, dt.datetime(2021, 2, 7), 105), (3, dt.datetime(2021, 2, 8), 107)]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp, band int")
    sinks.write_fact(df, base, sort_cols=["band", "timestamp"])
    back = spark.read.parquet(base)
    assert sorted(r.ym for r in back.select("ym").distinct().collect()) == [202101, 202102]
    # pruning: a window over February lists only that month
    feb = sinks.window_filter(back, ("2021-02-01", "2021-03-01"))
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and feb.count() == 2
    # a reload replaces the table; replace="partitions" only the partitions that the new rows have
    again = spark.createDataFrame([(9, dt.datetime(2021, 2, 9), 110)], "id long, timestamp timestamp, band int")
    for replace, expected in (("partitions", [1, 9]), ("table", [9])):
        out = scratch_path(spark, "test-overwrite")
        sinks.overwrite_table(sinks.with_month_partition(df), out, ["ym"])
        sinks.overwrite_table(sinks.with_month_partition(again), out, ["ym"], replace=replace)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == expected


def test_rbn_reader_renames_mode_and_fills_tx_mode(spark):
    base = scratch_path(spark, "test-rbn")
    raw = spark.createDataFrame([(dt.datetime(2010, 1, 1), "W1", "K1", 14025, 107, "CQ", 12, 22, None)],
                                "timestamp timestamp, de_call string, dx_call string, frequency long, band int, "
                                "mode string, snr int, speed int, tx_mode string")
    raw.write.parquet(base)
    r = readers.load_rbn(spark, base).collect()[0]
    assert r.spot_type == "CQ" and r.tx_mode == "" and r.de_pfx == ""


def test_quoted_csv_of_all_sources(spark):
    """Quoted fields, commas and doubled quotes inside them; bad lines go to the quarantine with a reason."""
    from skywave.session import scratch_path
    from skywave.sources import readers, schemas
    path = scratch_path(spark, "test-csv")
    good = ['2024-01-02 03:04:05,14025000,107,CW,K1ABC,DL1XYZ,599,"05, ""zone""",599,14,CQ-WW,cq-ww/2024',
            '"2024-01-02 03:04:06","14025000","107","PH","K1ABC","DL1XYZ","59","a,b,c","59","","CQ-WW","x"']
    bad = ["2024-01-02 03:04:05,14025000,107,CW,K1ABC", '2024-01-02 03:04:05,many,107,CW,K1ABC,DL1XYZ,599,"05, 06",599,14,CQ-WW,x']
    spark.createDataFrame([(x,) for x in [*good, *bad, "  "]], "value string").coalesce(1).write.text(path)
    got = readers.load_contest(spark, path, fmt="csv").orderBy("timestamp").collect()
    assert [(r.mode, r.exch_sent, r.exch_rcvd, r.frequency) for r in got] == [("CW", '05, "zone"', "14", 14025000), ("PH", "a,b,c", "", 14025000)]
    left = {r.value: (r.columns, r.bad) for r in readers.quarantine(spark, path, schemas.CONTEST_QSO).collect()}
    assert left == {bad[0]: (5, "columns"), bad[1]: (12, "value")}


def test_overwrite_with_fewer_partitions(spark):
    """Truncate and reload: partitions that the new rows don't have go; replacing keeps them."""
    from skywave.session import scratch_path
    from skywave.sources.sinks import overwrite_table
    path = scratch_path(spark, "test-overwrite-parts")
    rows = spark.range(90).selectExpr("id", "id % 3 as part")
    overwrite_table(rows, path, ["part"])
    overwrite_table(rows.where("part = 1").selectExpr("id + 1000 as id", "part"), path, ["part"], replace="partitions")
    assert sorted((r.part, r["count"]) for r in spark.read.parquet(path).groupBy("part").count().collect()) == [(0, 30), (1, 30), (2, 30)]
    overwrite_table(rows.where("part < 2"), path, ["part"])
    assert sorted((r.part, r["count"]) for r in spark.read.parquet(path).groupBy("part").count().collect()) == [(0, 30), (1, 30)]


def test_lines_are_parsed_once_with_or_without_quotes(spark):
    """A line gives the same row bare and with every field quoted, and the plan parses it once."""
    lines = ["1,2021-03-01 12:00:00,W1\0\0, FN42 ,-10, 14097100 ,K1,,23,0,1000,90,107,WSPR,2.0,0,17",
             "2,2021-03-01 12:02:00,\0,FN42,,14097100,K2,EN52,23,,900,80,107,,2.0,0,15",
             "3,2021-03-01 12:04:00,W1,FN42,-9,14097100,K4,DM79,23,0,1000,90,107,2.0,0",          # 15 columns
             "4,never,W1,FN42,-9,14097100,K4,DM79,23,0,1000,90,107,2.0,0",
             "5,2021-03-01 12:04:00,W1,FN42,x7,14097100,K4,DM79,23,0,1000,90,107,WSPR,2.0,0,17",
             "6,2021-03-01 12:06:00,W1", ",,,,,,,,,,,,,,,,", "7" + "," * 17]
    got = []
    for each in (lines, [",".join(f'"{x}"' for x in line.split(",")) for line in lines]):
        path = scratch_path(spark, "test-once")
        spark.createDataFrame([(x,) for x in each], "value string").coalesce(1).write.text(path)
        rows, bad = readers.load_wspr(spark, path, fmt="csv"), readers.quarantine(spark, path, schemas.WSPR_SPOT, readers.V1_ABSENT)
        got.append((sorted(map(str, rows.collect())), sorted((r.value.replace('"', ""), r.columns, r.bad) for r in bad.collect())))
        for df in (rows, bad):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("from_csv(") <= 2                                     # a 17-column and a 15-column line's
    assert got[0] == got[1]
    assert len(got[0][0]) == 4 and [b for _, _, b in sorted(got[0][1])] == ["value", "value", "columns", "columns"]


def test_overwrite_query_with_large_ids(spark):
    """Bands whose ids add up to more than a BIGINT don't end the query."""
    from skywave.plans.registry import all_queries
    sf = scratch_path(spark, "test-large-ids")
    day = dt.datetime(1998, 5, 1)
    rows = [(60_000_000_000, 0, 0, 1, 30.0, 100.0, day), (60_000_000_000, 0, 0, 2, 31.0, 100.0, day), (60_000_000_000, 1, 0, 1, 32.0, 100.0, day)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{sf}/lineitem.parquet")
    spark.createDataFrame([(9, dt.datetime(2024, 1, 1), 1, "view", 5.0)], "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{sf}/events.parquet")
    got = {r.band: (r.rows, r.sum_snr, r.sum_id) for r in all_queries()["overwrite_table"](spark, sf).collect()}
    assert got == {102: (2, -9, None), 103: (1, -3, 6_000_000_000_000_010_001)}


def test_bronze_moves_source_rows(spark, monkeypatch):
    """Spots and solar rows are shuffled and sorted as the few numbers they are made of; the stored rows are all rows."""
    from skywave.sources import fixtures as fx
    sf = scratch_path(spark, "test-bronze")
    n = spark.range(200)
    n.selectExpr("id div 7 as l_orderkey", "id % 13 as l_partkey", "id % 5 as l_suppkey", "int(id % 7) as l_linenumber", "double(id % 50) as l_quantity",
                 "id * 997.5 as l_extendedprice", "timestamp'1998-01-30' + make_dt_interval(int(id % 60)) as l_shipdate").withColumn("l_extendedprice", F.col("l_extendedprice").cast("double")).write.parquet(f"{sf}/lineitem.parquet")
    n.selectExpr("id as event_id", "timestamp'2024-01-30' + make_dt_interval(int(id % 4)) as ts", "id % 31 as user_id", "'view' as event_type", "double(id % 90) as value").write.parquet(f"{sf}/events.parquet")
    n.selectExpr("id as o_orderkey", "id % 9 as o_custkey", "'F' as o_orderstatus", "double(id * 31.5) as o_totalprice", "timestamp'1998-01-30' + make_dt_interval(int(id % 60)) as o_orderdate").write.parquet(f"{sf}/orders.parquet")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    stored = {k: sorted(map(str, getattr(fx, k)(spark, sf).drop("ym").collect())) for k in ("spots", "solar_raw")}
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == size
    monkeypatch.setattr(fx, "MATERIALIZE", False)
    for k, rows in stored.items():
        assert rows == sorted(map(str, getattr(fx, k)(spark, sf).collect()))
    for k in ("spots", "solar"):
        parts, by_month, cluster = fx._BRONZE_LAYOUT[k]
        for source, columns in parts:
            made = fx._clustered(fx.table(spark, sf, source), fx._typed(columns(), fx.build_schema(k)), by_month, cluster)
            above, below = made._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
            assert "concat(" in above and "concat(" not in below and "Sort [" in above
