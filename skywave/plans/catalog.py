"""Registered queries over the driver tables (see FIXTURES.md for the mapping).

Every query reads the whole driver tables through ``skywave.sources.fixtures``
and runs the library operators on them; the matching DuckDB SQL lives in
``skywave.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave import constants as K
from skywave import functions
from skywave.operators import callsigns, features, flags, intervals, reports, sampling, signatures, solar, tables, validation
from skywave.plans.registry import register
from skywave.sources import fixtures as fx

# The fixture timeline (1995-2001) predates the reference's source windows
# (contest 2005+, RBN 2009+, gold 2020+); windows are parameters, and the
# registered queries pass one that covers the fixture timeline.
FIXTURE_WINDOW = ("1990-01-01", "2030-01-01")


# ---------------------------------------------------------------- signatures
@register("signatures_v1_raw")
def signatures_v1_raw(spark: SparkSession, sf: str) -> DataFrame:
    """v1 with the source's literal solar join: a spot counts once per reading of its bucket."""
    return signatures.wspr_signatures(fx.spots(spark, sf), fx.solar_raw(spark, sf), solar_mode="raw")


@register("signatures_v1")
def signatures_v1(spark: SparkSession, sf: str) -> DataFrame:
    return signatures.wspr_signatures(fx.spots(spark, sf), fx.solar_raw(spark, sf))


def _spots(spark, sf):
    return fx.spots(spark, sf)


def _cg(spark, sf):
    return callsigns.callsign_grid(_spots(spark, sf))


def _chain(spark, sf):
    """The flagging chain's shared inputs: bronze, its station-day summary
    (AQE reuses its exchange), the callsign dimension derived from it."""
    s = _spots(spark, sf)
    summary = callsigns.station_days(s)
    return s, summary, callsigns.callsign_grid(summary=summary)


def _flags(spark, sf):
    s, summary, cg = _chain(spark, sf)
    return flags.balloon_flags_v2(s, cg, summary=summary)


def _contest_sig(spark, sf, cg=None):
    cg = _cg(spark, sf) if cg is None else cg
    return signatures.contest_signatures(fx.contest_raw(spark, sf), cg, fx.solar_raw(spark, sf), window=FIXTURE_WINDOW)


def _rbn_sig(spark, sf, cg=None):
    cg = _cg(spark, sf) if cg is None else cg
    return signatures.rbn_signatures(fx.rbn_raw(spark, sf), cg, fx.solar_raw(spark, sf), window=FIXTURE_WINDOW)


def _v2(spark, sf, chain=None):
    s, summary, cg = _chain(spark, sf) if chain is None else chain
    return signatures.wspr_signatures_v2(s, fx.solar_raw(spark, sf), flags.balloon_flags_v2(s, cg, summary=summary))


def _union(spark, sf):
    chain = _chain(spark, sf)
    cg = chain[2]
    return signatures.union_signatures(wspr=_v2(spark, sf, (chain[0], chain[1], cg)), contest=_contest_sig(spark, sf, cg),
                                       rbn=_rbn_sig(spark, sf, cg))


# ---------------------------------------------------------------- scans
def _schema_cols(df, schema):
    return df.select(*[f.name for f in schema.fields])


@register("scan_spots")
def scan_spots(spark, sf):
    from skywave.sources.schemas import WSPR_SPOT
    return _schema_cols(_spots(spark, sf), WSPR_SPOT)


def _quoted_csv(spark, df, schema, name):
    """A source's rows as raw CSV files, every field in quotes."""
    from skywave.session import scratch_path
    path = scratch_path(spark, f"raw-{name}")
    fields = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])
    df.select(F.to_csv(fields, {"quoteAll": "true", "escape": '"'})).write.option("compression", "gzip").text(path)
    return path


@register("scan_rbn")
def scan_rbn(spark, sf):
    """RBN spots through the raw-file reader."""
    from skywave.sources import readers, schemas
    return readers.load_rbn(spark, _quoted_csv(spark, fx.rbn_raw(spark, sf), schemas.RBN_SPOT, "rbn"), fmt="csv")


@register("scan_contest")
def scan_contest(spark, sf):
    """Contest QSOs through the raw-file reader."""
    from skywave.sources import readers, schemas
    return readers.load_contest(spark, _quoted_csv(spark, fx.contest_raw(spark, sf), schemas.CONTEST_QSO, "contest"), fmt="csv")


@register("scan_solar")
def scan_solar(spark, sf):
    """Solar readings through the raw-file reader."""
    from skywave.sources import readers, schemas
    return readers.load_solar(spark, _quoted_csv(spark, fx.solar_raw(spark, sf), schemas.SOLAR, "solar"), fmt="csv")


def _modes(spark, sf):
    return (fx.pskr_spots(spark, sf).select("mode")
            .unionByName(fx.rbn_raw(spark, sf).select(F.col("tx_mode").alias("mode")))
            .unionByName(fx.contest_raw(spark, sf).select("mode")))


@register("mode_thresholds")
def mode_thresholds(spark, sf):
    """The seeded threshold table resolved for every mode observed in the
    PSK Reporter, RBN and contest data."""
    return validation.observed_mode_thresholds(_modes(spark, sf), validation.seed_mode_thresholds(spark))


@register("threshold_usage")
def threshold_usage(spark, sf):
    """All 15 thresholds with the observations of their mode in the three sources."""
    return validation.threshold_usage(_modes(spark, sf), validation.seed_mode_thresholds(spark))


@register("schema_upgrade")
def schema_upgrade(spark, sf):
    """Legacy (v1, 15-column) bronze rows upgraded to v2: mode/column_count
    added with their defaults; counted per (mode, column_count)."""
    legacy = _spots(spark, sf).drop("mode", "column_count", "ym").withColumn("band", F.col("band").cast("short"))
    up = tables.upgrade_v1_to_v2(legacy)
    return up.groupBy("mode", "column_count").agg(F.count(F.lit(1)).alias("rows"), F.sum("band").alias("band_sum"))


# ---------------------------------------------------------------- predicates / grid functions
@register("clean_callsign")
def clean_callsign(spark, sf):
    s = _spots(spark, sf)
    padded = s.select(F.rpad("callsign", 16, "\u0000").alias("c")).unionByName(
        s.select(F.rpad("reporter", 16, "\u0000").alias("c")))
    return padded.select(functions.clean_fixed("c").alias("callsign")).groupBy("callsign").agg(
        F.count(F.lit(1)).alias("rows")).withColumn("length", F.length("callsign"))


def _all_grids(spark, sf):
    s = _spots(spark, sf)
    return s.select(F.col("grid").alias("g")).unionByName(s.select(F.col("reporter_grid").alias("g"))).unionByName(
        fx.pskr_spots(spark, sf).select(F.col("sender_grid").alias("g"))).distinct()


@register("valid_grid_filter")
def valid_grid_filter(spark, sf):
    g = _all_grids(spark, sf)
    return g.select(F.col("g").alias("grid"), functions.has_valid_field("g").cast("int").alias("valid_field"))


@register("grid_validation")
def grid_validation(spark, sf):
    g = _all_grids(spark, sf)
    return g.select(F.col("g").alias("grid"), F.length("g").alias("grid_length"),
                    functions.is_valid_locator("g").cast("int").alias("is_valid_format"),
                    functions.has_valid_field("g").cast("int").alias("valid_field"))


@register("grid_centroids")
def grid_centroids(spark, sf):
    g = _all_grids(spark, sf).where(functions.is_valid_locator("g"))
    p = functions.maidenhead_point("g", 8)
    return g.select(F.col("g").alias("grid"), functions.maidenhead_lat("g").alias("lat4"),
                    functions.maidenhead_lon("g").alias("lon4"), p["lat"].alias("lat"), p["lon"].alias("lon"))


@register("path_geometry")
def path_geometry(spark, sf):
    s = _spots(spark, sf).where(functions.has_valid_field("grid") & functions.has_valid_field("reporter_grid"))
    pairs = s.select(functions.grid4("grid").alias("tx_grid_4"), functions.grid4("reporter_grid").alias("rx_grid_4")).distinct()
    tlon, tlat = functions.maidenhead_lon("tx_grid_4"), functions.maidenhead_lat("tx_grid_4")
    rlon, rlat = functions.maidenhead_lon("rx_grid_4"), functions.maidenhead_lat("rx_grid_4")
    return pairs.select("tx_grid_4", "rx_grid_4", functions.great_circle_km(tlon, tlat, rlon, rlat).alias("distance_km"),
                        functions.azimuth_deg(tlon, tlat, rlon, rlat).alias("azimuth_deg"))


@register("freq_to_band")
def freq_to_band(spark, sf):
    p = fx.pskr_spots(spark, sf)
    return p.groupBy("band", functions.freq_to_band("frequency", "hz").alias("resolved_band")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("freq_to_band_edges")
def freq_to_band_edges(spark, sf):
    """The band lookup by an edge table of any size, as an interval join."""
    from skywave.functions.bands import band_edges_df
    p = intervals.lookup_band(fx.pskr_spots(spark, sf).select("band", "frequency"), band_edges_df(spark))
    return p.groupBy("band", "resolved_band").agg(F.count(F.lit(1)).alias("rows"))


@register("training_filter")
def training_filter_q(spark, sf):
    return sampling.training_filter(_spots(spark, sf), FIXTURE_WINDOW).groupBy("band").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- monitoring
@register("data_integrity")
def data_integrity(spark, sf):
    return reports.data_integrity(_spots(spark, sf))


@register("spots_daily")
def spots_daily(spark, sf):
    return reports.spots_daily(_spots(spark, sf))


# ---------------------------------------------------------------- solar
@register("solar_daily")
def solar_daily(spark, sf):
    return solar.solar_daily(fx.solar_raw(spark, sf))


@register("solar_buckets")
def solar_buckets(spark, sf):
    return solar.solar_buckets(fx.solar_raw(spark, sf), "max")


@register("latest_by_key")
def latest_by_key_q(spark, sf):
    return solar.solar_latest(fx.solar_raw(spark, sf))


@register("solar_join_raw")
def solar_join_raw(spark, sf):
    return solar.join_solar_raw(_spots(spark, sf).select("id", "timestamp"), fx.solar_raw(spark, sf))


@register("solar_join_bucketed")
def solar_join_bucketed(spark, sf):
    return solar.join_solar_bucketed(_spots(spark, sf).select("id", "timestamp"), fx.solar_raw(spark, sf), how="inner")


@register("solar_coverage")
def solar_coverage(spark, sf):
    return solar.solar_coverage_start(fx.solar_raw(spark, sf))


# ---------------------------------------------------------------- callsigns and flags
@register("callsign_grid")
def callsign_grid(spark, sf):
    return _cg(spark, sf)


@register("callsign_grid_report")
def callsign_grid_report(spark, sf):
    return callsigns.callsign_grid_report(_cg(spark, sf))


@register("velocity_day")
def velocity_day(spark, sf):
    return flags.velocity_day(_spots(spark, sf))


@register("type2_telemetry")
def type2_telemetry(spark, sf):
    s, summary, cg = _chain(spark, sf)
    return flags.type2_telemetry(s, cg, flagged=flags.velocity_day(None, summary=summary), summary=summary)


@register("balloon_flags_v2")
def balloon_flags_v2(spark, sf):
    return _flags(spark, sf)


@register("flag_summary")
def flag_summary(spark, sf):
    s, summary, cg = _chain(spark, sf)
    return flags.flag_summary(flags.balloon_flags_v2(s, cg, summary=summary), s)


@register("exclude_type2")
def exclude_type2(spark, sf):
    """Spots left per band after removing type-2 telemetry TX and RX."""
    s, summary, cg = _chain(spark, sf)
    f = flags.balloon_flags_v2(s, cg, summary=summary).where(F.col("flag_reason") == "type2_telemetry")
    return signatures.exclude_flagged(s, f).groupBy("band").agg(F.count(F.lit(1)).alias("rows"))


@register("exclude_velocity_day")
def exclude_velocity_day(spark, sf):
    """Spots left per band after removing (TX callsign, day) flight days."""
    s = _spots(spark, sf)
    f = flags.velocity_day(s)
    return signatures.exclude_flagged(s, f).groupBy("band").agg(F.count(F.lit(1)).alias("rows"))


@register("mobility_tier")
def mobility_tier(spark, sf):
    return flags.mobility_profile(_spots(spark, sf))


@register("velocity_tier_v1")
def velocity_tier_v1(spark, sf):
    return flags.velocity_tier_v1(_spots(spark, sf))


@register("type2_telemetry_v1")
def type2_telemetry_v1(spark, sf):
    s = _spots(spark, sf)
    return flags.type2_telemetry_v1(s, callsigns.callsign_grid(s), flagged=flags.velocity_tier_v1(s))


@register("reserved_prefix_v1")
def reserved_prefix_v1(spark, sf):
    """Reserved-prefix step checked against the callsign dimension and the
    velocity-tier flags only (in the full v1 chain every reserved callsign is
    already caught as type-2; see balloon_flags_v1)."""
    s = _spots(spark, sf)
    return flags.reserved_prefix_v1(s, callsigns.callsign_grid(s), flagged=flags.velocity_tier_v1(s))


@register("balloon_flags_v1")
def balloon_flags_v1(spark, sf):
    s = _spots(spark, sf)
    return flags.balloon_flags_v1(s, callsigns.callsign_grid(s))


# ---------------------------------------------------------------- signatures
@register("signatures_v2")
def signatures_v2(spark, sf):
    return _v2(spark, sf)


@register("signature_delta")
def signature_delta(spark, sf):
    return signatures.signature_delta(signatures_v1(spark, sf), _v2(spark, sf))


@register("enrich_endpoints")
def enrich_endpoints(spark, sf):
    q = fx.contest_raw(spark, sf).select("timestamp", "band", "mode", "call_1", "call_2")
    return callsigns.enrich_endpoints(q, _cg(spark, sf), "call_1", "call_2")


@register("endpoint_resolution")
def endpoint_resolution(spark, sf):
    return callsigns.endpoint_resolution(fx.rbn_raw(spark, sf), _cg(spark, sf), "dx_call", "de_call", by=["band"])


@register("contest_signatures")
def contest_signatures(spark, sf):
    return _contest_sig(spark, sf)


@register("rbn_signatures")
def rbn_signatures(spark, sf):
    return _rbn_sig(spark, sf)


@register("anchor_counts")
def anchor_counts(spark, sf):
    return signatures.anchor_counts(_contest_sig(spark, sf))


@register("signature_report")
def signature_report(spark, sf):
    return signatures.signature_report(_rbn_sig(spark, sf))


@register("snr_distribution")
def snr_distribution(spark, sf):
    return signatures.snr_distribution(_rbn_sig(spark, sf))


@register("coverage_metrics")
def coverage_metrics(spark, sf):
    return signatures.coverage_metrics(_rbn_sig(spark, sf))


@register("signature_union")
def signature_union(spark, sf):
    return _union(spark, sf)


@register("rows_by_band")
def rows_by_band(spark, sf):
    u = _union(spark, sf)
    return u.groupBy("source", "band").agg(F.count(F.lit(1)).alias("rows"))


@register("dxpedition_paths")
def dxpedition_paths(spark, sf):
    return signatures.dxpedition_paths(fx.rbn_raw(spark, sf), fx.dxpedition_catalog(spark, sf), _cg(spark, sf))


@register("dxpedition_paths_binned")
def dxpedition_paths_binned(spark, sf):
    """The same paths by callsign and time cell."""
    return signatures.dxpedition_paths(fx.rbn_raw(spark, sf), fx.dxpedition_catalog(spark, sf), _cg(spark, sf), cell_days=2)


@register("dxpedition_signatures")
def dxpedition_signatures(spark, sf):
    windows = signatures.merge_windows(fx.dxpedition_catalog(spark, sf))
    p = signatures.dxpedition_paths(fx.rbn_raw(spark, sf), windows, _cg(spark, sf), spread=signatures.signature_spread())
    return signatures.dxpedition_signatures(p, fx.solar_raw(spark, sf), min_spots=1, replicate=2)


# ---------------------------------------------------------------- sampling / gold
# Fixture-sized sample parameters (the reference's 200K/1M/10M per cell/band
# exceed the fixture tables, which would make every sample "all rows").
FIX_PER_CELL = 20
FIX_PER_BAND = 200
FIX_DENSITY_LIMIT = 2000
FIX_HASH_N = 1000


def _density(spark, sf):
    return sampling.ifw_density(_spots(spark, sf), fx.solar_raw(spark, sf), sample_limit=FIX_DENSITY_LIMIT,
                                window=FIXTURE_WINDOW)


def _continuous(spark, sf):
    return sampling.gold_continuous(_spots(spark, sf), fx.solar_raw(spark, sf), _density(spark, sf),
                                    per_band=FIX_PER_BAND, window=FIXTURE_WINDOW)


@register("hash_sample")
def hash_sample(spark, sf):
    s = _spots(spark, sf)
    return sampling.hash_sample(s, FIX_HASH_N, sampling.sample_key_cols()).select("id", "band", "hash_u32")


@register("gold_stratified")
def gold_stratified(spark, sf):
    return sampling.gold_stratified(_spots(spark, sf), fx.solar_raw(spark, sf), per_cell=FIX_PER_CELL, window=FIXTURE_WINDOW)


@register("ifw_density")
def ifw_density(spark, sf):
    return _density(spark, sf)


@register("density_stats")
def density_stats(spark, sf):
    return sampling.density_stats(_density(spark, sf))


@register("gold_continuous")
def gold_continuous(spark, sf):
    return _continuous(spark, sf)


@register("gold_v6")
def gold_v6(spark, sf):
    return sampling.gold_v6(_continuous(spark, sf))


@register("ssn_quintile_bounds")
def ssn_quintile_bounds(spark, sf):
    return sampling.ssn_quintile_bounds(_spots(spark, sf), fx.solar_raw(spark, sf), window=FIXTURE_WINDOW)


FIX_QT_MIN_SPOTS = 8
FIX_QT_PER_BAND = 40


def _qt_paths(spark, sf):
    return sampling.quality_test_paths(signatures_v1(spark, sf), per_band=FIX_QT_PER_BAND, min_spots=FIX_QT_MIN_SPOTS)


@register("quality_test_paths")
def quality_test_paths(spark, sf):
    return _qt_paths(spark, sf)


# ---------------------------------------------------------------- validation
def _scored(spark, sf, profile="wspr"):
    pred = fx.predictions(signatures_v1(spark, sf))
    return validation.score_paths(pred, validation.seed_mode_thresholds(spark), profile=profile)


SCORE_COLUMNS = ["source", "tx_grid_4", "rx_grid_4", "band", "hour", "month", "actual_snr", "actual_mode", "predicted_snr", "snr_error",
                 "ft8_viable", "cw_viable", "rtty_viable", "ssb_viable", "mode_hit", "profile"]


@register("score_paths")
def score_paths(spark, sf):
    return _scored(spark, sf).select(*SCORE_COLUMNS)


@register("score_paths_portable")
def score_paths_portable(spark, sf):
    """The same paths for a 5 W station: 14 dB over the reference."""
    return _scored(spark, sf, "portable").select(*SCORE_COLUMNS)


@register("model_metrics")
def model_metrics(spark, sf):
    return validation.model_metrics(_scored(spark, sf), ["source", "band"])


METRIC_SETS = [("source", "band", "hour"), ("source", "band"), ("source", "hour"), ("band",), ()]


@register("model_metrics_sets")
def model_metrics_sets(spark, sf):
    """Metrics over five sets of dimensions from one pass."""
    return validation.model_metrics_sets(_scored(spark, sf), METRIC_SETS)


@register("band_hour_heatmap")
def band_hour_heatmap(spark, sf):
    return validation.band_hour_heatmap(_scored(spark, sf))


@register("quality_test_summary")
def quality_test_summary(spark, sf):
    return validation.quality_test_summary(quality_test_metrics(spark, sf))


@register("quality_test_metrics")
def quality_test_metrics(spark, sf):
    paths = _qt_paths(spark, sf)
    preds = paths.select("path_id", (F.col("median_snr") + ((F.col("band") * 7 + F.col("hour") * 3) % 11 - 5)).alias("model_snr"),
                         ((F.col("path_id") * 13) % 40 - 20).cast("double").alias("voacap_snr"))
    return validation.quality_test_metrics(paths, preds)


@register("step_i_compare")
def step_i_compare(spark, sf):
    p = fx.step_i_paths(fx.spots(spark, sf))
    return validation.step_i_compare(p.drop("voacap_band_open"), p.select(
        "tx_lat", "tx_lon", "rx_lat", "rx_lon", "freq_mhz", "year", "month", "hour_utc", "voacap_band_open"))


# ---------------------------------------------------------------- versions, config, ingest log
@register("latest_versions")
def latest_versions(spark, sf):
    return reports.latest_versions(fx.lab_versions(spark, sf))


@register("recent_versions")
def recent_versions(spark, sf):
    return reports.recent_versions(fx.lab_versions(spark, sf), 10)


@register("latest_config")
def latest_config(spark, sf):
    return reports.latest_config(fx.config_table(spark, sf))


@register("pending_files_reload")
def pending_files_reload(spark, sf):
    """Primed entries and files that have grown are loaded again."""
    return reports.pending_files(fx.file_listing(spark, sf), fx.ingest_log(spark, sf), reload_primed=True, reload_grown=True)


@register("pending_files")
def pending_files(spark, sf):
    return reports.pending_files(fx.file_listing(spark, sf), fx.ingest_log(spark, sf))


# ---------------------------------------------------------------- contracts and gates
@register("conformance_report")
def conformance_report(spark, sf):
    from skywave.sources.schemas import WSPR_CONTRACT
    return tables.conformance_report(_spots(spark, sf), WSPR_CONTRACT)


@register("width_check")
def width_check(spark, sf):
    return tables.width_check(_spots(spark, sf), ["reporter", "reporter_grid", "callsign", "grid", "mode", "version"])


FIX_GATES = {"callsign_grid": 50, "balloon_flags_v2": 40, "spots": 1000}


@register("row_gates")
def row_gates(spark, sf):
    s, summary, cg = _chain(spark, sf)
    return tables.row_gates({"callsign_grid": (cg, FIX_GATES["callsign_grid"]),
                             "balloon_flags_v2": (flags.balloon_flags_v2(s, cg, summary=summary), FIX_GATES["balloon_flags_v2"]),
                             "spots": (s, FIX_GATES["spots"])})


@register("table_inventory")
def table_inventory(spark, sf):
    from skywave.sources import schemas as S
    s = _spots(spark, sf)
    return tables.table_inventory({
        "wspr.bronze": _schema_cols(s, S.WSPR_SPOT), "solar.bronze": fx.solar_raw(spark, sf),
        "rbn.bronze": _schema_cols(fx.rbn_raw(spark, sf), S.RBN_SPOT),
        "contest.bronze": _schema_cols(fx.contest_raw(spark, sf), S.CONTEST_QSO),
        "wspr.callsign_grid": callsigns.callsign_grid(s), "pskr.bronze": _schema_cols(fx.pskr_spots(spark, sf), S.PSKR_SPOT),
        "validation.model_results": None})


# ---------------------------------------------------------------- features, quality, live state
@register("signature_features")
def signature_features(spark, sf):
    return features.signature_features(signatures_v1(spark, sf))


@register("quality_distribution")
def quality_distribution(spark, sf):
    return features.quality_distribution(fx.silver(spark, sf))


@register("live_conditions")
def live_conditions(spark, sf):
    return features.live_conditions(solar.solar_latest(fx.solar_raw(spark, sf)))


@register("live_enrich")
def live_enrich(spark, sf):
    cond = features.conditions_by_bucket(solar.solar_latest(fx.solar_raw(spark, sf)))
    p = fx.pskr_spots(spark, sf).select("timestamp", "sender_call", "receiver_call", "band", "snr")
    return features.enrich_with_conditions(p, cond)


# ---------------------------------------------------------------- raw files
def _raw_spots(spark, sf):
    from skywave.session import scratch_path
    path = scratch_path(spark, "raw-spots")
    fx.raw_spot_lines(spark, sf).write.text(path)
    return path


@register("scan_spots_csv")
def scan_spots_csv(spark, sf):
    """Spots through the raw-file reader: padding stripped, older lines conformed, bad lines left out."""
    from skywave.sources import readers
    return readers.load_wspr(spark, _raw_spots(spark, sf), fmt="csv")


@register("scan_quarantine")
def scan_quarantine(spark, sf):
    """The lines that the reader leaves out, by reason and number of columns."""
    from skywave.sources import readers, schemas
    bad = readers.quarantine(spark, _raw_spots(spark, sf), schemas.WSPR_SPOT, readers.V1_ABSENT)
    return bad.groupBy("bad", "columns").agg(F.count(F.lit(1)).alias("lines"))


# ---------------------------------------------------------------- streaming (each equals its batch twin)
def _stream_dirs(spark, name):
    from skywave.session import scratch_path
    base = scratch_path(spark, name)
    return {k: f"{base}/{k}" for k in ("src", "out", "log", "ckpt")}


def _pskr_rows(spark, sf):
    from skywave.sources.schemas import PSKR_SPOT
    return _schema_cols(fx.pskr_spots(spark, sf), PSKR_SPOT)


@register("pskr_ingest")
def pskr_ingest(spark, sf):
    """PSK Reporter spots written as gzip JSONL files, ingested by the file
    stream (availableNow) into bronze."""
    from skywave.streaming import ingest
    d = _stream_dirs(spark, "pskr-ingest")
    ingest.write_jsonl_gz(_pskr_rows(spark, sf), d["src"], files=4)
    ingest.ingest_pskr(spark, d["src"], d["out"], d["log"], d["ckpt"])
    return ingest.read_bronze(spark, d["out"])


@register("pskr_reload")
def pskr_reload(spark, sf):
    """Five collector files loaded; then one has grown and one has shrunk under its
    name, and the next load replaces their rows: the last contents of all files."""
    from skywave.streaming import loads
    d = _stream_dirs(spark, "pskr-reload")
    rows = _pskr_rows(spark, sf)
    file = F.pmod(F.xxhash64("sender_call", "receiver_call", "timestamp"), F.lit(5))
    named = rows.withColumn("__f", file).withColumn("file", F.concat(F.lit("spots-"), F.col("__f")))
    half = F.pmod(F.xxhash64("receiver_call", "timestamp"), F.lit(2)) == 0
    first = named.where((F.col("__f") != 0) | half).unionByName(named.where((F.col("__f") == 1) & half).withColumn("snr", F.lit(99).cast(rows.schema["snr"].dataType)))
    loads.write_named_files(first.drop("__f"), d["src"])
    loads.load_pending(spark, d["src"], d["out"], d["log"])
    loads.write_named_files(named.where("__f < 2").drop("__f"), d["src"])
    loads.load_pending(spark, d["src"], d["out"], d["log"])
    return loads.read_current(spark, d["out"], d["log"])


@register("signatures_incremental")
def signatures_incremental(spark, sf):
    """Signatures v1 kept by months: all months but the last two, then one by one, the
    last one replayed; each step reads the spots of its own months only."""
    from skywave.operators import incremental
    from skywave.session import scratch_path
    from skywave.sources.sinks import window_filter
    s, solar_rows = fx.spots(spark, sf), fx.solar_raw(spark, sf)
    path = scratch_path(spark, "signature-partials")
    last = s.agg(F.date_trunc("month", F.max("timestamp")).alias("m")).select(
        *[F.date_format(F.add_months("m", i), "yyyy-MM-dd").alias(f"m{i + 1}") for i in (-1, 0, 1)]).first()
    for window in (("1900-01-01", last.m0), (last.m0, last.m1), (last.m1, last.m2), (last.m1, last.m2)):
        incremental.add_months(window_filter(s, window), solar_rows, path)
    return incremental.signatures_of(spark.read.parquet(path))


@register("callsign_grid_incremental")
def callsign_grid_incremental(spark, sf):
    """The callsign dimension kept by days: older days, then the last month's, replayed."""
    from skywave.operators import incremental
    from skywave.session import scratch_path
    from skywave.sources.sinks import window_filter
    s = fx.spots(spark, sf)
    path = scratch_path(spark, "station-days")
    last = s.agg(F.date_format(F.date_trunc("month", F.max("timestamp")), "yyyy-MM-dd").alias("m")).first().m
    for load, window in enumerate([("1900-01-01", last), (last, "2100-01-01"), (last, "2100-01-01")]):
        incremental.add_days(window_filter(s, window), path, load)
    return callsigns.callsign_grid(summary=incremental.station_days_of(spark, path))


@register("stream_ingest_log")
def stream_ingest_log(spark, sf):
    """The ingest log of the stream: files whose log entry differs from what
    they hold (none), and the rows loaded."""
    from skywave.streaming import ingest
    d = _stream_dirs(spark, "pskr-log")
    ingest.write_jsonl_gz(_pskr_rows(spark, sf), d["src"], files=4)
    ingest.ingest_pskr(spark, d["src"], d["out"], d["log"], d["ckpt"])
    listed = ingest.source_files(spark, d["src"])
    log = ingest.read_log(spark, d["log"])
    missing = reports.pending_files(listed, log).agg(F.count(F.lit(1)).alias("pending"))
    return log.agg(F.sum("row_count").alias("rows"), F.count_if(F.col("file_size") <= 0).alias("without_size")).crossJoin(missing)


def _stream_quality(spark, sf, newest_first):
    from skywave.sources.schemas import SILVER
    from skywave.streaming import ingest, rollups
    d = _stream_dirs(spark, "quality")
    ingest.write_files(_schema_cols(fx.silver(spark, sf), SILVER), d["src"], files=4, fmt="parquet", newest_first=newest_first)
    rollups.run_quality_rollup(spark, d["src"], SILVER, d["out"], d["ckpt"], max_files_per_trigger=4)
    return rollups.read_quality_rollup(spark, d["out"])


@register("stream_quality")
def stream_quality(spark, sf):
    """Hourly quality rollup maintained by a stream over silver files."""
    return _stream_quality(spark, sf, newest_first=False)


@register("stream_quality_late")
def stream_quality_late(spark, sf):
    """The same with the newest files first: nothing is too late."""
    return _stream_quality(spark, sf, newest_first=True)


@register("stream_quality_compacted")
def stream_quality_compacted(spark, sf):
    """The rollup over 50 batches of a file each, compacted by the stream after every
    ten: the result is read from one set and the batches after it."""
    from skywave.sources.schemas import SILVER
    from skywave.streaming import rollups
    d = _stream_dirs(spark, "quality-compacted")
    silver = _schema_cols(fx.silver(spark, sf), SILVER)
    silver.repartition(50, F.xxhash64(*silver.columns)).write.parquet(d["src"])
    rollups.run_quality_rollup(spark, d["src"], SILVER, d["out"], d["ckpt"], max_files_per_trigger=1, compact_every=10)
    return rollups.read_quality_rollup(spark, d["out"])


def _stream_daily(spark, sf, newest_first, sketches=False):
    from skywave.sources.schemas import WSPR_SPOT
    from skywave.streaming import ingest, rollups
    d = _stream_dirs(spark, "spots-daily")
    ingest.write_files(_schema_cols(fx.spots(spark, sf), WSPR_SPOT), d["src"], files=4, fmt="parquet", newest_first=newest_first)
    rollups.run_spots_daily(spark, d["src"], d["out"], d["ckpt"], max_files_per_trigger=8, sketches=sketches)
    return rollups.read_spots_daily(spark, d["out"], sketches)


@register("stream_spots_daily")
def stream_spots_daily(spark, sf):
    """Daily spots, exact distinct stations and longest path kept by a stream."""
    return _stream_daily(spark, sf, newest_first=False)


@register("stream_spots_daily_late")
def stream_spots_daily_late(spark, sf):
    return _stream_daily(spark, sf, newest_first=True)


@register("stream_spots_daily_sketch")
def stream_spots_daily_sketch(spark, sf):
    """Daily spots with sketched distinct stations: counts, and whether each estimate is
    within 8 % (five standard errors) of the exact count."""
    got = _stream_daily(spark, sf, newest_first=True, sketches=True)
    exact = reports.spots_daily(fx.spots(spark, sf)).select("day", "band", "mode", F.col("unique_tx").alias("tx"), F.col("unique_rx").alias("rx"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.08 * F.col(b)
    return got.join(exact, ["day", "band", "mode"]).select(
        "day", "band", "mode", "spot_count", "avg_snr", "max_distance", near("unique_tx", "tx").alias("tx_near"), near("unique_rx", "rx").alias("rx_near"))


@register("overwrite_table")
def overwrite_table(spark, sf):
    """A table by band, reloaded with fewer bands, then one band replaced beside the others.

    ids are summed as decimals: the sum of a band's 15-digit ids soon passes 2**63.
    sum_id is a BIGINT, so it is NULL where no BIGINT is the sum."""
    from skywave.session import scratch_path
    from skywave.sources.sinks import overwrite_table as overwrite
    path = scratch_path(spark, "overwrite")
    s = _spots(spark, sf).select("id", "snr", "band")
    overwrite(s, path, ["band"])
    overwrite(s.where("band < 108"), path, ["band"])
    overwrite(s.where("band = 105 and snr > -10"), path, ["band"], replace="partitions")
    return spark.read.parquet(path).groupBy("band").agg(F.count(F.lit(1)).alias("rows"), F.sum("snr").alias("sum_snr"),
                                                         F.sum(F.col("id").cast("decimal(38,0)")).try_cast("bigint").alias("sum_id"))


@register("stream_live_conditions")
def stream_live_conditions(spark, sf):
    """The live snapshot of a stream that meets its oldest readings last."""
    from skywave.sources.schemas import SOLAR
    from skywave.streaming import ingest, live
    d = _stream_dirs(spark, "live")
    ingest.write_files(_schema_cols(fx.solar_raw(spark, sf), SOLAR), d["src"], files=3, fmt="parquet", newest_first=True, ts_col="time")
    live.run_live_conditions(spark, d["src"], d["out"], d["ckpt"], max_files_per_trigger=1)
    return live.read_live_conditions(spark, d["out"])


@register("stream_live_enrich")
def stream_live_enrich(spark, sf):
    """Streamed spots, newest files first, with the conditions of their bucket."""
    from skywave.sources.schemas import PSKR_SPOT
    from skywave.streaming import ingest, live
    d = _stream_dirs(spark, "live-enrich")
    ingest.write_files(_pskr_rows(spark, sf), d["src"], files=3, fmt="parquet", newest_first=True)
    stream = spark.readStream.schema(PSKR_SPOT).parquet(d["src"]).select("timestamp", "sender_call", "receiver_call", "band", "snr")
    q = (live.enrich_stream(stream, solar.solar_latest(fx.solar_raw(spark, sf))).writeStream.format("parquet")
         .option("path", d["out"]).option("checkpointLocation", d["ckpt"]).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(d["out"])
