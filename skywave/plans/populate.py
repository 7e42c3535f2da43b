"""Warehouse population: the build steps in dependency order.

Each step reads stored tables, runs the operators and overwrites its output
table (re-runs are idempotent), guarded by the row gates of the original
build scripts: the callsign dimension must be complete before type-2 flagging
(otherwise every transmitter looks synthetic), flags must exist before the
terrestrial signatures, the continuous gold set before v6.

    python -m skywave.plans.populate --root <warehouse folder> [--steps a,b,...]

Layout under the root: ``<schema>.<table>/`` Parquet folders; bronze facts are
month-partitioned (``write_fact``), derived tables partitioned by band where
consumers read one band at a time.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skywave import constants as K
from skywave.operators import callsigns, flags, sampling, signatures, tables
from skywave.sources import sinks


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    gates: dict = field(default_factory=lambda: {
        "callsign_grid": K.MIN_CALLSIGN_GRID_ROWS, "flags": K.MIN_FLAG_ROWS, "gold_continuous": 1})
    windows: dict = field(default_factory=lambda: {
        "contest": K.CONTEST_WINDOW, "rbn": K.RBN_WINDOW, "gold": K.GOLD_WINDOW})

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        """Read with the schema stored next to the table (an empty partitioned
        table has no files to infer it from)."""
        stored = _read_text(self.spark, f"{self.path(table)}/{SCHEMA_FILE}")
        reader = self.spark.read
        if stored:
            reader = reader.schema(T.StructType.fromJson(json.loads(stored)))
        return reader.parquet(self.path(table))

    def write(self, df: DataFrame, table: str, partition_cols=None) -> int:
        sinks.overwrite_table(df, self.path(table), partition_cols)
        _write_text(self.spark, f"{self.path(table)}/{SCHEMA_FILE}", df.schema.json())
        return self.read(table).count()

    def load_bronze(self, df: DataFrame, table: str, sort_cols=("band", "timestamp")) -> int:
        """Bronze facts: month-partitioned, clustered by band and time."""
        sinks.write_fact(df, self.path(table), sort_cols=list(sort_cols), mode="overwrite")
        return self.read(table).count()


SCHEMA_FILE = "_skywave_schema.json"   # leading underscore: ignored by Parquet readers


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _spots(wh: Warehouse) -> DataFrame:
    return wh.read("wspr.bronze")


def populate_station_days(wh: Warehouse) -> int:
    return wh.write(callsigns.station_days(_spots(wh)), "wspr.station_days")


def populate_callsign_grid(wh: Warehouse) -> int:
    n = wh.write(callsigns.callsign_grid(summary=wh.read("wspr.station_days")), "wspr.callsign_grid")
    tables.assert_min_rows(wh.read("wspr.callsign_grid"), wh.gates["callsign_grid"], "wspr.callsign_grid")
    return n


def populate_balloon_flags(wh: Warehouse) -> int:
    cg = wh.read("wspr.callsign_grid")
    tables.assert_min_rows(cg, wh.gates["callsign_grid"], "wspr.callsign_grid (before type-2 flagging)")
    return wh.write(flags.balloon_flags_v2(None, cg, summary=wh.read("wspr.station_days")), "wspr.balloon_callsigns_v2")


def populate_signatures_v1(wh: Warehouse) -> int:
    return wh.write(signatures.wspr_signatures(_spots(wh), wh.read("solar.bronze")), "wspr.signatures_v1", ["band"])


def populate_signatures_v2(wh: Warehouse) -> int:
    fl = wh.read("wspr.balloon_callsigns_v2")
    tables.assert_min_rows(fl, wh.gates["flags"], "wspr.balloon_callsigns_v2")
    sig = signatures.wspr_signatures_v2(_spots(wh), wh.read("solar.bronze"), fl)
    return wh.write(sig, "wspr.signatures_v2_terrestrial", ["band"])


def populate_contest_signatures(wh: Warehouse) -> int:
    sig = signatures.contest_signatures(wh.read("contest.bronze"), wh.read("wspr.callsign_grid"), wh.read("solar.bronze"),
                                        window=wh.windows["contest"])
    return wh.write(sig, "contest.signatures", ["band"])


def populate_rbn_signatures(wh: Warehouse) -> int:
    sig = signatures.rbn_signatures(wh.read("rbn.bronze"), wh.read("wspr.callsign_grid"), wh.read("solar.bronze"),
                                    window=wh.windows["rbn"])
    return wh.write(sig, "rbn.signatures", ["band"])


def populate_gold_stratified(wh: Warehouse, per_cell: int = K.STRATIFIED_PER_CELL) -> int:
    g = sampling.gold_stratified(_spots(wh), wh.read("solar.bronze"), per_cell=per_cell, window=wh.windows["gold"])
    return wh.write(g, "wspr.gold_stratified", ["band"])


def populate_gold_continuous(wh: Warehouse, per_band: int = K.CONTINUOUS_PER_BAND,
                             density_limit: int = K.DENSITY_SAMPLE_LIMIT) -> int:
    s, sol = _spots(wh), wh.read("solar.bronze")
    density = sampling.ifw_density(s, sol, sample_limit=density_limit, window=wh.windows["gold"])
    g = sampling.gold_continuous(s, sol, density, per_band=per_band, window=wh.windows["gold"])
    return wh.write(g, "wspr.gold_continuous", ["band"])


def populate_gold_v6(wh: Warehouse) -> int:
    cont = wh.read("wspr.gold_continuous")
    tables.assert_min_rows(cont, wh.gates["gold_continuous"], "wspr.gold_continuous (before v6)")
    return wh.write(sampling.gold_v6(cont), "wspr.gold_v6", ["band"])


def populate_quality_test_paths(wh: Warehouse, per_band: int = K.QUALITY_TEST_PER_BAND,
                                min_spots: int = K.QUALITY_TEST_MIN_SPOTS) -> int:
    p = sampling.quality_test_paths(wh.read("wspr.signatures_v1"), per_band=per_band, min_spots=min_spots)
    return wh.write(p, "validation.quality_test_paths")


# name -> (prerequisite steps, function); insertion order is a valid build order
STEPS: dict[str, tuple[tuple[str, ...], Callable[..., int]]] = {
    "station_days": ((), populate_station_days),
    "callsign_grid": (("station_days",), populate_callsign_grid),
    "balloon_flags": (("station_days", "callsign_grid"), populate_balloon_flags),
    "signatures_v1": ((), populate_signatures_v1),
    "signatures_v2": (("balloon_flags",), populate_signatures_v2),
    "contest_signatures": (("callsign_grid",), populate_contest_signatures),
    "rbn_signatures": (("callsign_grid",), populate_rbn_signatures),
    "gold_stratified": ((), populate_gold_stratified),
    "gold_continuous": ((), populate_gold_continuous),
    "gold_v6": (("gold_continuous",), populate_gold_v6),
    "quality_test_paths": (("signatures_v1",), populate_quality_test_paths),
}


def build_order(requested=None) -> list[str]:
    """Requested steps plus their prerequisites, in dependency order."""
    want = set(requested or STEPS)
    changed = True
    while changed:
        changed = False
        for name in list(want):
            for dep in STEPS[name][0]:
                if dep not in want:
                    want.add(dep)
                    changed = True
    return [n for n in STEPS if n in want]


def run(wh: Warehouse, steps=None, options: dict | None = None) -> DataFrame:
    """Run steps in order; returns a report (step, rows written, seconds)."""
    options = options or {}
    report = []
    for name in build_order(steps):
        t0 = time.perf_counter()
        rows = STEPS[name][1](wh, **options.get(name, {}))
        report.append((name, int(rows), round(time.perf_counter() - t0, 3)))
    return wh.spark.createDataFrame(report, "step string, rows bigint, seconds double")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--root", required=True, help="warehouse folder (shared storage on a cluster)")
    ap.add_argument("--steps", default="", help="comma-separated steps (default: all)")
    a = ap.parse_args(argv)
    from skywave.session import get_session
    spark = get_session()
    run(Warehouse(spark, a.root), [s for s in a.steps.split(",") if s] or None).show(truncate=False)


if __name__ == "__main__":
    main()


__all__ = ["Warehouse", "STEPS", "build_order", "run"]
