"""Table-level helpers: latest-version dedup, row gates, schema contract checks
and inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence, descending: bool = True,
                  tie_break: Sequence | None = None) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_cols`` (the
    reference's replacing-merge 'latest version wins').

    ``row_number() == 1`` over a key partition; Spark plans it with a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key is reduced to
    one row per map task before it moves.  ``tie_break`` makes the choice total
    (defaults to all remaining columns)."""
    keys = list(keys)
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in keys]
    order = _cols(order_cols) + _cols(rest)
    order = [o.desc() if descending else o.asc() for o in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


class RowGateError(RuntimeError):
    pass


def assert_min_rows(df: DataFrame, n: int, what: str = "table") -> int:
    """Pre/post gate: raise unless ``df`` has at least ``n`` rows.  Only counts
    up to ``n`` (``limit(n).count()``), so the gate never scans more than it needs."""
    got = df.limit(n).count()
    if got < n:
        raise RowGateError(f"{what}: expected at least {n} rows, found {got}")
    return got


def row_gates(checks: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """One row per gate: name, required rows, rows in the table, passed."""
    spark = next(iter(checks.values()))[0].sparkSession
    parts = []
    for name, (df, n) in checks.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("seen"))
                     .select(F.lit(name).alias("gate"), F.lit(n).cast("bigint").alias("required"),
                             F.col("seen").cast("bigint").alias("seen")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", (F.col("seen") >= F.col("required")).cast("int"))


def table_inventory(datasets: dict[str, DataFrame | None]) -> DataFrame:
    """Rows and columns per dataset; missing datasets are reported with -1."""
    parts = []
    spark = None
    for name, df in datasets.items():
        if df is None:
            continue
        spark = df.sparkSession
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("dataset"), F.lit(1).alias("present"),
            F.col("n").cast("bigint").alias("row_count"), F.lit(len(df.columns)).alias("column_count")))
    missing = [n for n, d in datasets.items() if d is None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if missing:
        m = spark.createDataFrame([(n, 0, -1, -1) for n in missing],
                                  "dataset string, present int, row_count bigint, column_count int")
        out = out.unionByName(m)
    return out


def conformance_report(df: DataFrame, contract) -> DataFrame:
    """Per contract column: position, name, expected type, present, and in ONE
    pass over the data the rows out of range, over the fixed width and NULL.

    ``contract`` rows are (name, reference type, max width or None, (lo, hi) or None)."""
    present = set(df.columns)
    aggs = []
    for name, _, width, rng in contract:
        if name not in present:
            continue
        c = F.col(name)
        aggs.append(F.count_if(c.isNull()).alias(f"{name}__null"))
        if width is not None:
            aggs.append(F.count_if(F.length(c) > width).alias(f"{name}__wide"))
            aggs.append(F.max(F.length(c)).alias(f"{name}__maxlen"))
        if rng is not None:
            lo, hi = rng
            cond = F.lit(False)
            if lo is not None:
                cond = cond | (c < lo)
            if hi is not None:
                cond = cond | (c > hi)
            aggs.append(F.count_if(cond).alias(f"{name}__range"))
    stats = df.agg(*aggs)
    rows = []
    for pos, (name, ref_type, width, rng) in enumerate(contract, start=1):
        ok = name in present
        def g(suffix, ok=ok, name=name):
            return F.col(f"{name}__{suffix}").cast("bigint") if ok else F.lit(None).cast("bigint")
        rows.append(F.struct(
            F.lit(pos).alias("position"), F.lit(name).alias("name"), F.lit(ref_type).alias("expected_type"),
            F.lit(int(ok)).alias("present"),
            (g("null") if ok else F.lit(None).cast("bigint")).alias("null_rows"),
            (g("range") if ok and rng is not None else F.lit(0).cast("bigint")).alias("out_of_range_rows"),
            (g("wide") if ok and width is not None else F.lit(0).cast("bigint")).alias("over_width_rows"),
            (g("maxlen") if ok and width is not None else F.lit(None).cast("bigint")).alias("max_length"),
        ))
    out = stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("conforms", (F.col("present") == 1) & (F.col("null_rows") == 0)
                          & (F.col("out_of_range_rows") == 0) & (F.col("over_width_rows") == 0)).withColumn(
        "conforms", F.col("conforms").cast("int"))


def width_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """max(length) of each string column (before narrowing to a fixed width)."""
    return df.agg(*[F.max(F.length(c)).cast("bigint").alias(f"max_len_{c}") for c in columns])


def upgrade_v1_to_v2(df: DataFrame) -> DataFrame:
    """Schema upgrade of legacy bronze rows: add ``mode`` ('WSPR') and
    ``column_count`` (15) when absent, widen band to int."""
    from skywave.sources.readers import conform_wspr
    if "band" in df.columns:
        df = df.withColumn("band", F.col("band").cast(T.IntegerType()))
    return conform_wspr(df)
