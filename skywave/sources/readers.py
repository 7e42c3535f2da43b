"""Typed readers for the bronze datasets.

Every reader takes an explicit schema (no inference), strips the NUL padding of
fixed-width strings once at ingest, and fills the reference's type defaults
(no column is nullable there: missing = 0 or '').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skywave.constants import V1_DEFAULT_COLUMN_COUNT, V1_DEFAULT_MODE
from skywave.functions.grid import clean_fixed
from skywave.sources import schemas

WSPR_FIXED_STRINGS = ["reporter", "reporter_grid", "callsign", "grid", "mode", "version"]
RBN_STRINGS = ["de_call", "de_pfx", "de_cont", "dx_call", "dx_pfx", "dx_cont", "spot_type", "tx_mode"]
CONTEST_STRINGS = ["mode", "call_1", "call_2", "rst_sent", "exch_sent", "rst_rcvd", "exch_rcvd", "contest", "source"]


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, **options) -> DataFrame:
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.schema(schema).load(path)


def conform(df: DataFrame, schema: T.StructType, strings=(), defaults: dict | None = None) -> DataFrame:
    """Cast to ``schema`` (adding absent columns with their default), strip NULs
    from ``strings`` and replace NULLs by the type default."""
    defaults = defaults or {}
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name).try_cast(f.dataType)
        else:
            c = F.lit(defaults.get(f.name)).cast(f.dataType)
        if f.name in strings:
            c = clean_fixed(c)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def conform_wspr(df: DataFrame) -> DataFrame:
    """Bronze v2 contract; v1 rows get mode 'WSPR' and column_count 15."""
    return conform(df, schemas.WSPR_SPOT, WSPR_FIXED_STRINGS,
                   {"mode": V1_DEFAULT_MODE, "column_count": V1_DEFAULT_COLUMN_COUNT})


#: Columns that the older 15-column spot files lack.
V1_ABSENT = ("mode", "column_count")


#: How the archives write CSV: fields may be quoted, and quotes in them are doubled.
CSV = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once per row: as a generator's output they
    aren't copied into each filter and expression above that uses them, as those of
    a projection are."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _lines(spark: SparkSession, path: str, schema: T.StructType, absent=()) -> DataFrame:
    """Raw CSV lines with their parsed rows: value, columns (the line's own
    count), row (a struct of ``schema``; lines without the ``absent`` columns
    have NULL there) and bad (why a line can't be used, else NULL).  A line is
    parsed as one record, with quoted fields, doubled quotes and commas inside
    them; its fields are text first, so nothing is inferred, and nothing that
    fails to parse becomes a default.

    A line is parsed once: by the CSV parser if it has a quote, else its fields
    are what lies between the commas."""
    full = schema.fieldNames()
    old = [n for n in full if n not in absent]
    text = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    quoted, n = F.contains("value", F.lit('"')), F.col("columns")
    # what is outside quotes tells the number of columns
    outside = F.when(quoted, F.regexp_replace("value", '"([^"]|"")*"', "")).otherwise(F.col("value"))
    text = _once(text, columns=F.size(F.split(outside, ",")))
    is_old = n == len(old) if absent else F.lit(False)

    def parsed(names, when: Column) -> Column:
        return F.when(when, F.from_csv("value", ", ".join(f"`{x}` string" for x in [*names, "__bad"]), CSV))

    text = _once(text, __full=parsed(full, quoted & (n == len(full))), __old=parsed(old, quoted & is_old) if absent else F.lit(None))
    records = F.when(n == len(full), F.array(*[F.col("__full")[x] for x in full]))
    record = F.col("__full")["__bad"]
    if absent:
        records = records.when(is_old, F.array(*[F.col("__old")[x] for x in old]))
        record = F.coalesce(record, F.col("__old")["__bad"])
    text = _once(text, __fields=F.when(quoted, records).otherwise(F.split("value", ",")), __record=record)

    def field(f: T.StructField) -> Column:
        """The field's text; NULL where the line has no such column."""
        at = F.get("__fields", F.lit(full.index(f.name)))
        if absent:
            at = F.when(~is_old, at) if f.name in absent else F.when(is_old, F.get("__fields", F.lit(old.index(f.name)))).otherwise(at)
        at = F.coalesce(clean_fixed(at), F.lit(""))
        at = at if isinstance(f.dataType, T.StringType) else F.trim(at)
        return F.when(~is_old, at) if f.name in absent else at

    usable = (n == len(full)) | is_old
    text = _once(text, __text=F.when(usable, F.struct(*[field(f).alias(f.name) for f in schema.fields])))
    given = lambda f: F.col("__text")[f.name]
    text = _once(text, row=F.when(usable, F.struct(*[(given(f) if isinstance(f.dataType, T.StringType) else given(f).try_cast(f.dataType)).alias(f.name) for f in schema.fields])))
    unread = F.lit(False)                                # a field with text in the line and nothing in the row
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            unread = unread | (F.coalesce(given(f) != "", F.lit(False)) & F.col("row")[f.name].isNull())
    reason = F.when(~usable, F.lit("columns")).when(F.col("__record").isNotNull(), F.lit("record")).when(unread, F.lit("value"))
    return text.select("value", "columns", "row", reason.alias("bad"))


def quarantine(spark: SparkSession, path: str, schema: T.StructType, absent=()) -> DataFrame:
    """Lines of raw CSV that ``load_*`` leaves out: value, columns, bad."""
    return _lines(spark, path, schema, absent).where(F.col("bad").isNotNull()).select("value", "columns", "bad")


def _good(spark: SparkSession, path: str, schema: T.StructType, absent=()) -> DataFrame:
    good = _lines(spark, path, schema, absent).where(F.col("bad").isNull())
    rows = good.select("row.*", F.col("columns").alias("__n"))
    if "column_count" in schema.fieldNames():            # the line's own count
        rows = rows.withColumn("column_count", F.col("__n").cast(schema["column_count"].dataType))
    return rows.drop("__n")


def load_wspr(spark: SparkSession, path: str, fmt: str = "parquet", ingest: bool | None = None, **options) -> DataFrame:
    """Typed bronze spots.  Raw CSV (15 or 17 columns, NUL padding; bad lines are
    in ``quarantine``) and ``ingest=True`` go through ``conform_wspr``; a
    conformed Parquet table is read as is, so filters on its plain columns reach
    the scan (PushedFilters) and month partitions prune."""
    if fmt == "csv":
        return conform_wspr(_good(spark, path, schemas.WSPR_SPOT, V1_ABSENT))
    df = _read(spark, path, schemas.WSPR_SPOT, fmt, **options)
    return conform_wspr(df) if ingest else df.select(*schemas.WSPR_SPOT.fieldNames())


def load_rbn(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """RBN archive under its explicit schema: the files' ``mode`` column is
    ``spot_type``, and ``tx_mode`` is absent (empty) in the oldest files."""
    if fmt == "csv":
        return conform(_good(spark, path, schemas.RBN_SPOT, ("tx_mode",)), schemas.RBN_SPOT, RBN_STRINGS)
    variant = T.StructType([*schemas.RBN_SPOT.fields, T.StructField("mode", T.StringType())])
    raw = _read(spark, path, variant, fmt, **options)    # a name that a file lacks reads as NULL
    raw = raw.withColumn("spot_type", F.coalesce("spot_type", "mode")).drop("mode")
    return conform(raw, schemas.RBN_SPOT, RBN_STRINGS)


def load_contest(spark: SparkSession, path: str, fmt: str = "parquet", ingest: bool | None = None, **options) -> DataFrame:
    if fmt == "csv":
        return conform(_good(spark, path, schemas.CONTEST_QSO), schemas.CONTEST_QSO, CONTEST_STRINGS)
    df = _read(spark, path, schemas.CONTEST_QSO, fmt, **options)
    return conform(df, schemas.CONTEST_QSO, CONTEST_STRINGS) if ingest else df.select(*schemas.CONTEST_QSO.fieldNames())


def load_solar(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    return conform_solar(_good(spark, path, schemas.SOLAR) if fmt == "csv" else _read(spark, path, schemas.SOLAR, fmt, **options))


def conform_solar(df: DataFrame) -> DataFrame:
    df = conform(df, schemas.SOLAR, ["source_file"])
    return df.withColumn("updated_at", F.coalesce("updated_at", F.current_timestamp()))
