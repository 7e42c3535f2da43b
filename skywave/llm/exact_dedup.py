"""Exact duplicates by a tree merge of sorted digest runs.

Texts are equal when they are identical after each ``[\\x20\\x09-\\x0D]+`` became
one space.  Every input partition becomes a run of (digest, doc_id) sorted by
digest, written to the shared checkpoint folder.  Runs then merge in rounds,
``FAN`` neighbours at a time: a round is keyed by (digest, number of the run
group), so each exchange is spread over all digests, and of every digest a run
group sends one row however many copies it holds; the smallest doc_id and the
number of rows survive each level.  After the last round the results go back
down the same tree, so no join key ever meets more than ``FAN`` rows of a level
or the rows of one input partition: a group that holds a third of all rows is
spread over as many keys as there are runs.

A digest is SHA-256 and verified by length and a second, independent hash.
DataFrame functions only.

Cases: null counts as the empty text; rows that repeat a doc_id and its text
are one group, and one of them is kept; a null doc_id sorts after all others;
extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywave.llm.common import stored

FAN = 16
KEY = ["digest", "check", "length"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, run, digest, check, length): sorted runs, one a partition."""
    text = normalised(F.col("text"))
    return stored(docs.select("doc_id", text.alias("text"))
                  .select("doc_id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().cast("long").alias("run"),
                          F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("check"),
                          F.octet_length("text").alias("length"))
                  .sortWithinPartitions("digest", "doc_id", "row"))


def groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    base = runs(docs)
    last = base.agg(F.max("run")).first()[0] or 0
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    level = base.groupBy("run", *KEY).agg(F.min(who).alias("keep"), F.count("*").alias("size"))
    levels = [level]
    while last > 0:                                       # log(runs) rounds
        last //= FAN
        level = (level.withColumn("run", F.expr(f"run div {FAN}")).groupBy("run", *KEY)
                      .agg(F.min("keep").alias("keep"), F.sum("size").alias("size")))
        levels.append(level)
    found = levels.pop().select("run", *KEY, "keep", "size")
    for below in reversed(levels):
        up = below.select(F.expr(f"run div {FAN}").alias("up"), "run", *KEY)
        found = up.join(found.withColumnRenamed("run", "up"), ["up", *KEY]).select("run", *KEY, "keep", "size")
    return (base.join(found, ["run", *KEY])
                .select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the rows that an equal text makes superfluous."""
    kept = groups(docs).filter("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"), F.sha2(normalised(F.col("text")), 256).alias("digest"))
    on = F.col("all.doc_id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_sha"))
    rows = rows.join(kept, on, "left_semi")
    again = docs.groupBy("doc_id").count().filter("count > 1")
    if not again.isEmpty():                               # rows that repeat a doc_id: of those with its text, too, one stays
        rows = rows.withColumn("id", F.col("all.doc_id")).dropDuplicates(["id", "digest"])
    return rows.select("all.*")
