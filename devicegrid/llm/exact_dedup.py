"""Exact de-duplication by a 128-bit content hash, checked byte by byte.

Main path: DataFrame functions only.  Rows are grouped by (hash, text), so
that the grouping itself compares the bytes; copies collapse on the map side
and a text shared by a third of all rows costs each task one row.  What then
travels is slim: hash, digest and ids.  A hash met by two different texts is
found by counting its classes, and only the rows of such hashes are joined on
the text again.

Defined results
* a null text counts as empty; texts are compared as they are (give
  ``normalise`` to compare another form);
* the row with the largest ``doc_id`` stays (``keep="min"``: the smallest);
  null ids never win over others; a group of null ids alone has a null
  ``keep_id`` and all its rows count as kept;
* rows that repeat both ``doc_id`` and text carry the same answer, and
  :func:`deduplicate` returns one of them;
* an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import text_of, written


def content_hash(text: Column) -> Column:
    """128 bits as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def mark_duplicates(docs: DataFrame, keep: str = "max", normalise: Callable[[Column], Column] | None = None,
                    hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    text = (normalise or (lambda c: c))(text_of())
    best = {"max": F.max, "min": F.min}[keep]
    rows = docs.select("doc_id", text.alias("body")).withColumn("hash", hashed(F.col("body")))

    classes = written(
        rows.groupBy("hash", "body")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"),
        "exact-classes")
    per_hash = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    collided = per_hash.where("n > 1").select("hash")

    slim = rows.select("doc_id", "hash")
    if collided.isEmpty():
        out = slim.join(classes, "hash")
    else:
        alone = classes.join(collided, "hash", "left_anti")
        apart = (rows.join(collided, "hash", "left_semi").groupBy("hash", "body")
                 .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        same = (rows.join(apart, ["hash", "body"])
                .select("hash", "doc_id", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"))
        out = slim.join(alone, "hash").unionByName(same)
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, keep: str = "max", normalise: Callable[[Column], Column] | None = None,
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    marks = written(
        mark_duplicates(docs, keep, normalise, hashed).where("kept")
        .groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows")),
        "exact-kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("rows").alias("__rows"))
    sha = F.sha2((normalise or (lambda c: c))(text_of()), 256)
    keyed = docs.withColumn("__own", sha)
    kept = keyed.join(marks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha")))
    if not marks.where("__rows > 1").isEmpty():
        # Repeated rows: one of each (doc_id, text) stays, whatever its other columns say.
        single = kept.where("__rows = 1")
        again = kept.where("__rows > 1").dropDuplicates(["__id", "__own"])
        kept = single.unionByName(again)
    return kept.select(*docs.columns)
