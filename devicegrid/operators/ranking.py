"""Running totals over a whole table without a one-task window, and the exact
area under the ROC curve (Mann-Whitney ranks with ties) built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devicegrid.session import cut_lineage


def running_totals(rows: DataFrame, group: str, order: str, sums: Sequence[str]) -> DataFrame:
    """Adds ``before_<c>``: the total of column c over the group's rows that come
    before this one by ``order`` (unique within the group).

    Rows are sorted over all tasks and kept; each task's part of a group is a
    cell.  Offsets run over cells - as many as tasks - and rows within one cell.
    """
    cells = cut_lineage(rows.sort(group, order).withColumn("_cell", F.spark_partition_id()))
    earlier = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.groupBy(group, "_cell").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums]).select(
        F.col(group).alias("_g"), F.col("_cell").alias("_c"), *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inner = Window.partitionBy(group, "_cell").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    met = cells.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")))
    return met.select(*rows.columns, *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inner), F.lit(0))).alias(f"before_{c}") for c in sums])


def roc_auc(scored: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """(group, positives, negatives, auc): the share of pairs of a positive and a
    negative row that the score orders right, ties counting half; null without
    one of the two.  Rows without score or label are left out."""
    counts = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(group, score).agg(
        F.count_if(F.col(label) > 0).alias("pos"), F.count_if(F.col(label) <= 0).alias("neg"))
    pairs = running_totals(counts, group, score, ["neg"])
    won = F.sum(F.col("pos") * (2 * F.col("before_neg") + F.col("neg")))  # twice the pairs: whole numbers
    return pairs.groupBy(group).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), won.alias("won")).select(
        group, "positives", "negatives", F.expr("try_divide(cast(won as double), 2.0D * positives * negatives)").alias("auc"))
