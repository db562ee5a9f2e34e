"""Features, labels, splits and models on the marts.

* labels and features are exact column expressions (window over the daily
  rows of one device, whose size is bounded by the number of days);
* the split is seeded by hashes and exact within each label (no window over a
  whole class, which would put half the data in one task);
* the fault model is in ``operators.boosting``, clusters in ``operators.clusters``;
* the cash forecast is in ``operators.forecast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.functions.exprs import portable_hash_text
from devicegrid.operators import boosting
from devicegrid.operators.ranking import roc_auc
from devicegrid.session import written

# --- fault model -------------------------------------------------------------


def next_event_label(daily_faults: DataFrame, key: str = "atm_id", date: str = "event_date",
                     features: Sequence[str] = C.FAULT_FEATURES) -> DataFrame:
    """Features plus ``fault_tomorrow`` = the next event row's fault count
    (0 on a device's last row) and the binary ``label`` = fault_tomorrow > 0.

    The "next row" is the next day *with events*, not the next calendar day.
    """
    w = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())
    nxt = F.coalesce(F.lead("faults", 1).over(w), F.lit(0))
    return daily_faults.select(
        key, date, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in features],
        nxt.cast("long").alias("fault_tomorrow"),
        (nxt > 0).cast("int").alias("label"))


def stratified_split(df: DataFrame, keys: Sequence[str], label: str = "label",
                     test_fraction: float = C.SPLIT_TEST_FRACTION, seed: int = C.SEED,
                     name: str = "split", cells_first: bool = False) -> DataFrame:
    """Seeded split with the exact share of each label: the rows with the
    smallest SHA-256 of their keys are the test rows of their label.

    Rows are counted per (label, first 12 bits of the hash); the running sum
    over those few cells says which cells are test and which train.  Only the
    one cell per label that the limit falls into is ranked row by row.
    ``cells_first`` writes the rows with their cells, then the counts of the cells:
    rows are computed and hashed once, and the joins know the counts' size and need
    not deal out the rows.
    """
    drawn_by = portable_hash_text(*keys, seed=seed)
    drawn = df.withColumn("_cell", F.substring(drawn_by, 1, 3))
    drawn = written(drawn, "drawn") if cells_first else drawn
    cells = drawn.groupBy(F.col(label).alias("_label"), F.col("_cell").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_label").orderBy("_of").rowsBetween(Window.unboundedPreceding, 0)
    want = F.floor(F.sum("_n").over(Window.partitionBy("_label")) * F.lit(test_fraction) + 0.5)
    cells = cells.select("_label", "_of", (want - (F.sum("_n").over(upto) - F.col("_n"))).alias("_room"), "_n")
    cells = written(cells, "cells") if cells_first else cells
    met = drawn.join(cells, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_cell") == F.col("_of")))
    sure = met.where((F.col("_room") <= 0) | (F.col("_room") >= F.col("_n"))).withColumn(
        name, F.when(F.col("_room") > 0, "test").otherwise("train"))
    place = F.row_number().over(Window.partitionBy("_label", "_of").orderBy(drawn_by))
    edge = met.where((F.col("_room") > 0) & (F.col("_room") < F.col("_n"))).withColumn(
        name, F.when(place <= F.col("_room"), "test").otherwise("train"))
    return sure.unionByName(edge).select(*df.columns, name)


def fit_fault_model(train: DataFrame, features: Sequence[str] = C.FAULT_FEATURES,
                    label: str = "label", max_iter: int = C.GBT_MAX_ITER,
                    max_depth: int = C.GBT_MAX_DEPTH, step_size: float = C.GBT_STEP_SIZE) -> boosting.Boosted:
    """Boosted trees; ``label`` may have more than two values (softmax)."""
    return boosting.fit(train, features, label, max_iter, max_depth, step_size)


def score(model: boosting.Boosted, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``fault_probability`` (class 1) and ``predicted`` (probability > threshold)."""
    prob = F.col("_p").getItem(1)
    return boosting.with_probabilities(model, df, "_p").select(
        *df.columns, prob.alias("fault_probability"), (prob > threshold).cast("int").alias("predicted"))


def classification_metrics(scored: DataFrame, label: str = "label") -> dict[str, float]:
    """Exact ROC-AUC of the probability and F1 of the positive class."""
    one = scored.select(F.lit("model").alias("_of"), "fault_probability", label)
    auc = roc_auc(one, "_of", "fault_probability", label).first()
    c = scored.agg(F.count_if((F.col("predicted") == 1) & (F.col(label) == 1)).alias("tp"),
                   F.count_if((F.col("predicted") == 1) & (F.col(label) == 0)).alias("fp"),
                   F.count_if((F.col("predicted") == 0) & (F.col(label) == 1)).alias("fn")).first()
    denom = 2 * c.tp + c.fp + c.fn
    return {"roc_auc": float("nan") if auc is None or auc.auc is None else auc.auc, "f1": (2.0 * c.tp / denom) if denom else 0.0}


def feature_auc(labelled: DataFrame, features: Sequence[str] = C.FAULT_FEATURES, label: str = "label") -> DataFrame:
    """(feature, positives, negatives, auc): how well each feature alone orders the labels."""
    long = labelled.select(label, *[F.col(c).cast("double").alias(c) for c in features]).unpivot([label], list(features), "feature", "value")
    return roc_auc(long, "feature", "value", label)


def feature_importance(spark: SparkSession, model: boosting.Boosted) -> DataFrame:
    """(feature, importance: share of the mean gain), largest first."""
    return (spark.createDataFrame(list(model.importance().items()), "feature string, importance double")
                 .orderBy(F.col("importance").desc(), F.col("feature")))


def score_checks(scored: DataFrame, keys: Sequence[str], label: str = "label", threshold: float = 0.5) -> DataFrame:
    """One row: rows, positives, and what must be 0 - scores outside [0, 1],
    predictions that disagree with the threshold, rows that share a key."""
    p = F.col("fault_probability")
    per_key = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("y"),
        F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)).alias("outside"),
        F.count_if(F.col("predicted") != (p > threshold).cast("int")).alias("other"))
    return per_key.agg(
        F.sum("n").alias("rows"), F.sum("y").cast("long").alias("positives"), F.sum("outside").alias("outside_0_1"),
        F.sum("other").alias("against_threshold"), F.count_if(F.col("n") > 1).alias("repeated_keys"))


def cluster_checks(assigned: DataFrame, centres: list, features: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """One row: devices, clusters used, and devices nearer to another centre (must be 0)."""
    def distance(centre):
        return sum((F.col(f) - F.lit(float(x))) ** 2 for f, x in zip(features, centre))

    all_d = F.array(*[distance(c) for c in centres])
    return assigned.withColumn("_d", all_d).agg(
        F.count(F.lit(1)).alias("devices"), F.count_distinct("cluster").alias("clusters"),
        F.count_if(F.col("_d")[F.col("cluster")] > F.array_min("_d") + 1e-9).alias("nearer_elsewhere"))


# --- clustering --------------------------------------------------------------


def zscore(df: DataFrame, features: Sequence[str] = C.CLUSTER_FEATURES,
           keep: Sequence[str] = ("atm_id",)) -> DataFrame:
    """Standardise features: NULL -> 0, then (x - mean) / population sd.

    A constant feature (sd 0) becomes 0.  Fitting the scaler is one
    distributed aggregate; only its parameters (a mean and an sd per
    feature) reach the driver, and are applied as literals.
    """
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                for c in features])
    stats = filled.agg(*[F.avg(c).alias(f"m_{c}") for c in features],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
    cols = []
    for c in features:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        if s is None or m is None or s <= 0:
            cols.append(F.lit(0.0).alias(c))
        else:
            cols.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
    return filled.select(*keep, *cols)


def utilisation(profile: DataFrame, key: str = "atm_id", group: str = "region",
                value: str = "total_tx") -> DataFrame:
    """``utilisation_score`` in (0, 1]: the share of the group's rows with at
    most this ``value``, plus a recommendation label.

    (Own definition; the source pipeline only names the column.)  Exact at
    every size: rows are counted per (group, value) with map-side
    combination, the running sum goes over those counts - as many as there
    are different values - and is joined back on both columns, so that a
    group that holds most rows is spread over its values.
    """
    counts = profile.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(group).orderBy(value)
    ranked = counts.select(
        F.col(group).alias("_g"), F.col(value).alias("_v"),
        (F.sum("_n").over(upto).cast("double") / F.sum("_n").over(Window.partitionBy(group))).alias("_score"))
    j = profile.join(ranked, F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v")))
    rec = (F.when(F.col("_score") >= 0.8, "expand").when(F.col("_score") <= 0.2, "review")
            .otherwise("maintain"))
    return j.select(key, group, value, F.round("_score", 4).alias("utilisation_score"),
                    rec.alias("recommendation"))
