"""k-means with D-squared seeding and all restarts side by side, and the
Euclidean silhouette.

A pass over the rows serves every restart: distances to all centres are folds over
arrays, sums per (restart, cluster) are combined before the exchange, and
only ``restarts`` x ``k`` centres reach the driver.  Draws come from SHA-256 of
the row's key, so a run can be repeated in any engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicegrid import config as C
from devicegrid.session import cut_lineage

Centres = list[list[list[float]]]


@dataclass(frozen=True)
class Clusters:
    centres: list[list[float]]
    cost: float


def _point(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def _distances(point: Column, centres: Column) -> Column:
    """Squared distances.  Centres come as a value, not as code, so that a new
    round needs no new compilation."""
    return F.transform(centres, lambda c: F.aggregate(F.zip_with(point, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d))


def _drawn(seed: int, restart: int, step: int, key: str) -> Column:
    """A number in (0, 1) from the row's key."""
    text = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(str(restart)), F.lit(str(step)), F.col(key).cast("string")), 256)
    return (F.conv(F.substring(text, 1, 13), 16, 10).cast("long") + 1) / F.lit(4503599627370497.0)


def seeded(rows: DataFrame, key: str, features: Sequence[str], k: int, restarts: int, seed: int) -> Centres:
    """Each next centre is drawn with a chance in proportion to the squared distance
    to the nearest one so far: the row of smallest -ln(u) / weight (ties by key)."""
    centres: Centres = [[] for _ in range(restarts)]
    for step in range(k):
        if step and not all(centres):
            break
        picks = []
        for r in range(restarts):
            weight = F.array_min(_distances(_point(features), F.lit(centres[r]))) if step else F.lit(1.0)
            race = F.when(weight > 0, -F.ln(_drawn(seed, r, step, key)) / weight).otherwise(F.lit(float("inf")))
            picks.append(F.min(F.struct(race.alias("race"), F.col(key).alias("key"), *[F.col(f).alias(f) for f in features])).alias(f"p{r}"))
        found = rows.agg(*picks).first()
        for r in range(restarts):
            if found[f"p{r}"] is not None:
                centres[r].append([float(found[f"p{r}"][f]) for f in features])
    return centres


def _nearest(point: Column, centres: Column) -> Column:
    """(cluster, cost); of equally near centres the first."""
    return F.transform(F.array(_distances(point, centres)), lambda d: F.struct(
        (F.array_position(d, F.array_min(d)) - 1).cast("int").alias("cluster"), F.array_min(d).alias("cost")))[0]


def over_all_cores(rows: DataFrame) -> DataFrame:
    """Devices are few bytes a row, which AQE puts into one partition; what is done
    with each is dear, and a pass takes as long as its largest task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit_kmeans(rows: DataFrame, key: str = "atm_id", features: Sequence[str] = C.CLUSTER_FEATURES, k: int = C.KMEANS_K,
               restarts: int = C.KMEANS_RESTARTS, seed: int = C.SEED, max_iter: int = 40) -> Clusters:
    """The cheapest of ``restarts`` runs (ties: the first) after ``max_iter`` rounds or
    when no centre moves; a cluster without rows keeps its centre."""
    data = cut_lineage(over_all_cores(rows.select(key, *features)))
    centres = seeded(data, key, features, k, restarts, seed)
    if not all(centres):
        return Clusters([], 0.0)
    def dealt():
        found = F.transform(F.lit(centres), lambda c: _nearest(_point(features), c))
        return data.select(*features, F.posexplode(found).alias("_r", "_n"))

    for _ in range(max_iter):
        sums = dealt().groupBy("_r", F.col("_n.cluster").alias("_c")).agg(F.count(F.lit(1)).alias("_m"), *[F.sum(f).alias(f) for f in features]).collect()
        moved = 0.0
        for s in sums:
            new = [s[f] / s["_m"] for f in features]
            moved = max(moved, *(abs(a - b) for a, b in zip(new, centres[s["_r"]][s["_c"]])))
            centres[s["_r"]][s["_c"]] = new
        if moved <= 1e-9:
            break
    costs = {r["_r"]: r["cost"] for r in dealt().groupBy("_r").agg(F.sum("_n.cost").alias("cost")).collect()}
    best = min(range(restarts), key=lambda r: (round(costs[r], 6), r))
    return Clusters(centres[best], float(costs[best]))


def assign(rows: DataFrame, found: Clusters, features: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """``rows`` with the number of the nearest centre as ``cluster``."""
    return rows.withColumn("cluster", _nearest(_point(features), F.lit(found.centres))["cluster"])


def silhouette(assigned: DataFrame, key: str = "atm_id", features: Sequence[str] = C.CLUSTER_FEATURES, sample: int = 2_000, seed: int = C.SEED) -> float:
    """Mean silhouette, by Euclidean distance, of ``sample`` rows (those of smallest
    hash; all rows of a smaller table) against all rows.

    A task adds up the distances of its rows to every sampled row, by cluster, and
    hands on sample x clusters sums: no pair of rows is ever a row.
    """
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)
    drawn = assigned.orderBy(order, key).limit(sample).select("cluster", *features).collect()
    points = np.array([[float(r[f]) for f in features] for r in drawn]).reshape(len(drawn), len(features))
    sizes = {r.cluster: r.n for r in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(sizes, default=0) + 1

    def sums(batches):
        total = np.zeros((top, len(points)))
        for batch in batches:
            of = batch.column(0).to_numpy()
            x = np.stack([batch.column(i + 1).to_numpy() for i in range(len(features))], axis=1)
            for at in range(0, len(x), 256):
                d = np.sqrt(((x[at:at + 256, None, :] - points[None]) ** 2).sum(axis=2))
                np.add.at(total, of[at:at + 256], d)
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(c, pa.int64()), pa.array(total[c, i])], names=["i", "c", "d"])

    parts = over_all_cores(assigned.select("cluster", *[F.col(f).cast("double") for f in features])).mapInArrow(sums, "i long, c long, d double")
    total = np.zeros((top, len(points)))
    for r in parts.groupBy("i", "c").agg(F.sum("d").alias("d")).collect():
        total[r.c, r.i] = r.d
    out = []
    for i, row in enumerate(drawn):
        own, others = sizes[row.cluster], [c for c in sizes if c != row.cluster]
        if own == 1 or not others:
            out.append(0.0)
            continue
        a, b = total[row.cluster, i] / (own - 1), min(total[c, i] / sizes[c] for c in others)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out)) if out else 0.0
