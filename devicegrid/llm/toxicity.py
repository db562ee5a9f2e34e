"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

A text is the set of its hashed words, word pairs and skip pairs (one word
left out between), 2^20 coordinates.  FTRL-proximal keeps a rate of its own
for each coordinate, and its L1 term leaves most weights at exactly 0, so that
the model is a short list of (coordinate, weight), bounded by 2^20 entries.

Fitting takes a bounded sample of labelled rows (``max_rows`` in expectation,
by hash of the id; an equal number of each label, all rows of a label with
fewer, and the intercept is set back to the shares of the whole): texts become coordinates in parallel tasks, and one task
runs FTRL over the bounded sample in the order of the ids' hash.  Scoring needs
no shuffle and reads every text whole.

Defined results
* a null or empty text has only the intercept, and so a score too;
* of several labels for one id, any of them 1 makes it 1; null labels teach
  nothing; with nothing to learn from, every score is 0.5 less a little (0.0
  weights would tie), so ``predicted`` is 0;
* a null id counts as empty text in the split; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.langid import equal_parts, sampled

BITS = 20
WORD = re.compile(r"\w+")
MEMO = 300_000
#: Odd multipliers of the hashed pairs.
PAIR, SKIP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def featurizer():
    """A function text -> sorted coordinates; coordinate 0 is the intercept."""
    memo: dict[str, int] = {}

    def spread(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * MIX
        return (x >> np.uint64(64 - BITS)).astype(np.int32)

    def features(text: str | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        if len(memo) > MEMO:
            memo.clear()
        codes = []
        for w in words:
            c = memo.get(w)
            if c is None:
                c = memo[w] = zlib.crc32(w.encode()) + 1
            codes.append(c)
        h = np.array(codes, np.uint64)
        found = [np.zeros(1, np.int32), spread(h * PAIR)]
        if len(h) > 1:
            found.append(spread(h[:-1] * PAIR + h[1:] * SKIP + np.uint64(1)))
        if len(h) > 2:
            found.append(spread(h[:-2] * SKIP + h[2:] * PAIR + np.uint64(2)))
        return np.unique(np.concatenate(found))

    return features


def ftrl(rows: list[tuple[np.ndarray, int]], alpha: float, beta: float, l1: float, l2: float, epochs: int) -> np.ndarray:
    """Weights after ``epochs`` passes over (coordinates, label) in order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for at, label in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[at] = grown
    return weights(z, n)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, epochs: int = 6,
        alpha: float = 2.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) learnt from ``labels`` (doc_id, toxic) and the texts."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return np.zeros(0, np.int32), np.zeros(0)
    shares = equal_parts(sizes, max_rows)
    # Bounded by max_rows, and so broadcast: the texts are not shuffled.
    sample = known.where(sampled("toxic", shares)).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__y"))
    rows = docs.select("doc_id", F.col("text").alias("__t")).join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("doc_id", "__y", "__t")

    def featured(batches):
        features = featurizer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([features(t).tobytes() for t in batch.column(2).to_pylist()], pa.binary())], names=["id", "y", "at"])

    def train(batches):
        learnt = [(np.frombuffer(a, np.int32), y) for batch in batches
                  for y, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        w = ftrl(learnt, alpha, beta, l1, l2, epochs)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], names=["at", "w"])

    # One task, bounded by max_rows whatever the input.
    found = (rows.mapInArrow(featured, "id bigint, y int, at binary").repartition(1)
             .sortWithinPartitions(F.xxhash64(F.lit("deal"), F.col("id")), "id", "at")
             .mapInArrow(train, "at int, w double").collect())
    weights = {r["at"]: r["w"] for r in found}
    if set(shares) == {0, 1} and shares[0] != shares[1]:
        weights[0] = weights.get(0, 0.0) + math.log(shares[0] / shares[1])
    at = sorted(weights)
    return np.array(at, np.int32), np.array([weights[x] for x in at], np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, with ``score`` and ``predicted`` (kept columns of these names give way)."""
    keep = [c for c in keep if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        features, dense = featurizer(), np.zeros(1 << BITS)
        at, w = shared.value
        dense[at] = w
        if not len(at):
            dense[0] = -0.01
        for batch in batches:
            sums = [float(dense[features(t)].sum()) for t in batch.column(len(keep)).to_pylist()]
            scores = [1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, s)))) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
