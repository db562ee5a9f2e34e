"""Second-order boosted trees on quantile bins, logistic or softmax.

Features are cut at exact quantiles (running totals over the counts of their
values, so that no task ranks a whole column).  Rows alike in all bins and in the
label have one gradient at all times, so each such vector is kept once with the number
of its rows; vectors are packed into blocks of bins, a byte a feature, feature by
feature.  A round grows one tree per output level by level: each
task adds up gradients and hessians of its rows by (output, node, feature, bin),
and the driver picks every node's best split from those sums, whose size depends
on the model alone.  Trees of a round share the passes over the vectors.

Blocks and the scores so far are kept by the tasks (an RDD of arrays: a pass has
no columns for Catalyst to plan, and there are 1,500 of them).  Scores are brought
up to date every ``FRESH`` rounds; what a lost executor kept is computed again
from the written blocks and the trees.

Gain of a split: (GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)) / 2; a leaf's value is
-G/(H+l) times the step.  Ties go to the first feature and the lowest cut.  A
missing feature counts as 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicegrid.operators.ranking import running_totals
from devicegrid.session import cut_lineage, written

FRESH = 2
#: Scores are written every so many rounds, so that their lineage stays short.
CUT = 100
BLOCK = 500_000
#: Rows that a pass works on at once: its arrays stay in a core's cache.
CHUNK = 16_384
ROWS_PER_TASK = 25_000
#: Features of few bins are summed up together, in so many cells at most.
CELLS = 1024
#: Column with the number of rows that one stands for.
COUNT = "__n"


@dataclass
class Tree:
    """A complete binary tree, root 1, children 2n and 2n + 1: split feature (-1: leaf),
    last bin that goes left, leaf value, gain."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 << depth
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row after ``depth`` levels (or the leaf above); a row of ``bins`` per feature."""
        rows = bins.shape[1]
        at, flat, place = np.ones(rows, np.intp), bins.ravel(), np.arange(rows)
        split = self.feature >= 0
        # A leaf's rows stay: its child is itself, and no bin lies above 255.
        column = np.where(split, self.feature, 0).astype(np.intp) * rows
        cut = np.where(split, self.cut, 255).astype(np.uint8)
        left = np.where(split, 2, 1) * np.arange(len(split))
        for _ in range(depth):
            above = flat.take(column.take(at) + place) > cut.take(at)
            at = left.take(at)
            at += above
        return at


@dataclass
class Boosted:
    features: list[str]
    cuts: list[list[float]]
    classes: int
    depth: int
    trees: list[list[Tree]] = field(default_factory=list)

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """A row per feature."""
        out = np.empty((len(columns), len(columns[0]) if len(columns) else 0), np.uint8)
        for i, (x, cuts) in enumerate(zip(columns, self.cuts)):
            out[i] = np.searchsorted(np.array(cuts), np.nan_to_num(x), side="right")
        return out

    def importance(self) -> dict[str, float]:
        """Mean gain of the splits on each feature, as shares."""
        total, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for trees in self.trees:
            for t in trees:
                used = t.feature >= 0
                np.add.at(total, t.feature[used], t.gain[used])
                np.add.at(n, t.feature[used], 1)
        mean = total / np.maximum(n, 1)
        return dict(zip(self.features, (mean / mean.sum() if mean.sum() else mean).tolist()))


def added(margin: np.ndarray, bins: np.ndarray, rounds: Sequence[Sequence[Tree]], depth: int) -> np.ndarray:
    out = margin.copy()
    if len(rounds):
        for i in range(0, len(out), CHUNK):
            part = np.ascontiguousarray(bins[:, i:i + CHUNK])
            for trees in rounds:
                for k, t in enumerate(trees):
                    out[i:i + CHUNK, k] += t.value[t.nodes(part, depth)]
    return out


def probabilities(margin: np.ndarray) -> np.ndarray:
    """A column per output: of class 1 (logistic) or of every class (softmax)."""
    if margin.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = probabilities(margin)
    if margin.shape[1] == 1:
        return p - y[:, None], p * (1 - p)
    return p - (y[:, None] == np.arange(margin.shape[1])), 2 * p * (1 - p)


def values(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]


def alike(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Different values of features and label, with the number of their rows."""
    return rows.select(*values(features), F.col(label).cast("int").alias(label)).groupBy(*features, label).agg(F.count(F.lit(1)).alias(COUNT))


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int, count: str | None = None) -> list[list[float]]:
    """For each feature the least value of every bin but the first; a value's bin is
    its rank times ``bins`` over the rows, so that equal values share one.  A row
    stands for ``count`` rows."""
    n = (F.col(count) if count else F.lit(1)).cast("long").alias(COUNT)
    long = rows.select(*values(features), n).unpivot([COUNT], list(features), "feature", "value")
    counts = running_totals(long.groupBy("feature", "value").agg(F.sum(COUNT).alias("n")), "feature", "value", ["n"])
    total = rows.select(n).agg(F.sum(COUNT)).first()[0] or 0
    least = counts.groupBy("feature", F.expr(f"before_n * {bins} div {max(total, 1)}").alias("bin")).agg(F.min("value").alias("cut"))
    out: dict[str, list[float]] = {f: [] for f in features}
    for r in least.where("bin > 0").collect():  # bins - 1 a feature at most
        out[r.feature].append(r.cut)
    return [sorted(out[f]) for f in features]


def blocks(rows: DataFrame, model: Boosted, label: str) -> DataFrame:
    """(bins, labels): a row per batch of rows."""
    n = len(model.features)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = model.bins([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n)])
                y = batch.column(n).to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["bins", "labels"])

    return rows.select(*values(model.features), F.col(label).cast("int").alias("__y")).mapInArrow(pack, "bins binary, labels binary")


def vectors(rows: DataFrame, model: Boosted, label: str) -> DataFrame:
    """(bins, label, ``COUNT``): a row per vector of bins and label, from rows that stand for ``COUNT`` each."""
    n = len(model.features)

    def binned(batches):
        for batch in batches:
            x = model.bins([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n)])
            ends = np.arange(0, x.size + 1, n, dtype=np.int32)
            bins = pa.Array.from_buffers(pa.binary(), x.shape[1], [None, pa.py_buffer(ends), pa.py_buffer(x.T.tobytes())])
            yield pa.RecordBatch.from_arrays([bins, batch.column(n), batch.column(n + 1)], names=["bins", "label", COUNT])

    each = rows.select(*values(model.features), F.col(label).cast("int"), F.col(COUNT).cast("long")).mapInArrow(binned, f"bins binary, label int, {COUNT} long")
    return each.groupBy("bins", "label").agg(F.sum(COUNT).alias(COUNT))


def vector_blocks(vectors: DataFrame, features: int) -> DataFrame:
    """(bins, labels, counts): a row per batch of vectors."""
    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, features)
                parts = [x.T.tobytes(), batch.column(1).to_numpy().astype(np.int32).tobytes(), batch.column(2).to_numpy().astype(np.int64).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["bins", "labels", "counts"])

    return vectors.mapInArrow(pack, "bins binary, labels binary, counts binary")


def even_blocks(rows: DataFrame, model: Boosted, label: str, tasks: int) -> DataFrame:
    """``blocks`` in ``tasks`` partitions with as many batches each: a pass takes as
    long as its largest task."""
    return blocks(rows, model, label).repartition(tasks)


def bundles(widths: Sequence[int]) -> list[list[int]]:
    """Features in groups, whose numbers of bins multiply to ``CELLS`` at most (a wider feature alone)."""
    out: list[list[int]] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        fits = next((g for g in out if np.prod([widths[i] for i in (*g, f)], dtype=np.int64) <= CELLS), None)
        if fits is None:
            out.append([f])
        else:
            fits.append(f)
    return out


def bundled(bins: np.ndarray, groups: Sequence[Sequence[int]], widths: Sequence[int]) -> np.ndarray:
    """The cell of every row in every group."""
    out = np.zeros((len(groups), bins.shape[1]), np.uint16)
    for j, group in enumerate(groups):
        for f in group:
            out[j] = out[j] * np.uint16(widths[f]) + bins[f]
    return out


def histograms(margin, bins, y, trees: Sequence[Tree], level: int, width: int, counts=None, cells=None) -> np.ndarray:
    """Sums of (gradient, hessian) by output, node of the level, feature and bin; a
    row stands for as many as ``counts`` says.  ``cells``: groups, widths, ``bundled``
    bins; a group is summed up at once, and its features' sums are taken from that."""
    n, first = len(bins), 1 << level
    groups, widths, codes = cells or ([[f] for f in range(n)], [width] * n, bins)
    sizes = [int(np.prod([widths[f] for f in group])) for group in groups]
    # Nodes above the level, in which others ended, share a cell that is left out.
    cell = np.concatenate((np.full(first, first), np.arange(first)))
    sums = [[np.zeros((2, (first + 1) * size)) for size in sizes] for _ in trees]
    for i in range(0, len(y), CHUNK):
        part = np.ascontiguousarray(bins[:, i:i + CHUNK])
        g, h = (np.ascontiguousarray(v.T) for v in gradients(margin[i:i + CHUNK], y[i:i + CHUNK]))
        if counts is not None:
            g, h = g * counts[i:i + CHUNK], h * counts[i:i + CHUNK]
        for k, tree in enumerate(trees):
            node = cell.take(tree.nodes(part, level))
            for j, size in enumerate(sizes):
                at = node * size + codes[j, i:i + CHUNK]
                sums[k][j][0] += np.bincount(at, g[k], (first + 1) * size)
                sums[k][j][1] += np.bincount(at, h[k], (first + 1) * size)
    out = np.zeros((len(trees), 2, first, n, width))
    for k in range(len(trees)):
        for group, found in zip(groups, sums[k]):
            each = found.reshape(2, first + 1, *[widths[f] for f in group])[:, :first]
            for place, f in enumerate(group):
                others = tuple(2 + i for i in range(len(group)) if i != place)
                out[k, :, :, f, :widths[f]] = each.sum(axis=others)
    return out


def split_gains(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """Gain of every (feature, cut) of a node from its histograms; -inf where a side
    has less than ``least`` hessian."""
    gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    gt, ht = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    gr, hr = gt - gl, ht - hl
    gain = (gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - gt ** 2 / (ht + ridge)) / 2
    return np.where((hl >= least) & (hr >= least), gain, -np.inf)


def grow(tree: Tree, level: int, sums: np.ndarray, step: float, ridge: float, least: float) -> None:
    """Best splits of a level's nodes and the values of their children."""
    first = 1 << level
    for i in range(first):
        g, h = sums[0, i], sums[1, i]
        if level and tree.feature[(first + i) // 2] < 0:
            continue
        gain = split_gains(g, h, ridge, least)
        f, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
        node = first + i
        if not level:
            tree.value[1] = -step * g[0].sum() / (h[0].sum() + ridge)
        if gain[f, c] <= 1e-6:
            continue
        tree.feature[node], tree.cut[node], tree.gain[node] = f, c, gain[f, c]
        for child, part in ((2 * node, slice(None, c + 1)), (2 * node + 1, slice(c + 1, None))):
            tree.value[child] = -step * g[f, part].sum() / (h[f, part].sum() + ridge)


def fit(rows: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 300, depth: int = 5, step: float = 0.05,
        bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Boosted:
    """Boosted trees for labels 0, 1, ... (two classes: logistic, more: softmax)."""
    spark = rows.sparkSession
    kept = written(alike(rows.where(F.col(label).isNotNull()), features, label), "alike")
    classes = int(kept.agg(F.max(label)).first()[0] or 0) + 1
    model = Boosted(list(features), quantile_cuts(kept, features, bins, COUNT), max(2, classes), depth)
    outputs = 1 if model.classes == 2 else model.classes
    met = written(vectors(kept, model, label), "vectors")
    # A task a core, and none for a few rows: a pass is short, more tasks only wait for each other.
    tasks = max(1, min(spark.sparkContext.defaultParallelism, met.count() // ROWS_PER_TASK))
    widths, n = [1 + len(c) for c in model.cuts], len(features)
    width, groups = max(widths, default=1), bundles(widths)
    packed = cut_lineage(vector_blocks(met, n).repartition(tasks))

    def opened(parts):
        """Blocks of up to ``BLOCK`` vectors with their scores."""
        held, size = [], 0
        for r in parts:
            held.append(r)
            size += len(r.labels) // 4
            if size >= BLOCK:
                yield joined(held)
                held, size = [], 0
        if held:
            yield joined(held)

    def joined(held):
        y = np.frombuffer(b"".join(r.labels for r in held), np.int32)
        counts = np.frombuffer(b"".join(r.counts for r in held), np.int64)
        bins = np.concatenate([np.frombuffer(r.bins, np.uint8).reshape(n, -1) for r in held], axis=1)
        return (bins, bundled(bins, groups, widths)), y, counts, np.zeros((len(y), outputs))

    def kept_scores(state, trees):
        return state.map(lambda b: (*b[:3], added(b[3], b[0][0], trees, depth))).persist()

    def pass_over(state, trees, current, level):
        def sums(parts):
            total = np.zeros((outputs, 2, 1 << level, n, width))
            for (x, codes), y, counts, margin in parts:
                total += histograms(added(margin, x, trees, depth), x, y, current, level, width, counts, (groups, widths, codes))
            yield total
        found = state.mapPartitions(sums)
        return found.treeReduce(np.add) if found.getNumPartitions() > 64 else sum(found.collect())

    state = packed.rdd.mapPartitions(opened).persist()
    try:
        if not state.isEmpty():
            fresh = 0
            for r in range(rounds):
                if r - fresh == FRESH:
                    old, state = state, kept_scores(state, model.trees[fresh:])
                    if r % CUT == 0:
                        state.checkpoint()
                    fresh = r
                current = [Tree.empty(depth) for _ in range(outputs)]
                for level in range(depth):
                    sums = pass_over(state, model.trees[fresh:], current, level)
                    for k, tree in enumerate(current):
                        grow(tree, level, sums[k], step, ridge, least)
                    if r == fresh and level == 0 and r:
                        old.unpersist()  # the pass above has filled the new one
                model.trees.append(current)
    finally:
        state.unpersist()
    return model


def with_probabilities(model: Boosted, rows: DataFrame, name: str = "probabilities") -> DataFrame:
    """``rows`` with the probability of every class, as an array."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scored(*columns: pa.Array) -> pa.Array:
        m = shared.value
        x = m.bins([c.to_numpy(zero_copy_only=False) for c in columns])
        p = probabilities(added(np.zeros((x.shape[1], 1 if m.classes == 2 else m.classes)), x, m.trees, m.depth))
        p = np.hstack([1 - p, p]) if p.shape[1] == 1 else p
        return pa.ListArray.from_arrays(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32), pa.array(p.ravel()))

    return rows.withColumn(name, F.arrow_udf(scored, "array<double>")(*values(model.features)))


def first_split_gains(rows: DataFrame, features: Sequence[str], label: str = "label", bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> DataFrame:
    """(feature, cut, gain): every split that the first tree's root can choose from."""
    kept = cut_lineage(rows.select(*features, F.col(label).cast("int").alias(label)).where(F.col(label).isNotNull()))
    model = Boosted(list(features), quantile_cuts(kept, features, bins), 2, 1)
    width, n = 1 + max(map(len, model.cuts), default=0), len(features)

    def sums(parts):
        total = np.zeros((2, n, width))
        for r in parts:
            y = np.frombuffer(r.labels, np.int32)
            x = np.frombuffer(r.bins, np.uint8).reshape(n, len(y))
            total += histograms(np.zeros((len(y), 1)), x, y, [Tree.empty(1)], 0, width)[0, :, 0]
        yield total

    found = blocks(kept, model, label).rdd.mapPartitions(sums).treeReduce(np.add)
    gain = split_gains(found[0], found[1], ridge, least)
    out = [(f, float(cut), float(gain[i, c])) for i, f in enumerate(features) for c, cut in enumerate(model.cuts[i]) if gain[i, c] > -np.inf]
    return rows.sparkSession.createDataFrame(out, "feature string, cut double, gain double")
