"""N-gram Jaccard self-join by chosen paths.

A document is the set of its word shingles (``shingle`` consecutive words;
a text of fewer words, but not none, is one shingle).  Documents with equal
sets form one node.  Each node carries ``COORDS`` min-hash coordinates, the
tokens of which a path samples: two nodes share a coordinate with a
probability that equals their similarity.

1. Chosen paths.  Every run starts a path from a coordinate of its own and
   deals the nodes into buckets.  Buckets of up to ``small`` nodes are compared
   by brute force; larger ones split on the run's next coordinate, up to
   ``depth`` times.  What is still large then (a group of near copies) is
   compared block by block, so that no task holds a group.  The number of runs
   follows from the target recall at the threshold and the full depth.
   Comparing means estimating the similarity from the coordinates; nodes above
   a safe margin below the threshold are tied together by a spanning forest,
   never by all pairs.
2. Ties are contracted to components, supersets of the true classes.
3. Within components, block against block, exact similarities are counted from
   the shingle sets: each node's links, and a spanning forest of true links.
   The forest's components are the classes.

Defined results
* null, empty and word-free texts have no shingles: a class of their own each,
  no links; they are never near copies of each other;
* repeated rows and equal texts share a node and count as links of each other;
* ``class_id`` is the smallest doc_id of the class (null only if all are null),
  ``n_links`` the number of other rows with a similarity of at least
  ``threshold``, ``n_texts`` the number of other different sets among them;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import release_memory, written
from devicegrid.llm.components import components
from devicegrid.llm.decontaminate import words_of

COORDS = 96
DEPTH = 4
MEMO = 150_000
#: Hashes of a block of sets, and of the sets compared at once.
WEIGHT, PART = 2_000_000, 500_000
_RNG = np.random.Generator(np.random.PCG64(20240607))
#: Odd multipliers of the coordinates and of a shingle's words.
FACTORS = _RNG.integers(1, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)
WORD_FACTORS = _RNG.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingler(shingle: int):
    """A function text (bytes) -> sorted distinct 64-bit shingle hashes."""
    memo: dict[bytes, int] = {}

    def shingles(text: bytes | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        if len(memo) > MEMO:
            memo.clear()
        codes = []
        for w in words:
            c = memo.get(w)
            if c is None:
                c = memo[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
            codes.append(c)
        codes = np.array(codes, np.uint64)
        size = min(shingle, len(codes))
        h = np.full(len(codes) - size + 1, size, np.uint64)
        for j in range(size):
            h = (h ^ codes[j:len(codes) - size + 1 + j]) * WORD_FACTORS[j % 64]
            h ^= h >> np.uint64(32)
        return np.unique(h)

    return shingles


def sketch(hashes: np.ndarray) -> np.ndarray:
    """COORDS min-hash values of 32 bits."""
    out = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):
        part = hashes[None, i:i + 4096] * FACTORS[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has shared a bucket with probability ``recall``."""
    runs = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth))
    if runs > COORDS // depth:
        raise ValueError(f"threshold {threshold} with recall {recall} needs {runs} runs of {depth} coordinates; there are {COORDS}")
    return runs


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph on 0..n-1 with edges (a, b)."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def groups_of(batches, key: list[str]):
    """Dicts of columns for each run of equal keys in sorted batches."""
    held: list[pa.RecordBatch] = []

    def flush():
        if held:
            whole = pa.Table.from_batches(held)
            # Hashes stay where Arrow has them.
            yield {c: [x.as_buffer() for x in whole.column(c)] if c == "hashes" else whole.column(c).to_pylist() for c in whole.column_names}
            held.clear()

    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in key)))
        at = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                if keys[at] != last:
                    yield from flush()
                    last = keys[at]
                held.append(batch.slice(at, i - at))
                at = i
    yield from flush()


def blocked(rows: DataFrame, group: list[str], size: DataFrame, node: str, block: int) -> DataFrame:
    """Deal the rows of each group to pairs of blocks of about ``block`` nodes.

    Each node meets every other node of its group in exactly one pair (i, j),
    i <= j; a node of a group of b blocks is sent to b pairs.  Groups of up to
    ``block`` nodes have the one pair (0, 0).  Adds ``__pi``, ``__pj``, ``__own``.
    """
    sized = rows.join(size, group)
    b = F.ceil(F.col("__n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(node)), b).cast("int")
    return (sized.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), b - 1)))
            .withColumn("__pi", F.least("__own", "__other")).withColumn("__pj", F.greatest("__own", "__other")))


def nodes_of(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: doc_id, node (16 bytes of the set's digest, null without words), its
    size, its min-hash coordinates and, to compare by, the low byte of each."""

    def run(batches):
        shingles = shingler(shingle)
        for batch in batches:
            ids, sketches, sizes = [], [], []
            for text in batch.column(1):
                h = shingles(text.as_py())
                sizes.append(len(h))
                ids.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                sketches.append(sketch(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array([None if s is None else s.tobytes() for s in sketches], pa.binary()),
                pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in sketches], pa.binary())],
                names=["doc_id", "node", "size", "sketch", "brief"])
        del shingles
        release_memory()

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, size long, sketch binary, brief binary")


def _paths(sketches: DataFrame, runs: int, depth: int) -> DataFrame:
    """(path, rest, node): the first bucket of each run, and the run's next coordinates."""

    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(nodes), COORDS)
            values = values[:, :runs * depth].reshape(len(nodes), runs, depth)
            path = values[:, :, 0].astype(np.int64) * 64 + np.arange(runs)
            rest = np.ascontiguousarray(values[:, :, 1:])
            yield pa.RecordBatch.from_arrays([
                pa.array(path.ravel()),
                pa.array([r.tobytes() for row in rest for r in row], pa.binary()),
                pa.array([n for n in nodes for _ in range(runs)], pa.binary())], names=["path", "rest", "node"])
        release_memory()

    return sketches.select("node", "sketch").mapInArrow(run, "path long, rest binary, node binary")


def _buckets(sketches: DataFrame, runs: int, depth: int, small: int) -> DataFrame:
    """(path, node, __n): the buckets to compare, of two nodes at least."""
    level = _paths(sketches, runs, depth)
    done = None
    for d in range(depth):
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        met = written(level.join(counts, "path"), "paths")
        last = d == depth - 1
        ready = (met if last else met.where(F.col("__n") <= small)).select("path", "node", "__n")
        done = ready if done is None else done.unionByName(ready)
        if last:
            break
        large = met.where(F.col("__n") > small)
        if large.isEmpty():
            break
        token = F.substring(F.col("rest"), 1 + 4 * d, 4)
        level = large.select(F.xxhash64("path", token).alias("path"), "rest", "node")
    return done


def _compare_sketches(batches, margin: float):
    for g in groups_of(batches, ["path", "__pi", "__pj"]):
        s = np.frombuffer(b"".join(g["brief"]), np.uint8).reshape(len(g["node"]), COORDS)
        a, b = [], []
        mixed = g["__pi"][0] != g["__pj"][0]
        own = np.array(g["__own"])
        for i in range(len(s) - 1):
            near = np.flatnonzero((s[i + 1:] == s[i]).mean(axis=1) >= margin) + i + 1
            if mixed:
                near = near[own[near] != own[i]]
            a.append(np.full(len(near), i))
            b.append(near)
        if a:
            kept = forest(len(s), np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array([g["node"][x] for x, _ in kept], pa.binary()),
                                              pa.array([g["node"][y] for _, y in kept], pa.binary())], names=["a", "b"])
    release_memory()


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of shared hashes, a range of hashes at a time (sets are sorted)."""
    parts = 1 + (sum(map(len, left)) + sum(map(len, right))) // PART
    cuts = np.array([(1 << 64) * k // parts for k in range(1, parts)], np.uint64)
    at = [[0, *np.searchsorted(x, cuts).tolist(), len(x)] for x in (*left, *right)]
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(parts):
        some = [x[a[k]:a[k + 1]] for x, a in zip((*left, *right), at)]
        out += _shared(some[:len(left)], some[len(left):])
    return out


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The same by products over blocks of columns."""
    flat = np.concatenate(left + right)
    values, at = np.unique(flat, return_inverse=True)
    often = np.bincount(at) > 1
    column = np.where(often, np.cumsum(often) - 1, -1)[at]
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    keep = column >= 0
    order = np.argsort(column[keep], kind="stable")
    row, column = row[keep][order], column[keep][order]
    out = np.zeros((len(left), len(right)), np.float32)
    step = 8192
    for c in range(0, int(often.sum()), step):
        lo, hi = np.searchsorted(column, (c, c + step))
        m = np.zeros((len(left) + len(right), step), np.float32)
        m[row[lo:hi], column[lo:hi] - c] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _compare_sets(batches, threshold: float):
    """(node, links, texts, other): a node's links in this pair of blocks; edges of the forest."""
    for g in groups_of(batches, ["label", "__pi", "__pj"]):
        first = {n: i for i, n in reversed(list(enumerate(g["node"])))}  # a node may come with several rows
        at = sorted(first.values())
        sets = [np.frombuffer(g["hashes"][i], np.uint64) for i in at]
        copies, own = np.array([g["copies"][i] for i in at], np.int64), np.array([g["__own"][i] for i in at])
        nodes, sizes = [g["node"][i] for i in at], np.array([len(s) for s in sets], np.float64)
        mixed = g["__pi"][0] != g["__pj"][0]
        left = np.flatnonzero(own == g["__pi"][0])
        right = np.flatnonzero(own == g["__pj"][0]) if mixed else left
        if not len(left) or not len(right):
            continue
        both = _common([sets[i] for i in left], [sets[i] for i in right]).astype(np.float64)
        # Exact in integers: |x & y| / |x | y| >= t.
        near = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9
        if not mixed:
            np.fill_diagonal(near, False)
        links, texts = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        links[left] += near.astype(np.int64) @ copies[right]
        texts[left] += near.sum(axis=1)
        if mixed:
            links[right] += near.T.astype(np.int64) @ copies[left]
            texts[right] += near.sum(axis=0)
        x, y = np.nonzero(near)
        kept = forest(len(nodes), left[x], right[y])
        some = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([
            pa.array([nodes[i] for i in some] + [nodes[a] for a, _ in kept], pa.binary()),
            pa.array(links[some].tolist() + [0] * len(kept), pa.int64()),
            pa.array(texts[some].tolist() + [0] * len(kept), pa.int64()),
            pa.array([None] * len(some) + [nodes[b] for _, b in kept], pa.binary())], names=["node", "links", "texts", "other"])
    release_memory()


def join_classes(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, recall: float = 0.99999,
                 small: int = 256, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links, n_texts, class_rows``."""
    rows = written(nodes_of(docs, shingle), "nodes")
    worded = rows.where("node is not null")
    nodes = worded.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.max("size").alias("size"))
    sketches = written(worded.select("node", "sketch", "brief").dropDuplicates(["node"]), "sketches")  # equal for equal nodes

    # 1. Chosen paths.
    margin = max(0.0, threshold - 4.5 * math.sqrt(threshold * (1 - threshold) / COORDS))
    sizes = _buckets(sketches, runs_for(threshold, recall, depth), depth, small)
    dealt = blocked(sizes.drop("__n"), ["path"], sizes.groupBy("path").agg(F.max("__n").alias("__n")), "node", small)
    ties = (dealt.select("path", "__pi", "__pj", "__own", "node").join(sketches.select("node", "brief"), "node")
            .repartition("path", "__pi", "__pj").sortWithinPartitions("path", "__pi", "__pj", "node")
            .select("path", "__pi", "__pj", "__own", "node", "brief")
            .mapInArrow(lambda b: _compare_sketches(b, margin), "a binary, b binary"))

    # 2. Components of the ties.
    groups = written(components(ties).join(nodes, "node").select("node", "label", "copies", "rep", "size"), "ties")

    # 3. Exact similarities within components.
    wanted = groups.select(F.col("rep").alias("__rep"), "node", "label", "copies")
    # Merge join at every size: the texts' shuffle is to grow with the texts, not
    # to set in where the members outgrow a broadcast.
    found = docs.select("doc_id", F.col("text").cast("binary").alias("__text")).join(
        wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__rep"))).select("label", "node", "copies", "__text")

    def sets(batches):
        shingles = shingler(shingle)
        for batch in batches:
            hashes, keep = [], []
            for node, text in zip(batch.column(1).to_pylist(), batch.column(3)):
                h = shingles(text.as_py())
                # A doc_id may be given to several texts; the node's own is wanted.
                keep.append(len(h) > 0 and hashlib.blake2b(h.tobytes(), digest_size=16).digest() == node)
                hashes.append(h.tobytes())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(hashes, pa.binary())],
                                             names=["label", "node", "copies", "hashes"])
            yield out.filter(pa.array(keep, pa.bool_()))
        del shingles
        release_memory()

    members = found.mapInArrow(sets, "label binary, node binary, copies long, hashes binary")
    # A group of long texts counts as more nodes, so that blocks are bounded by their hashes too.
    weight = groups.groupBy("label").agg(F.greatest(F.count(F.lit(1)), F.ceil(F.sum("size") * small / WEIGHT)).alias("__n"))
    pairs = (blocked(members, ["label"], weight, "node", small)
             .select("label", "__pi", "__pj", "__own", "node", "copies", "hashes")
             .repartition("label", "__pi", "__pj").sortWithinPartitions("label", "__pi", "__pj", "node"))
    exact = written(pairs.mapInArrow(lambda b: _compare_sets(b, threshold), "node binary, links long, texts long, other binary"), "links")
    degrees = exact.where("other is null").groupBy("node").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    classes = components(exact.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))

    per_node = (nodes.drop("size").join(degrees, "node", "left").join(classes, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    per_class = per_node.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_rows"))
    answers = per_node.join(per_class, "label").select(
        "node", "class_id", "class_rows", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"))
    return worded.select("doc_id", "node").join(answers, "node").select("doc_id", "class_id", "n_links", "n_texts", "class_rows").unionByName(
        rows.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                          F.lit(0).cast("long").alias("n_texts"), F.lit(1).cast("long").alias("class_rows")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without those whose class has a smaller doc_id; a
    text without words stays.  Of rows that repeat the smallest doc_id of their
    class all stay (drop exact copies before)."""
    marks = join_classes(docs, **options).where(F.col("class_id") != F.col("doc_id")).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(marks.hint("merge"), F.col("doc_id") == F.col("__id"), "left_anti")
