"""Finding repeated windows over a whole corpus, as Spark jobs.

A window is ``window`` consecutive codes (bytes or words) of one document.
Which windows occur again is found in these steps:

1. Anchors (one pass over the texts).  Each window is anchored at its ``gram``
   of smallest hash, so that equal windows have equal anchors at equal places.
   Consecutive windows with one anchor form a run; a row holds the anchor's
   hash, the hash of the run's stretch of text, the document and the place.
   There are about 2 / (window - gram + 2) rows a code.
2. Rows whose anchor occurs once in the corpus are dropped (counts combine on
   the map side, so that a frequent anchor costs each task one row).
3. Runs with equal anchor and stretch are one class, whatever their number.  A
   class keeps its number of rows and its first row.
4. Anchors with several classes go to index shards: one stretch of text per
   class is cut from its first document and shipped by anchor.  Shards are
   indexed in chunks of about ``CHUNK`` codes and stream their own stretches
   through the index, which marks the windows that other classes have too.
   An anchor with more than ``MOST_CODES`` codes in its stretches is not put
   into a chunk: its windows are compared by two 64-bit hashes, sums over
   different codes, with an aggregation.
5. Marks return to the rows of their classes and to the documents.

The index of step 4 and the rule which occurrence goes are given by a
:class:`Kind`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import written

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1_000_000
#: Codes of one anchor's stretches beyond which it is not indexed (an anchor is never split).
MOST_CODES = 2 * CHUNK
#: Bytes of documents after which a task hands its stretches on.
OUTPUT = 4 << 20
#: Windows handled at once in one document.
PIECE = 4_000_000
SHIFT = 16  # a place is start << SHIFT | number of windows


@dataclass(frozen=True)
class Kind:
    """``codes(data, memo)``: 64-bit codes of a text (``memo()`` makes what a task
    remembers of them); ``bounds(data)``: first and past-the-last byte of each code;
    ``body_codes(body, memo)``: codes for the index of a stretch of bytes; ``mark(bodies, counts, docs, starts)``: for each stretch the
    indices of its windows that go; ``first_stays``: the first occurrence of a
    window stays (else none does)."""

    window: int
    gram: int
    codes: Callable
    bounds: Callable
    body_codes: Callable
    mark: Callable
    first_stays: bool
    memo: Callable = dict


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            inverse = pow(BASE, -1, 1 << 64)
            self.up, self.down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, inverse, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up, dtype=np.uint64), np.cumprod(self.down, dtype=np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64(salt * 0x2545F4914F6CDD1D % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of the stretches of an array of codes."""

    def __init__(self, codes: np.ndarray, powers: Powers):
        powers.upto(len(codes) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers.up[:len(codes)], dtype=np.uint64)))
        self.down = powers.down

    def of(self, a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
        """Of codes[a:b], element by element."""
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64), salt)

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    out, span = v, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    n = len(v) - width + 1
    return np.minimum(out[:n], out[width - span:width - span + n]) if span < width else out


def runs(codes: np.ndarray, window: int, gram: int, powers: Powers) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, stretch hash, first window, number of windows) of each run."""
    for at in range(0, max(0, len(codes) - window + 1), PIECE):
        part = codes[at:at + PIECE + window - 1]
        rolling = Rolling(part, powers)
        grams = rolling.grams(gram)
        places = np.arange(len(grams), dtype=np.uint64)
        mask = np.uint64((1 << 24) - 1)
        least = (sliding_min((grams & ~mask) | places, window - gram + 1) & mask).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1))
        count = np.diff(np.concatenate((first, [len(least)])))
        yield grams[least[first]].view(np.int64), rolling.of(first, first + count - 1 + window, 1).view(np.int64), first + at, count


def run_rows(docs: DataFrame, kind: Kind) -> DataFrame:
    """Step 1: (key, seg, doc, at)."""

    def run(batches):
        powers, memo = Powers(), kind.memo()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                if data:
                    for key, seg, first, count in runs(kind.codes(data, memo), kind.window, kind.gram, powers):
                        for column, x in zip(out, (key, seg, np.full(len(key), doc), (first << SHIFT) | count)):
                            column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["key", "seg", "doc", "at"])

    return docs.select("doc", "data").mapInArrow(run, "key long, seg long, doc long, at long")


def _stretches(docs: DataFrame, carriers: DataFrame, kind: Kind, schema: str, emit: Callable) -> DataFrame:
    """For each document with carriers, ``emit(data, codes, doc, carriers)`` gives columns of ``schema``."""
    per_doc = carriers.groupBy(F.col("doc").alias("__doc")).agg(F.collect_list(F.struct("key", "seg", "at", "rows")).alias("c"))
    # All columns of docs pass, so that this exchange of the texts serves the last join too.
    met = docs.join(per_doc, F.col("doc") == F.col("__doc"), "left").where("c is not null").select(*docs.columns, "c")
    at = [docs.columns.index(c) for c in ("doc", "data")] + [len(docs.columns)]
    fields = [x.split() for x in schema.split(", ")]
    arrow = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}

    def run(batches):
        powers, memo = Powers(), kind.memo()
        for batch in batches:
            out, size = [[] for _ in fields], 0
            for row in zip(*(batch.column(i) for i in at)):
                doc, data, carried = (x.as_py() for x in row)
                for column, x in zip(out, emit(data, doc, carried, powers, memo)):
                    column.extend(x)
                size += len(data)
                if size > OUTPUT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, (_, t) in zip(out, fields)], names=[n for n, _ in fields])
                    out, size = [[] for _ in fields], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, (_, t) in zip(out, fields)], names=[n for n, _ in fields])

    return met.mapInArrow(run, schema)


def _bodies(kind: Kind):
    def emit(data, doc, carriers, powers, memo):
        first = [c["at"] >> SHIFT for c in carriers]
        count = [c["at"] & ((1 << SHIFT) - 1) for c in carriers]
        begin, past = kind.bounds(data)
        return ([c["key"] for c in carriers], [c["seg"] for c in carriers], [doc] * len(carriers), first, count,
                [data[begin[a]:past[a + n - 2 + kind.window]] for a, n in zip(first, count)])
    return emit


def _window_hashes(kind: Kind):
    def emit(data, doc, carriers, powers, memo):
        codes = kind.codes(data, memo)
        rolling, other = Rolling(codes, powers), Rolling(mix(codes, 7), powers)
        out = [[], [], [], [], [], []]
        for c in carriers:
            a, n = c["at"] >> SHIFT, c["at"] & ((1 << SHIFT) - 1)
            starts = np.arange(a, a + n)
            for column, x in zip(out, (np.full(n, c["key"]), np.full(n, c["seg"]), np.full(n, doc), starts,
                                       rolling.of(starts, starts + kind.window, 2).view(np.int64),
                                       other.of(starts, starts + kind.window, 3).view(np.int64))):
                column.append(x)
        return [np.concatenate(c).tolist() for c in out]
    return emit


def _index_chunks(batches, kind: Kind):
    """Step 4 in a task: whole anchors, sorted, in chunks of about CHUNK codes.

    The rows of a document given several times ship the same stretch; a class
    has one in the index."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    memo = kind.memo()

    def flush():
        whole = pa.Table.from_batches(held)
        key, seg, doc, first, count = (whole.column(c).to_numpy() for c in ("key", "seg", "doc", "first", "count"))
        marks = kind.mark([kind.body_codes(b.as_py(), memo) for b in whole.column("body")], count, doc, first)
        some = [i for i, m in enumerate(marks) if len(m)]
        yield pa.RecordBatch.from_arrays([
            pa.array(key[some]), pa.array(seg[some]), pa.array([marks[i].tolist() for i in some], pa.list_(pa.int32()))],
            names=["key", "seg", "marks"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, segs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.concatenate(([(keys[0], segs[0]) != last], (keys[1:] != keys[:-1]) | (segs[1:] != segs[:-1])))
        last = keys[-1], segs[-1]
        if not new.all():
            batch = batch.filter(pa.array(new))
            keys = keys[new]
            if not len(keys):
                continue
        ends = np.concatenate((np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
        weight = np.diff(np.concatenate(([0], np.cumsum(batch.column(4).to_numpy() + kind.window)[ends - 1])))
        at = 0
        for end, w in zip(ends.tolist(), weight.tolist()):
            new = not held or held[-1].column(0)[held[-1].num_rows - 1].as_py() != int(keys[at])
            if new and size and size + w > CHUNK:
                yield from flush()
                held, size = [], 0
            held.append(batch.slice(at, end - at))
            size += w
            at = end
    if held:
        yield from flush()


def removed_windows(docs: DataFrame, kind: Kind, max_classes: int | None = None) -> DataFrame:
    """(doc, hits): windows that go, by document of ``docs`` (doc long, data binary).

    A hit is a run of windows (``at``) of which all go (``marks`` null) or those marked.
    ``max_classes``: anchors of more classes are not indexed either.
    """
    rows = written(run_rows(docs, kind), "places")
    # Written first: between two plain shuffles Spark can split a frequent anchor's partition.
    often = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often", True)
    rows = written(rows.join(often, "key"), "runs", True)
    classes = written(rows.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc", "at")).alias("first"))
                      .select("key", "seg", "rows", "first.doc", "first.at"), "classes", True)
    codes = F.col("at").bitwiseAND((1 << SHIFT) - 1) + kind.window
    wide = F.col("codes") > MOST_CODES
    if max_classes is not None:
        wide = wide | (F.col("classes") > max_classes)
    per_key = (classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum(codes).alias("codes")).where("classes > 1")
               .select("key", wide.alias("wide")))
    several = classes.join(per_key, "key")

    bodies = _stretches(docs, several.where("not wide"), kind,
                        "key long, seg long, doc long, first long, count int, body binary", _bodies(kind))
    marks = (bodies.repartition("key").sortWithinPartitions("key", "seg")
             .mapInArrow(lambda b: _index_chunks(b, kind), "key long, seg long, marks array<int>"))
    if not per_key.where("wide").isEmpty():
        hashed = _stretches(docs, several.where("wide"), kind,
                            "key long, seg long, doc long, start long, h1 long, h2 long", _window_hashes(kind))
        same = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "start")).alias("least")).where("n > 1")
        gone = hashed.join(same, ["h1", "h2"])
        if kind.first_stays:
            gone = gone.where((F.col("doc") != F.col("least.doc")) | (F.col("start") != F.col("least.start")))
        starts = several.select("key", "seg", F.shiftright("at", SHIFT).alias("a"))
        marks = marks.unionByName(gone.join(starts, ["key", "seg"]).groupBy("key", "seg").agg(
            F.array_sort(F.collect_list((F.col("start") - F.col("a")).cast("int"))).alias("marks")))

    # Rows of a class that go whole, or by the marks of the class.
    if kind.first_stays:
        whole = (F.col("doc") != F.col("first_doc")) | (F.col("at") != F.col("first_at"))
    else:
        whole = F.col("rows") > 1
    known = classes.select("key", "seg", "rows", F.col("doc").alias("first_doc"), F.col("at").alias("first_at"))
    # Written too, so that a class of very many rows is split in the join.
    known = written(known.join(marks, ["key", "seg"], "left").where("rows > 1 or marks is not null"), "marked", True)
    hits = (rows.join(known, ["key", "seg"])
            .withColumn("marks", F.when(~whole, F.col("marks"))).where(whole | F.col("marks").isNotNull()))
    return hits.groupBy("doc").agg(F.collect_list(F.struct("at", "marks")).alias("hits"))


def covered(n: int, window: int, hits: list) -> np.ndarray:
    """Which of n codes lie in a window that goes."""
    steps = np.zeros(n + 1, np.int64)
    for h in hits or ():
        a, count = h["at"] >> SHIFT, h["at"] & ((1 << SHIFT) - 1)
        if h["marks"] is None:
            steps[a] += 1
            steps[a + count - 1 + window] -= 1
        else:
            starts = a + np.asarray(h["marks"], np.int64)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + window, -1)
    return np.cumsum(steps)[:n] > 0


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, data, doc_id): ``doc`` orders documents as their ids do.

    Usually the id itself.  Where ids are null or repeat, documents - distinct
    (id, text) - are numbered in the order of id (null first) and text digest.
    """
    slim = docs.select("doc_id")
    plain = slim.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty()
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    if plain:
        return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"), data.alias("data"), "doc_id")
    keyed = docs.select("doc_id", data.alias("data")).withColumn("digest", F.sha2("data", 256))
    order = written(keyed.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
                    .sort(F.asc_nulls_first("__id"), "__digest").withColumn("doc", F.monotonically_increasing_id()), "numbers")
    return keyed.join(order, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))).select("doc", "data", "doc_id")


def suffix_order(keys: np.ndarray, step: int = 1) -> np.ndarray:
    """Starts of the suffixes of a text in sorted order, by doubling.  A key
    stands for the ``step`` signs from its place on; only suffixes not yet told
    apart are sorted again."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(keys)
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    todo = order[_shared(new)]
    while len(todo):
        after = np.where(todo + step < n, rank[np.minimum(todo + step, n - 1)] + 1, 0)
        at = np.argsort(rank[todo] * np.int64(n + 2) + after)
        todo, after = todo[at], after[at]
        old = rank[todo]
        new_group = np.concatenate(([True], old[1:] != old[:-1]))
        new = new_group | np.concatenate(([True], after[1:] != after[:-1]))
        # A group keeps its first rank; its parts follow by their place in it.
        place = np.arange(len(todo))
        group = np.maximum.accumulate(np.where(new_group, place, 0))
        part = np.maximum.accumulate(np.where(new, place, 0))
        rank[todo] = old + part - group
        todo = todo[_shared(new)]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def _shared(new: np.ndarray) -> np.ndarray:
    """Which places of a sorted list belong to a part of two or more."""
    return ~(new & np.concatenate((new[1:], [True])))
