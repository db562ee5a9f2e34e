"""Periodic runs of words: stretches that repeat one period at least twice.

A run is a maximal stretch of words of one text with a smallest period q (words
q apart are identical) whose length is at least ``least`` and at least 2 q.
Spark spreads the texts; a task takes them in chunks of about ``CHUNK`` words
and finds the runs of a chunk by descending-LCP Kruskal:

1. Every word becomes a number, every six words (half of ``least``) a class of
   their own document, by exact ranks.  A run of period q and length n makes its
   starts s and s + q agree over n - q >= least / 2 words, so that only positions
   whose class occurs again can matter; prose has few.
2. These suffixes are sorted by doubling, and neighbours in that order get their
   common length (LCP) along the text, each from the one before less one.
3. Neighbours are united by decreasing LCP (union-find); a class keeps its
   positions in order.  Uniting two classes at LCP l makes positions u < v
   newly adjacent.  If v - u <= l, the words from u to v + l have the period
   v - u, and no smaller one, as u plus a smaller one would agree with u over
   more than l words and so stand between them already (nor, for that reason,
   does a place that the same level adds later).  Where the words before u and v
   differ, that is a run; so each is found once, at its own start.

Defined results: a null text has no words and no runs; an empty table gives an
empty one; a row is judged on its own, so that repeated rows, null or repeated
ids come back as given; kept columns named like a result column (``runs``,
``collapsed``) give way to it; a text of any length is taken whole, by one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import text_of
from devicegrid.llm.repeats import suffix_order

#: Words that a task looks at together (a longer text is a chunk of its own).
CHUNK = 400_000
RUN = "array<struct<start:long,length:long,period:long>>"


def ranks(keys: np.ndarray) -> np.ndarray:
    """Place of each key among the different keys in order."""
    order = np.argsort(keys)
    new = np.concatenate(([False], keys[order][1:] != keys[order][:-1]))
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


def gram_classes(codes: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Exact class of the ``size`` codes from each place on, within a document.

    As many ranks as fit are packed into 62 bits and ranked anew, until they
    span ``size`` codes; the last one may overlap the one before.
    """
    out, span = codes, 1
    while span < size:
        base = int(out.max()) + 2
        many = min(62 // base.bit_length(), -(-size // span))
        keys = out + 1
        for k in range(1, many):
            step = min(k * span, size - span)
            ahead = np.zeros_like(out)
            ahead[:-step] = out[step:] + 1
            keys = keys * base + ahead
        out, span = ranks(keys), min(size, many * span)
    return ranks(out * np.int64(int(doc[-1]) + 1) + doc)


def neighbours(codes: np.ndarray, classes: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, LCP) of suffixes that follow each other in sorted order and share ``gram`` codes."""
    order = suffix_order(classes, gram)
    same = classes[order[1:]] == classes[order[:-1]]
    before = np.full(len(codes), -1)
    before[order[1:][same]] = order[:-1][same]
    at = np.flatnonzero(before >= 0)
    words, lcp, length, last = codes.tolist(), [], 0, -2
    n = len(words)
    for i, j in zip(at.tolist(), before[at].tolist()):
        length = max(gram, length - 1) if last == i - 1 else gram
        far = max(i, j)
        while far + length < n and words[i + length] == words[j + length]:
            length += 1
        lcp.append(length)
        last = i
    return at, before[at], np.array(lcp, np.int64)


def seeds(i: np.ndarray, j: np.ndarray, lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(u, v, l): positions at most l apart, newly adjacent in the union at LCP l."""
    parent: dict[int, int] = {}
    sets: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    order = np.argsort(-lcp, kind="stable")
    for a, b, length in zip(i[order].tolist(), j[order].tolist(), lcp[order].tolist()):
        a, b = root(a), root(b)
        small, large = sets.pop(a, None) or [a], sets.pop(b, None) or [b]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        parent[a] = b
        many = len(small) * 8 > len(large) > 64
        for m, x in enumerate(small):
            k = bisect_left(large, x)
            if k and (not m or small[m - 1] < large[k - 1]) and x - large[k - 1] <= length and x - large[k - 1] + length >= least:
                yield large[k - 1], x, length
            if k < len(large) and (m + 1 == len(small) or small[m + 1] > large[k]) and large[k] - x <= length and large[k] - x + length >= least:
                yield x, large[k], length
        if many:
            large = sorted(small + large)
        else:
            for x in small:
                insort(large, x)
        sets[b] = large


def chunk_runs(codes: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in the codes of several documents, which
    separators that occur once keep apart."""
    gram = -(-least // 2)
    if len(codes) <= gram:
        return []
    classes = gram_classes(codes, doc, gram)
    if int(classes.max()) + 1 == len(classes):
        return []
    found = seeds(*neighbours(codes, classes, gram), least)
    return sorted((u, v - u + length, v - u) for u, v, length in found if u == 0 or codes[u - 1] != codes[v - 1])


def texts_runs(texts: Sequence[bytes], least: int = 12) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """For each text its runs by start and period, and its words without the repeats."""
    number = defaultdict(count().__next__)
    words = [t.split() for t in texts]  # bytes split at 0x20 and 0x09-0x0D only
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    ends = np.cumsum(sizes)
    codes = np.empty(int(ends[-1]), np.int64)
    for w, end in zip(words, ends.tolist()):
        codes[end - 1 - len(w):end - 1] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
    codes[ends - 1] = len(number) + np.arange(len(ends))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts = ends - sizes
    found = chunk_runs(codes, np.repeat(np.arange(len(ends)), sizes), least)
    steps = np.zeros(len(codes) + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    if found:
        of = np.searchsorted(ends, [f[0] for f in found], side="right")
        for k, (start, length, period) in zip(of.tolist(), found):
            out[k].append((start - int(starts[k]), length, period))
    kept = np.cumsum(steps)[:-1] == 0
    collapsed = []
    for w, runs, start in zip(words, out, starts.tolist()):
        if runs:
            w = [x for x, k in zip(w, kept[start:start + len(w)].tolist()) if k]
        collapsed.append(b" ".join(w))
    return out, collapsed


def find_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str | Column = "text", least: int = 12) -> DataFrame:
    """``keep`` columns, ``runs`` (by start, then period; places are word numbers
    from 0) and ``collapsed``: the words without those that a run contains after
    its first period, joined by one space."""
    kept = [c for c in keep if c not in ("runs", "collapsed")]
    body = text_of(text) if isinstance(text, str) else F.coalesce(text, F.lit(""))
    slim = docs.select(*[F.col(c) for c in kept], body.cast("binary").alias("__text"))
    pair = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        def done(batch, at, end, texts):
            runs, collapsed = texts_runs(texts, least)
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(pair))
            part = batch.slice(at, end - at)
            return pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(offsets, structs), pa.array([c.decode() for c in collapsed], pa.string())],
                names=[*kept, "runs", "collapsed"])

        for batch in batches:
            texts, at, size = [], 0, 0
            for k, value in enumerate(batch.column(batch.num_columns - 1)):
                texts.append(value.as_py())
                size += len(texts[-1])
                if size > 6 * CHUNK:
                    yield done(batch, at, k + 1, texts)
                    texts, at, size = [], k + 1, 0
            if texts:
                yield done(batch, at, batch.num_rows, texts)

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in slim.schema.fields[:-1])
    return slim.mapInArrow(run, f"{types}runs {RUN}, collapsed string")
