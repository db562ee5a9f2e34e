"""Repeated byte strings by a run-length index of the Burrows-Wheeler transform.

The corpus work - which stretches can repeat, who gets what - is done by the
Spark jobs of ``repeats``.  Within a shard, the stretches are concatenated with
separators and sorted into a suffix order; the Burrows-Wheeler transform is
kept as runs with a sample of the suffix order at both ends of each run.  The
matching statistics of all stretches then follow by streaming over them: at a
run's ends the longest match is compared directly with the sample next to it,
and between run ends a match is one shorter than at the byte before.  In
repetitive texts there are few runs.

Defined results
* a null text counts as empty; texts shorter than ``window`` lose nothing;
* repeated rows and equal texts are copies: all bytes of those of ``window``
  bytes or more go; overlapping windows count, matches cross no document;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.repeats import Kind, covered, numbered, removed_windows, suffix_order

WINDOW, GRAM = 400, 128
#: A random 64-bit code for each byte.
BYTE_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
PACK, BITS = 7, 9


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of ``text`` (1..256, 0 separates)
    with samples of the suffix order at their first and last places."""

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        padded = np.concatenate((text.astype(np.int64), np.zeros(PACK, np.int64)))
        self.packed = np.zeros(n, np.int64)
        for j in range(PACK):
            self.packed = (self.packed << BITS) | padded[j:n + j]
        order = suffix_order(self.packed, PACK)
        before = text[order - 1]
        # The first suffix has no byte before it: it ends a run on both sides.
        edge = np.concatenate(([True], (before[1:] != before[:-1]) | (order[1:] == 0) | (order[:-1] == 0)))
        heads = np.flatnonzero(edge)
        self.symbols, self.lengths = before[heads], np.diff(np.concatenate((heads, [n])))
        self.first, self.last = order[heads], order[heads + self.lengths - 1]

    def _match(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, element by element."""
        n, out = len(self.text), np.zeros(len(x), np.int64)
        active = np.arange(len(x))
        while len(active):
            a, b = x[active] + out[active], y[active] + out[active]
            inside = (a < n) & (b < n)
            left, right = self.packed[np.minimum(a, n - 1)], self.packed[np.minimum(b, n - 1)]
            same = inside & (left == right)
            stop = inside & ~same
            differ = left[stop] ^ right[stop]
            out[active[stop]] += sum((differ >> (BITS * j)) == 0 for j in range(1, PACK))
            active = active[same]
            out[active] += PACK
        return np.minimum(out, n - np.maximum(x, y))

    def statistics(self) -> np.ndarray:
        """For each place of the text the length of its longest match elsewhere."""
        n = len(self.text)
        place, reach = np.arange(n), np.zeros(n, np.int64)
        for x, y in ((self.first[1:], self.last[:-1]), (self.last[:-1], self.first[1:])):
            ends = np.zeros(n, np.int64)
            ends[x] = x + self._match(x, y)
            reach = np.maximum(reach, np.maximum.accumulate(ends) - place)
        return reach


def mark(bodies: list[np.ndarray], counts, docs, starts, window: int = WINDOW) -> list[np.ndarray]:
    """Windows (by index in each stretch) that occur elsewhere among the stretches."""
    sizes = np.array([len(b) for b in bodies])
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    text = np.zeros(at[-1], np.int64)
    for b, a in zip(bodies, at):
        text[a:a + len(b)] = b
    again = RunLengthIndex(text).statistics() >= window
    return [np.flatnonzero(again[a:a + n]) for a, n in zip(at, counts)]


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(
        window, gram,
        codes=lambda data, memo: BYTE_CODES[np.frombuffer(data, np.uint8)],
        bounds=lambda data: (range(len(data)), range(1, len(data) + 1)),
        body_codes=lambda body, memo: np.frombuffer(body, np.uint8).astype(np.int64) + 1,
        mark=lambda bodies, counts, docs, starts: mark(bodies, counts, docs, starts, window),
        first_stays=False)


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_classes: int | None = None, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and ``kept`` (binary) if asked for."""
    rows = numbered(docs)
    hits = removed_windows(rows, kind(window, gram), max_classes)
    met = rows.join(hits.withColumnRenamed("doc", "__doc"), F.col("doc") == F.col("__doc"), "left").select("doc_id", "data", "hits")

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for data, found in zip(batch.column(1), batch.column(2)):
                data, found = data.as_py(), found.as_py()
                gone = covered(len(data), window, found) if found else None
                kept = data if gone is None else np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = 0 if gone is None else int(np.count_nonzero(np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1))
                for column, x in zip(out, (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    column.append(x)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(out[4], pa.binary())] if with_text else []),
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return met.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, "
                               "n_spans long, kept_sha256 string" + ", kept binary" * with_text)
