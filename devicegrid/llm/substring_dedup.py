"""Repeated word sequences by a compressed FM-index per shard.

The corpus work is done by the Spark jobs of ``repeats``.  Within a shard, the
stretches of words are concatenated with separators; the index keeps the
Burrows-Wheeler transform as a wavelet matrix of packed bits with sampled
counts.  The stretches are streamed against it by backward search, all windows
side by side, word by word from the right; a window leaves the search as soon
as its interval holds nothing but itself.  Windows whose matching statistics
reach the threshold share an interval with their equals, of which the first
occurrence - smallest document, then earliest start - stays.

Defined results
* words are maximal runs of anything but space and the control signs 9 to 13,
  unchanged; a null text has none; fewer words than ``window`` lose nothing;
* rows that repeat both id and text are one document and fare alike; ids that
  are null come first, one id with several texts is ordered by text digest;
* words are compared by 64-bit hashes;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.repeats import BASE, Kind, covered, mix, numbered, removed_windows, suffix_order

WINDOW, GRAM = 20, 4
BASE64 = np.uint64(BASE)
#: Masks of the first 0 to 8 bytes.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word."""
    edges = np.diff(np.concatenate(([0], (~SPACE[raw]).view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_codes(data: bytes, memo: dict) -> np.ndarray:
    """A 64-bit hash of each word: eight bytes after eight, each mixed into what
    came before; a digest for words of more than 64 bytes."""
    raw = np.frombuffer(data + bytes(8), np.uint8)
    begin, past = word_bounds(raw[:len(data)])
    eight = np.ndarray((len(data) + 1,), "<u8", raw, strides=(1,))
    size = past - begin
    codes = mix(size.astype(np.uint64), 5)
    which, at, left = np.arange(len(size)), begin, size
    for _ in range(8):
        codes[which] = mix(codes[which] * BASE64 ^ (eight[at] & KEEP[np.minimum(left, 8)]))
        more = left > 8
        if not more.any():
            break
        which, at, left = which[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > 64).tolist():
        codes[i] = int.from_bytes(hashlib.blake2b(data[begin[i]:past[i]], digest_size=8).digest(), "little")
    return codes


class WaveletMatrix:
    """Ranks of symbols in a sequence: a level of packed bits per bit of a symbol."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        n = len(sequence)
        start = np.arange(symbols) * 0
        names = np.arange(symbols)
        for bit in reversed(range(max(1, int(symbols - 1).bit_length()))):
            ones = ((sequence >> bit) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            level = (bit, words, counts, n - int(ones.sum()))
            self.levels.append(level)
            start = self._down(level, names, start)
            sequence = np.concatenate((sequence[~ones], sequence[ones]))
        self.start = start

    @staticmethod
    def _down(level, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        bit, words, counts, zeros = level
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        ones = counts[word] + np.bitwise_count(words[word] & below)
        return np.where((symbol >> bit) & 1, zeros + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        first = self.start[symbol]
        for level in self.levels:
            at = self._down(level, symbol, at)
        return at - first


class FMIndex:
    """Counts of smaller symbols and the Burrows-Wheeler transform as a wavelet matrix."""

    def __init__(self, text: np.ndarray):
        symbols = int(text.max()) + 1
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.transform = WaveletMatrix(text[suffix_order(text) - 1], symbols)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one symbol more on the left."""
        base = self.below[symbol]
        return base + self.transform.rank(symbol, lo), base + self.transform.rank(symbol, hi)


def repeated(text: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices into ``starts``, interval) of the windows that occur at least twice."""
    index = FMIndex(text)
    which = np.arange(len(starts))
    last = text[starts + window - 1]
    lo, hi = index.below[last], index.below[last + 1]
    for back in range(2, window + 1):
        alive = hi - lo > 1
        which, lo, hi = which[alive], lo[alive], hi[alive]
        lo, hi = index.extend(text[starts[which] + window - back], lo, hi)
    alive = hi - lo > 1
    return which[alive], lo[alive]


def mark(bodies: list[np.ndarray], counts, docs, starts, window: int = WINDOW) -> list[np.ndarray]:
    """Windows (by index in each stretch) with an earlier equal among the stretches."""
    sizes = np.array([len(b) for b in bodies])
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    _, names = np.unique(np.concatenate(bodies), return_inverse=True)
    text = np.zeros(at[-1], np.int64)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    text[inside] = names + 1
    counts = np.asarray(counts, np.int64)
    owner = np.repeat(np.arange(len(bodies)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    which, interval = repeated(text, at[owner] + offset, window)
    doc, start = np.asarray(docs)[owner[which]], np.asarray(starts)[owner[which]] + offset[which]
    order = np.lexsort((start, doc, interval))
    later = np.concatenate(([False], interval[order][1:] == interval[order][:-1])) if len(order) else np.zeros(0, bool)
    gone = np.sort(which[order[later]])
    cuts = np.searchsorted(owner[gone], np.arange(len(bodies) + 1))
    return [offset[gone[a:b]] for a, b in zip(cuts[:-1], cuts[1:])]


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(
        window, gram,
        codes=word_codes,
        bounds=lambda data: word_bounds(np.frombuffer(data, np.uint8)),
        body_codes=word_codes,
        mark=lambda bodies, counts, docs, starts: mark(bodies, counts, docs, starts, window),
        first_stays=True)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_classes: int | None = None, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256``, and ``kept`` (string) if asked for."""
    rows = numbered(docs)
    hits = removed_windows(rows, kind(window, gram), max_classes)
    met = rows.join(hits.withColumnRenamed("doc", "__doc"), F.col("doc") == F.col("__doc"), "left").select("doc_id", "data", "hits")

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for data, found in zip(batch.column(1), batch.column(2)):
                words, found = data.as_py().split(), found.as_py()
                kept = words
                if found:
                    gone = covered(len(words), window, found)
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                text = b" ".join(kept)
                for column, x in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None)):
                    column.append(x)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:2]), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(out[3], pa.string())] if with_text else []),
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    return met.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, "
                               "kept_sha256 string" + ", kept string" * with_text)
