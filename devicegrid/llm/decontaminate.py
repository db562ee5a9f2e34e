"""Benchmark decontamination by a broadcast set of test n-grams.

Items and documents are cut into normalised words (A-Z lowered; letters and
digits of ASCII and everything beyond it).  A window is ``ngram`` consecutive
words of an item; an item of fewer words, but not none, is one window.  Words
become numbers of the items' vocabulary, document positions whose whole
window is in the vocabulary are looked up by hash, and hits are verified
against the window's numbers themselves.

The set is broadcast in parts of at most ``max_windows`` windows and
``max_bytes`` bytes; a larger benchmark takes several passes over the
documents, each adding to the hits of the one before.  No shuffle of texts.

Defined results
* null and word-free texts have no words and are clean; a word-free item hits
  nothing; items that share an id count once, a null item_id reads as '';
* overlapping windows are merged; repeated document rows are scanned alike;
* ``remove="documents"`` drops documents with a hit, ``remove="spans"`` cuts
  the hit words (from the first to the end of the last word of a run) out of
  the text; an empty benchmark leaves everything as it is.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import release_memory

#: Bytes to lower-cased bytes; what separates words becomes a space.
TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20) for b in range(256))
SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def item_windows(benchmark: DataFrame, ngram: int) -> DataFrame:
    """Distinct (item, window): the window as its words joined by spaces."""

    def run(batches):
        for batch in batches:
            items, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                size = min(ngram, len(words))
                found = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else ()
                items += [item] * len(found)
                windows += found
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], names=["item", "win"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "item string, win binary").distinct()


class WindowSet:
    """Numbers of the vocabulary, and by window size the hashes and items of the windows."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        by_size: dict[int, dict[bytes, list[str]]] = {}
        for item, window in sorted(rows):
            codes = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window.split(b" ")], np.int32)
            by_size.setdefault(len(codes), {}).setdefault(codes.tobytes(), []).append(item)
        self.sizes = {size: (np.unique(self.hashed(np.array([np.frombuffer(k, np.int32) for k in found]))), found)
                      for size, found in by_size.items()}

    @staticmethod
    def hashed(windows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(windows), np.uint64)
        for j in range(windows.shape[1]):
            h = (h ^ windows[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.vocabulary.get
        codes = np.array([get(w, 0) for w in words], np.int32)
        known = np.concatenate(([0], np.cumsum(codes > 0)))
        for size, (hashes, found) in self.sizes.items():
            at = np.flatnonzero(known[size:] - known[:-size] == size) if len(words) >= size else []
            if not len(at):
                continue
            windows = np.lib.stride_tricks.sliding_window_view(codes, size)[at]
            h = self.hashed(windows)
            near = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
            for i, window in zip(at[near], windows[near]):
                if (who := found.get(window.tobytes())) is not None:
                    hit[i:i + size] = True
                    items.update(who)
        return hit, items


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], ngram: int = 10,
         max_windows: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """The columns ``keep`` of every row, with ``spans`` (hit runs of words),
    ``items`` (ids with occurring windows, sorted), ``n_words`` and ``n_hit``."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, ngram)
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("win")), F.lit(0)).alias("b")).first()
    passes = max(1, -(-size.n // max_windows), -(-size.b // max_bytes))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    spans_type, items_type = "array<struct<first:int,past:int>>", "array<string>"
    out = docs.select(*keep, F.col("text").cast("binary").alias("__text"),
                      F.lit(None).cast(spans_type).alias("spans"), F.lit(None).cast(items_type).alias("items"))
    k = len(keep)
    for part in range(passes):
        mine = F.pmod(F.xxhash64("win"), F.lit(passes)) == part
        # A part is bounded by max_windows and max_bytes (in expectation, by hash).
        shared = spark.sparkContext.broadcast([(r.item, bytes(r.win)) for r in windows.where(mine).collect()])
        last = part == passes - 1

        def run(batches, shared=shared, last=last):
            found = WindowSet(shared.value)
            for batch in batches:
                spans, items, n_words, n_hit = [], [], [], []
                for text, old_spans, old_items in zip(*(batch.column(i).to_pylist() for i in (k, k + 1, k + 2))):
                    words = words_of(text)
                    hit, who = found.hits(words)
                    for s in old_spans or ():
                        hit[s["first"]:s["past"]] = True
                    spans.append([{"first": a, "past": b} for a, b in _spans(hit)])
                    items.append(sorted(who | set(old_items or ())))
                    n_words.append(len(words))
                    n_hit.append(int(hit.sum()))
                shape = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))
                columns = {"spans": pa.array(spans, shape), "items": pa.array(items, pa.list_(pa.string()))}
                if last:
                    columns |= {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64())}
                kept = list(batch.columns[:k]) + ([] if last else [batch.column(k)])
                yield pa.RecordBatch.from_arrays([*kept, *columns.values()], names=[*batch.schema.names[:len(kept)], *columns])
            del found
            release_memory()

        hits = f"spans {spans_type}, items {items_type}"
        out = out.mapInArrow(run, f"{schema}, {hits}, n_words long, n_hit long" if last else f"{schema}, __text binary, {hits}")
    return out


def cut_spans(text: str, spans: list) -> str:
    """The text without the bytes from the first to the past-the-last word of each span."""
    data = text.encode()
    words = [m.span() for m in SPAN.finditer(data)]
    out, at = [], 0
    for s in spans:
        out.append(data[at:words[s["first"]][0]])
        at = words[s["past"] - 1][1]
    return b"".join([*out, data[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", ngram: int = 10) -> DataFrame:
    """The rows of ``docs`` without contaminated documents, or with the spans cut out."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], "text")
    names = [f"c{i}" for i in range(len(docs.columns))]
    scanned = scan(renamed, benchmark, names, ngram)
    if remove == "documents":
        scanned = scanned.where("n_hit = 0")
    else:
        at = docs.columns.index("text")
        cut = F.udf(lambda t, s: cut_spans(t, s) if t else t, "string")
        text = F.col(names[at])
        scanned = scanned.withColumn(names[at], F.when(F.col("n_hit") > 0, cut(text, "spans")).otherwise(text))
    return scanned.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
