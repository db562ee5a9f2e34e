"""SentencePiece encoding and decoding over a relational lattice.

A text becomes units: a run of word marks and the word after it (no piece
reaches over such a boundary, which is checked when a model is read).  For a
table of units, :func:`encode_units` explodes all substrings up to the longest
piece, joins them with the piece table, and folds the lattice of each unit's
edges: the best path (Viterbi) for unigram models, and for BPE models - where
the best path is not the library's answer - the merges in order of rank over the
same edges.  Exploding and the broadcast join leave a unit's edges together, so
they need no exchange to be grouped, and a task folds the lattices of thousands
of units at a time, a pass doing one step of each.

:func:`encode` does this for every different unit of all documents.  The tasks
that read documents write them in packs: a document as the numbers of its units
in the pack, and each different unit of a pack once, in the bucket of its hash.
One exchange of packs is read twice: the units go on to their buckets, where
each different one is folded once, its ids go back to the packs that hold it, and
each pack is put together with its documents.  Units and ids travel compressed,
a row a pack and bucket; no text is shuffled.  Only units of more than ``APART``
signs, whose merges grow with the square of their length, are merged with a heap.

Defined results
* a null text has null ids, an empty one none; decoding gives the text back,
  U+2581 excepted, which the format uses for the space;
* signs without a piece become their UTF-8 bytes' pieces;
* equal scores: the longer last piece (Viterbi), the leftmost pair (merges);
* repeated rows are encoded alike; further columns named in ``keep`` pass.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid.llm.common import release_memory

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
#: The length from which merges use a heap, and the one from which units have no lattice.
LONG, APART = 48, 256
#: Units, each occurrence counted, after which a pack of documents ends.
PACK = 2_500_000
#: Most buckets of different units; a pack has as many rows of units.
BUCKETS = 1024
#: Edges that are folded at a time, and numbers of units that are sent back at a time.
EDGES, BACK = 150_000, 200_000
#: More than the signs of a unit in a lattice and the pieces of a model.
SIGNS = 1 << 20
#: A unit's place in a pack, and kinds of rows of packs.
PLACE = np.dtype([("pack", "<i8"), ("at", "<i4")])
DOC, CODES, UNITS = 0, 1, 2


class Model:
    """Pieces of a model file: ids and scores by piece, ids of the byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave texts as they are")
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE) or not proto.trainer_spec.byte_fallback:
            raise ValueError("only unigram and BPE models with byte pieces")
        self.prefix = rules.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}
        self.bytes = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.surface = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else
                        p.piece.replace(MARK, " ").encode() if p.type in (NORMAL, USER_DEFINED) else b"" for p in proto.pieces]
        if any(re.search(f"[^{MARK}]{MARK}|\n.|.\n", p, re.S) for p in self.ids):
            raise ValueError("a piece reaches over a word's or line's end")
        self.longest = max(map(len, self.ids))
        #: A sign without a piece costs this much on a Viterbi path.
        self.unknown = min(self.scores.values()) - 10.0

    def parts(self) -> dict:
        return self.__dict__

    @classmethod
    def of(cls, parts: dict) -> "Model":
        model = cls.__new__(cls)
        model.__dict__.update(parts)
        return model

    def score_of(self) -> np.ndarray:
        """Scores by id."""
        out = np.zeros(len(self.surface))
        for piece, at in self.ids.items():
            out[at] = self.scores[piece]
        return out

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return UNIT.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def fold(self, unit: str) -> list[int]:
        """Ids of a unit: its lattice folded in the task."""
        pieces = self.merged(unit) if self.kind == BPE else self.best_path(unit)
        out = []
        for p in pieces:
            at = self.ids.get(p)
            out += [at] if at is not None else [self.bytes[b] for b in p.encode()]
        return out

    def merged(self, unit: str) -> list[str]:
        score = self.scores.get
        parts = list(unit)
        if len(parts) > LONG:
            return self.merged_long(parts)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merged_long(self, parts: list[str]) -> list[str]:
        """The same merges with a heap, for units of any length."""
        score, n = self.scores.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and (s := score(both := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, j, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not parts[i] or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p]

    def best_path(self, unit: str) -> list[str]:
        n, score = len(unit), self.scores.get
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                s = score(unit[start:end])
                if s is None and start == end - 1:
                    s = self.unknown
                if s is not None and best[start] + s > best[end]:
                    best[end], back[end] = best[start] + s, start
        out, end = [], n
        while end:
            out.append(unit[back[end]:end])
            end = back[end]
        return out[::-1]


UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, score): as many rows as the model has pieces."""
    pieces = list(model.ids)
    # As Arrow columns no Python worker has to start for it.
    return spark.createDataFrame(pa.table({
        "piece": pa.array(pieces, pa.string()), "id": pa.array(list(model.ids.values()), pa.int32()),
        "score": pa.array([float(model.scores[p]) for p in pieces], pa.float64())}))


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """(unit, ids) for the distinct units of a table: lattice, join, fold."""
    return _folded(units.select("unit").where("unit <> ''").distinct(), model)


def _folded(whole: DataFrame, model: Model, at_once: int = EDGES) -> DataFrame:
    """(unit, ids) and the further columns of a table of different units.

    Exploding and a broadcast join keep rows in order, so the edges of a unit
    reach the fold together.  Units beyond a lattice come as one row."""
    kept = [c for c in whole.columns if c != "unit"]
    short = F.col("n") <= APART
    spans = (whole.withColumn("n", F.length("unit")).withColumn("s", F.explode_outer(F.when(short, F.sequence(F.lit(0), F.col("n") - 1))))
             .withColumn("e", F.explode_outer(F.when(short, F.sequence(F.col("s") + 1, F.least(F.col("n"), F.col("s") + model.longest)))))
             .withColumn("piece", F.col("unit").substr(F.col("s") + 1, F.col("e") - F.col("s"))).withColumn("key", F.xxhash64("piece")))
    # Bounded by the model's pieces.  The join is on hashes, which are numbers; the pieces are compared after it.
    pieces = piece_table(whole.sparkSession, model).select(F.xxhash64("piece").alias("key"), F.col("piece").alias("__piece"), "id")
    if pieces.select("key").distinct().count() < len(model.ids):
        raise ValueError("two pieces have the same hash")
    met = spans.join(F.broadcast(pieces), "key", "left").withColumn("id", F.when(F.col("piece") == F.col("__piece"), F.col("id")))
    # Single signs stay in the lattice, with or without a piece.  An edge is one number, as each row costs.
    first = F.coalesce(F.col("e") == 1, F.lit(True))
    edges = met.where(F.col("id").isNotNull() | F.coalesce(F.col("e") == F.col("s") + 1, F.lit(True))).select(
        F.when(first, F.col("unit")).alias("unit"),
        ((F.col("s").cast("long") * SIGNS + F.col("e")) * SIGNS + F.coalesce(F.col("id") + 1, F.lit(0))).alias("edge"), *[F.when(first, F.col(c)).alias(c) for c in kept])
    shared = whole.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        m, open_ = Model.of(shared.value), []
        scores = m.score_of()
        for batch in batches:
            open_.append(batch)
            if sum(b.num_rows for b in open_) >= at_once:
                rows = pa.Table.from_batches(open_)
                # The last unit may go on in the next batch.
                last = int(np.flatnonzero(rows.column(0).is_valid().to_numpy())[-1])
                yield from _fold_edges(rows.slice(0, last), m, scores, kept)
                open_ = pa.Table.from_batches(rows.slice(last).combine_chunks().to_batches()).to_batches()
        if open_:
            yield from _fold_edges(pa.Table.from_batches(open_), m, scores, kept)
            open_.clear()
        del m, scores
        release_memory()

    types = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in whole.select(*kept).schema)
    return edges.mapInArrow(run, f"unit string, ids array<int>{types}")


def _fold_edges(rows: pa.Table, model: Model, scores: np.ndarray, kept: list[str]):
    """Folds the lattices of units whose edges lie together, all units at a time."""
    starts = np.flatnonzero(rows.column("unit").is_valid().to_numpy())
    if not len(starts):
        return
    heads = rows.take(pa.array(starts)).combine_chunks()
    edge = rows.column("edge").fill_null(-1).to_numpy()
    s, e, ids = edge // SIGNS ** 2, edge // SIGNS % SIGNS, edge % SIGNS - 1
    e[edge < 0] = 0
    unit = np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [len(s)]))))
    size = np.maximum.reduceat(e, starts)
    base = np.concatenate(([0], np.cumsum(size)))
    in_lattice = s >= 0
    unit, s, e, ids = unit[in_lattice], s[in_lattice], e[in_lattice], ids[in_lattice]
    begin, end = base[unit] + s, base[unit] + e
    score = np.where(ids >= 0, scores[ids], model.unknown)
    ends = (_merged_ends if model.kind == BPE else _viterbi_ends)(unit, begin, end, score, base)
    chosen = np.flatnonzero(ends[begin] == end)
    chosen = chosen[np.argsort(begin[chosen], kind="stable")]
    ids, unit, s = ids[chosen], unit[chosen], s[chosen]
    texts = heads.column("unit")
    # Signs without a piece become bytes, units without a lattice what the heap gives.
    many = np.ones(len(ids), np.int64)
    signs = {}
    for k in np.flatnonzero(ids < 0):
        signs[k] = [model.bytes[b] for b in texts[int(unit[k])].as_py()[s[k]].encode()]
        many[k] = len(signs[k])
    flat, at = np.repeat(ids, many).astype(np.int32), np.cumsum(many) - many
    for k, found in signs.items():
        flat[at[k]:at[k] + many[k]] = found
    length = np.bincount(np.repeat(unit, many), minlength=len(starts))
    lists = [flat]
    if len(apart := np.flatnonzero(size == 0)):
        cuts, lists = np.cumsum(length), []
        done = 0
        for u in apart:
            found = np.array(model.fold(texts[int(u)].as_py()), np.int32)
            lists += [flat[done:cuts[u]], found]
            done, length[u] = cuts[u], len(found)
        lists.append(flat[done:])
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    out = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists), pa.int32()))
    yield from pa.table([texts, out, *(heads.column(c) for c in kept)], names=["unit", "ids", *kept]).to_batches(max_chunksize=10_000)


def _merged_ends(unit, begin, end, score, base) -> np.ndarray:
    """The end of the part that starts at each sign, -1 where none starts.  A pass
    merges in each unit the two parts whose edge ranks best, the leftmost of equal ones."""
    ends = np.arange(1, base[-1] + 2)
    two = end > begin + 1
    order = np.flatnonzero(two)
    order = order[np.lexsort((begin[order], -score[order], unit[order]))]
    unit, begin, end = unit[order], begin[order], end[order]
    while len(unit):
        # A part's next one may be in another unit; no edge ends there.
        over_two = np.flatnonzero(ends[ends[begin]] == end)
        best = over_two[np.concatenate(([True], np.diff(unit[over_two]) > 0))[:len(over_two)]]
        middle = ends[begin[best]]
        ends[begin[best]], ends[middle] = end[best], -1
        # Units without a merge are done, and edges whose bounds are gone or that are parts now.
        going = np.zeros(len(base), bool)
        going[unit[best]] = True
        live = np.flatnonzero(going[unit] & (ends[begin] >= 0) & (ends[begin] < end) & (ends[end] >= 0))
        unit, begin, end = unit[live], begin[live], end[live]
    return ends


def _viterbi_ends(unit, begin, end, score, base) -> np.ndarray:
    """The end of the part that starts at each sign, -1 where none starts: the best
    paths, of all units at a time, by their ends; of equal ones the longer last piece."""
    best, back = np.zeros(base[-1] + 1), np.zeros(base[-1] + 1, np.int64)
    # A unit's first sign is its neighbour's end: paths to ends are kept apart.
    last = end - base[unit]
    order = np.lexsort((begin, unit, last))
    cuts = np.searchsorted(last[order], np.arange(1, last.max(initial=0) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        now = order[a:b]
        first = begin[now] == base[unit[now]]
        cost = np.where(first, 0.0, best[begin[now]]) + score[now]
        heads = np.flatnonzero(np.concatenate(([True], np.diff(unit[now]) > 0)))
        top = np.repeat(np.maximum.reduceat(cost, heads), np.diff(np.concatenate((heads, [len(now)]))))
        # Starts go up, so the first of equal paths is the one with the longest piece.
        hit = np.flatnonzero(cost == top)
        hit = hit[np.concatenate(([True], np.diff(unit[now[hit]]) > 0))]
        best[end[now[hit]]], back[end[now[hit]]] = cost[hit], begin[now[hit]]
    ends = np.full(base[-1] + 1, -1)
    at, start = base[1:], base[:-1]
    while len(at):
        going = at > start
        at, start = at[going], start[going]
        ends[back[at]] = at
        at = back[at]
    return ends


def _packs(docs: DataFrame, model: Model, keep: list[str], max_units: int, buckets: int) -> DataFrame:
    """The documents of each task in packs of about ``max_units`` different units
    (a document is in one pack), three kinds of rows with the number ``__pack``:
    DOC, the columns ``keep``, ``__n`` (how many units) and ``__data`` (digest of
    the text), ``__i`` their order; CODES, numbers in the pack of some documents'
    units in ``__data``; and UNITS, the different units of bucket ``__i`` in
    ``__data`` (``__n`` bytes) and the steps of their numbers in ``__at``.
    Frequent units have small numbers; of equally frequent ones those of a
    bucket lie together."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    fields = docs.select(*keep).schema

    def run(batches):
        from collections import defaultdict

        from pyspark import TaskContext
        m = Model.of(shared.value)
        pack, size, done = TaskContext.get().partitionId() << 32, 0, 0
        at: dict[str, int] = defaultdict()
        at.default_factory = at.__len__
        codes: list[np.ndarray] = []
        types = None
        columns = [*keep, "__pack", "__kind", "__i", "__n", "__data", "__at"]

        def rows(kind, i, n, data, numbers=None, kept=None):
            size = len(data)
            kept = [pa.nulls(size, t) for t in types] if kept is None else kept
            return pa.RecordBatch.from_arrays([*kept, pa.array([pack] * size, pa.int64()), pa.array([kind] * size, pa.int32()), pa.array(i, pa.int64()),
                                               pa.array(n, pa.int64()), pa.array(data, pa.binary()), pa.array(numbers or [None] * size, pa.binary())], names=columns)

        def listed():
            names = sorted(at)
            met = np.fromiter(map(at.__getitem__, names), np.int64, len(names))
            often = sum(np.bincount(c, minlength=len(names)) for c in codes)[met]
            bucket = np.fromiter((zlib.crc32(u.encode()) % buckets for u in names), np.int64, len(names))
            numbers, named = np.empty(len(names), np.int32), np.empty(len(names), np.int32)
            numbers[np.lexsort((bucket, -np.log2(often).astype(np.int64)))] = np.arange(len(names))
            named[met] = numbers
            for i, part in enumerate(codes):
                yield rows(CODES, [i], [len(part)], [_pressed(named[part])])
            order = np.lexsort((numbers, bucket))
            cuts = np.concatenate((np.flatnonzero(np.diff(bucket[order], prepend=-1)), [len(order)]))
            for i in range(0, len(cuts) - 1, 64):
                parts = [order[a:b] for a, b in zip(cuts[i:i + 64], cuts[i + 1:i + 65])]
                # A line's end is a unit of its own, and the only one with a line's end.
                data = ["\n".join("" if (u := names[k]) == "\n" else u for k in part).encode() for part in parts]
                yield rows(UNITS, [bucket[p[0]] for p in parts], list(map(len, data)),
                           [_zstd(d, 6) for d in data], [_pressed(np.diff(numbers[p], prepend=0)) for p in parts])

        for batch in batches:
            types = [c.type for c in batch.columns[:len(keep)]]
            texts = batch.column(len(keep))
            i = 0
            while i < batch.num_rows:
                first, some, counts, said = i, [], [], []
                while i < batch.num_rows and i < first + 512 and len(at) < max_units and size < PACK:
                    text = texts[i].as_py()
                    units = () if text is None else m.units(text)
                    some.append(np.fromiter(map(at.__getitem__, units), np.int32, len(units)))
                    size += len(units)
                    counts.append(None if text is None else len(units))
                    said.append(None if text is None else _digest(text.replace(MARK, " ")))
                    i += 1
                if i > first:
                    yield rows(DOC, range(done, done + i - first), counts, said, kept=[c.slice(first, i - first) for c in batch.columns[:len(keep)]])
                    codes.append(np.concatenate(some))
                    done += i - first
                if len(at) >= max_units or size >= PACK:
                    yield from listed()
                    pack, size, done = pack + 1, 0, 0
                    at.clear()
                    codes.clear()
        if at:
            yield from listed()
        # It refers to itself: a worker would keep its units until some later collection.
        at.clear()
        codes.clear()
        release_memory()

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(
        run, f"{schema}__pack long, __kind int, __i long, __n long, __data binary, __at binary")


def _units_apart(batches):
    """The rows of units."""
    for batch in batches:
        part = batch.filter(pc.equal(batch.column("__kind"), UNITS)).select(["__i", "__pack", "__n", "__data", "__at"])
        if part.num_rows:
            yield part


def _different(rows: pa.Table) -> pa.Table:
    """The different units of a bucket, each with its numbers in the packs that hold it."""
    from collections import defaultdict
    seen: dict[str, int] = defaultdict()
    seen.default_factory = seen.__len__
    units, numbers = [], []
    for n, data, at in zip(*(rows.column(c) for c in ("__n", "__data", "__at"))):
        names = pa.decompress(data.as_buffer(), n.as_py(), "zstd", asbytes=True).decode().split("\n") if n.as_py() else [""]
        units.append(np.fromiter(map(seen.__getitem__, names), np.int64, len(names)))
        numbers.append(np.cumsum(_unpressed(at.as_buffer(), len(names))))
    packs = np.repeat(rows.column("__pack").to_numpy(), list(map(len, units)))
    unit, number = np.concatenate(units), np.concatenate(numbers)
    order = np.argsort(unit, kind="stable")
    places = np.empty(len(order), PLACE)
    places["pack"], places["at"] = packs[order], number[order]
    offsets = (np.concatenate(([0], np.cumsum(np.bincount(unit)))) * PLACE.itemsize).astype(np.int32)
    at = pa.Array.from_buffers(pa.binary(), len(seen), [None, pa.py_buffer(offsets), pa.py_buffer(places.tobytes())])
    release_memory()
    different = pa.array([u or "\n" for u in seen], pa.string())
    seen.clear()
    return pa.table({"unit": different, "at": at})


def _id_type(ids: int) -> np.dtype:
    return np.dtype("<u2" if ids <= 1 << 16 else "<i4")


def _sent_back(batches, most: int):
    """The ids (less than ``most``) of units, sent to the packs that hold them: a row a pack and some hundred thousand of the task's units."""
    def rows(part):
        table = pa.Table.from_batches(part).combine_chunks()
        held, ids = np.frombuffer(b"".join(table.column("at").to_pylist()), PLACE), table.column("ids").combine_chunks()
        pack, at = held["pack"], held["at"]
        unit = np.repeat(np.arange(table.num_rows), pc.binary_length(table.column("at")).to_numpy() // PLACE.itemsize)
        many, flat = ids.value_lengths().to_numpy().astype(np.int64), ids.flatten().to_numpy()
        begin = np.cumsum(many) - many
        order = np.lexsort((at, pack))
        cuts = np.concatenate((np.flatnonzero(np.diff(pack[order], prepend=-1)), [len(order)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            here = order[a:b]
            n = many[unit[here]]
            found = flat[np.repeat(begin[unit[here]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([pack[here[0]]], pa.int64()), pa.array([len(here)], pa.int64()), pa.array([len(found)], pa.int64()), *(
                pa.array([x], pa.binary()) for x in (_pressed(np.diff(at[here], prepend=0)), _pressed(n), _zstd(found.astype(_id_type(most)).tobytes(), 3)))],
                names=["__pack", "__units", "__n", "__at", "__many", "__ids"])

    part, size = [], 0
    for batch in batches:
        part.append(batch)
        size += (pc.sum(pc.binary_length(batch.column("at"))).as_py() or 0) // PLACE.itemsize
        if size >= BACK:
            yield from rows(part)
            part, size = [], 0
    if size:
        yield from rows(part)
        part.clear()
    release_memory()


def _zstd(data: bytes, level: int) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def _pressed(numbers: np.ndarray) -> bytes:
    """32-bit values compressed, their first bytes first."""
    return _zstd(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3) if len(numbers) else b""


def _unpressed(data: pa.Buffer, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int32)
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.uint8).reshape(4, n).T.copy().view(np.int32)[:, 0]


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


class Decoder:
    def __init__(self, model: Model):
        self.flat = np.frombuffer(b"".join(model.surface), np.uint8)
        self.length = np.array([len(s) for s in model.surface])
        self.begin = np.cumsum(self.length) - self.length
        self.prefix = model.prefix

    def decode(self, ids: np.ndarray) -> str:
        length = self.length[ids]
        shift = self.begin[ids] - (np.cumsum(length) - length)
        text = self.flat[np.repeat(shift, length) + np.arange(length.sum())].tobytes().decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def encode(docs: DataFrame, path: str, keep: list[str], max_units: int = 500_000, digest: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids`` of every row; with ``digest`` instead
    ``n_tokens``, ``ids_sha256`` (little-endian 32-bit ids) and ``round_trip``.
    Kept columns of these names give way.  ``max_units``: different units after
    which a pack of documents ends."""
    keep = [c for c in keep if c not in (("n_tokens", "ids_sha256", "round_trip") if digest else ("ids",))]
    model = Model(path)
    tasks = docs.rdd.getNumPartitions()
    buckets = min(8 * max(1, tasks), BUCKETS)
    # One exchange, read twice: the units in it go on to their buckets, the documents wait for the ids.
    # (Nothing is selected or filtered before it is read, which would make two of it.)
    packs = _packs(docs, model, keep, max_units, buckets).repartition(4 * max(1, tasks), "__pack")
    met = packs.mapInArrow(_units_apart, "__i long, __pack long, __n long, __data binary, __at binary").repartition(buckets, "__i")
    whole = met.groupBy("__i").applyInArrow(_different, "unit string, at binary")
    most = len(model.surface)
    back = _folded(whole, model).select("ids", "at").mapInArrow(
        lambda batches: _sent_back(batches, most), "__pack long, __units long, __n long, __at binary, __many binary, __ids binary")
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(rows: pa.Table, units: pa.Table) -> pa.Table:
        release_memory()
        decoder = Decoder(Model.of(shared.value)) if digest else None
        at, many = ([_unpressed(x.as_buffer(), n.as_py()) for x, n in zip(units.column(c), units.column("__units"))] for c in ("__at", "__many"))
        kind = _id_type(most)
        flat = [np.frombuffer(pa.decompress(x.as_buffer(), n.as_py() * kind.itemsize, "zstd"), kind) for x, n in zip(units.column("__ids"), units.column("__n"))]
        nothing = [np.zeros(0, np.int32)]
        at, many, flat = np.concatenate([np.cumsum(x) for x in at] or nothing), np.concatenate(many or nothing), np.concatenate(flat or nothing).astype(np.int32)
        begin, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        begin[at], length[at] = np.cumsum(many, dtype=np.int64) - many, many
        kind = rows.column("__kind")
        parts = rows.filter(pc.equal(kind, CODES)).sort_by("__i")
        numbers = np.concatenate([_unpressed(x.as_buffer(), n.as_py()) for x, n in zip(parts.column("__data"), parts.column("__n"))] or nothing)
        rows = rows.filter(pc.equal(kind, DOC)).sort_by("__i")
        # With a digest no more than one document's ids are kept.
        values = None if digest else np.empty(length[numbers].sum(), np.int32)
        out, end, filled = [], 0, 0
        for n, said in zip(rows.column("__n"), rows.column("__data")):
            ids = None
            if n.is_valid:
                codes = numbers[end:end + n.as_py()]
                end += len(codes)
                many = length[codes]
                ids = flat[np.repeat(begin[codes] - (np.cumsum(many) - many), many) + np.arange(many.sum())] if len(codes) else codes
            if digest:
                out.append((None, None, None) if ids is None else (
                    len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), _digest(decoder.decode(ids)) == said.as_py()))
            else:
                out.append(filled)
                if ids is not None:
                    values[filled:filled + len(ids)] = ids
                    filled += len(ids)
        if digest:
            more = {c: pa.array([x[k] for x in out], t) for k, (c, t) in enumerate(
                {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "round_trip": pa.bool_()}.items())}
        else:
            more = {"ids": pa.ListArray.from_arrays(np.array([*out, filled], np.int32), pa.array(values, pa.int32()),
                                                    mask=rows.column("__n").combine_chunks().is_null())}
        return pa.table([*(rows.column(c) for c in keep), *more.values()], names=[*keep, *more])

    return packs.groupBy("__pack").cogroup(back.groupBy("__pack")).applyInArrow(
        run, (f"{schema}, " if keep else "") + ("n_tokens long, ids_sha256 string, round_trip boolean" if digest else "ids array<int>"))


def decode(rows: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``text`` from ``ids`` (a kept ``text`` gives way)."""
    keep = [c for c in keep if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(Model(path).parts())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def run(batches):
        decoder = Decoder(Model.of(shared.value))
        for batch in batches:
            texts = [None if x.as_py() is None else decoder.decode(np.array(x.as_py(), np.int64)) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    return rows.select(*keep, F.col("ids").alias("__ids")).mapInArrow(run, f"{schema}, text string")
