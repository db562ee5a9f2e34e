"""Secrets in texts: fixed patterns, and formats inferred from what they find.

``scan`` reads every text once and writes its finds: spans of the fixed patterns
of ``KINDS`` (leftmost, not overlapping within a kind; matches shorter than the
kind's least size fall away) and every other candidate, a maximal stretch of
credential characters of ``least`` or more that no fixed span touches.

``infer`` learns a format for each kind from the labelled credentials, and one
for the other candidates.  Spark draws the sample (the ``max_rows`` different
credentials of smallest hash of each kind, of ``max_length`` characters at most)
and counts its prefix tree; the tree's statistically compatible states are then
merged (ALERGIA: Hoeffding's bound on the frequencies of stopping and of each
next character, all the way down), which leaves a probabilistic automaton of few
states.  A kind without samples has no format.

``score`` runs every candidate through all formats, side by side.  A candidate is
a secret of the likeliest kind if that format is at least ``odds`` times likelier
than the format of other candidates, and at least as likely, per character, as
all but ``spare`` of the kind's own sample.  Its span is called ``like_<kind>``.
(So a format that is frequent among candidates without a label counts as ordinary.)

Defined results: a null text is empty; an empty table gives an empty one; each
row is judged on its own, so that repeated rows, null or repeated ids come back
as given; a kept column named ``spans`` gives way to the result's.  Texts and
candidates of any length are read and scored whole; only the sample has limits.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devicegrid.llm.common import text_of, written

# The patterns of the base kinds and the least sizes of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
KINDS = ("assign", "access", "hex")
LEAST = (6, 20, 24)

OTHER = len(KINDS)
STRETCH = re.compile(r"[A-Za-z0-9+/_.=-]+")
FINDS = "array<struct<kind:int,start:int,end:int,value:string>>"
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
PLACE = np.full(256, -1, np.int64)
PLACE[np.frombuffer(CHARACTERS.encode(), np.uint8)] = np.arange(len(CHARACTERS))


def finds(text: str, least: int) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns and of the other candidates."""
    out = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST[0]]
    taken, others = [m[1:3] for m in out], []
    for m in STRETCH.finditer(text):
        if m.end() - m.start() < min(least, *LEAST[1:]):
            continue
        # What the other two patterns match lies within such a stretch.
        inner = [(kind, x.start(), x.end(), x[0]) for kind, pattern in ((1, ACCESS), (2, HEX))
                 for x in pattern.finditer(text, m.start(), m.end()) if x.end() - x.start() >= LEAST[kind]]
        out += inner
        if not inner and m.end() - m.start() >= least:
            others.append((OTHER, m.start(), m.end(), m[0]))
    k = 0
    for o in others:
        while k < len(taken) and taken[k][1] <= o[1]:
            k += 1
        if k == len(taken) or taken[k][0] >= o[2]:
            out.append(o)
    return sorted(out, key=lambda f: (f[1], f[0]))


def scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", least: int = 16) -> DataFrame:
    """``keep`` columns and ``finds`` of every row, written."""
    kept = [c for c in keep if c not in ("finds", "spans")]
    slim = docs.select(*kept, text_of(text).alias("__text"))
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "value"), f)) for f in finds(t.as_py(), least)]
                     for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], names=[*kept, "finds"])

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in slim.schema.fields[:-1])
    return written(slim.mapInArrow(run, f"{types}finds {FINDS}"), "finds")


# -- formats


class Tree:
    """A prefix tree, or the automaton that it is merged into: by state how many
    strings pass and stop, and by character the next state and how many go there."""

    def __init__(self, rows: Sequence[tuple[str, int, int]]):
        """rows: (prefix, strings that begin with it, strings that it is)."""
        self.passing, self.stopping, self.next = [0], [0], [{}]
        states = {"": 0}
        for prefix, passing, stopping in sorted(rows, key=lambda r: len(r[0])):
            if prefix:
                states[prefix] = len(self.next)
                self.next[states[prefix[:-1]]][prefix[-1]] = [len(self.next), passing]
                self.passing.append(passing)
                self.stopping.append(stopping)
                self.next.append({})
            else:
                self.passing[0], self.stopping[0] = passing, stopping

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """Whether no frequency of the two, or of what follows, differs beyond the bound."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passing[a], self.passing[b]
            most = bound * (n ** -0.5 + m ** -0.5)
            if most >= 1 and (len(self.next[b]) == 0 or m == 1):
                continue  # a difference is 1 at most; single strings tell nothing further down
            if abs(self.stopping[a] / n - self.stopping[b] / m) > most:
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > most:
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def evidence(self, a: int, b: int) -> float:
        """Log probability that ``a`` and what follows it give to the tree below ``b``."""
        todo, out, other = [(a, b)], 0.0, 1 / (len(CHARACTERS) + 1)
        while todo:
            a, b = todo.pop()
            n = self.passing[a] + 1 if a >= 0 else 1
            out += self.stopping[b] * math.log(((self.stopping[a] if a >= 0 else 0) + other) / n)
            for c, (to, m) in self.next[b].items():
                x = self.next[a].get(c) if a >= 0 else None
                out += m * math.log(((x[1] if x else 0) + other) / n)
                todo.append((x[0] if x else -1, to))
        return out

    def fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to state ``a`` and what follows it."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passing[a] += self.passing[b]
            self.stopping[a] += self.stopping[b]
            for c, (to, n) in self.next[b].items():
                if c in self.next[a]:
                    self.next[a][c][1] += n
                    todo.append((self.next[a][c][0], to))
                else:
                    self.next[a][c] = [to, n]

    def merge(self, alpha: float) -> list[int]:
        """Merges each state, in the order of their strings, into that compatible
        state which explains its strings best; returns the states that stay."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        kept, seen, k = [0], {0}, 0
        while k < len(kept):
            state = kept[k]
            for c in sorted(self.next[state]):
                to = self.next[state][c][0]
                if to in seen:
                    continue
                fit = [other for other in kept if self.compatible(other, to, bound)]
                if fit:
                    best = max(fit, key=lambda other: self.evidence(other, to))
                    self.next[state][c][0] = best
                    self.fold(best, to)
                else:
                    kept.append(to)
                    seen.add(to)
            # Folding may have given an earlier state a new way out.
            k = next((i for i, s in enumerate(kept) if any(to not in seen for to, _ in self.next[s].values())), len(kept))
        return kept


@dataclass(frozen=True)
class Format:
    """An automaton as tables: next state and log probability by (state, character),
    log probability of stopping by state.  The last state is where a string goes
    that left the format: any character is as likely there."""

    to: np.ndarray
    cost: np.ndarray
    stop: np.ndarray
    least: float = -math.inf

    @staticmethod
    def of(rows: Sequence[tuple[str, int, int]], alpha: float) -> Format:
        tree, a = Tree(rows), len(CHARACTERS)
        kept = tree.merge(alpha)
        place = {s: i for i, s in enumerate(kept)}
        to = np.full((len(kept) + 1, a), len(kept), np.int64)
        seen, stop = np.zeros(to.shape), np.zeros(len(to))
        for i, s in enumerate(kept):
            stop[i] = tree.stopping[s]
            for c, (t, n) in tree.next[s].items():
                to[i, CHARACTERS.index(c)], seen[i, CHARACTERS.index(c)] = place[t], n
        # One string more, which spreads evenly over all characters and the end.
        total = seen.sum(axis=1) + stop + 1
        return Format(to, np.log((seen + 1 / (a + 1)) / total[:, None]), np.log((stop + 1 / (a + 1)) / total))

    def likelihoods(self, values: Sequence[str]) -> np.ndarray:
        """Log probability of each value, longest first through the tables together."""
        sizes = np.array([len(v) for v in values], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = PLACE[np.frombuffer("".join(values).encode(), np.uint8)]
        starts = (np.cumsum(sizes) - sizes)[order]
        state, total = np.zeros(len(values), np.int64), np.zeros(len(values))
        ends, step = sizes[order], 0
        for step in range(int(ends[0]) if len(ends) else 0):
            active = int(np.searchsorted(-ends, -step, side="left"))
            if active < 8:
                break
            c = flat[starts[:active] + step]
            total[:active] += self.cost[state[:active], c]
            state[:active] = self.to[state[:active], c]
        else:
            step = int(ends[0]) if len(ends) else 0
        to, cost = self.to.tolist(), self.cost.tolist()
        for k in np.flatnonzero(ends > step).tolist():
            s, sum_ = int(state[k]), float(total[k])
            for c in flat[starts[k] + step:starts[k] + ends[k]].tolist():
                sum_ += cost[s][c]
                s = to[s][c]
            state[k], total[k] = s, sum_
        out = np.empty(len(values))
        out[order] = total + self.stop[state]
        return out


def infer(found: DataFrame, max_rows: int = 1000, max_length: int = 256, alpha: float = 0.05,
          spare: float = 0.01, slack: float = 0.25) -> dict[int, Format]:
    """The format of each kind that has samples, and of the other candidates.

    What reaches the driver is the sample's prefix tree: at most ``max_rows``
    times ``max_length`` prefixes of a kind."""
    values = found.select(F.explode("finds").alias("f")).select("f.kind", "f.value").where(F.length("value") <= max_length).distinct()
    drawn = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    sample = values.withColumn("__n", F.row_number().over(drawn)).where(F.col("__n") <= max_rows)
    prefixes = (sample.select("kind", "value", F.explode(F.sequence(F.lit(0), F.length("value"))).alias("n"))
                .select("kind", F.expr("substr(value, 1, n)").alias("prefix"), (F.col("n") == F.length("value")).cast("int").alias("whole"))
                .groupBy("kind", "prefix").agg(F.count(F.lit(1)).alias("passing"), F.sum("whole").alias("stopping")))
    rows: dict[int, list] = {}
    for r in prefixes.collect():
        rows.setdefault(r.kind, []).append((r.prefix, r.passing, r.stopping))
    out = {}
    for kind, tree in rows.items():
        plain = Format.of(tree, alpha)
        own = [prefix for prefix, _, stopping in tree if stopping]
        level = np.quantile(plain.likelihoods(own) / (np.array([len(v) for v in own]) + 1), spare)
        out[kind] = Format(plain.to, plain.cost, plain.stop, float(level) - slack)
    return out


def score(found: DataFrame, formats: dict[int, Format], keep: Sequence[str] = ("doc_id",), odds: float = 1e9) -> DataFrame:
    """``keep`` columns and ``spans`` by start and kind: all fixed ones and the
    candidates that a format takes in.  ``score`` is the log-odds of the kind's
    format against that of other candidates (null without such formats)."""
    kept = [c for c in keep if c not in ("finds", "spans")]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    known = [k for k in range(OTHER) if k in formats]

    def judged(found_rows: list[dict]) -> list[dict | None]:
        values = [f["value"] for f in found_rows]
        sizes = np.array([len(v) + 1 for v in values])
        by_kind = {k: formats[k].likelihoods(values) for k in formats}
        plain = by_kind.get(OTHER, -math.log(len(CHARACTERS) + 1) * sizes)
        likely = np.array([np.where(by_kind[k] / sizes >= formats[k].least, by_kind[k], -np.inf) for k in known])
        out: list[dict | None] = []
        for i, f in enumerate(found_rows):
            if f["kind"] < OTHER:
                odd = float(by_kind[f["kind"]][i] - plain[i]) if f["kind"] in by_kind else None
                out.append({"kind": KINDS[f["kind"]], "start": f["start"], "end": f["end"], "score": odd})
                continue
            best = int(np.argmax(likely[:, i])) if known else -1
            odd = likely[best, i] - plain[i] if known else -math.inf
            out.append({"kind": f"like_{KINDS[known[best]]}", "start": f["start"], "end": f["end"], "score": float(odd)}
                       if odd >= math.log(odds) else None)
        return out

    def run(batches):
        for batch in batches:
            rows = batch.column(batch.num_columns - 1).to_pylist()
            flat = [f for r in rows for f in r]
            verdicts = iter(judged(flat) if flat else [])
            spans = [[s for s in (next(verdicts) for _ in r) if s] for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, kind)], names=[*kept, "spans"])

    types = "".join(f"`{c}` {found.schema[c].dataType.simpleString()}, " for c in kept)
    return found.select(*kept, "finds").mapInArrow(run, f"{types}spans {SPANS}")


def find_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``spans`` of every row: scan, infer, score."""
    found = scan(docs, keep, text)
    return score(found, infer(found), keep)
