"""The conversation trie against one that rebuilds every conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from devicegrid.llm import prefix_trie

EMPTY = hashlib.sha256(b"").hexdigest()


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - (abs(c) % 5 if c > 0 else -(abs(c) % 5)), [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path)))
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    out = []
    for path, who in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c, n in who if n == len(path)))
        out.append((min(who)[0], len(path), min(members[path[:-1]])[0] if path else None, len(who), len(children[path]),
                    sum(not children[p] for p in below), sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, pos int")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **kw).collect()), key=str)


def test_built_conversations(spark):
    rng = random.Random(11)
    rows = []
    for c in rng.sample(range(-40, 400), 160):
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, ("user", "assistant")[t % 2], rng.choice(["a", "b", "é🎉"]) if t > 2 else "hi"))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(60) for t in range(11)]
    rows += [(7000, t, "user", f"long {t % 5}") for t in range(2500)]  # several blocks
    rows += [(7001, t, "user", f"long {t % 5}") for t in range(2100)] + [(7002, t, None if t % 2 else "user", None) for t in range(20)]
    rng.shuffle(rows)
    got = trie(spark, rows)
    small = [r for r in rows if r[0] not in (7000, 7001)]
    assert trie(spark, small) == plain(small)
    paths = {}
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t, r or "", x or ""))
    for c, own in turns.items():
        own = [x[1:] for x in sorted(own)]
        turns[c] = own
    for c, own in turns.items():  # sums over long paths by hashes of prefixes
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c + (-c) % 5
        path, key = turns.get(base, [])[:h] + own[h:], b""
        for d, turn in enumerate([None, *path]):
            key = hashlib.sha256(key + repr(turn).encode()).digest()
            p = paths.setdefault(key, [d, [], turn])
            p[1].append(c)
    assert sorted((r[0], r[1], r[3]) for r in got) == sorted((min(m), d, len(m)) for d, m, _ in paths.values())
    root = next(r for r in got if r[1] == 0)
    assert root[6] == sum((len(m) - 1) * len(t[1].encode()) for d, m, t in paths.values() if d)


def test_awkward_turns(spark):
    rows = [(None, 0, "user", "x"), (5, None, "user", "b"), (5, None, "user", "a"), (5, 0, "user", "a"), (5, 0, "user", "a"), (6, 1, None, None), (6, 1, "", ""),
            (7, 0, "us", "erx"), (8, 0, "user", "x"), (9, 0, "use", "rx"), (13, 0, "user", "only"), (5, 3, "a" * 1000, "é" * 100_000)]
    assert trie(spark, rows) == plain(rows)
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert trie(spark, [(lone, 0, "user", "x")]) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_conversation_over_several_tasks(spark):
    rows = [(10, t, "user", f"t{t % 7}") for t in range(3000)] + [(c, 0, "user", "hi") for c in range(20, 320)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        placed = prefix_trie.placed_turns(turns, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    r = prefix_trie._constant(0)
    f = 0
    for k, row in enumerate(placed.where("conv_id = 10").orderBy("pos").collect()):
        f = (f * r + prefix_trie._whole(row.d_hi, row.d_lo)) % prefix_trie.P
        assert row.pos == k + 1 and prefix_trie._whole(row.f_hi, row.f_lo) == f
    assert k == 2999


def test_colliding_fingerprints_are_found_and_redone(spark, monkeypatch):
    real = prefix_trie._constant
    calls = []

    def weak(salt):
        calls.append(salt)
        return 1 if salt == 0 else real(salt)  # sums: the order of turns is lost
    monkeypatch.setattr(prefix_trie, "_constant", weak)
    rows = [(1000 + 5 * i, t, "user", x) for i, word in enumerate(["abcdefghij", "bacdefghij", "abcdefghji"]) for t, x in enumerate(word)]
    assert trie(spark, rows) == plain(rows)
    assert max(calls) == 1


def test_long_lists_of_ends(spark):
    ids = list(range(0, 30_000))
    ends = spark.createDataFrame([(1, 0, 0, i) for i in ids] + [(2, 5, -5, 7)], "depth long, f_hi long, f_lo long, conv_id long").repartition(16)
    got = {r.depth: r.ends_sha256 for r in prefix_trie.ends_digests(ends).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"7").hexdigest()}
