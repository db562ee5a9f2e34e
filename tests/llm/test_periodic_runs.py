"""Periodic runs against a plain search over all starts and periods."""

import hashlib
import random
import re
import zlib

import pytest

from devicegrid.llm import periodic_runs
from devicegrid.llm import queries as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    out, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if length >= max(least, 2 * p):
                out.setdefault((i, length), p)  # the smallest period of a stretch comes first
            i = j
    return sorted((i, length, p) for (i, length), p in out.items())


def plain_collapse(words, runs):
    gone = {k for i, length, p in runs for k in range(i + p, i + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def built(rng):
    parts = []
    for _ in range(rng.randint(1, 4)):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        times = rng.randint(1, 9)
        parts += (unit * times)[:rng.randint(1, len(unit) * times)]
        parts += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 8))]
    return parts


def test_chunks_equal_the_plain_search():
    rng = random.Random(13)
    texts = [built(rng) for _ in range(1500)] + [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 700, list("ab") * 300 + list("c") + list("ab") * 300]
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), [rng.choice("ab") for _ in range(800)]]
    for least in (12, 5):
        for at in range(0, len(texts), 300):
            part = texts[at:at + 300]
            runs, collapsed = periodic_runs.texts_runs([" ".join(t).encode() for t in part], least)
            for t, r, c in zip(part, runs, collapsed):
                assert r == plain_runs(t, least), t
                assert c.decode() == plain_collapse(t, r)


def test_packing_of_many_codes_is_exact():
    import numpy as np
    codes = np.array([5, 6, 7, 8, 9, 10, 5, 6, 7, 8, 9, 11, 5, 6, 7, 8, 9, 10], np.int64)
    doc = np.zeros(len(codes), np.int64)
    small = periodic_runs.gram_classes(codes, doc, 6)
    large = periodic_runs.gram_classes(np.where(codes == 5, 1 << 29, codes), doc, 6)  # two to a key
    assert small[0] == small[12] != small[6] and large[0] == large[12] != large[6]


def test_awkward_rows(spark):
    rows = [(1, None, "r"), (2, "", "r"), (None, "a " * 30, "r"), (3, "x\ty  " * 20, "r"), (3, "x\ty  " * 20, "r"), (4, " \n", "r"), (5, "日本 🎉 " * 40_000, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = sorted(periodic_runs.find_runs(docs, ["doc_id", "runs"]).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in out]
    assert got == [(None, [(0, 30, 1)], "a"), (1, [], ""), (2, [], ""), (3, [(0, 40, 2)], "x y "), (3, [(0, 40, 2)], "x y "), (4, [], ""),
                   (5, [(0, 80_000, 2)], "日本 🎉")]
    assert periodic_runs.find_runs(docs.where("false")).count() == 0


def test_query_equals_the_plain_search(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = q.op13_periodic_runs(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    some = 0
    for r in rows:
        words = WORD.findall(docs[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            runs = [tuple(x) for x in periodic_runs.texts_runs([" ".join(words).encode()])[0][0]]  # the plain search is quadratic
        else:
            runs = plain_runs(words)
        some += bool(runs)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert some > 10
