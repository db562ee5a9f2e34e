"""Registered queries of the training-data operators: against their SQL, or
against plain Python over all rows, on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from devicegrid.llm import queries as q
from devicegrid.llm import sql
from devicegrid.plans.compare import compare, duckdb_conn


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    r = compare(spark, name, sf_dir, q.QUERIES, sql.ORACLE_SQL, duckdb_conn(sf_dir))
    assert r["status"] == "match", r


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_toxicity_scores_every_document(spark, documents):
    # The smallest tables label too few documents; a larger one shows that it learns.
    larger = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in q.op2_toxicity(spark, larger).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    held = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.97
    assert sum(s >= 0.5 for s in toxic) > 0.75 * len(toxic) and sum(s >= 0.5 for s in clean) < 0.01 * len(clean)


def test_language_id_held_out(spark, sf_dir, documents):
    rows = q.op3_language_id(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.95


def test_sharding(spark, sf_dir, documents):
    rows = q.op4_sharding(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        data = (documents[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert 0 < sum(r.grown_shard == 8 for r in rows) < len(rows) / 4


def test_sentencepiece_equals_the_library(spark, sf_dir, documents):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=q.piece_model())
    rows = q.op6_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        ids = np.array(library.encode(documents[r.doc_id].text), "<i4")
        assert (r.n_tokens, r.ids_sha256, r.round_trip) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), True)


def test_repeated_bytes_brute_force(spark, sf_dir, documents):
    data = {i: (r.text or "").encode() for i, r in documents.items()}
    seen = Counter(b[s:s + 400] for b in data.values() for s in range(len(b) - 399))
    rows = {r.doc_id: r for r in q.op9_suffix_array_dedup(spark, sf_dir).collect()}
    assert rows.keys() == data.keys()
    for i, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 399):
            if seen[b[s:s + 400]] > 1:
                gone[s:s + 400] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())


def test_repeated_words_brute_force(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in q.op10_substring_dedup(spark, sf_dir).collect()}
    assert rows.keys() == documents.keys()
    seen = set()
    for i in sorted(documents):
        words = re.findall(r"[^\x20\x09-\x0D]+", documents[i].text or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s:s + 20])
            if window in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        r = rows[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_pipeline_brute_force(spark, sf_dir, documents):
    import sentencepiece
    docs = [r for r in documents.values() if any(c.isalpha() for c in r.text or "")]
    last = {r.text: r for r in sorted(docs, key=lambda r: r.doc_id)}
    docs = sorted(last.values(), key=lambda r: r.doc_id)
    sets = []
    for r in docs:
        w = words_of(r.text)
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = [r for i, r in enumerate(docs) if label[i] == i]
    tests = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words_of(r.text)
        n = min(10, len(w))
        tests |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
    sizes = {len(t) for t in tests}
    clean = [r for r in docs if not any(tuple(w[i:i + n]) in tests for w in [words_of(r.text)] for n in sizes for i in range(len(w) - n + 1))]
    library = sentencepiece.SentencePieceProcessor(model_file=q.piece_model())
    expected = {r.doc_id: library.encode(r.text) for r in clean}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == expected and len(rows) == len(expected)
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), sf_dir).columns == docs.columns, name
