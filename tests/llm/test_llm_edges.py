"""Defined results of the training-data operators on awkward rows: nulls, empty
and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
from itertools import combinations, pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicegrid.llm import (chat_format, common, components, decontaminate, exact_dedup, jaccard_join, langid, repeats,
                            sentencepiece_codec, sharding, substring_dedup, suffix_dedup, toxicity)
from devicegrid.llm.queries import piece_model

SCHEMA = "doc_id long, text string, lang string, hash string, node string, score string, key string, `n` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "h", "n", "s", "k", 1) for i, t, lang in rows], SCHEMA)


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SAME = " ".join(f"same{i}" for i in range(200))
ROWS = [(1, None, "en"), (2, "", "de"), (3, SAME, "en"), (3, SAME, "en"), (4, SAME, None), (None, SAME, "en"), (None, None, None),
        (5, LONG, "en"), (6, "a", "fr"), (7, "\n\t  ", "fr"), (3, "another text under the same id", "de"), (8, "日本語 🎉 \u0000 ok", "en")]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def anonymous_mb():
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:")) // 1024


def test_release_memory_gives_back_what_malloc_holds():
    # Every hundredth array stays, so that malloc does not give back the rest by itself.
    arrays = [np.ones(12_000) for _ in range(3000)]
    kept = arrays[::100]
    del arrays
    before = anonymous_mb()
    common.release_memory()
    assert anonymous_mb() < before - 100 and len(kept) == 30


def test_large_arrays_go_back_as_they_are_freed():
    common.release_memory()
    np.ones(4_000_000)  # malloc would keep arrays up to this size from now on
    arrays = [np.ones(1_000_000) for _ in range(30)]
    kept = arrays[-1]
    before = anonymous_mb()
    del arrays
    assert anonymous_mb() < before - 100 and len(kept) == 1_000_000


# -- 1 chat formatting

def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string, state string")


def test_chat_round_trip_of_awkward_texts(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "&amp; &#60;s> & <<SYS>>", None, "", "<s<s>>", "a" * 300_000, "x\ny\n"]
    rows = [(1, i, ("user", "assistant")[i % 2], t, "", "") for i, t in enumerate(nasty)]
    rows += [(2, 0, "odd\nrole<s>", "hi", "", ""), (None, None, None, None, "", ""), (3, 1, "user", "b", "", ""), (3, 1, "user", "b", "", "")]
    out = {r.conv_id: r for r in chat_format.format_chats(chats(spark, rows)).withColumn(
        "turns", chat_format.parse_chats(F.col("formatted"))).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(("user", "assistant")[i % 2], t or "") for i, t in enumerate(nasty)]
    assert "".join(s.text for s in out[1].segments) == out[1].formatted
    assert [(t.role, t.text) for t in out[2].turns] == [("odd\nrole<s>", "hi")] and not out[2].valid
    assert out[None].n_turns == 1 and out[3].n_turns == 2
    assert out[3].bad_turn == 1 and out[1].valid and out[1].bad_turn is None


def test_chat_machine_follows_the_template(spark):
    template = chat_format.ChatTemplate(transitions={"start": {"user": "done"}}, accepting=("done",), loss_roles=("user",))
    out = chat_format.format_chats(chats(spark, [(1, 0, "user", "x", "", "")]), template).collect()[0]
    assert out.valid and [s.text for s in out.segments if s.loss] == ["x"]
    assert chat_format.format_chats(chats(spark, [])).count() == 0
    with pytest.raises(ValueError):
        chat_format.format_chats(chats(spark, []), chat_format.ChatTemplate(control=("abc",)))


# -- 2 toxicity

def test_toxicity_without_labels_or_rows(spark, awkward, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(awkward, labels)
    rows = toxicity.score(awkward, model, ["doc_id", "hash"]).collect()
    assert len(rows) == len(ROWS) and all(r.predicted == 0 and 0 < r.score < 0.5 for r in rows)
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0


def test_ftrl_equals_the_plain_loop():
    rng = random.Random(3)
    rows = [(np.array(sorted({0, *(rng.randrange(1, 30) for _ in range(6))})), rng.randrange(2)) for _ in range(60)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.3, 0.1
    z, n = [0.0] * 30, [0.0] * 30

    def weight(i):
        sign = 1 if z[i] > 0 else -1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - sign * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(2):
        for at, y in rows:
            g = 1 / (1 + np.exp(-sum(weight(i) for i in at))) - y
            w = {i: weight(i) for i in at}
            for i in at:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    got = toxicity.ftrl(rows, alpha, beta, l1, l2, 2)
    assert np.allclose(got[:30], [weight(i) for i in range(30)]) and not got[30:].any()


def test_a_rare_label_is_in_the_sample(spark):
    docs = frame(spark, [(i, "vile insult" if i % 1500 == 7 else f"plain words {i % 7}", "en") for i in range(4000)])
    labels = docs.select("doc_id", (F.col("doc_id") % 1500 == 7).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, max_rows=40, l1=0.1)
    rows = toxicity.score(docs, model, ["doc_id"]).collect()
    assert model[1].max() > 0  # learnt from a toxic text
    assert min(r.score for r in rows if r.doc_id % 1500 == 7) > 10 * max(r.score for r in rows if r.doc_id % 1500 != 7)
    assert {r.doc_id for r in rows if r.predicted} <= set(range(7, 4000, 1500))


# -- 3 language identification

def test_language_of_awkward_rows(spark, awkward, empty):
    learn = frame(spark, [(i, "the cat and the dog", "en") for i in range(20)] + [(i, "der hund und die katze", "de") for i in range(20, 41)])
    model = langid.fit(learn)
    rows = langid.predict(awkward, model, ["doc_id", "text"]).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    score = model.scorer()
    assert score("DOGS und")[0] in ("de", "en") and score("the")[0] == "en" and score("katzen")[0] == "de"
    assert score("½ ² 12") == ("und", 0.0) and score("жж") == ("de", 0.5)
    assert langid.predict(awkward, langid.fit(empty), ["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(empty, model, ["doc_id"]).count() == 0


def test_a_rare_language_is_learnt_and_does_not_win_others(spark):
    rows = [(i, f"the cat and the dog w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}", "en") for i in range(6000)]
    rows += [(i, "mbwa na paka wa jirani", "sw") for i in range(6000, 6012)] + [(6012, "once only", "xx")]
    score = langid.fit(frame(spark, rows), max_rows=3000).scorer()
    assert score("mbwa wa jirani")[0] == "sw" and score("waa")[0] == score("wbc")[0] == score("the dog")[0] == "en"
    assert langid.fit(frame(spark, rows), max_rows=300).scorer()("mbwa wa jirani")[0] == "sw"
    assert langid.equal_parts({"a": 2, "b": 10, "c": 100}, 22) == {"a": 1.0, "b": 1.0, "c": 0.1}
    model = langid.fit(frame(spark, rows))
    assert model.langs == ["en", "sw"]


def test_language_memo_does_not_change_votes():
    words = {w: np.array([-1.0, -4.0]) for w in ("aa", "bb")}
    model = langid.Model(["x", "y"], 0, words, {"c": np.array([-5.0, -1.0])})
    score = model.scorer()
    text = " ".join(f"aa{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(15_000)) + " bb"
    assert score(text) == model.scorer()(text) == score(text)


# -- 4 sharding

def test_sharding_awkward_rows(spark, awkward, empty):
    tree = sharding.regular_tree(5)
    rows = sharding.shard_rows(awkward, tree, sharding.add_shard(tree), buckets=3).collect()
    assert len(rows) == len(ROWS)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert sharding.shard_rows(empty, tree).count() == 0
    with pytest.raises(ValueError):
        sharding.leaf(0, 0.0)


def test_weight_change_moves_only_through_its_subtree(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    a = sharding.Node("a", (sharding.leaf(0), sharding.leaf(1)))
    b = sharding.Node("b", (sharding.leaf(2), sharding.leaf(3)))
    heavy = sharding.Node("b", (sharding.leaf(2), sharding.leaf(3, 3.0)))
    rows = keys.select(sharding.place(F.col("k"), sharding.Node("r", (a, b))).alias("old"),
                       sharding.place(F.col("k"), sharding.Node("r", (a, heavy))).alias("new")).collect()
    moved = [r for r in rows if r.old != r.new]
    assert moved and all(r.new in (2, 3) for r in moved) and not any(r.old == 3 for r in moved)
    assert abs(sum(r.new == 3 for r in rows) / 4000 - 0.5) < 0.04 and abs(sum(r.old == 0 for r in rows) / 4000 - 0.25) < 0.04


# -- 5 exact de-duplication

def expect_classes(rows):
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(t or "", []).append(i)
    return sorted(((i, max((x for x in texts[t or ""] if x is not None), default=None), len(texts[t or ""])) for i, t, _ in rows), key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_classes(awkward, empty, weak):
    # A hash of one value makes all texts collide: only the bytes tell them apart.
    hashed = (lambda c: F.unhex(F.lit("00"))) if weak else exact_dedup.content_hash
    rows = exact_dedup.mark_duplicates(awkward, hashed=hashed).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in rows), key=repr) == expect_classes(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    kept = exact_dedup.deduplicate(awkward, hashed=hashed)
    assert kept.columns == awkward.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({t or "" for _, t, _ in ROWS})
    assert exact_dedup.mark_duplicates(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


# -- 6 SentencePiece

def test_units_by_lattice_equal_the_task_fold(spark):
    model = sentencepiece_codec.Model(piece_model())
    units = ["▁the", "▁tionality", "▁日本🎉x", "z", "aaaaaaaaaaaaa", "\n", "▁▁▁▁", "▁"]
    df = spark.createDataFrame([(u, 1) for u in units + units], "unit string, ids int")
    for kind in (sentencepiece_codec.BPE, sentencepiece_codec.UNIGRAM):
        model.kind = kind
        assert {r.unit: list(r.ids) for r in sentencepiece_codec.encode_units(df, model).collect()} == {u: model.fold(u) for u in units}


def test_viterbi_is_the_best_segmentation():
    model = sentencepiece_codec.Model(piece_model())
    model.kind = sentencepiece_codec.UNIGRAM
    for word in ("▁theon", "thanti", "erea", "x日y"):
        def cost(cuts):
            parts = [word[a:b] for a, b in pairwise((0, *cuts, len(word)))]
            return sum(model.scores.get(p, model.unknown if len(p) == 1 else -np.inf) for p in parts)
        best = max(cost(c) for n in range(len(word)) for c in combinations(range(1, len(word)), n))
        assert sum(model.scores.get(p, model.unknown) for p in model.best_path(word)) == best


def test_long_units_merge_alike():
    model = sentencepiece_codec.Model(piece_model())
    rng = random.Random(5)
    for _ in range(30):
        unit = "".join(rng.choice("abtherin▁ o") for _ in range(45))
        assert model.merged_long(list(unit)) == model.merged(unit)


def test_encode_and_decode_awkward_rows(spark, awkward, empty):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = sentencepiece_codec.encode(awkward, piece_model(), ["doc_id", "text", "key"], max_units=20)
    got = rows.collect()
    assert len(got) == len(ROWS) and all((r.ids is None) == (r.text is None) for r in got)
    assert all(list(r.ids) == library.encode(r.text) for r in got if r.text is not None)
    back = sentencepiece_codec.decode(rows.withColumnRenamed("text", "was"), piece_model(), ["doc_id", "was"]).collect()
    assert all(r.text == r.was for r in back)
    assert sentencepiece_codec.encode(empty, piece_model(), ["doc_id"]).count() == 0


def test_every_unit_passes_the_lattice(spark, monkeypatch):
    import sentencepiece
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abtherin日") for _ in range(rng.randint(1, 9))) for _ in range(30)) for _ in range(40)]
    texts += ["x" * 300 + " the end", "", None, texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for max_units in (50, 500_000):
        got = sentencepiece_codec.encode(docs, piece_model(), ["doc_id"], max_units=max_units).collect()
        assert {r.doc_id: r.ids for r in got} == {i: None if t is None else library.encode(t) for i, t in enumerate(texts)}
    model = sentencepiece_codec.Model(piece_model())
    monkeypatch.setattr(sentencepiece_codec, "_folded", lambda whole, model: whole.select("unit", F.array(F.lit(7)).alias("ids"), "at"))
    got = {r.doc_id: r.ids for r in sentencepiece_codec.encode(docs.where("doc_id < 40"), piece_model(), ["doc_id"], max_units=50).collect()}
    assert got == {i: [7] * len(model.units(t)) for i, t in enumerate(texts[:40])}


def test_lattices_fold_alike_wherever_their_edges_are_cut(spark):
    model = sentencepiece_codec.Model(piece_model())
    rng = random.Random(7)
    units = {"".join(rng.choice("abtherin日▁.") for _ in range(rng.randint(1, 14))) for _ in range(400)} | {"\n", "x" * 300, "the" * 120}
    df = spark.createDataFrame([(u, str(i)) for i, u in enumerate(sorted(units))], "unit string, at string")
    for kind in (sentencepiece_codec.BPE, sentencepiece_codec.UNIGRAM):
        model.kind = kind
        got = sentencepiece_codec._folded(df, model, at_once=50).collect()
        assert {r.unit: (list(r.ids), r.at) for r in got} == {u: (model.fold(u), str(i)) for i, u in enumerate(sorted(units))}
        assert len(got) == len(units)


def test_packs_are_made_once_and_small(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghinorstuv") for _ in range(rng.randint(2, 14))) for _ in range(5000)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) + "\nend" for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = sentencepiece_codec.encode(docs, piece_model(), ["doc_id"], digest=True)
    assert all(r.round_trip for r in rows.collect())
    # The units and the documents of a pack come from one exchange.
    assert "ReusedExchange" in rows._jdf.queryExecution().executedPlan().toString()
    packs = sentencepiece_codec._packs(docs, sentencepiece_codec.Model(piece_model()), ["doc_id"], 500_000, 16)
    size = packs.agg(F.sum(F.length("__data") + F.coalesce(F.length("__at"), F.lit(0)))).first()[0]
    assert size < 0.5 * sum(map(len, texts))


# -- 7 n-gram Jaccard join

def shingles(text):
    words = [w.decode() for w in decontaminate.words_of((text or "").encode())]
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else None


def brute_classes(rows):
    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {x: min((rows[i][0] for i in range(len(rows)) if label[i] == x and rows[i][0] is not None), default=None) for x in label}
    return [(r[0], least[x], n) for r, x, n in zip(rows, label, links)]


def test_join_classes_brute_force(spark, awkward, empty):
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join_classes(awkward).collect()), key=repr)
    # Word-free rows are classes of their own.
    assert got == sorted((x if shingles(r[1]) else (r[0], r[0], 0) for r, x in zip(ROWS, brute_classes(ROWS))), key=repr)
    assert jaccard_join.join_classes(empty).count() == 0
    assert jaccard_join.keep_one(awkward).columns == awkward.columns


def test_large_groups_go_block_by_block(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(words), "en"))
    rows += [(100 + i, " ".join(f"{i}v{j}" for j in range(50)), "en") for i in range(20)]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join_classes(frame(spark, rows), small=8).collect()), key=repr)
    assert got == sorted(brute_classes(rows), key=repr)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


# -- 8 decontamination

def test_decontamination_in_passes(spark, awkward, empty):
    items = spark.createDataFrame([(1, "Same5 same6, SAME7 same8 same9 same10 same11 same12 same13 same14 same15"), (2, "a"), (None, None),
                                   (3, " -- "), (2, "a")], "item_id int, text string")
    one = decontaminate.scan(awkward, items, ["doc_id", "text"]).collect()
    many = decontaminate.scan(awkward, items, ["doc_id", "text"], max_windows=1).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many)) and len(one) == len(ROWS)
    by_text = {r.text: r for r in one}
    assert by_text[SAME]["n_hit"] == 11 and by_text[SAME]["items"] == ["1"] and by_text["a"]["items"] == ["2"]
    assert by_text[None]["n_words"] == 0 and by_text[LONG]["n_hit"] == 0
    left = decontaminate.decontaminate(awkward, items)
    assert left.columns == awkward.columns and left.count() == len(ROWS) - 5
    cut = {r.text for r in decontaminate.decontaminate(awkward, items, remove="spans").collect()}
    assert SAME.replace(" ".join(f"same{i}" for i in range(5, 16)), "") in cut and "" in cut
    assert decontaminate.decontaminate(awkward, items.limit(0)).count() == len(ROWS)
    assert decontaminate.scan(empty, items, ["doc_id"]).count() == 0


# -- 9 and 10 repeated windows

@pytest.mark.parametrize("max_classes", [1, 1000])
def test_repeats_of_awkward_rows(spark, awkward, empty, max_classes):
    rows = suffix_dedup.find_repeats(awkward, window=40, gram=9, max_classes=max_classes).collect()
    data = [(t or "").encode() for _, t, _ in ROWS]
    seen = {}
    for b in data:
        for s in range(len(b) - 39):
            seen[b[s:s + 40]] = seen.get(b[s:s + 40], 0) + 1
    expected = []
    for (i, _, _), b in zip(ROWS, data):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 39):
            if seen[b[s:s + 40]] > 1:
                gone[s:s + 40] = True
        expected.append((i, len(b), int(gone.sum())))
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in rows), key=repr) == sorted(expected, key=repr)
    assert suffix_dedup.find_repeats(empty).count() == 0


@pytest.mark.parametrize("max_classes", [1, 1000])
def test_earlier_windows_of_awkward_rows(spark, awkward, empty, max_classes):
    rows = substring_dedup.remove_repeats(awkward, window=6, gram=2, max_classes=max_classes).collect()
    # One document per (id, text); null ids first, then by id and text digest.
    order = sorted({(i is not None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), i, t or "") for i, t, _ in ROWS}, key=lambda x: x[:3])
    seen, expected = set(), {}
    for _, _, _, i, t in order:
        words = t.encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - 5):
            w = tuple(words[s:s + 6])
            if w in seen:
                gone[s:s + 6] = [True] * 6
            seen.add(w)
        expected[i, t] = (len(words), sum(gone))
    assert sorted(((r.doc_id, r.n_words, r.n_removed) for r in rows), key=repr) == sorted(((i, *expected[i, t or ""]) for i, t, _ in ROWS), key=repr)
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("max_classes", [16_384, 1])
def test_a_row_given_twice_keeps_first_occurrences(spark, max_classes):
    shared = [f"s{i}" for i in range(30)]
    twice = " ".join([f"a{i}" for i in range(40)] + shared + [f"b{i}" for i in range(40)])
    other = [f"c{i}" for i in range(40)] + shared + [f"d{i}" for i in range(40)]
    rows = frame(spark, [(1, twice, "en"), (1, twice, "en"), (2, " ".join(other), "en")])
    got = sorted((r.doc_id, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(rows, max_classes=max_classes, with_text=True).collect())
    assert got == [(1, 0, twice), (1, 0, twice), (2, 30, " ".join(other[:40] + other[70:]))]


def test_periodic_texts(spark):
    rows = [(1, "a" * 900, "en"), (2, "ab" * 300, "en"), (3, "b" + "a" * 420, "en"), (4, "la " * 50, "en"), (5, "la la", "en")]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.find_repeats(frame(spark, rows)).collect()}
    assert got == {1: 900, 2: 600, 3: 420, 4: 0, 5: 0}
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 49, 5: 0}


def test_indexes_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        bodies = [np.array([rng.randrange(1, 4) for _ in range(rng.randrange(8, 60))]) for _ in range(6)]
        counts, docs, starts = [len(b) - 5 for b in bodies], [rng.randrange(3) for _ in bodies], [100 * i for i in range(6)]
        where = {}
        for b, d, s in zip(bodies, docs, starts):
            for i in range(len(b) - 5):
                where.setdefault(tuple(b[i:i + 6]), []).append((d, s + i))
        again = [[i for i in range(len(b) - 5) if len(where[tuple(b[i:i + 6])]) > 1] for b in bodies]
        later = [[i for i in range(len(b) - 5) if min(where[tuple(b[i:i + 6])]) != (d, s + i)] for b, d, s in zip(bodies, docs, starts)]
        assert [m.tolist() for m in suffix_dedup.mark(bodies, counts, docs, starts, 6)] == again
        assert [m.tolist() for m in substring_dedup.mark([b.astype(np.uint64) for b in bodies], counts, docs, starts, 6)] == later


def test_runs_cover_every_window_once_and_depend_on_content_alone():
    rng = np.random.default_rng(2)
    powers = repeats.Powers()
    text = rng.integers(1, 5, 3000).astype(np.uint64)
    twice = np.concatenate((text[500:900], rng.integers(1, 5, 777).astype(np.uint64), text[500:900]))
    (key, seg, first, count), = repeats.runs(twice, 50, 10, powers)
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == len(twice) - 49
    inner = [(k, s) for k, s, f, c in zip(key, seg, first, count) if 50 < f and f + c < 300]
    again = [(k, s) for k, s, f, c in zip(key, seg, first, count) if 1177 + 50 < f and f + c < 1177 + 300]
    assert inner and inner == again


def thue_morse(n, a, b):
    word = a
    for _ in range(n):
        word += word.translate(str.maketrans(a + b, b + a))
    return word


def test_substring_dedup_tells_words_of_equal_polynomial_sums_apart(spark):
    for n in (10, 11, 12):
        x, y = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
        rest = " ".join(f"w{i}" for i in range(19))
        docs = frame(spark, [(1, f"{x} {rest}", "en"), (2, f"{y} {rest}", "en"), (3, f"{x} {rest}", "en")])
        got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
        assert got == {1: 0, 2: 0, 3: 20}


def test_result_columns_win_over_kept_ones(spark):
    rows = [(i, "the cat and the dog " * 3 + str(i), "en", 0.5, "x", 7) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, predicted int")
    model = langid.fit(docs)
    found = langid.predict(docs, model, docs.columns)
    assert sorted(found.columns) == sorted(docs.columns) and {r.lang_pred for r in found.collect()} == {"en"}
    kept = langid.with_language(docs.union(docs.limit(1).withColumn("text", F.lit(None).cast("string"))), model)
    assert kept.columns == docs.columns and kept.count() == 20 and {r.lang_pred for r in kept.collect()} == {"x"}
    toxic = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    scored = toxicity.score(docs, toxic, docs.columns).collect()
    assert len(scored) == 20 and all(r.predicted in (0, 1) for r in scored)
    pieces = sentencepiece_codec.encode(docs.withColumn("ids", F.lit("x")), piece_model(), ["doc_id", "ids", "text"], max_units=20)
    assert all(len(r.ids) for r in pieces.collect())
    assert sentencepiece_codec.decode(pieces, piece_model(), ["doc_id", "text"]).where("text is null").count() == 0


def test_near_copies_of_long_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "WEIGHT", 3000)
    monkeypatch.setattr(jaccard_join, "PART", 1000)
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = [(i, " ".join(base[:380 + i % 20] + [f"tail{i}"]), "en") for i in range(60)]
    out = {r.doc_id: r for r in jaccard_join.join_classes(frame(spark, rows)).collect()}
    assert {(r.class_id, r.n_links, r.class_rows) for r in out.values()} == {(0, 59, 60)}


def test_a_threshold_beyond_the_runs_is_an_error():
    with pytest.raises(ValueError):
        jaccard_join.runs_for(0.5, 0.99999)
