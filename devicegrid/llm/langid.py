"""Language identification with word-first backoff.

A known word votes with its log frequency in each language.  A word never
seen votes with the mean log frequency of its character n-grams (with word
ends marked), the longest n of which any n-gram is known: 4, 3, 2, then 1.
Votes are added up and turned into a posterior over the learnt languages.

Fitting counts words in Spark tasks over a bounded sample of labelled rows
(``max_rows`` in expectation, by hash of the id): an equal number of each
language, all rows of a language with fewer.  A word not seen in a language
counts as frequent as in the largest sample, so that a language with little
text does not win the rare words of others.  The model holds at most
``max_words`` words and ``max_grams`` n-grams per language and length, so it is
small enough to broadcast whatever the corpus size.  Scoring needs no shuffle
and reads every text whole.

Defined results
* ``und`` with score 0 if the text is null or has no letter;
* letters that no n-gram knows: the language with most training rows, score
  1/languages; ties in votes: the first language in alphabetical order;
* a language of which no word is learnt is not predicted; with nothing to
  learn from, every text is ``und``;
* a null id counts as empty text in the split; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devicegrid.llm.common import release_memory

MAX_N = 4
WORD = re.compile(r"[^\W\d_]+")
#: A vote may favour one language over another by at most e to this power.
FLOOR = -6.0
#: Words whose votes a task keeps (for four languages), and words looked up at once.
MEMO, PART = 160_000, 40_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single signs without the marks."""
    if n == 1:
        return list(word)
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies: words and n-grams, each with a value per language."""

    def __init__(self, langs: list[str], fallback: int, words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.langs, self.fallback = langs, fallback
        self.word_at, self.gram_at = ({k: i for i, k in enumerate(x)} for x in (words, grams))
        none = np.zeros((0, max(1, len(langs))), np.float32)
        self.word_rows, self.gram_rows = (np.array(list(x.values()), np.float32) if x else none for x in (words, grams))

    def parts(self) -> dict:
        """Plain values, to be broadcast."""
        return self.__dict__

    @classmethod
    def of(cls, parts: dict) -> "Model":
        model = cls.__new__(cls)
        model.__dict__.update(parts)
        return model

    def votes(self, words: list[str]) -> np.ndarray:
        """A row per word: log frequencies less their maximum, not below FLOOR; zeros if nothing is known."""
        out = np.zeros((len(words), max(1, len(self.langs))), np.float32)
        known = [(i, at) for i, w in enumerate(words) if (at := self.word_at.get(w)) is not None]
        if known:
            out[[i for i, _ in known]] = self.word_rows[[at for _, at in known]]
        get, flat, size, rest = self.gram_at.get, [], [], []
        for i, w in enumerate(words):
            if w in self.word_at:
                continue
            for n in range(MAX_N, 0, -1):
                found = [at for g in grams_of(w, n) if (at := get(g)) is not None]
                if found:
                    flat += found
                    size.append(len(found))
                    rest.append(i)
                    break
        if rest:
            size = np.array(size)
            out[rest] = np.add.reduceat(self.gram_rows[flat], np.cumsum(size) - size) / size[:, None]
        return np.maximum(out - out.max(axis=1, keepdims=True), FLOOR)

    def scorer(self):
        """A function text -> (language, score) that keeps the votes of many words."""
        size = max(2 * PART, MEMO // max(4, len(self.langs)) * 4)
        votes = np.zeros((size + 1, max(1, len(self.langs))), np.float32)
        rows: dict[str, int] = {}  # 0: a word without a letter

        def learn(words: set[str]) -> None:
            if len(rows) + len(words) > size:
                rows.clear()
            lettered = [w for w in words if w.isalpha() or any(c.isalpha() for c in w)]
            first = len(rows) + 1
            votes[first:first + len(lettered)] = self.votes(lettered)
            rows.update(zip(lettered, range(first, first + len(lettered))))
            if len(lettered) < len(words):
                rows.update(dict.fromkeys(words.difference(lettered), 0))

        def score(text: str | None) -> tuple[str, float]:
            words = words_of(text) if text and self.langs else []
            total, any_letter = np.zeros(max(1, len(self.langs))), False
            for k in range(0, len(words), PART):
                part = words[k:k + PART]
                at = [rows.get(w) for w in part]
                if None in at:
                    missing = {w for w, i in zip(part, at) if i is None}
                    if len(rows) + len(missing) > size:
                        missing = set(part)  # starts anew
                    learn(missing)
                    at = [rows[w] for w in part]
                at = np.array(at)
                any_letter |= bool(at.any())
                total += votes[at].sum(axis=0, dtype=np.float64)
            if not any_letter:
                return "und", 0.0
            if not total.any():
                return self.langs[self.fallback], 1.0 / len(self.langs)
            best = int(total.argmax())
            return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())

        return score


def _counts(batches):
    for batch in batches:
        seen: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in seen.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(words), pa.string()),
                "word": pa.array(list(words), pa.string()),
                "n": pa.array(list(words.values()), pa.int64())})
    release_memory()


def _gram_rows(batches):
    for batch in batches:
        seen: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for size in range(1, MAX_N + 1):
                for g in grams_of(word, size):
                    seen[lang, size, g] += n
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in seen], pa.string()),
            "size": pa.array([k[1] for k in seen], pa.int32()),
            "gram": pa.array([k[2] for k in seen], pa.string()),
            "n": pa.array(list(seen.values()), pa.int64())})
    release_memory()


def equal_parts(sizes: dict, max_rows: int) -> dict:
    """The share of each group's rows that a sample of ``max_rows`` takes: an equal
    number of each group, the whole group where it has fewer."""
    shares, left = {}, float(max_rows)
    for done, (group, n) in enumerate(sorted(sizes.items(), key=lambda x: x[1])):
        part = min(n, left / (len(sizes) - done))
        shares[group] = part / n
        left -= part
    return shares


def sampled(group: str, shares: dict) -> Column:
    """True for about the share of its group of the rows, by hash of doc_id."""
    most = F.create_map(*(x for g, share in shares.items() for x in (F.lit(g), F.lit(int(share * 2**63) - 1).cast("long"))))
    return F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col("doc_id")), 1) <= most[F.col(group)]


def fit(docs: DataFrame, max_rows: int = 20_000, max_words: int = 30_000, max_grams: int = 20_000, min_count: int = 3) -> Model:
    """Learn from the rows of ``docs`` with both a language and a text."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], 0, {}, {})
    sample = rows.where(sampled("lang", equal_parts(sizes, max_rows))).select("lang", "text")
    words = (sample.mapInArrow(_counts, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    grams = (words.mapInArrow(_gram_rows, "lang string, size int, gram string, n long")
             .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    top_words = words.withColumn("at", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("at") <= max_words)
    top_grams = grams.withColumn("at", F.row_number().over(
        Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))).where(F.col("at") <= max_grams)

    top_words, top_grams = top_words.collect(), top_grams.collect()
    langs = sorted({r["lang"] for r in top_words})
    if not langs:
        return Model([], 0, {}, {})

    def table(found, key, group) -> dict[str, np.ndarray]:
        col = {x: i for i, x in enumerate(langs)}
        counts: dict[str, np.ndarray] = {}
        total: dict = {}
        for r in found:
            counts.setdefault(r[key], np.zeros(len(langs)))[col[r["lang"]]] += r["n"]
            total.setdefault(group(r), np.zeros(len(langs)))[col[r["lang"]]] += r["n"]
        # A count of 0 is half a word of the largest sample, whatever the language's own.
        least = {g: 0.5 / t.max() for g, t in total.items()}
        of = {k: len(k) if key == "gram" else 0 for k in counts}
        return {k: np.log((v / np.maximum(total[of[k]], 1) + least[of[k]]) / (1 + least[of[k]] * len(counts))) for k, v in counts.items()}

    return Model(
        langs, max(range(len(langs)), key=lambda i: (sizes[langs[i]], -i)),
        table(top_words, "word", lambda r: 0),
        table(top_grams, "gram", lambda r: r["size"]))


def language_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """(lang_pred, score) of a text; only the text goes to Python."""
    shared = spark.sparkContext.broadcast(model.parts())

    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = Model.of(shared.value).scorer()
        for part in parts:
            out = [score(t.as_py()) for t in part]
            yield pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                                             names=["lang_pred", "score"])
        del score
        release_memory()

    return F.arrow_udf(found, "lang_pred string, score double")(text)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, with ``lang_pred`` and ``score`` (kept columns of these names give way)."""
    kept = [c for c in keep if c not in ("lang_pred", "score")]
    found = docs.select(*kept, language_of(docs.sparkSession, model, F.col("text")).alias("__found"))
    return found.select(*kept, "__found.lang_pred", "__found.score")


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language."""
    return docs.where(language_of(docs.sparkSession, model, F.col("text"))["lang_pred"] != "und")
