"""Registered queries of the operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid.llm import chat_format, decontaminate, exact_dedup, jaccard_join, langid, periodic_runs, prefix_trie, secret_scan, sentencepiece_codec, sharding, substring_dedup, suffix_dedup, toxicity
from devicegrid.llm.common import id_crc32, read, text_of


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, digests read back from the output."""
    said = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    chats = chat_format.format_chats(turns.unionByName(extra))
    back = chats.withColumn("turns", chat_format.parse_chats(F.col("formatted")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = chat_format.unescape(F.array_join(F.filter("segments", lambda s: s["loss"])["text"], ""))
    return back.withColumn("learnt", learnt).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn where crc32(doc_id) mod 5 is not 0, score every document."""
    docs = read(spark, sf_dir, "documents")
    learn = id_crc32() % 5 != 0
    model = toxicity.fit(docs.select("doc_id", "text"), read(spark, sf_dir, "labels").where(learn).select("doc_id", "toxic"))
    return toxicity.score(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", (~learn).alias("held_out"), "score", "predicted")


def language_model(docs: DataFrame) -> langid.Model:
    """Learnt from the texts and languages of rows whose crc32(doc_id) mod 3 is not 1."""
    return langid.fit(docs.where(id_crc32() % 3 != 1).select("doc_id", "lang", "text"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt where crc32(doc_id) mod 3 is not 1."""
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs.select("doc_id", "text"), language_model(docs), ["doc_id"]).select(
        "doc_id", (id_crc32() % 3 == 1).alias("held_out"), "lang_pred", "score")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards, and in nine."""
    tree = sharding.regular_tree(8)
    return sharding.shard_rows(read(spark, sf_dir, "documents"), tree, sharding.add_shard(tree))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays; one row per document."""
    return exact_dedup.mark_duplicates(read(spark, sf_dir, "documents"))


def piece_model() -> str:
    """Path of the SentencePiece model: a parameter, by default the public 32k one."""
    return os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again to compare."""
    return sentencepiece_codec.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), ["doc_id"], digest=True)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: five words, similarity 0.8."""
    return jaccard_join.join_classes(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and benchmark items hit by windows of ten words, for every document."""
    hits = decontaminate.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in 400-byte strings that start anywhere else go."""
    return suffix_dedup.find_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 20 words that also start earlier go."""
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, their heads taken from other ones."""
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by fixed patterns and by inferred formats."""
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat(
            s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.KINDS))
    return found.select("doc_id", *map(number, secret_scan.KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def wrapped_words(text: Column, h: Column) -> Column:
    """The text, or where ``h`` is a multiple of ten its words made periodic from
    word a on: word i becomes word a + (i - a) % p."""
    g = F.floor(h / 10)

    def turned(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        return F.concat(F.slice(words, 1, a), F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), 1, n - a))

    # A list of one, so that the words are extracted once.
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0))
    return F.when(h % 10 == 0, F.array_join(F.transform(words, turned)[0], " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, and its words without their repeats."""
    docs = read(spark, sf_dir, "documents").select("doc_id", wrapped_words(text_of(), id_crc32()).alias("text"))
    found = periodic_runs.find_runs(docs, ["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.short")).alias("period"), F.expr("1000 * top.length div -top.short").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_sharding": op4_sharding,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secret_scan": op12_secret_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
