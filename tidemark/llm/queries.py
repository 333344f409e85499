"""One query per operator, with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    backoff,
    buckets,
    bytepairs,
    chat,
    discriminant,
    forest,
    frames,
    lines,
    merkle,
    mixing,
    packing,
    ranking,
    spelling,
)
from tidemark.llm.shared import fold, stored, table
from tidemark.llm.tokens import ID_BYTES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SEQUENCE_TOKENS = 4096
PACKED_END = 1
FILE_END = 2
SHARD_BYTES = 1 << 20

MIX_PATH = ["domain", "lang", "source"]
# Target shares by node of the tree; what is not named weighs 1 beside its siblings.
MIX_WEIGHTS = {
    "/web": 60, "/books": 25, "/reference": 15,
    "/web/en": 5, "/web/de": 2, "/web/fr": 2, "/books/en": 3, "/reference/en": 2,
    "/web/en/src0": 2,
}
MIX_EPOCHS = 4
MIX_SEED = 17


def packed(docs: DataFrame, keep_words: bool = True) -> DataFrame:
    """The place of every piece of every document, and a digest of its ids."""
    pieces = packing.token_pieces(docs, TOKENIZER, PACKED_END, SEQUENCE_TOKENS, keep_words)
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.place(digests, SEQUENCE_TOKENS, packing.groups_for(docs))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packed(table(spark, sf_dir, "documents"))


def op2_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every document, and whether it stays without its boilerplate."""
    return lines.judge(table(spark, sf_dir, "documents"))


def op3_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document; those of fold 2 of 7 teach the model nothing."""
    return backoff.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document over two-word shingles."""
    return forest.near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("text_key")


def domain_of(source: Column) -> Column:
    """The sources numbered 0 to 9 are web, to 14 books, all others reference."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    number = F.try_to_number(number, F.lit("999999999"))
    return F.when(number < 10, "web").when(number < 15, "books").otherwise("reference")


def op5_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a mix of the size of the corpus, each with the epochs that take it."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source",
        mixing.n_words(F.col("text")).alias("n_tokens"),
    )
    return mixing.mixed(
        stored(docs, "sized"), MIX_PATH, MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED
    )


def op6_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document; rows of fold 1 of 3 are held out of the labels."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = discriminant.fit(docs, labels.where(~held_out))
    return (
        docs.select("doc_id", "text")
        .withColumn("held_out", F.coalesce(held_out, F.lit(False)))
        .withColumn("score", discriminant.score(model, F.col("text")))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .drop("text")
    )


def op7_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, each of at most 1 MiB of text."""
    return buckets.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op8_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written token files hold of every document."""
    docs = table(spark, sf_dir, "documents")
    files = frames.write_token_files(docs, TOKENIZER, FILE_END, frames.token_folder(spark))
    return frames.read_token_files(files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    written = chat.formatted(chat.row_turns(rows.unionByName(extra)))
    turns = chat.read_back(F.col("formatted"))
    learned = F.array_join(chat.under_loss(F.col("formatted"), F.col("loss")), "")
    told = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return written.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_prefix_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the bytes that they stand for, as digests."""
    pattern = public_tokenizers.PATTERN
    coded = bytepairs.encoded(table(spark, sf_dir, "documents"), RANKS, pattern)
    return bytepairs.decoded(coded, RANKS, pattern).select(
        "doc_id",
        F.floor(F.octet_length("ids") / ID_BYTES).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_dual_tree_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return ranking.ranked(items, table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its form, its root and its near words."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_frequency_rules": op2_line_frequency_rules,
    "op3_backoff_automaton": op3_backoff_automaton,
    "op4_lsh_forest": op4_lsh_forest,
    "op5_hierarchical_mixing": op5_hierarchical_mixing,
    "op6_quadratic_discriminant": op6_quadratic_discriminant,
    "op7_extendible_hashing": op7_extendible_hashing,
    "op8_seekable_token_files": op8_seekable_token_files,
    "op9_merkle_fingerprints": op9_merkle_fingerprints,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_prefix_byte_pairs": op11_prefix_byte_pairs,
    "op12_dual_tree_ranking": op12_dual_tree_ranking,
    "op13_spelling_variants": op13_spelling_variants,
}
