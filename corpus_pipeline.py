"""The corpus pipeline: five stages over the documents, each written and read again.

1. quality classifier: documents that it scores below 0.5 go;
2. quality rules: documents that fail go, boilerplate lines leave the others;
3. near duplicates: of each group one document stays, over five-word shingles
   at a similarity of 0.8, the one with the smallest id;
4. mixing: a part of the corpus by target weights, no document twice;
5. packing: the place of every piece in sequences of 4096 tokens.

All stages but the last return the columns of the documents they got. Null and
empty texts do not outlast the rules, a repeated row does not outlast the near
duplicates, and an empty table stays one in all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import discriminant, forest, lines, mixing, packing, queries
from tidemark.llm.shared import stored, table, unused

SHINGLE_WORDS = 5
# Of the words that reach the mixing, in percent.
MIX_SHARE = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are scored 0.5 or better.

    Null and empty texts have the statistics of no words and are judged by them; rows
    with a null id teach nothing, a repeated row is judged each time. Without labels
    of both classes all documents stay. An empty table stays one; other columns,
    whatever their names, come through.
    """
    model = discriminant.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(discriminant.score(model, F.col("text")) >= 0.5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the rules, without their boilerplate lines.

    Null, empty and short texts fail; a null source is a host of its own; repeated rows
    pass or fail together, whatever their ids. An empty table stays one; other
    columns, whatever their names, come through, but ``n_chars`` follows the text.
    """
    return lines.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id.

    Texts without words are alike only in having no group: each stays. Null ids give way
    to others and are one document if their texts are equal; of a repeated row one
    stays. An empty table stays one; other columns, whatever their names, come
    through.
    """
    kept = forest.near_duplicates(docs, SHINGLE_WORDS).where("kept")
    own_id, own_key, key = unused(docs.columns, "own_id", "own_key", "text_key")
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    keyed = docs.withColumn(key, lines.text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key))
    return (
        keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).select(*docs.columns)
    )


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a mix of `MIX_SHARE` percent of the words, none twice.

    Documents without words are not taken. Null languages and sources are leaves of
    their own; equal ids go together, null ids as one id. An empty table stays one;
    other columns, whatever their names, come through.
    """
    domain, words, epoch = unused(docs.columns, "domain", "words", "epoch")
    measured = docs.withColumns(
        {
            domain: queries.domain_of(F.col("source")),
            words: mixing.n_words(F.col("text")),
        }
    )
    return mixing.mixed(
        measured,
        [domain, *queries.MIX_PATH[1:]],
        queries.MIX_WEIGHTS,
        share=MIX_SHARE,
        seed=queries.MIX_SEED,
        tokens=words,
        epoch=epoch,
    ).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document.

    Null and empty texts are the end token alone; repeated rows and null ids are
    documents of their own. No rows give no rows; other columns are not kept. Tasks do
    not keep their words, as all stages share the Python workers.
    """
    return queries.packed(docs, keep_words=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

# The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
