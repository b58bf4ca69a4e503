"""A corpus made ready for training: five stages from documents to packed sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``.  Its rows are written as Parquet to the shared folder
and read again as the next one's documents.  All but the last return the columns of documents: those of any other name
come through as they are, also if they are called like something that an operator adds.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows and empty tables; what it does with
them stands in its docstring and in that of the operator's module.  An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm import mixing, packing, paragraphs, simhash, toxicity
from leafwright.llm.texts import packed, read, unused
from leafwright.session import settle

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.7; the labels of ``sf_dir`` train the score.

    Null and empty texts score by the bias alone and stay; of repeated rows all stay or all go; a text is scored whole.
    """
    costs = toxicity.language_model(docs)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), costs)
    rows = docs.select("doc_id", "text", packed(docs).alias("row"))
    scored = toxicity.score(rows, costs, model, toxicity.TOXIC, "row")
    return scored.filter(F.col("score") < TOXIC_FROM).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of 3-word shingles, links at 2 differing bits.

    That of the smallest id stays; null and empty texts are one group; rows without an id all stay.
    """
    return simhash.one_of_each(docs, n=3, budget=2)


def drop_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier place of the corpus holds; ``n_chars`` follows the text.

    Earlier is by id, then by place.  Rows without an id and null texts stay as they are; a text of nothing but passages
    of others becomes empty.
    """
    mark = unused(docs.columns, "removed")
    out = paragraphs.without_repeats(docs, mark=mark)
    shorter = F.when(F.col(mark).isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", F.coalesce(shorter, "n_chars")).select([F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0 to 3 times.

    A null source is a source of its own; documents without words are taken once; repeated rows are rows of their own.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text"), mixing.size_of(F.col("text")).alias("words"), packed(docs).alias("row"))
    mixed = mixing.mix(rows, F.col("words"))
    return mixed.select("row", F.explode(F.expr("array_repeat(0, copies)"))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 token ids; a null text has its end id only."""
    found = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(settle(found, "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("paragraphs", drop_repeated_paragraphs),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# SQL can express neither the trained score nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; gives the packed pieces."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
