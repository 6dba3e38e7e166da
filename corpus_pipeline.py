"""From ``documents`` to packed sequences: language, quality, near-duplicates, benchmark leaks, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), where ``docs`` is read from the
files its predecessor wrote, and returns a DataFrame. All but the last return the columns of ``documents``.

Defined results: empty tables give no rows, whatever stage they reach. Null, empty and letterless texts leave in the language
stage. Without labelled languages all documents leave there; without quality labels none leaves in the quality stage (score
0.5); without benchmark items none leaves as a leak. Null ids are kept, but never learned from. Rows with equal id and text
are one document; of copies with several ids the least id stays. Texts are read whole, however long they are. Columns beside
``doc_id``, ``text`` and ``lang`` go through the first four stages as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import decontam, language, neardup, packing, quality
from fieldloom.llm.common import fold, labelled_sample, scratch, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without letters, or far from all samples, go."""
    return language.known_language(docs, language.fit(docs, fold(F.col("doc_id"), 4) != 2))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts stay: a score of 0.3 or more."""
    sample = labelled_sample(table(spark, sf_dir, "labels"), "quality", fold(F.col("doc_id"), 5) != 0, quality.MOST)
    vectors = quality.word_vectors(docs)
    return quality.good(docs, vectors, quality.train(docs, sample, vectors))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id."""
    return neardup.one_of_each(docs)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items stay; an item may occur with edits (see ``decontam``)."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    found = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(found).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language", known_language), ("quality", good_quality), ("near-duplicates", one_of_each), ("decontamination", no_leaks), ("packing", packed)]

#: No SQL has a stage's rows: they come from learned models, sketches and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
