"""A corpus from raw documents to packed sequences, in five stages.

Toxic documents go; one document of each near-duplicate group stays; passages
that an earlier document holds are cut out; sources are mixed to their target
weights; what is left is packed.  Every stage takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holecard.llm import mixing, ngram_join, packing, queries, substring_dedup, toxicity
from holecard.session import prepare
from holecard.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.5, unchanged."""
    prepare(spark)
    model = queries.toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


#: Near duplicates of the corpus: words of a shingle and hundredths of similarity.
NEAR_SHINGLE, NEAR_THRESHOLD = 5, 80


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group: linked
    by a similarity of 0.8 and more of their sets of five-word shingles.

    Documents without an id or words are groups of their own; of repeated rows
    with one doc_id all that are the smallest of their group stay.
    """
    prepare(spark)
    groups = ngram_join.near_duplicates(docs.select("doc_id", "text"), NEAR_SHINGLE, NEAR_THRESHOLD)
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_hc_of")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_hc_of"], "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that smaller ones
    hold; a text that loses nothing keeps its white space."""
    prepare(spark)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("_hc_text", F.col("text"))
    out = substring_dedup.dedup_spans(marked)
    text = F.when(F.col("n_removed") == 0, F.col("_hc_text")).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*kept)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every time that a document is taken."""
    prepare(spark)
    out = mixing.mix(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and places in sequences."""
    prepare(spark)
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: A learned model, a shuffle by a Spark hash and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the checkpoint folder and read again."""
    prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
