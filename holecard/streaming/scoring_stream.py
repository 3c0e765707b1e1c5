"""Structured Streaming form of the evaluation and analysis stages.

Completions that arrive as files (one table per batch of prompts) are scored
as they land: the scoring operators are row-local, so the same column
expressions run unchanged on a stream in append mode.  The per-result summary
is a streaming aggregation (running means and spreads per result name).
Checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from holecard.operators import scoring
from holecard.session import ensure_checkpoint_dir

RESPONSE_SCHEMA = T.StructType([
    T.StructField("prompt_id", T.StringType()),
    T.StructField("result_name", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("completion", T.StringType()),
])


def _checkpoint(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def scored_stream(spark: SparkSession, source_dir: str,
                  schema: T.StructType = RESPONSE_SCHEMA) -> DataFrame:
    """Streaming DataFrame of scored responses read from parquet files."""
    responses = spark.readStream.schema(schema).parquet(source_dir)
    return scoring.code_bleu(responses.withColumn("completion", scoring.strip_eot("completion")))


def start_scoring(spark: SparkSession, source_dir: str, sink_dir: str, name: str = "scoring",
                  available_now: bool = True) -> StreamingQuery:
    """Score every response file that lands in ``source_dir`` into parquet."""
    writer = (scored_stream(spark, source_dir).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", _checkpoint(spark, name))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def start_summary(spark: SparkSession, source_dir: str, query_name: str = "scorecard_summary",
                  available_now: bool = True) -> StreamingQuery:
    """Running summary per result name into an in-memory table ``query_name``."""
    scored = scored_stream(spark, source_dir)
    agg = scored.groupBy("result_name").agg(
        F.count(F.lit(1)).alias("n_responses"),
        F.avg("ngram_match_score").alias("average_ngram_match_score"),
        F.avg("weighted_ngram_match_score").alias("average_weighted_ngram_match_score"),
        F.avg("codebleu").alias("average_code_bleu"),
        F.stddev_samp("codebleu").alias("average_code_bleu_moe"))
    writer = (agg.writeStream.format("memory").queryName(query_name).outputMode("complete")
              .option("checkpointLocation", _checkpoint(spark, query_name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
