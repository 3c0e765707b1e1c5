"""Registered queries of the training-data operators, over whole tables.

Each takes ``(spark, sf_dir)``, applies one operator with production parameters
and derives its digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holecard.llm import (chat_format, language_id, merkle, mixing, ngram_join, packing, part_codes, quality_rules,
                          secret_scan, substring_dedup, topk_search, toxicity, url_filter)
from holecard.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"
#: Entries of the URL list: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2
TOXIC_FOLDS, TOXIC_HELD = 5, 0
#: A conversation with control strings in its texts.
CONTROL_ID, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def _in_fold(folds: int, held: int):
    return F.coalesce(language_id.remainder(F.col("doc_id"), folds) == held, F.lit(False))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 1: the mixture of languages of every document; learned outside the held-out fold."""
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    held = language_id.remainder(F.col("doc_id"), LANGUAGE_FOLDS)
    model = language_id.Model.fit(docs.where(held != LANGUAGE_HELD))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", _in_fold(LANGUAGE_FOLDS, LANGUAGE_HELD).alias("held_out"), "lang_pred", "score",
                      "langs", "shares")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 2: the verdict on every page's url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).drop("url")


def substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 3: every document without the 13-word windows of smaller documents."""
    out = substring_dedup.dedup_spans(_documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 4: the five best partners of every fiftieth vector."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0)


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 5: the words that the mix takes of every document."""
    out = mixing.schedule(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 6: every conversation formatted, and read back from the output."""
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    control = spark.range(1).select(
        F.lit(CONTROL_ID).cast("long").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")) \
        .select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.lit(CONTROL_TEXT).alias("text"))
    rows = rows.unionByName(control).withColumn("content", chat_format.text_part(F.col("text")))
    out = chat_format.format_chats(rows.drop("text"))
    pieces = chat_format.read_turns(F.col("formatted"))
    out = out.withColumn("pieces", pieces)
    read = F.array_join(F.transform("pieces", lambda p: F.concat(
        chat_format.read_role(p), F.lit("\n"), chat_format.read_text(p), F.lit("\n"))), "")
    loss = F.array_join(F.zip_with("pieces", "turns", chat_format.read_loss), "")
    out = out.withColumn("loss", loss)
    return out.select("conv_id", F.size("pieces").cast("long").alias("n_turns"),
                      F.sha2(read, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 7: where every piece of every document's ids lies."""
    out = packing.pack(_documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 8: base statistics of every document and the learned rules' verdict."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    out = quality_rules.judge(quality_rules.statistics(docs), rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "rule")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from labels outside the held-out fold."""
    known = labels.where(language_id.remainder(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD)
    return toxicity.fit(docs, known.select("doc_id", "toxic"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 9: the toxicity of every document."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = toxicity.score(docs, toxicity_model(docs, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", _in_fold(TOXIC_FOLDS, TOXIC_HELD).alias("held_out"), "score", "predicted")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 10: the group of every document under shingle similarity of 0.9."""
    return ngram_join.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 11: the code of every vector and what it loses."""
    coded = part_codes.compress(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    out = part_codes.with_group_error(coded.rows)
    return out.select("vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 12: where every document holds what looks like a secret."""
    out = secret_scan.scan(_documents(spark, sf_dir, "doc_id", "text"))
    labels = secret_scan.names()
    counts = [F.size(secret_scan.of_kind(F.col("base_spans"), i)).cast("long").alias(f"n_{kind.name}")
              for i, kind in enumerate(secret_scan.KINDS)]
    return out.select("doc_id", *counts,
                      F.sha2(secret_scan.printed(F.col("base_spans"), labels), 256).alias("base_sha256"),
                      secret_scan.printed(F.col("spans"), labels).alias("spans"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 13: every document's place in a Merkle tree over the sources, and
    whether its text, half of them tampered with, still leads to the root."""
    docs = _documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in docs.columns]
    tampered = F.translate("text", "\n", "")
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & (tampered != F.col("text"))
    shown = F.when(touched, merkle.leaf_digest(*fields[:-1], tampered))
    tree = merkle.build(docs, merkle.leaf_digest(*fields), carry={"shown": shown})
    out = merkle.proofs(tree)
    out = out.withColumn("folded_root", merkle.fold(F.coalesce("carried_shown", "digest"), F.col("path")))
    return out.select(F.col("order").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
                      "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_language_mixture": language,
    "op2_url_trie": url_verdicts,
    "op3_substring_dedup": substring,
    "op4_exact_topk": top_k,
    "op5_source_mix": mixture,
    "op6_chat_format": chats,
    "op7_cost_packing": packed,
    "op8_quality_rules": quality,
    "op9_toxicity": toxic,
    "op10_ngram_jaccard": near_duplicates,
    "op11_part_codes": vector_codes,
    "op12_secret_scan": secrets,
    "op13_merkle_manifest": manifest,
}
