"""One registered query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.llm import (
    chat_format, decontamination, hard_negatives, jaccard_join, language_id, lattice_lm, line_dedup, mixing, oracles,
    order_minhash, prefix_bpe, pseudonyms, toxicity, whitening,
)
from leakscope.llm.common import fold, table
from leakscope.llm.vectors import floored, is_finite


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language_id.train(docs.where(~held_out))
    found = language_id.languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.edit_likeness(table(spark, folder, "documents"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"), k=4, percent=85)


def op4_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counts = [F.coalesce(F.col("__found")[kind], F.lit(0)).alias(f"n_{kind}") for kind in pseudonyms.KINDS]
    return pseudonyms.pseudonymise(docs).select("doc_id", "text", *counts)


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.col("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(~held_out)
    found = toxicity.toxicity(table(spark, folder, "documents").select("doc_id", "text"), labels)
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    added = [spark.range(1).select(F.lit(-1).alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"),
                                   control.alias("text")) for i, role in enumerate(("user", "assistant"))]
    return chat_format.digests(chat_format.windows(given.unionByName(added[0]).unionByName(added[1])))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs, with_passages=True).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 1
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = lattice_lm.lm_scores(docs, ~held_out, lattice_lm.load_pieces())
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                        "score")


def op11_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = prefix_bpe.load_word_bpe(str(public_tokenizers.path("word_bpe_49k.json")))
    encoded = prefix_bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer)
    return prefix_bpe.decode(encoded, tokenizer).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(is_finite("embedding")).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        floored("embedding", 256).alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(is_finite("embedding")).select(
        "vec_id", floored("embedding", 1024, 100_000).alias("vector"))
    blocks = whitening.read_blocks(rows, fill=100_000)
    model = whitening.fit(blocks)
    error = whitening.identity_error(blocks, model)
    return whitening.whitened(blocks, model).select(
        "vec_id", "component", F.lit(blocks.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (op1_language_id, op2_order_minhash, op3_jaccard_join, op4_pseudonyms, op5_source_mix,
                  op6_decontamination, op7_toxicity, op8_chat_format, op9_line_dedup, op10_lattice_lm, op11_prefix_bpe,
                  op12_hard_negatives, op13_whitening, pipeline)
}

ORACLES: dict[str, str] = oracles.SQL
