"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (
    bitplane_ids, byte_bpe, decision_lists, filter_audit, ftrl_toxicity, gru_language, hyperminhash, license_scan, ngram_join,
    pairwise_quality, permutation_index, poisson_mix, table_clusters,
)
from granary.llm.batches import fold_of
from granary.llm.oracles import ORACLES as ORACLES
from granary.operators.shared_store import settle, shared_folder

END_ID = 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"


def op1_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.search(table(spark, folder, "embeddings"), lambda key: key % 20 == 0, nearest=20)


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), hyperminhash.Rule(size=2, percent=80))


def _graded(scores: DataFrame, cut: float) -> DataFrame:
    held_out = F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op4_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return _graded(pairwise_quality.score(documents, pairwise_quality.learn(documents, table(spark, folder, "labels"))), 0.5)


def op5_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return _graded(ftrl_toxicity.score(documents, ftrl_toxicity.learn(documents, table(spark, folder, "labels"))), 0.7)


def op6_gru_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False))
    found = gru_language.identify(documents, gru_language.learn(documents))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_decision_lists(spark: SparkSession, folder: str) -> DataFrame:
    stats = settle(decision_lists.statistics(table(spark, folder, "documents").select("doc_id", "text")))
    rules = decision_lists.learn(stats, table(spark, folder, "labels"))
    return decision_lists.judge(stats, rules).select("doc_id", *decision_lists.BASE, "base_failed", "kept")


def op8_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Equal shares per source, as many documents as there are now."""
    return poisson_mix.replicate(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree by source and id; every hundredth is its directory's licence file."""
    number = F.col("doc_id")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), (number / 1000).cast("long"), (number / 100).cast("long"),
                       F.when(number % 100 == 0, F.lit("LICENSE")).otherwise(number.cast("string")))
    files = table(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan(files).withColumn("score", F.round("score", 9))


def op10_bitplane_ids(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch(spark, "ids")
    bitplane_ids.write(table(spark, folder, "documents"), place, public_tokenizers.path("word_bpe_49k.json"), END_ID, added_as_text=False)
    return bitplane_ids.digests(spark, place)


def op11_table_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return table_clusters.cluster(table(spark, folder, "embeddings"))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"), ngram_join.Rule(size=3, percent=90))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("filter")


QUERIES = {f.__name__: f for f in (
    op1_permutation_index, op2_byte_bpe, op3_hyperminhash, op4_pairwise_quality, op5_ftrl_toxicity, op6_gru_language, op7_decision_lists, op8_poisson_mix, op9_license_scan, op10_bitplane_ids,
    op11_table_clusters, op12_ngram_join, op13_filter_audit,
)}
