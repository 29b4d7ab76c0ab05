"""From raw documents to token ids: quality, language, near copies, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import byte_bpe, gru_language, hyperminhash, pairwise_quality, poisson_mix
from granary.llm.queries import scratch, table

# Words per shingle and least similarity of the near-copy stage.
NEAR = hyperminhash.Rule(size=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the preference model scores below one half.

    NULL and empty texts are scored like any other, long ones whole; repeated rows share their fate, all columns
    stay and no rows give none.
    """
    return pairwise_quality.keep(docs, pairwise_quality.learn(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (NULL and empty texts too) and those that no learned language fits.

    Long texts are read whole; repeated rows share their fate, all columns stay and no rows give none.
    """
    return gru_language.keep(docs, gru_language.learn(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies, the one with the least doc_id.

    NULL, empty and white texts are near nothing and stay, as do rows without doc_id; of rows that share a
    doc_id the least stays. All columns stay (a column without an order, such as a map, ends the job with
    Spark's error) and no rows give none.
    """
    return hyperminhash.keep_one(docs, NEAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies or skips documents so that every source has an equal expected share; shuffled.

    A NULL source is a source of its own; NULL ids and texts are drawn like others, repeated rows draw alike.
    Exactly the columns that came are returned, whatever they are called; no rows give none.
    """
    return poisson_mix.replicate(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and proof that they decode to it.

    NULL and empty texts have no ids; long ones are encoded whole; repeated rows stay. This last stage
    returns doc_id, lang, source and its own columns; others (text and n_chars too) are left behind.
    """
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                            decoded="decoded")
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("mixture", mixture), ("tokens", tokens)]

#: Learned stages can't be written as SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage's rows are kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        place = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
