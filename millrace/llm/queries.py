"""One query per corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bestfit,
    exact,
    importance,
    lloyd,
    lookup_sketch,
    mixing,
    packing,
    passages,
    quality,
    repeats,
    simhash,
    toxicity,
    warc,
)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
        F.round(F.try_element_at("mix_times", F.lit(1)), 6).alias("first_time"),
    )
    return mixed.orderBy("first_time", "doc_id")


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, "score").select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_exact_dedup(spark, sf_dir):
    return exact.owned(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op7_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op8_fingerprints(spark, sf_dir):
    return lookup_sketch.fingerprints(table(spark, sf_dir, "documents"))


@query
def op10_repeats(spark, sf_dir):
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


@query
def op5_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("quality").alias("score"),
        F.col("quality_text").alias("text_score"),
        F.col("quality_metadata").alias("metadata_score"),
        (F.col("quality") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op11_centroids(spark, sf_dir):
    return lloyd.clustered(table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, block=16)


@query
def op12_best_fit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bestfit.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048)


@query
def op13_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return importance.resampled(docs, table(spark, sf_dir, "benchmark"), percent=25, least_words=20)
