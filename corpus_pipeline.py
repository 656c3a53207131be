"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes
each result as Parquet and gives the reread rows to the next stage. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, mixing, packing, simhash, toxicity
from millrace.llm.common import set_aside, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model is fitted on the labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows, back = set_aside(docs, ("text",))
    return toxicity.scored(rows, model, "toxicity").where("toxicity < 0.5").select(*back)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles differ in four bits at most."""
    return simhash.deduplicated(docs, errors=4, width=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per pass over a document that the mix takes, in training order."""
    return mixing.in_training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, packed in the stored order."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A learned model and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), f"stage-{name}")
