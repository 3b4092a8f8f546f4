"""A corpus pipeline: stages that call the corpus operators one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annalist.llm import langid, mixing, packing, pii, simhash
from annalist.llm.common import held_out, materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rows teach stay."""
    return langid.keep_known(docs, langid.fit(docs.where(~held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.keep_first(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to surrogates."""
    return pii.replace_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix of sources takes it."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its place in a training sequence."""
    return packing.pack(packing.tokenize(docs))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("surrogates", surrogates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]
#: The first, second and last stage have no SQL form; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
