"""The queries ``opN_<name>``: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import clustering, divergence, embedding_dedup, gif, langid, mixing, packing, phrase_dedup, pii, quality, simhash, suffix_dedup, toxicity
from annalist.llm.common import held_out


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(_documents(spark, sf_dir), with_ids=False)
    return packing.pack(pieces)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.fit(docs.where(~held_out()))
    return langid.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(_documents(spark, sf_dir), spans_col="spans")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    index, vectors = toxicity.fit_and_vectorize(docs, labels.where(~held_out()))
    return toxicity.score_vectors(vectors, index).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.digests(gif.media(_documents(spark, sf_dir)))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(_documents(spark, sf_dir)))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = phrase_dedup.remove_passages(_documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op11_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, kept_back = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out(folds=3, fold=1)
    return quality.score(docs, quality.fit(docs, labels.where(~kept_back))).select("doc_id", kept_back.alias("held_out"), "score", "predicted")


def op12_yinyang_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_documents(spark, sf_dir))


def queries() -> dict:
    own = [op1_best_fit_packing, op2_language_id, op3_surrogates, op4_toxicity, op5_embedding_near_dedup, op6_gif_media, op7_simhash_near_dedup, op8_mix_sources, op9_suffix_dedup, op10_substring_dedup, op11_quality_votes, op12_yinyang_clusters, op13_source_divergence]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op8_mix_sources": mixing.ORACLE_SQL, "op12_yinyang_clusters": clustering.ORACLE_SQL, "op13_source_divergence": divergence.ORACLE_SQL}
