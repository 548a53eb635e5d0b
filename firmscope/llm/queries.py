"""Queries of the subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscope.llm import ann, best_fit, centroids, decontaminate, langid, licenses, line_dedup, manifest, packing, simhash, sql, token_counts, token_files, toxicity
from firmscope.llm.encode import vocabulary
from firmscope.llm.toxicity import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(table(spark, sf_dir, "documents"), vocabulary()))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), "removed_lines")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary(), end_id=1)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(remainder("doc_id", 5) > 0))
    return langid.identify(docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text"), model, ["doc_id", "held_out"])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_whole(table(spark, sf_dir, "documents"), vocabulary(), end_id=0)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings"))).drop("n_distances")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(remainder("doc_id", 7) == 0, more).otherwise(F.col("n_chars").cast("string"))
    return manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], claims={"n_chars": tampered})


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = [op1_length_histogram, op2_toxicity, op3_simhash, op4_decontamination, op5_nearest, op6_licenses, op7_line_dedup, op8_token_files, op9_language, op10_packing, op11_best_fit, op12_centroids, op13_manifest, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op12_centroids": sql.CENTROIDS, "op13_manifest": sql.MANIFEST}
