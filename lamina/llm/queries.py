"""The operators of this package as queries: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    alignment,
    ann,
    byte_ids,
    collocations,
    jaccard_join,
    language,
    markov,
    packing,
    segment_bpe,
    simhash,
    token_files,
    toxicity,
    vector_dedup,
    warc_archive,
)
from lamina.llm.common import id_remainder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return markov.score_documents(docs, id_remainder(10) != 0)


def op2_segment_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = segment_bpe.encode_documents(docs, segment_bpe.vocabulary_path())
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.edit_likeness(_table(spark, folder, "documents").select("doc_id", "text"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(4) == 2
    model = language.fit(docs, ~held_out)
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("lid_language").alias("lang_pred"),
        F.col("lid_score").alias("score"),
        F.col("lid_rejected").alias("rejected"),
    )


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return jaccard_join.link_counts(docs)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    path = token_files.fresh_token_path(spark)
    token_files.write_token_files(docs, path, byte_ids.vocabulary_path(), end_id=0)
    return token_files.read_digests(spark, path)


def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = warc_archive.fresh_archive_path(spark)
    warc_archive.write_archive(_table(spark, folder, "pages"), path)
    return warc_archive.read_index(spark, path)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, byte_ids.vocabulary_path(), end_id=1)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, name) for name in ("documents", "labels"))
    held_out = id_remainder(5) == 0
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.top_phrases(_table(spark, folder, "documents").select("text", "lang"))


def op12_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.link_classes(_table(spark, folder, "embeddings"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(_table(spark, folder, "documents").select("doc_id", "text"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_markov, op2_segment_bpe, op3_simhash, op4_language, op5_jaccard_join, op6_token_files,
    op7_ann, op8_warc_archive, op9_packing, op10_toxicity, op11_collocations, op12_vector_dedup,
    op13_alignment,
)}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {}
