"""Documents through language ID, toxicity, near-duplicate removal and packing.

Each stage gets all that its predecessor kept. All but the last return the columns of
documents; the last returns a row per piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import byte_ids, jaccard_join, language, packing, toxicity
from lamina.llm.common import apart
from lamina.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that lie near a language learned from all rows with a language."""
    model = language.fit(docs, F.lit(True))
    named = apart(docs).withColumn("text", F.col("text").cast("string"))
    found = language.predict(named, model)
    return found.filter(~F.col("lid_rejected")).select(*named.columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learned from the labels of the documents that are left."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, F.lit(True))
    named = apart(docs).withColumn("text", F.col("text").cast("string"))
    scored = toxicity.score(named, model)
    return scored.filter("tox_score < 0.5").select(*named.columns).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one of smallest doc_id (null last), of each class of links: five words, Jaccard 0.8."""
    return jaccard_join.one_of_each_class(docs, width=5, over=80, under=100)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 ids."""
    return packing.pack(docs, byte_ids.vocabulary_path(), end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_copies),
    ("packing", pack_sequences),
]

#: Classifiers, tokenizers and greedy packing have no SQL form; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
