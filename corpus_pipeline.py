"""A training-data pipeline over ``documents``: each stage's rows are written as Parquet and read by the next.

Every stage but the last returns the columns of its input, with their values:
columns that have the name of something the stage's operator makes are carried
under free names meanwhile.  The last stage's table holds every document's token
ids; ``run`` returns their counts and digests.  Null, empty and repeated rows are
as the stage's operator defines them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm import bpe, decontam, langid, pii, simhash
from fleetspark.llm.common import free_names, quoted, read_table, shared_folder
from fleetspark.llm.queries import vocabulary


def beside(docs: DataFrame, made: set[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage(docs)`` with the columns of ``docs``; those named as in ``made`` are out of the stage's sight."""
    clash = [c for c in docs.columns if c.lower() in made]
    away = dict(zip(clash, free_names(docs, *[f"kept_{i}" for i in range(len(clash))])))
    got = stage(docs.select(*[quoted(c).alias(away.get(c, c)) for c in docs.columns]))
    return got.select(*[quoted(away.get(c, c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts whose language is known; the model learns from the labelled rows of ``docs``."""
    model = langid.train(docs)
    return beside(docs, {"lang_pred", "score"}, lambda d: langid.predict(d, model).filter(F.col("lang_pred") != "und"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest doc_id."""
    return simhash.deduplicated(docs).select(*[quoted(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = read_table(spark, sf_dir, "benchmark")
    return beside(docs, {"n_words", "n_hit", "items", "contaminated", "__hits", "__items"},
                  lambda d: decontam.decontaminate(d, items).filter(~F.col("contaminated")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are taken out of the texts; no document goes."""
    return beside(docs, {"__clean", "__spans"}, pii.sanitised)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every text."""
    return bpe.digest(docs, vocabulary("word_bpe_49k.json"), ids=True)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

#: Fingerprints, the language model and word BPE have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs.drop("ids")
