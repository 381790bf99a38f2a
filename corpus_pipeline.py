"""From documents to token files: language, near duplicates, benchmark passages, mix, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm import decontaminate, langid, mixing, simhash, tokens
from creditlake.llm.common import in_training, prepare, table
from creditlake.settings import stage

#: A text whose nearest profile is further than this is in no language that was learnt.
LEAST_SCORE = 0.2
#: Pieces held by a Python worker: fewer than alone, as workers of the stages before live on beside.
PIECES = 150_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learnt from the table itself; texts without letters and unknown languages go."""
    prepare(spark)
    profiles = langid.learn_profiles(docs, in_training("doc_id"))
    rows = docs.select(F.struct("*").alias("doc"), "text")
    found = langid.identify(rows, profiles)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of equal or similar texts."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, edited or not."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files: doc_id, start, n_tokens, ids_crc32."""
    prepare(spark)
    return tokens.encode_documents(docs, pieces=PIECES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Profiles, prints, edit distances and tokens have no form in SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None
