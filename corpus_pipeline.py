"""A corpus pipeline of five stages, each one operator of ``tideline.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import secrets as secret_scan
from tideline.llm import simhash_dedup
from tideline.llm.common import among, keep
from tideline.llm.language_id import fit, predict, usual_length
from tideline.llm.mixing import mix
from tideline.llm.packing import pack
from tideline.llm.queries import held_out, secret_model
from tideline.sources.scratch import settled

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tidy(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` with its result written and its intermediate tables deleted."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return settled(lambda: stage(spark, docs, sf_dir))

    return run


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a written number for each row, as ids may be null or repeated."""
    return keep(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language, with ``lang`` as predicted; the others go:
    null texts, texts without a letter, those whose score is under 0.5, and those
    whose code is far longer than that of a training text."""
    train = ~held_out(F.col("doc_id"))
    model = fit(docs, train)
    judged = predict(docs, model, usual=usual_length(docs, train, model))
    return judged.where("lang_pred <> 'und' and score >= 0.5 and learned").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id: texts
    whose shingles of five words have a Jaccard similarity of 0.8 or more.

    Each row counts by itself, whether its id is null, repeated or neither.
    """
    rows = numbered(docs)
    groups = keep(simhash_dedup.near_duplicates(rows, shingle=5, similarity=0.8, id_col="row").withColumnRenamed("id", "row"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("r"))
    kept = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.r").alias("row"))
    return among(rows, kept, "row").select(*COLUMNS)


@tidy
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars as of the new text."""
    return secret_scan.redact(docs, secret_model(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@tidy
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; the one last document of a source
    that the mix takes in part is there once more if that part is half of it."""
    rows = numbered(docs)
    taken = mix(rows, row_col="row").select("row", F.round("copies").cast("int").alias("n")).where("n > 0")
    return rows.join(taken, "row").select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("copy")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, none across documents, bucketed by length."""
    return pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("packing", packing)]

#: Classifiers, hashing to 64 bits, random rounding and tokens have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, with a written table between any two."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
