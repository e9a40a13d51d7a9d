"""From raw documents to packed training bins, in five stages.

Every stage works on all rows that the one before kept and returns the
columns of ``documents``, the last one the bins. Columns beyond those that a
stage reads pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonehour.llm.best_fit_packing import best_fit_packing
from zonehour.llm.common import read_table, stored
from zonehour.llm.decontaminate import match_benchmark
from zonehour.llm.language_id import UNDETERMINED, fit_language_model, predict_languages
from zonehour.llm.ngram_quality import judge_quality
from zonehour.llm.simhash_dedup import keep_one

MIN_LANGUAGE_SCORE = 0.4
SHINGLE_WORDS, MAX_BITS = 3, 2  # of the SimHash near-duplicates
CAPACITY = 8192  # tokens of a bin


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row in one column, beside the columns that a stage reads."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the rows' own lang; rejects texts without a language (no
    letter) or with a score under MIN_LANGUAGE_SCORE. lang becomes the
    predicted one. A null or empty text goes; a row with a null lang is
    judged but not learned from; if no row has a text and a lang, no
    language is known and every row goes. Repeated rows are judged alike;
    texts of any length are read whole."""
    found = predict_languages(packed(docs, "text"), fit_language_model(docs))
    sure = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return sure.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns])


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what fails the base rules or its language's perplexity bands.
    A null or empty text has no words and goes. Repeated rows are judged
    alike; texts of any length are read whole."""
    return judge_quality(packed(docs, "text", "lang")).where("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of near-duplicates, a null doc_id
    last, of rows with equal ids any one. Texts without words, null and empty
    ones too, have one fingerprint, so they are one group."""
    return keep_one(docs, SHINGLE_WORDS, MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item. A null or
    empty text and an empty benchmark match nothing, so such rows stay.
    Repeated rows are judged alike."""
    matched = match_benchmark(docs.withColumnsRenamed({c: f"doc.{c}" for c in docs.columns if c not in ("doc_id", "text")}), read_table(spark, sf_dir, "benchmark"))
    clean = matched.where(F.size("hits") == 0)
    return clean.select(*[F.col(c if c in ("doc_id", "text") else f"`doc.{c}`").alias(c) for c in docs.columns])


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into bins of CAPACITY tokens. Every row is packed,
    repeated ones and null and empty texts (an end token) too; a text beyond
    CAPACITY is cut into pieces. No rows give no bins."""
    return best_fit_packing(docs, CAPACITY)


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_bins),
]

# the fitted models of the first two stages have no SQL; tests compare the stages after the first with brute-force
# versions, each on its own input, and run() with the stages in a chain
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
