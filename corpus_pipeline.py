"""The corpus pipeline: five operators one after the other over ``documents``.

Every stage reads what the one before wrote and judges all of it. All but the
last return the columns of ``documents``; ``n_chars`` follows the text. Extra
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import load, piece_model
from docketflow.llm.line_dedup import drop_boilerplate
from docketflow.llm.minhash import one_per_class
from docketflow.llm.mixing import take
from docketflow.llm.quality_rules import keep_good
from docketflow.llm.sentencepiece_codec import encode_decode
from docketflow.llm.stages import run_stages

# Compression bands, mixing and BagMinHash are no SQL; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from the texts."""
    cleaned = drop_boilerplate(docs, F.col("source"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_per_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated to meet the targets of their sources."""
    return take(docs, F.array("source"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text and the text they decode to."""
    return encode_decode(docs, piece_model())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder and read again."""
    return run_stages(spark, load(spark, sf_dir, "documents"), STAGES, sf_dir)
