"""Running functions one after the other, each on the written rows of the one before."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from docketflow.llm.common import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def run_stages(
    spark: SparkSession, docs: DataFrame, stages: Sequence[tuple[str, Stage]], sf_dir: str
) -> DataFrame:
    """What the last stage returns. Parquet in the checkpoint folder cuts the lineage between."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid4().hex}"
    for k, (_, stage) in enumerate(stages[:-1]):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return stages[-1][1](spark, docs, sf_dir)
