"""Filters that stand for clean-up deletions: what is returned is what stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.functions.dates import Moment, timestamp_literal
from docketflow.operators.joins import fits_broadcast, lookup_join


def keep_since(df: DataFrame, date_col: str, cutoff: Moment) -> DataFrame:
    """Drop the rows before ``cutoff``. Rows without a date stay."""
    moment = F.col(date_col)
    return df.filter(moment.isNull() | (moment >= timestamp_literal(cutoff)))


def drop_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop the rows whose key is in ``keys``. Rows with a NULL key stay."""
    return _match(df, keys, on, "left_anti")


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep only the rows whose key is in ``keys``."""
    return _match(df, keys, on, "left_semi")


def _match(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    pairs = keys.select(*on)
    # distinct() first: copies of a key must not pile up in one task.
    joined = lookup_join(df, pairs.distinct(), on, how, small=fits_broadcast(pairs))
    return joined.select(*df.columns)
