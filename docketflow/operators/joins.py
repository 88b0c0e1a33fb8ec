"""Joining a large table to a lookup table.

The small side is broadcast only after its size was measured. Beyond the bound
the join is shuffled, and the rows of keys that hold far more than their share
are cut into slices, so that they never gather in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table that is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot if it has more than so many even shares of a table of at least so many rows.
HOT_SHARES = 2
HOT_MIN_ROWS = 1_000_000
# What the sketch can track at most. It is sized for every key that can be hot: no more
# than shuffle partitions / HOT_SHARES keys have that share. Only beyond 200,000 shuffle
# partitions could hot keys be missed; their rows are then joined in one task each.
MAX_TRACKED = 1_000_000
_SALT = "__salt"

_FIXED_WIDTH = (
    T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the whole table is small enough to be sent to every executor.

    Runs one aggregate over ``df``; for a Parquet table of numbers Spark answers
    it without reading any column.
    """
    fields = df.schema.fields
    texts = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if any(not isinstance(f.dataType, _FIXED_WIDTH) for f in fields if f.name not in texts):
        return False
    row = F.lit(16 * len(fields)).cast("bigint")
    for name in texts:
        row = row + F.coalesce(F.octet_length(name), F.lit(0))
    size = df.agg(F.sum(row) if texts else F.count(F.lit(1)) * row).first()[0] or 0
    return size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


@dataclass(frozen=True)
class HotKeys:
    """Keys (as hashes) with too many rows for one task, and how many tasks they need."""

    hashes: tuple[int, ...] = ()
    slices: int = 1

    def __or__(self, other: HotKeys) -> HotKeys:
        """The keys hot in either table, of the same kind of key."""
        hashes = tuple(dict.fromkeys((*self.hashes, *other.hashes)))
        return HotKeys(hashes, max(self.slices, other.slices))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_key_sketch(spark: SparkSession, keys: Sequence[str]) -> Column:
    """Aggregate of bounded size that finds the most frequent keys in one pass."""
    most = math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / HOT_SHARES)
    tracked = min(MAX_TRACKED, 10 * max(100, most))
    return F.call_function(
        "approx_top_k", key_hash(keys), F.lit(min(tracked, max(100, most))), F.lit(tracked)
    )


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> HotKeys:
    """The keys of ``df`` with several times an even share of its rows.

    The counts are estimates. They only decide where rows are processed, never
    which rows come out. A table of less than ``min_rows`` rows has none.
    """
    return hot_keys_of(df, [keys], min_rows)[0]


def hot_keys_of(
    df: DataFrame, several: Sequence[Sequence[str]], min_rows: int | None = None
) -> list[HotKeys]:
    """:func:`hot_keys` for several keys of a table in one pass over it."""
    spark = df.sparkSession
    sketches = [hot_key_sketch(spark, keys).alias(f"top{k}") for k, keys in enumerate(several)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return [hot_keys_from(spark, row[f"top{k}"], row["n"], min_rows) for k in range(len(several))]


def hot_keys_from(
    spark: SparkSession, top: Sequence[Row] | None, total: int, min_rows: int | None = None
) -> HotKeys:
    """:class:`HotKeys` out of a sketch that was computed along with other figures."""
    if total < (HOT_MIN_ROWS if min_rows is None else min_rows):
        return HotKeys()
    even_share = total / int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = [entry for entry in top or () if entry["count"] > HOT_SHARES * even_share]
    if not hot:
        return HotKeys()
    slices = math.ceil(max(entry["count"] for entry in hot) / even_share)
    return HotKeys(tuple(entry["item"] for entry in hot), slices)


def spread_join(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str, hot: HotKeys,
    hot_on: Sequence[str] | None = None, spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffled join in which the hot keys of ``facts`` are cut into slices.

    Either side is computed once. A fact goes to the slice that a hash of its
    ``spread_by`` columns (all by default) and of its partition names, so a
    recomputed task sends it to the same place again, and copies of one fact
    are spread as far as their partitions are. Only the ``dim`` rows of hot keys
    are repeated, once per slice. ``hot_on`` are the key columns ``hot`` was
    measured on, all of them by default.
    """
    _check_same_types(facts, dim, keys)
    if not hot.hashes:
        return facts.join(dim, list(keys), how)
    is_hot = key_hash(hot_on or keys).isin(list(hot.hashes))
    place = F.xxhash64(*(spread_by or facts.columns), F.spark_partition_id())
    slice_of_row = F.pmod(place, F.lit(hot.slices)).cast("int")
    every_slice = F.sequence(F.lit(0), F.lit(hot.slices - 1))
    salted = facts.withColumn(_SALT, F.when(is_hot, slice_of_row).otherwise(F.lit(0)))
    copies = dim.withColumn(
        _SALT, F.explode(F.when(is_hot, every_slice).otherwise(F.array(F.lit(0))))
    )
    return salted.join(copies, [*keys, _SALT], how).drop(_SALT)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    hot: HotKeys | None = None,
    hot_on: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``facts`` to a lookup table: broadcast if it is small, else :func:`spread_join`.

    ``small`` states the outcome of an earlier :func:`fits_broadcast`, ``hot``
    that of :func:`hot_keys` on ``hot_on``; ``HotKeys()`` says that the keys of ``facts`` are
    unique, or known to be even, and spares the pass over them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a lookup: {how}")
    _check_same_types(facts, dim, keys)
    if fits_broadcast(dim) if small is None else small:
        return facts.join(F.broadcast(dim), list(keys), how)
    return spread_join(facts, dim, keys, how, hot_keys(facts, keys) if hot is None else hot, hot_on)


def unique_lookup(df: DataFrame, key: str, value: str, quarantine: bool = False) -> DataFrame:
    """One row per key; the query fails when a key has two different values.

    With ``quarantine`` it does not: such a key has no value, and a text in ``problema``.
    Repeated copies collapse before the shuffle. The result is partitioned by
    ``key``, so a join on it needs no further exchange of this side.
    """
    rows, known = F.count(F.lit(1)), F.count(value)
    conflict = (F.min(value) != F.max(value)) | ((known > 0) & (known < rows))
    problem = F.concat(F.lit(f"more than one {value} for {key} "), F.col(key).cast("string"))
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key)
    if not quarantine:
        return grouped.agg(F.when(conflict, F.raise_error(problem)).otherwise(F.max(value)).alias(value))
    return grouped.agg(
        F.when(~F.coalesce(conflict, F.lit(False)), F.max(value)).alias(value),
        F.when(conflict, problem).alias("problema"),
    )


def _check_same_types(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> None:
    # Equal numbers of different types have different hashes.
    for key in keys:
        left, right = facts.schema[key].dataType, dim.schema[key].dataType
        if left != right:
            raise TypeError(f"join key {key}: {left.simpleString()} and {right.simpleString()}")
