"""Seconds between consecutively numbered rows of a process log.

The log is read once and exchanged once. Numbers are put into blocks of
consecutive ones, the blocks are dealt to tasks by range, and a row that is the
last of its block is also sent to the next one, so each block has the row before
each of its rows. Blocks follow one another over the tasks and numbers within a
block, so the result comes out in the order of the numbers without a further sort.

A number with far more than its share of rows gets places of its own, over which
its rows are spread; the rows of the number after it only meet how many they are.
"""

from __future__ import annotations

from collections.abc import Collection
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketflow.functions.dates import seconds_between
from docketflow.operators import joins
from docketflow.operators.joins import hot_keys, key_hash, lookup_join

# Consecutive numbers of a block; one row in so many is sent twice.
BLOCK = 4096
_PLACE = ("__bloque", "__numero", "__parte")


def log_seconds(
    log: DataFrame,
    first: int | None = None,
    last: int | None = None,
    numbers: Collection[int] | DataFrame | None = None,
    keep_number: bool = False,
) -> DataFrame:
    """``segundos`` from each row to the row numbered one lower, in order of ``numfila``.

    The value is the earlier time minus the later one. The row before is looked
    up by its number in the whole ``log``, not only among the selected rows: it
    is NULL where that number is missing, and the query fails where it occurs
    twice. ``first``, ``last`` and ``numbers`` select rows; ``numbers`` may be
    millions, also as the single column of a table. Rows without number come
    first, with NULL. ``numfila`` is returned only with ``keep_number``.
    """
    number = F.col("numfila")
    rows = log.select("numfila", "fecha")
    if numbers is None:
        low, high, runs = first, last, None
    else:
        runs = _runs(log.sparkSession, numbers)
        if runs is None:
            low, high = 1, 0
        else:
            low = runs.least if first is None else max(first, runs.least)
            high = runs.greatest if last is None else min(last, runs.greatest)
    # The outermost bounds, and the row before the first, reach the scan.
    rows = rows.filter(_between(number, None if low is None else low - 1, high))
    rows = rows.withColumn(_PLACE[0], _block(number))
    own, before = _between(number, low, high), _between(number + 1, low, high)
    if runs is not None:
        rows = lookup_join(rows, runs.by_block, [_PLACE[0]], "inner", small=runs.small)
        own = own & _in_runs(F.col("tramos"), number)
        before = before & _in_runs(F.col("tramos"), number + 1)
    flagged = rows.select(
        "numfila", "fecha", _PLACE[0], F.coalesce(own, F.lit(False)).alias("propia"),
        (number.isNotNull() & F.coalesce(before, F.lit(False))).alias("anterior"),
    ).filter("propia or anterior")
    neighbours = (
        Window.partitionBy(*_PLACE).orderBy("numfila").rangeBetween(-1, -1)
    )
    placed = _placed(flagged).repartitionByRange(*_PLACE)
    looked_up = placed.select(
        "numfila", "fecha", "propia", F.sum("veces").over(neighbours).alias("veces_antes"),
        F.max("fecha").over(neighbours).alias("fecha_antes"),
    ).filter("propia")
    problem = F.concat(F.lit("more than one row before number "), number.cast("string"))
    seconds = F.when(number.isNotNull(), seconds_between(F.col("fecha"), F.col("fecha_antes")))
    several = number.isNotNull() & (F.col("veces_antes") > 1)
    return looked_up.select(
        *(["numfila"] if keep_number else []),
        F.when(several, F.raise_error(problem)).otherwise(seconds).alias("segundos"),
    )


def _between(number: Column, low: int | None, high: int | None) -> Column:
    kept = F.lit(True)
    if low is not None:
        kept = kept & (number >= low)
    if high is not None:
        kept = kept & (number <= high)
    return kept


def _block(number: Column) -> Column:
    return F.floor(number / F.lit(BLOCK)).cast("bigint")


def _placed(rows: DataFrame) -> DataFrame:
    """Each row at its own place, and at that of the next number if it is another one."""
    number, following = F.col("numfila"), F.col("numfila") + 1
    spark = rows.sparkSession
    hot = hot_keys(rows.filter(number.isNotNull()), ["numfila"])
    shared = F.lit(None).cast("bigint")
    if not hot.hashes:
        here, there = _block(number), _block(following)
        at = [F.when(F.col("propia"), F.struct(here.alias(_PLACE[0]), F.lit(True).alias("propia")))]
        elsewhere = F.col("anterior") & (~F.col("propia") | (here != there))
        at.append(F.when(elsewhere, F.struct(there.alias(_PLACE[0]), F.lit(False).alias("propia"))))
        copies = rows.select("numfila", "fecha", F.inline(F.array_compact(F.array(*at))))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return copies.select(
            "*", shared.alias(_PLACE[1]), _spread_nulls(parts).alias(_PLACE[2]),
            F.lit(1).cast("bigint").alias("veces"),
        )
    # At most one row for each key that can be hot; blocks with one have a place for each number.
    is_hot = key_hash(["numfila"]).isin(list(hot.hashes))
    found = rows.filter(is_hot).groupBy("numfila").agg(
        F.count(F.lit(1)).alias("veces"), F.max("fecha").alias("fecha"), F.max("anterior").alias("anterior")
    )
    many = found.collect()
    numbers = sorted(r["numfila"] for r in many)
    blocks = sorted({n // BLOCK for n in numbers})

    def place(n: Column, part: Column, own: bool) -> Column:
        block = _block(n)
        return F.struct(
            block.alias(_PLACE[0]), F.when(block.isin(blocks), n).otherwise(shared).alias(_PLACE[1]),
            part.cast("int").alias(_PLACE[2]), F.lit(own).alias("propia"),
        )

    part = F.pmod(F.xxhash64("fecha", F.spark_partition_id()), F.lit(hot.slices)).cast("int")
    here = place(number, F.when(number.isNull() | number.isin(numbers), part).otherwise(0), True)
    every_part = F.sequence(F.lit(0), F.when(following.isin(numbers), hot.slices - 1).otherwise(0))
    there = F.transform(every_part, lambda p: place(following, p, False))
    single = ~F.coalesce(number.isin(numbers), F.lit(False))
    apart = ~F.col("propia") | (_block(number) != _block(following)) | _block(number).isin(blocks)
    nowhere = F.array().cast(f"array<{_place_type()}>")
    copies = F.concat(
        F.when(F.col("propia"), F.array(here)).otherwise(nowhere),
        F.when(F.col("anterior") & single & apart, there).otherwise(nowhere),
    )
    spread = rows.select("numfila", "fecha", F.inline(copies), F.lit(1).cast("bigint").alias("veces"))
    counted = found.filter("anterior").select("numfila", "fecha", F.inline(there), "veces")
    return spread.unionByName(counted)


def _place_type() -> str:
    block, number, part = _PLACE
    return f"struct<{block}:bigint,{number}:bigint,{part}:int,propia:boolean>"


def _spread_nulls(parts: int) -> Column:
    """Rows without number are spread, all others share a part."""
    place = F.pmod(F.xxhash64("fecha", F.spark_partition_id()), F.lit(parts)).cast("int")
    return F.when(F.col("numfila").isNull(), place).otherwise(0)


class _Runs(NamedTuple):
    """Selected numbers: for each block the runs of consecutive ones, in order."""

    by_block: DataFrame  # block, tramos
    small: bool
    least: int
    greatest: int


def _runs(spark: SparkSession, numbers: Collection[int] | DataFrame) -> _Runs | None:
    """The runs by block; a block also has the first number of the next, for the row before it.

    None if no number is selected. The table goes into the plan as data: the plan has the
    same size for any list.
    """
    if isinstance(numbers, DataFrame):
        (name,) = numbers.columns
        n = F.col(name).cast("bigint")
        listed = numbers.select(n.alias("desde"), n.alias("hasta")).dropna()
        found = listed.agg(F.min("desde"), F.max("desde"), F.count(F.lit(1))).first()
        least, greatest, count = found
        if not count:
            return None
        cut = listed.select(
            F.explode(F.array_distinct(F.array(_block(F.col("desde")), _block(F.col("desde") - 1)))).alias(_PLACE[0]),
            "desde", "hasta",
        ).distinct()
    else:
        if isinstance(numbers, range) and abs(numbers.step) == 1 and len(numbers):
            ends = numbers[0], numbers[-1]
            starts = np.array([min(ends)], np.int64)
            stops = np.array([max(ends)], np.int64)
        else:
            kept = (n for n in numbers if n is not None)
            known = np.unique(np.fromiter(kept, np.int64))
            if not len(known):
                return None
            starts = known[np.concatenate([[True], np.diff(known) != 1])]
            stops = known[np.concatenate([np.diff(known) != 1, [True]])]
        least, greatest = int(starts[0]), int(stops[-1])
        table = pa.table({"desde": starts, "hasta": stops})
        listed = spark.createDataFrame(table, "desde bigint, hasta bigint")
        of_run = F.sequence(_block(F.col("desde") - 1), _block(F.col("hasta")))
        cut = listed.select(F.explode(of_run).alias(_PLACE[0]), "desde", "hasta").select(
            _PLACE[0],
            F.greatest(F.col("desde"), F.col(_PLACE[0]) * BLOCK).alias("desde"),
            F.least(F.col("hasta"), (F.col(_PLACE[0]) + 1) * BLOCK).alias("hasta"),
        ).filter("desde <= hasta")
        count = len(starts) + int(((stops - starts) // BLOCK + 2).sum())
    by_block = cut.groupBy(_PLACE[0]).agg(
        F.array_sort(F.collect_list(F.struct("desde", "hasta"))).alias("tramos")
    )
    return _Runs(by_block, 16 * count <= joins.BROADCAST_BYTES, least, greatest)


def _in_runs(runs: Column, number: Column) -> Column:
    """Whether a number lies in one of the sorted runs, found by halving."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(BLOCK.bit_length()))))

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(runs, at + step - 1)["desde"] <= number, at + step).otherwise(at)

    def inside(at: Column) -> Column:
        return F.coalesce(F.get(runs, at - 1)["hasta"] >= number, F.lit(False))

    return F.aggregate(steps, F.lit(0), further, inside)
