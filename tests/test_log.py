import collections
import random
from datetime import timedelta

import pytest
from conftest import at, plan_of, table
from pyspark.sql import functions as F

from docketflow import log_seconds
from docketflow.operators import joins, process_log

LOG = [
    (1, at("2008-01-01 10:00:00")),
    (2, at("2008-01-01 10:00:05.900")),
    (3, at("2008-01-02 10:00:05.100")),
    (5, at("2008-01-02 11:00:00")),
]


def values(df):
    return [tuple(row) for row in df.collect()]


@pytest.fixture(params=["broadcast", "shuffled"])
def way(request):
    if request.param == "shuffled":
        request.getfixturevalue("no_broadcast")


def test_whole_log(spark, way):
    result = log_seconds(table(spark, "est_log", LOG), keep_number=True)
    assert values(result) == [(1, None), (2, -5), (3, -86400), (5, None)]


def test_single_column_in_number_order(spark, way):
    assert values(log_seconds(table(spark, "est_log", LOG[::-1]))) == [
        (None,), (-5,), (-86400,), (None,),
    ]


def test_selection_looks_up_in_the_whole_log(spark, way):
    log = table(spark, "est_log", LOG)
    assert values(log_seconds(log, first=2, last=3)) == [(-5,), (-86400,)]
    assert values(log_seconds(log, 1, 4, numbers=(3, 2, 9), keep_number=True)) == [
        (2, -5), (3, -86400),
    ]


def test_double_predecessor_fails_only_where_it_is_used(spark, way):
    log = table(spark, "est_log", [*LOG, (1, at("2008-01-01 09:00:00"))])
    assert values(log_seconds(log, first=3)) == [(-86400,), (None,)]
    with pytest.raises(Exception, match="more than one row before number 2"):
        log_seconds(log, last=2).collect()


def test_repeated_number_keeps_all_its_rows(spark, way):
    many = [(3, at(f"2008-01-02 10:00:{i:02d}")) for i in range(60)]
    log = table(spark, "est_log", [*LOG[:2], *many])
    result = values(log_seconds(log, keep_number=True))
    assert len(result) == 62
    # 24 hours after 10:00:05 less five seconds, then one second more each
    assert sorted(s for n, s in result if n == 3) == sorted(-86395 - i for i in range(60))


def test_selection_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    table(spark, "est_log", LOG).write.parquet(path)
    plan = plan_of(log_seconds(spark.read.parquet(path), 10000, 12000, (10020, 10019, 10021)))
    assert "GreaterThanOrEqual(numfila,10018)" in plan and "LessThanOrEqual(numfila,10021)" in plan
    assert plan.count("FileScan") == plan.count("ReadSchema") == 1
    assert "Python" not in plan
    assert "GreaterThanOrEqual(numfila,9999)" in plan_of(log_seconds(spark.read.parquet(path), 10000, 12000))


def test_one_range_exchange(spark, tmp_path):
    path = str(tmp_path / "log")
    table(spark, "est_log", LOG).write.parquet(path)
    for numbers in (None, [1, 3]):
        plan = plan_of(log_seconds(spark.read.parquet(path), numbers=numbers))
        assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Sort [") == 1
        assert "hashpartitioning(numfila" not in plan and "MergeJoin" not in plan


def by_definition(rows, wanted):
    """(number, seconds), or None if the query must fail."""
    before = collections.defaultdict(list)
    for n, at_ in rows:
        before[n].append(at_)
    result = []
    for n, at_ in rows:
        if n is None:
            if wanted is None:
                result.append((n, None))
        elif wanted is None or n in wanted:
            earlier = before.get(n - 1, [])
            if len(earlier) > 1:
                return None
            whole = [x and x.replace(microsecond=0) for x in (at_, *earlier)]
            seconds = int((whole[1] - whole[0]).total_seconds()) if earlier and None not in whole else None
            result.append((n, seconds))
    return sorted(result, key=repr)


def random_log(seed, twice=()):
    rng = random.Random(seed)
    start = at("2008-01-01")
    numbers = rng.sample(range(-40, 200), 150) + [None, None, 0, 4096, 4095, 4097, 8191, 8192]
    rows = [(n, start + timedelta(milliseconds=rng.randrange(10**9))) for n in numbers if n not in twice]
    rows += [(n, start + timedelta(seconds=k)) for n in twice for k in range(40)]
    rows.append((500, None))
    return list(dict.fromkeys(rows))


@pytest.mark.parametrize("block", [4, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs(spark, way, monkeypatch, block, seed):
    monkeypatch.setattr(process_log, "BLOCK", block)
    rows = [r for r in random_log(seed) if r[0] != 0 or r[1]]
    rows = [r for k, r in enumerate(rows) if r[0] is None or r[0] not in {x[0] for x in rows[:k]}]
    log = table(spark, "est_log", rows).repartition(5)
    rng = random.Random(seed)
    chosen = rng.sample(range(-50, 210), 90) + [4095, 4096, 8192]
    assert sorted(values(log_seconds(log, keep_number=True)), key=repr) == by_definition(rows, None)
    found = values(log_seconds(log, numbers=chosen, keep_number=True))
    assert sorted(found, key=repr) == by_definition(rows, set(chosen))
    assert [n for n, _ in found] == sorted(n for n, _ in found)
    listed = spark.createDataFrame([(n,) for n in [*chosen, None, chosen[0]]], "n bigint")
    assert sorted(values(log_seconds(log, numbers=listed, keep_number=True)), key=repr) == by_definition(rows, set(chosen))
    ranged = values(log_seconds(log, numbers=range(150, -20, -1), keep_number=True))
    assert sorted(ranged, key=repr) == by_definition(rows, set(range(-19, 151)))
    assert values(log_seconds(log, first=0, last=20, numbers=chosen, keep_number=True)) == [
        r for r in found if 0 <= r[0] <= 20
    ]


def test_hot_numbers_are_spread(spark, no_broadcast):
    """Hot numbers, one after the other's neighbour; rows after them fail only where selected."""
    twice = (20, 50, 4096)
    rows = [r for r in random_log(3) if r[0] not in {20, 21, 50, 51, 4096, 4097}]
    rows += [(n, at("2008-02-01") + timedelta(seconds=k)) for n in twice for k in range(80)]
    rows = [r for k, r in enumerate(rows) if r[0] in (None, *twice) or r[0] not in {x[0] for x in rows[:k]}]
    log = table(spark, "est_log", rows).repartition(5)
    assert joins.hot_keys(log.dropna(), ["numfila"]).hashes
    found = values(log_seconds(log, keep_number=True))
    assert sorted(found, key=repr) == by_definition(rows, None)
    numbers = [n for n, _ in found if n is not None]
    assert numbers == sorted(numbers) and numbers.count(50) == 80
    placed = process_log._placed(log.select("*", F.lit(True).alias("propia"), F.lit(True).alias("anterior")))
    assert placed.filter("numfila = 50 and propia").select("__parte").distinct().count() > 1
    with_next = log.union(table(spark, "est_log", [(51, at("2008-02-02"))]))
    assert len(values(log_seconds(with_next, last=50))) == len([n for n in numbers if n <= 50])
    with pytest.raises(Exception, match="more than one row before number 51"):
        log_seconds(with_next, first=51).collect()


def test_a_million_numbers(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(0, 3_000_000, 2).select(
        F.col("id").alias("numfila"), F.timestamp_seconds(F.col("id") * 3).cast("timestamp_ntz").alias("fecha")
    ).union(
        spark.range(1, 3_000_000, 200).select("id", F.timestamp_seconds(F.col("id") * 3).cast("timestamp_ntz"))
    ).write.parquet(path)
    log = spark.read.schema("numfila bigint, fecha timestamp_ntz").parquet(path)
    result = log_seconds(log, numbers=range(0, 3_000_000, 3), keep_number=True)
    few = log_seconds(log, numbers=range(0, 30, 3), keep_number=True)
    assert abs(len(plan_of(result)) - len(plan_of(few))) < 100
    got = result.agg(F.count(F.lit(1)), F.count("segundos"), F.min("segundos"), F.max("segundos")).first()
    odd = set(range(1, 3_000_000, 200))
    there = [n for n in range(0, 3_000_000, 3) if n % 2 == 0 or n in odd]
    follows = [n for n in there if (n - 1) % 2 == 0 and n > 0 or n - 1 in odd]
    assert tuple(got) == (len(there), len(follows), -3, -3)


def test_no_number_selects_nothing(spark):
    log = table(spark, "est_log", LOG)
    assert values(log_seconds(log, numbers=[])) == []
    assert values(log_seconds(log, numbers=spark.createDataFrame([], "n bigint"))) == []
    assert values(log_seconds(log.filter("false"))) == []
