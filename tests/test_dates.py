from datetime import datetime, timedelta

import pytest
from conftest import at, plan_of
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketflow import day_between, parse_dmy, seconds_between, trunc_day
from docketflow.functions.dates import as_datetime, from_day, until_day

TIMES = [
    "1969-12-31 23:59:58.500", "2008-02-29 00:00:00", "2008-03-01 00:00:00",
    "2008-03-01 10:00:00", "2008-03-01 15:00:00", "2008-03-02 00:00:00",
    "2008-03-02 23:59:59.999", "2008-03-03 00:00:00", None,
]


def moments(spark, rows, names):
    schema = ", ".join(f"{name} timestamp_ntz" for name in names)
    return spark.createDataFrame(rows, schema)


def test_trunc_day_and_parse(spark):
    row = moments(spark, [(at("2008-03-01 15:30:01"),)], ["t"]).select(
        trunc_day(F.col("t")).alias("day"), parse_dmy(F.lit("31/12/2008")).alias("parsed")
    )
    assert [field.dataType.simpleString() for field in row.schema] == ["timestamp_ntz"] * 2
    assert tuple(row.first()) == (at("2008-03-01"), at("2008-12-31"))


def test_column_bounds_equal_truncating_form(spark):
    values = [at(text) for text in TIMES]
    rows = [(t, lo, hi) for t in values for lo in values for hi in values]
    t, lo, hi = F.col("t"), F.col("lo"), F.col("hi")
    plain = (trunc_day(t) >= lo) & (trunc_day(t) <= hi)
    df = moments(spark, rows, ["t", "lo", "hi"])
    assert df.filter(plain).count() > 100
    assert df.filter(~plain.eqNullSafe(day_between(t, lo, hi)) & lo.isNotNull()
                     & hi.isNotNull() & t.isNotNull()).count() == 0
    kept = df.filter(day_between(t, lo, hi))
    assert kept.filter(t.isNull() | lo.isNull() | hi.isNull()).count() == 0


@pytest.fixture(scope="module")
def grid(spark):
    start = datetime(2008, 3, 1)
    rows = [(start + timedelta(hours=6 * i, seconds=i % 3),) for i in range(40)]
    df = moments(spark, rows, ["t"]).coalesce(1).cache()
    df.count()
    return df


@given(
    st.datetimes(datetime(2008, 2, 28), datetime(2008, 3, 12)),
    st.datetimes(datetime(2008, 2, 28), datetime(2008, 3, 12)),
)
def _literal_bounds(grid, lo, hi):
    day = trunc_day(F.col("t"))
    bound = [F.lit(b.isoformat(sep=" ")).cast("timestamp_ntz") for b in (lo, hi)]
    by_definition = (day >= bound[0]) & (day <= bound[1])
    assert grid.filter(by_definition != day_between(F.col("t"), lo, hi)).isEmpty()


def test_literal_bounds_equal_truncating_form(grid):
    from hypothesis import settings

    settings(max_examples=25, deadline=None)(_literal_bounds)(grid)


def test_halves(grid):
    day = datetime(2008, 3, 3, 10)
    both = grid.filter(day_between(F.col("t"), day, day + timedelta(days=3)))
    halves = grid.filter(from_day(F.col("t"), day)).filter(
        until_day(F.col("t"), day + timedelta(days=3))
    )
    assert both.exceptAll(halves).isEmpty() and halves.exceptAll(both).isEmpty()


def test_literal_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    moments(spark, [(at("2008-03-01"),)], ["t"]).write.parquet(path)
    plan = plan_of(
        spark.read.parquet(path).filter(day_between(F.col("t"), at("2008-03-01"), at("2008-03-02")))
    )
    assert "GreaterThanOrEqual(t,2008-03-01T00:00)" in plan
    assert "LessThan(t,2008-03-03T00:00)" in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_ignore_zone_and_fractions(spark, zone):
    pairs = [
        ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 7200),
        ("2024-11-03 00:30:00", "2024-11-03 02:30:00", 7200),
        ("2008-01-01 10:00:05.900", "2008-01-01 10:00:06.100", 1),
        ("1969-12-31 23:59:58.500", "1970-01-01 00:00:00.200", 2),
        ("2008-01-02 00:00:00", "2008-01-01 00:00:00", -86400),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = moments(spark, [(at(a), at(b)) for a, b, _ in pairs], ["a", "b"])
        got = df.select("a", "b", seconds_between(F.col("a"), F.col("b")).alias("s"))
        assert got.schema["s"].dataType.simpleString() == "bigint"
        found = {(row.a, row.b): row.s for row in got.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == {(at(a), at(b)): seconds for a, b, seconds in pairs}


def test_zoned_moment_is_rejected():
    with pytest.raises(ValueError):
        as_datetime(datetime.fromisoformat("2008-01-01T00:00:00+00:00"))
