import pytest
from conftest import at, plan_of, table
from pyspark.sql import functions as F

from docketflow import drop_matching, keep_matching, keep_since, with_court, with_status_code
from docketflow.operators import joins
from docketflow.operators.joins import HotKeys, fits_broadcast, hot_keys, lookup_join, spread_join


@pytest.fixture(params=["broadcast", "shuffled"])
def way(request):
    if request.param == "shuffled":
        request.getfixturevalue("no_broadcast")


def ids(df):
    return sorted(row[0] for row in df.collect())


def test_keep_since(spark):
    rows = [(1, at("2007-12-31 23:59:00")), (2, at("2008-01-01")), (3, None)]
    df = spark.createDataFrame(rows, "id int, d timestamp_ntz")
    assert ids(keep_since(df, "d", at("2008-01-01"))) == [2, 3]


def test_keep_since_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(at("2008-01-01"),)], "d timestamp_ntz").write.parquet(path)
    plan = plan_of(keep_since(spark.read.parquet(path), "d", at("2008-01-01")))
    assert "Or(IsNull(d),GreaterThanOrEqual(d,2008-01-01T00:00))" in plan


def test_matching(spark, way):
    df = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id int, k int")
    keys = spark.createDataFrame([(7, "x"), (7, "x"), (None, "y")], "k int, other string")
    dropped, kept = drop_matching(df, keys, ["k"]), keep_matching(df, keys, ["k"])
    assert (ids(dropped), ids(kept)) == ([2, 3], [1])
    assert dropped.columns == kept.columns == ["id", "k"]


def test_matching_a_hot_and_a_null_key(spark, no_broadcast):
    rows = [(i, 7 if i % 3 == 0 else None if i % 3 == 1 else i) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k int")
    keys = spark.createDataFrame([(7,), (2,), (8,)] * 3, "k int")
    dropped = drop_matching(df, keys, ["k"])
    plan = plan_of(dropped)
    assert "Union" not in plan and "__salt" in plan and "SortMergeJoin" in plan
    matching = {i for i, k in rows if k in (7, 2, 8)}
    assert ids(dropped) == sorted(set(range(600)) - matching)
    assert ids(keep_matching(df, keys, ["k"])) == sorted(matching)


def test_with_court(spark, way):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, oficina bigint")
    courts = table(spark, "juzgado_oficina", [(10, 100), (10, 100), (11, None)])
    left = with_court(df, "oficina", courts)
    assert left.columns == ["id", "oficina", "juzgado"]
    assert {row.id: row.juzgado for row in left.collect()} == {1: 100, 2: None, 3: None}
    assert ids(with_court(df, "oficina", courts, "inner")) == [1]


def test_with_status_code(spark, way):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, id_estado_expediente bigint")
    states = table(spark, "estado_expediente", [(5, "196"), (6, "XXX")])
    rows = with_status_code(df, states, ["196"]).collect()
    assert [(row.id, row.codigo) for row in rows] == [(1, "196")]


def test_size_check_counts_rows_and_text(spark):
    numbers = spark.range(1000)
    assert fits_broadcast(numbers, 16_000) and not fits_broadcast(numbers, 15_999)
    texts = numbers.select(F.repeat(F.lit("x"), 100).alias("t"))
    assert fits_broadcast(texts, 116_000) and not fits_broadcast(texts, 115_999)
    assert not fits_broadcast(numbers.select(F.array("id")))
    assert fits_broadcast(numbers.filter("id < 0"), 0)


def test_only_frequent_keys_are_hot(spark, no_broadcast):
    third = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = hot_keys(third, ["k"])
    expected = third.filter("k = -1").select(joins.key_hash(["k"])).first()[0]
    assert found.hashes == (expected,)
    assert found.slices == 6  # a third of the rows over 16 partitions
    assert hot_keys(spark.range(3000), ["id"]) == HotKeys()


def test_small_input_has_no_hot_keys(spark):
    assert hot_keys(spark.range(10).select(F.lit(1).alias("k")), ["k"]) == HotKeys()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_slices_do_not_change_the_result(spark, no_broadcast, how):
    facts = spark.range(900).select("id", F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 9).alias("k"))
    dim = spark.range(0, 6).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(facts, ["k"])
    assert hot.hashes
    plain = facts.join(dim, "k", how)
    expected = sorted(map(tuple, plain.collect()))
    for other in (
        spread_join(facts, dim, ["k"], how, hot, ["k"], ["id"]),
        lookup_join(facts, dim, ["k"], how),
    ):
        assert other.columns == plain.columns
        assert sorted(map(tuple, other.collect())) == expected


def test_hot_rows_are_spread(spark, no_broadcast):
    facts = spark.range(4000).select("id", F.lit(1).cast("bigint").alias("k"))
    dim = spark.createDataFrame([(1, 5)], "k bigint, v int")
    joined = spread_join(facts, dim, ["k"], "left", hot_keys(facts, ["k"]), ["k"], ["id"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 6 and max(row["count"] for row in sizes) < 2000


def test_copies_of_one_row_stay_spread(spark, no_broadcast):
    facts = spark.range(0, 4000, 1, 8).select(F.lit(1).cast("bigint").alias("k"))
    dim = spark.createDataFrame([(1, 5)], "k bigint, v int")
    joined = lookup_join(facts, dim, ["k"], "left")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id(), "v").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 4 and max(row["count"] for row in sizes) <= 1500
    assert sum(row["count"] for row in sizes) == 4000 and {row.v for row in sizes} == {5}


def test_more_than_a_thousand_hot_keys_are_found(spark, no_broadcast):
    spark.conf.set("spark.sql.shuffle.partitions", "6000")
    try:
        # 1,500 keys of 12 rows each, 6,000 keys of one: an even share is 4 rows.
        keys = spark.range(24_000).select(
            F.when(F.col("id") < 18_000, F.col("id") % 1500).otherwise(F.col("id")).alias("k")
        )
        assert len(hot_keys(keys, ["k"]).hashes) == 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "16")


def test_key_types_must_agree(spark):
    facts = spark.range(5)
    dim = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(TypeError):
        lookup_join(facts, dim, ["id"])
    with pytest.raises(ValueError):
        lookup_join(facts, facts, ["id"], "full")
