"""Tables stored by case: the same answers, and no exchange for the joins by case."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_exits import as_frames, by_definition, random_data, resolved

from docketflow import (
    child_event_exits,
    child_reassignment_exits,
    exit_candidates,
    last_exit_event,
    latest_per_case,
    open_by_case,
    write_by_case,
)
from docketflow.operators import candidates, joins

CODES = ("SOB", "ARC")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    requests, *data, ends = random_data(41, 0.0)
    asked, tables = as_frames(spark, requests, *data)
    folder = str(tmp_path_factory.mktemp("by_case") / "court")
    assert write_by_case(tables, folder, 4) == {
        "actuacion_exp": 4, "expediente": 4, "cambio_asignacion_exp": 4,
        "estado_expediente": 0, "juzgado_oficina": 0,
    }
    return requests, data, ends, asked, tables, open_by_case(spark, folder)


@pytest.fixture
def large(spark, monkeypatch):
    """No table is small enough to broadcast, and no key is hot."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges_by_case(df):
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    return len(re.findall(r"Exchange hashpartitioning\(id_expediente#", plan))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_tables_come_back_as_they_were(stored):
    *_, tables, back = stored
    for before, after in zip(tables, back):
        assert after.schema.simpleString() == before.schema.simpleString()
        assert rows(before) == rows(after)


def test_answers_are_the_same(stored):
    requests, data, ends, asked, _, back = stored
    expected = by_definition(requests, *data, CODES, ("ETO",))
    assert resolved(last_exit_event(asked, back, ends, CODES, ("ETO",))) == expected


QUERIES = {
    "J2, derived events": lambda asked, t, end: child_event_exits(asked, t, end),
    "J3, derived reassignments": lambda asked, t, end: child_reassignment_exits(asked, t, end),
    "J6, both with own events": lambda asked, t, end: exit_candidates(asked, t, end, CODES),
}


@pytest.mark.parametrize("name", QUERIES)
def test_no_exchange_for_the_joins_with_cases(stored, spark, monkeypatch, name):
    """Offices and states are broadcast, the tables by case are not: nothing is exchanged by case."""
    _, _, ends, asked, tables, back = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(candidates, "fits_broadcast", lambda df: False)
    try:
        found, shuffled = (QUERIES[name](asked, t, ends[1]) for t in (back, tables))
        assert rows(found) == rows(shuffled) != []
        assert exchanges_by_case(found) == 0 < exchanges_by_case(shuffled)
        assert "Bucketed: true" in plan_of(found) and "SortMergeJoin [id_expediente" in plan_of(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_answers_per_case_are_the_same(stored, large):
    _, _, ends, _, tables, back = stored
    found, shuffled = (latest_per_case(t, ends, exit_codes=CODES) for t in (back, tables))
    assert rows(found) == rows(shuffled) != []


def test_a_hot_case_is_not_put_into_one_bucket(spark, monkeypatch, no_broadcast, tmp_path):
    requests, *data, ends = random_data(42, 0.5)
    asked, tables = as_frames(spark, requests, *data)
    layout = write_by_case(tables, str(tmp_path / "court"), 4)
    assert layout["actuacion_exp"] == 0 and layout["expediente"] == 4
    back = open_by_case(spark, str(tmp_path / "court"))
    expected = by_definition(requests, *data, CODES, ("ETO",))
    assert resolved(last_exit_event(asked, back, ends, CODES, ("ETO",))) == expected


def test_extra_columns_are_left_out(spark, tmp_path, stored):
    *_, tables, _ = stored
    more = tables._replace(cases=tables.cases.withColumn("cubos", F.lit(1)))
    write_by_case(more, str(tmp_path / "court"), 2)
    assert rows(open_by_case(spark, str(tmp_path / "court")).cases) == rows(tables.cases)
