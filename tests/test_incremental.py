"""State plus batches equals the full run."""

import random

import pytest
from conftest import tables_of
from test_exits import as_frames, by_definition, random_data, with_own_ends

from pyspark.sql import functions as F

from docketflow import ExitLedger
from docketflow.operators import joins
from docketflow.operators.exits import exits_from_state, merged_state
from docketflow.plans import incremental
from docketflow.sources.store import shared_folder

CODES = ("SOB", "ARC")


def answered(df):
    return {r.request_id: (r.id_act, r.fecha_salida, r.codigo_salida) for r in df.collect()}


def dealt(rows, seed, n):
    """The rows dealt to so many parts at random."""
    rng = random.Random(seed)
    parts = [[] for _ in range(n)]
    for row in rows:
        rng.choice(parts).append(row)
    return parts


def one_origin(data):
    """A case has one row, of its only origin, wherever its link comes from."""
    events, states, cases, changes, courts = data
    return events, states, list(dict(cases).items()), changes, courts


@pytest.mark.parametrize("seed, hot, childs", [(51, 0.0, ("ETO",)), (52, 0.3, ("ETO", "SOB"))])
@pytest.mark.parametrize("way", ["broadcast", "shuffled"])
def test_batches_equal_the_full_run(spark, request, way, seed, hot, childs):
    if way == "shuffled":
        request.getfixturevalue("no_broadcast")
    requests, *data, _ = random_data(seed, hot)
    requests = with_own_ends(requests, seed)
    events, states, cases, changes, courts = one_origin(data)
    ledger = ExitLedger(spark, shared_folder(spark, "ledger"), CODES, childs)
    assert ledger.answers() is None
    parts = [dealt(rows, seed + k, 3) for k, rows in enumerate((events, cases, changes, requests))]
    seen = [[], [], [], []]
    for batch in zip(*parts):
        for known, new in zip(seen, batch):
            known.extend(new)
        all_events, all_cases, all_changes, all_requests = seen
        asked, tables = as_frames(spark, all_requests, [], states, all_cases, [], courts)
        new = tables_of(spark, batch[0], [], batch[1], batch[2], [])
        ledger.update(asked, tables, new)
        expected = by_definition(all_requests, all_events, states, all_cases, all_changes, courts, CODES, childs)
        assert answered(ledger.answers()) == expected
    # A batch that is sent again changes nothing, nor does compaction.
    ledger.update(asked, tables, new)
    assert answered(ledger.answers()) == expected
    ledger.compact()
    assert answered(ledger.answers()) == expected
    ledger.update(asked, tables, tables_of(spark, [], [], [], [], []))
    assert answered(ledger.answers()) == expected


def test_only_touched_cases_are_answered_again(spark):
    requests, *data, _ = random_data(53, 0.0)
    requests = with_own_ends(requests, 53)
    events, states, cases, changes, courts = one_origin(data)
    asked, tables = as_frames(spark, requests, [], states, cases, [], courts)
    path = shared_folder(spark, "ledger")
    ledger = ExitLedger(spark, path, CODES)
    ledger.update(asked, tables, tables_of(spark, events, [], [], changes, []))
    late = [e for e in events if e[1] is not None][0]
    more = [(900, late[1], 1, late[3], late[4])]
    number = ledger.update(asked, tables, tables_of(spark, more, [], [], [], []))
    newest = spark.read.json(f"{path}/commits").filter(f"commit = {number}").first().lote
    again = spark.read.parquet(f"{path}/respuestas/lote={newest}")
    touched = {late[1], dict(cases).get(late[1])} - {None}
    assert {r.request_id for r in again.collect()} == {r[0] for r in requests if r[1] in touched}
    assert 0 < again.count() < len(requests) / 2
    expected = by_definition(requests, events + more, states, cases, changes, courts, CODES, ("ETO",))
    assert answered(ledger.answers()) == expected


def test_a_batch_that_stops_half_way_is_not_seen(spark, monkeypatch):
    requests, *data, _ = random_data(54, 0.0)
    requests = with_own_ends(requests, 54)
    events, states, cases, changes, courts = one_origin(data)
    asked, tables = as_frames(spark, requests, [], states, cases, [], courts)
    ledger = ExitLedger(spark, shared_folder(spark, "ledger"), CODES)
    ledger.update(asked, tables, tables_of(spark, events[:100], [], [], [], []))
    before = answered(ledger.answers())
    rest = tables_of(spark, events[100:], [], [], changes, [])

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_commit", stop)
        with pytest.raises(RuntimeError):
            ledger.update(asked, tables, rest)
    assert answered(ledger.answers()) == before
    ledger.update(asked, tables, rest)
    expected = by_definition(requests, events, states, cases, changes, courts, CODES, ("ETO",))
    assert answered(ledger.answers()) == expected != before


def test_an_update_shuffles_no_more_than_it_must(spark, monkeypatch):
    """Nothing is chosen for a first batch; no rank and no join back where no case is hot."""
    requests, *data, _ = random_data(57, 0.0)
    events, states, cases, changes, courts = one_origin(data)
    asked, tables = as_frames(
        spark, with_own_ends(requests, 57), events, states, cases, changes, courts
    )
    read = []
    touched = incremental._touched
    monkeypatch.setattr(incremental, "_touched", lambda *x: read.append(1) or touched(*x))
    ledger = ExitLedger(spark, shared_folder(spark, "ledger"), CODES, ("ETO",))
    ledger.update(asked, tables, tables)
    assert not read
    state = merged_state(spark.read.parquet(f"{ledger.path}/estado").drop("lote"))
    plain = exits_from_state(asked, state, tables.cases, tables.courts)
    plan = plain._sc._jvm.PythonSQLUtils.explainString(plain._jdf.queryExecution(), "simple")
    assert plan.count("row_number(") < 4 and "numero_fila" not in plan
    # Requests without a case, an office or an end have no exit, by either way.
    odd = asked.limit(3).withColumns({
        "idexp": F.lit(None).cast("bigint"), "request_id": F.col("request_id") + 1_000_000,
    }).unionByName(asked.limit(3).withColumns({
        "fin_periodo": F.lit(None).cast("timestamp_ntz"), "request_id": F.col("request_id") + 2_000_000,
    }))
    both = asked.unionByName(odd)
    way = lambda: answered(exits_from_state(both, state, tables.cases, tables.courts))
    along = way()
    assert len(along) == both.count() and along.items() >= answered(ledger.answers()).items()
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_SHARES", 0.001)
    assert way() == along
