"""Hand-made cases, and a comparison with the definition applied request by request."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import at, plan_of, table, tables_of
from pyspark.sql import functions as F

from docketflow import (
    CHILD_CODES,
    EXIT_CODES,
    child_event_exits,
    child_reassignment_exits,
    exit_candidates,
    last_exit_event,
    latest_per_case,
    own_case_exits,
)
from docketflow.operators import bloom, exits, joins

COURTS = [(10, 100), (11, 100), (20, 200)]
STATES = [(i, code) for i, code in enumerate((*EXIT_CODES, *CHILD_CODES, "XXX"), start=1)]
STATE_ID = {code: i for i, code in STATES}
END = at("2008-12-31")
ASK = (1, "2008-03-01", 10)

# name: requests (case, date, office), events and reassignments (id, case, date, office,
# code), origin of cases, expected (id, code)
E1 = (5, 1, "2008-04-01", 10, "SOB")
CHILD = (7, 2, "2008-06-01", 10, "ETO")
SCENARIOS = {
    "no rows": ([ASK], [], [], {}, [(-2, None)]),
    "plain hit": ([ASK], [E1], [], {}, [(5, "SOB")]),
    "latest wins, other office of the court": (
        [ASK], [E1, (6, 1, "2008-05-01", 11, "ARC")], [], {}, [(6, "ARC")]),
    "other court": ([ASK], [(5, 1, "2008-04-01", 20, "SOB")], [], {}, [(-2, None)]),
    "event office without court": ([ASK], [(5, 1, "2008-04-01", 99, "SOB")], [], {}, [(-2, None)]),
    "request office without court": ([(1, "2008-03-01", 99)], [E1], [], {}, [(-2, None)]),
    "no court on both sides": (
        [(1, "2008-03-01", 99)], [(5, 1, "2008-04-01", 99, "SOB")], [], {}, [(-2, None)]),
    "code not listed": ([ASK], [(5, 1, "2008-04-01", 10, "XXX")], [], {}, [(-2, None)]),
    "child code on the case itself": (
        [ASK], [(5, 1, "2008-04-01", 10, "ETO")], [], {}, [(-2, None)]),
    "exit code on a child": ([ASK], [(7, 2, "2008-06-01", 10, "SOB")], [], {2: 1}, [(-2, None)]),
    "last day counts whole": ([ASK], [(5, 1, "2008-12-31 23:59:59", 10, "SOB")], [], {}, [(5, "SOB")]),
    "after the period": ([ASK], [(5, 1, "2009-01-01", 10, "SOB")], [], {}, [(-2, None)]),
    "same day as a midnight request": (
        [ASK], [(5, 1, "2008-03-01 15:00:00", 10, "SOB")], [], {}, [(5, "SOB")]),
    "only the event is truncated": (
        [(1, "2008-03-01 10:00:00", 10)], [(5, 1, "2008-03-01 15:00:00", 10, "SOB")], [], {},
        [(-2, None)]),
    "child event": ([ASK], [CHILD], [], {2: 1}, [(7, "ETO")]),
    "child reassignment": ([ASK], [], [(8, 2, "2008-06-01", 10, "ETO")], {2: 1}, [(8, "ETO")]),
    "both on one child": (
        [ASK], [CHILD], [(8, 2, "2008-06-02", 10, "ETO")], {2: 1}, [(8, "ETO")]),
    "own case and child": ([ASK], [E1, CHILD], [], {2: 1}, [(-3, None)]),
    "two children": (
        [ASK], [CHILD, (9, 3, "2008-06-01", 10, "ETO")], [], {2: 1, 3: 1}, [(-3, None)]),
    "second child before the request": (
        [ASK], [CHILD, (9, 3, "2008-02-01", 10, "ETO")], [], {2: 1, 3: 1}, [(7, "ETO")]),
    "no grandchildren": (
        [ASK], [(9, 3, "2008-06-01", 10, "ETO")], [], {2: 1, 3: 2}, [(-2, None)]),
    "reassignment of the case itself": (
        [ASK], [], [(8, 1, "2008-06-01", 10, "ETO")], {}, [(-2, None)]),
    "tie goes to the higher id": (
        [ASK], [E1, (6, 1, "2008-04-01", 10, "ARC")], [], {}, [(6, "ARC")]),
    "tie of id goes to the higher code": (
        [ASK], [E1, (5, 1, "2008-04-01", 10, "ARC")], [], {}, [(5, "SOB")]),
    "event without date": ([ASK], [(5, 1, None, 10, "SOB")], [], {}, [(-2, None)]),
    "requests are independent": (
        [ASK, (1, "2008-04-15", 10), (1, "2008-05-02", 10)],
        [E1, (6, 1, "2008-05-01", 11, "ARC")], [], {}, [(6, "ARC"), (6, "ARC"), (-2, None)]),
    "code stays text": ([ASK], [(5, 1, "2008-04-01", 10, "196")], [], {}, [(5, "196")]),
    "request without date": ([(1, None, 10)], [E1], [], {}, [(-2, None)]),
    "own origin is one group": (
        [ASK], [E1, (7, 1, "2008-06-01", 10, "ETO")], [], {1: 1}, [(7, "ETO")]),
    "copies of a row are one": ([ASK], [E1, E1, E1], [], {}, [(5, "SOB")]),
}


@pytest.fixture(scope="module")
def scenarios(spark):
    """All scenarios side by side; each has its own block of case numbers."""
    requests, events, changes, cases, expected = [], [], [], [], {}
    for block, (asks, evs, chs, origin, answers) in enumerate(SCENARIOS.values()):
        base = block * 1000
        for (case, day, office), answer in zip(asks, answers):
            request_id = len(requests)
            requests.append((request_id, base + case, at(day), office, 13))
            expected[request_id] = answer
        events += [(i, base + c, STATE_ID[code], o, at(d)) for i, c, d, o, code in evs]
        changes += [(i, base + c, o, at(d), code) for i, c, d, o, code in chs]
        cases += [(base + c, base + origin[c] if c in origin else None) for c in (1, 2, 3)]
    tables = tables_of(spark, events, STATES, cases, changes, COURTS)
    return table(spark, "pedidos", requests), tables, expected


def answers_of(df):
    return {row.request_id: (row.id_act, row.codigo_salida) for row in df.collect()}


def test_scenarios(scenarios):
    requests, tables, expected = scenarios
    assert answers_of(last_exit_event(requests, tables, END)) == expected


def test_scenarios_without_broadcast(scenarios, no_broadcast):
    requests, tables, expected = scenarios
    assert answers_of(last_exit_event(requests, tables, END)) == expected


def test_date_is_null_exactly_without_exit(scenarios):
    requests, tables, _ = scenarios
    for row in last_exit_event(requests, tables, END).collect():
        assert (row.fecha_salida is None) == (row.id_act < 0)


def test_plan_has_no_python_and_no_cartesian_product(scenarios):
    requests, tables, _ = scenarios
    plan = plan_of(last_exit_event(requests, tables, END))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_two_courts_for_an_office_fail(spark, scenarios):
    requests, tables, _ = scenarios
    doubled = tables._replace(courts=table(spark, "juzgado_oficina", [*COURTS, (10, 200)]))
    with pytest.raises(Exception, match="more than one juzgado"):
        last_exit_event(requests, doubled, END).collect()


def test_no_period_end_is_rejected(scenarios):
    requests, tables, _ = scenarios
    with pytest.raises(ValueError):
        last_exit_event(requests, tables, [])


def random_data(seed, hot):
    """Small numbers of cases, offices and days, so that everything collides."""
    rng = random.Random(seed)
    start = datetime(2008, 1, 1)

    def moment():
        day = start + timedelta(days=rng.randrange(40))
        return rng.choice([day, day + timedelta(hours=rng.randrange(24)), None, day])

    def case():
        return 0 if rng.random() < hot else rng.choice([None, *range(30)])

    def office():
        return 0 if rng.random() < hot else rng.choice([None, *range(12)])

    states = [(1, "SOB"), (2, "ARC"), (3, "ETO"), (4, "XXX")]
    courts = [(o, rng.choice([100, 200, 300, None])) for o in range(10)]
    cases = [(c, rng.choice([None, 0, 0, 1, 2, c])) for c in range(30)]
    events = [
        (rng.randrange(60), case(), rng.choice([1, 2, 3, 4, None]), office(), moment())
        for _ in range(250)
    ]
    events += events[:40]
    changes = [
        (rng.randrange(60), case(), office(), moment(), rng.choice(["ETO", "OTR"]))
        for _ in range(80)
    ]
    ends = [start + timedelta(days=d, hours=h) for d, h in ((12, 0), (25, 7), (38, 0))]
    requests = [(i, case(), moment(), office(), 13, rng.choice(ends)) for i in range(200)]
    return requests, events, states, cases, changes, courts, ends


def by_definition(requests, events, states, cases, changes, courts, exits, childs):
    """One request at a time: candidates, latest per case, then none, one or several."""
    code, court, origin = dict(states), dict(courts), dict(cases)
    midnight = lambda moment: datetime.combine(moment.date(), datetime.min.time())
    answers = {}
    for request_id, idexp, since, office, _, end in requests:
        rows = [(d, i, code.get(s), c, o, c) for i, c, s, o, d in events if code.get(s) in exits]
        rows += [
            (d, i, code.get(s), c, o, origin.get(c)) for i, c, s, o, d in events
            if code.get(s) in childs
        ]
        rows += [(d, i, k, c, o, origin.get(c)) for i, c, o, d, k in changes if k in childs]
        latest = {}
        for d, i, k, c, o, target in rows:
            if None in (d, since, end, idexp, target, court.get(o), court.get(office)):
                continue
            same = target == idexp and court[o] == court[office]
            if same and since <= midnight(d) <= end:
                latest[c] = max(latest.get(c, (d, i, k)), (d, i, k))
        if len(latest) == 1:
            (d, i, k), = latest.values()
            answers[request_id] = (i, d, k)
        else:
            answers[request_id] = (-3 if latest else -2, None, None)
    return answers


def as_frames(spark, requests, events, states, cases, changes, courts):
    schema = (
        "request_id bigint, idexp bigint, ta_fecha timestamp_ntz, ta_oficina bigint,"
        " camara int, fin_periodo timestamp_ntz"
    )
    return spark.createDataFrame(requests, schema), tables_of(
        spark, events, states, cases, changes, courts
    )


def resolved(df):
    return {r.request_id: (r.id_act, r.fecha_salida, r.codigo_salida) for r in df.collect()}


@pytest.mark.parametrize("seed, hot, childs", [(1, 0.0, ("ETO",)), (2, 0.4, ("ETO", "SOB"))])
def test_several_period_ends(spark, seed, hot, childs):
    requests, *data, ends = random_data(seed, hot)
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), childs)
    assert {a[0] for a in expected.values()} >= {-2, -3}
    assert resolved(last_exit_event(*frames, ends, ("SOB", "ARC"), childs)) == expected


def salted_keys(df):
    lines = plan_of(df).splitlines()
    return " ".join(line for line in lines if "SortMergeJoin" in line and "__salt" in line)


@pytest.mark.parametrize("seed, hot", [(3, 0.4), (4, 0.0)])
def test_hot_keys_without_broadcast(spark, no_broadcast, seed, hot):
    requests, *data, ends = random_data(seed, hot)
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), ("ETO",))
    assert bool(joins.hot_keys(frames[0], ["idexp"]).hashes) == (hot > 0)
    result = last_exit_event(*frames, ends, ("SOB", "ARC"), ("ETO",))
    # Few states and offices are always hot here, the requests only with a hot case.
    assert ("idexp#" in salted_keys(result)) == (hot > 0)
    assert resolved(result) == expected


@pytest.mark.parametrize("seed, several", [(9, True), (10, False)])
def test_few_requests_prune_the_other_cases(spark, monkeypatch, seed, several):
    monkeypatch.setattr(exits, "PRUNE_RATIO", 0)
    requests, *data, ends = random_data(seed, 0.2)
    requests = [r for r in requests if r[1] in (None, 0, 2, 5)]
    if not several:
        requests = [(*r[:5], ends[1]) for r in requests]
        ends = [ends[1]]
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), ("ETO", "SOB"))
    assert {a[0] for a in expected.values()} >= {-2, -3}
    result = last_exit_event(*frames, ends, ("SOB", "ARC"), ("ETO", "SOB"))
    assert "LeftSemi" in plan_of(result)
    assert resolved(result) == expected


def test_many_requests_prune_by_a_filter(spark, monkeypatch):
    """A tenth of the cases, too many to broadcast: about a tenth of the events is shuffled."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 4 * bloom.BLOCK_BYTES)
    rng = random.Random(13)
    n, start = 20_000, datetime(2008, 1, 1)
    asked = rng.sample(range(n), n // 10)
    requests = [(k, c, start, 10, 13) for k, c in enumerate(asked)]
    events = [(c, c, 1, 10, start + timedelta(days=c % 300)) for c in range(n)]
    tables = tables_of(spark, events, STATES, [(c, None) for c in range(n)], [], COURTS)
    frame = table(spark, "pedidos", requests)
    few = exits._few_cases(frame, len(requests), tables.cases)
    assert few.filter is not None
    marked = few.mark(tables.events, "id_expediente", "kept").filter("kept")
    kept = {r.id_expediente for r in marked.collect()}
    assert set(asked) <= kept and len(kept) < 1.05 * n / 10 + 0.04 * n
    result = last_exit_event(frame, tables, END)
    lines = plan_of(result).splitlines()
    at_filter = max(i for i, x in enumerate(lines) if "shiftleft" in x)
    assert "BroadcastHashJoin" in plan_of(result) and at_filter > next(
        i for i, x in enumerate(lines) if "Exchange hashpartitioning(id_expediente" in x
    )
    assert answers_of(result) == {k: (c, STATES[0][1]) for k, c in enumerate(asked)}


@pytest.mark.parametrize("seed, several", [(9, True), (10, False), (14, None)])
def test_filtered_cases_give_the_same_rows(spark, monkeypatch, seed, several):
    monkeypatch.setattr(exits, "PRUNE_RATIO", 0)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", bloom.BLOCK_BYTES)
    requests, *data, ends = random_data(seed, 0.2)
    requests = [r for r in requests if r[1] in (None, 0, 2, 5)] * 8
    requests = [(k, *r[1:]) for k, r in enumerate(requests)]
    if several is False:
        requests = [(*r[:5], ends[1]) for r in requests]
        ends = ends[1]
    frames = as_frames(spark, requests, *data)
    assert exits._few_cases(frames[0], len(requests), frames[1].cases).filter is not None
    expected = by_definition(requests, *data, ("SOB", "ARC"), ("ETO", "SOB"))
    given = None if several is None else ends
    assert resolved(last_exit_event(*frames, given, ("SOB", "ARC"), ("ETO", "SOB"))) == expected


def test_a_filter_knows_its_keys(spark):
    keys = spark.range(0, 50_000, 5).union(spark.createDataFrame([(-1,), (None,), (2**62,)], "id bigint"))
    made = bloom.bloom_filter(keys, 10_003)
    assert made.n_blocks == 4
    asked = spark.range(-10, 50_000).union(spark.createDataFrame([(None,), (2**62,)], "id bigint"))
    marked = bloom.with_bloom(asked, "id", made, "may")
    assert marked.columns == ["id", "may"] and marked.count() == 50_012
    in_keys = marked.join(keys.dropna(), "id", "left_semi")
    assert in_keys.filter("not may").count() == 0 and in_keys.count() == 10_002
    others = marked.join(keys.dropna(), "id", "left_anti").filter("may").count()
    assert others < 0.04 * 40_000
    assert marked.filter("id is null").first().may is False
    assert bloom.bloom_filter(keys, 10**12) is None


def test_many_requests_are_not_broadcast(spark, monkeypatch):
    requests, *data, ends = random_data(11, 0.2)
    frames = as_frames(spark, requests, *data)
    assert "LeftSemi" not in plan_of(last_exit_event(*frames, ends, ("SOB",), ("ETO",)))
    monkeypatch.setattr(exits, "PRUNE_RATIO", 0)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", min(16 * len(requests), bloom.BLOCK_BYTES) - 1)
    assert "LeftSemi" not in plan_of(last_exit_event(*frames, ends, ("SOB",), ("ETO",)))


def test_one_period_end(spark):
    requests, *data, ends = random_data(5, 0.3)
    requests = [(*r[:5], ends[1]) for r in requests]
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), ("ETO",))
    assert resolved(last_exit_event(*frames, ends[1], ("SOB", "ARC"), ("ETO",))) == expected


def test_unknown_period_end_fails(spark):
    requests, *data, ends = random_data(6, 0.0)
    frames = as_frames(spark, requests, *data)
    with pytest.raises(Exception, match="period ends"):
        last_exit_event(*frames, ends[:2], ("SOB", "ARC"), ("ETO",)).collect()


def candidates_by_definition(requests, events, states, cases, changes, courts, end):
    code, court, origin = dict(states), dict(courts), dict(cases)
    exits, childs = ("SOB", "ARC"), ("ETO",)
    branches = (
        [(i, d, code.get(s), c, o, c) for i, c, s, o, d in events if code.get(s) in exits],
        [(i, d, code.get(s), c, o, origin.get(c)) for i, c, s, o, d in events
         if code.get(s) in childs],
        [(i, d, k, c, o, origin.get(c)) for i, c, o, d, k in changes if k in childs],
    )
    asked = [
        (r[1], court[r[3]], r[2]) for r in requests
        if None not in (r[1], r[2], court.get(r[3]))
    ]
    found = []
    for rows in branches:
        found.append(sorted(
            (i, d, k, c, target, court[o]) for i, d, k, c, o, target in rows
            if None not in (d, target, court.get(o)) and any(
                target == case and court[o] == juzgado
                and since <= datetime.combine(d.date(), datetime.min.time()) <= end
                for case, juzgado, since in asked
            )
        ))
    return found


@pytest.mark.parametrize("way", ["broadcast", "shuffled"])
def test_candidate_branches(spark, way, request):
    if way == "shuffled":
        request.getfixturevalue("no_broadcast")
    requests, *data, ends = random_data(7, 0.3)
    asked, tables = as_frames(spark, requests, *data)
    own, child, change = candidates_by_definition(requests, *data, ends[1])
    assert own and child and change

    def rows(df):
        return sorted(tuple(row) for row in df.collect())

    codes = ("SOB", "ARC")
    assert rows(own_case_exits(asked, tables, ends[1], codes)) == own
    assert rows(child_event_exits(asked, tables, ends[1])) == child
    assert rows(child_reassignment_exits(asked, tables, ends[1])) == change
    everything = exit_candidates(asked, tables, ends[1], codes)
    assert rows(everything) == sorted(own + child + change)


def test_latest_per_case_is_one_row_per_key(spark):
    _, *data, ends = random_data(8, 0.3)
    _, tables = as_frames(spark, [], *data)
    rows = latest_per_case(tables, ends, exit_codes=("SOB", "ARC")).collect()
    keys = [(r.idexp, r.juzgado, r.id_expediente, r.fin_periodo) for r in rows]
    assert len(keys) == len(set(keys)) > 0
    assert all(None not in key for key in keys)
    for end in ends:
        alone = latest_per_case(tables, end, exit_codes=("SOB", "ARC")).collect()
        together = [tuple(r)[:3] + tuple(r)[4:] for r in rows if r.fin_periodo == end]
        assert sorted(map(tuple, alone)) == sorted(together)


@pytest.mark.parametrize("ratio", [0, 10**9])
def test_a_case_of_two_origins_counts_for_both(spark, monkeypatch, ratio):
    monkeypatch.setattr(exits, "PRUNE_RATIO", ratio)
    requests = [(1, 1, at("2008-03-01"), 10, 13), (2, 9, at("2008-03-01"), 10, 13),
                (3, 2, at("2008-03-01"), 10, 13)]
    events = [(7, 2, STATE_ID["ETO"], 10, at("2008-06-01")),
              (8, 2, STATE_ID["SOB"], 10, at("2008-05-01"))]
    cases = [(2, 1), (2, 9), (2, 9), (1, None), (9, None)]
    tables = tables_of(spark, events, STATES, cases, [], COURTS)
    asked = table(spark, "pedidos", requests)
    assert answers_of(last_exit_event(asked, tables, END)) == {
        1: (7, "ETO"), 2: (7, "ETO"), 3: (8, "SOB"),
    }
    found = exit_candidates(asked, tables, END).collect()
    assert sorted((r.id_actuacion_exp, r.idexp) for r in found) == [(7, 1), (7, 9), (8, 2)]


@pytest.mark.parametrize("ratio", [0, 10**9])
def test_a_case_among_its_own_origins(spark, monkeypatch, ratio):
    monkeypatch.setattr(exits, "PRUNE_RATIO", ratio)
    requests = [(1, 1, at("2008-03-01"), 10, 13), (2, 2, at("2008-03-01"), 10, 13)]
    events = [(7, 2, STATE_ID["ETO"], 10, at("2008-06-01")),
              (8, 2, STATE_ID["SOB"], 10, at("2008-05-01"))]
    tables = tables_of(spark, events, STATES, [(2, 1), (2, 2), (1, None)], [], COURTS)
    answers = answers_of(last_exit_event(table(spark, "pedidos", requests), tables, END))
    assert answers == {1: (7, "ETO"), 2: (7, "ETO")}


def test_period_end_of_a_request_is_checked_for_a_single_end_too(spark):
    requests, *data, ends = random_data(6, 0.0)
    frames = as_frames(spark, [(*r[:5], ends[0]) for r in requests], *data)
    with pytest.raises(Exception, match="period ends"):
        last_exit_event(*frames, ends[1:2], ("SOB", "ARC"), ("ETO",)).collect()


def test_only_asked_ends_are_answered(spark):
    requests, *data, ends = random_data(12, 0.2)
    many = sorted({*ends, *(ends[0] + timedelta(hours=k) for k in range(1, 90))})
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), ("ETO",))
    result = last_exit_event(*frames, many, ("SOB", "ARC"), ("ETO",))
    assert resolved(result) == expected
    # As many rows as there are steps with rows and asked ends, not cases times ends.
    latest = exits._latest_per_case(
        frames[1], exits.court_lookup(frames[1].courts), many[-1], None, ["SOB", "ARC"], ["ETO"],
        exits._first_ends(spark, many),
    )
    asked = frames[0].select("idexp", F.lit(100).cast("long").alias("juzgado"), F.lit(1).alias(exits.STEP))
    every = latest_per_case(frames[1], many, exit_codes=["SOB", "ARC"], child_codes=["ETO"])
    assert exits._as_of(latest, asked).count() == frames[0].select("idexp").dropna().distinct().count()
    assert 0 < latest.count() < every.count() / 5


# Own bounds


def with_own_ends(requests, seed):
    """Ends of any day and hour, before the request too, and some without."""
    rng = random.Random(seed)
    start = datetime(2007, 12, 30)
    ends = [None, *(start + timedelta(hours=rng.randrange(45 * 24)) for _ in range(300))]
    return [(*r[:5], rng.choice(ends)) for r in requests]


@pytest.mark.parametrize("seed, hot, childs", [(21, 0.0, ("ETO",)), (22, 0.4, ("ETO", "SOB")), (23, 0.2, ("ETO",))])
def test_own_bounds(spark, seed, hot, childs):
    requests, *data, _ = random_data(seed, hot)
    requests = with_own_ends(requests, seed)
    frames = as_frames(spark, requests, *data)
    expected = by_definition(requests, *data, ("SOB", "ARC"), childs)
    assert {a[0] for a in expected.values()} >= {-2, -3} and len(set(expected.values())) > 5
    assert resolved(last_exit_event(*frames, None, ("SOB", "ARC"), childs)) == expected


@pytest.mark.parametrize("hot", [0.4, 0.0])
def test_own_bounds_without_broadcast(spark, no_broadcast, hot):
    requests, *data, _ = random_data(24, hot)
    requests = with_own_ends(requests, 24)
    frames = as_frames(spark, requests, *data)
    result = last_exit_event(*frames, None, ("SOB", "ARC"), ("ETO",))
    assert ("idexp#" in salted_keys(result)) == (hot > 0)
    assert resolved(result) == by_definition(requests, *data, ("SOB", "ARC"), ("ETO",))


def test_own_bounds_of_few_requests_prune_the_other_cases(spark, monkeypatch):
    monkeypatch.setattr(exits, "PRUNE_RATIO", 0)
    requests, *data, _ = random_data(25, 0.2)
    requests = with_own_ends([r for r in requests if r[1] in (None, 0, 2, 5)], 25)
    frames = as_frames(spark, requests, *data)
    result = last_exit_event(*frames, exit_codes=("SOB", "ARC"), child_codes=("ETO",))
    assert "LeftSemi" in plan_of(result)
    assert resolved(result) == by_definition(requests, *data, ("SOB", "ARC"), ("ETO",))


def test_own_bounds_equal_a_given_end(scenarios, spark):
    requests, tables, expected = scenarios
    own = requests.withColumn("fin_periodo", F.lit(END).cast("timestamp_ntz"))
    assert answers_of(last_exit_event(own, tables)) == expected
    with pytest.raises(ValueError, match="fin_periodo"):
        last_exit_event(requests, tables)


def test_own_bounds_of_no_requests(spark, scenarios):
    requests, tables, _ = scenarios
    own = requests.withColumn("fin_periodo", F.col("ta_fecha"))
    assert last_exit_event(own.filter("false"), tables).collect() == []
    unbounded = own.withColumn("fin_periodo", F.lit(None).cast("timestamp_ntz"))
    assert {a for a, _ in answers_of(last_exit_event(unbounded, tables)).values()} == {-2}


def test_three_cases_of_a_day_leave_the_last_of_two_others(spark):
    """A third case of a day is behind two others from then on, also when one of them goes on."""
    cases = [(c, 1) for c in (2, 3, 4)] + [(1, None)]
    events = [
        (20, 2, STATE_ID["ETO"], 10, at("2008-05-01 08:00:00")),
        (30, 3, STATE_ID["ETO"], 10, at("2008-05-01 09:00:00")),
        (40, 4, STATE_ID["ETO"], 10, at("2008-05-01 10:00:00")),
        (41, 4, STATE_ID["ETO"], 10, at("2008-05-03")),
        (42, 4, STATE_ID["ETO"], 10, at("2008-05-04")),
        (31, 3, STATE_ID["ETO"], 10, at("2008-05-06")),
    ]
    asks = [("2008-05-01", "2008-04-30", -2), ("2008-05-01", "2008-05-01", -3),
            ("2008-05-02", "2008-05-05", 42), ("2008-05-02", "2008-05-03", 41),
            ("2008-05-01", "2008-05-05", -3), ("2008-05-04", "2008-05-06", -3),
            ("2008-05-05", "2008-05-31", 31), ("2008-05-02", "2008-05-02", -2)]
    requests = [(k, 1, at(since), 10, 13, at(end)) for k, (since, end, _) in enumerate(asks)]
    frames = as_frames(spark, requests, events, STATES, cases, [], COURTS)
    found = answers_of(last_exit_event(*frames))
    assert {k: found[k][0] for k in found} == {k: a for k, (*_, a) in enumerate(asks)}


def test_the_plan_does_not_grow_with_the_ends(spark):
    requests, *data, ends = random_data(12, 0.2)
    frames = as_frames(spark, requests, *data)
    sizes = []
    for n in (30, 1000):
        many = sorted({*ends, *(ends[0] + timedelta(hours=k) for k in range(n))})
        sizes.append(len(plan_of(last_exit_event(*frames, many, ("SOB", "ARC"), ("ETO",)))))
    assert abs(sizes[1] - sizes[0]) < 0.05 * sizes[0]
    own = plan_of(last_exit_event(*frames, None, ("SOB", "ARC"), ("ETO",)))
    assert "Cartesian" not in own and "NestedLoop" not in own and "Python" not in own
