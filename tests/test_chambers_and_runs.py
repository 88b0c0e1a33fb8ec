import collections
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from conftest import at, plan_of, table, tables_of
from pyspark.sql import functions as F
from test_exits import as_frames, by_definition, random_data

from docketflow import (
    CHAMBERS,
    ChamberPeriod,
    RunStore,
    append_error,
    chamber_periods,
    chamber_statistics,
    has_previous_period,
    pending_periods,
    periods_frame,
    read_case_tables,
    read_errors,
    read_statistics,
    requests_per_period,
    run_chambers,
    save_statistics,
)
from docketflow.operators import exits
from docketflow.plans import chambers
from docketflow.plans.runs import DONE, FAILED, SKIPPED
from docketflow.sources import store as stores
from docketflow.sources.store import shared_folder

STARTS, ENDS = at("2008-01-01"), at("2008-12-31")


@pytest.fixture(params=["broadcast", "shuffled"])
def way(request):
    if request.param == "shuffled":
        request.getfixturevalue("no_broadcast")


def test_eighteen_chambers():
    numbers = [chamber.camara for chamber in CHAMBERS]
    assert len(set(numbers)) == 18
    assert set(numbers) == {6, 8, 9, *range(13, 28)}


def test_defaults_and_given_bounds():
    (bahia,) = chamber_periods(camaras=[13])
    assert bahia == (13, "calcular_estadistica_bahia", STARTS, ENDS)
    (federal,) = chamber_periods(hasta=at("2009-01-31"), camaras=[8])
    assert federal[2:] == (STARTS, at("2009-01-31"))
    with pytest.raises(ValueError, match="hasta is required"):
        chamber_periods(camaras=[15])
    with pytest.raises(ValueError, match="unknown chambers"):
        chamber_periods(camaras=[7])


@pytest.fixture(scope="module")
def small(spark):
    """Chamber 13 has a resolved, an open and a doubtful request, 14 a late exit."""
    requests = table(spark, "pedidos", [
        (1, 1, at("2008-03-01"), 10, 13),
        (2, 2, at("2008-03-01"), 10, 13),
        (3, 3, at("2008-12-31 18:00:00"), 99, 13),
        (4, 4, at("2008-03-01"), 20, 14),
        (5, 5, at("2007-12-31"), 10, 13),
        (6, 6, at("2008-03-01"), 10, None),
    ])
    events = [
        (11, 1, 1, 10, at("2008-04-01")),
        (12, 2, 1, 10, at("2008-04-01")),
        (13, 21, 2, 10, at("2008-05-01")),
        (14, 4, 1, 20, at("2008-10-01")),
    ]
    tables = tables_of(
        spark, events, [(1, "SOB"), (2, "ETO")], [(c, None) for c in range(1, 7)] + [(21, 2)],
        [], [(10, 100), (20, 200)],
    )
    return requests, tables


def test_statistics_of_several_chambers(small):
    requests, tables = small
    periods = chamber_periods(camaras=[13, 16]) + chamber_periods(
        hasta=at("2008-06-30"), camaras=[14]
    )
    rows = chamber_statistics(requests, tables, periods).collect()
    assert sorted(map(repr, rows)) == sorted(
        f"Row(camara={camara}, desde={STARTS!r}, hasta={hasta!r}, juzgado={juzgado},"
        f" resultado={resultado!r}, codigo_salida={codigo!r}, n={n})"
        for camara, hasta, juzgado, resultado, codigo, n in [
            (13, ENDS, 100, "salida", "SOB", 1),
            (13, ENDS, 100, "varias", None, 1),
            (13, ENDS, None, "sin_salida", None, 1),
            (14, at("2008-06-30"), 200, "sin_salida", None, 1),
            (16, ENDS, None, None, None, 0),
        ]
    )


def test_requests_per_period(small):
    requests, _ = small
    rows = requests_per_period(requests, chamber_periods(camaras=[13, 14, 16])).collect()
    assert {row.camara: row.n for row in rows} == {13: 3, 14: 1, 16: 0}


def in_periods_by_definition(requests, periods):
    midnight = lambda moment: datetime.combine(moment.date(), datetime.min.time())
    return sorted(
        (r[0], p.camara, p.desde, p.hasta) for r in requests for p in periods
        if r[4] == p.camara and p.desde <= midnight(r[2]) <= p.hasta
    )


@pytest.mark.parametrize("most", [200_000, 50])
def test_requests_in_overlapping_periods(spark, monkeypatch, most):
    monkeypatch.setattr(chambers, "MAX_BUCKETS", most)
    rng = random.Random(most)
    start = at("2008-01-01")
    asked = [
        (k, k, start + timedelta(hours=rng.randrange(-100, 2400)), 10, rng.choice([13, 14, 15, None]))
        for k in range(300)
    ]
    periods = []
    for _ in range(60):
        first = start + timedelta(hours=rng.choice([24 * rng.randrange(90), rng.randrange(2000)]))
        periods.append(ChamberPeriod(rng.choice([13, 14]), "p", first, first + timedelta(hours=rng.randrange(-48, 700))))
    found = chambers.requests_in_periods(table(spark, "pedidos", asked), periods)
    rows = sorted((r.request_id, r.camara, r.desde, r.hasta) for r in found.collect())
    assert rows == in_periods_by_definition(asked, periods) and len(rows) > 100


def test_a_thousand_periods(spark, small):
    """Daily and overlapping periods of a chamber: no expression for each, results as one by one."""
    requests, tables = small
    days = [STARTS + timedelta(days=k) for k in range(360)]
    periods = [ChamberPeriod(13, "p", day, day + timedelta(days=n)) for day in days for n in (0, 6, 364)]
    periods = periods[:1000]
    result = chamber_statistics(requests, tables, periods)
    short = chamber_statistics(requests, tables, periods[:30])
    assert abs(len(plan_of(result)) - len(plan_of(short))) < 0.05 * len(plan_of(short))
    found = {(r.desde, r.hasta, r.juzgado, r.resultado): r.n for r in result.collect()}
    assert {key[:2] for key in found} == {p[2:] for p in periods}
    # One period alone says the same.
    for k in (0, 2, 181, 272, 999):
        alone = chamber_statistics(requests, tables, periods[k : k + 1]).collect()
        assert {(r.desde, r.hasta, r.juzgado, r.resultado): r.n for r in alone} == {
            key: n for key, n in found.items() if key[:2] == periods[k][2:]
        }


def test_has_previous_period(spark, way):
    runs = spark.createDataFrame(
        [(13, at("2008-06-30")), (13, at("2008-06-30")), (13, at("2007-06-30"))],
        "camara int, hasta timestamp_ntz",
    )
    asked = spark.createDataFrame(
        [(13, at("2008-07-01")), (14, at("2008-07-01")), (13, at("2008-07-02"))],
        "camara int, desde timestamp_ntz",
    )
    rows = has_previous_period(asked, runs).collect()
    assert {(r.camara, r.desde.day): r.tiene_anterior for r in rows} == {
        (13, 1): True, (14, 1): False, (13, 2): False,
    }
    assert len(rows) == 3


def test_pending_periods(spark, way):
    asked = periods_frame(spark, chamber_periods(camaras=[13, 14]))
    done = periods_frame(spark, chamber_periods(camaras=[13]))
    left = pending_periods(asked, done)
    assert left.columns == asked.columns
    assert [row.camara for row in left.collect()] == [14]
    assert pending_periods(asked, done, recalculate=True).count() == 2


def test_statistics_are_stored_replaced_and_skipped(spark, small):
    requests, tables = small
    folder = shared_folder(spark, "runs")

    def run(source, **options):
        return run_chambers(
            spark, lambda periods: chamber_statistics(source, tables, periods), folder,
            camaras=[13, 14], **options,
        )

    def stored():
        rows = read_statistics(spark, folder).groupBy("camara", "desde").agg(
            F.sum("n").alias("n"), F.max("run_id").alias("run_id")
        )
        return {(row.camara, row.desde.year): (row.n, row.run_id) for row in rows.collect()}

    assert [o.estado for o in run(requests)] == [DONE, DONE]
    assert stored() == {(13, 2008): (3, 1), (14, 2008): (1, 1)}
    assert [o.estado for o in run(requests)] == [SKIPPED, SKIPPED]
    # Without requests the former rows are replaced by a zero, not left behind.
    assert [o.estado for o in run(requests.filter("camara = 13"), recalculate=True)] == [DONE, DONE]
    assert stored() == {(13, 2008): (3, 2), (14, 2008): (0, 2)}
    following = run(requests, desde=at("2009-01-01"), hasta=at("2009-12-31"))
    assert [(o.estado, o.tiene_anterior) for o in following] == [(DONE, True), (DONE, True)]
    assert stored()[13, 2008] == (3, 2) and stored()[13, 2009] == (0, 3)
    assert read_errors(spark, folder).count() == 0


def test_one_failing_chamber_does_not_stop_the_others(spark, small):
    requests, _ = small
    folder = shared_folder(spark, "runs")
    bad = F.when(F.col("camara") == 14, F.raise_error(F.lit("no data for 14"))).otherwise(F.col("n"))
    outcomes = run_chambers(
        spark, lambda periods: requests_per_period(requests, periods).withColumn("n", bad),
        folder, camaras=[8, 13, 14],
    )
    assert [(o.camara, o.estado) for o in outcomes] == [(8, FAILED), (13, DONE), (14, FAILED)]
    logged = {row.nombre_proceso: row for row in read_errors(spark, folder).collect()}
    assert set(logged) == {"calcular_estadistica_federal", "calcular_estadistica_comodoro"}
    assert "no data for 14" in logged["calcular_estadistica_comodoro"].m_error
    assert all(row["at"] is not None for row in logged.values())
    assert [row.camara for row in read_statistics(spark, folder).collect()] == [13]


def test_a_run_after_one_that_failed_altogether(spark, small):
    requests, _ = small
    folder = shared_folder(spark, "runs")

    def run(n):
        return run_chambers(
            spark, lambda periods: requests_per_period(requests, periods).withColumn("n", n),
            folder, camaras=[13, 14],
        )

    assert [o.estado for o in run(F.raise_error(F.lit("x")).cast("bigint"))] == [FAILED, FAILED]
    assert read_errors(spark, folder).count() == 2
    assert [o.estado for o in run(F.col("n"))] == [DONE, DONE]
    assert read_statistics(spark, folder).count() == 2


def test_periods_a_fraction_of_a_second_apart_both_stay(spark):
    path = shared_folder(spark, "results")
    for fraction in (100_000, 900_000):
        end = at("2008-06-30 10:00:00").replace(microsecond=fraction)
        row = spark.createDataFrame(
            [(13, at("2008-01-01"), end, fraction)],
            "camara int, desde timestamp_ntz, hasta timestamp_ntz, n int",
        )
        save_statistics(row, path, 1)
    assert sorted(row.n for row in read_statistics(spark, path).collect()) == [100_000, 900_000]


def test_folder_without_checkpoint_dir_is_in_the_warehouse():
    settings = {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )
    assert shared_folder(session, "x").startswith("hdfs://x/warehouse/x-")


def test_a_plan_that_cannot_be_analysed_fails_once(spark, small):
    requests, _ = small
    folder = shared_folder(spark, "runs")
    calls = []

    def compute(periods):
        calls.append(len(periods))
        return requests_per_period(requests, periods).select("no_such_column")

    outcomes = run_chambers(spark, compute, folder, camaras=[8, 13, 14], run_id=7)
    assert [o.estado for o in outcomes] == [FAILED] * 3 and calls == [2]
    logged = read_errors(spark, folder)
    assert {row.run_id for row in logged.collect()} == {7} and logged.count() == 3
    assert len(stores.Folder(spark, f"{folder}/commits").numbers()) == 1


def test_a_failed_run_has_a_number_of_its_own(spark, small):
    requests, _ = small
    folder = shared_folder(spark, "runs")

    def run(n):
        run_chambers(
            spark, lambda periods: requests_per_period(requests, periods).withColumn("n", n),
            folder, camaras=[13, 14],
        )

    run(F.raise_error(F.lit("x")).cast("bigint"))
    run(F.col("n"))
    assert {row.run_id for row in read_errors(spark, folder).collect()} == {1}
    assert {row.run_id for row in read_statistics(spark, folder).collect()} == {2}


def test_two_threads_get_different_numbers(spark):
    folder = shared_folder(spark, "runs")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: RunStore(spark, folder).claim(), range(40)))
    assert sorted(numbers) == list(range(1, 41))


def test_commits_of_several_threads_are_all_published(spark):
    folder = shared_folder(spark, "runs")

    def add(k):
        append_error(spark, folder, f"problem {k}", "p", k)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(8)))
    assert sorted(r.run_id for r in read_errors(spark, folder).collect()) == list(range(8))


def test_a_number_is_created_whole_and_once(spark):
    folder = stores.Folder(spark, shared_folder(spark, "numbers"))
    assert folder.numbers() == []
    assert folder.create(3, "first") and not folder.create(3, "second")
    assert folder.numbers() == [3] and folder.add(str) == 4
    lines = spark.read.text(folder.path).collect()
    assert sorted(r.value for r in lines) == ["4", "first"]


def test_a_file_system_that_is_not_local_renames(spark):
    folder = stores.Folder(spark, shared_folder(spark, "numbers"))
    folder._local = False
    assert folder.create(3, "first") and not folder.create(3, "second") and folder.add(str) == 4
    assert sorted(r.value for r in spark.read.text(folder.path).collect()) == ["4", "first"]


def counted(stats):
    rows = stats.groupBy("camara").agg(F.sum("n").alias("n"), F.max("run_id").alias("run_id"))
    return {r.camara: (r.n, r.run_id) for r in rows.collect()}


def test_a_run_that_stops_before_its_commit_leaves_the_former_result(spark, small):
    requests, tables = small
    store = RunStore(spark, shared_folder(spark, "runs"))
    periods = chamber_periods(camaras=[13, 14])
    first = chamber_statistics(requests, tables, periods)
    store.commit([store.stage(first, 1)])
    before = store.statistics()
    more = chamber_statistics(requests.union(requests), tables, periods)
    staged = store.stage(more, 2)  # and the run is gone
    assert counted(store.statistics()) == {13: (3, 1), 14: (1, 1)}
    # A reader that began before the commit keeps its result, a later one sees all of the commit.
    store.commit([staged], [("late", "p")], 2)
    assert counted(before) == {13: (3, 1), 14: (1, 1)}
    assert counted(store.statistics()) == {13: (6, 2), 14: (2, 2)}
    assert [(r.m_error, r.run_id) for r in store.errors().collect()] == [("late", 2)]


def test_a_write_that_fails_half_way_leaves_the_former_result(spark, small):
    requests, tables = small
    store = RunStore(spark, shared_folder(spark, "runs"))
    periods = chamber_periods(camaras=[13, 14])
    stats = chamber_statistics(requests, tables, periods)
    store.commit([store.stage(stats, 1)])
    broken = F.when(F.col("camara") == 14, F.raise_error(F.lit("broken"))).otherwise(F.col("n"))
    with pytest.raises(Exception, match="broken"):
        store.stage(stats.withColumn("n", broken.cast("bigint")), 2)
    assert counted(store.statistics()) == {13: (3, 1), 14: (1, 1)}
    assert store.errors().count() == 0


def folders(spark, path):
    at_ = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at_.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(at_)} if fs.exists(at_) else set()


def test_vacuum_leaves_what_is_published(spark, small):
    requests, tables = small
    store = RunStore(spark, shared_folder(spark, "runs"))
    assert store.vacuum(datetime.now()) == 0
    both, one = chamber_periods(camaras=[13, 14]), chamber_periods(camaras=[14])
    store.commit([store.stage(chamber_statistics(requests, tables, both), 1)])
    store.commit([store.stage(chamber_statistics(requests, tables, one), 2)], [("e", "p")], 2)
    store.stage(chamber_statistics(requests, tables, both), 3)  # and the run is gone
    store.commit([store.stage(chamber_statistics(requests, tables, one), 4)])
    before = counted(store.statistics())
    assert before == {13: (3, 1), 14: (1, 4)}
    # Nothing is old enough yet; then runs 2 and 3 go, run 1 still has a period.
    assert store.vacuum(datetime.now() - timedelta(hours=1)) == 0
    assert store.vacuum(datetime.now() + timedelta(seconds=5)) == 2
    kept = {name.split("-")[1] for name in folders(spark, f"{store.path}/data") if "run" in name}
    assert kept == {"1", "4"} and counted(store.statistics()) == before
    assert [r.m_error for r in store.errors().collect()] == ["e"]


def test_nothing_to_publish_is_no_commit(spark):
    store = RunStore(spark, shared_folder(spark, "runs"))
    assert store.commit() is None and store.statistics() is None and store.errors().count() == 0


def doubtful_by_definition(requests, events, states, cases, changes, courts):
    """Requests at an office of several courts, or with a possible exit at one."""
    known = collections.defaultdict(set)
    for office, court in courts:
        known[office].add(court)
    bad = {office for office, found in known.items() if len(found) > 1}
    code, origin = dict(states), dict(cases)
    rows = [(d, c, o) for _, c, s, o, d in events if code.get(s) in ("SOB", "ARC")]
    rows += [(d, origin.get(c), o) for _, c, s, o, d in events if code.get(s) == "ETO"]
    rows += [(d, origin.get(c), o) for _, c, o, d, k in changes if k == "ETO"]
    found = set()
    for request_id, idexp, since, office, _, end in requests:
        near = any(
            o in bad and target is not None and target == idexp and None not in (d, since)
            and since <= datetime.combine(d.date(), datetime.min.time()) <= end
            for d, target, o in rows
        )
        if office in bad or near:
            found.add(request_id)
    return found


@pytest.mark.parametrize("way_, several", [("broadcast", True), ("broadcast", False), ("shuffled", True)])
def test_offices_of_several_courts_are_quarantined(spark, request, way_, several):
    if way_ == "shuffled":
        request.getfixturevalue("no_broadcast")
    requests, *data, ends = random_data(31, 0.1)
    if not several:
        requests, ends = [(*r[:5], ends[1]) for r in requests], ends[1:2]
    *most, courts = data
    doubled = courts + [(3, 100), (3, 200), (7, None), (7, 300), (11, 200), (11, 200)]
    asked, tables = as_frames(spark, requests, *most, doubled)
    for given in (ends, None):
        rows = exits.resolve_exits(asked, tables, given, ("SOB", "ARC"), ("ETO",), quarantine=True).collect()
        bad = doubtful_by_definition(requests, *most, doubled)
        assert {r.request_id for r in rows if r.problema is not None} == bad
        assert 0 < len(bad) < len(requests) == len(rows)
        assert {r.problema for r in rows} <= {None, *(f"more than one juzgado for id_oficina {o}" for o in range(12))}
        # The others are as if these offices did not exist.
        single = [(o, j) for o, j in doubled if len({b for a, b in doubled if a == o}) == 1]
        expected = by_definition(requests, *most, single, ("SOB", "ARC"), ("ETO",))
        assert {r.request_id: (r.id_act, r.fecha_salida, r.codigo_salida) for r in rows if r.problema is None} == {
            k: answer for k, answer in expected.items() if k not in bad
        }


def test_one_bad_office_fails_its_chamber_in_one_job(spark, small):
    requests, tables = small
    doubled = tables._replace(courts=tables.courts.union(tables.courts.limit(1).withColumn("juzgado", F.lit(300).cast("long"))))
    bad_office = tables.courts.limit(1).first().id_oficina
    store, calls = RunStore(spark, shared_folder(spark, "runs")), []

    def compute(periods):
        calls.append([p.camara for p in periods])
        return chamber_statistics(requests, doubled, periods, quarantine=True)

    outcomes = run_chambers(spark, compute, store, camaras=[13, 14, 16])
    failed = 13 if bad_office == 10 else 14
    assert calls == [[13, 14, 16]]
    assert {o.camara: o.estado for o in outcomes} == {
        k: FAILED if k == failed else DONE for k in (13, 14, 16)
    }
    (error,) = store.errors().collect()
    assert error.m_error == f"more than one juzgado for id_oficina {bad_office}" and error.run_id == 1
    assert set(counted(store.statistics())) == {13, 14, 16} - {failed}
    assert "problema" not in store.statistics().columns
    # Mended, the failed chamber alone is computed again.
    again = run_chambers(
        spark, lambda periods: chamber_statistics(requests, tables, periods, quarantine=True), store,
        camaras=[13, 14, 16],
    )
    assert [o.estado for o in again].count(DONE) == 1 and set(counted(store.statistics())) == {13, 14, 16}


def test_error_log_is_appended(spark):
    path = shared_folder(spark, "errors")
    append_error(spark, path, "first", "p")
    append_error(spark, path, "second", "p")
    assert sorted(row.m_error for row in read_errors(spark, path).collect()) == ["first", "second"]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base) and one != two


def test_tables_are_read_with_their_schema(spark, small, tmp_path):
    _, tables = small
    names = ["actuacion_exp", "estado_expediente", "expediente", "cambio_asignacion_exp",
             "juzgado_oficina"]
    for name, df in zip(names, tables):
        df.write.parquet(str(tmp_path / name))
    back = read_case_tables(spark, str(tmp_path))
    for written, read in zip(tables, back):
        assert read.schema.simpleString() == written.schema.simpleString()
        assert read.exceptAll(written).isEmpty() and written.exceptAll(read).isEmpty()
