"""Running the statistic for chambers and periods, and what controls a run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.dates import Moment
from docketflow.operators.joins import fits_broadcast, lookup_join
from docketflow.plans.chambers import ChamberPeriod, period_of, periods_frame, select_chambers
from docketflow.sources.store import RunStore, Staged

log = logging.getLogger(__name__)

DONE, SKIPPED, FAILED = "hecho", "omitido", "error"


class RunOutcome(NamedTuple):
    camara: int
    procedimiento: str
    estado: str
    tiene_anterior: bool | None = None
    mensaje: str | None = None


def has_previous_period(requested: DataFrame, runs: DataFrame) -> DataFrame:
    """Add ``tiene_anterior``: whether a run of the chamber ends the day before ``desde``.

    ``requested`` has ``camara, desde``, ``runs`` has ``camara, hasta``.
    """
    ends = runs.select("camara", F.date_add(F.col("hasta").cast("date"), 1).alias("dia"))
    known = ends.distinct().withColumn("tiene_anterior", F.lit(True))
    days = requested.withColumn("dia", F.col("desde").cast("date"))
    joined = lookup_join(days, known, ["camara", "dia"], "left", small=fits_broadcast(ends))
    return joined.select(
        *requested.columns, F.coalesce("tiene_anterior", F.lit(False)).alias("tiene_anterior")
    )


def pending_periods(requested: DataFrame, done: DataFrame, recalculate: bool = False) -> DataFrame:
    """The ``(camara, desde, hasta)`` still to compute: all of them to recalculate."""
    if recalculate:
        return requested
    keys = ["camara", "desde", "hasta"]
    stored = done.select(*keys)
    joined = lookup_join(
        requested, stored.distinct(), keys, "left_anti", small=fits_broadcast(stored)
    )
    return joined.select(*requested.columns)


def run_chambers(
    spark: SparkSession,
    compute: Callable[[Sequence[ChamberPeriod]], DataFrame],
    store: RunStore | str,
    desde: Moment | None = None,
    hasta: Moment | None = None,
    camaras: Collection[int] | None = None,
    recalculate: bool = False,
    run_id: int | None = None,
) -> list[RunOutcome]:
    """Compute and store the statistic of the chambers asked for.

    ``compute`` returns the statistic of the periods it is given. All chambers
    share one job. Where its rows have a ``problema`` (as those of
    ``chamber_statistics(..., quarantine=True)``), the chambers of these rows fail
    and the others are stored, from that same job. If the job itself fails, each
    chamber runs alone; a plan that cannot be analysed fails them all at once, as
    no chamber could do better. A failure becomes a row of the error log and an
    outcome, and is not raised; a failed chamber keeps its former result. Results
    and errors of a run are published together. Stored periods are skipped unless
    ``recalculate``.

    ``store`` is the folder of the runs. ``run_id`` is the number of the run in
    results and error log; without it the run claims one of its own, unless it has nothing to write.
    """
    store = RunStore(spark, store) if isinstance(store, str) else store
    outcomes: list[RunOutcome] = []
    problems: list[tuple[str, str]] = []

    def fail(chamber, problem: str, before: bool | None) -> None:
        problems.append((problem, chamber.procedimiento))
        outcomes.append(RunOutcome(chamber.camara, chamber.procedimiento, FAILED, before, problem))

    periods = []
    for chamber in select_chambers(camaras):
        try:
            periods.append(period_of(chamber, desde, hasta))
        except ValueError as problem:
            fail(chamber, str(problem), None)
    pending, before = _plan(spark, periods, store.statistics(), recalculate)
    run = run_id
    if run is None and (pending or problems):
        run = store.claim()
    for period in periods:
        if period not in pending:
            outcomes.append(RunOutcome(*period[:2], SKIPPED, before[period.camara]))
    staged: list[Staged] = []

    def compute_and_stage(some: Sequence[ChamberPeriod]) -> None:
        rows = store.stage(compute(some), run)
        staged.append(rows)
        bad = {(p.camara, p.desde, p.hasta): p.problema for p in rows.periods if p.problema}
        for period in some:
            problem = bad.get((period.camara, period.desde, period.hasta))
            if problem is None:
                outcomes.append(RunOutcome(*period[:2], DONE, before[period.camara]))
            else:
                fail(period, problem, before[period.camara])

    if pending:
        try:
            compute_and_stage(pending)
        except Exception as problem:
            if len(pending) == 1 or isinstance(problem, AnalysisException):
                for period in pending:
                    fail(period, str(problem), before[period.camara])
            else:
                log.warning("joint run failed, running each chamber alone: %s", problem)
                for period in pending:
                    try:
                        compute_and_stage([period])
                    except Exception as own_problem:
                        fail(period, str(own_problem), before[period.camara])
    store.commit(staged, problems, run)
    return sorted(outcomes)


def _plan(
    spark: SparkSession, periods: list[ChamberPeriod], stored: DataFrame | None, recalculate: bool
) -> tuple[list[ChamberPeriod], dict[int, bool]]:
    """Periods to compute, and which chambers follow on a stored period."""
    if stored is None or not periods:
        return periods, {period.camara: False for period in periods}
    asked = periods_frame(spark, periods)
    # At most one row per chamber asked for comes back.
    pending = {row["camara"] for row in pending_periods(asked, stored, recalculate).collect()}
    before = {
        row["camara"]: row["tiene_anterior"]
        for row in has_previous_period(asked, stored).collect()
    }
    return [period for period in periods if period.camara in pending], before
