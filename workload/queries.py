"""One registered query per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import docketflow as df
from docketflow.sources.store import shared_folder
from workload import mapping as m


def day_between_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = m.load(spark, sf_dir, "events").select("event_id", "ts")
    return events.filter(df.day_between(F.col("ts"), m.DAY_FROM, m.DAY_TO))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day/month/year text of each event back to its day, and the seconds since then."""
    text = F.date_format("ts", "dd/MM/yyyy")
    return m.load(spark, sf_dir, "events").select(
        "event_id",
        df.parse_dmy(text).alias("dia"),
        df.seconds_between(df.parse_dmy(text), F.col("ts")).alias("segundos"),
    )


def log_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.log_seconds(m.process_log(spark, sf_dir), keep_number=True)


def log_seconds_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and a list of numbers; sorted by the number, which is not returned."""
    numbers = range(m.LOG_FIRST, 2 * m.LOG_LAST, m.LOG_STEP)
    return df.log_seconds(m.process_log(spark, sf_dir), m.LOG_FIRST, m.LOG_LAST, numbers)


def log_seconds_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of all rows of two kinds of event, given as a table as long as the log allows."""
    listed = m.load(spark, sf_dir, "events").filter(F.col("event_type").isin(*m.LISTED_EVENTS))
    numbers = listed.select(m.log_number())
    return df.log_seconds(m.process_log(spark, sf_dir), numbers=numbers, keep_number=True)


def events_with_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = df.with_status_code(
        m.events(spark, sf_dir), m.states(spark), m.EXIT_CODES + m.CHILD_CODES
    )
    return df.with_court(events, "id_oficina", m.courts(spark, sf_dir)).select(
        "id_actuacion_exp", "id_expediente", "fecha_actuacion", "codigo", "juzgado"
    )


def exit_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.own_case_exits(
        m.requests(spark, sf_dir), m.case_tables(spark, sf_dir), m.PERIOD_END, m.EXIT_CODES
    )


def exit_child_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.child_event_exits(
        m.requests(spark, sf_dir), m.case_tables(spark, sf_dir), m.PERIOD_END, m.CHILD_CODES
    )


def exit_child_reassign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.child_reassignment_exits(
        m.requests(spark, sf_dir), m.case_tables(spark, sf_dir), m.PERIOD_END, m.CHILD_CODES
    )


def exit_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.exit_candidates(
        m.requests(spark, sf_dir),
        m.case_tables(spark, sf_dir),
        m.PERIOD_END,
        m.EXIT_CODES,
        m.CHILD_CODES,
    )


def latest_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.latest_per_case(
        m.case_tables(spark, sf_dir),
        m.PERIOD_END,
        exit_codes=m.EXIT_CODES,
        child_codes=m.CHILD_CODES,
    )


def last_exit_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.last_exit_event(
        m.requests(spark, sf_dir),
        m.case_tables(spark, sf_dir),
        m.PERIOD_END,
        m.EXIT_CODES,
        m.CHILD_CODES,
    )


def last_exit_event_one_chamber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of a single chamber: few requests, all other tables whole."""
    asked = m.requests(spark, sf_dir).filter(F.col("camara") == m.ONE_CHAMBER)
    tables = m.case_tables(spark, sf_dir)
    return df.last_exit_event(asked, tables, m.PERIOD_END, m.EXIT_CODES, m.CHILD_CODES)


def exit_own_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with a period end of its own, none of which the plan knows."""
    asked = m.requests(spark, sf_dir).withColumn("fin_periodo", m.own_end())
    tables = m.case_tables(spark, sf_dir)
    return df.last_exit_event(asked, tables, exit_codes=m.EXIT_CODES, child_codes=m.CHILD_CODES)


def chamber_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default ends where a chamber has one, a given end for the other two."""
    start = datetime(1996, 7, 1)
    without_end = [chamber.camara for chamber in df.CHAMBERS if chamber.default_hasta is None]
    with_end = [chamber.camara for chamber in df.CHAMBERS if chamber.default_hasta is not None]
    periods = df.chamber_periods(start, camaras=with_end) + df.chamber_periods(
        start, m.PERIOD_END, without_end
    )
    return df.requests_per_period(m.requests(spark, sf_dir), periods)


def chamber_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.chamber_statistics(
        m.requests(spark, sf_dir),
        m.case_tables(spark, sf_dir),
        m.PERIODS,
        m.EXIT_CODES,
        m.CHILD_CODES,
    )


def chamber_statistics_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chamber, every month of the orders; each month is a period of its own."""
    return df.chamber_statistics(
        m.requests(spark, sf_dir),
        m.case_tables(spark, sf_dir),
        m.monthly_periods(),
        m.EXIT_CODES,
        m.CHILD_CODES,
    )


def keep_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = m.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return df.keep_since(orders, "o_orderdate", m.KEEP_FROM)


def drop_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = (
        m.load(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("o_orderkey"))
    )
    orders = m.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return df.drop_matching(orders, returned, ["o_orderkey"])


def keep_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    building = (
        m.load(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    orders = m.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return df.keep_matching(orders, building, ["o_custkey"])


def has_previous_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = m.chamber_months(m.load(spark, sf_dir, "orders"))
    return df.has_previous_period(asked, m.run_registry(spark, sf_dir))


def pending_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = m.chamber_months(m.load(spark, sf_dir, "orders"))
    return df.pending_periods(asked, m.run_registry(spark, sf_dir))


def error_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all chambers without an end date: two have no default and fail."""
    requests = m.requests(spark, sf_dir)
    store = df.RunStore(spark, shared_folder(spark, "runs"))
    df.run_chambers(
        spark,
        lambda periods: df.requests_per_period(requests, periods),
        store,
        desde=datetime(1995, 1, 1),
    )
    stored = store.statistics().select("procedimiento", "n")
    failed = store.errors().select(
        F.col("nombre_proceso").alias("procedimiento"), "m_error"
    )
    return stored.join(failed, "procedimiento", "full")


def stored_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistic stored by three runs: first, repeated, and repeated to recalculate.

    ``ejecucion`` is the number of the run whose rows stay: the second computes
    nothing and leaves no number, the third, over the first chambers only,
    replaces theirs.
    """
    requests, tables = m.requests(spark, sf_dir), m.case_tables(spark, sf_dir)
    store = df.RunStore(spark, shared_folder(spark, "runs"))
    start, end = m.PERIODS[0].desde, m.PERIODS[0].hasta

    def compute(periods):
        return df.chamber_statistics(requests, tables, periods, m.EXIT_CODES, m.CHILD_CODES)

    chambers = range(13, 28)
    for camaras, again in ((chambers, False), (chambers, False), (chambers[: m.REPEATED], True)):
        df.run_chambers(spark, compute, store, start, end, camaras, again)
    return store.statistics().select(
        "camara", "desde", "hasta", "juzgado", "resultado", "codigo_salida", "n",
        F.col("run_id").alias("ejecucion"),
    )


def quarantined_chambers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which two offices have two courts each: their chambers fail, the others are stored.

    One office is that of some requests of a chamber, the other that of events of
    another chamber's cases.
    """
    requests, tables = m.requests_at_doubtful_office(spark, sf_dir), m.doubtful_tables(spark, sf_dir)
    store = df.RunStore(spark, shared_folder(spark, "runs"))
    start, end = m.PERIODS[0].desde, m.PERIODS[0].hasta

    def compute(periods):
        return df.chamber_statistics(
            requests, tables, periods, m.EXIT_CODES, m.CHILD_CODES, quarantine=True
        )

    df.run_chambers(spark, compute, store, start, end, range(13, 28))
    names = {c.procedimiento: c.camara for c in df.CHAMBERS}
    camara = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    failed = store.errors().select(
        camara[F.col("nombre_proceso")].alias("camara"), F.col("m_error")
    )
    stored = store.statistics().select(
        "camara", "juzgado", "resultado", "codigo_salida", "n", F.lit(None).cast("string").alias("m_error")
    )
    return stored.unionByName(failed, allowMissingColumns=True)


def incremental_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with an end of its own, after two batches of events that make up the whole."""
    asked = m.requests(spark, sf_dir).withColumn("fin_periodo", m.own_end())
    tables = m.case_tables(spark, sf_dir)
    ledger = df.ExitLedger(spark, shared_folder(spark, "ledger"), m.EXIT_CODES, m.CHILD_CODES)
    later = F.col("id_actuacion_exp") % 3 == 0
    links = tables.cases.filter("id_expediente_origen is not null")
    first = tables._replace(events=tables.events.filter(~later), cases=links)
    ledger.update(asked, tables, first._replace(reassignments=tables.reassignments.limit(0)))
    ledger.update(asked, tables, tables._replace(events=tables.events.filter(later), cases=links.limit(0)))
    return ledger.answers().drop("juzgado")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        day_between_events,
        order_days,
        log_seconds,
        log_seconds_selected,
        log_seconds_listed,
        events_with_court,
        exit_own,
        exit_child_event,
        exit_child_reassign,
        exit_candidates,
        latest_per_case,
        last_exit_event,
        last_exit_event_one_chamber,
        exit_own_bound,
        chamber_periods,
        chamber_statistics,
        chamber_statistics_monthly,
        keep_since,
        drop_matching,
        keep_matching,
        has_previous_period,
        pending_periods,
        error_log_append,
        stored_statistics,
        quarantined_chambers,
        incremental_exits,
    )
}
