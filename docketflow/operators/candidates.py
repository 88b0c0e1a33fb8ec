"""Rows that can be the exit of a case: the three branches and their union.

A branch yields each row once, however many requests ask for it, as
``(id_actuacion_exp, fecha_actuacion, codigo, id_expediente, idexp, juzgado)``:
``id_expediente`` is the case the row belongs to, ``idexp`` the case asked about.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.functions.codes import CHILD_CODES, EXIT_CODES
from docketflow.functions.dates import Moment, from_day, until_day
from docketflow.operators.joins import (
    HotKeys,
    fits_broadcast,
    hot_keys,
    hot_keys_of,
    lookup_join,
)
from docketflow.operators.lookup import (
    Lookup,
    court_lookup,
    status_lookup,
    with_court,
    with_status_code,
)
from docketflow.sources.tables import CaseTables

SHAPE = ("id_actuacion_exp", "fecha_actuacion", "codigo", "id_expediente", "id_oficina")


def own_case_exits(
    requests: DataFrame, tables: CaseTables, period_end: Moment,
    codes: Iterable[str] = EXIT_CODES,
) -> DataFrame:
    """Events of the requested case itself."""
    return _candidates(requests, tables, period_end, codes, (), reassigned=False)


def child_event_exits(
    requests: DataFrame, tables: CaseTables, period_end: Moment,
    codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """Events of the cases that originate from the requested one (one level)."""
    return _candidates(requests, tables, period_end, (), codes, reassigned=False)


def child_reassignment_exits(
    requests: DataFrame, tables: CaseTables, period_end: Moment,
    codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """Reassignments of the cases that originate from the requested one."""
    return _candidates(requests, tables, period_end, (), codes, events=False)


def exit_candidates(
    requests: DataFrame, tables: CaseTables, period_end: Moment,
    exit_codes: Iterable[str] = EXIT_CODES, child_codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """All three branches; columns match by position and duplicates stay."""
    return _candidates(requests, tables, period_end, exit_codes, child_codes)


def _candidates(
    requests: DataFrame, tables: CaseTables, period_end: Moment,
    exit_codes: Iterable[str], child_codes: Iterable[str],
    events: bool = True, reassigned: bool = True,
) -> DataFrame:
    """Each source is read once, for its own case and for the origins together."""
    exit_codes, child_codes = list(exit_codes), list(child_codes)
    courts = court_lookup(tables.courts)
    small_cases = not child_codes or fits_broadcast(
        tables.cases.select("id_expediente", "id_expediente_origen")
    )
    small_requests = fits_broadcast(requests.select("idexp", "ta_oficina", "ta_fecha"))
    parts = []
    if events:
        rows = tables.events.filter(until_day(F.col("fecha_actuacion"), period_end))
        states = status_lookup(tables.states, sorted({*exit_codes, *child_codes}))
        by_state, by_case, by_office = _measured(
            rows,
            [states.small, small_cases and small_requests, courts.small],
            ["id_estado_expediente", "id_expediente", "id_oficina"],
        )
        named = with_status_code(rows, states, hot=by_state).select(*SHAPE)
        own, child = F.col("codigo").isin(exit_codes), F.col("codigo").isin(child_codes)
        parts.append((named, own, child, by_case, by_office))
    if reassigned:
        rows = tables.reassignments.filter(
            until_day(F.col("fecha_asignacion"), period_end)
            & F.col("codigo_tipo_cambio_asignacion").isin(child_codes)
        ).select(
            F.col("id_cambio_asignacion_exp").alias("id_actuacion_exp"),
            F.col("fecha_asignacion").alias("fecha_actuacion"),
            F.col("codigo_tipo_cambio_asignacion").alias("codigo"),
            "id_expediente",
            "id_oficina",
        )
        by_case, by_office = _measured(
            rows, [small_cases and small_requests, courts.small], ["id_expediente", "id_oficina"]
        )
        parts.append((rows, F.lit(False), F.lit(True), by_case, by_office))
    lookup = origins(tables.cases) if child_codes else None
    # A case is busy by its own rows, or by those of the cases derived from it.
    busy, found = HotKeys(), None
    if child_codes and not small_requests:
        busy = hot_keys(tables.cases.filter("id_expediente_origen is not null"), ["id_expediente_origen"])
    for rows, own, child, by_case, by_office in parts:
        at_court = with_court(rows, "id_oficina", courts, "inner", hot=by_office)
        for_case = _for_cases(at_court, own, child, lookup, small_cases, by_case)
        found = for_case if found is None else found.union(for_case)
        busy = busy | by_case
    return _asked_for(found, requests, courts, small_requests, busy)


def _measured(rows: DataFrame, small: list[bool], keys: list[str]) -> list[HotKeys]:
    """Hot keys of the lookups that are too large to broadcast, in one pass if there is any."""
    if all(small):
        return [HotKeys()] * len(keys)
    return hot_keys_of(rows, [[key] for key in keys])


def origins(cases: DataFrame) -> DataFrame:
    """``(id_expediente, id_expediente_origen, primero, propio_origen)`` of the derived cases.

    A case may have several origins; each is a row, and ``primero`` marks one of
    them. ``propio_origen`` tells that the case is among its own origins.
    """
    pairs = (
        cases.select("id_expediente", "id_expediente_origen")
        .filter(F.col("id_expediente").isNotNull() & F.col("id_expediente_origen").isNotNull())
        .distinct()
    )
    origin = F.col("id_expediente_origen")
    of_case = Window.partitionBy("id_expediente")
    return pairs.select(
        "*",
        (F.row_number().over(of_case.orderBy(origin)) == 1).alias("primero"),
        F.max(origin == F.col("id_expediente")).over(of_case).alias("propio_origen"),
    )


def _for_cases(
    rows: DataFrame, own: Column, child: Column, origin_rows: DataFrame | None, small: bool,
    hot: HotKeys,
) -> DataFrame:
    """A row of the case itself, and one for each of its origins, named in ``idexp``."""
    if origin_rows is None:
        return rows.filter(own).withColumn("idexp", F.col("id_expediente"))
    joined = lookup_join(rows, origin_rows, ["id_expediente"], "left", small=small, hot=hot)
    once = own & F.coalesce("primero", F.lit(True))
    targets = F.array_compact(
        F.array(
            F.when(once, F.struct(F.col("id_expediente").alias("idexp"))),
            F.when(
                child & F.col("id_expediente_origen").isNotNull(),
                F.struct(F.col("id_expediente_origen").alias("idexp")),
            ),
        )
    )
    return joined.select(*rows.columns, F.explode(targets).alias("rol")).select(
        *rows.columns, "rol.idexp"
    )


def _asked_for(
    rows: DataFrame, requests: DataFrame, courts: Lookup, small: bool, busy: HotKeys
) -> DataFrame:
    """Keep the rows within the period of at least one request of their case and court.

    The earliest request decides that, so the requests of one key shrink to
    one row before they meet the candidates.
    """
    asked = (
        with_court(requests, "ta_oficina", courts, "inner")
        .groupBy("idexp", "juzgado")
        .agg(F.min("ta_fecha").alias("primera_fecha"))
    )
    joined = lookup_join(
        rows, asked, ["idexp", "juzgado"], "inner", small=small, hot=busy, hot_on=["idexp"]
    )
    return joined.filter(from_day(F.col("fecha_actuacion"), F.col("primera_fecha"))).select(
        *SHAPE[:4], "idexp", "juzgado"
    )
