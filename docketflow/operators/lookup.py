"""Office-to-court and status lookups."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.operators.joins import HotKeys, fits_broadcast, lookup_join, unique_lookup


class Lookup(NamedTuple):
    """A checked key-value table and whether it may be broadcast."""

    rows: DataFrame
    small: bool


def status_lookup(states: DataFrame, codes: Iterable[str]) -> Lookup:
    """``(id_estado_expediente, codigo)`` of the statuses with one of ``codes``."""
    wanted = states.filter(F.col("codigo_estado_expediente").isin(list(codes))).select(
        "id_estado_expediente", F.col("codigo_estado_expediente").alias("codigo")
    )
    return Lookup(unique_lookup(wanted, "id_estado_expediente", "codigo"), fits_broadcast(wanted))


def court_lookup(courts: DataFrame) -> Lookup:
    """Prepare ``courts(id_oficina, juzgado)`` for several :func:`with_court` calls."""
    pairs = courts.select("id_oficina", "juzgado")
    return Lookup(unique_lookup(pairs, "id_oficina", "juzgado"), fits_broadcast(pairs))


def quarantined_courts(courts: DataFrame) -> tuple[Lookup, Lookup | None]:
    """The offices of one court, and those of several as ``(id_oficina, problema)`` if there are any.

    An office of several courts is in neither row by row: as with an unknown office,
    its court is NULL.
    """
    pairs = courts.select("id_oficina", "juzgado")
    small = fits_broadcast(pairs)
    checked = unique_lookup(pairs, "id_oficina", "juzgado", quarantine=True)
    bad = checked.filter("problema is not null").select("id_oficina", "problema")
    return Lookup(checked.drop("problema"), small), None if bad.isEmpty() else Lookup(bad, small)


def with_court(
    df: DataFrame, office_col: str, courts: DataFrame | Lookup, how: str = "left",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``juzgado``, the court of the office in ``office_col``.

    An office that is unknown, or known without a court: NULL with ``how="left"``,
    no row with ``how="inner"``. ``hot`` are the busy offices, if they are known.
    """
    lookup = courts if isinstance(courts, Lookup) else court_lookup(courts)
    dim = lookup.rows.withColumnRenamed("id_oficina", office_col)
    if how == "inner":
        dim = dim.filter(F.col("juzgado").isNotNull())
    joined = lookup_join(df, dim, [office_col], how, small=lookup.small, hot=hot)
    return joined.select(*df.columns, "juzgado")


def with_status_code(
    events: DataFrame, states: DataFrame | Lookup, codes: Iterable[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Keep the events whose status has one of ``codes``, and add it as ``codigo``."""
    lookup = states if isinstance(states, Lookup) else status_lookup(states, codes)
    joined = lookup_join(
        events, lookup.rows, ["id_estado_expediente"], "inner", small=lookup.small, hot=hot
    )
    return joined.select(*events.columns, "codigo")
