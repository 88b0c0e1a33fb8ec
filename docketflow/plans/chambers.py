"""The chambers, their default periods and the statistic over them."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.codes import CHILD_CODES, EXIT_CODES, NO_EXIT, SEVERAL_EXITS
from docketflow.functions.dates import Moment, as_datetime, day_between
from docketflow.operators.exits import resolve_exits
from docketflow.sources.tables import CaseTables, parameter_table

# Rows of the index of periods by day, which is broadcast: about 10 MB.
MAX_BUCKETS = 200_000
BUCKET = "__dias"


class Chamber(NamedTuple):
    camara: int
    procedimiento: str
    default_desde: datetime
    default_hasta: datetime | None  # None: the caller must name the end


class ChamberPeriod(NamedTuple):
    camara: int
    procedimiento: str
    desde: datetime
    hasta: datetime


# Default period.
START_2008 = datetime(2008, 1, 1)
END_2008 = datetime(2008, 12, 31)

# Number, procedure and default period of each chamber.
CHAMBERS = (
    Chamber(6, "calcular_estadistica_p_econ", START_2008, END_2008),
    Chamber(8, "calcular_estadistica_federal", START_2008, None),
    Chamber(9, "calcular_estadistica_instr", START_2008, END_2008),
    Chamber(13, "calcular_estadistica_bahia", START_2008, END_2008),
    Chamber(14, "calcular_estadistica_comodoro", START_2008, END_2008),
    Chamber(15, "calcular_estadistica_cordoba", START_2008, None),
    Chamber(16, "calcular_estadistica_ctes", START_2008, END_2008),
    Chamber(17, "calcular_estadistica_g_roca", START_2008, END_2008),
    Chamber(18, "calcular_estadistica_la_plata", START_2008, END_2008),
    Chamber(19, "calcular_estadistica_mardel", START_2008, END_2008),
    Chamber(20, "calcular_estadistica_mendoza", START_2008, END_2008),
    Chamber(21, "calcular_estadistica_posadas", START_2008, END_2008),
    Chamber(22, "calcular_estadistica_parana", START_2008, END_2008),
    Chamber(23, "calcular_estadistica_resist", START_2008, END_2008),
    Chamber(24, "calcular_estadistica_salta", START_2008, END_2008),
    Chamber(25, "calcular_estadistica_rosario", START_2008, END_2008),
    Chamber(26, "calcular_estadistica_s_martin", START_2008, END_2008),
    Chamber(27, "calcular_estadistica_tucuman", START_2008, END_2008),
)


def select_chambers(camaras: Collection[int] | None = None) -> list[Chamber]:
    """The chambers with these numbers, all of them by default."""
    if camaras is None:
        return list(CHAMBERS)
    unknown = set(camaras) - {chamber.camara for chamber in CHAMBERS}
    if unknown:
        raise ValueError(f"unknown chambers {sorted(unknown)}")
    return [chamber for chamber in CHAMBERS if chamber.camara in camaras]


def period_of(
    chamber: Chamber, desde: Moment | None = None, hasta: Moment | None = None
) -> ChamberPeriod:
    """The period asked for, with the chamber's defaults for what is not given."""
    start = chamber.default_desde if desde is None else as_datetime(desde)
    end = chamber.default_hasta if hasta is None else as_datetime(hasta)
    if end is None:
        raise ValueError(f"{chamber.procedimiento}: hasta is required")
    return ChamberPeriod(chamber.camara, chamber.procedimiento, start, end)


def chamber_periods(
    desde: Moment | None = None,
    hasta: Moment | None = None,
    camaras: Collection[int] | None = None,
) -> list[ChamberPeriod]:
    return [period_of(chamber, desde, hasta) for chamber in select_chambers(camaras)]


def periods_frame(spark: SparkSession, periods: Iterable[ChamberPeriod]) -> DataFrame:
    """The periods as a table; its size is that of the parameter list."""
    columns = {
        "camara": "int",
        "procedimiento": "string",
        "desde": "timestamp_ntz",
        "hasta": "timestamp_ntz",
    }
    return parameter_table(spark, periods, columns)


def requests_in_periods(requests: DataFrame, periods: Sequence[ChamberPeriod]) -> DataFrame:
    """Requests whose date lies in the period of their chamber, with that period.

    ``requests`` has ``camara`` and ``ta_fecha``. Periods may overlap. The chambers and the outermost
    bounds are literals besides, so that they reach the scan and its partitions.
    """
    if not periods:
        raise ValueError("no period given")
    fecha = F.col("ta_fecha")
    first, last = min(p.desde for p in periods), max(p.hasta for p in periods)
    table, width = _by_bucket(requests.sparkSession, periods)
    return (
        requests.filter(
            day_between(fecha, first, last) & F.col("camara").isin(sorted({p.camara for p in periods}))
        )
        .withColumn(BUCKET, _bucket(fecha, width))
        .join(F.broadcast(table), ["camara", BUCKET])
        .filter(day_between(fecha, F.col("desde"), F.col("hasta")))
        .select(*requests.columns, "desde", "hasta")
    )


def _bucket(moment: Column, width: int) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(width)).cast("int")


def _by_bucket(spark: SparkSession, periods: Sequence[ChamberPeriod]) -> tuple[DataFrame, int]:
    """The periods once for each bucket of days they touch, and the width of a bucket in days.

    A request meets the periods of its bucket only. Buckets are single days unless
    the periods together have more than MAX_BUCKETS of them.
    """
    days = sum(max(0, (p.hasta.date() - p.desde.date()).days) + 1 for p in periods)
    width = -(-days // MAX_BUCKETS)
    bounds = F.sequence(_bucket(F.col("desde"), width), _bucket(F.col("hasta"), width))
    table = periods_frame(spark, periods).drop("procedimiento").filter("desde < hasta + interval 1 day")
    return table.withColumn(BUCKET, F.explode(bounds)), width


def requests_per_period(requests: DataFrame, periods: Sequence[ChamberPeriod]) -> DataFrame:
    """How many requests each chamber has in its period; 0 where there are none."""
    counted = (
        requests_in_periods(requests, periods)
        .groupBy("camara", "desde", "hasta")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        periods_frame(requests.sparkSession, periods)
        .join(counted, ["camara", "desde", "hasta"], "left")
        .select("camara", "procedimiento", "desde", "hasta", F.coalesce("n", F.lit(0)).alias("n"))
    )


def chamber_statistics(
    requests: DataFrame,
    tables: CaseTables,
    periods: Sequence[ChamberPeriod],
    exit_codes: Iterable[str] = EXIT_CODES,
    child_codes: Iterable[str] = CHILD_CODES,
    quarantine: bool = False,
) -> DataFrame:
    """Requests per chamber, court and outcome, all chambers in one job.

    ``resultado`` is ``salida``, ``sin_salida`` or ``varias``. A chamber without
    requests in its period has one row with ``n = 0``, so that every period
    asked for appears in the result. With ``quarantine`` an office of several
    courts does not fail the job: the requests it concerns are counted in a row
    ``error`` of their period, with the text in ``problema``.
    """
    asked = requests_in_periods(requests, periods).withColumn("fin_periodo", F.col("hasta"))
    ends = [period.hasta for period in periods]
    outcome = (
        F.when(F.col("id_act") == NO_EXIT, "sin_salida")
        .when(F.col("id_act") == SEVERAL_EXITS, "varias")
        .otherwise("salida")
    )
    resolved = resolve_exits(asked, tables, ends, exit_codes, child_codes, quarantine)
    court, code, more = F.col("juzgado"), F.col("codigo_salida"), []
    if quarantine:
        fine = F.col("problema").isNull()
        court, code = F.when(fine, court), F.when(fine, code)
        outcome = F.when(~fine, "error").otherwise(outcome)
        more = ["problema"]
    counted = (
        resolved.groupBy(
            "camara", "desde", "hasta", court.alias("juzgado"), outcome.alias("resultado"),
            code.alias("codigo_salida"),
        )
        .agg(F.count(F.lit(1)).alias("n"), *(F.min(name).alias(name) for name in more))
    )
    every_period = periods_frame(requests.sparkSession, periods).drop("procedimiento")
    return every_period.join(counted, ["camara", "desde", "hasta"], "left").select(
        "camara",
        "desde",
        "hasta",
        "juzgado",
        "resultado",
        "codigo_salida",
        F.coalesce("n", F.lit(0)).alias("n"),
        *more,
    )
