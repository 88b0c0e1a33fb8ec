"""The last exit event of each request, for all requests at once.

A request asks for the latest qualifying row per case and answers only when a
single case has one. For a fixed period end the latest row of a case does not
depend on the request: it qualifies if its day is not before the request's
date, and if it does not, no earlier row does either. So the rows are reduced
to one per case and court first, then to the two latest cases per requested
case and court, and each request meets at most one row. Nothing grows with
requests times events.

Where requests have different period ends, time is an axis of steps: the given
ends, or single days where each request brings an end of its own. Rows are
reduced to one per case, court and step, then to the two latest cases of a step,
and an as-of merge runs along the axis: rows and asked ends of a case and court
in one order, carrying the latest row so far and the latest of another case. A
case with a third of all rows is spread over its steps before, and afterwards
has two rows a step at most. No plan holds an expression for each end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketflow.functions.codes import CHILD_CODES, EXIT_CODES, NO_EXIT, SEVERAL_EXITS
from docketflow.functions.dates import (
    Moment,
    as_datetime,
    from_day,
    timestamp_literal,
    until_day,
)
from docketflow.operators.candidates import origins
from docketflow.operators import joins
from docketflow.operators.bloom import BloomFilter, bloom_filter, with_bloom
from docketflow.operators.joins import (
    HotKeys,
    hot_key_sketch,
    hot_keys,
    hot_keys_from,
    lookup_join,
    spread_join,
)
from docketflow.operators.lookup import (
    Lookup,
    court_lookup,
    quarantined_courts,
    with_court,
    with_status_code,
)
from docketflow.sources.tables import CaseTables, parameter_table

# Prune by the requested cases when there are at least so many times as many cases.
PRUNE_RATIO = 2
# With fewer links than this no case is taken to have very many derived from it.
HOT_MIN_LINKS = 100_000
# Column of the place on the time axis.
STEP = "__paso"
FIRST_DAY = date(1, 1, 1)


def last_exit_event(
    requests: DataFrame,
    tables: CaseTables,
    period_end: Moment | Sequence[Moment] | None = None,
    exit_codes: Iterable[str] = EXIT_CODES,
    child_codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """One row per request: ``request_id, id_act, fecha_salida, codigo_salida``.

    ``id_act`` is the id of the exit, -2 when there is none and -3 when more
    than one case has one; date and code are NULL for both. With several period
    ends ``requests`` must say in ``fin_periodo`` which of them applies. Without
    any, ``fin_periodo`` is each request's own bound, of whatever value: it counts
    to the end of its day, and a request without it has no exit.
    """
    return resolve_exits(requests, tables, period_end, exit_codes, child_codes).select(
        "request_id", "id_act", "fecha_salida", "codigo_salida"
    )


def resolve_exits(
    requests: DataFrame,
    tables: CaseTables,
    period_end: Moment | Sequence[Moment] | None = None,
    exit_codes: Iterable[str] = EXIT_CODES,
    child_codes: Iterable[str] = CHILD_CODES,
    quarantine: bool = False,
) -> DataFrame:
    """:func:`last_exit_event` with all columns of ``requests`` and their ``juzgado``.

    An office of several courts fails the query. With ``quarantine`` it does not:
    ``problema`` says of each request whether its own office, or that of a row that
    could be its exit, has several courts; its other columns are then of no use.
    """
    if period_end is None and "fin_periodo" not in requests.columns:
        raise ValueError("neither a period end nor fin_periodo is given")
    ends = None if period_end is None else _period_ends(period_end)
    if quarantine:
        courts, bad_offices = quarantined_courts(tables.courts)
    else:
        courts, bad_offices = court_lookup(tables.courts), None
    profile = _profile(requests, own_ends=ends is None)
    keys = ["idexp", "juzgado"]
    asked = with_court(requests, "ta_oficina", courts)
    # Without any request there is no end, and no row is before the first day.
    last, steps = (profile.latest or FIRST_DAY, _days) if ends is None else (ends[-1], None)
    if ends is None:
        asked = asked.withColumn(STEP, _day(F.col("fin_periodo")))
    elif len(ends) > 1:
        asked, steps = _with_step(asked, ends), _first_ends(requests.sparkSession, ends)
    elif "fin_periodo" in requests.columns:
        # A filter, as a column that nothing uses would not be computed.
        asked = asked.filter(_known(F.col("fin_periodo") == timestamp_literal(ends[0])))
    few = _few_cases(requests, profile.count, tables.cases)
    bounds = (last, profile.earliest, exit_codes, child_codes, steps, few)
    latest = _latest_per_case(tables, courts, *bounds)
    if steps is None:
        best = _two_latest(latest)
    else:
        keys.append(STEP)
        best = _as_of(latest, asked.select(*keys))
    joined = spread_join(asked, best, keys, "left", profile.hot, hot_on=["idexp"])
    problem = F.lit(None).cast("string")
    if bad_offices is not None:
        joined = _with_problems(joined, tables, bad_offices, bounds, profile.hot)
        seen = from_day(F.col("dudoso.fecha_actuacion"), F.col("ta_fecha"))
        problem = F.coalesce("problema", F.when(seen, F.col("dudoso.codigo")))
    more = [problem.alias("problema")] if quarantine else []
    return joined.select(*requests.columns, "juzgado", *_outcome(), *more)


def _outcome() -> list[Column]:
    """Id, date and code of the exit, from the state at a request's end and its date."""
    since = F.col("ta_fecha")
    several = F.coalesce(from_day(F.col("segunda_fecha"), since), F.lit(False))
    single = from_day(F.col("ultimo.fecha_actuacion"), since) & ~several
    return [
        F.when(several, F.lit(SEVERAL_EXITS))
        .when(single, F.col("ultimo.id_actuacion_exp"))
        .otherwise(F.lit(NO_EXIT))
        .alias("id_act"),
        F.when(single, F.col("ultimo.fecha_actuacion")).alias("fecha_salida"),
        F.when(single, F.col("ultimo.codigo")).alias("codigo_salida"),
    ]


def case_state(
    tables: CaseTables,
    exit_codes: Iterable[str] = EXIT_CODES,
    child_codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """The latest rows per case, court and day: what any request is answered from.

    States of parts of the events are merged by :func:`merged_state` into that of all.
    """
    courts = court_lookup(tables.courts)
    return _latest_by_case(tables, courts, None, None, exit_codes, child_codes, _days)


def merged_state(states: DataFrame) -> DataFrame:
    """One row per case, court and day out of several states; merging one twice changes nothing."""
    # A state has one row of a key, so nothing merges before the shuffle; by case alone, the
    # join to the origins of a case needs no further one.
    return _latest(states.repartition("id_expediente"), ["id_expediente", "juzgado", STEP])


def exits_from_state(
    requests: DataFrame, state: DataFrame, cases: DataFrame, courts: DataFrame
) -> DataFrame:
    """:func:`resolve_exits` of requests with a ``fin_periodo`` of their own, from a merged state."""
    keys = ["idexp", "juzgado", STEP]
    hot = _profile(requests, own_ends=True).hot
    asked = with_court(requests, "ta_oficina", courts)
    asked = asked.withColumn(STEP, _day(F.col("fin_periodo")))
    latest = _per_target(state, cases)
    # Only cases derived from one case can make its rows of a step many.
    derived = cases.filter("id_expediente_origen is not null")
    least = min(joins.HOT_MIN_ROWS, HOT_MIN_LINKS)
    few_of_step = not hot_keys(derived, ["id_expediente_origen"], least).hashes
    if not hot.hashes:
        # No case is asked for by more requests than one task takes: they go along with its rows.
        found = _as_of(latest, asked, requests.columns, few_of_step)
        return found.select(*requests.columns, "juzgado", *_outcome())
    best = _as_of(latest, asked.select(*keys), few_of_step=few_of_step)
    joined = spread_join(asked, best, keys, "left", hot, hot_on=["idexp"])
    return joined.select(*requests.columns, "juzgado", *_outcome())


def _with_problems(
    asked: DataFrame, tables: CaseTables, bad_offices: Lookup, bounds: tuple, hot: HotKeys
) -> DataFrame:
    """The requests with ``problema`` of their own office, and ``dudoso``, the latest row of their
    case at an office of several courts, with the problem as its ``codigo``.

    Read only if there is such an office. The rows of these offices take the same
    way as all others, each office as a court of its own.
    """
    own = bad_offices.rows.withColumnRenamed("id_oficina", "ta_oficina")
    asked = lookup_join(asked, own, ["ta_oficina"], "left", small=bad_offices.small)
    text = bad_offices.rows.select(F.col("id_oficina").alias("juzgado"), "problema")
    offices = bad_offices.rows.select("id_oficina", F.col("id_oficina").alias("juzgado"))
    rows = _latest_per_case(tables, Lookup(offices, bad_offices.small), *bounds)
    named = lookup_join(rows, text, ["juzgado"], "inner", small=bad_offices.small)
    together = named.withColumn("ultimo", F.col("ultimo").withField("codigo", F.col("problema")))
    together = together.withColumn("juzgado", F.lit(0).cast("bigint"))
    if STEP in rows.columns:
        keys = ["idexp", STEP]
        points = asked.select("idexp", F.lit(0).cast("bigint").alias("juzgado"), STEP)
        latest = _as_of(together, points)
    else:
        keys, latest = ["idexp"], _two_latest(together)
    found = latest.select(*keys, F.col("ultimo").alias("dudoso"))
    return spread_join(asked, found, keys, "left", hot, hot_on=["idexp"])


def latest_per_case(
    tables: CaseTables,
    period_end: Moment | Sequence[Moment],
    since: Moment | None = None,
    exit_codes: Iterable[str] = EXIT_CODES,
    child_codes: Iterable[str] = CHILD_CODES,
) -> DataFrame:
    """The latest row up to the period end per ``(idexp, juzgado, id_expediente)``.

    Equal dates are decided by the higher id, then the higher code. With several
    period ends there is one row for each of them, named in ``fin_periodo``.
    """
    courts, ends = court_lookup(tables.courts), _period_ends(period_end)
    spark = tables.events.sparkSession
    steps = _first_ends(spark, ends) if len(ends) > 1 else None
    rows = _latest_per_case(tables, courts, ends[-1], since, exit_codes, child_codes, steps)
    if steps is not None:
        rows = _at_every_end(rows, spark, ends)
    kept = [name for name in rows.columns if name != "ultimo"]
    return rows.select(*kept, "ultimo.id_actuacion_exp", "ultimo.fecha_actuacion", "ultimo.codigo")


def _period_ends(period_end: Moment | Sequence[Moment]) -> list[datetime]:
    moments = period_end if isinstance(period_end, Sequence) else [period_end]
    ends = sorted({as_datetime(moment) for moment in moments})
    if not ends:
        raise ValueError("no period end given")
    return ends


class _Profile(NamedTuple):
    """What one pass over the requests tells."""

    count: int
    earliest: datetime | None  # date asked from
    latest: datetime | None  # own period end
    hot: HotKeys  # the cases asked for most


def _profile(requests: DataFrame, own_ends: bool) -> _Profile:
    latest = F.max("fin_periodo") if own_ends else F.lit(None)
    row = requests.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ta_fecha").alias("earliest"),
        latest.alias("latest"),
        hot_key_sketch(requests.sparkSession, ["idexp"]).alias("top"),
    ).first()
    hot = hot_keys_from(requests.sparkSession, row["top"], row["n"])
    return _Profile(row["n"], row["earliest"], row["latest"], hot)


def _known(is_end: Column) -> Column:
    problem = F.raise_error(F.lit("fin_periodo is not among the given period ends"))
    return F.when(is_end, F.lit(True)).otherwise(problem.cast("boolean"))


# Steps of the time axis


def _day(moment: Column) -> Column:
    return F.unix_date(moment.cast("date"))


def _days(moves: DataFrame) -> DataFrame:
    """Each row at the step of its own day."""
    return moves.withColumn(STEP, _day(_moment_of_move()))


def _moment_of_move() -> Column:
    return F.coalesce("propio.fecha_actuacion", "derivado.fecha_actuacion")


def _ends_table(spark: SparkSession, ends: Sequence[datetime]) -> DataFrame:
    """``(fin_periodo, STEP)``: the ends numbered in order."""
    rows = [(end, k) for k, end in enumerate(ends)]
    return F.broadcast(parameter_table(spark, rows, {"fin_periodo": "timestamp_ntz", STEP: "int"}))


def _with_step(asked: DataFrame, ends: Sequence[datetime]) -> DataFrame:
    """The requests with the step of their ``fin_periodo``; fails where it is not an end."""
    joined = asked.join(_ends_table(asked.sparkSession, ends), "fin_periodo", "left")
    return joined.filter(_known(F.col(STEP).isNotNull())).select(*asked.columns, STEP)


def _first_ends(
    spark: SparkSession, ends: Sequence[datetime]
) -> Callable[[DataFrame], DataFrame]:
    """Puts each row at the first end that includes it, by an index of the days between the ends.

    The index has a row for each day from the first end to the last, so it grows
    with the years and not with the number of ends.
    """
    epoch = date(1970, 1, 1)
    days = [(end.date() - epoch).days for end in ends]
    spans = [
        (k, before + 1, day) for k, (before, day) in enumerate(zip([days[0] - 1, *days], days))
        if day > before
    ]
    table = parameter_table(spark, spans, {STEP: "int", "desde": "int", "hasta": "int"})
    index = F.broadcast(table.select(STEP, F.explode(F.sequence("desde", "hasta")).alias("dia")))

    def steps(moves: DataFrame) -> DataFrame:
        day = F.greatest(_day(_moment_of_move()), F.lit(days[0]))
        return moves.withColumn("dia", day).join(index, "dia").select(*moves.columns, STEP)

    return steps


class _Asked(NamedTuple):
    """The requested cases, if they are a minor part: as keys, or as a filter where they are many."""

    keys: DataFrame | None
    filter: BloomFilter | None = None

    def mark(self, df: DataFrame, case: str, flag: str) -> DataFrame:
        """``df`` with whether a case is, or with the filter may be, among the requested ones."""
        if self.filter is not None:
            return with_bloom(df, case, self.filter, flag)
        # Joined by an expression, so that all joins share one broadcast.
        few = F.broadcast(self.keys)
        joined = df.join(few, df[case] == few["idexp"], "left")
        return joined.select(*(df[x] for x in df.columns), few["idexp"].isNotNull().alias(flag))

    def keep(self, df: DataFrame, case: str) -> DataFrame:
        """The rows of requested cases."""
        if self.filter is not None:
            return with_bloom(df, case, self.filter, "__pedido").filter("__pedido").drop("__pedido")
        few = F.broadcast(self.keys)
        return df.join(few, df[case] == few["idexp"], "left_semi")


def _few_cases(requests: DataFrame, count: int, cases: DataFrame) -> _Asked | None:
    """The requested cases, if they are a minor part of all.

    Typical for the run of a single chamber. Rows of other cases then need not be
    shuffled: the cases are broadcast if they are small enough, and a Bloom filter
    of them beyond that. Where the requests are most of the cases, None: every case
    is resolved.
    """
    if cases.count() < PRUNE_RATIO * count:
        return None
    asked = requests.filter("idexp is not null").select("idexp")
    if 16 * count <= joins.BROADCAST_BYTES:
        return _Asked(asked.distinct())
    found = bloom_filter(asked, count)
    return None if found is None else _Asked(None, found)


def _latest_per_case(
    tables: CaseTables,
    courts: Lookup,
    last: Moment | None,
    since: Moment | None,
    exit_codes: Iterable[str],
    child_codes: Iterable[str],
    steps: Callable[[DataFrame], DataFrame] | None = None,
    asked_cases: _Asked | None = None,
) -> DataFrame:
    """The latest row per requested case, court and case, with ``steps`` for each step of time."""
    state = _latest_by_case(tables, courts, last, since, exit_codes, child_codes, steps, asked_cases)
    return _per_target(state, tables.cases, asked_cases)


def _latest_by_case(
    tables: CaseTables,
    courts: Lookup,
    last: Moment | None,
    since: Moment | None,
    exit_codes: Iterable[str],
    child_codes: Iterable[str],
    steps: Callable[[DataFrame], DataFrame] | None = None,
    asked_cases: _Asked | None = None,
) -> DataFrame:
    """The latest rows per case and court, with ``steps`` for each step: mergeable by maximum."""
    moves = _moves(tables, last, since, list(exit_codes), list(child_codes))
    step = []
    if steps is not None:
        moves, step = steps(moves), [STEP]
    if asked_cases is not None:
        moves = asked_cases.mark(moves, "id_expediente", "__pedido")
        moves = moves.filter("derivado is not null or __pedido").drop("__pedido")
    if not courts.small:
        # The offices must be shuffled: collapse copies and busy offices first.
        moves = _latest(moves, ["id_expediente", "id_oficina", *step])
    at_court = with_court(moves, "id_oficina", courts, "inner")
    return _latest(at_court, ["id_expediente", "juzgado", *step])


def _per_target(
    latest: DataFrame, cases: DataFrame, asked_cases: _Asked | None = None
) -> DataFrame:
    """The latest rows of cases turned to the cases they count for."""
    step = [STEP] if STEP in latest.columns else []
    if asked_cases is not None:
        cases = asked_cases.keep(cases, "id_expediente_origen")
    # At most one row per case, court and step is left on this side, so no case is hot.
    by_case = latest.join(origins(cases), "id_expediente", "left")
    case, origin = F.col("id_expediente"), F.col("id_expediente_origen")
    # A row counts once for its own case, and once for each case it originates from.
    once = F.coalesce("primero", F.lit(True))
    as_own = F.when(
        once, F.when(F.col("propio_origen"), F.greatest("propio", "derivado")).otherwise(F.col("propio"))
    )
    as_child = F.when(origin.isNotNull() & (origin != case), F.col("derivado"))
    roles = F.array(
        F.struct(case.alias("idexp"), as_own.alias("ultimo")),
        F.struct(origin.alias("idexp"), as_child.alias("ultimo")),
    )
    by_target = (
        by_case.select("id_expediente", "juzgado", *step, F.explode(roles).alias("rol"))
        .filter(F.col("rol.ultimo").isNotNull())
        .select("rol.idexp", "juzgado", "id_expediente", *step, "rol.ultimo")
    )
    if asked_cases is not None:
        by_target = asked_cases.keep(by_target, "idexp")
    return by_target


def _moves(
    tables: CaseTables,
    last: Moment | None,
    since: Moment | None,
    exit_codes: list[str],
    child_codes: list[str],
) -> DataFrame:
    """Events and reassignments in the period, each source read once.

    ``propio`` holds the row if it counts for its own case, ``derivado`` if it
    counts for the case it originates from.
    """

    def in_period(df: DataFrame, moment: Column) -> DataFrame:
        until = F.lit(True) if last is None else until_day(moment, last)
        kept = df.filter(F.col("id_expediente").isNotNull() & moment.isNotNull() & until)
        return kept if since is None else kept.filter(from_day(moment, since))

    fecha = F.col("fecha_actuacion")
    events = with_status_code(
        in_period(tables.events, fecha), tables.states, sorted({*exit_codes, *child_codes})
    )
    event = F.struct(fecha, F.col("id_actuacion_exp"), F.col("codigo"))
    asignacion = F.col("fecha_asignacion")
    code = F.col("codigo_tipo_cambio_asignacion")
    reassignments = in_period(tables.reassignments, asignacion).filter(code.isin(child_codes))
    reassignment = F.struct(
        asignacion.alias("fecha_actuacion"),
        F.col("id_cambio_asignacion_exp").alias("id_actuacion_exp"),
        code.alias("codigo"),
    )
    return events.select(
        "id_expediente",
        "id_oficina",
        F.when(F.col("codigo").isin(exit_codes), event).alias("propio"),
        F.when(F.col("codigo").isin(child_codes), event).alias("derivado"),
    ).union(
        reassignments.select(
            "id_expediente", "id_oficina", F.when(F.lit(False), reassignment), reassignment
        )
    )


def _latest(moves: DataFrame, keys: list[str]) -> DataFrame:
    # max of a struct merges on the map side: a busy case leaves one row per task.
    return moves.groupBy(*keys).agg(
        F.max("propio").alias("propio"), F.max("derivado").alias("derivado")
    )


def _at_every_end(rows: DataFrame, spark: SparkSession, ends: Sequence[datetime]) -> DataFrame:
    """The row that holds at each end, from the rows that are the latest of their step.

    A case of one requested case and court has at most one row per end.
    """
    in_order = Window.partitionBy("idexp", "juzgado", "id_expediente").orderBy(STEP)
    following = F.lead(STEP, 1, len(ends)).over(in_order)
    held = rows.withColumn("siguiente", following)
    every = F.explode(F.sequence(F.col(STEP), F.col("siguiente") - 1)).alias(STEP)
    columns = [name for name in rows.columns if name != STEP]
    expanded = held.select(*columns, every)
    return expanded.join(_ends_table(spark, ends), STEP).select(*columns, "fin_periodo")


def _as_of(
    latest: DataFrame, asked: DataFrame, columns: Sequence[str] | None = None,
    few_of_step: bool = False,
) -> DataFrame:
    """The state of each asked ``(idexp, juzgado, STEP)``: latest row, and date of another case's.

    With ``columns``, that of each row of ``asked`` with these and its court, also
    where a key is null and there is no state.

    Two cases of a step suffice: a third is behind both of them from then on. In
    the order of time, the latest row of another case is the one before the
    present run of rows of one case. Where ``few_of_step`` says that no case has very
    many of a step, all of them stay: to leave out the others takes a shuffle.
    """
    keys = ["idexp", "juzgado", STEP]
    event = F.struct("ultimo.*", F.col("id_expediente").alias("caso"))
    rows = latest if few_of_step else _numbered(latest, keys).filter(F.col("numero_fila") <= 2)
    rows = rows.select(*keys, F.lit(False).alias("pedido"), event.alias("evento"))
    nothing = F.lit(None).cast(rows.schema["evento"].dataType).alias("evento")
    known, fila = asked.dropna(subset=keys), []
    if columns is None:
        known = known.distinct()
    else:
        whole = F.struct(*columns).alias("fila")
        fila = [whole]
        rows = rows.withColumn("fila", F.lit(None).cast(asked.select(whole).schema["fila"].dataType))
    known = known.select(*keys, F.lit(True).alias("pedido"), nothing, *fila)
    in_order = Window.partitionBy("idexp", "juzgado").orderBy(STEP, "pedido", "evento")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    other = F.col("previo.caso") != F.col("evento.caso")
    found = (
        rows.unionByName(known)
        .withColumn("previo", F.last("evento", ignorenulls=True).over(before))
        .withColumn("otro", F.when(other, F.col("previo.fecha_actuacion")))
        .withColumn("ultimo", F.last("evento", ignorenulls=True).over(so_far))
        .withColumn("segunda_fecha", F.last("otro", ignorenulls=True).over(so_far))
        .filter("pedido")
    )
    if columns is None:
        return found.select(*keys, "ultimo", "segunda_fecha")
    found = found.select("fila.*", "juzgado", "ultimo", "segunda_fecha")
    never = asked.filter(F.greatest(*(F.col(key).isNull() for key in keys)))
    return found.unionByName(never.select(*columns, "juzgado"), allowMissingColumns=True)


def _two_latest(latest: DataFrame) -> DataFrame:
    """Per requested case and court: the latest row, and the date of the next case's.

    Two cases suffice to tell none, one and several apart. The rank limit also
    works before the shuffle, so a case with a great many derived cases
    leaves two rows per task.
    """
    keys = ["idexp", "juzgado"]
    rank = F.col("numero_fila")
    return (
        _numbered(latest, keys)
        .filter(rank <= 2)
        .groupBy(*keys)
        .agg(
            F.max(F.when(rank == 1, F.col("ultimo"))).alias("ultimo"),
            F.max(F.when(rank == 2, F.col("ultimo.fecha_actuacion"))).alias("segunda_fecha"),
        )
    )


def _numbered(latest: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(
        F.desc("ultimo.fecha_actuacion"), F.desc("ultimo.id_actuacion_exp"), F.desc("ultimo.codigo")
    )
    return latest.withColumn("numero_fila", F.row_number().over(order))
