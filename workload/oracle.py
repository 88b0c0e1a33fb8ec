"""The registered queries as SQL, written row by row rather than reduced first."""

from __future__ import annotations

from docketflow import CHAMBERS, chamber_periods
from workload import mapping as m


def _ts(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def _codes(codes) -> str:
    return "(" + ", ".join(f"'{code}'" for code in codes) + ")"


_END = _ts(m.PERIOD_END)

_TABLES = f"""
WITH courts AS (
  SELECT s_suppkey AS id_oficina, CAST(n_regionkey AS BIGINT) AS juzgado
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
states(id_estado, codigo) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in m.STATES)}),
moves AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS caso, l_suppkey AS oficina,
         l_shipdate AS fecha, codigo
  FROM lineitem JOIN states
    ON id_estado = ascii(l_returnflag) * 100 + ascii(l_linestatus)),
derived AS (
  SELECT o_orderkey AS caso, o_orderkey // 4 AS origen FROM orders WHERE o_orderkey % 4 = 1),
changes AS (
  SELECT o_orderkey AS id, o_orderkey AS caso, o_custkey % 100 AS oficina,
         o_orderdate AS fecha, o_orderpriority AS codigo
  FROM orders),
own_rows AS (
  SELECT id, fecha, codigo, caso, oficina, caso AS idexp FROM moves
  WHERE codigo IN {_codes(m.EXIT_CODES)}),
event_rows AS (
  SELECT v.id, v.fecha, v.codigo, v.caso, v.oficina, d.origen AS idexp
  FROM moves v JOIN derived d ON v.caso = d.caso
  WHERE v.codigo IN {_codes(m.CHILD_CODES)}),
change_rows AS (
  SELECT c.id, c.fecha, c.codigo, c.caso, c.oficina, d.origen AS idexp
  FROM changes c JOIN derived d ON c.caso = d.caso
  WHERE c.codigo IN {_codes(m.CHILD_CODES)}),
all_rows AS (
  SELECT * FROM own_rows UNION ALL SELECT * FROM event_rows UNION ALL SELECT * FROM change_rows),
asked AS (
  SELECT o_orderkey AS request_id, o_orderkey AS idexp, o_orderdate AS ta_fecha, juzgado,
         CAST(o_orderkey % 15 + 13 AS INTEGER) AS camara
  FROM orders LEFT JOIN courts ON id_oficina = o_custkey % 100)
"""

_ROW = (
    "r.id AS id_actuacion_exp, r.fecha AS fecha_actuacion, r.codigo,"
    " r.caso AS id_expediente, r.idexp, c.juzgado"
)


def _branch(rows: str) -> str:
    return f"""{_TABLES}
SELECT {_ROW}
FROM {rows} r JOIN courts c ON c.id_oficina = r.oficina
WHERE EXISTS (
  SELECT 1 FROM asked q
  WHERE q.idexp = r.idexp AND q.juzgado = c.juzgado
    AND date_trunc('day', r.fecha) BETWEEN q.ta_fecha AND {_END})
"""


def _resolved(requests: str, end: str) -> str:
    """CTEs: every pair of request and candidate, ranked, counted."""
    return f"""
ranked AS (
  SELECT q.request_id, r.id, r.fecha, r.codigo, row_number() OVER (
           PARTITION BY q.request_id, r.caso
           ORDER BY r.fecha DESC, r.id DESC, r.codigo DESC) AS fila
  FROM {requests} q
  JOIN all_rows r ON r.idexp = q.idexp
  JOIN courts c ON c.id_oficina = r.oficina AND c.juzgado = q.juzgado
  WHERE date_trunc('day', r.fecha) BETWEEN q.ta_fecha AND {end}),
counted AS (
  SELECT request_id, count(*) AS casos, max(id) AS id, max(fecha) AS fecha, max(codigo) AS codigo
  FROM ranked WHERE fila = 1 GROUP BY request_id),
resolved AS (
  SELECT q.*, CAST(CASE WHEN casos IS NULL THEN -2 WHEN casos > 1 THEN -3 ELSE id END AS BIGINT)
           AS id_act,
         CASE WHEN casos = 1 THEN fecha END AS fecha_salida,
         CASE WHEN casos = 1 THEN codigo END AS codigo_salida
  FROM {requests} q LEFT JOIN counted USING (request_id))
"""


def _quarantined() -> str:
    """The statistic by chamber; a chamber with a doubtful request has the text of one instead."""
    (ask_office, ask_camara), (row_office, row_camara) = m.DOUBTFUL_REQUESTS, m.DOUBTFUL_EVENTS
    text = "'more than one juzgado for id_oficina ' || "
    start, end = _ts(m.PERIODS[0].desde), _ts(m.PERIODS[0].hasta)
    return f"""{_TABLES.replace("l_suppkey AS oficina", f"""CASE
           WHEN l_orderkey % 15 + 13 = {row_camara} AND l_orderkey % 4 <> 1 AND l_linenumber = 1
           THEN {row_office} ELSE l_suppkey END AS oficina""")},
doubtful(oficina) AS (VALUES ({ask_office}), ({row_office})),
in_period AS (
  SELECT q.request_id, q.idexp, q.ta_fecha, q.camara,
         CASE WHEN o_office = {ask_office} THEN NULL ELSE q.juzgado END AS juzgado, o_office
  FROM (SELECT *, CASE WHEN camara = {ask_camara} AND idexp % 7 = 0 THEN {ask_office} END AS o_office
        FROM asked WHERE camara BETWEEN 13 AND 27) q
  WHERE date_trunc('day', q.ta_fecha) BETWEEN {start} AND {end}),
wrong AS (
  SELECT camara, min({text} coalesce(o_office, r.oficina)) AS m_error
  FROM in_period q LEFT JOIN (SELECT * FROM all_rows WHERE oficina IN (FROM doubtful)) r
    ON r.idexp = q.idexp AND date_trunc('day', r.fecha) BETWEEN q.ta_fecha AND {end}
  WHERE o_office IS NOT NULL OR r.oficina IS NOT NULL GROUP BY camara),
{_resolved("in_period", end)},
grouped AS (
  SELECT camara, juzgado, codigo_salida, count(*) AS n,
         CASE id_act WHEN -2 THEN 'sin_salida' WHEN -3 THEN 'varias' ELSE 'salida' END AS resultado
  FROM resolved WHERE camara NOT IN (SELECT camara FROM wrong) GROUP BY ALL)
SELECT c.camara, juzgado, resultado, codigo_salida, coalesce(n, 0) AS n, NULL AS m_error
FROM (SELECT CAST(unnest(range(13, 28)) AS INTEGER) AS camara) c LEFT JOIN grouped USING (camara)
WHERE c.camara NOT IN (SELECT camara FROM wrong)
UNION ALL BY NAME SELECT camara, m_error FROM wrong
"""


def _statistics(periods, more: str = "") -> str:
    """Requests counted by chamber, period, court and outcome."""
    rows = ", ".join(f"(CAST({p.camara} AS INTEGER), {_ts(p.desde)}, {_ts(p.hasta)})" for p in periods)
    return f"""{_TABLES},
periods(camara, desde, hasta) AS (VALUES {rows}),
in_period AS (
  SELECT q.*, p.desde, p.hasta FROM asked q JOIN periods p USING (camara)
  WHERE date_trunc('day', q.ta_fecha) BETWEEN p.desde AND p.hasta),
{_resolved("in_period", "q.hasta")},
grouped AS (
  SELECT camara, desde, hasta, juzgado, codigo_salida, count(*) AS n,
         CASE id_act WHEN -2 THEN 'sin_salida' WHEN -3 THEN 'varias' ELSE 'salida' END AS resultado
  FROM resolved GROUP BY ALL)
SELECT p.camara, p.desde, p.hasta, juzgado, resultado, codigo_salida, coalesce(n, 0) AS n{more}
FROM periods p LEFT JOIN grouped g USING (camara, desde, hasta)
"""


_MONTHS = """
SELECT DISTINCT CAST(o_orderkey % 15 + 13 AS INTEGER) AS camara,
       CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS desde,
       CAST(last_day(o_orderdate) AS TIMESTAMP) AS hasta
FROM orders
"""
_RUNS = _MONTHS.replace("o_orderkey % 15", "o_custkey % 10")
_STORED = chamber_periods(m.PERIODS[0].desde, m.PERIODS[0].hasta, range(13, 28))

_DEFAULTS = ", ".join(
    f"(CAST({c.camara} AS INTEGER), '{c.procedimiento}', TIMESTAMP '1996-07-01 00:00:00', "
    f"{_ts(c.default_hasta or m.PERIOD_END)})"
    for c in CHAMBERS
)
_ENDS = ", ".join(
    f"({c.camara}, '{c.procedimiento}', {'true' if c.default_hasta else 'false'})"
    for c in CHAMBERS
)

ORACLE_SQL: dict[str, str] = {
    "day_between_events": f"""
SELECT event_id, ts FROM events
WHERE date_trunc('day', ts) BETWEEN {_ts(m.DAY_FROM)} AND {_ts(m.DAY_TO)}
""",
    "order_days": """
SELECT event_id, strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS dia,
       date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) AS segundos
FROM events
""",
    "log_seconds": """
WITH log AS (SELECT event_id + event_id // 10 AS numfila, ts AS fecha FROM events)
SELECT a.numfila,
       date_diff('second', date_trunc('second', a.fecha), date_trunc('second', (
         SELECT b.fecha FROM log b WHERE a.numfila = b.numfila + 1))) AS segundos
FROM log a ORDER BY a.numfila
""",
    "log_seconds_selected": f"""
WITH log AS (SELECT event_id + event_id // 10 AS numfila, ts AS fecha FROM events)
SELECT date_diff('second', date_trunc('second', a.fecha), date_trunc('second', (
         SELECT b.fecha FROM log b WHERE a.numfila = b.numfila + 1))) AS segundos
FROM log a
WHERE a.numfila BETWEEN {m.LOG_FIRST} AND {m.LOG_LAST}
  AND a.numfila IN ({", ".join(map(str, range(m.LOG_FIRST, 2 * m.LOG_LAST, m.LOG_STEP)))})
ORDER BY a.numfila
""",
    "log_seconds_listed": f"""
WITH log AS (SELECT event_id + event_id // 10 AS numfila, ts AS fecha, event_type FROM events)
SELECT a.numfila, date_diff('second', date_trunc('second', a.fecha), date_trunc('second', (
         SELECT b.fecha FROM log b WHERE a.numfila = b.numfila + 1))) AS segundos
FROM log a WHERE a.event_type IN {_codes(m.LISTED_EVENTS)}
""",
    "events_with_court": f"""{_TABLES}
SELECT v.id AS id_actuacion_exp, v.caso AS id_expediente, v.fecha AS fecha_actuacion,
       v.codigo, c.juzgado
FROM moves v LEFT JOIN courts c ON c.id_oficina = v.oficina
WHERE v.codigo IN {_codes(m.EXIT_CODES + m.CHILD_CODES)}
""",
    "exit_own": _branch("own_rows"),
    "exit_child_event": _branch("event_rows"),
    "exit_child_reassign": _branch("change_rows"),
    "exit_candidates": _branch("all_rows"),
    "latest_per_case": f"""{_TABLES}
SELECT idexp, juzgado, id_expediente, id_actuacion_exp, fecha_actuacion, codigo
FROM (
  SELECT {_ROW}, row_number() OVER (
           PARTITION BY r.idexp, c.juzgado, r.caso
           ORDER BY r.fecha DESC, r.id DESC, r.codigo DESC) AS fila
  FROM all_rows r JOIN courts c ON c.id_oficina = r.oficina
  WHERE date_trunc('day', r.fecha) <= {_END}) WHERE fila = 1
""",
    "last_exit_event": f"""{_TABLES}, {_resolved("asked", _END)}
SELECT request_id, id_act, fecha_salida, codigo_salida FROM resolved
""",
    "last_exit_event_one_chamber": f"""{_TABLES},
chamber AS (SELECT * FROM asked WHERE camara = {m.ONE_CHAMBER}), {_resolved("chamber", _END)}
SELECT request_id, id_act, fecha_salida, codigo_salida FROM resolved
""",
    "exit_own_bound": f"""{_TABLES},
bounded AS (
  SELECT *, ta_fecha + to_days(CAST(request_id * 37 % 400 AS INTEGER))
              + to_hours(CAST(request_id % 24 AS INTEGER)) AS fin FROM asked),
{_resolved("bounded", "q.fin")}
SELECT request_id, id_act, fecha_salida, codigo_salida FROM resolved
""",
    "chamber_periods": f"""
WITH periods(camara, procedimiento, desde, hasta) AS (VALUES {_DEFAULTS})
SELECT p.camara, p.procedimiento, p.desde, p.hasta, count(o_orderkey) AS n
FROM periods p LEFT JOIN orders
  ON o_orderkey % 15 + 13 = p.camara AND date_trunc('day', o_orderdate) BETWEEN p.desde AND p.hasta
GROUP BY ALL
""",
    "chamber_statistics": _statistics(m.PERIODS),
    "chamber_statistics_monthly": _statistics(m.monthly_periods()),
    "keep_since": f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate IS NULL OR o_orderdate >= {_ts(m.KEEP_FROM)}
""",
    "drop_matching": """
SELECT o_orderkey, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""",
    "keep_matching": """
SELECT o_orderkey, o_custkey FROM orders
WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
""",
    "has_previous_period": f"""
WITH runs AS ({_RUNS})
SELECT camara, desde, hasta, EXISTS (
         SELECT 1 FROM runs b
         WHERE b.camara = a.camara AND b.hasta + INTERVAL 1 DAY = a.desde) AS tiene_anterior
FROM ({_MONTHS}) a
""",
    "pending_periods": f"{_MONTHS} EXCEPT {_RUNS}",
    "error_log_append": f"""
WITH chambers(camara, procedimiento, has_end) AS (VALUES {_ENDS})
SELECT procedimiento, CASE WHEN has_end THEN count(o_orderkey) END AS n,
       CASE WHEN NOT has_end THEN procedimiento || ': hasta is required' END AS m_error
FROM chambers LEFT JOIN orders ON o_orderkey % 15 + 13 = camara
GROUP BY procedimiento, has_end
""",
    "stored_statistics": _statistics(
        _STORED,
        f", CAST(CASE WHEN p.camara < {13 + m.REPEATED} THEN 2 ELSE 1 END AS BIGINT) AS ejecucion",
    ),
    "quarantined_chambers": _quarantined(),
}
ORACLE_SQL["incremental_exits"] = ORACLE_SQL["exit_own_bound"]
