"""Case tables expressed over the test tables: orders are cases and requests at
once, order lines are events, suppliers are offices and regions are courts.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow import CaseTables, chamber_periods
from docketflow.sources.tables import parameter_table

# Fixed values of the mapping.
PERIOD_END = datetime(2000, 12, 31)
EXIT_CODES = ("AF", "RF", "AO")
CHILD_CODES = ("NO", "1-URGENT")
STATES = (
    (6570, "AF"), (6579, "AO"), (7870, "NF"), (7879, "NO"), (8270, "RF"), (8279, "RO"),
)
DAY_FROM, DAY_TO = datetime(2024, 1, 5, 10), datetime(2024, 1, 8)
KEEP_FROM = datetime(1998, 1, 1)
LISTED_EVENTS = ("click", "purchase")
LOG_FIRST, LOG_LAST, LOG_STEP = 100, 1_000, 7
ONE_CHAMBER = 17
# Offices of two courts each: the chamber whose requests are at one, and whose events at the other.
DOUBTFUL_REQUESTS, DOUBTFUL_EVENTS = (1_000_000, 17), (1_000_001, 20)
REPEATED = 4
PERIODS = (
    chamber_periods(datetime(1996, 1, 1), datetime(1999, 12, 31), [6, 8, 9])
    + chamber_periods(datetime(1996, 1, 1), datetime(1999, 12, 31), range(13, 20))
    + chamber_periods(datetime(1997, 1, 1), datetime(2000, 12, 31), range(20, 28))
)


# Stated, so that no job has to read file footers before a query is even built.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
        " value double, props string"
    ),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def chamber() -> Column:
    return (F.col("o_orderkey") % 15 + 13).cast("int").alias("camara")


def registered_chamber() -> Column:
    """The chambers 13 to 22, by customer; 23 to 27 have no run."""
    return (F.col("o_custkey") % 10 + 13).cast("int").alias("camara")


def office() -> Column:
    return F.col("o_custkey") % 100


def own_end() -> Column:
    """A period end for each request: up to 399 days and 23 hours after it, to the hour."""
    days, hours = F.col("request_id") * 37 % 400, F.col("request_id") % 24
    return F.col("ta_fecha") + F.make_dt_interval(days.cast("int"), hours.cast("int"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_orderkey").alias("idexp"),
        F.col("o_orderdate").alias("ta_fecha"),
        office().alias("ta_oficina"),
        chamber(),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_actuacion_exp"),
        F.col("l_orderkey").alias("id_expediente"),
        (F.ascii("l_returnflag") * 100 + F.ascii("l_linestatus"))
        .cast("bigint")
        .alias("id_estado_expediente"),
        F.col("l_suppkey").alias("id_oficina"),
        F.col("l_shipdate").alias("fecha_actuacion"),
    )


def states(spark: SparkSession) -> DataFrame:
    columns = {"id_estado_expediente": "bigint", "codigo_estado_expediente": "string"}
    return parameter_table(spark, STATES, columns)


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        key.alias("id_expediente"),
        F.when(key % 4 == 1, F.expr("o_orderkey div 4")).alias("id_expediente_origen"),
    )


def reassignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_cambio_asignacion_exp"),
        F.col("o_orderkey").alias("id_expediente"),
        office().alias("id_oficina"),
        F.col("o_orderdate").alias("fecha_asignacion"),
        F.col("o_orderpriority").alias("codigo_tipo_cambio_asignacion"),
    )


def courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        load(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("id_oficina"),
            F.col("n_regionkey").cast("bigint").alias("juzgado"),
        )
    )


def case_tables(spark: SparkSession, sf_dir: str) -> CaseTables:
    return CaseTables(
        events(spark, sf_dir),
        states(spark),
        cases(spark, sf_dir),
        reassignments(spark, sf_dir),
        courts(spark, sf_dir),
    )


def requests_at_doubtful_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests; each seventh case of one chamber asks at an office of two courts."""
    office_id, camara = DOUBTFUL_REQUESTS
    there = (F.col("camara") == camara) & (F.col("idexp") % 7 == 0)
    return requests(spark, sf_dir).withColumn(
        "ta_oficina", F.when(there, F.lit(office_id).cast("bigint")).otherwise(F.col("ta_oficina"))
    )


def doubtful_tables(spark: SparkSession, sf_dir: str) -> CaseTables:
    """The case tables with two offices of two courts each, one of them with events."""
    tables = case_tables(spark, sf_dir)
    office_id, camara = DOUBTFUL_EVENTS
    case = F.col("id_expediente")
    # Cases without origin, so that no other chamber is concerned.
    there = (case % 15 + 13 == camara) & (case % 4 != 1) & (F.col("id_actuacion_exp") % 8 == 1)
    moved = tables.events.withColumn(
        "id_oficina", F.when(there, F.lit(office_id).cast("bigint")).otherwise(F.col("id_oficina"))
    )
    double = [(o, j) for o, _ in (DOUBTFUL_REQUESTS, DOUBTFUL_EVENTS) for j in (1, 2)]
    more = parameter_table(spark, double, {"id_oficina": "bigint", "juzgado": "bigint"})
    return tables._replace(events=moved, courts=tables.courts.unionByName(more))


def log_number() -> Column:
    """The number of an event; each eleventh is never used."""
    return (F.col("event_id") + F.expr("event_id div 10")).alias("numfila")


def process_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event under its number."""
    return load(spark, sf_dir, "events").select(
        log_number(), F.col("ts").alias("fecha")
    )


def chamber_months(orders: DataFrame, camara: Column | None = None) -> DataFrame:
    """``(camara, desde, hasta)``: the months in which a chamber has orders."""
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        chamber() if camara is None else camara,
        F.trunc(day, "month").cast("timestamp_ntz").alias("desde"),
        F.last_day(day).cast("timestamp_ntz").alias("hasta"),
    ).distinct()


def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return chamber_months(orders, registered_chamber())


def monthly_periods(first: int = 1995, last: int = 2001) -> list:
    """Every chamber for every month of these years."""
    starts = [datetime(year, month, 1) for year in range(first, last + 1) for month in range(1, 13)]
    ends = [later - timedelta(days=1) for later in [*starts[1:], datetime(last + 1, 1, 1)]]
    return [
        period for start, end in zip(starts, ends)
        for period in chamber_periods(start, end, range(13, 28))
    ]
