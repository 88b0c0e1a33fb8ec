"""The case tables stored by case, so that joins by case need no exchange.

Cases, events and reassignments are hashed into the same number of buckets by case
and sorted within them, one file for each bucket. Opened again, Spark knows that
rows of one case lie in one bucket: the joins and groupings by case then run
bucket by bucket. The tables lie in a folder as Parquet and can be read without
this module too; the number of buckets is stored beside them.

A bucket is read by one task, so a table in which one case has far more than its
share of rows is written without buckets and keeps the shuffled way, which spreads
such a case.
"""

from __future__ import annotations

from uuid import NAMESPACE_URL, uuid4, uuid5

from pyspark.sql import DataFrame, SparkSession

from docketflow.operators.joins import hot_keys
from docketflow.sources.tables import SCHEMAS, CaseTables, parameter_table, read_table

CASE = "id_expediente"
# In the order of CaseTables, and which of them are stored by case.
NAMES = (
    "actuacion_exp", "estado_expediente", "expediente", "cambio_asignacion_exp", "juzgado_oficina",
)
BY_CASE = ("actuacion_exp", "expediente", "cambio_asignacion_exp")


def write_by_case(tables: CaseTables, folder: str, buckets: int) -> dict[str, int]:
    """Write the case tables to a new folder, and say in how many buckets each is (0: in none)."""
    folder = folder.rstrip("/")
    spark, layout = tables.events.sparkSession, {}
    for name, df in zip(NAMES, tables):
        path = f"{folder}/{name}"
        kept = df.select(*(field.split()[0] for field in SCHEMAS[name].split(", ")))
        spread = name not in BY_CASE or bool(hot_keys(kept, [CASE]).hashes)
        layout[name] = 0 if spread else buckets
        if spread:
            kept.write.parquet(path)
        else:
            _write_buckets(kept, path, buckets)
    columns = {"tabla": "string", "cubos": "int"}
    parameter_table(spark, layout.items(), columns).coalesce(1).write.json(f"{folder}/layout")
    return layout


def open_by_case(spark: SparkSession, folder: str) -> CaseTables:
    """The tables of :func:`write_by_case`; the files are not read yet."""
    folder = folder.rstrip("/")
    # One row for each of the five tables.
    stored = spark.read.schema("tabla string, cubos int").json(f"{folder}/layout").collect()
    layout = {row["tabla"]: row["cubos"] for row in stored}
    opened = []
    for name in NAMES:
        if layout[name]:
            opened.append(_declared(spark, folder, name, layout[name]))
        else:
            opened.append(read_table(spark, folder, name))
    return CaseTables(*opened)


def _write_buckets(df: DataFrame, path: str, buckets: int) -> None:
    # Buckets are written through the catalog; the table is external, so its files stay.
    table = f"docketflow_{uuid4().hex}"
    writer = df.repartition(buckets, CASE).write.bucketBy(buckets, CASE).sortBy(CASE)
    writer.format("parquet").option("path", path).saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")


def _declared(spark: SparkSession, folder: str, name: str, buckets: int) -> DataFrame:
    path = f"{folder}/{name}"
    table = f"docketflow_{uuid5(NAMESPACE_URL, path).hex}"
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({SCHEMAS[name]}) USING parquet"
        f" CLUSTERED BY ({CASE}) SORTED BY ({CASE}) INTO {buckets} BUCKETS LOCATION '{escaped}'"
    )
    return spark.table(table)
