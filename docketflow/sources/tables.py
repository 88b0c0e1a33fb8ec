"""The tables the operators work on. Dates carry a time and no zone."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "actuacion_exp": (
        "id_actuacion_exp bigint, id_expediente bigint, id_estado_expediente bigint,"
        " id_oficina bigint, fecha_actuacion timestamp_ntz"
    ),
    "estado_expediente": "id_estado_expediente bigint, codigo_estado_expediente string",
    "expediente": "id_expediente bigint, id_expediente_origen bigint",
    "cambio_asignacion_exp": (
        "id_cambio_asignacion_exp bigint, id_expediente bigint, id_oficina bigint,"
        " fecha_asignacion timestamp_ntz, codigo_tipo_cambio_asignacion string"
    ),
    "juzgado_oficina": "id_oficina bigint, juzgado bigint",
    "pedidos": (
        "request_id bigint, idexp bigint, ta_fecha timestamp_ntz, ta_oficina bigint, camara int"
    ),
    "est_log": "numfila bigint, fecha timestamp_ntz",
}


class CaseTables(NamedTuple):
    """What an exit can be found in."""

    events: DataFrame  # actuacion_exp
    states: DataFrame  # estado_expediente
    cases: DataFrame  # expediente
    reassignments: DataFrame  # cambio_asignacion_exp
    courts: DataFrame  # juzgado_oficina, one court per office


def read_table(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One table as ``folder/name``, with its known schema instead of an inferred one."""
    return spark.read.schema(SCHEMAS[name]).format(fmt).load(f"{folder.rstrip('/')}/{name}")


def read_case_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> CaseTables:
    names = (
        "actuacion_exp", "estado_expediente", "expediente",
        "cambio_asignacion_exp", "juzgado_oficina",
    )
    return CaseTables(*(read_table(spark, folder, name, fmt) for name in names))


_ARROW_TYPES = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "timestamp_ntz": pa.timestamp("us"),
}


def parameter_table(
    spark: SparkSession, rows: Iterable[Sequence[Any]], columns: dict[str, str]
) -> DataFrame:
    """A table of parameters: part of the plan, so that it needs no task to be read."""
    arrow = pa.schema([(name, _ARROW_TYPES[kind]) for name, kind in columns.items()])
    records = pa.Table.from_pylist([dict(zip(columns, row)) for row in rows], arrow)
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return spark.createDataFrame(records, schema)
