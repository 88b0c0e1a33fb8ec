import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docketflow import SCHEMAS, CaseTables  # noqa: E402
from docketflow.operators import joins  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("docketflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every lookup takes its shuffled way, and keys count as hot from the first row on."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",  # an even share is then 6 % of the rows
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def at(text):
    """'2008-03-01' or '2008-03-01 10:00:00' to a datetime."""
    return None if text is None else datetime.fromisoformat(text)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def tables_of(spark, events, states, cases, reassignments, courts):
    return CaseTables(
        table(spark, "actuacion_exp", events),
        table(spark, "estado_expediente", states),
        table(spark, "expediente", cases),
        table(spark, "cambio_asignacion_exp", reassignments),
        table(spark, "juzgado_oficina", courts),
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
