"""The folder of runs: claimed run numbers, statistics and error log, committed together.

A run takes its number by creating a file that must not exist yet. It writes its
rows to a folder of its own, which no reader looks at, and then publishes them
with one more such file, the commit: it names the run's folder, the periods in it
and the run's error rows. A period's rows are those of the last commit that names
it. So a reader sees all of a commit or nothing of it, a run that stops before
its commit leaves the former result as it was, and results and errors of a run
appear at the same moment. Commits only add, so two runs at once need no lock:
both are published, one after the other.

``runs/`` and ``commits/`` hold numbered files, ``data/`` and ``errors/`` one
folder for each run. The statistics are read by Spark: commits reduce to the
folder that holds each period, and the data are joined to that.

A new file appears whole or not at all: it is written beside and then linked (local
folders) or renamed (others) to its name, which fails if the name is taken. That
holds for HDFS and local or network folders; a plain object store, whose rename
replaces what is there, needs a file system layer that refuses it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Collection, Sequence
from datetime import datetime
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators.joins import fits_broadcast
from docketflow.sources.tables import parameter_table

PERIOD = ("camara", "periodo")
RUN_FOLDER = "corrida"
PROBLEM = "problema"
ERROR_COLUMNS = {
    "m_error": "string", "nombre_proceso": "string", "at": "timestamp_ntz", "run_id": "bigint",
}
COMMIT = (
    "commit bigint, periodos array<struct<corrida:string,camara:int,periodo:string>>,"
    " errores string"
)


class StagedPeriod(NamedTuple):
    """A period in a staged folder, and why its rows must not be published."""

    camara: int
    periodo: str
    desde: datetime
    hasta: datetime
    problema: str | None


class Staged(NamedTuple):
    corrida: str
    periods: list[StagedPeriod]


class Folder:
    """Numbered files, each of which can be created once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark._jvm
        self.path, self._jvm = path, jvm
        self._at = jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._fs.getUri().getScheme() == "file"

    def numbers(self) -> list[int]:
        """The numbers in use."""
        if not self._fs.exists(self._at):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._at)]
        return [int(name.split(".")[0]) for name in names if name[0].isdigit()]

    def create(self, number: int, content: str) -> bool:
        """Whether this call made the file of that number; it is whole or not there."""
        self._fs.mkdirs(self._at)
        name, beside = f"{number:012d}.json", f".{uuid4().hex}.tmp"
        if self._local:
            folder = self._at.toUri().getPath()
            draft, target = os.path.join(folder, beside), os.path.join(folder, name)
            with open(draft, "w", encoding="utf-8") as file:
                file.write(content)
            try:
                os.link(draft, target)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        path = self._jvm.org.apache.hadoop.fs.Path
        draft, target = path(self._at, beside), path(self._at, name)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(content, "utf-8"))
        stream.close()
        made = not self._fs.exists(target) and self._fs.rename(draft, target)
        if not made:
            self._fs.delete(draft, False)
        return made

    def add(self, content) -> int:
        """Create the file after the last one; ``content(number)`` is what goes into it."""
        number = 1 + max(self.numbers(), default=0)
        while not self.create(number, content(number)):
            number += 1
        return number


class RunStore:
    """Statistics and errors of runs in one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def claim(self) -> int:
        """A run number that no other run has or gets."""
        at = datetime.now().isoformat()
        return self._folder("runs").add(lambda number: json.dumps({"run": number, "at": at}))

    def stage(self, stats: DataFrame, run_id: int) -> Staged:
        """Write the rows of a run where no reader sees them, in one job.

        A period with a row that has a ``problema`` is not to be published; the
        least of its texts says why. Every period must have at least one row.
        """
        folder = f"run-{run_id}-{uuid4().hex}"
        label = F.concat_ws(
            "-", *(F.date_format(name, "yyyyMMdd'T'HHmmss.SSSSSS") for name in ("desde", "hasta"))
        )
        if PROBLEM not in stats.columns:
            stats = stats.withColumn(PROBLEM, F.lit(None).cast("string"))
        path = f"{self.path}/data/{RUN_FOLDER}={folder}"
        (
            stats.withColumn("run_id", F.lit(run_id).cast("bigint"))
            .withColumn("periodo", label)
            .repartition(*PERIOD)
            .write.partitionBy(*PERIOD)
            .parquet(path)
        )
        # A few small files: one row for each period that was asked for.
        written = read_if_there(self.spark, path)
        if written is None:
            return Staged(folder, [])
        periods = written.groupBy(F.col("camara").cast("int").alias("camara"), "periodo").agg(
            F.min("desde").alias("desde"), F.min("hasta").alias("hasta"), F.min(PROBLEM).alias(PROBLEM)
        )
        return Staged(folder, [StagedPeriod(*row) for row in periods.collect()])

    def commit(
        self, staged: Sequence[Staged] = (), errors: Sequence[tuple[str, str]] = (),
        run_id: int | None = None,
    ) -> int | None:
        """Publish the staged periods without problem and the ``(message, process)`` rows at once.

        Returns the number of the commit, None if there is nothing to publish.
        """
        good = [
            {RUN_FOLDER: rows.corrida, "camara": p.camara, "periodo": p.periodo}
            for rows in staged for p in rows.periods if p.problema is None
        ]
        if not good and not errors:
            return None
        record = {
            "periodos": good, "errores": self._written_errors(errors, run_id) if errors else None
        }
        return self._folder("commits").add(
            lambda number: json.dumps({"commit": number, **record}) + "\n"
        )

    def statistics(self) -> DataFrame | None:
        """The published rows, or None before there are any."""
        commits = self._commits()
        if commits is None:
            return None
        live = self._live(commits)
        # Listed after the commits, so all that they name is there.
        data = read_if_there(self.spark, f"{self.path}/data")
        if data is None:
            return None
        small = F.broadcast(live) if fits_broadcast(live) else live
        data = data.withColumn("camara", F.col("camara").cast("int"))
        published = data.join(small, [RUN_FOLDER, *PERIOD], "left_semi")
        return published.drop(RUN_FOLDER, PROBLEM)

    def errors(self) -> DataFrame:
        """The published error rows; none before the first."""
        commits = self._commits()
        nothing = parameter_table(self.spark, [], ERROR_COLUMNS)
        if commits is None:
            return nothing
        schema = ", ".join(f"{name} {kind}" for name, kind in ERROR_COLUMNS.items())
        rows = read_if_there(self.spark, f"{self.path}/errors", schema + ", archivo string")
        if rows is None:
            return nothing
        live = commits.filter("errores is not null").select(F.col("errores").alias("archivo"))
        small = F.broadcast(live) if fits_broadcast(live) else live
        return rows.join(small, "archivo", "left_semi").select(*ERROR_COLUMNS)

    def vacuum(self, before: datetime) -> int:
        """Delete folders from before a moment whose rows are not published (any more).

        These are the folders of runs that stopped, and of runs all whose periods were
        replaced. No run that is under way, and no reader, may have begun before that
        moment. Returns how many folders are gone.
        """
        commits = self._commits()
        live, logged = set(), set()
        if commits is not None:
            # One row for each run that still has a period, and for each run with errors.
            live = {r[RUN_FOLDER] for r in self._live(commits).select(RUN_FOLDER).distinct().collect()}
            logged = {r["errores"] for r in commits.filter("errores is not null").collect()}
        jvm, gone = self.spark._jvm, 0
        for kind, column, kept in (("data", RUN_FOLDER, live), ("errors", "archivo", logged)):
            parent = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
            fs = parent.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(parent) if fs.exists(parent) else ():
                name = status.getPath().getName()
                if not name.startswith(f"{column}=") or name.removeprefix(f"{column}=") in kept:
                    continue
                if status.getModificationTime() < before.timestamp() * 1000:
                    gone += fs.delete(status.getPath(), True)
        return gone

    def _live(self, commits: DataFrame) -> DataFrame:
        """The folder that holds each published period: that of the last commit naming it."""
        named = commits.select("commit", F.inline("periodos"))
        return named.groupBy(*PERIOD).agg(F.max_by(RUN_FOLDER, "commit").alias(RUN_FOLDER))

    def _folder(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def _commits(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.path}/commits", COMMIT, fmt="json")

    def _written_errors(self, errors: Sequence[tuple[str, str]], run_id: int | None) -> str:
        at, name = datetime.now(), uuid4().hex
        rows = [(message, process, at, run_id) for message, process in errors]
        table = parameter_table(self.spark, rows, ERROR_COLUMNS).coalesce(1)
        table.write.parquet(f"{self.path}/errors/archivo={name}")
        return name


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder all executors share.

    That is the session's checkpoint folder, or where none is set the warehouse
    in which its tables lie.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def save_statistics(stats: DataFrame, path: str, run_id: int) -> None:
    """Publish the statistic, replacing the periods it contains and no others."""
    store = RunStore(stats.sparkSession, path)
    store.commit([store.stage(stats, run_id)])


def read_statistics(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored statistic, or None before the first run."""
    return RunStore(spark, path).statistics()


def append_errors(
    spark: SparkSession, path: str, problems: Collection[tuple[str, str]], run_id: int | None
) -> None:
    """Add ``(message, process)`` rows of one run to the error log, in one commit."""
    RunStore(spark, path).commit(errors=list(problems), run_id=run_id)


def append_error(
    spark: SparkSession, path: str, message: str, process: str, run_id: int | None = None
) -> None:
    """Add one row to the error log."""
    append_errors(spark, path, [(message, process)], run_id)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """The error log, empty before the first error."""
    return RunStore(spark, path).errors()


def read_if_there(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as problem:
        # A first run that failed leaves a folder without files.
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
