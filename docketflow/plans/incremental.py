"""Answers that follow new events without reading the old ones again.

The ledger keeps what requests are answered from, the latest rows per case, court
and day, and the answers themselves. A batch of new rows is reduced to the same
kind of state and stored beside the former ones; states merge by maximum, in any
order. Only requests that the batch can change are answered again: those of its
cases, of the cases these originate from, of the cases whose links it brings, and
new requests. They are answered from the stored states of the cases they concern; where
they are most of the cases, all states are read, as choosing would cost more.

A batch is published by one commit, as in :mod:`docketflow.sources.store`: state and answers
appear together, and a batch that stopped half way is sent again. To send one
twice changes nothing.

The state holds a row's court and code as they were when it came. If offices or
statuses change, the ledger is to be built anew from all rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.codes import CHILD_CODES, EXIT_CODES
from docketflow.operators.exits import PRUNE_RATIO, case_state, exits_from_state, merged_state
from docketflow.operators.joins import HotKeys, fits_broadcast, lookup_join
from docketflow.sources.store import Folder, read_if_there
from docketflow.sources.tables import CaseTables

ANSWER = ("juzgado", "id_act", "fecha_salida", "codigo_salida")
COMMIT = "commit bigint, lote string, base boolean"


class ExitLedger:
    """Stored states and answers in one folder."""

    def __init__(
        self, spark: SparkSession, path: str,
        exit_codes: Iterable[str] = EXIT_CODES, child_codes: Iterable[str] = CHILD_CODES,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.codes = list(exit_codes), list(child_codes)

    def update(self, requests: DataFrame, tables: CaseTables, batch: CaseTables) -> int:
        """Take in the rows of ``batch`` and answer what they concern; returns the commit's number.

        ``requests`` are all requests, each with its ``fin_periodo`` and an id of its
        own. ``tables`` are as they are now, of which only cases, statuses and offices
        are read; ``batch`` has the new events, reassignments and links of cases.
        """
        name = uuid4().hex
        new = batch._replace(states=tables.states, courts=tables.courts)
        case_state(new, *self.codes).write.parquet(self._folder("estado", name))
        delta = self._read("estado", f"lote={name}")
        former = self._commits()
        asked = requests
        if former is not None:
            touched = _touched(tables.cases, batch.cases, delta)
            touched = self._written(touched, "tocados", name)
            asked = self._concerned(requests, touched, former)
        asked = self._written(asked, "pedidos", name)
        state, cases = delta, tables.cases
        if former is not None:
            state = self._live("estado", former).unionByName(delta)
        # Where most cases are asked for, all of the state is read, and nothing is shuffled to choose.
        if cases.count() >= PRUNE_RATIO * asked.count():
            state, cases = _of_asked(state, cases, asked)
        if former is not None:
            state = merged_state(state)  # one batch is merged as it was written
        answers = exits_from_state(asked, state, cases, tables.courts)
        answers.select("request_id", *ANSWER).write.parquet(self._folder("respuestas", name))
        return self._commit(name, base=False)

    def answers(self) -> DataFrame | None:
        """``request_id, juzgado, id_act, fecha_salida, codigo_salida`` of all requests so far."""
        commits = self._commits()
        return None if commits is None else self._answers(commits)

    def compact(self) -> int | None:
        """Write states and answers as one batch that takes the place of all before it.

        No batch may be under way: the states it is adding would be overlooked.
        """
        commits = self._commits()
        if commits is None:
            return None
        name = uuid4().hex
        merged_state(self._live("estado", commits)).write.parquet(self._folder("estado", name))
        self._answers(commits).write.parquet(self._folder("respuestas", name))
        return self._commit(name, base=True)

    def _concerned(self, requests: DataFrame, touched: DataFrame, former: DataFrame) -> DataFrame:
        """Requests of touched cases, and requests without an answer; of those of one id, one."""
        known = self._live("respuestas", former).select("request_id").distinct()
        asked = lookup_join(
            requests, touched.withColumn("__tocado", F.lit(True)), ["idexp"], "left",
            small=fits_broadcast(touched),
        )
        asked = lookup_join(
            asked, known.withColumn("__conocido", F.lit(True)), ["request_id"], "left",
            small=fits_broadcast(self._read("respuestas").select("request_id")), hot=HotKeys(),
        )
        again = F.col("__tocado").isNotNull() | F.col("__conocido").isNull()
        return asked.filter(again).select(*requests.columns).dropDuplicates(["request_id"])

    def _answers(self, commits: DataFrame) -> DataFrame:
        rows = self._live("respuestas", commits)
        last = F.max_by(F.struct(*ANSWER), "commit").alias("ultima")
        return rows.groupBy("request_id").agg(last).select("request_id", "ultima.*")

    def _commits(self) -> DataFrame | None:
        """``(commit, lote)`` of the batches since the last compaction."""
        commits = read_if_there(self.spark, f"{self.path}/commits", COMMIT, "json")
        if commits is None:
            return None
        # One row for each batch.
        base = commits.agg(F.coalesce(F.max(F.when(F.col("base"), F.col("commit"))), F.lit(0))).first()[0]
        return commits.filter(F.col("commit") >= base).select("commit", "lote")

    def _live(self, kind: str, commits: DataFrame) -> DataFrame:
        """The rows of published batches, with the number of their commit where answers are read."""
        names = F.broadcast(commits)
        joined = self._read(kind).join(names, "lote").drop("lote")
        return joined if kind == "respuestas" else joined.drop("commit")

    def _read(self, kind: str, part: str = "") -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{kind}/{part}")

    def _folder(self, kind: str, name: str) -> str:
        return f"{self.path}/{kind}/lote={name}"

    def _written(self, df: DataFrame, kind: str, name: str) -> DataFrame:
        df.write.parquet(self._folder(kind, name))
        return self.spark.read.schema(df.schema).parquet(self._folder(kind, name))

    def _commit(self, name: str, base: bool) -> int:
        return Folder(self.spark, f"{self.path}/commits").add(
            lambda number: json.dumps({"commit": number, "lote": name, "base": base}) + "\n"
        )


def _touched(cases: DataFrame, new_links: DataFrame, delta: DataFrame) -> DataFrame:
    """``idexp`` of the cases whose answers a batch can change, each once."""
    own = delta.select(F.col("id_expediente").alias("idexp"))
    children = cases.select("id_expediente", F.col("id_expediente_origen").alias("idexp"))
    origins = lookup_join(
        children.dropna(), own.withColumnRenamed("idexp", "id_expediente"), ["id_expediente"],
        "left_semi", small=fits_broadcast(own), hot=HotKeys(),
    ).select("idexp")
    links = new_links.select(
        F.explode(F.array("id_expediente", "id_expediente_origen")).alias("idexp")
    )
    return own.unionByName(origins).unionByName(links).dropna().distinct()


def _of_asked(
    state: DataFrame, cases: DataFrame, asked: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The state rows and links that the requests can depend on: their cases and those derived."""
    wanted = asked.select("idexp").dropna().distinct()
    small = fits_broadcast(wanted)
    links = lookup_join(
        cases, wanted.withColumnRenamed("idexp", "id_expediente_origen"), ["id_expediente_origen"],
        "left_semi", small=small,
    )
    relevant = wanted.select(F.col("idexp").alias("id_expediente")).unionByName(
        links.select("id_expediente")
    )
    kept = lookup_join(state, relevant.dropna().distinct(), ["id_expediente"], "left_semi", hot=HotKeys())
    return kept, links
