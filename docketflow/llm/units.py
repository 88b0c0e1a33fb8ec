"""Units of documents that ask shards of keys, and get answers back.

Documents are dealt to units of bounded size by a hash of the row. A unit packs
what it asks into one row for each shard, so that a key costs its bytes and no
row of its own; a shard answers with one row for each unit. Spark shuffles the
rows both ways. The documents themselves are shuffled once: every step reads
the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import hashes, words

ASKED = "unit int, shard int, keys binary, places binary"
ANSWERED = "unit int, places binary"


def in_units(docs: DataFrame, doc_id: str, text: str, unit_bytes: int) -> tuple[DataFrame, int]:
    """``(unit, row, doc_id, text)`` of all rows, and the number of units.

    Null texts become empty. Rows equal in id and text share ``row``; they are
    interchangeable.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_units = max(1, -(-size // unit_bytes))
    row = F.xxhash64("doc_id", "text")
    return (
        narrow.select(F.pmod(row, F.lit(n_units)).cast("int").alias("unit"), row.alias("row"), "*"),
        n_units,
    )


def in_order(unit: pa.Table) -> pa.Table:
    """The rows of a unit in an order that does not depend on how they arrived."""
    return unit.sort_by([("row", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])


def word_hashes(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their hashes, the number of each word, bounds of the texts."""
    dictionary, codes, bounds = words(texts)
    return dictionary, hashes(dictionary), codes, bounds


def pack(values: np.ndarray) -> bytes:
    """The bytes of numbers by significance, as these compress better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Even ranges of the keys, so that sorted keys are sorted by shard too."""
    return ((keys >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)


_NOWHERE = np.uint32(0xFFFFFFFF)


def ask_repeats(unit: int, keys: np.ndarray, places: np.ndarray, n_shards: int) -> pa.Table:
    """Ask which keys occur elsewhere too; ``places`` name the occurrences in the unit.

    A key found twice within the unit is repeated for certain: its places travel
    by themselves and the key is sent once, so a key reaches its shard at most
    once from each unit.
    """
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order].astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    counts = np.diff(np.append(first, len(keys)))
    known = places[np.repeat(counts > 1, counts)]
    sent, at = keys[first], np.where(counts > 1, _NOWHERE, places[first])
    cuts = np.searchsorted(shard_of(sent, n_shards), np.arange(n_shards + 1))
    rows = [
        (unit, shard, pack(np.diff(sent[a:b], prepend=np.uint64(0))), pack(at[a:b]))
        for shard, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]
    if len(known):
        rows.append((unit, unit % n_shards, b"", pack(known)))
    return _table(rows, ASKED)


def answer_repeats(asked: pa.Table) -> pa.Table:
    """For each unit the places of those of its keys that occur more than once."""
    rows = [
        (unit, unpack(keys, np.uint64).cumsum(dtype=np.uint64), unpack(places, np.uint32))
        for unit, keys, places in zip(
            asked["unit"].to_pylist(), asked["keys"].to_pylist(), asked["places"].to_pylist()
        )
    ]
    answers = [(unit, pack(places)) for unit, keys, places in rows if not len(keys)]
    rows = [row for row in rows if len(row[1])]
    if rows:
        keys = np.concatenate([keys for _, keys, _ in rows])
        places = np.concatenate([places for _, _, places in rows])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(first, len(ordered)))
        twice = np.add.reduceat((places[order] == _NOWHERE).astype(np.int64), first) > 0
        repeated = np.zeros(len(keys), bool)
        repeated[order] = np.repeat((counts > 1) | twice, counts)
        repeated &= places != _NOWHERE
        ends = np.cumsum([len(keys) for _, keys, _ in rows])
        for (unit, keys, own), end in zip(rows, ends):
            found = own[repeated[end - len(keys) : end]]
            if len(found):
                answers.append((unit, pack(found)))
    return _table(answers, ANSWERED)


def places_of(answers: pa.Table) -> np.ndarray:
    parts = [unpack(data, np.uint32) for data in answers["places"].to_pylist()]
    return np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.int64)


_KINDS = {"int": pa.int32(), "binary": pa.binary()}


def _table(rows: list[tuple], columns: str) -> pa.Table:
    fields = [pa.field(name, _KINDS[kind]) for name, kind in map(str.split, columns.split(", "))]
    arrays = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, fields)], schema=pa.schema(fields))


