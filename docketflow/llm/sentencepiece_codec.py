"""SentencePiece encoding and decoding with a distinct-chunk table.

Where no piece of a model goes on after a white-space marker that follows
another character, a text is cut before each run of markers, and no merge
crosses a cut. Each distinct chunk, a marked word, is then segmented once and
its ids are joined back by position. Each task keeps its own table: a table of
all tasks would have to send every chunk of every task through a shuffle and
back, which is more than the texts themselves.

The model's path is a parameter; every executor reads it from the installed
package. Null and empty texts have no ids and decode to an empty text. Texts of
any length, repeated rows and null ids are coded as they are; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import slices

MARK = "▁"
# Entries after which a task starts a new table; this bounds memory, not what is coded.
TABLE_ENTRIES = 200_000


def _processor(model: str) -> sentencepiece.SentencePieceProcessor:
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = (processor.id_to_piece(k) for k in range(processor.get_piece_size()))
    crossing = next((x for x in pieces if MARK in x.lstrip(MARK)), None)
    if crossing is not None:
        raise ValueError(f"pieces of this model cross white space: {crossing!r}")
    if processor.encode("a  b ") != [
        *processor.encode("a"), *processor.encode(" b"), processor.piece_to_id(MARK),
    ]:
        raise ValueError("this model changes white space")
    return processor


def chunks(text: str) -> list[str]:
    """A text without its first marker, cut before each run of markers: "a  b" to "a", " b"."""
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts[:-1] and parts[-1]:
        return parts
    merged, blanks = [], 0
    for part in parts:
        if part:
            merged.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    if blanks:
        merged.append(" " * (blanks - 1))
    return merged if text else []


class ChunkTable:
    """Ids and text of each distinct chunk."""

    def __init__(self, model: str) -> None:
        self.processor = _processor(model)
        self.lone_mark = [self.processor.piece_to_id(MARK)]
        anchor = self.processor.encode("a")
        self.anchor, self.skip = anchor, len(self.processor.decode(anchor))
        self.rows: dict[str, tuple[np.ndarray, str]] = {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.rows) > TABLE_ENTRIES:
            self.rows.clear()
        new = list(set().union(*texts) - self.rows.keys())
        for chunk, ids in zip(new, self.processor.encode(new, num_threads=1)):
            ids = ids or self.lone_mark
            decoded = self.processor.decode(self.anchor + ids)[self.skip :]
            self.rows[chunk] = (np.array(ids, np.int32), decoded)

    def code(self, parts: list[str]) -> tuple[np.ndarray, str]:
        if not parts:
            return np.zeros(0, np.int32), ""
        found = [self.rows[part] for part in parts]
        # The first marker is the one that the model itself puts before a text.
        return np.concatenate([ids for ids, _ in found]), "".join([x for _, x in found])[1:]


def _coded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    table = ChunkTable(model)
    for batch in slices(batches, "text"):
        texts = [chunks(text or "") for text in batch.column("text").to_pylist()]
        table.learn(texts)
        coded = [table.code(parts) for parts in texts]
        ends = np.cumsum([0, *(len(ids) for ids, _ in coded)])
        flat = np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in coded)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        decoded = pa.array([text for _, text in coded], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), ids, decoded], ["doc_id", "ids", "decoded"]
        )


def encode_decode(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, ids, decoded)``: the ids of each whole text and what they decode to."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        partial(_coded, model=model), f"doc_id {kind}, ids array<int>, decoded string"
    )
