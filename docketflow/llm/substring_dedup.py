"""Substring dedup: remove passages of ``window`` words that occur elsewhere too.

Level-wise doubling. Two equal windows of 35 words share every shorter window
inside them, so only what is repeated at one length is extended to twice that
length, until the length is the window's or no candidate survives: 9, 18, 35.

At the first length each window is held by one anchor: the 9 words inside it
with the least hash, leftmost of equal ones. Equal windows have equal anchors,
so nothing is lost, and only about one position in fourteen is an anchor. At 18
words a surviving anchor is extended to the right if that stays inside the
window, else to the left. Windows whose extension survives are compared whole.

Windows are compared by 64-bit hashes, a new one at each length; a window is
taken for repeated by mistake only if all three collide. Windows never cross
documents. Equal rows repeat each other. Null and empty texts have no words,
texts shorter than the window lose none, and columns beside the id and the text
are ignored. Any length of text is read whole.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docketflow.llm.common import mixed, window_hashes
from docketflow.llm.units import (
    ANSWERED, ASKED, answer_repeats, ask_repeats, in_order, in_units, places_of, word_hashes,
)

WINDOW = 35
UNIT_BYTES = 8 * 1024 * 1024
_PLACE_BITS = 27  # a position in a unit; a unit of one longer text keeps its position in 32


class _Unit:
    """The words of a unit, its windows, and the anchor of each."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.table = in_order(table)
        self.window = window
        self.base = -(-window // 4)
        self.dictionary, hashes, self.codes, self.bounds = word_hashes(self.table["text"])
        self.hashes = hashes[self.codes]
        n = len(self.codes)
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        self.starts = np.flatnonzero(np.arange(n) + window <= ends)

    @property
    def unit(self) -> int:
        return self.table["unit"][0].as_py()

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the anchor's words at every position, the anchor of every window."""
        base = window_hashes(self.hashes, self.base)
        if not len(self.starts):
            return base, self.starts
        low = np.uint64((1 << max(_PLACE_BITS, int(len(base)).bit_length())) - 1)
        least = (base & ~low) | np.arange(len(base), dtype=np.uint64)
        width, size = self.window - self.base + 1, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        rest = width - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
        return base, (least & low)[self.starts].astype(np.int64)

    def extended(self, anchors: np.ndarray) -> np.ndarray:
        """Place of the extension that holds each window: twice its anchor, odd to the left."""
        left = anchors - self.starts > self.window - 2 * self.base
        return 2 * anchors + left


def _flags(n: int, places: np.ndarray) -> np.ndarray:
    flags = np.zeros(n, bool)
    flags[places] = True
    return flags


def _ask_anchors(table: pa.Table, window: int, n_shards: int) -> pa.Table:
    unit = _Unit(table, window)
    base, anchors = unit.anchors()
    used = np.flatnonzero(_flags(len(base), anchors))
    return ask_repeats(unit.unit, base[used], used, n_shards)


def _ask_doubled(table: pa.Table, found: pa.Table, window: int, n_shards: int) -> pa.Table:
    places = places_of(found)
    if not len(places) or not table.num_rows:
        return ask_repeats(0, np.zeros(0, np.uint64), places, n_shards)
    unit = _Unit(table, window)
    base, anchors = unit.anchors()
    alive = _flags(len(base), places)[anchors]
    used = np.flatnonzero(_flags(2 * len(base), unit.extended(anchors)[alive]))
    doubled = window_hashes(unit.hashes, 2 * unit.base)
    left = used % 2
    keys = mixed(doubled[used // 2 - left * unit.base] + left.astype(np.uint64))
    return ask_repeats(unit.unit, keys, used, n_shards)


def _ask_windows(
    table: pa.Table, found: pa.Table, window: int, n_shards: int, doubled: bool
) -> pa.Table:
    places = places_of(found)
    if not len(places) or not table.num_rows:
        return ask_repeats(0, np.zeros(0, np.uint64), places, n_shards)
    unit = _Unit(table, window)
    base, anchors = unit.anchors()
    at = unit.extended(anchors) if doubled else anchors
    used = unit.starts[_flags(2 * len(base), places)[at]]
    keys = window_hashes(unit.hashes, window)[used]
    return ask_repeats(unit.unit, keys, used, n_shards)


def _remove(table: pa.Table, found: pa.Table, window: int) -> pa.Table:
    unit = _Unit(table, window)
    n = len(unit.codes)
    places = places_of(found)
    edges = np.zeros(n + 1, np.int64)
    edges[places] = 1  # a window starts at a place once
    np.subtract.at(edges, places + window, 1)
    kept = np.cumsum(edges[:n]) == 0
    bounds = np.concatenate([[0], np.cumsum(kept)])[unit.bounds]
    taken = unit.dictionary.cast(pa.string()).take(pa.array(unit.codes[kept]))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), taken), " ")
    n_words = np.diff(unit.bounds)
    return pa.table(
        {
            "doc_id": unit.table["doc_id"],
            "n_words": n_words,
            "n_removed": n_words - np.diff(bounds),
            "kept": texts,
        }
    )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: each text without its repeated windows.

    ``kept`` are the remaining words joined by one space.
    """
    dealt, n = in_units(docs, doc_id, text, unit_bytes)
    by_unit = dealt.groupBy("unit")

    def answered(asked: DataFrame) -> DataFrame:
        return asked.groupBy("shard").applyInArrow(answer_repeats, ANSWERED)

    def ask_again(step, found: DataFrame, **options) -> DataFrame:
        ask = partial(step, window=window, n_shards=n, **options)
        return by_unit.cogroup(found.groupBy("unit")).applyInArrow(
            lambda left, right: ask(left, right), ASKED
        )

    first = partial(_ask_anchors, window=window, n_shards=n)
    found = answered(by_unit.applyInArrow(lambda table: first(table), ASKED))
    doubled = 2 * -(-window // 4) <= window
    if doubled:
        found = answered(ask_again(_ask_doubled, found))
    found = answered(ask_again(_ask_windows, found, doubled=doubled))
    kind = dealt.schema["doc_id"].dataType.simpleString()
    return by_unit.cogroup(found.groupBy("unit")).applyInArrow(
        lambda left, right: _remove(left, right, window),
        f"doc_id {kind}, n_words long, n_removed long, kept string",
    )
