"""Packing documents into sequences: bounded-space online best fit.

Each partition of the documents keeps at most ``OPEN_WINDOWS`` open windows of
2,048 tokens. A document that fits into a window is never cut here: it goes to
the open window it fills best, and where it fits into none, the fullest window is
emitted for a new one. A longer document is cut: its first piece fills the
fullest window that has room for ``LEAST_PIECE`` tokens, full windows follow, and
its last piece is placed like a whole document. Windows still open at the end are
the leftovers. They are merged in rounds of ``FAN_IN`` partitions by the same
rule, longest pieces first, until one task holds what is left of all: at most
``OPEN_WINDOWS`` windows, which are cut wherever a window is full. The last
remainder is cut at powers of two, so that it needs no padding either.

So padding is only in emitted windows into which nothing fitted any more. A task
holds its open windows and one slice of texts; the partitions' leftovers are
bounded by the number of windows, whatever the size of a source or text.

Words are encoded once for each distinct one of a worker's tasks, which share one table of
bounded size: the tokenizer must drop
white space and encode the words between it independently, and words of
ASCII and Latin-1 letters must fall into parts by one rule, which is checked against the library on samples
when it is loaded. A document's ids are followed by one end id. Null and
empty texts, and texts without ids, are that id alone. Texts of any length,
repeated rows and null ids are packed as they are; other columns are ignored. An
empty table has no pieces. The packing depends on the partitions' rows in their
order; a task that is computed again packs alike, and each round is stored.
"""

from __future__ import annotations

import os
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import slices, words, written

SEQUENCE_TOKENS = 2048
END_ID = 1
OPEN_WINDOWS = 64
LEAST_PIECE = 16
# Partitions whose leftovers one task merges: 64 * 64 windows of 8 KB.
FAN_IN = 64
# Entries after which a worker starts a new table of words; this bounds memory only.
TABLE_ENTRIES = 400_000
# A sequence's id: the round, the task in it, the number in the task.
ROUND_BITS, TASK_BITS = 58, 32


# A word of ASCII and Latin-1 letters alone is cut into parts by rule, each encoded on its own.
PLAIN_WORD = r"^[\x21-\x7E\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
PART = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ a-z0-9\x{DF}-\x{F6}\x{F8}-\x{FF}]+)"


def gathered(
    flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` that ``codes`` name, one after the other, and where each starts.

    Stretch k has the ``lengths[k]`` elements after those of the stretches before it. The last
    number of the starts is the end.
    """
    own = lengths[codes]
    starts = np.concatenate([[0], np.cumsum(own)])
    first = np.cumsum(lengths) - lengths
    at = np.repeat(first[codes] - starts[:-1], own)
    at += np.arange(starts[-1])
    return flat[at], starts


class _Ids:
    """The ids of each distinct text that was asked for, learnt when it is first met."""

    def __init__(self, learn) -> None:
        self.learn, self.known = learn, {}

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if len(self.known) > TABLE_ENTRIES:
            self.known.clear()
        new = [text for text in texts if text not in self.known]
        for text, ids in zip(new, self.learn(new)):
            self.known[text] = array("I", ids).tobytes()
        found = [self.known[text] for text in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), lengths


class WordTable:
    """Ids of words by a table of the distinct ones.

    Words of ASCII and Latin-1 letters are cut into parts (contractions, letters, digits, other marks) and each
    distinct part is encoded once; other words are encoded whole, once each.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # How the model spells letters beyond ASCII, which are several bytes each.
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelt = {k: spell(chr(k))[0][0] for k in range(0xDF, 0x100) if chr(k).isalpha()}
        self.parts = _Ids(self._ids_of_parts)
        self.words = _Ids(lambda new: [x.ids for x in self._library(new)])
        self._check()

    def _library(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def _ids_of_parts(self, parts: list[str]) -> list[list[int]]:
        tokenize, spelt = self.tokenizer.model.tokenize, self.spelt
        return [
            [x.id for x in tokenize(part if part.isascii() else part.translate(spelt))]
            for part in parts
        ]

    def _check(self) -> None:
        """Whether this tokenizer does drop white space and cut plain words by the rule."""
        marks = [chr(k) for k in (*range(0x21, 0x7F), *range(0xC0, 0x100))]
        pairs = [f"{a}{b}" for a in ("'", "-", "aB", "7", ".") for b in marks]
        contracted = "it's 'S --'s I'LL 'veto don't 've'd 're'm a'l 'l x''s 12's"
        texts = [
            "a b", " a\n\tb  ", "x1 'S.\x0b\u0301e \x0c\u1112\u1161\u11ab\r-", " ".join(marks),
            "".join(marks), " ".join(pairs), "".join(pairs), contracted, *self.special,
        ]
        ids, bounds = self.encode(pa.array(texts))
        if any(
            whole.ids != ids[a:b].tolist()
            for whole, a, b in zip(self._library(texts), bounds, bounds[1:])
        ):
            raise ValueError("this tokenizer does not encode words independently")

    def _words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the distinct words one after the other, and how many each has."""
        plain = pc.match_substring_regex(distinct, PLAIN_WORD)
        for content in self.special:
            plain = pc.and_not(plain, pc.match_substring(distinct, content))
        cut = pc.replace_substring_regex(pc.utf8_lower(distinct.filter(plain)), PART, r" \1 ")
        part_names, part_codes, bounds = words(cut)
        ids, lengths = self.parts.of(part_names.to_pylist())
        ids, starts = gathered(ids, lengths, part_codes)
        others, other_lengths = self.words.of(distinct.filter(pc.invert(plain)).to_pylist())
        # Plain words come first in the ids; each word is then taken at its own place.
        is_plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.concatenate([np.diff(starts[bounds]), other_lengths])
        place = np.empty(len(distinct), np.int64)
        place[np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])] = np.arange(
            len(distinct)
        )
        ids, _ = gathered(np.concatenate([ids, others]), sizes, place)
        return ids, sizes[place]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text starts and ends."""
        dictionary, codes, bounds = words(texts)
        ids, starts = gathered(*self._words(dictionary), codes)
        return ids, starts[bounds]


@lru_cache(maxsize=1)
def word_table(tokenizer: str) -> WordTable:
    """The table of this process: one for each task would pile up in a worker of many small tasks."""
    return WordTable(tokenizer)


class Piece:
    """Tokens of one document: they start after its first ``start`` ids."""

    __slots__ = ("doc_id", "start", "tokens", "doc_tokens")

    def __init__(self, doc_id, start: int, tokens: np.ndarray, doc_tokens: int) -> None:
        self.doc_id, self.start, self.tokens, self.doc_tokens = doc_id, start, tokens, doc_tokens

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.tokens[:length], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + length, self.tokens[length:], self.doc_tokens)


class Packer:
    """Open windows, ordered by the room they have left."""

    def __init__(self, first_id: int, size: int, open_windows: int) -> None:
        self.next_id, self.size, self.most = first_id, size, open_windows
        self.rooms: list[tuple[int, int]] = []
        self.windows: dict[int, list[Piece]] = {}
        self.rows: list[tuple] = []

    def emit(self, pieces: list[Piece], open_: bool = False) -> None:
        """A sequence of these pieces, as rows."""
        offset = 0
        for piece in pieces:
            n = len(piece.tokens)
            tokens = piece.tokens.astype("<u4").tobytes()
            self.rows.append(
                (piece.doc_id, piece.start, n, piece.doc_tokens, self.next_id, offset, tokens, open_)
            )
            offset += n
        self.next_id += 1

    def _put(self, piece: Piece, room: int, window: list[Piece], key: int) -> None:
        window.append(piece)
        room -= len(piece.tokens)
        if room:
            self.windows[key] = window
            insort(self.rooms, (room, key))
        else:
            self.emit(window)

    def place(self, piece: Piece) -> None:
        """A piece no longer than a window goes where it leaves least room."""
        at = bisect_left(self.rooms, (len(piece.tokens), -1))
        if at < len(self.rooms):
            room, key = self.rooms.pop(at)
            self._put(piece, room, self.windows.pop(key), key)
            return
        if len(self.rooms) >= self.most:
            _, key = self.rooms.pop(0)
            self.emit(self.windows.pop(key))
        key = max(self.windows, default=-1) + 1
        self._put(piece, self.size, [], key)

    def add(self, piece: Piece) -> None:
        """A document: placed whole, or cut if it is longer than a window."""
        if len(piece.tokens) > self.size:
            at = bisect_left(self.rooms, (LEAST_PIECE, -1))
            if at < len(self.rooms):
                room, key = self.rooms.pop(at)
                head, piece = piece.cut(room)
                self._put(head, room, self.windows.pop(key), key)
        while len(piece.tokens) > self.size:
            head, piece = piece.cut(self.size)
            self.emit([head])
        self.place(piece)

    def leave(self) -> None:
        """The open windows as leftovers, the fullest first."""
        for _, key in self.rooms:
            self.emit(self.windows.pop(key), open_=True)
        self.rooms = []

    def finish(self) -> None:
        """The open windows one after the other, cut where a sequence is full."""
        rest = [piece for _, key in self.rooms for piece in self.windows.pop(key)]
        self.rooms = []
        left = sum(len(piece.tokens) for piece in rest)
        while left:
            room = min(self.size, 1 << (left.bit_length() - 1))
            left -= room
            sequence = []
            while room:
                piece = rest.pop(0)
                if len(piece.tokens) > room:
                    piece, after = piece.cut(room)
                    rest.insert(0, after)
                sequence.append(piece)
                room -= len(piece.tokens)
            self.emit(sequence)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _fields(kind: pa.DataType) -> pa.Schema:
    long = pa.int64()
    return pa.schema([
        ("doc_id", kind), ("start", long), ("length", long), ("doc_tokens", long),
        ("sequence_id", long), ("offset", long), ("tokens", pa.binary()), ("open", pa.bool_()),
    ])


def _arrays(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return [pa.array(column, field.type) for column, field in zip(columns, schema)]


def _packed(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, size: int, open_windows: int
) -> Iterator[pa.RecordBatch]:
    table = word_table(tokenizer)
    packer = Packer(TaskContext.get().partitionId() << TASK_BITS, size, open_windows)
    schema = None
    for batch in slices(batches, "text"):
        schema = schema or _fields(batch.schema.field("doc_id").type)
        ids, bounds = table.encode(batch.column("text"))
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), bounds, bounds[1:]):
            tokens = np.append(ids[a:b], np.uint32(end_id))
            packer.add(Piece(doc_id, 0, tokens, len(tokens)))
        yield pa.RecordBatch.from_arrays(_arrays(packer.taken(), schema), schema=schema)
    if schema is not None:
        packer.leave()
        yield pa.RecordBatch.from_arrays(_arrays(packer.taken(), schema), schema=schema)


def _merger(turn: int, last: bool, size: int, open_windows: int):
    """Packs the leftovers of a group of tasks; the last group leaves none."""

    def merged(key: tuple[pa.Scalar], leftovers: pa.Table) -> pa.Table:
        first_id = (turn << ROUND_BITS) + (key[0].as_py() << TASK_BITS)
        packer = Packer(first_id, size, open_windows)
        rows = leftovers.sort_by(
            [("length", "descending"), ("sequence_id", "ascending"), ("offset", "ascending")]
        )
        names = ("doc_id", "start", "tokens", "doc_tokens")
        for doc_id, start, tokens, total in zip(*(rows[name].to_pylist() for name in names)):
            packer.place(Piece(doc_id, start, np.frombuffer(tokens, "<u4"), total))
        packer.finish() if last else packer.leave()
        schema = _fields(leftovers.schema.field("doc_id").type)
        return pa.Table.from_arrays(_arrays(packer.taken(), schema), schema=schema)

    return merged


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    size: int = SEQUENCE_TOKENS,
    open_windows: int = OPEN_WINDOWS,
    fan_in: int = FAN_IN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, doc_tokens, sequence_id, offset, tokens``.

    ``start`` counts the ids of the document before the piece, ``offset`` those of
    the sequence; ``tokens`` are the ids as little-endian unsigned 32-bit numbers.
    ``size`` must be a power of two for the remainder to need no padding.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    shape = (
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long,"
        " tokens binary, open boolean"
    )
    limits = {"size": size, "open_windows": open_windows}
    first = partial(_packed, tokenizer=tokenizer, end_id=end_id, **limits)
    rounds = [written(narrow.mapInArrow(first, shape), "packing")]
    task = F.shiftright(F.col("sequence_id"), TASK_BITS).bitwiseAND(F.lit((1 << 26) - 1))
    last = False
    while not last:
        leftovers = rounds[-1].filter("open")
        tasks = 1 + (leftovers.agg(F.max(task)).first()[0] or 0)
        last = tasks <= fan_in
        groups = leftovers.groupBy(F.floor(task / F.lit(fan_in)).cast("long").alias("group"))
        merged = groups.applyInArrow(_merger(len(rounds), last, **limits), shape)
        rounds.append(written(merged, "packing"))
    whole = rounds[0].filter("not open")
    for later in rounds[1:]:
        whole = whole.unionByName(later.filter("not open"))
    return whole.drop("open")
