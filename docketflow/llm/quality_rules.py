"""Quality rules by compression bands.

How well zstandard compresses a text tells repetition (far too well) and noise
(hardly at all) from prose. The ratio, compressed by plain size in bytes, is
taken of the whole text and of its chunks of fixed size; both must lie in the
band of their size. What is left at the end is a chunk too: it is judged by the
band of its own length, and as the end of the last bytes of full chunk size.

Null and empty texts, and texts without words, have zero counts, fail the base
rules and are not kept. Repeated rows each get their own row. Every column but
the id and the text is ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.2
# (bytes from, least ratio, greatest ratio). Prose of several languages was measured: a
# hundredth of it lies below 0.50, 0.46, 0.43, 0.40 at 512, 1,024, 4,096 and 16,384 bytes,
# and a hundredth above 0.67, 0.59, 0.51, 0.44. Encoded or random bytes stay above 0.7 where
# prose does not, and below 256 bytes the ratio says little.
BANDS = (
    (0, 0.0, float("inf")),
    (256, 0.25, 0.95),
    (512, 0.30, 0.85),
    (1024, 0.28, 0.75),
    (4096, 0.25, 0.70),
    (16384, 0.20, 0.65),
)
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_TRAILING = bytes(range(0x80, 0xC0))

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, ratio double, bad_chunks double"
)


def in_band(size: int, ratio: float) -> bool:
    low, high = next((low, high) for start, low, high in reversed(BANDS) if size >= start)
    return low <= ratio <= high


def repeated_words(words: list[bytes], length: int = 3) -> int:
    """Words covered by windows of so many words that are found twice or more."""
    windows = list(zip(*(words[k:] for k in range(length))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + length - max(start, end)
            end = start + length
    return covered


def bad_chunks(text: bytes, compress) -> float:
    """Share of the chunks out of their band."""
    bad = []
    for start in range(0, len(text), CHUNK_BYTES):
        chunk = text[start : start + CHUNK_BYTES]
        judged = [chunk]
        if start and len(chunk) < CHUNK_BYTES:  # a short rest alone says little
            judged.append(text[-CHUNK_BYTES:])
        bad.append(not all(in_band(len(x), len(compress(x)) / len(x)) for x in judged))
    return sum(bad) / len(bad) if bad else 0.0


def rules(text: bytes | None, compress) -> tuple:
    """All columns of SCHEMA for one text."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    ratio = len(compress(text)) / len(text) if text else 0.0
    bad_share = bad_chunks(text, compress)
    return (
        len(words),
        len(text.translate(None, _SPACE + _TRAILING)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        n_repeat,
        failed,
        not failed and in_band(len(text), ratio) and bad_share <= MAX_BAD_CHUNKS,
        ratio,
        bad_share,
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.large_binary())
        columns = zip(*(rules(text.as_py(), compress) for text in texts))
        kept = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "text"]
        left = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns)], [*left, *names])


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id of each document with the columns of SCHEMA, in one pass without a shuffle."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(_rows, f"doc_id {kind}, {SCHEMA}")


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    verdict = [field.split()[0] for field in SCHEMA.split(", ")].index("kept")
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.large_binary())
        yield batch.filter(pa.array([rules(x.as_py(), compress)[verdict] for x in texts]))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; the text is in the column ``text``."""
    return docs.mapInArrow(_keep, docs.schema)
