"""What the operators share: reading words, slicing batches, cutting lineage."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

# A word is a run of characters other than these six; bytes.split() splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 * 1024 * 1024


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share.

    It is the one of ``spark.checkpoint.dir``; only a session without it, as in
    a test, gets one below its warehouse.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{warehouse}/checkpoints"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows read from a checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about SLICE_BYTES of a text column, a longer text alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        parts = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(parts, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def words(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the number of each word in it, and where each text starts and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # without rows
        texts = pa.array([], pa.string())
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = bounds - bounds[:1] if len(bounds) else np.zeros(1, np.int64)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # text starts or ends with white space, or has no word
        kept = codes != empty
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        codes = codes[kept]
    return coded.dictionary, codes, bounds


def hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(x) for x in values.cast(pa.large_binary()).to_pylist()), np.uint64, len(values)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly over all bits, one to one (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def window_hashes(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words from each position on, as far as there are so many."""
    n = len(word_hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up = np.full(len(word_hashes), _STEP, np.uint64)
    down = np.full(len(word_hashes), _BACK, np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(word_hashes * up)])
    return mixed((sums[length:] - sums[:n]) * down[:n] + np.uint64(length))


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))[: len(values)]
    return starts, np.diff(np.append(starts, len(values)))


def piece_model() -> str:
    """The SentencePiece model of the registered queries, from the installed public package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer() -> str:
    """The tokenizer of the packing query, from the installed public package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read from Parquet in the shared folder: smaller than a checkpoint."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
