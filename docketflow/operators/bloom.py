"""Keeping the rows whose key may be among many others, before they are shuffled.

A Bloom filter in blocks: a key's hash names a block, a word of 64 bits in it and
four bits of that word. The bits are set by one aggregate over the keys and sent
to every task as one row for each block. A row of another key is kept now and then
(about one in fifty at BITS_PER_KEY bits), a row of one of the keys always, so the
filter may only stand before a join that decides. All of it are built-in
functions.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators import joins

BITS_PER_KEY = 12
# With fewer bits a key too many others pass.
LEAST_BITS_PER_KEY = 4
BITS_OF_KEY = 4
# bitmap_construct_agg fills 4,096 bytes: 512 words of a block.
BLOCK_WORDS = 512
BLOCK_BYTES = 8 * BLOCK_WORDS
_BLOCK, _WORDS = "__bloque_bloom", "__palabras"


class BloomFilter(NamedTuple):
    blocks: DataFrame  # block, words
    n_blocks: int


def bloom_filter(keys: DataFrame, count: int) -> BloomFilter | None:
    """The filter of the only column of ``keys``, of which there are at most ``count``.

    None if it would take more than ``joins.BROADCAST_BYTES`` or too few bits for each key.
    """
    most = joins.BROADCAST_BYTES // BLOCK_BYTES
    wanted = max(1, math.ceil(count * BITS_PER_KEY / (8 * BLOCK_BYTES)))
    n_blocks = min(wanted, most)
    if n_blocks < 1 or n_blocks * 8 * BLOCK_BYTES < LEAST_BITS_PER_KEY * count:
        return None
    (name,) = keys.columns
    block, word, shifts = _places(F.col(name), n_blocks)
    bits = keys.dropna().select(
        block.alias(_BLOCK), F.explode(F.array(*(_position(word, s) for s in shifts))).alias("bit")
    )
    maps = bits.groupBy(_BLOCK).agg(F.bitmap_construct_agg("bit").alias("mapa"))
    # Words by number instead of bytes, so that one of them is found at once.
    word_at = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)),
        lambda k: F.conv(F.hex(F.substring("mapa", k * 8 + 1, F.lit(8))), 16, -10).cast("bigint"),
    )
    return BloomFilter(maps.select(_BLOCK, word_at.alias(_WORDS)), n_blocks)


def with_bloom(df: DataFrame, key: str, keys: BloomFilter, flag: str) -> DataFrame:
    """``df`` with ``flag``: false only where the key is none of the filter's keys."""
    block, word, shifts = _places(F.col(key), keys.n_blocks)
    mask = F.lit(0).cast("bigint")
    for shift in shifts:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), shift))
    found = F.get(F.col(_WORDS), word).bitwiseAND(mask) == mask
    joined = df.withColumn(_BLOCK, block).join(F.broadcast(keys.blocks), _BLOCK, "left")
    return joined.select(*df.columns, F.coalesce(found, F.lit(False)).alias(flag))


def _places(key: Column, n_blocks: int) -> tuple[Column, Column, list[Column]]:
    """Block, word in the block, and the bits of the word, each as its number."""
    hashed = F.xxhash64(key)
    block = F.pmod(hashed, F.lit(n_blocks)).cast("int")
    other = F.xxhash64(F.lit(BLOCK_WORDS), key)
    word = F.pmod(other, F.lit(BLOCK_WORDS)).cast("int")
    shifts = [
        F.shiftrightunsigned(other, 16 + 8 * k).bitwiseAND(F.lit(63)).cast("int")
        for k in range(BITS_OF_KEY)
    ]
    return block, word, shifts


def _position(word: Column, shift: Column) -> Column:
    """Where bit ``shift`` of a word is in a bitmap, which is read from the high byte of a word."""
    byte = F.lit(7) - F.shiftright(shift, 3)
    return (word * 64 + byte * 8 + shift.bitwiseAND(F.lit(7))).cast("bigint")
