"""LM scoring with a bigram model kept in Elias-Fano tries.

Tokens are the lower-cased (A-Z) words of a whole text and one end. The model is
interpolated absolute discounting,

    p(w | v) = max(c(v, w) - D, 0) / c(v) + D * n(v) / c(v) * p(w),
    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),

with c counts in the training texts, n(v) the number of distinct words after v,
N all and V distinct training tokens; an unseen context leaves p(w). The begin
of a text is a context of its own.

The trie is sharded by context. Units of documents count their own n-grams and
send every distinct one to its shard once, whether for training, for its score,
or both; the shard adds the counts up, builds its part of the trie with
quantised probabilities (a byte, in steps of 7/254 of a decimal power, rounded
down, so that the probabilities after a context never sum to more than one) and
answers with one byte for each n-gram asked. A context's weight D n(v) / c(v) is
quantised to two bytes. The steps of a context so frequent that its least value
lies below 1e-7 are as much wider as it takes to reach that value, so a code of 0
only stands for 0. Everything counts over all training texts; nothing is pruned.

Null texts are empty and score their end. A text of a null id counts as id ''.
Repeated rows count and score each by itself. 64-bit hashes stand for words, and
within a context 40 bits for the next word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import hashes, mixed, runs_of, slices, words
from docketflow.llm.elias_fano import SUCCESSOR_BITS, Trie, scratch
from docketflow.llm.units import in_order, in_units, pack, shard_of, unpack

DISCOUNT = 0.9
ADDED = 0.1
UNIT_BYTES = 8 * 1024 * 1024
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
STEP = 7 / 254
WEIGHT_STEP = 7 / 65534
_LOW = np.uint64((1 << SUCCESSOR_BITS) - 1)

_ASKED = pa.schema(
    [("unit", pa.int32()), ("shard", pa.int32()), ("ngrams", pa.binary())]
)
_ANSWERED = pa.schema([("unit", pa.int32()), ("shard", pa.int32()), ("found", pa.binary())])
_ASKED_SQL = "unit int, shard int, ngrams binary"
_ANSWERED_SQL = "unit int, shard int, found binary"


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 == 0


def steps(followed: np.ndarray, least: float, step: float, kind: type) -> np.ndarray:
    """Step of each context: ``step``, or wider if it takes that to reach ``least / followed``."""
    if not least:
        return np.full(len(followed), step)
    reach = np.log10(np.maximum(followed, 1) / least)
    return np.maximum(step, reach / (np.iinfo(kind).max - 1))


def pair_steps(followed: np.ndarray, discount: float) -> np.ndarray:
    return steps(followed, np.floor(discount) + 1 - discount, STEP, np.uint8)


def weight_steps(followed: np.ndarray, discount: float) -> np.ndarray:
    return steps(followed, discount, WEIGHT_STEP, np.uint16)


def quantised(p: np.ndarray, step: float | np.ndarray, kind: type) -> np.ndarray:
    """Codes of probabilities, rounded down; 0 stands for nothing at all."""
    top = np.iinfo(kind).max
    with np.errstate(divide="ignore"):
        code = np.floor(top + np.log10(p) / step + 1e-9)
    return np.where(p > 0, np.maximum(code, 1), 0).astype(kind)


def probability(code: np.ndarray, step: float | np.ndarray) -> np.ndarray:
    top = np.iinfo(code.dtype).max
    return np.where(code > 0, 10.0 ** ((code.astype(np.float64) - top) * step), 0.0)


def _join(*parts: np.ndarray) -> bytes:
    """Arrays in one text of bytes, each after its number of bytes."""
    packed = [pack(part) for part in parts]
    return np.array([len(x) for x in packed], np.int64).tobytes() + b"".join(packed)


def _split(data: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(kinds))
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [unpack(data[end - size : end], kind) for size, end, kind in zip(sizes, ends, kinds)]


class _Unit:
    """The distinct n-grams of a unit, in the order in which they are asked."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table = in_order(table)
        dictionary, codes, bounds = words(pc.ascii_lower(table["text"]))
        # Words by hash, so that they are sorted by shard; begin and end are words too.
        named = np.concatenate([hashes(dictionary), [BEGIN, END]])
        order = np.argsort(named)
        self.words = named[order]
        rank = np.empty(len(named), np.int64)
        rank[order] = np.arange(len(named))
        begin, end = rank[-2:]
        n_docs, n_words = len(bounds) - 1, len(codes)
        self.sizes = np.diff(bounds) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        last = self.starts + self.sizes - 1
        self.tokens = np.empty(n_words + n_docs, np.int64)
        is_end = np.zeros(len(self.tokens), bool)
        is_end[last] = True
        self.tokens[is_end] = end
        self.tokens[~is_end] = rank[codes]
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = begin
        self.trained = ~table["held_out"].to_numpy()
        learns = np.repeat(self.trained, self.sizes)
        self.word_counts = np.bincount(
            self.tokens[learns], minlength=len(self.words)
        ).astype(np.uint32)
        pair = before * len(self.words) + self.tokens
        order = np.argsort(pair)
        sorted_pairs = pair[order]
        first, runs = runs_of(sorted_pairs)
        self.pair_of = np.empty(len(pair), np.int64)
        self.pair_of[order] = np.repeat(np.arange(len(first)), runs)
        self.pair_counts = np.add.reduceat(learns[order].astype(np.uint32), first, dtype=np.uint32)
        self.before, self.after = np.divmod(sorted_pairs[first], len(self.words))
        # Successors ascend by their own bits within a context, as the trie keeps them.
        short = mixed(self.words)[self.after] & _LOW
        order = np.lexsort((short, self.before))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.pair_of = back[self.pair_of]
        self.before, self.after, self.short = self.before[order], self.after[order], short[order]
        self.pair_counts = self.pair_counts[order]

    def shards(self, n: int) -> Iterator[tuple[int, slice, slice]]:
        """Each shard that is asked, with its words and its pairs."""
        cuts = np.searchsorted(shard_of(self.words, n), np.arange(n + 1))
        pair_cuts = np.searchsorted(self.before, cuts)
        for k in range(n):
            if cuts[k + 1] > cuts[k]:
                yield k, slice(*cuts[k : k + 2]), slice(*pair_cuts[k : k + 2])


def _ask(table: pa.Table, n_shards: int) -> pa.Table:
    unit = _Unit(table)
    number = table["unit"][0].as_py()
    rows = {"unit": [], "shard": [], "ngrams": []}
    for shard, own, pairs in unit.shards(n_shards):
        per_word = np.bincount(unit.before[pairs] - own.start, minlength=own.stop - own.start)
        short = unit.short[pairs]
        rows["unit"].append(number)
        rows["shard"].append(shard)
        rows["ngrams"].append(
            _join(
                np.diff(unit.words[own], prepend=np.uint64(0)),
                unit.word_counts[own],
                per_word.astype(np.uint32),
                short.astype(np.uint32),
                (short >> np.uint64(32)).astype(np.uint8),
                unit.pair_counts[pairs],
            )
        )
    return pa.table(rows, schema=_ASKED)


def _asked(data: bytes) -> tuple[np.ndarray, ...]:
    gaps, counts, per_word, low, high, pair_counts = _split(
        data, np.uint64, np.uint32, np.uint32, np.uint32, np.uint8, np.uint32
    )
    short = (high.astype(np.uint64) << np.uint64(32)) | low
    return gaps.cumsum(dtype=np.uint64), counts, per_word.astype(np.int64), short, pair_counts


def _learn_and_answer(asked: pa.Table, discount: float) -> pa.Table:
    """Add up what the units sent to a shard, build its trie, look up what they asked."""
    sent = [_asked(data) for data in asked["ngrams"].to_pylist()]
    contexts, where = np.unique(np.concatenate([x[0] for x in sent]), return_inverse=True)
    counts = np.bincount(where, np.concatenate([x[1] for x in sent]), len(contexts))
    word_counts = counts.astype(np.int64)
    number = np.repeat(where, np.concatenate([x[2] for x in sent]))
    successors = np.concatenate([x[3] for x in sent])
    times = np.concatenate([x[4] for x in sent])
    learned = np.flatnonzero(times)
    order = learned[np.lexsort((successors[learned], number[learned]))]
    number_, successor_ = number[order], successors[order]
    new = np.ones(len(order), bool)
    new[1:] = (number_[1:] != number_[:-1]) | (successor_[1:] != successor_[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(times[order].astype(np.float64), first) if len(first) else np.zeros(0)
    number_, successor_ = number_[first], successor_[first]
    followed = np.bincount(number_, total, len(contexts))
    distinct = np.bincount(number_, minlength=len(contexts))
    with np.errstate(invalid="ignore", divide="ignore"):
        weight = np.where(followed > 0, discount * distinct / followed, 0)
    step = pair_steps(followed, discount)[number_]
    codes = quantised(np.maximum(total - discount, 0) / followed[number_], step, np.uint8)
    with scratch() as folder:
        trie = Trie.build(
            folder, contexts, number_, successor_,
            quantised(weight, weight_steps(followed, discount), np.uint16), codes,
        )
        rows = []
        for words_, _, per_word, short, _ in sent:
            at = trie.find_contexts(words_)
            rows.append(
                _join(
                    word_counts[at].astype(np.uint64),
                    trie.context_values[at],
                    trie.find(np.repeat(at, per_word), short),
                )
            )
        del trie
    return pa.table(
        {"unit": asked["unit"], "shard": asked["shard"], "found": rows}, schema=_ANSWERED
    )


def _score(
    table: pa.Table, found: pa.Table, n_shards: int, n_tokens: int, n_words: int, discount: float
) -> pa.Table:
    unit = _Unit(table)
    counts = np.zeros(len(unit.words), np.uint64)
    weights = np.zeros(len(unit.words), np.uint16)
    codes = np.zeros(len(unit.before), np.uint8)
    answers = dict(zip(found["shard"].to_pylist(), found["found"].to_pylist()))
    for shard, own, pairs in unit.shards(n_shards):
        counts[own], weights[own], codes[pairs] = _split(
            answers[shard], np.uint64, np.uint16, np.uint8
        )
    base = (counts.astype(np.float64) + ADDED) / (n_tokens + ADDED * (n_words + 1))
    # A word is followed as often as it is found, and a begin is as frequent as an end.
    followed = counts.astype(np.float64)
    followed[unit.words == BEGIN] = followed[unit.words == END]
    weight = probability(weights, weight_steps(followed, discount))
    weight[followed == 0] = 1.0  # a context that no training text has
    seen = probability(codes, pair_steps(followed, discount)[unit.before])
    pair = np.log10(seen + weight[unit.before] * base[unit.after])

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, unit.starts) if len(unit.starts) else values

    return pa.table(
        {
            "doc_id": unit.table["doc_id"],
            "held_out": unit.table["held_out"],
            "n_tokens": unit.sizes,
            "n_known": by_text((counts > 0).astype(np.int64)[unit.tokens]),
            "train_tokens": np.full(len(unit.sizes), n_tokens),
            "base_score": by_text(np.log10(base)[unit.tokens]),
            "score": by_text(pair[unit.pair_of]),
        }
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        dictionary, codes, bounds = words(pc.ascii_lower(batch.column("text")))
        named = np.append(hashes(dictionary), END).view(np.int64)
        counts = np.append(np.bincount(codes, minlength=len(dictionary)), len(bounds) - 1)
        yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(counts)], ["word", "n"])


def totals(texts: DataFrame) -> tuple[int, int]:
    """All and distinct tokens of the column ``text``."""
    counted = texts.mapInArrow(_count_words, "word long, n long").filter("n > 0")
    row = (
        counted.groupBy("word").agg(F.sum("n").alias("n"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    )
    return row["n"] or 0, row["v"]


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    discount: float = DISCOUNT,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """Counts, unigram score and model score of every text; a tenth is held out of training."""
    dealt, n = in_units(docs, doc_id, text, unit_bytes)
    dealt = dealt.withColumn("held_out", held_out("doc_id"))
    n_tokens, n_words = totals(dealt.filter(~F.col("held_out")).select("text"))
    by_unit = dealt.groupBy("unit")
    ask = partial(_ask, n_shards=n)
    learn = partial(_learn_and_answer, discount=discount)
    finish = partial(_score, n_shards=n, n_tokens=n_tokens, n_words=n_words, discount=discount)
    found = (
        by_unit.applyInArrow(lambda table: ask(table), _ASKED_SQL)
        .groupBy("shard")
        .applyInArrow(lambda table: learn(table), _ANSWERED_SQL)
    )
    kind = dealt.schema["doc_id"].dataType.simpleString()
    return by_unit.cogroup(found.groupBy("unit")).applyInArrow(
        lambda left, right: finish(left, right),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
