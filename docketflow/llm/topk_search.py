"""Exact top-k search by inner product with distributed histogram selection.

Components become integers floor(256 x). Every query is scored against every
candidate, block by block: queries are dealt to groups, candidates packed into
blocks, and each block meets each group once. A round scores everything and
counts scores in 4,096 equal bins of the range in which a query's k-th best
score is known to lie; the next round divides the bin that holds it. Once bins
are one wide the k-th score is known exactly. A last pass returns the scores
above it and, of those equal to it, the ones with the smallest ids.

A block counts only bins from its own k-th best score on, as the k-th best of
all cannot be lower, so a round sends a few counts for each query and block
however large a block or a group of equal vectors is.

Vectors that are null or hold a null, NaN or infinite component take no part,
nor do rows without an id. Vectors are compared with those of their own length
only. A query's own row, that is every row of its id, is no candidate. A row
that repeats a query is a query again, and repeated candidates are candidates
each. Scores beyond 64 bits are held at the limits of a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.common import cut

SCALE = 256
BINS = 4096
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
_LONG = np.iinfo(np.int64)

# Candidate blocks of a slice, where there are enough for every core to have some slices.
SLICE_BLOCKS = 32
SLICES_PER_CORE = 4


def integer_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vector array<long>, dim)`` of the rows that take part."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return rows.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(SCALE * x.cast("double"))).alias("vector"),
        F.size(vector).alias("dim"),
    )


def _packed(
    batches: Iterator[pa.RecordBatch], block: int, kept: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    """Rows of at most ``block`` vectors of one length (and of one query group)."""
    for batch in batches:
        ids = batch.column("vec_id").to_numpy()
        dims = batch.column("dim").to_numpy()
        groups = batch.column("part").to_numpy() if "part" in kept else np.zeros_like(dims)
        for dim, group in np.unique(np.stack([dims, groups]), axis=1).T:
            own = np.flatnonzero((dims == dim) & (groups == group))
            flat = batch.column("vector").take(pa.array(own)).flatten().to_numpy()
            matrix = flat.reshape(len(own), dim).astype(np.int64)
            for at in range(0, len(own), block):
                rows = slice(at, at + block)
                values = {
                    "part": int(group), "dim": int(dim),
                    "ids": ids[own[rows]].tobytes(), "vectors": matrix[rows].tobytes(),
                }
                yield pa.RecordBatch.from_pylist(
                    [{name: values[name] for name in kept}],
                    pa.schema([(name, _ARROW[name]) for name in kept]),
                )


_ARROW = {"part": pa.int32(), "dim": pa.int32(), "ids": pa.binary(), "vectors": pa.binary()}


def _matrix(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(vectors, np.int64).reshape(len(numbers), dim)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (queries, candidates)]
    bound = largest[0] * largest[1] * queries.shape[1]
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    if bound <= _LONG.max:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.T.astype(object)
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each pair of blocks with its scores, own rows masked out."""
    for batch in batches:
        for row in batch.to_pylist():
            query_ids, queries = _matrix(row["ids"], row["vectors"], row["dim"])
            ids, candidates = _matrix(row["c_ids"], row["c_vectors"], row["dim"])
            low = np.frombuffer(row["low"], np.int64)
            yield row, query_ids, ids, low, scores(queries, candidates), query_ids[:, None] != ids


def _count(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for row, query_ids, ids, low, score, other in _pairs(batches):
        step = row["step"]
        floor = low
        if len(ids) > k:
            masked = np.where(other, score, _LONG.min)
            floor = np.maximum(low, np.partition(masked, -k, axis=1)[:, -k])
        # Distances as unsigned numbers, which a range of all longs does not overflow.
        far = score.view(np.uint64) - low.view(np.uint64)[:, None]
        bins = far // np.uint64(step)
        counted = other & (score >= floor[:, None]) & (bins < BINS)
        query, candidate = np.nonzero(counted)
        key, n = np.unique(query * BINS + bins[query, candidate].astype(np.int64), return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([row["block"]] * len(key), pa.int64()),
                "query": pa.array(key // BINS, pa.int32()),
                "bin": pa.array(key % BINS, pa.int32()),
                "n": pa.array(n, pa.int64()),
            }
        )


def _narrow(state: pa.Table, counts: pa.Table, k: int) -> pa.Table:
    """The part of each query's range that holds its k-th best score, one bin of the last."""
    row = state.to_pylist()[0]
    low = np.frombuffer(row["low"], np.int64).copy()
    above = np.frombuffer(row["above"], np.int64).copy()
    query = counts["query"].to_numpy()
    bins = counts["bin"].to_numpy()
    order = np.lexsort((-bins, query))
    query, bins, n = query[order], bins[order], counts["n"].to_numpy()[order]
    starts = np.searchsorted(query, np.arange(len(low) + 1))
    for q, (a, b) in enumerate(zip(starts, starts[1:])):
        running = above[q] + np.cumsum(n[a:b])
        at = int(np.searchsorted(running, k))
        if a + at < b:
            above[q] = running[at] - n[a + at]
            low[q] = (low[q : q + 1].view(np.uint64) + np.uint64(int(bins[a + at]) * row["step"])).view(np.int64)[0]
    row |= {"low": low.tobytes(), "above": above.tobytes(), "step": max(1, row["step"] // BINS)}
    return pa.Table.from_pylist([row], state.schema)


def _best(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for row, query_ids, ids, low, score, other in _pairs(batches):
        query, candidate = np.nonzero(other & (score >= low[:, None]))
        found = score[query, candidate]
        order = np.lexsort((ids[candidate], ~found, query))  # ~ descends without overflow
        query, candidate, found = query[order], candidate[order], found[order]
        first = np.searchsorted(query, query)
        kept = np.arange(len(query)) - first < k
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([row["block"]] * int(kept.sum()), pa.int64()),
                "query": pa.array(query[kept], pa.int32()),
                "query_id": query_ids[query[kept]],
                "vec_id": ids[candidate[kept]],
                "score": found[kept],
            }
        )


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the k best candidates of each query."""
    spark = rows.sparkSession
    narrow = rows.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("asks")
    )
    asks = integer_vectors(narrow.filter("asks"), "vec_id", "vector")
    vectors = integer_vectors(narrow, "vec_id", "vector")
    n_parts = max(1, -(-asks.count() // QUERY_BLOCK))
    dealt = asks.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_parts)).cast("int"))
    names = ("part", "dim", "ids", "vectors")
    queries = dealt.repartition(n_parts, "part").mapInArrow(
        partial(_packed, block=QUERY_BLOCK, kept=names), "part int, dim int, ids binary, vectors binary"
    )
    candidates = cut(vectors.mapInArrow(
        partial(_packed, block=CANDIDATE_BLOCK, kept=names[1:]), "dim int, ids binary, vectors binary"
    )).select("dim", F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
    largest = vectors.select(
        F.array_max(F.transform("vector", lambda x: F.abs(x.cast("decimal(20,0)")))).alias("x"), "dim"
    ).agg(F.max("x"), F.max("dim")).first()
    # No score is further from 0 than this.
    bound = min(int(largest[0] or 0) ** 2 * (largest[1] or 0), _LONG.max)
    step = 1
    while step * BINS < 2 * bound + 2:
        step *= BINS
    n = F.octet_length("ids") / 8
    states = cut(queries.withColumn("block", F.monotonically_increasing_id())).select(
        "*",
        _repeated(-bound - 1, n).alias("low"),
        _repeated(0, n).alias("above"),
        F.lit(step).cast("long").alias("step"),
    )
    # Candidates stay in their slice; the smaller side, the query blocks, goes to every slice.
    n_blocks = max(1, candidates.count())
    cores = spark.sparkContext.defaultParallelism
    n_slices = max(min(n_blocks, SLICES_PER_CORE * cores), n_blocks // SLICE_BLOCKS)
    slice_of = F.pmod(F.xxhash64("c_ids"), F.lit(n_slices)).cast("int")
    sliced = candidates.withColumn("slice", slice_of).repartition(n_slices, "slice", "dim")
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)))

    def scored(state: DataFrame, function, schema: str) -> DataFrame:
        met = sliced.join(state.withColumn("slice", every_slice), ["slice", "dim"]).select(
            "block", "ids", "vectors", "dim", "c_ids", "c_vectors", "low", "step"
        )
        return met.mapInArrow(partial(function, k=k), schema)

    kept = "part int, dim int, ids binary, vectors binary, block long, low binary, above binary, step long"
    narrow_down = partial(_narrow, k=k)
    while True:
        counts = (
            scored(states, _count, "block long, query int, bin int, n long")
            .groupBy("block", "query", "bin").agg(F.sum("n").alias("n"))
        )
        states = cut(
            states.groupBy("block").cogroup(counts.groupBy("block"))
            .applyInArrow(lambda left, right: narrow_down(left, right), kept)
        )
        if step == 1:
            break
        step //= BINS
    best = scored(states, _best, "block long, query int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _repeated(value: int, n: Column) -> Column:
    """So many 64-bit numbers as bytes."""
    text = np.array([value], np.int64).tobytes().hex()
    return F.unhex(F.repeat(F.lit(text), n.cast("int")))
