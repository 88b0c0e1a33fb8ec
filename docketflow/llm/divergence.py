"""How the sources of a language diverge in their words, by run-length columns.

Terms are runs of ASCII letters and non-ASCII characters, with only A-Z
lower-cased. A language keeps the terms that at least ``min_docs`` of its
documents contain. With V kept terms, and N the sum of a group's counts over
them, a term counted c times has the weight

    p = 1 + floor(10**9 * (c + 2) / (N + 2 * V))

in a (language, source) group, and likewise in the whole language. Two weights
differ by f = floor((p - q)**2 / (p + q)). A pair of sources differs by the sum
of f over the kept terms; terms are listed where a group uses them more than its
language does.

For the pairs, the vocabulary of a language is reordered by the counts of its
terms in all sources, so that equal counts lie side by side, and cut into blocks.
Within a block each group's column of counts is run-length encoded. The run
boundaries of two columns are intersected, and f is taken once for each common
run and multiplied by its length. Blocks are summed up by pair.

Weights are exact: whole numbers of any size for the few distinct counts of a
column (numpy), decimals of 38 digits in Spark. A document's terms are counted
within the task that reads it, so a frequent word or a source with a third of all
rows reaches the shuffle as one count from each slice of texts. A term has one row
with its counts by source, of which there are at most as many as the result has
pairs for one source. Nothing is sampled, and terms of any frequency count.

Null languages, sources and texts are read as empty. A group without any term, of
empty texts or in a language without kept terms, takes part with N = 0; in a
language with V = 0 every pair differs by 0. Very long texts are read whole,
repeated rows count as often as they occur, ties of a value go to the smaller
item by its UTF-8 bytes, and an empty table has no groups and no rows. Columns
other than the three named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.common import cut, runs_of, slices, written
from docketflow.operators.joins import fits_broadcast

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 10**9
# What is no part of a term; the pattern keeps ASCII letters and all beyond ASCII.
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
# Counts in the columns of a block of the vocabulary; bounds what a task holds.
BLOCK_COUNTS = 4_000_000

# Sources whose counts decide in which range of the vocabulary a term lies.
LEADING_COUNTS = 2

COUNTED = "lang string, source string, term string, count long, docs long"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms, the number of each term in it, and the text each one is in."""
    parts = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.large_string()), ""), NO_TERM)
    text_of = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    flat = pc.ascii_lower(parts.flatten())
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    return (
        coded.dictionary,
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        text_of[real.to_numpy(zero_copy_only=False)],
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by group and term of each slice of texts; a null term stands for the group itself."""
    for batch in slices(batches, "text"):
        groups = pa.Table.from_batches([batch.select(["lang", "source"])]).group_by(
            ["lang", "source"]
        ).aggregate([])
        known = {tuple(g.values()): k for k, g in enumerate(groups.to_pylist())}
        pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        group_of = np.fromiter((known[pair] for pair in pairs), np.int64, batch.num_rows)
        names, codes, text_of = terms_of(batch.column("text"))
        in_text = np.unique(text_of * len(names) + codes)
        size = max(1, len(names))
        keys, counts = np.unique(group_of[text_of] * size + codes, return_counts=True)
        in_group = group_of[in_text // size] * size + in_text % size
        docs = np.bincount(np.searchsorted(keys, in_group), minlength=len(keys))
        own = np.arange(len(known))
        at = pa.array(np.concatenate([own, keys // size]))
        term = pa.concat_arrays([
            pa.nulls(len(own), names.type), names.take(pa.array(keys % size)),
        ]).cast(pa.string())
        nothing = np.zeros(len(own), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                groups["lang"].combine_chunks().take(at), groups["source"].combine_chunks().take(at),
                term, pa.array(np.concatenate([nothing, counts])),
                pa.array(np.concatenate([nothing, docs])),
            ],
            ["lang", "source", "term", "count", "docs"],
        )


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, count, docs)`` of all terms, and a row without term for each group."""
    plain = docs.select(
        *(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source")),
        F.col("text").cast("string").alias("text"),
    )
    return plain.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )


def weight(count: Column, total: Column, n_terms: Column) -> Column:
    """p as a long; the product goes beyond that type and is a decimal."""
    product = (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + 2 * n_terms).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", product, below)


def gap(p: Column, q: Column) -> Column:
    """f of two weights, which are at most 10**9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def encoded(at: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of a column that is 0 but for ``counts`` at the places ``at``."""
    column = np.zeros(length, np.int64)
    column[at] = counts
    starts, _ = runs_of(column)
    return starts, column[starts]


def weights(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """p of each count, computed once for each distinct one."""
    distinct, place = np.unique(counts, return_inverse=True)
    below = total + 2 * n_terms
    exact = [1 + SCALE * (int(c) + 2) // below for c in distinct]
    return np.array(exact, np.int64)[place]


def differ(a: tuple, b: tuple, length: int) -> int:
    """The sum of f over the positions of two columns ``(run starts, weights)``."""
    starts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(np.append(starts, length))).sum())


def _block_pairs(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """The part of one block of the vocabulary in each pair of sources, each pair once."""
    groups, terms = groups.sort_by("source"), terms.sort_by("place")
    counts = terms["counts"].combine_chunks()
    place = np.repeat(np.arange(len(counts)), pc.list_value_length(counts).to_numpy())
    found = counts.flatten()
    count, names = found.field("count").to_numpy(), groups["source"].combine_chunks()
    source = pc.index_in(found.field("source"), value_set=names).to_numpy()
    order = np.argsort(source, kind="stable")
    cuts = np.searchsorted(source[order], np.arange(len(names) + 1))
    columns = []
    for k, (total, n_terms) in enumerate(
        zip(groups["total"].to_pylist(), groups["n_terms"].to_pylist())
    ):
        own = order[cuts[k] : cuts[k + 1]]
        starts, values = encoded(place[own], count[own], len(counts))
        columns.append((starts, weights(values, total, n_terms)))
    langs, names = groups["lang"].to_pylist(), names.to_pylist()
    rows = [
        (langs[a], names[a], names[b], differ(columns[a], columns[b], len(counts)))
        for a in range(len(names))
        for b in range(a + 1, len(names))
    ]
    fields = [("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())]
    arrays = zip(*rows) if rows else [[]] * len(fields)
    return pa.Table.from_arrays(
        [pa.array(x, kind) for x, (_, kind) in zip(arrays, fields)], schema=pa.schema(fields)
    )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: see the contract of the two parts.

    ``pair``: every other source of the language with the value of the pair.
    ``term``: the ``top_terms`` kept terms by f that the group has and uses more
    than its language.
    """
    counts = written(term_counts(docs), "divergence-counts")
    vocabulary = written(
        counts.filter("term is not null")
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.array_sort(F.collect_list(F.struct("source", "count"))).alias("counts"),
        )
        .filter(F.col("docs") >= min_docs)
        .drop("docs"),
        "divergence-terms",
    )
    groups = _group_sizes(counts, vocabulary)
    both = _pairs(vocabulary, groups).unionByName(_terms(vocabulary, groups, top_terms))
    return both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def _group_sizes(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(lang, source, total, n_terms, lang_total)`` of every group: N, V, and N of the language."""
    used = vocabulary.select("lang", F.explode("counts").alias("own")).groupBy(
        "lang", F.col("own.source").alias("source")
    ).agg(F.sum("own.count").alias("total"))
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    every = counts.filter("term is null").select("lang", "source")
    nothing = F.lit(0).cast("long")
    known = every.join(used, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", nothing).alias("total"),
        F.coalesce("n_terms", nothing).alias("n_terms"),
    )
    of_lang = known.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    return cut(known.join(of_lang, "lang"))


def _pairs(vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    block_terms = max(1, BLOCK_COUNTS // most)
    blocks = written(
        # The leading counts decide the range: whole rows of counts would make long sampled keys.
        vocabulary.repartitionByRange("lang", F.slice("counts", 1, LEADING_COUNTS), "term")
        .sortWithinPartitions("lang", "counts", "term")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("block", F.expr(f"place div {block_terms}"))
        .select("lang", "block", "place", "counts"),
        "divergence-blocks",
    )
    # Under other names, as either side of a cogroup must have its own columns.
    of_block = (
        blocks.select(F.col("lang").alias("of_lang"), F.col("block").alias("of_block"))
        .distinct()
        .join(groups, F.col("of_lang") == F.col("lang"))
    )
    parts = (
        blocks.groupBy("lang", "block")
        .cogroup(of_block.groupBy("of_lang", "of_block"))
        .applyInArrow(_block_pairs, "lang string, a string, b string, value long")
    )
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # A language without kept terms has no block; its pairs differ by nothing.
    bare = groups.filter("n_terms = 0")
    others = bare.select("lang", F.col("source").alias("b"))
    nothing = (
        bare.select("lang", F.col("source").alias("a")).join(others, "lang").filter("a < b")
        .select("lang", "a", "b", F.lit(0).cast("long").alias("value"))
    )
    sides = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    pairs = summed.unionByName(nothing).select("lang", "value", F.inline(sides))
    return _ranked(pairs).withColumn("part", F.lit("pair"))


def _terms(vocabulary: DataFrame, groups: DataFrame, top_terms: int) -> DataFrame:
    in_lang = F.aggregate("counts", F.lit(0).cast("long"), lambda n, x: n + x["count"])
    uses = vocabulary.select(
        "lang", F.col("term").alias("item"), in_lang.alias("lang_count"), F.inline("counts")
    )
    small = F.broadcast(groups) if fits_broadcast(groups) else groups
    p = weight(F.col("count"), F.col("total"), F.col("n_terms"))
    q = weight(F.col("lang_count"), F.col("lang_total"), F.col("n_terms"))
    more = uses.filter("count > 0").join(small, ["lang", "source"]).select(
        "lang", "source", "item", p.alias("p"), q.alias("q")
    ).filter("p > q")
    valued = more.select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(valued).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))
