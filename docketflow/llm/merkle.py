"""A Merkle manifest of a dataset by rolling up nested structs.

Every row is a leaf, the leaves of a source form a tree in the order of their
ids, and the roots of the sources form the tree above them. H is the lowercase
hex SHA-256 of its inputs, concatenated; digests go in as hex text. While a tree
has several nodes, every 16 consecutive ones become their H.

The rank of a node within its tree is written in base 16. A block is the nodes
that agree in all but the last three digits, 4,096 at most. Grouping away one
digit after the other nests the children into structs, so a block ends as one
row that holds its nodes, and its hash is a node of the pass above. Each pass is
stored. Proofs go the other way: a block's path to the root meets the block in
one grouping, and exploding its structs level by level hands each child the path
with its own siblings before it. No row is joined to its siblings, and no task
holds more than blocks.

A tree with a third of all rows is spread like any other: ranks come from a sort
by range, of which only one count for each partition and tree is summed up.

A null field is hashed as ``-``. A null source is a tree of its own, first in
order; null ids come first within it. Rows of one id are ordered by their
leaves, and equal rows are leaves of their own. Empty and very long texts are
hashed whole. Of an empty table there are no leaves and no root. Columns other
than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.common import cut, written
from docketflow.operators.joins import fits_broadcast

FAN_OUT = 16
# Digits that a block spans: 16 ** 3 nodes at most.
BLOCK_DIGITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# monotonically_increasing_id() holds the partition above these bits.
PLACE_BITS = 33


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """H of the fields, each as ``-`` if null, else its length in bytes, a colon and its text."""
    texts = [field.cast("string") for field in fields]
    sized = (F.concat(F.octet_length(x).cast("string"), F.lit(":"), x) for x in texts)
    return digest(*(F.coalesce(x, F.lit("-")) for x in sized))


class Manifest(NamedTuple):
    """The stored passes from the leaves to the root: first those of the sources' trees."""

    of_sources: list[DataFrame]
    above: list[DataFrame]
    kept: list[str]


def ranked(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """The rows with ``rank`` in their ``tree`` and its size ``n``, and the largest size.

    Rows equal in ``order`` are placed as they come in, so they spread over
    partitions too.
    """
    by = [F.col(name).asc_nulls_first() for name in ("tree", *order, "arrival")]
    placed = written(
        rows.withColumn("arrival", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("arrival")
        .withColumn("place", F.monotonically_increasing_id()),
        "merkle-order",
    )
    part = F.shiftright("place", PLACE_BITS)
    counted = placed.groupBy("tree", part.alias("part")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("own")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        counted.select(
            F.col("tree").alias("of_tree"),
            F.col("part").alias("of_part"),
            (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("own").over(tree).alias("n"),
        )
    )
    largest = starts.agg(F.max("n")).first()[0] or 0
    # A row for each partition, and one more for each tree.
    small = F.broadcast(starts) if fits_broadcast(starts) else starts
    same = F.col("tree").eqNullSafe(F.col("of_tree")) & (part == F.col("of_part"))
    joined = placed.join(small, same)
    columns = [name for name in rows.columns if name != "arrival"]
    return joined.select(*columns, (F.col("place") + F.col("shift")).alias("rank"), "n"), largest


def _sizes(n: Column) -> list[Column]:
    """How many nodes a tree of ``n`` has before each digit of a block is grouped away, and after."""
    return [F.ceil(n / F.lit(FAN_OUT**k)).cast("long") for k in range(BLOCK_DIGITS + 1)]


def rolled_up(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """``(tree, block, n, hash, kids)``: a row for each block of ``(tree, rank, n, hash, payload)``.

    ``kids`` nests the children of three digits. One exchange by block serves all
    groupings. Where a tree is down to one node, that node goes up unchanged.
    """
    digit = [F.pmod(F.expr(f"rank div {FAN_OUT**k}"), F.lit(FAN_OUT)) for k in range(BLOCK_DIGITS)]
    kid = F.struct(digit[0].alias("digit"), "hash", *payload).alias("kid")
    names = [f"digit{k}" for k in range(1, BLOCK_DIGITS)]
    rows = nodes.select(
        "tree", F.expr(f"rank div {FAN_OUT**BLOCK_DIGITS}").alias("block"), "n",
        *(digit[k].alias(name) for k, name in enumerate(names, 1)), kid,
    ).repartition("tree", "block")
    for k, size in enumerate(_sizes(F.col("n"))[:-1]):
        kids, above = F.col("kids"), names[k:]
        joined = F.array_join(F.transform(kids, lambda x: x["hash"]), "")
        grouped = rows.groupBy("tree", "block", "n", *above).agg(
            F.array_sort(F.collect_list("kid")).alias("kids")
        )
        hashed = F.when(size > 1, F.sha2(joined, 256)).otherwise(kids[0]["hash"]).alias("hash")
        if above:
            kid = F.struct(F.col(above[0]).alias("digit"), hashed, "kids").alias("kid")
            rows = grouped.select("tree", "block", "n", *above[1:], kid)
        else:
            rows = grouped.select("tree", "block", "n", hashed, "kids")
    return rows


def _passes(nodes: DataFrame, largest: int, payload: Sequence[str]) -> list[DataFrame]:
    """Stored blocks, pass after pass, until every tree is one block."""
    stored = [written(rolled_up(nodes, payload), "merkle-blocks")]
    block = FAN_OUT**BLOCK_DIGITS
    while largest > block:
        largest = -(-largest // block)
        nodes = stored[-1].select(
            "tree", F.col("block").alias("rank"), _sizes(F.col("n"))[-1].alias("n"), "hash"
        )
        stored.append(written(rolled_up(nodes, ["rank"]), "merkle-blocks"))
    return stored


def build(leaves: DataFrame, source: str, order: Sequence[str], leaf: str) -> Manifest:
    """The manifest of ``leaves``, one row each with its hash in the column ``leaf``.

    All other columns of ``leaves`` are kept beside the leaf and come back with
    its proof.
    """
    kept = [name for name in leaves.columns if name not in (source, leaf)]
    rows = leaves.select(
        F.col(source).alias("tree"), F.col(leaf).alias("hash"),
        F.struct(F.lit(0).alias("none"), *(F.col(name) for name in kept)).alias("row"),
        *(F.col(name).alias(f"order{k}") for k, name in enumerate(order)),
    )
    sort = [*(f"order{k}" for k in range(len(order))), "hash"]
    of_sources = _passes(*ranked(rows, sort), ["row"])
    subroots = of_sources[-1].select(
        F.lit(0).alias("tree"), F.col("tree").alias("source"), "hash"
    )
    return Manifest(of_sources, _passes(*ranked(subroots, ["source"]), ["source"]), kept)


def _side(kids: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.transform(F.slice(kids, start, length), lambda x: x["hash"]), "")


def _unrolled(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """A row for each node of the blocks, with its siblings put before the block's path."""
    rows = blocks
    for k in reversed(range(BLOCK_DIGITS)):
        several = _sizes(F.col("n"))[k] > 1
        exploded = rows.select("tree", "n", *carried, F.inline(_children(several)))
        rows = exploded if k == 0 else exploded.select(
            "tree", "n", *carried, "path", F.col("kid.kids").alias("kids")
        )
    return rows


def _children(several: Column) -> Column:
    """The kids of a node, each with its path; a node passed on unchanged adds no level to it."""
    kids, path = F.col("kids"), F.col("path")

    def child(kid: Column, i: Column) -> Column:
        own = F.struct(
            _side(kids, F.lit(1), i).alias("left"),
            _side(kids, i + 2, F.size(kids)).alias("right"),
        )
        longer = F.when(several, F.concat(F.array(own), path)).otherwise(path)
        return F.struct(kid.alias("kid"), longer.alias("path"))

    return F.transform(kids, child)


def _with_paths(blocks: DataFrame, paths: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Each block beside its path: both are rows of one grouping by tree and block."""
    known = ["path", *carried]
    types = {name: paths.schema[name].dataType for name in known}
    nothing = {name: blocks.schema[name].dataType for name in ("n", "kids")}
    both = blocks.select(
        "tree", "block", "n", "kids", *(F.lit(None).cast(types[x]).alias(x) for x in known)
    ).unionByName(
        paths.select(
            "tree", "block", *(F.lit(None).cast(nothing[x]).alias(x) for x in nothing), *known
        )
    )
    return both.groupBy("tree", "block").agg(
        *(F.first(name, ignorenulls=True).alias(name) for name in ("n", "kids", *known))
    )


def proofs(manifest: Manifest) -> DataFrame:
    """``leaf, subroot, root, path`` of every leaf, with the columns kept beside it.

    ``path`` leads from the leaf to the root: at each level the digests of the
    siblings to the ``left`` and to the ``right``, concatenated.
    """
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    rows = manifest.above[-1].select(
        "tree", "block", "n", "kids", nothing.alias("path"), F.col("hash").alias("root")
    )
    for lower in reversed(manifest.above[:-1]):
        paths = _unrolled(rows, ["root"]).select(
            "tree", F.col("kid.rank").alias("block"), "path", "root"
        )
        rows = _with_paths(lower, paths, ["root"])
    paths = _unrolled(rows, ["root"]).select(
        F.col("kid.source").alias("tree"), F.lit(0).cast("long").alias("block"), "path",
        F.col("kid.hash").alias("subroot"), "root",
    )
    for lower in reversed(manifest.of_sources):
        if lower is not manifest.of_sources[-1]:
            paths = _unrolled(rows, ["subroot", "root"]).select(
                "tree", F.col("kid.rank").alias("block"), "path", "subroot", "root"
            )
        rows = _with_paths(lower, paths, ["subroot", "root"])
    return _unrolled(rows, ["subroot", "root"]).select(
        *(F.col(f"kid.row.{name}").alias(name) for name in manifest.kept),
        F.col("tree").alias("source"), F.col("kid.hash").alias("leaf"), "subroot", "root", "path",
    )


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, leaf, tampered)`` of documents.

    ``tampered`` is the leaf of the row with the A-Z of its text in lower case,
    for every row where 5 divides the CRC-32 of the decimal id; null for others.
    """
    fields = [F.col(name) for name in FIELDS]
    lowered = F.translate("text", UPPER, LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        "doc_id", "source", leaf_of(fields).alias("leaf"),
        F.when(chosen, leaf_of([*fields[:-1], lowered])).alias("tampered"),
    )


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Every document with its proof, and whether the proof still holds for the tampered rows."""
    leaves = written(document_leaves(docs), "merkle-leaves")
    found = proofs(build(leaves, "source", ["doc_id"], "leaf"))
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
