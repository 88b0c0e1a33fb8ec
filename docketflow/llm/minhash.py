"""Near-dedup by BagMinHash over multisets of five-word shingles.

A text is the multiset of its five-word shingles (a text of one to four words
has one shingle of all of them). Two texts are near duplicates if their
weighted Jaccard similarity is at least 0.8; classes are the connected parts of
that relation.

BagMinHash draws points of Poisson processes for every unit of weight of every
shingle and keeps, for each of 96 components, the least point. Weights are
discretised to whole units in dyadic intervals (0,1], (1,2], (2,4], (4,8], ...:
one process for each interval, as fast as the interval is long, whose points
fall on a random unit of it and count if the weight reaches that unit. So the
share of equal components is an unbiased estimate of the weighted Jaccard
similarity, and a process stops at the first point beyond the greatest
component: most shingles of a long text cost one point.

24 bands of 4 components make the candidates (a pair at 0.8 is missed once in
300,000 pairs). Equal texts are one node. In a bucket every node is first
compared with one pivot, which joins most copies. Only buckets with nodes of
different parts go on. There, weight that a node shares with no other node left
bounds its overlap with any of them: two nodes of sizes m and n that share at
most s and t with others overlap in min(s, t) at most, so their similarity is at
most min(s, t) / (m + n - min(s, t)). Nodes that cannot reach 0.8 with anyone
leave, and the others are compared with the one that shares most. What is then
still in different parts is compared with each other within a task for each
bucket, a bucket of many nodes or long texts in blocks of bounded size; only
links between different parts leave the task. So no link is lost, a large group of copies is
not expanded to pairs, and texts that only have a passage in common are never
paired. Every link is verified by the exact multiset overlap of the texts. A pivot of
very many pairs, a bucket, a part or a text of very many rows is cut into
slices wherever its rows are joined.

Null texts and texts without words have no shingles: each is a class of its
own. The class id is the least id in it; rows that repeat an id, or have none,
belong to the class of their text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.common import (
    WORD, cut, hashes, mixed, runs_of, slices, window_hashes, words, written,
)
from docketflow.llm.units import (
    ANSWERED, ASKED, answer_repeats, ask_repeats, in_order, in_units, places_of,
)
from docketflow.operators.joins import (
    HOT_SHARES, HotKeys, hot_key_sketch, hot_keys, hot_keys_from, key_hash, spread_join,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
UNIT_BYTES = 8 * 1024 * 1024
# Nodes of a bucket that one task compares with as many others, and shingles of theirs.
BLOCK = 800
BLOCK_UNITS = 1_000_000
# From so many rows on, keys with far more than their share are cut into slices.
HOT_ROWS = 10_000
_M = BANDS * ROWS
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)


def shingle_counts(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """Text number, hash and count of every distinct shingle, sorted by text."""
    dictionary, codes, bounds = words(texts)
    hashed = hashes(dictionary)[codes]
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    starts = np.flatnonzero(np.arange(len(codes)) + shingle <= ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = window_hashes(hashed, shingle)[starts]
    short = np.flatnonzero((sizes > 0) & (sizes < shingle))
    whole = [window_hashes(hashed[bounds[k] : bounds[k + 1]], sizes[k])[0] for k in short]
    text = np.concatenate([owner[starts], short])
    found = np.concatenate([found, np.array(whole, np.uint64)])
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    return text[first], found[first], np.diff(np.append(first, len(text)))


def bag_minhash(
    text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, m: int = _M
) -> np.ndarray:
    """The least points of each text: ``n_texts`` x ``m``, infinite for a text without elements."""
    least = np.full((n_texts, m), np.inf)
    owner, seed, reach, below, rate = [], [], [], [], []
    low = 0
    while (inside := weight > low).any():  # the interval (low, high]
        high = max(1, 2 * low)
        level = mixed(np.array([high.bit_length()], np.uint64))
        owner.append(text[inside])
        seed.append(mixed(element[inside] ^ level))
        reach.append(weight[inside])
        below.append(np.full(inside.sum(), low))
        rate.append(np.full(inside.sum(), float(high - low)))
        low = high
    if not owner:
        return least
    owner, seed, reach, below, rate = map(np.concatenate, (owner, seed, reach, below, rate))
    at = np.zeros(len(owner))
    drawn = np.uint64(0)
    while len(owner):
        width = int(np.clip(100_000 // len(owner), 1, 64))
        number = drawn + np.arange(1, width + 1, dtype=np.uint64)
        first = mixed(seed[:, None] + number * _STEP)
        second = mixed(first ^ _OTHER)
        gaps = -np.log(((first >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        # Added in order from the start, so that the width never shows in the last bit.
        points = np.cumsum(np.column_stack([at, gaps / rate[:, None]]), axis=1)[:, 1:]
        component = (second >> np.uint64(32)).astype(np.int64) * m >> 32
        part = (second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
        unit = below[:, None] + 1 + np.floor(part * rate[:, None])
        counts = unit <= reach[:, None]
        place = (owner[:, None] * m + component)[counts]
        np.minimum.at(least.reshape(-1), place, points[counts])
        at = points[:, -1]
        drawn += np.uint64(width)
        open_ = at < least.max(axis=1)[owner]
        owner, seed, reach, below, rate, at = (
            x[open_] for x in (owner, seed, reach, below, rate, at)
        )
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each text and band."""
    points = mixed(least.view(np.uint64)).reshape(len(least), BANDS, ROWS)
    key = np.zeros(points.shape[:2], np.uint64)
    for row in range(ROWS):
        key = mixed(key * _STEP + points[:, :, row])
    return key.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        n = batch.num_rows
        text, element, weight = shingle_counts(batch.column("text"))
        keys = band_keys(bag_minhash(text, element, weight, n))
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1))
        )
        size = pa.array(np.bincount(text, weight, n).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("doc_id"), size, bands],
            ["node", "doc_id", "size", "bands"],
        )


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    common = sum(min(n, large[x]) for x, n in small.items())
    both = a.total() + b.total() - common
    return common / both if both else 0.0


def shingles(text: str, shingle: int = SHINGLE) -> Counter:
    own = text.encode().split()
    if len(own) < shingle:
        return Counter([tuple(own)] if own else [])
    return Counter(zip(*(own[k:] for k in range(shingle))))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[str, Counter] = ("", Counter())
    for batch in batches:
        close = []
        for a, text_a, text_b in zip(*(batch.column(x) for x in ("a", "text_a", "text_b"))):
            if a.as_py() != last[0]:  # pairs of one pivot mostly follow each other
                last = (a.as_py(), shingles(text_a.as_py()))
            close.append(overlap(last[1], shingles(text_b.as_py())) >= SIMILARITY)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b")], ["a", "b"]
        ).filter(pa.array(close, pa.bool_()))


def verified(pairs: DataFrame, texts: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """The pairs whose multisets overlap enough; ``hot`` are the pivots ``a`` of very many pairs."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = spread_join(pairs.join(b, "b"), a, ["a"], "inner", hot, spread_by=["b"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a string, b string")


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for the nodes of the edges: the least node of their part.

    Labels spread to neighbours and jump to the label of their label, so the
    number of rounds follows the logarithm of a part's width.
    """
    both = cut(edges.union(edges.select("b", "a")).distinct())
    hubs = hot_keys(both, ["b"], HOT_ROWS)
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")
    ))
    large = hot_keys(labels, ["label"], HOT_ROWS)
    while True:
        neighbours = labels.withColumnRenamed("node", "b")
        told = (
            spread_join(both, neighbours, ["b"], "inner", hubs, spread_by=["a"])
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("told"))
        )
        nearer = labels.join(told, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "told").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = cut(spread_join(nearer, jump, ["label"], "inner", large, spread_by=["node"]).select(
            "node", "old", F.least("label", "further").alias("label")
        ))
        seen = labels.agg(
            F.count_if(F.col("label") != F.col("old")).alias("changed"),
            F.count(F.lit(1)).alias("n"),
            hot_key_sketch(labels.sparkSession, ["label"]).alias("top"),
        ).first()
        labels = labels.select("node", "label")
        if not seen["changed"]:
            return labels
        large = hot_keys_from(labels.sparkSession, seen["top"], seen["n"], HOT_ROWS)


def node_of(text: Column) -> Column:
    """Half of SHA-256 of a text with words, else null."""
    return F.when(text.rlike(WORD), F.substring(F.sha2(text, 256), 1, 32))


def _mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their labels, and the buckets that have several labels, with a pivot."""
    placed = members.join(labels, "node")
    pivot = F.min(F.struct("first", "node", "label", "size", "shared")).alias("pivot")
    buckets = (
        placed.groupBy("band", "key")
        .agg(pivot, F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
    )
    return placed, buckets


def _still_mixed(members: DataFrame, labels: DataFrame, hot: HotKeys) -> DataFrame:
    known = members.withColumn("shared", F.lit(0)).withColumn("first", F.lit(0))
    _, buckets = _mixed(known, labels)
    keys = ["band", "key"]
    return written(
        spread_join(members, buckets.select(*keys), keys, "left_semi", hot, spread_by=["node"]), "mixed"
    )


def _possible(size: Column, size_a: Column, shared: Column, shared_a: Column) -> Column:
    """Whether two nodes can reach the similarity, by their sizes and what they share at all."""
    common = F.least(shared, shared_a, size, size_a)
    return common * (1 + SIMILARITY) >= SIMILARITY * (size + size_a) - 1e-9


def _with_pivot(members: DataFrame, labels: DataFrame, hot: HotKeys) -> DataFrame:
    """Candidates ``(a, b)``: the pivot of a bucket with nodes of other labels."""
    placed, buckets = _mixed(members, labels)
    names = ("node", "label", "size", "shared")
    pivots = buckets.select("band", "key", *(F.col(f"pivot.{x}").alias(f"{x}_a") for x in names))
    columns = (F.col(x) for x in ("size", "size_a", "shared", "shared_a"))
    return (
        spread_join(placed, pivots, ["band", "key"], "inner", hot, spread_by=["node"])
        .filter((F.col("label") != F.col("label_a")) & _possible(*columns))
        .select(F.col("node_a").alias("a"), F.col("node").alias("b"))
        .distinct()
    )


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash for every unit of weight of every shingle, as bytes."""
    for batch in slices(batches, "text"):
        text, element, weight = shingle_counts(batch.column("text"))
        first = np.cumsum(weight) - weight
        turn = np.arange(weight.sum()) - np.repeat(first, weight)
        unit = mixed(np.repeat(element, weight) + turn.astype(np.uint64) * _OTHER)
        ends = np.cumsum(np.bincount(text, weight, batch.num_rows).astype(np.int64))
        packed = [unit[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(packed, pa.binary())], ["node", "units"]
        )


def _close(bucket: pa.Table) -> pa.Table:
    """Links that join different labels, of all pairs of a bucket or of two of its blocks."""
    node, label = bucket["node"].to_pylist(), bucket["label"].to_pylist()
    block = bucket["block"].to_numpy()
    between_two = bucket["low"][0].as_py() != bucket["high"][0].as_py()
    units = [np.frombuffer(x.as_buffer(), np.uint64) for x in bucket["units"]]
    sizes = np.array([len(x) for x in units])
    together = np.concatenate(units)
    order = np.argsort(together)
    _, lengths = runs_of(together[order])
    del together
    # Only shingles that several texts have, each one a column.
    common = np.repeat(lengths > 1, lengths)
    owner = np.repeat(np.arange(len(units), dtype=np.int32), sizes)[order[common]]
    several = lengths[lengths > 1]
    column = np.repeat(np.arange(len(several)), several)
    overlaps = np.zeros((len(units), len(units)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(units), 4096), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        overlaps += part @ part.T
    close = np.zeros(overlaps.shape, bool)
    for i, row in enumerate(overlaps):
        total = sizes[i] + sizes[i + 1 :]
        close[i, i + 1 :] = row[i + 1 :].astype(np.float64) * (1 + SIMILARITY) >= SIMILARITY * total - 1e-9
    if between_two:
        close &= block[:, None] != block[None, :]
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(close)):
        x, y = find(label[i]), find(label[j])
        if x != y:
            parent[x] = y
            links.append((node[i], node[j]))
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})


def _within_buckets(
    members: DataFrame, labels: DataFrame, texts: DataFrame, hot: HotKeys
) -> DataFrame:
    """Candidates ``(a, b)`` that join different labels, out of all pairs of a bucket."""
    placed, buckets = _mixed(members, labels)
    needed = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_UNITS)
    sizes = placed.groupBy("band", "key").agg(F.ceil(needed).cast("int").alias("blocks"))
    mixed_ = buckets.select("band", "key").join(sizes, ["band", "key"])
    wanted = texts.join(members.select("node").distinct(), "node", "left_semi")
    elements = wanted.select("node", "text").mapInArrow(_units, "node string, units binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    inside = spread_join(
        placed, mixed_, ["band", "key"], "inner", hot, spread_by=["node"]
    ).withColumn("block", own)
    one = inside.filter("blocks = 1").withColumn("other", F.lit(0))
    many = inside.filter("blocks > 1").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = one.union(many).select(
        "band", "key", "node", "label", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    return (
        dealt.join(elements, "node").groupBy("band", "key", "low", "high")
        .applyInArrow(lambda table: _close(table), "a string, b string").distinct()
    )


def _linked(labels: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The labels after the verified pairs are joined."""
    pairs = written(pairs, "pairs")
    hot = hot_keys(pairs, ["a"], HOT_ROWS)
    edges = cut(verified(pairs, texts, hot))
    if edges.isEmpty():
        return labels
    a, b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    joined = spread_join(edges.join(b, "b"), a, ["a"], "inner", hot, spread_by=["b"])
    roots = components(joined.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    renamed = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
    large = hot_keys(labels, ["label"], HOT_ROWS)
    return cut(spread_join(labels, renamed, ["label"], "left", large, spread_by=["node"]).select(
        "node", F.coalesce("root", "label").alias("label")
    ))


def _ask_shingles(unit: pa.Table, n_shards: int) -> pa.Table:
    _, element, _ = shingle_counts(in_order(unit)["text"])
    return ask_repeats(unit["unit"][0].as_py(), element, np.arange(len(element)), n_shards)


def _shared(unit: pa.Table, found: pa.Table) -> pa.Table:
    unit = in_order(unit)
    text, _, weight = shingle_counts(unit["text"])
    places = places_of(found)
    shared = np.bincount(text[places], weight[places], unit.num_rows).astype(np.int64)
    return pa.table({"node": unit["doc_id"], "shared": shared})


def shared_weight(texts: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """``(node, shared)``: the weight of a text's shingles that other texts have too."""
    dealt, n = in_units(texts, "node", "text", unit_bytes)
    by_unit = dealt.groupBy("unit")
    ask = partial(_ask_shingles, n_shards=n)
    found = (
        by_unit.applyInArrow(lambda table: ask(table), ASKED)
        .groupBy("shard").applyInArrow(answer_repeats, ANSWERED)
    )
    return by_unit.cogroup(found.groupBy("unit")).applyInArrow(
        lambda left, right: _shared(left, right), "node string, shared long"
    )


def _hot_nodes(nodes: DataFrame) -> HotKeys:
    """The texts of very many rows: fewer than there are shuffle partitions."""
    total = nodes.agg(F.sum("n")).first()[0] or 0
    if total < HOT_ROWS:
        return HotKeys()
    share = total / int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.filter(F.col("n") > HOT_SHARES * share).select(key_hash(["node"]), "n").collect()
    slices_ = math.ceil(max((n for _, n in rows), default=0) / share)
    return HotKeys(tuple(key for key, _ in rows), max(1, slices_))


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame, HotKeys]:
    """Nodes with their least id, the labels of those that have near duplicates, and the hot nodes."""
    signed = docs.filter("node is not null").mapInArrow(
        _signed,
        f"node string, doc_id {docs.schema['doc_id'].dataType.simpleString()},"
        " size long, bands array<long>",
    )
    nodes = cut(signed.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"),
    ))
    hot = _hot_nodes(nodes)
    members = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    keys = ["band", "key"]
    full = hot_keys(members, keys, HOT_ROWS)
    members = written(
        spread_join(members, shared.drop("n"), keys, "inner", full, spread_by=["node"]), "buckets"
    )
    known, asked = docs.filter("node is not null").select("node", "text"), members.select("node").distinct()
    texts = written(
        spread_join(known, asked, ["node"], "left_semi", hot, spread_by=["node"])
        .groupBy("node").agg(F.first("text").alias("text")),
        "texts",
    )
    labels = cut(members.select("node").distinct().withColumn("label", F.col("node")))
    by_hash = members.withColumn("shared", F.col("size")).withColumn("first", F.xxhash64("node"))
    labels = _linked(labels, _with_pivot(by_hash, labels, full), texts)
    left = _still_mixed(members, labels, full)
    likely = written(
        left.join(shared_weight(texts.join(left.select("node").distinct(), "node", "left_semi")), "node")
        .filter(F.col("shared") >= SIMILARITY * F.col("size") - 1e-9)
        .withColumn("first", F.lit(1) - F.col("shared") / F.col("size")),
        "likely",
    )
    labels = _linked(labels, _with_pivot(likely, labels, full), texts)
    labels = _linked(labels, _within_buckets(likely, labels, texts, full), texts)
    return nodes, labels, hot


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), node_of(F.col(text)).alias("node")
    )


def _classes(docs: DataFrame) -> tuple[DataFrame, HotKeys]:
    """``(node, label, class_id, best)``, ``best`` the node of the least id; and the hot nodes."""
    nodes, labels, hot = _labelled(docs)
    named = nodes.join(labels, "node", "left").select(
        "node", "doc_id", F.coalesce("label", "node").alias("label")
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))
    best = named.groupBy("label").agg(F.min(order).alias("best"))
    large = hot_keys(labels, ["label"], HOT_ROWS)
    chosen = spread_join(named.drop("doc_id"), best, ["label"], "inner", large, spread_by=["node"])
    return chosen.select(
        "node", "label", F.col("best.doc_id").alias("class_id"), F.col("best.node").alias("best")
    ), hot


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, class_id)`` for each row."""
    keyed = _keyed(docs, doc_id, text)
    classes, hot = _classes(keyed)
    texts = keyed.filter("node is not null").drop("text")
    found = spread_join(texts, classes, ["node"], "left", hot).select("doc_id", "class_id")
    return found.union(
        keyed.filter("node is null").select("doc_id", F.col("doc_id").alias("class_id"))
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all columns, of each class only the one of least id."""
    classes, hot = _classes(_keyed(docs, doc_id, text))
    whole = docs.select(
        F.struct(*(F.col(x) for x in docs.columns)).alias("doc"),
        F.col(doc_id).alias("id"),
        node_of(F.col(text)).alias("node"),
    )
    chosen = classes.filter("node = best").select("node", "class_id")
    alone = whole.filter("node is null").select("doc")
    texts = whole.filter("node is not null")
    rows = spread_join(texts, chosen, ["node"], "inner", hot, spread_by=["id"]).filter(
        F.col("id").eqNullSafe(F.col("class_id"))
    )
    # Rows equal in id and text are left; one of them stays.
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("id")))
    kept = first.filter("n = 1").select("doc").union(alone)
    return kept.select(*(F.col("doc").getField(x).alias(x) for x in docs.columns))
