"""Mixing sources to target weights as a min-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern (the set of their sources); token capacity then flows from the patterns
to the quotas of the sources. The first pass over a pattern costs nothing a
token and each further pass more than the one before, so repetition is spread
evenly before anything is repeated more often. Last, documents are selected: a
pattern with flow for 1.4 passes takes every document once and, in a seeded
order, as many of them again as come nearest to the rest.

Only the aggregate by pattern reaches the driver: sources are a stated set and
their number does not follow the rows. A null text has size 0 and is taken 0
words. A null source is a source of its own, last in order. Repeated rows are
documents of their own. Reruns agree: the order depends on the row and the seed
alone, not on partitions.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import WORD, cut
from docketflow.operators import joins
from docketflow.sources.tables import parameter_table

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MAX_PASSES = 2
SEED = 20240607
# Places of the last, undecided part of a pattern, which are filled one by one.
LAST_PART = 1024
FAN_OUT_BITS = 6
ORDER_BITS = 63
NO_NAME = ""


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[int],
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    max_passes: int = MAX_PASSES,
) -> list[Fraction]:
    """The tokens wanted of each source, in the order of ``sizes``; weights repeat.

    A target stops at ``max_passes`` times the size; what it cannot take is
    shared among the others by weight until none is above its limit.
    """
    wanted = [Fraction(0)] * len(sizes)
    open_ = [k for k, size in enumerate(sizes)]
    rest = share * sum(sizes)
    while open_:
        total = sum(weights[k % len(weights)] for k in open_)
        part = {k: rest * weights[k % len(weights)] / total for k in open_}
        full = [k for k in open_ if part[k] > max_passes * sizes[k]]
        for k in full or open_:
            wanted[k] = Fraction(max_passes * sizes[k]) if full else part[k]
            rest -= wanted[k]
        open_ = [k for k in open_ if k not in full] if full else []
    return wanted


class _Flow:
    """Successive shortest paths with potentials over a graph of patterns and sources."""

    def __init__(self, n: int) -> None:
        self.arcs: list[list] = []  # to, capacity left, cost
        self.out: list[list[int]] = [[] for _ in range(n)]

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, source: int, sink: int) -> None:
        height = [0] * len(self.out)
        while True:
            dist: dict[int, int] = {source: 0}
            via: dict[int, int] = {}
            queue = [(0, source)]
            while queue:
                far, node = heapq.heappop(queue)
                if far > dist[node]:
                    continue
                for k in self.out[node]:
                    to, capacity, cost = self.arcs[k]
                    new = far + cost + height[node] - height[to]
                    if capacity and new < dist.get(to, 1 << 62):
                        dist[to], via[to] = new, k
                        heapq.heappush(queue, (new, to))
            if sink not in dist:
                return
            for node in range(len(height)):
                height[node] += dist.get(node, dist[sink])
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = self.arcs[via[node] ^ 1][0]
            amount = min(self.arcs[k][1] for k in path)
            for k in path:
                self.arcs[k][1] -= amount
                self.arcs[k ^ 1][1] += amount


def route(
    capacity: dict[tuple, int], quota: dict, max_passes: int = MAX_PASSES
) -> dict[tuple[tuple, object], int]:
    """Tokens of each ``(pattern, source)``: the cheapest flow that fills the quotas best.

    A pattern is a tuple of sources; its p-th pass can carry its capacity once
    and costs p - 1 a token, which is convex. A source that shares no document with
    another is filled from its own pattern at once, so only sources that overlap
    take part in the flow.
    """
    shared = {name for pattern in capacity if len(pattern) > 1 for name in pattern}
    alone = {p for p in capacity if len(p) == 1 and p[0] not in shared}
    filled = {(p, p[0]): min(quota[p[0]], max_passes * capacity[p]) for p in alone}
    patterns = [p for p in capacity if p not in alone]
    sources = [name for name in quota if name in shared]
    return filled | _flow_of(capacity, quota, max_passes, patterns, sources)


def _flow_of(
    capacity: dict[tuple, int], quota: dict, max_passes: int, patterns: list, sources: list
) -> dict[tuple[tuple, object], int]:
    flow = _Flow(2 + len(patterns) + len(sources))
    place = {name: 2 + len(patterns) + k for k, name in enumerate(sources)}
    carried = {}
    for k, pattern in enumerate(patterns):
        for turn in range(max_passes):
            flow.arc(0, 2 + k, capacity[pattern], turn)
        for name in pattern:
            full = max_passes * capacity[pattern]
            carried[pattern, name] = flow.arc(2 + k, place[name], full, 0)
    for name in sources:
        flow.arc(place[name], 1, quota[name], 0)
    flow.run(0, 1)
    return {pair: flow.arcs[k + 1][1] for pair, k in carried.items()}


def place_last(sizes: Sequence[tuple[int, int]], rest: int) -> list[int]:
    """Of ``(order, size)`` those orders to take so that the sizes come near the rest.

    In order, each that still fits; then one more, or one for another, where
    that comes nearer.
    """
    chosen, others, left = [], [], rest
    for order, size in sorted(x for x in sizes if x[1]):
        fits = size <= left
        (chosen if fits else others).append((size, order))
        left -= size if fits else 0
    others.sort()
    best = (left, [], [])
    for size, order in [(0, None), *sorted(chosen)]:
        # What should come in if this one goes out (0: if nothing goes out).
        at = bisect_left(others, (size + left, -1))
        for new_size, new in others[max(0, at - 1) : at + 1]:
            off = abs(left + size - new_size)
            if off < best[0]:
                best = (off, [order], [new])
    _, out, into = best
    return [order for _, order in chosen if order not in out] + into


def select_rest(sized: DataFrame, rests: dict[str, int]) -> dict[str, tuple[int, list[int]]]:
    """For each pattern ``(cut, more)``: rows with ``order < cut`` or ``order in more`` are taken.

    Sums by the leading bits of the order tell how many leading rows fit whole
    and in which part the rest ends; that part is divided again until it has at
    most LAST_PART places. No pattern is ever sorted or collected whole.
    """
    spark, depth = sized.sparkSession, 0
    result = {key: (0, []) for key in rests}
    parts = {key: (0, rest) for key, rest in rests.items() if rest > 0}
    columns = {"key": "string", "first": "bigint"}
    while parts:
        width = ORDER_BITS - depth
        rows = [(key, first) for key, (first, _) in parts.items()]
        at = _parameters(spark, rows, columns)
        inside = sized.join(at, "key").filter(
            (F.col("order") >= F.col("first"))
            & (F.col("order") - F.col("first") < F.lit(1 << width if width < 63 else 2**63 - 1))
        )
        step = max(0, width - FAN_OUT_BITS)
        bins = (
            inside.groupBy("key", F.shiftright("order", step).alias("bin"))
            .agg(F.sum("size").alias("size"), F.count_distinct("order").alias("n"))
            .collect()  # at most 64 rows of each pattern
        )
        of_key = _by_key(bins)
        following, last = {}, {}
        for key, (first, rest) in parts.items():
            own = sorted((r["bin"], r["size"], r["n"]) for r in of_key.get(key, ()))
            if step == 0 or sum(n for *_, n in own) <= LAST_PART:
                last[key] = (first, rest)
                continue
            for bin_, size, _ in own:
                if size > rest:
                    following[key] = (bin_ << step, rest)
                    break
                rest -= size
                result[key] = ((bin_ + 1) << step, [])
        if last:
            rows = [(key, first) for key, (first, _) in last.items()]
            at = _parameters(spark, rows, columns)
            ends = sized.join(at, "key").filter(
                (F.col("order") >= F.col("first"))
                & (F.col("order") - F.col("first") < F.lit(1 << width if width < 63 else 2**63 - 1))
            )
            found = ends.groupBy("key", "order").agg(F.sum("size").alias("size")).collect()
            of_key = _by_key(found)
            for key, (first, rest) in last.items():
                sizes = [(r["order"], r["size"]) for r in of_key.get(key, ())]
                result[key] = (max(first, result[key][0]), place_last(sizes, rest))
        parts, depth = following, depth + FAN_OUT_BITS
    return result


def mix(
    docs: DataFrame,
    sources: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    max_passes: int = MAX_PASSES,
    seed: int = SEED,
) -> tuple[DataFrame, dict[str | None, int], dict[str | None, Fraction]]:
    """What the mix takes of each document, and the size and target of each source.

    ``sources`` is an array of the sources a document belongs to; a null in it
    is the null source, and a document without any is not taken. The frame has
    one row per input row: ``doc`` (all its columns), ``size``, ``passes`` and
    ``taken`` = ``passes`` x ``size``. Rows equal in id and text share a place
    in the order and are taken alike.
    """
    spark = docs.sparkSession
    named = F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit(NO_NAME)))
    key = F.to_json(F.array_sort(F.array_distinct(F.coalesce(named, F.array()))))
    whole = F.struct(*(F.col(name) for name in docs.columns)).alias("doc")
    order = F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit(2**63 - 1))
    measured = docs.select(
        whole, key.alias("key"), n_words(F.col(text)).alias("size"), order.alias("order")
    )
    sized = cut(measured.select("key", "size", "order"))
    totals = {
        r["key"]: r["size"]
        for r in sized.filter("key <> '[]'").groupBy("key").agg(F.sum("size").alias("size")).collect()
    }
    members = {pattern: tuple(json.loads(pattern)) for pattern in totals}
    names = sorted({x for own in members.values() for x in own}, key=lambda x: (x == NO_NAME, x))
    sizes = dict.fromkeys(names, 0)
    for pattern, own in members.items():
        for x in own:
            sizes[x] += totals[pattern]
    wanted = dict(zip(names, targets(list(sizes.values()), weights, share, max_passes)))
    quota = {name: int(target + Fraction(1, 2)) for name, target in wanted.items()}
    flows = route({own: totals[p] for p, own in members.items()}, quota, max_passes)
    amount = {p: sum(flows[own, x] for x in own) for p, own in members.items()}
    rests = {p: amount[p] % totals[p] if totals[p] else 0 for p in totals}
    ends = select_rest(sized, rests)
    plan = [
        (p, amount[p] // totals[p] if totals[p] else 0, ends[p][0], ",".join(map(str, ends[p][1])))
        for p in totals
    ]
    columns = {"key": "string", "whole": "bigint", "cut": "bigint", "more": "string"}
    # One row for each pattern, with at most LAST_PART places.
    planned = _parameters(spark, plan, columns).withColumn(
        "more", F.filter(F.split("more", ","), lambda x: x != "").cast("array<bigint>")
    )
    again = (F.col("order") < F.col("cut")) | F.array_contains("more", F.col("order"))
    passes = F.coalesce(F.col("whole") + again.cast("bigint"), F.lit(0))
    taken = measured.join(planned, "key", "left").select(
        "doc", "size", passes.alias("passes"), (passes * F.col("size")).alias("taken")
    )
    plain = {x: None if x == NO_NAME else x[1:] for x in names}
    return (
        taken,
        {plain[x]: sizes[x] for x in names},
        {plain[x]: wanted[x] for x in names},
    )


def take(docs: DataFrame, sources: Column, **options) -> DataFrame:
    """The mixed documents: as many equal rows as passes, with the columns of ``docs``."""
    mixed, _, _ = mix(docs, sources, **options)
    repeated = mixed.filter("passes > 0").select("doc", F.explode(F.expr("sequence(1, passes)")))
    return repeated.select(*(F.col("doc").getField(x).alias(x) for x in docs.columns))


def with_sources(
    mixed: DataFrame, source: Column, sizes: dict[str | None, int], wanted: dict[str | None, Fraction]
) -> DataFrame:
    """``mixed`` with ``source_size`` and ``target`` of its source, null included."""
    rows = [
        (NO_NAME if name is None else f"={name}", size, float(wanted[name]))
        for name, size in sizes.items()
    ]
    columns = {"__named": "string", "source_size": "bigint", "target": "double"}
    named = mixed.withColumn("__named", F.coalesce(F.concat(F.lit("="), source), F.lit(NO_NAME)))
    return named.join(_parameters(mixed.sparkSession, rows, columns), "__named", "left").drop("__named")


def _by_key(rows: Sequence[Row]) -> dict[str, list[Row]]:
    found: dict[str, list[Row]] = {}
    for row in rows:
        found.setdefault(row["key"], []).append(row)
    return found


def _parameters(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, str]) -> DataFrame:
    """A table of patterns or sources, to be broadcast if it is small."""
    table = parameter_table(spark, rows, columns)
    size = sum(len(x) if isinstance(x, str) else 16 for row in rows for x in row)
    return F.broadcast(table) if size <= joins.BROADCAST_BYTES else table
