"""Line dedup by site-relative frequency.

A line is boilerplate of a site if more than ``ratio`` of the site's pages
contain it. Lines are the parts of a text between newlines, compared whole and
unchanged; lines without a word are kept and never counted. A page counts once
for a line however often it repeats it. Pages with a null site form one site.
A line of fewer than ``min_pages`` pages is never boilerplate, or every line of
a site with one page would be.

A null text has no lines and stays null. A page of which every line goes keeps
an empty text. Each input row is a page of its own, also where ids repeat or
are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import WORD, cut
from docketflow.operators.joins import fits_broadcast

RATIO = 0.1
MIN_PAGES = 5


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _key(line: Column) -> Column:
    """The first half of SHA-256 of a line as 16 bytes."""
    return F.substring(F.unhex(F.sha2(line, 256)), 1, 16)


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(site, line, n_with, n_pages)`` of the lines that ``pages(site, text)`` repeat.

    Counts are combined per task before they are shuffled, so neither a large
    site nor a frequent line gathers its rows in one task. A site has at most
    ``lines per page / ratio`` such lines, however many pages it has.
    """
    lines = pages.select(
        F.coalesce("site", F.lit("")).alias("site"),
        F.col("site").isNull().alias("nameless"),
        F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"),
    )
    counted = (
        lines.filter(F.col("line").rlike(WORD))
        .groupBy("site", "nameless", _key(F.col("line")).alias("line"))
        .agg(F.count(F.lit(1)).alias("n_with"))
        .filter(F.col("n_with") >= min_pages)
    )
    sizes = pages.groupBy(
        F.coalesce("site", F.lit("")).alias("site"), F.col("site").isNull().alias("nameless")
    ).agg(F.count(F.lit(1)).alias("n_pages"))
    return counted.join(sizes, ["site", "nameless"]).filter(
        F.col("n_with") > F.lit(ratio) * F.col("n_pages")
    )


def drop_boilerplate(
    docs: DataFrame,
    site: Column,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = False,
) -> DataFrame:
    """The documents with their boilerplate lines removed from ``text``.

    All columns stay as they are, in their order; ``counts`` adds ``n_lines``
    and ``n_dropped``. The texts are joined once to the short list of their
    site, never line by line. The lists are broadcast if they were measured to
    be small; if not, the join is shuffled and a large site is split by AQE.
    """
    pages = docs.select(site.cast("string").alias("site"), "text")
    lines = cut(boilerplate(pages, ratio, min_pages))
    found = lines.groupBy("site", "nameless").agg(F.collect_list("line").alias("__gone"))
    if fits_broadcast(lines):
        found = F.broadcast(found)
    row = F.struct(*(F.col(name) for name in docs.columns)).alias("__doc")
    packed = docs.select(
        row,
        F.coalesce(site.cast("string"), F.lit("")).alias("site"),
        site.isNull().alias("nameless"),
    )
    joined = packed.join(found, ["site", "nameless"], "left")
    split = F.split("__doc.text", "\n")
    gone = F.coalesce("__gone", F.array().cast("array<binary>"))
    kept = F.filter(split, lambda x: ~(x.rlike(WORD) & F.array_contains(gone, _key(x))))
    text = F.when(F.size(gone) == 0, F.col("__doc.text")).otherwise(F.array_join(kept, "\n"))
    columns = [
        text.alias(name) if name == "text" else F.col("__doc").getField(name).alias(name)
        for name in docs.columns
    ]
    if counts:
        n_lines = F.when(F.col("__doc.text").isNull(), 0).otherwise(F.size(split)).cast("long")
        n_kept = F.when(F.size(gone) == 0, n_lines).otherwise(
            F.when(F.col("__doc.text").isNull(), 0).otherwise(F.size(kept))
        )
        columns += [n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped")]
    return joined.select(*columns)
