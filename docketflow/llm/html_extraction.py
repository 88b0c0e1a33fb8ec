"""HTML main text by union-free regular-expression inference.

A page is a stream of tokens: tags with their class, and texts. Neighbouring
repeats in the stream are folded into repeated groups. The streams of a host
are aligned one after the other with the host's wrapper, a regular expression
without alternatives: what one side lacks becomes an optional group, a group
found once on one side and repeatedly on the other becomes a repeated group,
and each text is a slot. Headers, footers, sidebars, notices, adverts, forms and
comments, told by their elements and classes on the page itself, and slots of a
group of the wrapper that repeats nothing but links, hold no main text; the
others do, within the article if the page has one.

Wrappers are made of distinct folded streams: of a few at a time, then of the
wrappers of these groups, in rounds, until a host has one. The pages themselves
are never gathered by host, nor are all its streams.

The text of a page: its blocks in order, each with character references
decoded, white space runs as one space and trimmed, without empty blocks, joined
by newlines. Null or empty HTML gives an empty text. Pages without a host
share one wrapper. Repeated rows and null ids give a row each. Broken markup is
read as far as it goes: an unclosed tag, comment or script ends with the page.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import cut, slices
from docketflow.llm.line_dedup import host_of
from docketflow.operators.joins import fits_broadcast

# Streams of a host that one task aligns; wrappers of such groups are aligned in further rounds.
FAN_IN = 64
# Longest repeated group that is looked for; longer ones stay written out in the wrapper.
MAX_FOLD = 24
# Symbols of a stream that one character each can tell apart; with more, each is two characters.
MAX_SYMBOLS = 1_000_000
# Pairs of items that one alignment compares; beyond it, only what lies between anchors is.
MAX_CELLS = 1_000_000
# Articles with less than this share of the text beside side regions are teasers.
LEAST_ARTICLE = 0.2

# Elements whose text is never part of the page's text.
RAW = frozenset("script style template noscript textarea title iframe svg select option button".split())
# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q"
    " ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements that a region is told by.
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table figure"
    " details dialog menu fieldset blockquote".split()
)
SIDE_ELEMENTS = frozenset("head nav header footer aside form dialog menu fieldset".split())
# Words in a class or id that tell a region without main text.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " cookie cookies consent notice notices alert popup modal newsletter subscribe nav navbar"
    " navigation menu menus breadcrumb breadcrumbs sidebar aside header footer masthead social share"
    " sharing related recommended comment comments disqus respond reply replies login signup search"
    " toolbar pagination pager widget".split()
)
# Words that only say which region of its kind it is; other words make a modifier of a token.
PLACE_WORDS = frozenset(
    "site page main global primary secondary top bottom left right upper lower first second third"
    " container wrapper wrap inner outer box area block section region list item items links link"
    " bar bars buttons button group row col column content text title form panel widgets post entry"
    " article story blog user mobile desktop sticky google js".split()
)
# Parts of an article that carry its title or its text.
_OF_TEXT = frozenset("post entry article story content blog".split())
_TITLES = frozenset("header masthead banner".split())
# Regions that hold articles of their own, as cards or comments.
_OF_CARDS = frozenset(
    "comment comments disqus respond reply replies related recommended".split()
)
# Elements that no class makes a side region.
WHOLE_ELEMENTS = frozenset("html body main article".split())
# A value: in quotes only right after the equals sign; a quote that nothing closes ends with the tag.
_VALUE = r"(?:\"[^\"]*\"|'[^']*'|[\"'][^>]*|[^\s>\"'][^\s>]*)"
_ATTRIBUTES = rf"(?:[\s/]+|=?[^\s/>=]+(?:\s*=\s*{_VALUE}?)?|=)*+"
_RAW_NAMES = "|".join(sorted(RAW))
_TOKEN = re.compile(
    r"(?P<text>[^<]+)"
    rf"|<(?P<close>/?)(?!(?:{_RAW_NAMES})[\s/>])(?P<name>[a-zA-Z][^\s/>]*)"
    rf"(?P<attributes>{_ATTRIBUTES})>?"
    rf"|<(?P<raw>{_RAW_NAMES})(?:/>|(?=[\s/>])(?>{_ATTRIBUTES})"
    r"(?:(?<=[\s\"']/)>|>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>?|\Z)|\Z))"
    r"|<!--.*?(?:-->|\Z)|<[!?/][^>]*>?|(?P<lone><)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(rf"(=?[^\s/>=]+)(?:\s*=\s*({_VALUE})?)?|[\s/=]")


def _values(attributes: str, names: tuple[str, ...]) -> list[str]:
    """The values of the attributes of these names."""
    found = (m for m in _ATTRIBUTE.finditer(attributes) if m[2] and m[1].lower() in names)
    return [m[2][1:].removesuffix(m[2][0]) if m[2][0] in "\"'" else m[2] for m in found]


SLOT = "#"
# First characters of two; no second one is among them, so a repeat begins and ends with a symbol.
_FIRSTS = 10_000
_REPEAT = {
    1: re.compile(rf"(.{{1,{MAX_FOLD}}}?)\1+", re.S),
    2: re.compile(rf"((?:[{chr(0x100)}-{chr(0x100 + _FIRSTS - 1)}].){{1,{MAX_FOLD}}}?)\1+", re.S),
}


def _side_words(attributes: str) -> set[str]:
    """Side words of the classes and ids that name a side region as a whole.

    Every part of such a token is a side word or a place word: ``right-sidebar``
    and ``cookieNotice`` are regions, ``no-sidebar`` and ``comment-open`` are not.
    """
    found: set[str] = set()
    for token in " ".join(_values(attributes, ("class", "id"))).split():
        spread = re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()
        parts = {x for x in re.split(r"[^a-z]+", spread) if x}
        side = parts & SIDE_WORDS
        if parts <= SIDE_WORDS | PLACE_WORDS and not (parts & _OF_TEXT and side <= _TITLES):
            found |= side
    return found


_SYMBOLS: dict[tuple[str, str], str] = {}


def symbol(name: str, attributes: str) -> str:
    """An element in a wrapper: its name and classes, and a mark of a region without main text.

    The mark is ``!``, or ``?!`` by classes that yield if the region holds the page's article.
    """
    known = _SYMBOLS.get((name, attributes))
    if known is None:
        if len(_SYMBOLS) > 10_000:
            _SYMBOLS.clear()
        known = _SYMBOLS[name, attributes] = _symbol(name, attributes)
    return known


def _symbol(name: str, attributes: str) -> str:
    named = _values(attributes, ("class",)) if "class" in attributes.lower() else []
    classes = ".".join(sorted(named[0].split())) if named else ""
    mark = "!" if name in SIDE_ELEMENTS else ""
    if not mark and name in CONTAINERS and name not in WHOLE_ELEMENTS:
        words = _side_words(attributes)
        mark = "!" if words & _OF_CARDS else "?!" if words else ""
    return f"{name}{'.' + classes if classes else ''}{mark}"


class Page:
    """The stream of a page, and the region and block of each of its texts."""

    def __init__(self, page: str) -> None:
        self.stream: list[str] = []
        self.texts: list[tuple[str, int, str]] = []
        regions: list[str] = []
        region, block = "", 0
        for match in _TOKEN.finditer(page):
            kind = match.lastgroup
            if kind == "text" or kind == "lone":
                text = match[0]
                self.texts.append((region, block, text))
                if (not self.stream or self.stream[-1] != SLOT) and not text.isspace():
                    self.stream.append(SLOT)
                continue
            if kind != "attributes":
                continue  # a comment, a declaration, a script or the like
            close, name, attributes = match["close"], match["name"].lower(), match["attributes"]
            if name not in INLINE:
                block += 1
            elif name == "br":
                self.texts.append((region, block, " "))
            if close:
                self.stream.append("/" + name)
                if name in CONTAINERS:
                    _leave(regions, name)
                    region = ">".join(regions)
                continue
            if attributes and name not in CONTAINERS and "class" not in attributes:
                attributes = ""
            own = symbol(name, attributes)
            self.stream.append(own)
            if name in CONTAINERS:
                regions.append(own)
                region = ">".join(regions)


def _leave(regions: list[str], name: str) -> None:
    """Leave the innermost region of this name with all inside it; nothing if there is none."""
    for k in reversed(range(len(regions))):
        if _name(regions[k]) == name:
            del regions[k:]
            return


def _name(own: str) -> str:
    return own.rstrip("?!").split(".")[0]


def _character(n: int) -> str:
    """The n-th character from the first one that is no surrogate and no ASCII."""
    return chr(0x100 + n if n < 0xD800 - 0x100 else 0xE000 + n - (0xD800 - 0x100))


def _code(n: int, width: int) -> str:
    """The n-th symbol in so many characters."""
    if width == 1:
        return _character(n)
    first, second = divmod(n, MAX_SYMBOLS)
    return _character(first) + _character(_FIRSTS + second)


def _width(stream: list[str]) -> int:
    """The characters that each symbol of the stream and of its groups needs to be told apart."""
    # Every group that is made stands for two items at least.
    return 1 if len(set(stream)) + len(stream) // 2 <= MAX_SYMBOLS else 2


def folded(stream: Iterable[str]) -> list:
    """:func:`folded_whole` of a stream for which one character a symbol will do.

    A stream of more symbols than there are characters for is left as it is; the
    operator does not go this way.
    """
    stream = list(stream)
    return folded_whole(stream, 1) if _width(stream) == 1 else stream


def folded_whole(stream: Iterable[str], width: int | None = None) -> list:
    """Neighbouring repeats as ``["+", group]``; a group may hold groups.

    Each symbol is one character while repeats are looked for, or two if the stream
    has more symbols than there are characters for: the repeats are the same.
    """
    stream = list(stream)
    width = width or _width(stream)
    characters: dict = {}
    text = "".join(characters.setdefault(x, _code(len(characters), width)) for x in stream)
    items: dict = {character: x for x, character in characters.items()}
    slots = {characters.get(SLOT)}

    def symbols(text: str) -> Iterable[str]:
        return text if width == 1 else (text[k : k + width] for k in range(0, len(text), width))

    def fold(match: re.Match) -> str:
        group = match[1]
        if len(group) == width and isinstance(items[group], list):
            return group
        if slots.isdisjoint(symbols(group)):
            return match[0]
        made = characters.setdefault("+" + group, _code(len(characters), width))
        items[made] = ["+", [items[x] for x in symbols(group)]]
        bodies[made] = group
        slots.add(made)
        return made

    bodies: dict[str, str] = {}
    while True:
        shorter = _REPEAT[width].sub(fold, text)
        for made, group in bodies.items():
            shorter = shorter.replace(made + group, made).replace(group + made, made)
        if shorter == text:
            return [items[x] for x in symbols(text)]
        text = shorter


def _fits(group: list, items: list, at: int) -> int:
    """How many items from ``at`` on are the group itself, once or more."""
    n = 0
    while items[at + n : at + n + len(group)] == group:
        n += len(group)
    return n


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of items found exactly once on either side, as many as rise together."""
    sides = []
    for items in (a, b):
        places: dict = {}
        for k, item in enumerate(items):
            places.setdefault(json.dumps(item), []).append(k)
        sides.append({key: own[0] for key, own in places.items() if len(own) == 1})
    first, second = sides
    pairs = sorted((k, second[key]) for key, k in first.items() if key in second)
    tails: list[int] = []  # the least end of a rising run of each length
    at: list[int] = []
    before: list[int] = []
    for k, (_, place) in enumerate(pairs):
        n = bisect_left(tails, place)
        tails[n : n + 1], at[n : n + 1] = [place], [k]
        before.append(at[n - 1] if n else -1)
    run, k = [], at[-1] if at else -1
    while k >= 0:
        run.append(pairs[k])
        k = before[k]
    return run[::-1]


def align(wrapper: list, stream: list) -> list:
    """The wrapper that matches what either side matches.

    Equal items stay. A repeated group absorbs its single occurrences on the
    other side, and two repeated or optional groups are aligned inside. The
    rest, by longest common subsequence, becomes optional. What both sides begin
    and end with is set aside first; two long middles are cut at the items that
    either has exactly once, and where there are none, both become optional.
    """
    if wrapper == stream:
        return wrapper
    n, m = len(wrapper), len(stream)
    if n * m <= MAX_CELLS:
        return _aligned(wrapper, stream)
    shorter = min(n, m)
    head = next((k for k in range(shorter) if wrapper[k] != stream[k]), shorter)
    tail = next(
        (k for k in range(shorter - head) if wrapper[-1 - k] != stream[-1 - k]), shorter - head
    )
    if head or tail:
        middle = align(wrapper[head : n - tail], stream[head : m - tail])
        return wrapper[:head] + middle + wrapper[n - tail :]
    anchors = _anchors(wrapper, stream)
    if not anchors:
        return [["?", side] for side in (wrapper, stream) if side]
    out: list = []
    i = j = 0
    for a, b in [*anchors, (n, m)]:
        out += align(wrapper[i:a], stream[j:b]) + wrapper[a : a + 1]
        i, j = a + 1, b + 1
    return out


def _aligned(wrapper: list, stream: list) -> list:
    n, m = len(wrapper), len(stream)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    step: list[list] = [[None] * (m + 1) for _ in range(n + 1)]
    for i in reversed(range(n)):
        for j in reversed(range(m)):
            options = [(best[i + 1][j], (1, 0)), (best[i][j + 1], (0, 1))]
            a, b = wrapper[i], stream[j]
            if a == b or isinstance(a, list) and isinstance(b, list) and a[0] == b[0] == "+":
                options.append((best[i + 1][j + 1] + 1, (1, 1)))
            elif isinstance(a, list):
                k = _fits(a[1], stream, j)
                if k:
                    options.append((best[i + 1][j + k] + k, (1, k)))
            elif isinstance(b, list):
                k = _fits(b[1], wrapper, i)
                if k:
                    options.append((best[i + k][j + 1] + k, (k, 1)))
            best[i][j], step[i][j] = max(options, key=lambda x: x[0])
    out: list = []
    i = j = 0
    left: list = []
    right: list = []

    def optional() -> None:
        for part in (left, right):
            if part:
                whole = len(part) == 1 and isinstance(part[0], list) and part[0][0] == "?"
                out.append(part[0] if whole else ["?", part[:]])
                part.clear()

    while i < n or j < m:
        di, dj = step[i][j] if i < n and j < m else (int(i < n), int(i >= n))
        if (di, dj) == (1, 0):
            left.append(wrapper[i])
        elif (di, dj) == (0, 1):
            right.append(stream[j])
        else:
            optional()
            a, b = wrapper[i], stream[j]
            if isinstance(a, list) and isinstance(b, list) and a != b:
                out.append(["+", align(a[1], b[1])])
            else:
                out.append(a if isinstance(a, list) else b)
        i, j = i + di, j + dj
    optional()
    return out


def infer(streams: Iterable[list]) -> list:
    """One wrapper of all streams; the order of the streams is fixed by their text."""
    wrapper: list | None = None
    for text in sorted({json.dumps(x) for x in streams}, key=lambda x: (len(x), x)):
        stream = json.loads(text)
        wrapper = stream if wrapper is None else align(wrapper, stream)
    return wrapper or []


def as_regex(wrapper: list) -> str:
    """The wrapper as a regular expression over symbols."""
    return " ".join(
        f"( {as_regex(x[1])} ){x[0]}" if isinstance(x, list) else x for x in wrapper
    )


def menus(wrapper: list) -> set[str]:
    """Regions of repeated groups in which every slot is a link."""
    found: set[str] = set()
    kept: set[str] = set()

    def walk(items: list, regions: list[str], link: int, repeated: bool) -> int:
        for item in items:
            if isinstance(item, list):
                link = walk(item[1], regions, link, repeated or item[0] == "+")
            elif item == SLOT:
                (found if link and repeated else kept).add(">".join(regions))
            elif item[0] == "/":
                link -= item == "/a" and link > 0
                if item[1:] in CONTAINERS:
                    _leave(regions, item[1:])
            else:
                link += _name(item) == "a"
                if _name(item) in CONTAINERS:
                    regions.append(item)
        return link

    walk(wrapper, [], 0, False)
    return found - kept


def is_side(region: str) -> bool:
    return any(part.endswith("!") for part in region.split(">"))


def _inside(region: str) -> bool:
    return any(_name(part) in ("article", "main") for part in region.split(">"))


def _freed(region: str, mains: bool) -> str:
    """The region without the marks by class around its outermost ``main`` (or article)."""
    parts = region.split(">")
    names = ("main",) if mains else ("article", "main")
    at = next((k for k, part in enumerate(parts) if _name(part) in names), 0)
    return ">".join([*(part.removesuffix("?!") for part in parts[:at]), *parts[at:]])


def _teasers(texts: list, told: dict[str, str], menu_regions: set[str]) -> bool:
    """Whether a page without ``main`` has articles that hold but a small part of its text."""
    inside = outside = 0
    for region, _, text in texts:
        if is_side(told.get(region, region)) or region in menu_regions:
            continue
        if any(_name(part) == "main" for part in region.split(">")):
            return False
        size = len("".join(text.split()))
        inside, outside = inside + size * _inside(region), outside + size * (not _inside(region))
    return inside < LEAST_ARTICLE * (inside + outside)


def main_text(page: str, menu_regions: set[str]) -> str:
    """The blocks of a page in the slots that hold main text."""
    texts = Page(page).texts
    regions = {region for region, _, text in texts if not text.isspace()}
    within = any(_inside(region) and not is_side(region) for region in regions)
    # Classes never make a side region of what holds the main element, or all articles.
    told = {
        region: _freed(region, within) for region, _, _ in texts if "?!" in region and _inside(region)
    }
    within = within or any(_inside(x) and not is_side(x) for x in told.values())
    within = within and not _teasers(texts, told, menu_regions)
    kept: dict[str, bool] = {}
    blocks: dict[int, list[str]] = {}
    for region, block, text in texts:
        if region not in kept:
            side = is_side(told.get(region, region)) or region in menu_regions
            kept[region] = not side and (not within or _inside(region))
        if kept[region]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n".join(line for line in lines if line)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        found = {
            (host, json.dumps(folded_whole(Page(page or "").stream)))
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist())
        }
        hosts, streams = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_pydict(
            {"host": pa.array(hosts, pa.string()), "stream": pa.array(streams, pa.string())}
        )


def _wrap(pdf: pd.DataFrame) -> pd.DataFrame:
    wrapper = infer(json.loads(x) for x in pdf["stream"])
    return pd.DataFrame({"host": pdf["host"].iloc[:1], "stream": [json.dumps(wrapper)]})


def _described(pdf: pd.DataFrame) -> pd.DataFrame:
    wrapper = json.loads(pdf["stream"].iloc[0])
    return pd.DataFrame(
        {
            "host": pdf["host"].iloc[:1],
            "wrapper": [as_regex(wrapper)],
            "menus": ["\n".join(sorted(menus(wrapper)))],
        }
    )


def wrappers(pages: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``(host, wrapper, menus)`` of ``pages(host, html)``.

    The streams of a host are aligned in groups of about ``fan_in``, then the
    wrappers of the groups, and so on until each host has one.
    """
    streams = cut(pages.mapInArrow(_streams, "host string, stream string").distinct())
    while True:
        counts = streams.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        if fits_broadcast(counts):
            counts = F.broadcast(counts)
        parts = F.ceil(F.col("n") / F.lit(fan_in)).cast("long")
        part = F.pmod(F.xxhash64("stream"), parts)
        dealt = streams.join(counts, "host").select("host", "stream", part.alias("part"))
        streams = cut(
            dealt.groupBy("host", "part").applyInPandas(
                lambda pdf: _wrap(pdf), "host string, stream string"
            ).distinct()
        )
    return streams.groupBy("host").applyInPandas(
        lambda pdf: _described(pdf), "host string, wrapper string, menus string"
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        regions = [set(x.split("\n")) if x else set() for x in batch["menus"].to_pylist()]
        texts = [main_text(page or "", own) for page, own in zip(batch["html"].to_pylist(), regions)]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """``(page_id, url, text)`` of every page."""
    host = F.coalesce(host_of(F.col(url)), F.lit(""))
    narrow = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"),
        host.alias("host"),
    )
    found = cut(wrappers(narrow.select("host", "html"))).select("host", "menus")
    if fits_broadcast(found):
        found = F.broadcast(found)
    kind = narrow.schema["page_id"].dataType.simpleString()
    return (
        narrow.join(found, "host", "left").select("page_id", "url", "html", "menus")
        .mapInArrow(_extracted, f"page_id {kind}, url string, text string")
    )
