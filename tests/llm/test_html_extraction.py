"""Awkward markup, long streams and wrappers that match what they were inferred from."""

import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketflow.llm import html_extraction as h


@pytest.mark.parametrize("page, text", [
    ("<p title=it's>Hello one</p><p>Second</p><p>don't stop</p>", "Hello one\nSecond\ndon't stop"),
    ("<p title=\"it's\">a</p><p title='say \"x\"'>b</p>", "a\nb"),
    ("<p data-x=\"a > b\">a</p><p data-y = 'c > d' >b</p>", "a\nb"),
    ("<p =x y= z==w q'r s\"t>a</p><p>don't \"stop\"</p>", "a\ndon't \"stop\""),
    ("<p a='b'c=\"d\"e>a</p>", "a"),
    ("<p title=\"never closed>a</p><p>b</p>", "a\nb"),
    ("<p title=\"x>y</p><p id=\"z\">b</p>", "b"),
    ("<p x=/>a</p><br/>b<img src=/a/ alt=it's>c", "a\nbc"),
    ("<script data-x='a>b'>var t = '<p>no</p>';</script><p>a</p>", "a"),
    ("<script src=/js/>no</script><p>a</p>", "a"),
    ("<script src=\"x\" /><p>a</p>", "a"),
    ("<div class=x'y><p>a</p></div>", "a"),
    ("<div title=\"class=sidebar\"><p>a</p></div><div class = 'sidebar'><p>s</p></div>", "a"),
    ("<div data-class=sidebar><p>a</p></div><div CLASS=Sidebar>s</div>", "a"),
    ("<p\ntitle\n=\n'x>'\n>a</p>", "a"),
])
def test_attributes(page, text):
    assert h.main_text(page, set()) == text


@pytest.mark.parametrize("page, text", [
    ("<article>teaser</article><div><p>" + "real text " * 30 + "</p></div>", "teaser\n" + "real text " * 29 + "real text"),
    ("<article><p>" + "real text " * 30 + "</p></article><div>note</div>", "real text " * 29 + "real text"),
    ("<main><p>short</p></main><div>" + "long " * 99 + "</div>", "short"),
    ("<article>short</article><div class=sidebar>" + "long " * 99 + "</div>", "short"),
    ("<article></article><div>a</div>", "a"),
])
def test_articles_and_teasers(page, text):
    assert h.main_text(page, set()) == text


def expression(wrapper, names):
    """The wrapper as an expression over one character for each symbol."""
    def of(items):
        return "".join(
            f"(?:{of(x[1])}){x[0]}" if isinstance(x, list) else re.escape(names.setdefault(x, chr(0x4E00 + len(names))))
            for x in items
        )
    return of(wrapper)


def matches(wrapper, stream):
    names = {}
    pattern = expression(wrapper, names)
    text = "".join(names.setdefault(x, chr(0x4E00 + len(names))) for x in stream)
    return re.fullmatch(pattern, text) is not None


def random_stream(rng):
    stream = []
    for _ in range(rng.randint(0, 6)):
        part = rng.choice([["p", "#", "/p"], ["li", "a", "#", "/a", "/li"], ["#"], ["h2", "#", "/h2"], ["div"]])
        stream += part * rng.choice([1, 1, 2, 5])
    return stream


@pytest.mark.parametrize("cells", [1_000_000, 20, 0])
@pytest.mark.parametrize("seed", range(5))
def test_an_aligned_wrapper_matches_both_sides(monkeypatch, cells, seed):
    monkeypatch.setattr(h, "MAX_CELLS", cells)
    rng = random.Random(seed)
    for _ in range(60):
        a, b = random_stream(rng), random_stream(rng)
        wrapper = h.align(h.folded(a), h.folded(b))
        assert matches(wrapper, a) and matches(wrapper, b)


def test_150_000_symbols_do_not_stop_a_page():
    page = "".join(f"<div class=c{k}>t{k}</div>" for k in range(150_000))
    start = time.perf_counter()
    assert h.folded(h.Page(page).stream)
    text = h.main_text(page, set())
    assert text.count("\n") == 149_999 and text.startswith("t0\nt1\n")
    assert time.perf_counter() - start < 60


def test_pages_of_any_number_of_symbols_are_folded_alike(monkeypatch):
    rng = random.Random(8)
    streams = [
        [x for _ in range(rng.randint(0, 60)) for x in rng.choice(("p # /p", "p.a # /p", "li a # /a /li", "#", "br")).split()]
        for _ in range(300)
    ]
    expected = [h.folded(x) for x in streams]
    assert [h.folded_whole(x, 2) for x in streams] == expected
    pages = ["<ul>" + "<li><a>x</a></li>" * 20 + "</ul>", "<p>x</p>" * 30]
    batch = pa.RecordBatch.from_pydict({"host": ["a", "b"], "html": pages})
    whole = [b.to_pydict() for b in h._streams(iter([batch]))]
    monkeypatch.setattr(h, "MAX_SYMBOLS", 40)
    assert [h.folded_whole(x) for x in streams] == expected
    again = [b.to_pydict() for b in h._streams(iter([batch]))]
    assert [set(zip(*x.values())) for x in again] == [set(zip(*x.values())) for x in whole]


def test_more_symbols_than_characters_stay_unfolded(monkeypatch):
    monkeypatch.setattr(h, "MAX_SYMBOLS", 10)
    stream = ["p", "#", "/p"] * 20
    assert h.folded(stream) == stream
    monkeypatch.setattr(h, "MAX_SYMBOLS", 1_000_000)
    assert h.folded(stream) == [["+", ["p", "#", "/p"]]]


def test_symbols_are_no_surrogates():
    made = {h._character(k) for k in range(0, h.MAX_SYMBOLS, 997)} | {h._character(k) for k in (0xD6FF, 0xD700)}
    assert all(not 0xD800 <= ord(c) < 0xE000 for c in made)
    assert ord(h._character(h.MAX_SYMBOLS)) < 0x110000
    assert h._character(0xD6FF) == "퟿" and h._character(0xD700) == ""


def test_long_streams_are_aligned_in_time():

    def stream(seed):
        own = random.Random(seed)
        out = []
        for k in range(4000):
            out += [f"div.s{k}", "#", "/div"]
            if own.random() < 0.1:
                out += own.choice([["hr"], ["p", "#", "/p"], ["b", "/b", "i"]])
        return out

    a, b = stream(2), stream(3)
    start = time.perf_counter()
    wrapper = h.align(a, b)
    assert time.perf_counter() - start < 30
    assert "div.s17" in wrapper and "div.s3999" in wrapper
    # Neither side has a symbol of its own: nothing to hold on to, both are optional.
    c, d = ["x", "y"] * 5000, ["y", "x", "x"] * 5000
    start = time.perf_counter()
    assert h.align(c, d) == [["?", c], ["?", d]]
    assert time.perf_counter() - start < 5


def test_a_host_of_many_streams_is_wrapped_in_rounds(spark):
    rng = random.Random(4)
    rows = []
    for k in range(120):
        body = "".join(rng.choice(["<p>x</p>", "<h2>t</h2>", "<div class=d%d>q</div>" % rng.randrange(4)]) for _ in range(rng.randint(1, 7)))
        rows.append(("a.org", f"<div class=links><a>l</a>{'<a>m</a>' * rng.randint(1, 3)}</div>{body}"))
    rows += [("b.org", "<p>one</p>"), (None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "host string, html string").repartition(5)
    found = {r.host: r for r in h.wrappers(pages.withColumn("host", F.coalesce("host", F.lit(""))), fan_in=5).collect()}
    assert set(found) == {"a.org", "b.org", ""}
    assert found["a.org"].menus == "div.links" and found["b.org"].menus == ""
    texts = h.extract(
        pages.select(F.lit(1).alias("page_id"), F.concat(F.lit("http://"), "host", F.lit("/x")).alias("url"), "html")
    ).collect()
    assert len(texts) == 122 and not any("l" == x for r in texts for x in r.text.split("\n"))
