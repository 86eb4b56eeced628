"""The page parser against a second parser, and on broken pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from docloom.functions import markup
from docloom.operators import parse as P


class Second(HTMLParser):
    """Visible text between block tags, by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.found, self.held, self.hidden = [], "", 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.held.strip(markup.WHITE).strip():
            self.found.append(self.held.strip(markup.WHITE))
        self.held = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.held += "\n"
        elif tag in markup.BLOCKS:
            self.flush()
        self.hidden += tag in markup.RAW

    def handle_endtag(self, tag):
        if tag in markup.BLOCKS:
            self.flush()
        self.hidden -= tag in markup.RAW

    def handle_data(self, data):
        self.held += "" if self.hidden else data


def texts(page):
    return [text for _, text, _ in markup.Elements(page).found]


def kinds(page):
    return [(kind, text) for kind, text, _ in markup.Elements(page).found]


def test_texts_are_those_of_a_second_parser():
    draw = random.Random(6)
    parts = ["a &amp; b", " &lt;c&gt; &#233;&eacute;", "<p>", "</p>", '<div title="x > y">', "</div>", "<b>", "</b>", "<br>", "<ul><li>", "</li>", "</ul>", "<!-- <p>no</p> -->", "<script>if (a < b) '</p>'</script>", "<table><tr><td>", "<td>", "</table>", "<h2>", "</h2>", "1 < 2", "\n", "<style>p{}</style>", "<P CLASS='q'>", "&copy;", "&unknown;"]
    for _ in range(3000):
        page = "".join(draw.choices(parts, k=draw.randrange(1, 16)))
        assert texts(page) == Second(page).found


def test_nesting_names_the_kind():
    page = "<li>one<p>two</p>three<ul><li>in</ul>four</li>five<td>x<h3>head<p>cell</td><pre>  a\n b</pre>"
    assert kinds(page) == [("list_item", t) for t in ("one", "two", "three", "in", "four")] + [("text", "five"), ("table_cell", "x"), ("section_header", "head"), ("section_header", "cell"), ("preformatted", "a\n b")]
    assert markup.Elements("<div><p>a<p>b</div>c").found == [("text", "a", ("div", "p")), ("text", "b", ("div", "p")), ("text", "c", ())]
    assert markup.Elements("<ul><li>a<li>b</ul>").found[1][2] == ("ul", "li")


def test_what_never_ends_takes_the_rest():
    assert texts("a<!-- b <p>c") == ["a"] and texts("a<script>b<p>c") == ["a"] and texts("a<p title='b>c") == ["a"]
    assert texts("a<!--x-->b<!doctype c>d<?e?>f</ g>h") == ["abdfh"] and texts("x <3 y & z") == ["x <3 y & z"]
    assert texts(None or "") == [] and texts("<p> &nbsp; </p>") == []


def test_cells_of_tables(spark):
    page = "<table><tr><th>h1<th>h2<tr><td>a<td>b<p>c</table>x<table><td>1<table><tr><td>in</table>2</table>"
    rows = spark.createDataFrame([(7, page), (8, None)], "page_id int, html string")
    got = [tuple(r) for r in P.table_cells(rows, ["page_id"]).collect()]
    assert got == [(7, 0, 0, 0, True, "h1"), (7, 0, 0, 1, True, "h2"), (7, 0, 1, 0, False, "a"), (7, 0, 1, 1, False, "b\nc"), (7, 1, 0, 0, False, "1\n2"), (7, 2, 0, 0, False, "in")]


@pytest.mark.parametrize("opening", ["<!-- x ", "<p ", "<script>", "<div>", "<p title='", "<", "</div>", "<table><tr><td>", "<li>", "&amp", "<p a= b c="])
def test_broken_pages_take_time_by_their_length(opening):
    def seconds(n):
        start = time.process_time()
        markup.Elements(opening * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(160_000) < 10 * max(seconds(40_000), 0.05)
