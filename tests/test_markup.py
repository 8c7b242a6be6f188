"""Listing pages in any legal spelling, against the standard library's parser."""

from __future__ import annotations

import html as stdlib
from html.entities import html5
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsengine.functions import markup as M

VOID = set(M.VOID)


class Listing(HTMLParser):
    """The same fields by a parser with a list of open elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.cards, self.card, self.at, self.next = [], [], None, 0, None

    def handle_starttag(self, name, attrs):
        self.start(name, dict(attrs), name in VOID)

    def handle_startendtag(self, name, attrs):
        self.start(name, dict(attrs), True)

    def start(self, name, attrs, empty):
        classes = (attrs.get("class") or "").split()
        card, mark = self.card, ""
        if card is None and name == "article" and "product_pod" in classes:
            self.card, mark = {"title": None, "href": None, "price": None, "availability": None, "rating": None}, "card"
            self.at = len(self.open)
        elif card is not None and name == "h3":
            mark = "title"
        elif name == "li" and "next" in classes:
            mark = "next"
        elif card is not None and "price_color" in classes and card["price"] is None:
            card["price"], mark = "", "price"
        elif card is not None and "availability" in classes and card["availability"] is None:
            card["availability"], mark = "", "availability"
        marks = [m for _, m in self.open]
        if name == "a" and card is not None and "title" in marks and card["href"] is None and card["title"] is None:
            card["title"], card["href"] = attrs.get("title", None), attrs.get("href") or ""
        if card is not None and "star-rating" in classes and card["rating"] is None:
            card["rating"] = next((c for c in classes if c != "star-rating"), "")
        if name == "a" and self.next is None and "next" in marks and "href" in attrs:
            self.next = attrs["href"] or ""
        if not empty:
            self.open.append((name, mark))

    def handle_endtag(self, name):
        places = [i for i, (n, _) in enumerate(self.open) if n == name]
        if places:
            del self.open[places[-1]:]
            if self.card is not None and len(self.open) <= self.at:
                self.cards.append(self.card)
                self.card = None

    def handle_data(self, data):
        data = data.strip()
        code = self.open and self.open[-1][0] in ("script", "style")  # code is no text
        if self.card is not None and data and not code:
            for field, sign in (("price", ""), ("availability", " ")):
                if field in [m for _, m in self.open]:
                    self.card[field] = sign.join(x for x in (self.card[field], data) if x)


def expected(page):
    p = Listing()
    p.feed(page)
    p.close()
    return [tuple(c.values()) for c in p.cards + ([p.card] if p.card else [])], p.next


def got(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    rows = df.select("i", M.read_listing("html").alias("x")).orderBy("i").collect()
    return [([tuple(c) for c in r["x"]["cards"]], r["x"]["next"]) for r in rows]


CARD = """<article {a}><h3><a {t}>x</a></h3><p {r}></p><div><p {p}>{price}</p><p {s}> {stock} </p></div></article>"""
USUAL = dict(a='class="product_pod"', t='href="b.html" title="B"', r='class="star-rating Two"', p='class="price_color"',
             price="£5.00", s='class="instock availability"', stock="<i></i>In stock")
VARIANTS = [
    {},
    {"a": "class='product_pod featured'"},
    {"a": 'id=x data-x="<article>" class = "big\n product_pod"'},
    {"a": "CLASS=product_pod"},
    {"a": 'class="product_pods"'},
    {"t": "title='A \"quoted\" > name' href='x?a=1&amp;b=2'"},
    {"t": 'title="Tea &amp; Cake &#8364;&#x20AC; &eacute;&copy 2 &notit; &bogus;" class="t" href="/a"'},
    {"t": 'data-title="no" title="yes" href="1" href="2"'},
    {"t": "title= href=empty"},
    {"t": 'href="only"'},
    {"r": 'class="Four star-rating"'},
    {"r": 'class="star-rating"'},
    {"price": "<!-- £9 --> £<b>5</b>.<i>00</i><!--x-->"},
    {"price": "&pound;7,50"},
    {"stock": "<span>In</span>\n <b>stock</b> (3)"},
    {"p": "class='x price_color' title='class=\"y\"'"},
    {"stock": "In <br> stock <br/> now<img src='>'>"},
    {"stock": "a</b></i> b"},
    {"price": '<script>var x = "</p><article class=\'product_pod\'>";</script>£3'},
    {"stock": "1 < 2 & 3 > 2"},
]


@pytest.mark.parametrize("end", ["</li>", ""])
def test_spellings(spark, end):
    cards = [CARD.format(**{**USUAL, **v}) for v in VARIANTS]
    nested = '<article class="product_pod"><h3><a href="1" title="one"><a href="2" title="two"></a></a></h3><li class="next"><a href="in"></a></li></article>'
    pages = [
        *cards, "".join(cards), f"<!-- {cards[0]} -->" + cards[1], nested, "", "no markup", "<article class=product_pod><h3><a href=x title=y>",
        "<style>article{}</style>" + cards[2] + '<ul><li class="next last"><!-- <a href="no"> --><a\thref=\'page-2.html\'>next</a>' + end,
        '<li class="next"><a>no href</a><a href="p3">x</a></li><li class=next><a href="p4">', "<article class='product_pod'></p></div><h3></article>x",
    ]
    for page, have in zip(pages, got(spark, pages), strict=True):
        assert have == expected(page), page


soup = st.lists(
    st.sampled_from([
        "<article class='product_pod'>", "</article>", "<h3>", "</h3>", "<a href=1 title=t>", "</a>", "<p class=price_color>", "</p>",
        "<p class='x availability'>", "£5", " In stock ", "<i class='star-rating One'>", "</i>", "<br>", "<div/>", "<li class=next>", "</li>",
        "<!-- <a> -->", "&amp;", "<a href='2'>", "<b>", "</b>",
    ]), max_size=25,
).map("".join)


@settings(max_examples=20, deadline=None)
@given(st.lists(soup, min_size=1, max_size=30))
def test_any_nesting(spark, pages):
    for page, have in zip(pages, got(spark, pages), strict=True):
        assert have == expected(page), page


reference = st.one_of(
    st.sampled_from(["&amp;", "&lt", "&notit;", "&NotEqualTilde;", "&copy", "&copyx", "&;", "&", "&#;", "&#x;", "&hellip;", "&AMP", "&ampamp;", "&fjlig;"]),
    st.integers(0, 0x110010).map(lambda n: f"&#{n};"), st.integers(0, 0x300).map(lambda n: f"&#x{n:x}"),
    st.sampled_from(["&#0;", "&#128;", "&#129;", "&#xD800;", "&#xFFFE;", "&#99999999999999999999;", "&#x00000000000041;", "x", " ", "#", ";", "a1"]),
)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(reference, max_size=8).map("".join), min_size=1, max_size=40))
def test_references(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", M.unescape("t").alias("u")).collect():
        assert r["u"] == stdlib.unescape(r["t"]), r["t"]


def test_all_names(spark):
    names = ["&" + n + " z" for n in html5]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    assert all(r["u"] == stdlib.unescape(r["t"]) for r in df.select("t", M.unescape("t").alias("u")).collect())


def test_anchors(spark):
    page = "<a href='1'>x<a HREF=\"2&amp;3\"></a></a><a name=x><!--<a href=4>--><A\nhref=5/><script><a href=6></script><a href>"
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(M.anchors("h")).first()[0] == ["1", "2&3", "5/", ""]
