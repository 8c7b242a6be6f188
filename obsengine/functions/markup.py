"""HTML by a tokenizer and a stack of open elements, in built-in expressions.

A page is cut into tokens (comments, declarations, script and style elements,
tags with quoted attributes, text).  A fold over the tokens keeps the elements
that are open: a start tag is pushed, an end tag closes the nearest open
element of its name and all inside, and one that closes nothing is ignored.
Fields are taken where they stand in that stack, so the order of attributes,
further classes, either kind of quotes, comments and nested elements don't
matter.  Character references are decoded by the HTML rules, numeric ones and
all names.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content, and the selectors of the layout.
VOID = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)
CARD, CARD_CLASS = "article", "product_pod"
TITLE_IN, NEXT_IN, NEXT_CLASS = "h3", "li", "next"
PRICE_CLASS, AVAILABILITY_CLASS, RATING_CLASS = "price_color", "availability", "star-rating"

_INSIDE = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
TOKEN_RE = (
    r"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*+>?"
    rf"|<(?:script|style)\b{_INSIDE}>.*?(?:</(?:script|style)\b[^>]*+>|\z)"
    rf"|</?[a-z]{_INSIDE}>|[^<]++|<"
)
_NAME_RE = r"^</?([A-Za-z][^\s/>]*)"
_ATTRIBUTE_RE = r"""[\s/"']([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?"""

_CARD = "struct<title:string,href:string,price:string,availability:string,rating:string>"
_STATE = f"struct<stack:array<struct<name:string,mark:string>>,cards:array<{_CARD}>,card:{_CARD},depth:int,next:string>"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------ character references

_BLANK = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f\x{85}]"
#: Names without a semicolon are at most so long.
_SHORT = max(len(n) for n in html5 if not n.endswith(";"))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"^{_BLANK}+|{_BLANK}+\z", "")


def _character(code: Column) -> Column:
    """The character of a code point, as the HTML rules read it: bytes of
    Windows-1252 where Unicode has controls, and no character for what is none."""
    point = F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit(0xFFFD)).otherwise(code)
    high = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    windows = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}
    table = F.from_json(F.lit(json.dumps({str(k): v for k, v in windows.items()})), "map<string,string>")
    none = (
        code.between(1, 8) | code.between(0xE, 0x1F) | (code == 0xB) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
        | ((code <= 0x10FFFF) & (code % 0x10000 >= 0xFFFE))
    )
    return F.when(none, F.lit("")).when(code.between(0x80, 0x9F), F.try_element_at(table, code.cast("string"))).otherwise(high)


def _reference(part: Column) -> Column:
    """What stands for the text behind an ampersand."""
    number = F.regexp_extract(part, r"^#([0-9]+);?", 1)
    sixteen = F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]+);?", 1)
    rest = F.regexp_replace(part, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")
    large = F.lit(0x110000)
    code = F.when(number != "", F.coalesce(number.try_cast("long"), large)).otherwise(
        F.when(F.length(F.ltrim(F.lit("0"), sixteen)) > 8, large).otherwise(F.conv(sixteen, 16, 10).cast("long"))
    )
    code = F.when(code > 0x10FFFF, large).otherwise(code)
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]{0,40};?)", 1)
    found = F.try_element_at(names, name)
    out = F.concat(F.lit("&"), part)
    for n in range(2, _SHORT + 1):  # the longest known beginning wins, so it is asked first
        known = F.try_element_at(names, F.substring(name, 1, n))
        out = F.when(known.isNotNull() & (F.length(name) >= n), F.concat(known, F.substring(part, n + 1, 1 << 30))).otherwise(out)
    out = F.when(found.isNotNull(), F.concat(found, F.substring(part, F.length(name) + 1, F.length(part)))).otherwise(out)
    return F.when((number != "") | (sixteen != ""), F.concat(_character(code), rest)).when(name != "", out).otherwise(F.concat(F.lit("&"), part))


def unescape(c: str | Column) -> Column:
    """Text with all character references decoded."""
    c = _col(c)
    parts = F.split(c, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _reference)
    return F.when(c.contains("&"), F.concat(parts[0], F.array_join(rest, ""))).otherwise(c)


# ---------------------------------------------------------------- the tokens


def tokens(html: str | Column) -> Column:
    return F.regexp_extract_all(_col(html), F.lit(TOKEN_RE), 0)


def attribute(tag: Column, name: str) -> Column:
    """A tag's attribute as it is written, the last of equal ones; '' where it
    has no value, NULL where there is none."""
    names = F.reverse(F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE_RE), 1), F.lower))
    values = F.reverse(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE_RE), 2))
    at = F.array_position(names, name)
    value = F.get(values, (at - 1).cast("int"))
    return F.when(at > 0, F.regexp_replace(value, r"""^["']|["']$""", ""))


def _raw(t: Column) -> Column:
    """A token's parts as they are written; each is read once."""
    token, name = t["token"], t["name"]
    opens = t["kind"] == "open"
    anchor = opens & (name == "a")
    return F.struct(
        t["kind"].alias("kind"),
        name.alias("name"),
        F.when(opens & token.contains("="), attribute(token, "class")).alias("classes"),
        F.when(anchor, attribute(token, "href")).alias("href"),
        F.when(anchor, attribute(token, "title")).alias("title"),
        (name.isin(*VOID) | token.endswith("/>")).alias("empty"),
        F.when(t["kind"] == "text", token).alias("text"),
    )


def _parsed(t: Column) -> Column:
    classes = F.when(t["classes"].isNotNull(), F.split(strip(t["classes"]), r"\s+"))
    return F.struct(
        t["kind"].alias("kind"),
        t["name"].alias("name"),
        F.coalesce(classes, F.array().cast("array<string>")).alias("classes"),
        unescape(t["href"]).alias("href"),
        unescape(t["title"]).alias("title"),
        t["empty"].alias("empty"),
        strip(unescape(t["text"])).alias("text"),
    )


def parsed_tokens(html: str | Column) -> Column:
    """A page's tokens in order: kind (open, close, text, none), name, classes,
    an anchor's href and title, whether it is empty, and its text."""
    named = F.transform(
        tokens(html), lambda t: F.struct(t.alias("token"), F.when(t.startswith("<"), F.lower(F.regexp_extract(t, _NAME_RE, 1))).otherwise("").alias("name"))
    )
    code = lambda x: x["name"].isin("script", "style") & ~x["token"].startswith("</")
    kind = lambda x: (
        F.when(code(x), "none").when(x["name"] != "", F.when(x["token"].startswith("</"), "close").otherwise("open"))
        .when(x["token"].startswith("<") & (F.length(x["token"]) > 1), "none").otherwise("text")
    )
    kinds = F.transform(named, lambda x: F.struct(x["token"].alias("token"), x["name"].alias("name"), kind(x).alias("kind")))
    return F.transform(F.transform(kinds, _raw), _parsed)


# ------------------------------------------------------------------- the fold


def _step(state: Column, token: Column) -> Column:
    stack, card, classes, name = state["stack"], state["card"], token["classes"], token["name"]
    within = card.isNotNull()
    marked = lambda mark: F.exists(stack, lambda e: e["mark"] == mark)
    has = lambda c: F.array_contains(classes, c)
    opens, closes = token["kind"] == "open", token["kind"] == "close"

    begins = opens & ~within & (name == CARD) & has(CARD_CLASS)
    price = opens & within & has(PRICE_CLASS) & card["price"].isNull()
    stock = opens & within & has(AVAILABILITY_CLASS) & card["availability"].isNull()
    mark = (
        F.when(begins, "card").when(within & (name == TITLE_IN), "title").when((name == NEXT_IN) & has(NEXT_CLASS), "next")
        .when(price, "price").when(stock, "stock").otherwise("")
    )
    anchor = opens & (name == "a")
    titled = anchor & within & card["href"].isNull() & card["title"].isNull() & marked("title")
    rated = opens & within & has(RATING_CLASS) & card["rating"].isNull()
    text = (token["kind"] == "text") & within & (token["text"] != "")
    into = lambda field, sign, mark: F.when(text & marked(mark), F.concat_ws(sign, F.nullif(field, F.lit("")), token["text"])).otherwise(field)
    now = F.struct(
        F.when(titled, token["title"]).otherwise(card["title"]).alias("title"),
        F.when(titled, F.coalesce(token["href"], F.lit(""))).otherwise(card["href"]).alias("href"),
        F.when(price, F.lit("")).otherwise(into(card["price"], "", "price")).alias("price"),
        F.when(stock, F.lit("")).otherwise(into(card["availability"], " ", "stock")).alias("availability"),
        F.when(rated, F.coalesce(F.get(F.filter(classes, lambda c: c != RATING_CLASS), 0), F.lit(""))).otherwise(card["rating"]).alias("rating"),
    )
    fresh = F.from_json(F.lit("{}"), _CARD)

    place = F.array_position(F.reverse(F.transform(stack, lambda e: e["name"])), name)
    left = (F.size(stack) - place).cast("int")  # elements that stay open
    shut = closes & (place > 0)
    pushed = F.array_append(stack, F.struct(name.alias("name"), mark.alias("mark")))
    ended = shut & within & (left < state["depth"])
    return F.struct(
        F.when(opens & ~token["empty"], pushed).when(shut, F.slice(stack, 1, left)).otherwise(stack).alias("stack"),
        F.when(ended, F.array_append(state["cards"], card)).otherwise(state["cards"]).alias("cards"),
        F.when(begins, fresh).when(ended, F.lit(None)).when(within, now).alias("card"),
        F.when(begins, F.size(stack) + 1).otherwise(state["depth"]).alias("depth"),
        F.coalesce(state["next"], F.when(anchor & marked("next"), token["href"])).alias("next"),
    ).cast(_STATE)


def read_listing(html: str | Column) -> Column:
    """(cards, next): the product cards of a listing page in order, with
    their texts as written, and the href of its link to the next page."""
    start = F.from_json(F.lit('{"stack":[],"cards":[],"depth":0}'), _STATE)

    def finish(state: Column) -> Column:
        # an element that is open at the page's end ends there
        cards = F.when(state["card"].isNotNull(), F.array_append(state["cards"], state["card"])).otherwise(state["cards"])
        return F.struct(cards.alias("cards"), state["next"].alias("next"))

    return F.aggregate(parsed_tokens(html), start, _step, finish)


def anchors(html: str | Column) -> Column:
    """The hrefs of all anchors of a page that have one, in order."""
    found = F.filter(parsed_tokens(html), lambda t: (t["kind"] == "open") & t["href"].isNotNull())
    return F.transform(found, lambda t: t["href"])
