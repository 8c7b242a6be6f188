"""Product cards and links out of a table of HTML pages (page_id, url, html).

Re-aims the reference's crawler as a job over already-fetched pages: the
fetching itself (HTTP, retries, politeness sleeps) is not built.  Every
page is handled by the task that holds it; a card is one exploded row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions.scalars import price_text_to_double, rating_word_to_int
from ..functions.urls import base_of, with_resolved_url
from ..session import checkpoint_dir


def product_cards(pages: DataFrame, lenient: bool = False, as_of=None) -> DataFrame:
    """One row per product card: source (the page's directory), product_name,
    price_gbp, availability, rating_1to5, url (resolved), scraped_at.

    Cards are read from the markup by ``functions.markup``, in any legal
    spelling.  Price text drops the pound sign and reads a decimal comma;
    anything else (a stray character, thousands separators) gives NULL unless
    ``lenient``.  An unknown rating word gives NULL, and so does a field whose
    element the card lacks.  ``scraped_at`` is ``as_of`` (the load's stamp) or
    the current time.
    """
    c = pages.select("page_id", base_of("url").alias("source"), M.read_listing("html").alias("_read"))
    c = c.select("page_id", "source", F.posexplode("_read.cards").alias("card_no", "card"))
    stamp = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    # Fields first, URL resolution after: the resolver reads its href many times.
    fields = c.select(
        "page_id",
        "card_no",
        "source",
        M.strip(F.col("card.title")).alias("product_name"),
        price_text_to_double(F.col("card.price"), lenient=lenient).alias("price_gbp"),
        F.regexp_replace("card.availability", r"\s+", " ").alias("availability"),
        rating_word_to_int(F.col("card.rating")).cast("int").alias("rating_1to5"),
        F.col("card.href").alias("_href"),
    )
    resolved = with_resolved_url(fields, "source", "_href", "url")
    return resolved.select(
        "page_id", "card_no", "source", "product_name", "price_gbp", "availability", "rating_1to5", "url",
        stamp.alias("scraped_at"),
    )


def next_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, next_url): the resolved next-page link, NULL if none."""
    # The resolver reads the href many times, and filters on its result are
    # pushed through plain columns: a generated column is read from the page once.
    x = pages.select("page_id", "url", F.explode(F.array(M.read_listing("html")["next"])).alias("_href"))
    return with_resolved_url(x, "url", "_href", "next_url").drop("_href")


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, link_no, href, link): every anchor of every page that has an
    href, resolved against the page's url."""
    x = pages.select("page_id", "url", F.posexplode(M.anchors("html")).alias("link_no", "href"))
    x = x.select("page_id", "url", F.col("link_no").cast("bigint").alias("link_no"), "href")
    return with_resolved_url(x, "url", "href", "link").select("page_id", "link_no", "href", "link")


# Fixed value that must equal the reference: pages visited per category.
MAX_PAGES = 3


def reach(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(start_url, url, hop) of all urls that lead on from each start, each
    with its least number of hops.

    A round doubles the hops: urls within n hops, and those that n more hops
    lead to.  It ends with the first round that finds no new url, so a chain
    of n pages takes about log2(n) rounds and a circle of links ends too.
    """
    jump = links.select("_from", "_to").distinct().checkpoint(eager=True)
    found = starts.select("start_url", F.col("start_url").alias("url"), F.lit(0).alias("hop")).distinct()
    found, n, hops = found.checkpoint(eager=True), -1, 1
    while n != (n := found.count()):
        step = found.join(jump, found.url == jump._from).select(
            "start_url", F.col("_to").alias("url"), (F.col("hop") + F.lit(hops)).alias("hop")
        )
        found = found.unionByName(step).groupBy("start_url", "url").agg(F.min("hop").alias("hop"))
        found = found.checkpoint(eager=True)
        far = jump.select(F.col("_from").alias("_mid"), F.col("_to").alias("_far"))
        jump = jump.join(far, jump._to == far._mid).select("_from", F.col("_far").alias("_to")).distinct()
        jump, hops = jump.checkpoint(eager=True), 2 * hops
    return found


def visits(pages: DataFrame, starts: DataFrame, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """(start_url, hop, url) of the pages that a category crawl visits.

    From each ``start_url`` (column of ``starts``) the crawl follows the
    resolved next-page link until there is none or ``max_pages`` pages have
    been visited; like the reference it keeps no visited set.  Without
    ``max_pages`` it goes on until no new page is reached, and visits each
    page once.  The walk joins narrow (url -> next url) rows only; a capped one
    reads the markup of the pages that it visits.
    """
    checkpoint_dir(pages.sparkSession)

    def links_of(some: DataFrame) -> DataFrame:
        found = next_links(some).where(F.col("next_url").isNotNull())
        return found.select(F.col("url").alias("_from"), F.col("next_url").alias("_to"))

    if max_pages is None:
        # One pass over the html; the narrow link table (a row per page)
        # is kept as a reliable checkpoint so every round reads it, not the pages.
        return reach(links_of(pages).checkpoint(eager=True), starts).select("start_url", "hop", "url")
    step = starts.select("start_url", F.lit(0).alias("hop"), F.col("start_url").alias("url"))
    walked = step
    for hop in range(1, max_pages):
        # the links of the pages that this hop leaves, read once a page: other pages' markup has no part in it
        here = pages.join(step.select("url").distinct(), "url", "left_semi").select("page_id", "url", "html")
        links = links_of(here)
        step = step.join(links, step.url == links._from).select("start_url", F.lit(hop).alias("hop"), F.col("_to").alias("url"))
        step = step.checkpoint(eager=True)
        walked = walked.unionByName(step)
    return walked


def crawl(pages: DataFrame, starts: DataFrame, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """The pages a category crawl visits (``visits``), a row a visit:
    (start_url, hop, page_id, url, html).  The html is joined once."""
    walked = visits(pages, starts, max_pages)
    return walked.join(pages, "url").select("start_url", "hop", "page_id", "url", "html")


def category_cards(pages: DataFrame, starts: DataFrame, max_pages: int | None = MAX_PAGES, lenient: bool = False,
                   as_of=None) -> DataFrame:
    """Product cards of every page a category crawl visits, tagged with the
    crawl's start url and the hop at which the page was reached.  A page that
    several crawls reach is read once, and its cards belong to each visit."""
    walked = visits(pages, starts, max_pages).checkpoint(eager=True)
    reached = pages.join(walked.select("url").distinct(), "url", "left_semi").select("page_id", "url", "html")
    cards = product_cards(reached, lenient=lenient, as_of=as_of).withColumnRenamed("url", "_card")
    cards = cards.join(reached.select("page_id", F.col("url").alias("_page")), "page_id")
    out = walked.join(cards, walked.url == cards._page).drop("url", "_page", "page_id", "card_no")
    return out.withColumnRenamed("_card", "url")
