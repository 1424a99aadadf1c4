"""Company lookup, links and articles from landed pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.functions import html as H
from marketspark.functions.text import fill_template, resolve
from marketspark.operators.ordering import BLOCK_ROWS
from marketspark.operators.skew import SMALL_ROWS, bounded, hash_bits, hot_keys, maybe_among, salted_join, small_side

#: Hashes of wanted addresses that are broadcast at most.
WANTED_HASHES = 4_000_000
#: Links whose pages one task reads: beyond that, those to one address are spread. Far fewer than of plain rows.
LINK_ROWS = 20_000

# Addresses, class names, defaults and the blocked link of the three news sites.
ET_BASE = "https://economictimes.indiatimes.com"
COMPANY_PAGE = ET_BASE + "/{ticker_name}/stocks/companyid-{cid}.cms"
COMPANY_NEWS_PAGE = ET_BASE + "/{ticker_name}/stocksupdate/companyid-{cid}.cms"
YAHOO_NEWS_PAGE = "https://finance.yahoo.com/quote/{ticker}.NS/news?p={ticker}.NS"
GOOGLE_BASE = "https://www.google.com"
GOOGLE_QUOTE_PAGE = (
    GOOGLE_BASE + "/finance/quote/{ticker}:NSE?sa=X&ved=2ahUKEwiDhJPLw5LzAhUhyzgGHYzqBDQQ3ecFegQINBAH"
)
NO_TITLE = "No title available"
NO_DATE = "No date available"
MORE_LINK_CLASS = "full_btn"
STORY_CLASS = "eachStory"
STORY_SUFFIX = ".cms"
ANCHOR_CLASSES = ("yf-13p9sh2", "subtle-link")
ANCHOR_SUFFIX = ".html"
ANCHOR_PATTERN = r'<a\s[^>]*class="[^"]*subtle-link[^"]*"[^>]*href="([^"]*\.html)"'
BLOCKED_LINKS = ("https://policies.oath.com/us/en/oath/privacy/adinfo/index.html",)
CARD_CLASS = "yY3Lee"
CARD_TEXT_CLASS = "Adak"
HEADLINE_MARK = ("data-test-locator", "headline")


@dataclass(frozen=True)
class ArticleRule:
    """Where title, date and body of an article stand on the pages of a site.

    With ``nested_paragraphs`` an unclosed paragraph of the body also has the text of those after it;
    without, a new one ends it, and the content is no longer than the page.
    """

    title_class: str | None = None
    title_where: tuple[str, str] | None = None
    date_class: str | None = None
    date_from_attribute: bool = False
    summary: tuple[str, str | None] | None = None
    body: tuple[str, str | None] | None = None
    nested_paragraphs: bool = True


ET_ARTICLE = ArticleRule(title_class="artTitle", date_class="jsdtTime", summary=("h2", "summary"))
YAHOO_ARTICLE = ArticleRule(
    title_where=HEADLINE_MARK, date_from_attribute=True, body=("div", "caas-body")
)


def first_companies(companies: DataFrame) -> DataFrame:
    """The first company of each ticker, by ``ordinal``."""
    others = F.struct("ticker_name", "cid")
    return companies.groupBy("ticker").agg(F.min_by(others, "ordinal").alias("c")).select("ticker", "c.*")


def company_lookup(
    tickers: DataFrame, companies: DataFrame, *, row_key: Sequence[str] = ("ticker",),
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Each ticker row with the name and id of its company, null when unknown.

    A company list over ``small_rows`` rows is not broadcast; hot tickers are then salted by
    ``row_key``.
    """
    firsts, small = bounded(first_companies(companies), small_rows)
    if small:
        return tickers.join(firsts, "ticker", "left")
    return salted_join(tickers, firsts, ["ticker"], "left", row_key=row_key)


def company_urls(df: DataFrame, template: str = COMPANY_PAGE, name: str = "url") -> DataFrame:
    """Page address from ``{ticker}``, ``{ticker_name}`` and ``{cid}`` slots."""
    slots = {c: F.col(c) for c in ("ticker", "ticker_name", "cid") if c in df.columns}
    return df.withColumn(name, fill_template(template, **slots))


def extract_links(
    pages: DataFrame, *, keep: Sequence[str], cls: str | None = None, pattern: str | None = None,
    suffix: str | None = ANCHOR_SUFFIX, blocked: Sequence[str] = (), base: str = "",
) -> DataFrame:
    """One row per link of a page (``link_no`` from 0): anchors of a class, or group 1 of ``pattern``.

    A pattern gives the raw text of the page, an anchor its decoded link.
    """
    if pattern:
        found = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    else:
        found = H.anchors(H.tokens(F.col("html")), cls)
    links = pages.select(*keep, F.posexplode(found).alias("link_no", "link"))
    if not pattern:
        links = links.select(*keep, "link_no", H.once(H.unescape(F.col("link"))).alias("link"))
    if suffix:
        links = links.where(F.col("link").endswith(suffix))
    if blocked:
        links = links.where(~F.col("link").isin(list(blocked)))
    return links.withColumn("link", resolve(base, F.col("link")))


def exclude_links(
    links: DataFrame, excluded: DataFrame, *, row_key: Sequence[str], rows: int = BLOCK_ROWS, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """``links`` without those whose ``link`` is among the links of the table ``excluded``.

    The table is reduced to its different links, written and counted; a small one is broadcast. To a
    large one the links are joined, hot ones salted by ``row_key``. A null link is excluded only if the
    table has a null.
    """
    listed, small = bounded(excluded.select(F.col("link").alias("_listed")).distinct(), small_rows)
    if small:
        return links.join(listed, F.col("link").eqNullSafe(F.col("_listed")), "left_anti")
    # null and text as one key that is never null, so that the salted join can be a plain one
    def key(link: str) -> Column:
        return F.when(F.col(link).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(link))).alias("_key")

    right = listed.select(key("_listed"), F.lit(True).alias("_found"))
    joined = salted_join(links.withColumn("_key", key("link")), right, ["_key"], "left", row_key=row_key, rows=rows)
    return joined.where(F.col("_found").isNull()).drop("_key", "_found")


def read_story_links(
    pages: DataFrame, *, keep: Sequence[str], container: tuple[str, str | None] = ("div", STORY_CLASS),
    suffix: str | None = STORY_SUFFIX, base: str = ET_BASE,
) -> DataFrame:
    """link_no, link and error of each story container: its first anchor, or why there is none.

    A page that cannot be read is one row with a null ``link_no``. Links without the suffix are other
    kinds of pages and left out.
    """
    rows = _elements(pages, keep, H.read_elements(F.col("html"), *container, ("a",)))
    firsts = F.filter(
        "_e", lambda e, i: (i == 0) | (F.get(F.col("_e"), i - 1)["container"] != e["container"])
    )
    rows = rows.select(*keep, "_error", F.explode_outer(firsts).alias("a"))
    rows = rows.select(
        *keep, F.col("a.container").alias("link_no"), F.col("a.href").alias("link"),
        F.coalesce("_error", F.when(F.col("a.container").isNotNull() & F.col("a.href").isNull(), "no link")).alias("error"),
    ).where(F.col("link").isNotNull() | F.col("error").isNotNull())
    if suffix:
        rows = rows.where(F.col("link").isNull() | F.col("link").endswith(suffix))
    return rows.withColumn("link", resolve(base, F.col("link")))


def _elements(pages: DataFrame, keep: Sequence[str], read: Column) -> DataFrame:
    """``_e`` and ``_error`` of each page that was read, behind an explode so that they are read once."""
    rows = pages.select(*keep, H.once(read).alias("_read"))
    return rows.select(*keep, F.col("_read.found").alias("_e"), F.col("_read.error").alias("_error"))


def _good(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNull()).drop("error")


def _bad(rows: DataFrame, keep: Sequence[str], part: str) -> DataFrame:
    return rows.where(F.col("error").isNotNull()).select(*keep, F.col(part).alias("part"), "error")


def extract_story_links(pages: DataFrame, *, keep: Sequence[str], **where) -> DataFrame:
    """The first anchor of each story container, if it has a link with the suffix."""
    return _good(read_story_links(pages, keep=keep, **where))


def story_errors(pages: DataFrame, *, keep: Sequence[str], **where) -> DataFrame:
    """part (number of the container) and error of what ``extract_story_links`` leaves out."""
    return _bad(read_story_links(pages, keep=keep, **where), keep, "link_no")


def more_link(pages: DataFrame, *, keep: Sequence[str], cls: str | None = MORE_LINK_CLASS) -> DataFrame:
    """The link of the first such anchor; pages without it are left out."""
    anchor = H.first_tag(H.tokens(F.col("html")), "a", cls)
    # exploding the one link drops the nulls without finding it a second time for a filter
    found = pages.select(*keep, H.once(H.attribute(anchor, "href")).alias("link"))
    return found.withColumn("link", H.unescape(F.col("link")))


@dataclass(frozen=True)
class StoredPages:
    """Pages landed once in a table that is bucketed and sorted by address (``sources.store.store_pages``).

    The flows take it in place of a frame of pages; every hop then reads the pages where they are.
    """

    frame: DataFrame


def join_articles(
    links: DataFrame, pages: DataFrame | StoredPages, *, row_key: Sequence[str], rows: int = LINK_ROWS,
    small_rows: int = SMALL_ROWS, wanted: int = WANTED_HASHES,
) -> DataFrame:
    """Each link with the landed page it points to; ``pages`` is unique over ``url``.

    The links are written and counted first: they are few bytes next to the pages they were found
    on. Up to ``small_rows`` they are broadcast and the pages are not shuffled at all. Beyond that
    the links go to the buckets of stored pages. Other pages are first reduced to those whose address
    has the hash of a wanted one (8 bytes each, counted before they are broadcast; more than ``wanted``
    are a filter of bounded size), so only these are shuffled. Addresses with about ``rows`` links
    or more are salted by ``row_key``. The partitions go by the number of links: pages that are much
    alike are few bytes in the shuffle, and all of them would be read by one task.
    """
    stored = isinstance(pages, StoredPages)
    known = links.where(F.col("link").isNotNull()).withColumnRenamed("link", "url")
    known, small = bounded(known, small_rows)
    targets = (pages.frame if stored else pages).select("url", "html")
    if small:
        return known.join(targets, "url")
    if stored:
        return _join_stored(known, targets, row_key, rows)
    hashes, few = bounded(known.select(F.xxhash64("url").alias("_wanted")).distinct(), wanted)
    if few:
        targets = targets.join(hashes, F.xxhash64("url") == F.col("_wanted"), "left_semi")
    else:
        targets = maybe_among(targets, ["url"], hash_bits(known.select("url").distinct(), ["url"]))
    partitions = max(int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known.count() // LINK_ROWS))
    return salted_join(known, targets, ["url"], row_key=row_key, rows=rows, partitions=partitions)


def _join_stored(links: DataFrame, pages: DataFrame, row_key: Sequence[str], rows: int) -> DataFrame:
    """Links go to the buckets; only the pages of hot addresses, one each, are taken out and repeated."""
    hot = hot_keys(links, ["url"], rows=rows)
    if hot is None:
        return links.join(pages, "url")
    # an address is hot for at least ``rows`` links, so these are few
    names = hot.select(F.col("url").alias("_hot"))
    cold = links.join(names, F.col("url") == F.col("_hot"), "left_anti").join(pages, "url")
    warm = links.join(names, F.col("url") == F.col("_hot"), "left_semi")
    hot_pages = small_side(pages.join(names, F.col("url") == F.col("_hot"), "left_semi"))
    return cold.unionByName(salted_join(warm, hot_pages, ["url"], row_key=row_key, hot=hot))


def read_articles(pages: DataFrame, rule: ArticleRule, *, keep: Sequence[str | Column]) -> DataFrame:
    """Title, date, content and error of each page; what has no body says so in ``error``."""
    rows = pages.withColumn("_tokens", H.tokens(F.col("html")))
    body = F.col("_tokens")
    if rule.summary:
        # exploding the one text keeps a filter on it from finding it a second time
        rows = rows.withColumn("_content", F.explode(F.array(H.first_text(body, *rule.summary))))
        content = H.unescape(F.col("_content"))
        error = F.when(F.col("_content").isNull(), "no body")
    else:
        read = H.read_elements(F.col("html"), *rule.body, ("p",), text=("p",), nested=rule.nested_paragraphs)
        rows = rows.withColumn("_read", F.explode(F.array(read)))
        found = F.col("_read.found")
        paragraphs = H.of_container(found, 0, "p")
        content = F.array_join(F.transform(paragraphs, lambda e: e["text"]), " ")
        error = F.coalesce(F.col("_read.error"), F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, "no body"))
    title = H.unescape(H.first_text(body, "h1", rule.title_class, rule.title_where))
    if rule.date_from_attribute:
        date = H.unescape(H.attribute(H.first_tag(body, "time", rule.date_class), "datetime"))
    else:
        date = H.unescape(H.first_text(body, "time", rule.date_class))
    return rows.select(
        *keep,
        F.coalesce(title, F.lit(NO_TITLE)).alias("title"),
        F.coalesce(date, F.lit(NO_DATE)).alias("date"),
        content.alias("content"),
        F.when(F.col("html").isNull(), "no page").otherwise(error).alias("error"),
    )


def extract_articles(pages: DataFrame, rule: ArticleRule, *, keep: Sequence[str | Column]) -> DataFrame:
    """Title, date and content of each page; a page without a body is left out first."""
    return _good(read_articles(pages, rule, keep=keep))


def article_errors(pages: DataFrame, rule: ArticleRule, *, keep: Sequence[str]) -> DataFrame:
    """part (null) and error of the pages that ``extract_articles`` leaves out."""
    rows = read_articles(pages, rule, keep=keep).withColumn("part", F.lit(None).cast("int"))
    return _bad(rows, keep, "part")


def read_headlines(
    pages: DataFrame, *, keep: Sequence[str], card: tuple[str, str | None] = ("div", CARD_CLASS),
    text: tuple[str, str | None] = ("div", CARD_TEXT_CLASS), base: str = GOOGLE_BASE,
) -> DataFrame:
    """Title, description, url, date (first ten characters) and error of each headline card.

    A card without a link or a description has an error, the others of its page do not. A page that
    cannot be read is one row with a null ``card_no``.
    """
    text_tag, text_class = text
    wanted = tuple(dict.fromkeys(("a", "time", text_tag)))
    rows = _elements(pages, keep, H.read_elements(F.col("html"), *card, wanted, text=("a", text_tag)))
    rows = rows.withColumn("_n", F.explode_outer(F.array_distinct(F.transform("_e", lambda e: e["container"]))))
    rows = rows.where(F.col("_n").isNotNull() | F.col("_error").isNotNull())

    def first(tag: str, cls: str | None = None) -> Column:
        def fits(e):
            right = (e["container"] == F.col("_n")) & (e["tag"] == tag)
            return right & F.array_contains(F.split(e["classes"], r"\s+"), cls) if cls else right

        return F.get(F.filter("_e", fits), F.lit(0))

    cards = rows.select(
        *keep, F.col("_n").alias("card_no"), "_error", first("a").alias("_a"),
        first(text_tag, text_class).alias("_t"), first("time").alias("_d"),
    )
    return cards.select(
        *keep, "card_no",
        F.substring("_d.datetime", 1, 10).alias("date"),
        F.col("_a.text").alias("title"),
        F.col("_t.text").alias("description"),
        resolve(base, F.col("_a.href")).alias("url"),
        F.coalesce("_error", F.when(F.col("_a.href").isNull(), "no link"), F.when(F.col("_t.text").isNull(), "no description")).alias("error"),
    )


def extract_headlines(pages: DataFrame, *, keep: Sequence[str], **where) -> DataFrame:
    """Title, description, url and date of each headline card.

    A card without a link or a description is dropped, the others of its page stay.
    """
    return _good(read_headlines(pages, keep=keep, **where))


def headline_errors(pages: DataFrame, *, keep: Sequence[str], **where) -> DataFrame:
    """part (number of the card) and error of what ``extract_headlines`` leaves out."""
    return _bad(read_headlines(pages, keep=keep, **where), keep, "card_no")


def unlanded(links: DataFrame, pages: DataFrame | StoredPages, *, keep: Sequence[str]) -> DataFrame:
    """part (null) and error of the links whose page has not landed.

    The different addresses are looked up, once each, so a hot one is a single row; what is left of them
    is then joined to the links again.
    """
    landed = (pages.frame if isinstance(pages, StoredPages) else pages).select(F.col("url").alias("link"))
    gone = links.select("link").where(F.col("link").isNotNull()).distinct().join(landed, "link", "left_anti")
    rows = salted_join(links.select(*keep, "link"), gone.withColumn("_gone", F.lit(True)), ["link"], row_key=[*keep, "link"])
    return rows.select(*keep, F.lit(None).cast("int").alias("part"), F.lit("page not landed").alias("error"))
