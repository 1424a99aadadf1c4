"""News from landed pages, one flow per kind of site. Links keep the ticker they came from.

``pages`` is a frame of landed pages or, for many of them, ``sources.store.store_pages`` of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.operators import news
from marketspark.operators.news import StoredPages


def _listing(tickers: DataFrame, pages: DataFrame | StoredPages, template: str) -> DataFrame:
    """Each ticker with the landed page its address template points to."""
    named = news.company_urls(tickers, template, name="link")
    return news.join_articles(named.select("ticker", "link"), pages, row_key=["ticker"])


def _articles(links: DataFrame, pages: DataFrame | StoredPages, rule: news.ArticleRule) -> DataFrame:
    found = news.join_articles(links, pages, row_key=["ticker", "link_no"])
    return news.extract_articles(found, rule, keep=["url", "ticker"])


def company_news(tickers: DataFrame, companies: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """Company page, its "more" link, the stories there, the articles."""
    known = news.company_lookup(tickers, companies)
    front = _listing(known, pages, news.COMPANY_PAGE)
    more = news.more_link(front, keep=["ticker"])
    listing = news.join_articles(more, pages, row_key=["ticker"])
    links = news.extract_story_links(listing, keep=["ticker"])
    return _articles(links, pages, news.ET_ARTICLE)


def company_updates(tickers: DataFrame, companies: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """The stories of the company's update page, then the articles."""
    known = news.company_lookup(tickers, companies)
    listing = _listing(known, pages, news.COMPANY_NEWS_PAGE)
    links = news.extract_story_links(listing, keep=["ticker"])
    return _articles(links, pages, news.ET_ARTICLE)


def update_errors(tickers: DataFrame, companies: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """ticker, url, part and error of all that ``company_updates`` leaves out.

    Pages that have not landed, story containers without a link, stories without a body.
    """
    keep = ["ticker", "url"]
    known = news.company_lookup(tickers, companies)
    wanted = news.company_urls(known, news.COMPANY_NEWS_PAGE, name="link").where(F.col("link").isNotNull())
    listing = _listing(known, pages, news.COMPANY_NEWS_PAGE)
    links = news.extract_story_links(listing, keep=["ticker"])
    stories = news.join_articles(links, pages, row_key=["ticker", "link_no"])
    gone = wanted.select("ticker", "link").unionByName(links.select("ticker", "link")).withColumn("url", F.col("link"))
    return (
        news.unlanded(gone, pages, keep=keep)
        .unionByName(news.story_errors(listing, keep=keep))
        .unionByName(news.article_errors(stories, news.ET_ARTICLE, keep=keep))
    )


def headline_errors(tickers: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """ticker, url, part and error of the cards that ``headlines`` leaves out."""
    listing = _listing(tickers, pages, news.GOOGLE_QUOTE_PAGE).withColumnRenamed("url", "page")
    return news.headline_errors(listing, keep=["ticker", "page"]).withColumnRenamed("page", "url")


def anchor_news(
    tickers: DataFrame, pages: DataFrame | StoredPages, *, cls: str | None = news.ANCHOR_CLASSES[1],
    pattern: str | None = None, blocked: Sequence[str] = (),
) -> DataFrame:
    """Anchors of a class on the ticker's news page, then the articles."""
    listing = _listing(tickers, pages, news.YAHOO_NEWS_PAGE)
    links = news.extract_links(
        listing, keep=["ticker"], cls=cls, pattern=pattern, blocked=blocked
    )
    return _articles(links, pages, news.YAHOO_ARTICLE)


def pattern_news(tickers: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """As ``anchor_news``, with the link pattern and the block list."""
    return anchor_news(
        tickers, pages, pattern=news.ANCHOR_PATTERN, blocked=news.BLOCKED_LINKS
    )


def headlines(tickers: DataFrame, pages: DataFrame | StoredPages) -> DataFrame:
    """Headline cards of each ticker's quote page."""
    listing = _listing(tickers, pages, news.GOOGLE_QUOTE_PAGE)
    return news.extract_headlines(listing, keep=["ticker"]).drop("card_no")
