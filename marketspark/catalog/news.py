"""Companies, links and articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.catalog import query, table
from marketspark.functions.text import fill_template
from marketspark.operators import news, reshape
from marketspark.operators.news import ArticleRule
from marketspark.plans import news as flows
from marketspark.sources import files, store

PAGE_RULE = ArticleRule(summary=("title", None))
HREFS = r"""regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)"""
# character references of the test pages; a cut text may end in one without its semicolon
DECODED = "{}"
for _name, _text in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
    DECODED = f"regexp_replace({DECODED}, '&{_name};?', '{_text}', 'g')"


def pages(spark, folder):
    return files.read_pages(spark, f"{folder}/pages.parquet")


@query("company_lookup", """
    select s_suppkey, (s_nationkey + 3)::varchar as ticker, n_name as ticker_name, n_regionkey::varchar as cid,
           'https://economictimes.indiatimes.com/' || n_name || '/stocks/companyid-' || n_regionkey || '.cms' as url
    from supplier left join nation on s_nationkey + 3 = n_nationkey
""")
def company_lookup(spark, folder):
    tickers = table(spark, folder, "supplier").select(
        "s_suppkey", (F.col("s_nationkey") + 3).cast("string").alias("ticker")
    )
    companies = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("ordinal"), F.col("n_nationkey").cast("string").alias("ticker"),
        F.col("n_name").alias("ticker_name"), F.col("n_regionkey").cast("string").alias("cid"),
    )
    return news.company_urls(news.company_lookup(tickers, companies))


@query("company_first", """
    select c_custkey, arg_min(p_name, p_partkey) as ticker_name, arg_min(p_brand, p_partkey) as cid
    from customer left join part on c_nationkey * 3 = p_size group by 1
""")
def company_first(spark, folder):
    tickers = table(spark, folder, "customer").select("c_custkey", (F.col("c_nationkey") * 3).alias("ticker"))
    companies = table(spark, folder, "part").select(
        F.col("p_partkey").alias("ordinal"), F.col("p_size").alias("ticker"),
        F.col("p_name").alias("ticker_name"), F.col("p_brand").alias("cid"),
    )
    return news.company_lookup(tickers, companies).drop("ticker")


@query("page_title", f"""
    select page_id, {DECODED.format("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's')")} as title,
           'No date available' as date,
           {DECODED.format("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} as content
    from pages
""")
def page_title(spark, folder):
    return news.extract_articles(pages(spark, folder), PAGE_RULE, keep=["page_id"])


@query("page_links", f"""
    with l as (select page_id, unnest({HREFS}) as href from pages)
    select page_id, 'https://site.example' || href as link from l where href like '%e' and href <> '/the'
""")
def page_links(spark, folder):
    links = news.extract_links(
        pages(spark, folder), keep=["page_id"], suffix="e", blocked=["/the"], base="https://site.example"
    )
    return links.drop("link_no")


@query("page_pattern_links", f"""
    with l as (select page_id, unnest({HREFS}) as link from pages)
    select page_id, link from l where link not in ('/the', '/and')
""")
def page_pattern_links(spark, folder):
    links = news.extract_links(
        pages(spark, folder), keep=["page_id"], pattern=r'<a\s[^>]*href="([^"]*)"', suffix=None,
        blocked=["/the", "/and"],
    )
    return links.drop("link_no")


@query("page_first_link", f"select page_id, ({HREFS})[1] as link from pages where len({HREFS}) > 0")
def page_first_link(spark, folder):
    return news.more_link(pages(spark, folder), keep=["page_id"], cls=None)


@query("page_story_links", f"""
    with l as (select page_id, {HREFS} as links from pages)
    select page_id, unnest(generate_series(0, len(links) - 1))::int as link_no, unnest(links) as link from l
""")
def page_story_links(spark, folder):
    return news.extract_story_links(
        pages(spark, folder), keep=["page_id"], container=("li", None), suffix=None, base=""
    )


@query("page_headlines", f"""
    select page_id, null::varchar as date, regexp_extract(html, '<a\\s[^>]*>(.*?)</a>', 1, 's') as title,
           {DECODED.format("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's')")} as description,
           'https://www.google.com' || ({HREFS})[1] as url
    from pages where len({HREFS}) > 0
""")
def page_headlines(spark, folder):
    cards = news.extract_headlines(
        pages(spark, folder), keep=["page_id"], card=("body", None), text=("h1", None)
    )
    return cards.drop("card_no")


# A closed paragraph ends at its end tag; an open one holds all that follows it in the article.
PARAGRAPHS = """array_to_string(list_transform(range(1, len(parts) + 1), lambda i: regexp_replace(
    case when contains(parts[i], '</p>') then split_part(parts[i], '</p>', 1)
         else array_to_string(parts[i:], '') end, '<[^>]*>', '', 'g')), ' ')"""


@query("page_paragraphs", f"""
    with a as (
        select *, string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>')[2:] as parts from pages
    )
    select page_id, url, {DECODED.format("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's')")} as title,
           'No date available' as date, {DECODED.format(PARAGRAPHS)} as content from a
""")
def page_paragraphs(spark, folder):
    rule = ArticleRule(body=("article", None))
    return news.extract_articles(pages(spark, folder), rule, keep=["page_id", "url"])


FLAT_PARAGRAPHS = """array_to_string(list_transform(parts, lambda x: regexp_replace(split_part(x, '</p>', 1), '<[^>]*>', '', 'g')), ' ')"""


@query("page_paragraphs_flat", f"""
    with a as (
        select *, string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>')[2:] as parts from pages
    )
    select page_id, url, {DECODED.format(FLAT_PARAGRAPHS)} as content from a
""")
def page_paragraphs_flat(spark, folder):
    """A new paragraph ends an open one: no more text than the page has."""
    rule = ArticleRule(body=("article", None), nested_paragraphs=False)
    return news.extract_articles(pages(spark, folder), rule, keep=["page_id", "url"]).drop("title", "date")


@query("links_not_in_table", f"""
    with l as (select page_id, unnest({HREFS}) as link, unnest(generate_series(0, len({HREFS}) - 1)) as link_no from pages)
    select page_id, link_no::int as link_no, link from l
    where link not in (select ({HREFS})[1] from pages where page_id % 3 = 0 and len({HREFS}) > 0)
""")
def links_not_in_table(spark, folder):
    """Links of all pages that are no first link of every third page; the list is too long to be broadcast."""
    landed = pages(spark, folder)
    links = news.extract_links(landed, keep=["page_id"], suffix=None)
    firsts = news.more_link(landed.where("page_id % 3 = 0"), keep=["page_id"], cls=None)
    return news.exclude_links(links, firsts, row_key=["page_id", "link_no"], rows=50, small_rows=0)


LINKED_SQL = f"""
    with l as (select page_id, unnest({HREFS}) as link, unnest(generate_series(0, len({HREFS}) - 1)) as link_no from pages),
    landed as (select link, min(page_id) as target from (select ({HREFS})[1] as link, page_id from pages) group by 1)
    select l.page_id, l.link_no::int as link_no, l.link as url, t.page_id as target,
           {DECODED.format("regexp_extract(t.html, '<h1[^>]*>(.*?)</h1>', 1, 's')")} as title
    from l join landed using (link) join pages t on t.page_id = landed.target
"""


@query("link_articles", LINKED_SQL)
def link_articles(spark, folder):
    """Links of every page joined to the page known by that address: the one whose first link it is."""
    landed_pages = pages(spark, folder)
    first = news.more_link(landed_pages, keep=["page_id", "html"], cls=None)
    landed = first.groupBy(F.col("link").alias("url")).agg(
        F.min_by(F.struct(F.col("page_id").alias("target"), "html"), "page_id").alias("t")
    )
    # the target id travels in front of the markup, so that it can be shown
    marked = landed.select("url", F.concat(F.col("t.target").cast("string"), F.lit("|"), "t.html").alias("html"))
    links = news.extract_links(landed_pages, keep=["page_id"], suffix=None)
    joined = news.join_articles(links, marked, row_key=["page_id", "link_no"])
    return news.extract_articles(
        joined, PAGE_RULE, keep=["page_id", "link_no", "url", F.split("html", r"\|", 2)[0].cast("bigint").alias("target")]
    ).drop("date", "content")


def _escaped(column):
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(plain), F.lit(coded))
    return column


def _documents(spark, folder):
    """Every document as the only news of a ticker of its own, its id."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("ticker"), "lang", "source", _escaped(F.col("text")).alias("body")
    )


def _landed(docs, *pages):
    """Pages made from each document, as (address, markup) with ``{column}`` slots."""
    slots = {c: F.col(c) for c in docs.columns}
    made = [
        docs.select(fill_template(url, **slots).alias("url"), fill_template(markup, **slots).alias("html"))
        for url, markup in pages
    ]
    return reshape.union_all(*made)


def _companies(docs):
    return docs.select(
        F.col("ticker").cast("bigint").alias("ordinal"), "ticker", F.col("lang").alias("ticker_name"),
        F.col("ticker").alias("cid"),
    )


STORIES = """<div class="top eachStory"><p>{source}</p><a href="/news/{ticker}.cms">{lang}</a><a href="/x.cms">x</a></div>
<div class="eachStory"><a href="/news/{ticker}.html">other kind</a></div><a href="/out.cms">outside</a>"""
STORY_PAGE = """<h1 class="artTitle">{source} &amp; <i>{lang}</i></h1><time class="jsdtTime">Last Updated: {lang}</time>
<script>var t = '<h2 class="summary">no</h2>';</script><h2 class="summary">{body}</h2>"""
STORY_SQL = """
    select 'https://economictimes.indiatimes.com/news/' || doc_id || '.cms' as url, doc_id::varchar as ticker,
           source || ' & ' || lang as title, 'Last Updated: ' || lang as date, text as content from documents
"""


@query("company_news", STORY_SQL)
def company_news(spark, folder):
    docs = _documents(spark, folder)
    pages = _landed(
        docs,
        (news.ET_BASE + "/{lang}/stocks/companyid-{ticker}.cms", '<a class="full_btn" href="/all/{ticker}?a=1&amp;b">all</a>'),
        ("/all/{ticker}?a=1&b", STORIES),
        (news.ET_BASE + "/news/{ticker}.cms", STORY_PAGE),
    )
    return flows.company_news(docs.select("ticker"), _companies(docs), pages)


@query("company_updates", STORY_SQL)
def company_updates(spark, folder):
    docs = _documents(spark, folder)
    pages = _landed(
        docs,
        (news.ET_BASE + "/{lang}/stocksupdate/companyid-{ticker}.cms", STORIES),
        (news.ET_BASE + "/news/{ticker}.cms", STORY_PAGE),
    )
    return flows.company_updates(docs.select("ticker"), _companies(docs), pages)


SHARED_STORIES = STORIES + """<div class="eachStory"><a href="/news/of-{lang}.cms">{lang}</a></div>
<div class="eachStory"><p>no link</p></div><div class="eachStory"><a href="/news/all.cms">all</a></div>
<div class="eachStory"><a href="/news/gone-{lang}.cms">not landed</a></div>"""
EMPTY_PAGE = """<h1 class="artTitle">{source}</h1><![no body here"""
UPDATES = news.ET_BASE + "/{lang}/stocksupdate/companyid-{ticker}.cms"


def _shared_pages(docs):
    """A ticker a document, with a story of its own (without a body if it is French), one that all of its
    language have, and one that everybody has."""
    languages = docs.select("lang", "lang", F.lit("lang").alias("source"), F.lit("").alias("ticker")).distinct()
    languages = languages.toDF("lang", "body", "source", "ticker")
    everybody = docs.select(F.lit("all").alias("lang"), F.lit("all").alias("body"), F.lit("all").alias("source"), F.lit("").alias("ticker")).distinct()
    return reshape.union_all(
        _landed(docs, (UPDATES, SHARED_STORIES)),
        _landed(docs.where("lang <> 'fr'"), (news.ET_BASE + "/news/{ticker}.cms", STORY_PAGE)),
        _landed(docs.where("lang = 'fr'"), (news.ET_BASE + "/news/{ticker}.cms", EMPTY_PAGE)),
        _landed(languages, (news.ET_BASE + "/news/of-{lang}.cms", STORY_PAGE)),
        _landed(everybody, (news.ET_BASE + "/news/all.cms", STORY_PAGE)),
    )


@query("company_updates_shared", f"""
    select * from ({STORY_SQL}) where ticker not in (select doc_id::varchar from documents where lang = 'fr')
    union all
    select 'https://economictimes.indiatimes.com/news/of-' || lang || '.cms', doc_id::varchar, 'lang & ' || lang, 'Last Updated: ' || lang, lang from documents
    union all
    select 'https://economictimes.indiatimes.com/news/all.cms', doc_id::varchar, 'all & all', 'Last Updated: all', 'all' from documents
""")
def company_updates_shared(spark, folder):
    """Several stories a ticker, stories that many tickers share, and an address that all have."""
    docs = _documents(spark, folder)
    return flows.company_updates(docs.select("ticker"), _companies(docs), _shared_pages(docs))


@query("stored_updates_shared", f"""
    select ticker, url, title, content from ({STORY_SQL}) where ticker not in (select doc_id::varchar from documents where lang = 'fr')
    union all
    select doc_id::varchar, 'https://economictimes.indiatimes.com/news/of-' || lang || '.cms', 'lang & ' || lang, lang from documents
    union all
    select doc_id::varchar, 'https://economictimes.indiatimes.com/news/all.cms', 'all & all', 'all' from documents
""")
def stored_updates_shared(spark, folder):
    """The same over pages in buckets, with links too many to be broadcast and addresses too hot for a bucket."""
    docs = _documents(spark, folder)
    landed = store.store_pages(_shared_pages(docs), buckets=16)
    listing = news.join_articles(
        news.company_urls(_companies(docs), news.COMPANY_NEWS_PAGE, name="link").select("ticker", "link"), landed, row_key=["ticker"], small_rows=0
    )
    links = news.extract_story_links(listing, keep=["ticker"])
    stories = news.join_articles(links, landed, row_key=["ticker", "link_no"], rows=100, small_rows=0)
    return news.extract_articles(stories, news.ET_ARTICLE, keep=["ticker", "url"]).drop("date")


@query("page_errors", """
    with d as (select doc_id, doc_id::varchar as ticker, lang, 'https://economictimes.indiatimes.com' as base from documents),
    l as (select *, base || '/' || lang || '/stocksupdate/companyid-' || ticker || '.cms' as listing,
                 'https://www.google.com/finance/quote/' || ticker || ':NSE?sa=X&ved=2ahUKEwiDhJPLw5LzAhUhyzgGHYzqBDQQ3ecFegQINBAH' as quote from d)
    select ticker, base || '/news/gone-' || lang || '.cms' as url, null::int as part, 'page not landed' as error from l
    union all select ticker, listing, 3, 'no link' from l
    union all select ticker, base || '/news/' || ticker || '.cms', null, 'no body' from l where lang = 'fr'
    union all select ticker, quote, 2, 'no description' from l
    union all select ticker, quote, 3, 'no link' from l
""")
def page_errors(spark, folder):
    """What two flows leave out, by page and card, beside the pages and cards that are good."""
    docs = _documents(spark, folder)
    tickers = docs.select("ticker")
    cards = _landed(docs, (news.GOOGLE_QUOTE_PAGE, CARDS + '<div class="yY3Lee"><div class="Adak">no link</div></div>'))
    return flows.update_errors(tickers, _companies(docs), _shared_pages(docs)).unionByName(flows.headline_errors(tickers, cards))


ANCHORS = """<a class="subtle-link big" href="https://site.example/{ticker}.html">{lang}</a>
<a class="subtle-link" href="https://policies.oath.com/us/en/oath/privacy/adinfo/index.html">ad</a>
<a class="subtle-link" href="https://site.example/{ticker}.htm">other kind</a><a class="subtle-link">none</a>"""
ANCHOR_PAGE = """<h1>other</h1><h1 data-test-locator="headline">{source}</h1><time datetime="2024-08-05T10:11:12.000Z">x</time>
<div class="caas-body x"><p>{lang}</p><div><p>{body}</p></div></div><p>outside</p>"""
ANCHOR_SQL = """
    select 'https://site.example/' || doc_id || '.html' as url, doc_id::varchar as ticker, source as title,
           '2024-08-05T10:11:12.000Z' as date, lang || ' ' || text as content from documents
"""


def _anchor_pages(docs):
    return _landed(
        docs, (news.YAHOO_NEWS_PAGE, ANCHORS), ("https://site.example/{ticker}.html", ANCHOR_PAGE)
    )


@query("anchor_news", ANCHOR_SQL)
def anchor_news(spark, folder):
    docs = _documents(spark, folder)
    return flows.anchor_news(docs.select("ticker"), _anchor_pages(docs))


@query("pattern_news", ANCHOR_SQL)
def pattern_news(spark, folder):
    docs = _documents(spark, folder)
    return flows.pattern_news(docs.select("ticker"), _anchor_pages(docs))


CARDS = """<div class="yY3Lee"><a href="/n/{ticker}">{source}</a><div class="Adak">{body}</div><time datetime="2024-08-05T1">x</time></div>
<div class="a yY3Lee"><a href="/m/{ticker}">{lang}</a><div><div class="Adak">{lang}</div></div></div>
<div class="yY3Lee"><a href="/bad/{ticker}">no text</a></div>"""


@query("headlines", """
    select doc_id::varchar as ticker, '2024-08-05' as date, source as title, text as description,
           'https://www.google.com/n/' || doc_id as url from documents
    union all
    select doc_id::varchar, null, lang, lang, 'https://www.google.com/m/' || doc_id from documents
""")
def headlines(spark, folder):
    docs = _documents(spark, folder)
    return flows.headlines(docs.select("ticker"), _landed(docs, (news.GOOGLE_QUOTE_PAGE, CARDS)))
