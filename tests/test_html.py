"""The tag reader against ``html.parser`` on random tag soup, and pages made to break a reader."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from marketspark.functions import html as H
from marketspark.operators import news

PIECES = [
    "<a", "<b", "<P", "</a>", "</b>", "</ b >", "</b x>", "<a ", "<b ", ' href="', " href='", " href=", ' HREF = "u v"', ' class="k l"', " class=k", " class = 'K'",
    "=", '"', "'", " ", ">", "/>", "/", "x", "t u", "<!--", "-->", "-- >", "--", "<!x>", "<!", "<?y", "<script>", "<script", "</script>", "<style a=b>", "</style >",
    "\n", "<", "<>", "</>", "==", "<a href=p class=k>one</a>", "<b class='k'>two</b>", "<b>", "</p>", "<bb>", "<a/>", "<script/>", "é", "日",
]


class Events(HTMLParser):
    """Starts, ends and texts outside scripts and styles, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append(("start", tag, dict(attrs)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.seen.append(("end", tag, None))

    def handle_data(self, data):
        if not self.cdata_elem:
            self.seen.append(("text", data, None))


def events(page):
    parser = Events()
    parser.feed(page)
    parser.close()
    return parser.seen


def text_of(seen, tag, fits):
    for i, (kind, name, attrs) in enumerate(seen):
        if kind == "start" and name == tag and fits(attrs):
            out = ""
            for kind, name, _ in seen[i + 1:]:
                if kind == "end" and name == tag:
                    break
                out += name if kind == "text" else ""
            return out
    return None


def expected(page):
    seen = events(page)
    starts = [(name, attrs) for kind, name, attrs in seen if kind == "start"]
    classed = [attrs for name, attrs in starts if name == "a" and "k" in (attrs.get("class") or "").split()]
    return (
        "".join(name for kind, name, _ in seen if kind == "text"),
        [attrs["href"] for name, attrs in starts if name == "a" and attrs.get("href") is not None],
        [attrs["href"] for attrs in classed if attrs.get("href") is not None],
        text_of(seen, "b", lambda attrs: True),
        text_of(seen, "b", lambda attrs: "k" in (attrs.get("class") or "").split()),
        text_of(seen, "a", lambda attrs: attrs.get("href") == "p"),
        next((attrs.get("class") for name, attrs in starts if name == "p"), None),
    )


def found(df):
    page = F.col("_t")
    return df.withColumn("_t", H.tokens(F.col("html"))).select(
        "html", F.array_join("_t", "").alias("whole"),
        F.array_join(F.filter(page, H.is_text), ""), H.anchors(page), H.anchors(page, "k"), H.first_text(page, "b"), H.first_text(page, "b", "k"),
        H.first_text(page, "a", None, ("href", "p")), H.attribute(H.first_tag(page, "p"), "class"),
    )


def test_random_tag_soup_reads_as_the_standard_parser_does(spark):
    rng = random.Random(11)
    pages = sorted({"".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(6000)})
    pages += ["".join(rng.choice(PIECES) for _ in range(400)) for _ in range(100)]
    df = spark.createDataFrame([(p,) for p in pages], "html string").repartition(8)
    rows = found(df).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row["whole"] == row["html"]
        assert tuple(row[2:]) == expected(row["html"]), row["html"]


HARD = {
    "forgotten quote": '<a href="x>t</a>' + '<b c="d">e</b>' * 2000,
    "a million quotes": "<a href=" + '"' * 1_000_001 + ">t</a><b>e</b>",
    "odd quotes": "<b c='>" + "<a href=\"x'>" * 100_001,
    "many attributes": "<a " + 'k="v" ' * 100_000 + 'href="p">t</a>',
    "many bare attributes": "<a " + "k=v m " * 100_000 + "href=p>t</a>",
    "open comments": "<b>t</b>" + "<!-- x " * 100_000,
    "open comments with ends of tags": "<b>t</b>" + "<!-- x > " * 100_000,
    "open tags": "<b>t</b>" + "<a x " * 100_000,
    "open scripts": "<b>t</b>" + "<script>" * 100_000,
    "ends": "</b>" * 200_000,
    "signs": "<" * 500_000 + ">" * 500_000,
    "one long text": "x" * 3_000_000,
}


@pytest.mark.parametrize("name", sorted(HARD))
def test_hard_pages_neither_fail_nor_stall(spark, name):
    page = HARD[name]
    start = time.perf_counter()
    row = found(spark.createDataFrame([(page,), ("<b>good</b>",)], "html string")).where(F.length("html") > 20).first()
    assert row["whole"] == page
    assert time.perf_counter() - start < 30
    if name == "forgotten quote":
        assert row[3] == ['x>t</a><b c=']
    if name.startswith("many"):
        assert row[3] == ["p"] and row[7] == "t"


def test_links_and_articles_of_hard_pages(spark):
    pages = spark.createDataFrame([(k, p) for k, p in HARD.items()], "k string, html string")
    links = {r["k"]: r["link"] for r in news.more_link(pages, keep=["k"], cls=None).collect()}
    assert links["many attributes"] == links["many bare attributes"] == "p"
    assert news.extract_links(pages, keep=["k"], suffix=None).count() >= 3
    stray = "<h1 class=artTitle title=\"x>t</h1>" + '<i class="d">e</i>' * 3000 + "<h2 class='summary'>s</h2>"
    article = news.extract_articles(spark.createDataFrame([(stray,)], "html string"), news.ET_ARTICLE, keep=[]).collect()
    assert [r["content"] for r in article] == ["s"]


def test_no_page_and_an_empty_one(spark):
    rows = found(spark.createDataFrame([(None,), ("",)], "html string")).collect()
    assert sorted((r["html"] is None, r[3], r[5]) for r in rows if r["html"] is not None) == [(False, [], None)]


class Inside(HTMLParser):
    """Elements inside containers with a stack of open tags, as ``read_elements`` should find them."""

    def __init__(self, tag, cls, wanted, nested):
        super().__init__(convert_charrefs=True)
        self.rule = (tag, cls, wanted, nested)
        self.stack, self.found, self.containers, self.hidden = [], [], 0, 0

    def handle_starttag(self, name, attrs, closed=False):
        tag, cls, wanted, nested = self.rule
        attrs = dict(attrs)
        classes = attrs.get("class") or ""
        if not nested and name in wanted:
            inner = max((i for i, (_, c, _) in enumerate(self.stack) if c is not None), default=-1)
            if any(n == name for n, _, _ in self.stack[inner + 1:]):
                self.close_to(name)
        records = []
        if name in wanted:
            records = [{"container": c, "tag": name, "href": attrs.get("href"), "text": ""} for _, c, _ in self.stack if c is not None]
            self.found += records
        container = None
        if name == tag and (cls is None or cls in classes.split()):
            container, self.containers = self.containers, self.containers + 1
        if not closed and name not in H.VOID and name not in H.RAW:
            self.stack.append((name, container, records))
            self.hidden += name == "template"

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs, closed=True)

    def close_to(self, name):
        while True:
            last, _, _ = self.stack.pop()
            self.hidden -= last == "template"
            if last == name:
                return

    def handle_endtag(self, name):
        if any(n == name for n, _, _ in self.stack):
            self.close_to(name)

    def handle_data(self, data):
        if not self.hidden and not self.cdata_elem:
            for _, _, records in self.stack:
                for record in records:
                    record["text"] += data

    def rows(self, page):
        self.feed(page)
        self.close()
        filled = {r["container"] for r in self.found}
        empty = [{"container": c, "tag": None, "href": None, "text": None} for c in range(self.containers) if c not in filled]
        return [(r["container"], r["tag"], r["href"], r["text"] if r["tag"] == "a" else None)
                for r in sorted(self.found + empty, key=lambda r: r["container"])]


@pytest.mark.parametrize("nested", [True, False])
@pytest.mark.parametrize("cls", [None, "k"])
def test_random_tag_soup_has_the_elements_of_a_stack_of_tags(spark, nested, cls):
    rng = random.Random(12)
    more = ["<div>", "<div class='k'>", "</div>", "<a href=1>", "<a>", "<p>", "<br>", "<template>", "</template>", "text ", "<a href='2'/>"]
    pages = sorted({"".join(rng.choice(PIECES + more * 3) for _ in range(rng.randrange(1, 25))) for _ in range(2500)})
    read = H.read_elements(F.col("html"), "div", cls, ("a", "p"), ("a",), nested=nested)
    rows = spark.createDataFrame([(p,) for p in pages], "html string").repartition(8).select("html", read.alias("r")).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row["r"]["error"] is None
        found = [(e["container"], e["tag"], e["href"], e["text"]) for e in row["r"]["found"]]
        assert found == Inside("div", cls, ("a", "p"), nested).rows(row["html"]), row["html"]


def test_open_paragraphs_are_linear_by_the_second_rule_and_bounded_by_the_first(spark):
    page = "<article>" + "".join(f"<p>paragraph {i} with some text" for i in range(20_000)) + "</article>"
    pages = spark.createDataFrame([(1, page), (2, "<article><p>a<p>b</article>"), (3, "<div>none</div>"), (4, None)], "id int, html string")
    flat = news.ArticleRule(body=("article", None), nested_paragraphs=False)
    found = {r["id"]: r["content"] for r in news.extract_articles(pages, flat, keep=["id"]).collect()}
    assert found == {1: " ".join(f"paragraph {i} with some text" for i in range(20_000)), 2: "a b"}
    nested = news.ArticleRule(body=("article", None))
    assert {r["id"]: r["content"] for r in news.extract_articles(pages, nested, keep=["id"]).collect()} == {2: "ab b"}
    errors = {r["id"]: r["error"] for r in news.article_errors(pages, nested, keep=["id"]).collect()}
    assert errors.keys() == {1, 3, 4} and "signs of text" in errors[1] and errors[3] == "no body" and errors[4] == "no page"


def test_deep_and_unmatched_tags_are_read_in_one_pass(spark):
    hard = {
        "deep": "<div class='k'>" + "<i>" * 100_000 + "<a href=x>t</a>" + "</i>" * 100_000,
        "ends that open nothing": "<div class='k'>" + "<i>" * 50_000 + "</b>" * 50_000 + "<a href=x>t</a>",
        "forgotten quote": "<div class='k'><a href=\"x>t</a>" + '<b c="d">e</b>' * 20_000,
        "section": "<div class='k'><![if x]><![what<a href=x>t</a>",
    }
    df = spark.createDataFrame(list(hard.items()), "k string, html string")
    start = time.perf_counter()
    links = {r["k"]: r["link"] for r in news.extract_story_links(df, keep=["k"], container=("div", "k"), suffix=None, base="").collect()}
    assert time.perf_counter() - start < 60
    assert links["deep"] == links["ends that open nothing"] == "x" and links["forgotten quote"] == "x>t</a><b c="


def test_pages_go_to_python_a_few_at_a_time(spark):
    pages = spark.createDataFrame([("<div><p>a &amp; b</p></div>",), (None,)], "html string")
    found = pages.select(
        H.unescape(F.col("html")).alias("text"),
        H.read_elements(F.col("html"), "div", None, ("p",), text=("p",)).alias("read"),
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" in plan
    rows = found.collect()
    assert [r.text for r in rows] == ["<div><p>a & b</p></div>", None]
    assert rows[0].read.found[0].text == "a & b" and rows[1].read.found is None and rows[1].read.error is None
