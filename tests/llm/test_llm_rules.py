"""URL filter and quality rules against plain Python."""

import math
import re
from collections import Counter

import pytest
from llm_cases import documents, edge_rows, prose

from marketspark.llm import quality, urls
from pyspark.sql import functions as F

URLS = [
    "https://a.example.org/es/1", "https://example.org/es/", "http://EXAMPLE.ORG/en/1?x=/fr/", "https://example.org/en/2", "https://myexample.org/es/1",
    "https://x.com/fr/1", "https://x.com/de/1", "https://x.com/en/1", "https://x.com", "https://org/", "https://org", "org/x", None, "", "://", "a://b://c/d",
    "https://y.net/a/b/c.html?q=1&r=2#z", "https://x.com/FR/1", "https://x.com/de", "https://u@x.org:80/q", "https://x.org?/y", "http://x.com\n/fr/1", "https://É.com/fr/é",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_rules_against_plain_python(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], None)]
    df = pages(spark, rows).withColumns({c: F.lit("clash") for c in ("host", "path", "matched", "features", "label", "prediction")})
    found = urls.filter_urls(df).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, rule, verdict = brute(URLS[r["page_id"] or 0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def plain_features(url):
    host, path, _, _ = brute(url)
    url = url or ""
    query = re.search(r"\?([^#]*)", url)
    query = query[1] if query else ""

    def entropy(text):
        return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) if text else 0.0

    def among(text, signs):
        return float(sum(c in signs for c in text))

    digits = "0123456789"
    return {
        "length": float(len(url)), "host_length": float(len(host)), "path_length": float(len(path)), "depth": among(path, "/"), "labels": among(host, "."),
        "digit_share": among(url, digits) / max(1, len(url)), "host_digits": among(host, digits), "path_digits": among(path, digits), "dashes": among(url, "-"),
        "underscores": among(url, "_"), "escapes": among(url, "%"), "parameters": among(query, "="), "separators": among(query, "&;"),
        "entropy": entropy(url), "path_entropy": entropy(path), "longest_part": float(max(map(len, path.split("/")))),
        "dotted_end": float(bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path))), "secure": float(url.startswith("https")),
    }


def test_features_against_plain_python(spark):
    given = [*URLS, "https://a-b_c.net/x%20y/1.tar.gz?a=1;b=2&c==#?d=3", "https://x/" + "ab1" * 700, "ftp://日本.jp/é/ü"]
    df = spark.createDataFrame([(u,) for u in given], "url string")
    made = urls.features(F.col("url"), urls.host(F.col("url")), urls.path(F.col("url")))
    assert len(made) == 18
    for row in df.select("url", *[c.alias(k) for k, c in made.items()]).collect():
        for name, value in plain_features(row["url"]).items():
            assert row[name] == pytest.approx(value, abs=1e-9), (row["url"], name)


def test_trees_learn_from_labelled_urls(spark):
    rows = [(i, f"https://site{i % 50}.net/{'spam' if i % 3 == 0 else 'news'}-{i}{'?a=1&b=2&c=' + str(i) if i % 3 == 0 else ''}", None) for i in range(600)]
    labelled = pages(spark, rows[:400]).select("url", F.when(F.col("page_id") % 3 == 0, "block").otherwise("allow").alias("verdict"))
    found = urls.filter_urls(pages(spark, rows[400:]), labelled=labelled).collect()
    right = sum((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in found)
    assert right >= 0.98 * len(found)
    again = urls.filter_urls(pages(spark, rows[400:]).repartition(5), labelled=labelled).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_without_labels_and_without_pages(spark):
    found = urls.filter_urls(pages(spark, [(1, "https://y.net/", None)])).collect()
    assert [tuple(r) for r in found] == [(1, "y.net", "/", None, "allow")]
    only = urls.filter_urls(pages(spark, [(1, "https://y.net/", None), (2, "https://x.com/de/1", None)])).collect()
    assert {r["page_id"]: r["verdict"] for r in only} == {1: "block", 2: "block"}
    assert urls.filter_urls(pages(spark, [])).count() == 0


def test_native(spark):
    plan = urls.filter_urls(pages(spark, [(i, u, None) for i, u in enumerate(URLS)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(inside)


def repeating():
    parts = [prose(700 + i, 9) for i in range(5)]
    return [(4000 + i, " ".join([parts[i % 5], prose(800 + i, 6), parts[i % 5], parts[(i + 1) % 5], parts[i % 5]] * (1 + i % 3)), "en", "a", 1) for i in range(15)]


def test_statistics_against_plain_python(spark):
    rows = edge_rows() + repeating() + [(1, "a " * 400, "en", "a", 1), (2, "😀 # é\n\n x\r\n😀 # é", None, None, None), (3, "a b c d", "en", "a", 1), (4, "a b c d e", "en", "a", 1)]
    found = quality.statistics(documents(spark, rows, extra=True)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    assert sorted(repr((r["doc_id"], *[r[n] for n in names])) for r in found) == sorted(repr((r[0], *counts(r[1]))) for r in rows)


@pytest.mark.parametrize("n,k,risk", [(1, 0, 0.1), (50, 3, 0.1), (5000, 20, 0.0025), (300, 299, 0.5), (400, 0, 0.01)])
def test_binomial_tail_against_summing(spark, n, k, risk):
    row = spark.createDataFrame([(n, k)], "n bigint, k bigint").select(quality.binomial_tail(F.col("n"), F.col("k"), risk)).first()
    assert row[0] == pytest.approx(sum(math.comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1)), rel=1e-9)


def labelled(n=4000):
    """Good texts with few symbols and bad ones with many; stratum "b" has too few labels for a proof."""
    rows = []
    for i in range(n):
        words = prose(i % 40, 20 + i % 10)
        rows.append((i, words + (" | # |" * (i % 3) if i % 4 == 0 else ""), "a" if i % 50 else "b", "s", 1))
    return rows


def test_cutoffs_and_verdicts_against_plain_python(spark):
    rows = labelled() + [(90_000, None, "a", "s", 1), (90_001, "x " * 50, None, "s", 1)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(4000) if i % 5] + [(7, 0, 0), (None, 1, 0), (3, None, 0)]
    truth = {}
    for i, good, _ in labels:
        if i is not None and good is not None:
            truth[i] = min(truth.get(i, 1), good)
    risk, delta = 0.08, 0.1
    rules = quality.RULES

    def measures(c):
        return {"symbol_share": c[2] / c[1] if c[1] else 0.0, "dup_line_share": c[4] / c[3] if c[3] else 0.0,
                "repeat_share": c[5] / c[0] if c[0] else 0.0, "word_length": c[1] / c[0] if c[0] else 0.0}

    def failed(c):
        return c[0] < 10 or 100 * c[5] > 20 * c[0]

    found = {r[0]: counts(r[1]) for r in rows}
    holdout = [(r[2], measures(found[r[0]])) for r in rows if truth.get(r[0]) == 1 and not failed(found[r[0]])]
    strata = {s for s, _ in holdout}
    limits = {}
    for s in strata:
        own = [m for x, m in holdout if x == s]
        for step in range(max(map(len, rules.values()))):
            level = {rule: sorted(values, reverse=True)[min(step, len(values) - 1)] for rule, values in rules.items()}
            k, n = sum(any(m[rule] > cut for rule, cut in level.items()) for m in own), len(own)
            tail = sum(math.comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1)) if k < n * risk else 1.0
            if tail > delta / len(strata):
                break
            limits |= {(s, rule): cut for rule, cut in level.items()}
    assert any(s == "a" for s, _ in limits) and not any(s == "b" for s, _ in limits)
    df = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality.judge(documents(spark, rows, extra=True), df, risk=risk, delta=delta).collect()
    lang = {r[0]: r[2] for r in rows}
    rejected = 0
    for r in got:
        c = found[r["doc_id"]]
        above = any(m > limits.get((lang[r["doc_id"]], rule), math.inf) for rule, m in measures(c).items())
        assert r["base_failed"] == failed(c)
        assert r["kept"] == (not failed(c) and not above)
        rejected += above
    assert rejected > 100


def test_cutoffs_are_proven_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    counted = quality.statistics(docs)
    found = {r["stratum"]: r.asDict() for r in quality.cutoffs(counted, labels).collect()}
    assert "en" in found and all(set(r) == {"stratum", *quality.RULES} for r in found.values())
    good = counted.where(~quality.base_failed()).join(labels.where("quality = 1"), "doc_id")
    for stratum, limits in found.items():
        own = good.where(F.col("stratum") == stratum)
        measured = own.select(*[m.alias(n) for n, m in quality.measures().items()])
        bad = measured.where(" or ".join(f"{name} > {limits[name]}" for name in quality.RULES)).count()
        assert bad <= 0.01 * own.count()


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality.judge(documents(spark, edge_rows(), extra=True), none).collect()
    assert len(found) == len(edge_rows())
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert quality.judge(documents(spark, []), none).count() == 0
