import math
import re

from shelfline.llm import queries, url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    fits = [(len(h + p), v, h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def check(rows, urls):
    for r in rows:
        host, path = parts(urls[r.page_id])
        verdict, name = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_query_on_pages(spark):
    root = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{root}/pages.parquet").collect()}
    rows = queries.op6_url_filter(spark, root).collect()
    assert len(rows) == len(urls)
    check(rows, urls)
    judged = [r for r in rows if r.rule is None]
    spam = re.compile("casino|pills|bets|adult|spam|ads-")
    right = sum((r.verdict == "block") == bool(spam.search(r.host)) for r in judged)
    assert right >= 0.95 * len(judged)


def test_model_is_a_logistic_regression_on_the_grams(spark):
    """Scores follow from the learned weights and the n-grams alone."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    learner = model.stages[-1]
    weights, bias = learner.coefficients.toArray(), learner.intercept
    urls = [(1, "http://a.example.com/x"), (2, "https://casino-win.example.com/")]
    frame = spark.createDataFrame(urls, "page_id long, url string")
    scores = {r.page_id: r.score for r in url_filter.judge(frame, model).collect()}
    for i, url in urls:
        host, path = parts(url)
        used = set()
        for stage, offset, text in ((model.stages[0], 0, host),
                                    (model.stages[1], url_filter.FEATURES, path)):
            marked = f"^{text}$"
            for n in url_filter.GRAMS:
                for at in range(max(1, len(marked) - n + 1)):
                    used.add(offset + stage.indexOf(marked[at:at + n]))
        want = 1 / (1 + math.exp(-bias - sum(weights[k] for k in used)))
        assert abs(scores[i] - want) < 1e-9


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.NET", "x://É.Net/En/?a#b",
            "http://net/", "http://notnet/", "http://a.org/fr/x", "http://a://b/c",
            "http://example.com/de/" + "x" * 50_000, "http://a.com?b/c#d", "http://a.com#d?e/",
            "http://a.\nb.com/de\n/x"]
    rows = [(i, u, "h", "p", 1) for i, u in enumerate(urls)] + [(5, urls[5], "h", "p", 1)]
    kind = "page_id long, url string, host string, path string, score int"
    frame = spark.createDataFrame(rows, kind)
    model = url_filter.train(url_filter.labelled_urls(spark))
    found = url_filter.judge(frame, model).collect()
    assert len(found) == len(rows)
    check(found, dict(enumerate(urls)))
    assert url_filter.judge(frame.limit(0), model).count() == 0
