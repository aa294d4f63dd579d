import pytest

from tallyboard.llm.url_filter import Rule, judge

RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"),
         Rule("block", "org/fr/bad"), Rule("allow", "a.net/"), Rule("block", "a.net/")]
URLS = ["http://x.net/", "http://net/", "http://X.Example.NET/en/1?q#f", "https://example.net/de/", "http://example.com/de/x", "http://example.com/de",
        "http://xexample.com/de/", "ftp://example.org/fr/a", "http://example.org/fr/badly", "http://example.org/fr/ba", "http://x.net", "http://x.net?/", "", None,
        "no scheme/", "http://a.b.c.net/en/", "http:///en/", "x://http://net/", "http://h/é/?x\ny", "http://a.net/x", "http://b.a.net/", "http://x.net:80/", "http://.net/",
        "http://x.net/" + "p" * 5000]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = []
    for r in RULES:
        h = r.rule[:r.rule.index("/")]
        if host and (host == h or host.endswith("." + h)) and path.startswith(r.path):
            fits.append((len(r.rule), len(h), r.verdict == "block", r.rule, r.verdict))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("sent", [20_000, 0])
def test_rules(spark, monkeypatch, sent):
    monkeypatch.setattr("tallyboard.llm.url_filter.SENT_RULES", sent)
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)] + [(0, URLS[0], "h", "v")], "page_id long, url string, html string, verdict string")
    got = sorted(tuple(r) for r in judge(pages, RULES).collect())
    want = sorted([(i, *brute(u)) for i, u in enumerate(URLS)] + [(0, *brute(URLS[0]))], key=lambda r: (r[0], r[1]))
    assert got == want
    assert judge(pages.limit(0), RULES).count() == 0


def test_bad_rules():
    for verdict, rule in (("drop", "a/"), ("block", "a"), ("allow", "/x")):
        with pytest.raises(ValueError):
            Rule(verdict, rule)
