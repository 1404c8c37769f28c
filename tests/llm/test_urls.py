"""URL rules and their aliases against brute force."""

import itertools
import random
from html.parser import HTMLParser
from urllib.parse import urljoin

from icelens.llm import url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in reversed(attrs)}
        if tag == "link" and "canonical" in a.get("rel", "").lower().split() and "href" in a:
            self.found.append(a["href"].strip())
        if tag == "meta" and a.get("http-equiv", "").lower() == "refresh":
            wait, _, rest = a.get("content", "").partition(";")
            rest = rest.strip()
            if rest.lower().startswith("url"):
                rest = rest[3:].strip().removeprefix("=").strip()
            rest = rest.strip("'\"")
            if rest:
                self.found.append(rest)


def cut(url):
    """host, path and name of a URL, character by character."""
    if url is None or "://" not in url:
        return "", "", None
    scheme, _, rest = url.partition("://")
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end].translate(LOWER), rest[end:].partition("#")[0]
    path, mark, query = tail.partition("?")
    return host, path, scheme.translate(LOWER) + "://" + host + (path or "/") + mark + query


def rule_of(host, path, rules):
    fit = [(len(h) + len(p), len(h), v == "allow", h + p) for v, h, p in ((v, h.lower(), p) for v, h, p in rules) if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (best[3], "allow" if best[2] else "block") if best else (None, None)


def plain(pages, rules, redirects=()):
    edges = []
    for url, html in pages:
        if url is not None and "://" in url:
            parser = Links()
            parser.feed(html or "")
            edges += [(url, urljoin(url, link)) for link in parser.found]
    names = {}
    near = {}
    for a, b in [*edges, *redirects]:
        if a is None or b is None or "://" not in a or "://" not in b:
            continue
        for u in (a, b):
            h, p, n = cut(u)
            names[n] = rule_of(*cut(n)[:2], rules)[1]
            near.setdefault(n, set())
        near[cut(a)[2]].add(cut(b)[2])
        near[cut(b)[2]].add(cut(a)[2])
    out = []
    for url, _ in pages:
        host, path, name = cut(url)
        rule, verdict = rule_of(host, path, rules)
        if verdict is None:
            seen, todo = {name}, [name]
            while todo:
                for n in near.get(todo.pop(), ()):
                    if n not in seen:
                        seen.add(n)
                        todo.append(n)
            known = {names.get(n) for n in seen}
            verdict = "allow" if "allow" in known else "block" if "block" in known else "allow"
        out.append((url, host, path, rule, verdict))
    return sorted(out, key=repr)


def judged(spark, pages, rules, redirects=None):
    df = spark.createDataFrame([(i, u, h, "r", "x", "y") for i, (u, h) in enumerate(pages)],
                               "page_id long, url string, html string, `a.b` string, Rule string, _host string").repartition(3)
    sent = spark.createDataFrame(redirects, "from_url string, to_url string, n.o string".replace("n.o", "`n.o`")) if redirects is not None else None
    out = url_filter.judged(df, url_filter.rule_table(spark, rules), sent)
    assert out.columns == ["page_id", "url", "html", "a.b", "_host", "host", "path", "rule", "verdict"]
    return sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)


ODD = [None, "", "no scheme", "mailto:a@b", "://", "http://", "http:///x", "HTTP://Www.EXAMPLE.com/en/a?x=1#y", "http://example.com", "http://example.com?en/",
       "http://notexample.com/en/", "http://com/", "http://a.net/es", "http://a.net/es/", "http://u:p@x.net:80/fr/", "http://x.org/a b\nc", "a://b://c/d",
       "http://x.org/" + "y" * 50_000, "http://" + "a." * 3000 + "com/"]


def test_rules_alone(spark):
    pages = [(u, None) for u in ODD + ODD[:4]]
    assert judged(spark, pages, url_filter.RULES) == plain(pages, url_filter.RULES)


def test_longest_rule_and_ties(spark):
    rules = [("block", "b.c", "/xx"), ("allow", "a.b.c", "/"), ("block", "c", "/xxxxx"), ("allow", "c", "/xxxxx"), ("block", "", "/"), ("block", "C", "/y")]
    pages = [(f"http://{h}/{p}", "") for h in ("a.b.c", "b.c", "z.c", "c", "d", "xb.c") for p in ("", "x", "xx", "xxx", "xxxxxx", "y")]
    assert judged(spark, pages, rules) == plain(pages, rules)


def test_aliases_equal_brute_force(spark):
    rnd = random.Random(5)
    hosts = ["a.org", "b.org", "www.example.com", "x.example.com", "s.net", "c.io"]
    urls = [f"http://{h}/{p}/{i}" for h in hosts for p in ("en", "es", "de") for i in range(6)]
    tags = ['<link rel="canonical" href="{}">', "<LINK href='{}' rel='next CANONICAL'/>", '<meta http-equiv=refresh content="0; url={}">',
            '<meta content="3;URL=\'{}\'" http-equiv="Refresh">', '<link rel="stylesheet" href="{}">', '<!-- <link rel="canonical" href="{}"> -->',
            '<script>var x = \'<link rel="canonical" href="{}">\'</script>', '<link title="rel=canonical" rel=icon href="{}">', "<p>{}"]
    links = ["/de/1", "../en/2?q=1&amp;r=2", "//c.io/de/0", "?x", "#top", "3", "./", "..", "mailto:x@y", "HTTP://A.org/de/1#z", ""]
    pages, redirects = [], []
    for u in urls:
        html = "".join(rnd.choice(tags).format(rnd.choice(links + urls[:12])) for _ in range(rnd.choice([0, 0, 0, 1, 2])))
        pages.append((u, "<html><head>" + html + "</head>"))
    redirects = [(rnd.choice(urls), rnd.choice(urls + ["http://never.fetched.example.com/en/9"]), "x") for _ in range(12)]
    redirects += [(None, urls[0], "x"), (urls[0], None, None), (urls[1], urls[1], ""), ("junk", urls[2], "")]
    for sent in (None, redirects):
        want = plain([(u, h.replace("&amp;", "&")) for u, h in pages], url_filter.RULES, [r[:2] for r in sent or ()])
        assert judged(spark, pages, url_filter.RULES, sent) == want


def test_block_reaches_a_long_chain(spark):
    chain = [f"http://h{i}.org/" for i in range(40)] + ["http://bad.net/es/1"]
    pages = [(u, f'<link rel=canonical href="{v}">') for u, v in itertools.pairwise(chain)] + [("http://h99.org/", "")]
    got = judged(spark, pages, url_filter.RULES)
    assert [v for u, *_, v in got if u != "http://h99.org/"] == ["block"] * 40
    assert got == plain(pages, url_filter.RULES)


def test_a_hub_with_many_aliases(spark):
    pages = [(f"http://m{i}.org/", '<link rel=canonical href="http://z.net/fr/1">') for i in range(3000)]
    assert {v for *_, v in judged(spark, pages, url_filter.RULES)} == {"block"}


def test_nothing(spark):
    assert judged(spark, [], url_filter.RULES) == []
    pages = [("http://a.com/", "<link rel=canonical href=http://b.net/es/>" * 2), ("http://a.com/", None)]
    assert judged(spark, pages, [("block", "net", "/")], []) == plain(pages, [("block", "net", "/")])


def test_unclosed_markup_of_a_long_page(spark):
    pages = [("http://q.org/", "<!--" * 60_000), ("http://r.org/", "<script " * 60_000), ("http://s.org/", "<link " * 60_000 + "<meta a=b " * 10_000)]
    assert {v for *_, v in judged(spark, pages, url_filter.RULES)} == {"allow"}
