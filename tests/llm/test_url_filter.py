import random
import re

from hourwise.llm import url_filter as u


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def brute(url):
    host, path = parts(url)
    fits = [(-len(h + p), a != "block", h + p, a) for a, h, p in u.LIST_RULES
            if url and "://" in url and path.startswith(p) and (host == h or host.endswith("." + h))]
    if fits:
        return host, path, min(fits)[2], min(fits)[3]
    return host, path, None, "block" if any(re.search(r, url or "", re.ASCII) for _, r in u.PATTERN_RULES) else "allow"


def urls():
    rng = random.Random(1)
    hosts = ["example.org", "a.example.org", "EXAMPLE.org", "notexample.org", "x.com", "com", "casino.net", "a.xxx", "ad.doubleclick.net", "é.org", ""]
    paths = ["/", "/es/x", "/es", "/en/1", "/en/15", "/fr/a", "/de/b", "/ads/1", "/ad/1", "/cgi-bin/q", "", "//fr/"]
    tails = ["", "?page=2&ref=x", "#top", "?utm_source=a", "?PHPSESSID=1", "?a=://org/es/", "#/fr/"]
    made = [f"{s}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for s in ("http", "https", "") for _ in range(120)]
    return [*made, None, "", "no scheme casino", "://", "http://org/", "http://org", made[0]]


def check(spark, **kw):
    rows = [(i if i % 9 else None, x, "x") for i, x in enumerate(urls())]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = u.judge_urls(df, u.rule_table(spark), **kw).collect()
    assert sorted((r._row.url or "", *tuple(r)[1:]) for r in got if r.rule is None) == sorted((x or "", *brute(x)) for _, x, _ in rows if brute(x)[2] is None)
    assert {(r._row.url, *tuple(r)[1:]) for r in got} == {(x, *brute(x)) for _, x, _ in rows} and len(got) == len(rows)


def test_equals_brute_force(spark):
    check(spark)


def test_rules_in_many_blocks_give_the_same(spark):
    check(spark, block_rules=4)


def test_rarest_token_is_the_index(spark):
    pages = spark.createDataFrame([(1, "http://a.example.org/es/"), (2, "http://b.org/x")], "page_id long, url string")
    by = {r["name"]: r.token for r in u.indexed(u.rule_table(spark), pages, "url").collect()}
    assert by["example.org/es/"] in ("es", "example") and by["org/"] == "org"


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://example.org/es/")], "page_id long, url string")
    rules = u.rule_table(spark)
    assert u.judge_urls(pages, rules.limit(0)).first().verdict == "allow"
    assert u.judge_urls(pages.limit(0), rules).count() == 0


def test_literals_are_read_off_the_expression():
    assert u.literals_of(r"/cgi-bin/") == [("bin", True), ("cgi", True)]
    assert u.literals_of(r"(?i)\bCasino\b") == [("casino", False)]
    assert u.literals_of(r"/ads?(?:erver)?s?/") == [("ad", False)]
    assert u.literals_of(r"x(ab)+c/(?:d|e)/f{2}\.g?é-h-") == [("c", False), ("f", False), ("h", True), ("xab", False)]
    assert u.literals_of(r"(?:a|b)|c") == [] and u.literals_of(r"[^/]*") == []
    assert u.literals_of(r"-(?=zz)a-(?!q)(?>bc)-") == [("a", True), ("bc", True)]


def test_fifty_thousand_rules(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 6))) for _ in range(4000)]
    lists = {(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((f"{rng.choice(words)}.{rng.choice(['org', 'com'])}", f"/{rng.choice(words)[:rng.randint(0, 5)]}")
                                                                         for _ in range(25_000))}
    shapes = (r"/{}-{}/", r"(?i)\b{}{}\b", r"[?&]{}=[0-9]+&{}", r"{}(?:x|y)?/{}")
    patterns = [(f"p{i}", rng.choice(shapes).format(rng.choice(words), rng.choice(words))) for i in range(25_000)]
    found = [(f"http://a.{h}{p}z/", None) for _, h, p in rng.sample(list(lists.values()), 20)]
    urls = [x for x, _ in found] + ["http://q.net/" + re.sub(r"\(\?i\)|\\b|\(\?:x\|y\)\?", "", r).replace("[?&]", "?").replace("[0-9]+", "7") for _, r in rng.sample(patterns, 20)]
    urls += [f"http://{rng.choice(words)}.com/{rng.choice(words)}/{rng.choice(words)}" for _ in range(40)]
    rules = u.rule_table(spark, list(lists.values()), patterns)
    compiled = [re.compile(r, re.ASCII) for _, r in patterns]
    expect = {}
    for x in urls:
        host, path = parts(x)
        fits = [(-len(h + p), a != "block", h + p, a) for a, h, p in lists.values() if path.startswith(p) and (host == h or host.endswith("." + h))]
        expect[x] = (min(fits)[2], min(fits)[3]) if fits else (None, "block" if any(r.search(x) for r in compiled) else "allow")
    assert len(set(expect.values())) > 10 and sum(rule is None and v == "block" for rule, v in expect.values()) >= 20
    got = u.judge_urls(spark.createDataFrame([(x,) for x in urls], "url string"), rules, block_rules=30_000).collect()
    assert {r._row.url: (r.rule, r.verdict) for r in got} == expect
    at = u.Index([r.asDict() for r in u.indexed(rules, spark.createDataFrame([(x,) for x in urls], "url string"), "url").collect()])
    assert not at.always and max(len(at.candidates(x)) for x in urls) < 500
