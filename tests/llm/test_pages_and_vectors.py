"""Main text, URL filter and Hamming search against plain versions."""

from __future__ import annotations

import html
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from shelflight.llm import hamming_search, url_filter
from shelflight.llm.main_text import Line, between, extract, main_text

# Main text

LONG = "Some sentence of the article that goes on for quite a while. " * 3


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<br><p></p>", ""), ("<script>var a = '<p>no</p>';</script>", ""),
    ("<nav><a href='/'>Home</a></nav><article><h1>T</h1><p>A&amp;b &eacute;&#233; <b>bo</b>ld<br>x\n\n y</p><p>Z.</article><footer>f</footer>", "T A&b éé bold x y Z."),
    ("<article><p>One</p><aside>no</aside><div class='share-buttons'>no</div><form><input><p>no</p></form><style>p{}</style><!-- no <p>no</p> --><p>Two</p>"
     "<section id=comments><p>no</p></section></article>", "One Two"),
    ("<article class='comment'><p>no no no no no no no</p></article><article><p>Yes</p></article>", "Yes"),
    ("<div class='header-menu'><p>x</p><article><p>Yes</p></article></div>", "Yes"),
    ("<main><p title='a > b'>Yes</p><p>2 &lt; 3</p></main>", "Yes 2 < 3"),
    ("<article><p>Open", "Open"), ("<nav>Menu<article><p>Yes</p></article>", "Yes"),
    (f"<header>Site</header><ul><li><a href=1>A</a></li><li><a href=2>B</a></li></ul><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
     "<div><a href=3>l</a></div><div><a href=4>l</a></div><div><a href=5>l</a></div>", f"{LONG.strip()} Short. {LONG.strip()}"),
    ("<p>little</p><p>text</p>", "little text"),
])
def test_main_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<html class='has-sidebar'><body class='has-sidebar search-page'><div id='page' class='no-comments'><p>Yes</p></div></body></html>", "Yes"),
    ("<body class='sidebar'><p>Yes</p></body>", "Yes"),
    ("<div id='page' class='share-layout'><p>Yes yes yes</p><div class='share-buttons'><p>no</p></div></div>", "Yes yes yes"),
    ("<article class='post no-comments'><p>Yes</p></article><div><p>more than that</p></div>", "Yes"),
    ("<article class='post tag-social'><p>Yes yes yes</p></article><article class='teaser'><p>no</p></article>", "Yes yes yes"),
    ("<article class='notice'><p>Yes</p></article><div><p>no</p></div>", "Yes"),
    ("<main><p>A</p><article class='notice'><p>Yes yes</p></article></main>", "A Yes yes"),
    ("<article><p>Yes</p><div id='comments'><article class='comment-body'><p>no no no no</p></article></div></article>", "Yes"),
    ("<div class='search-hit-1'><p>One</p></div><div class='search-hit-2'><p>Two</p></div>", "One Two"),
    ("<div class='search-hit'><p>One</p></div><div class='share-hit'><p>Two</p></div>", "One Two"),
    ("<div class='side related-posts'><p>no</p></div><div id='sidebar'><p>no no no no</p></div><p>Yes yes</p>", "Yes yes"),
    ("<div class='menu-wrap'><main class='page tag-social'><p>Yes yes</p></main></div>", "Yes yes"),
])
def test_names_that_do_not_refuse_the_text(page, want):
    assert main_text(page) == want


def test_surge_and_dive_points():
    lines = [Line("menu", 0), Line("x" * 90, 90), Line("s", 1), Line("link", 0), Line("link", 0), Line("link", 0), Line("tail", 4)]
    assert between(lines, 80) == ["x" * 90, "s"]
    assert between(lines, 1)[-1] == "tail"


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract(pages.withColumn("n_chars", F.lit("x"))).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        inside = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inside))
        assert r["text"] == " ".join(html.unescape(inside).split()) and r["n_chars"] == len(r["text"])


def test_pages_with_nulls_and_repeats(spark):
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "u", None), (2, "v", "<article>" + "<p>w</p>" * 30_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in extract(pages).collect()), key=repr)
    assert [(r[0], r[3]) for r in got] == [(1, 1), (1, 1), (2, 59_999), (None, 0)]
    assert extract(pages.where("false")).count() == 0


# URL filter

def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, rule in url_filter.RULES:
        of_host, slash, rest = rule.partition("/")
        if (host == of_host or host.endswith("." + of_host)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


ODD = [None, "", "no scheme", "http://", "://x", "http://EXAMPLE.org/es/1?a=b", "http://a.b.example.ORG/en/17#x", "http://org", "http://org?/x", "http://org/",
       "http://xorg/", "http://ÄÖ.com/de/", "https://x.com/fr/a://b", "http://example.org/es", "ftp://u@h.com:80/de/x.html", "http://x.net/" + "a/" * 3000]


def test_host_path_and_rule(spark):
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD + ODD)], "page_id long, url string, rule string")
    for r in url_filter.judge(rows).collect():
        host, path = split(r["url"])
        best = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
        assert best is None or r["verdict"] == best[1]
    assert url_filter.judge(rows.where("false")).count() == 0
    none = url_filter.judge(rows, rules=()).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_mined_rules_against_counting(spark):
    """All token sets counted one by one give the rules and verdicts of the mined ones."""
    rng = random.Random(3)
    urls = [f"http://{rng.choice(['a', 'b', 'www.c'])}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randint(1, 40)}{rng.choice(['', '.html', '/'])}" for _ in range(600)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    seen = rows.withColumn("__h", url_filter.host_and_path(F.col("url"))[0]).withColumn("__p", url_filter.host_and_path(F.col("url"))[1])
    sets = {r["page_id"]: (frozenset(r["t"]), r["__h"], r["__p"]) for r in seen.select("page_id", "__h", "__p", url_filter.tokens(F.col("__h"), F.col("__p")).alias("t")).collect()}
    labels = [(t, best[1]) for t, h, p in sets.values() if (best := plain_rule(h, p))]
    counts, said = {}, {}
    for t, verdict in labels:
        for n in range(1, len(t) + 1):
            for part in itertools.combinations(sorted(t), n):
                counts[part] = counts.get(part, 0) + 1
                said[part, verdict] = said.get((part, verdict), 0) + 1
    support, sure = 0.02, 0.9
    rules = {k: (n / counts[k[0]], n / len(labels)) for k, n in said.items() if n >= support * len(labels) and n / counts[k[0]] >= sure}
    kept = {k: v for k, v in rules.items() if not any(rules.get((tuple(x for x in k[0] if x != t), k[1]), (0,))[0] >= v[0] for t in k[0])}
    for r in url_filter.judge(rows, min_support=support, min_confidence=sure).collect():
        t, host, path = sets[r["page_id"]]
        if plain_rule(host, path):
            continue
        fitting = [(c, s, len(a), v == "block", list(a), v) for (a, v), (c, s) in kept.items() if t.issuperset(a)]
        best = max(fitting, default=None, key=lambda f: (round(f[0], 9), round(f[1], 9), *f[2:]))
        assert (r["verdict"], r["mined"]) == ((best[5], best[4]) if best else ("allow", None))


# Hamming search

def nearest(rows, k):
    known = [(i, c) for i, c in rows if i is not None and c is not None]
    out = []
    for q, code in known:
        if q % 20 == 0:
            near = sorted((((code ^ c) & (2**64 - 1)).bit_count(), i) for i, c in known if i != q)[:k]
            out += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("n, spread", [(1, 2), (7, 64), (300, 3), (300, 64)])
def test_search_against_all(spark, n, spread):
    rng = random.Random(n + spread)
    centres = [rng.getrandbits(64) - (1 << 63) for _ in range(5)]
    rows = []
    for i in range(n):
        code = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            code ^= 1 << rng.randrange(63)
        rows.append((i, code))
    rows += [(1000 + i, rows[0][1]) for i in range(n // 3)] + [(None, 5), (40_000, None)]
    df = spark.createDataFrame([(i, c, "x") for i, c in rows], "id long, code long, distance string")
    got = hamming_search.search(df, df.where("id % 20 = 0"), k=3)
    assert sorted(map(tuple, got.collect())) == nearest(rows, 3)


@pytest.mark.parametrize("codes_of_own", [1, 4, 12])
def test_search_with_repeated_ids(spark, codes_of_own):
    """Query ids on 2 and 12 rows, with one code or several, and neighbours on several rows."""
    rng = random.Random(codes_of_own)
    near = lambda flips: sum(1 << b for b in rng.sample(range(63), flips))
    rows = [(i, near(rng.randint(0, 4))) for i in range(1, 200) if i % 20]
    rows += [rows[0]] * 2 + [(7, 1), (7, 1), (7, 2)] * 4
    rows += [(20 * j, (1 << i % codes_of_own) - 1) for j, times in ((0, 2), (1, 12), (2, 1)) for i in range(times)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, code long")
    got = hamming_search.search(df, df.where("id % 20 = 0"))
    assert sorted(map(tuple, got.collect())) == nearest(rows, 10)


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], "id long, code long")
    assert hamming_search.search(df, df).count() == 0


def test_sign_code(spark):
    rows = spark.createDataFrame([([0.5, -1.0, 0.0, 2.0],), ([1.0] * 64,), ([],), (None,), ([1.0] * 65,)], "v array<float>")
    got = [r[0] for r in rows.select(hamming_search.sign_code(F.col("v"))).collect()]
    assert got == [9, -1, 0, None, None]
