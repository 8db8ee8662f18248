from __future__ import annotations

import html
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from llm_helpers import LLM_SMALL
from pyspark.sql import functions as F

from vigilog.llm import main_text as main_text_module
from vigilog.llm import url_rules as ur
from vigilog.llm.main_text import extracted, main_text


def article(page: str) -> str:
    """What stands in the article of the test pages, by their fixed layout."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
    blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:h1|p)>", body))
    return "\n".join(x for x in blocks if x)


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{LLM_SMALL}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    for r in extracted(pages).collect():
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


def stripped(page: str) -> str:
    """The page without class, id and role, and with div for every tag that says what it holds."""
    return re.sub(r"<(/?)(article|main|nav|footer|aside|header)\b", r"<\1div", re.sub(r' (class|id|role)="[^"]*"', "", page))


def shared_words(pages: list[str]) -> tuple[float, float, int]:
    """Recall and precision by words of the articles, and how many are exact, over pages that are stripped."""
    hit = got = want = exact = 0
    for page in pages:
        theirs, ours = article(page), main_text(stripped(page))
        a, b = Counter(theirs.split()), Counter(ours.split())
        hit, got, want, exact = hit + sum((a & b).values()), got + sum(b.values()), want + sum(a.values()), exact + (theirs == ours)
    return hit / want, hit / got, exact


def test_the_ratios_find_the_article_without_any_name(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    recall, precision, exact = shared_words(pages)
    assert recall == 1 and precision > 0.99 and exact > 0.88 * len(pages)
    monkeypatch.setattr(main_text_module, "fused_ratios", lambda blocks: defaultdict(lambda: 1.0))
    _, worse, fewer = shared_words(pages)
    assert fewer < exact and worse < precision


def test_a_known_word_is_a_prior_and_no_verdict():
    """An article inside an element that carries such a word is found; the same word beside it marks what to leave out."""
    inner = "".join(f"<p>{TEXT * 3}</p>" for _ in range(4))
    page = f"<body><div>Some line.</div><div class='content-sidebar-wrap'>{inner}<div class=related><p>{TEXT}</p></div></div></body>"
    assert main_text(page) == "\n".join([TEXT * 3] * 4)


TEXT = "A first long sentence, with marks and enough words to be one. And a second; it goes on, and on."
AROUND = {
    "plain body": f"<body><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><div class=story><p>{TEXT}<p>{TEXT} More &amp; more.</div><footer>Fine print, all rights.</footer>",
    "comments in the article": f"<main><article><p>{TEXT}</p><p>{TEXT} More &amp; more.</p><section class='comments'><p>I liked it, a lot. {TEXT}</p></section></article></main>",
    "forms, notes, scripts": f"<script>if (a < b) '<p>no</p>'</script><div id=cookie-notice><p>{TEXT}</p></div><div><p>{TEXT}</p><form><p>Sign up, please.</p></form><p>{TEXT} More &amp; more.</p></div><aside>{TEXT}</aside>",
}


@pytest.mark.parametrize("name", AROUND)
def test_other_layouts(name):
    assert main_text(AROUND[name]) == f"{TEXT}\n{TEXT} More & more."


SHORT = "Brief words, few of them."
PARTS = {
    "a section of short paragraphs": f"<div class=post><section class=a><p>{TEXT * 3}</p><p>{TEXT * 3}</p></section><section class=b><p>{SHORT}</p><p>No marks here</p></section></div>",
    "a small section like the others": f"<div><section><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p></section><section><p>{SHORT}</p></section></div>",
    "heading and intro around a list": f"<div class=entry><h1>The title</h1><p>{SHORT}</p><ul><li>{TEXT}</li><li>{TEXT}</li><li>{TEXT}</li></ul><p>{SHORT}</p></div>",
    "sections of the body itself": f"<section><h2>One</h2><p>{TEXT * 2}</p></section><div><section class=x><h2>Two</h2><div>{SHORT}</div></section></div>",
}


@pytest.mark.parametrize("name", PARTS)
def test_sections_lists_and_headings_without_an_article(name):
    page = f"<html><body><div class=nav><p>{SHORT}</p></div><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul>{PARTS[name]}<footer><p>{SHORT}</p></footer></body></html>"
    blocks = (" ".join(x.split()) for x in re.split(r"<[^>]*>", PARTS[name]))
    assert main_text(page) == "\n".join(x for x in blocks if x)


LINKED = {
    "article": f"<article><h1><a href=/t>The linked title</a></h1><p>{TEXT}</p><figure><figcaption><a href=/p>A linked caption</a></figcaption></figure><p>{TEXT}</p><h2>Sources</h2><ul><li><a href=/1>First source</a></li><li><a href=/2>Second source</a></li></ul></article>",
    "no article": f"<div class=post><h2><a href=/t>The linked title</a></h2><p>{TEXT}</p><ul><li><a href=/1>A link amid the text</a></li></ul><p>{TEXT}</p><h2>Sources</h2><ul><li><a href=/1>First source</a></li><li><a href=/2>Second source</a></li></ul></div>",
}


@pytest.mark.parametrize("name", LINKED)
def test_links_that_belong_to_the_article(name):
    menu = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>"
    blocks = (" ".join(x.split()) for x in re.split(r"</?(?:div|article|h\d|p|ul|li|fig\w+)[^>]*>", re.sub(r"</?a\b[^>]*>", "", LINKED[name])))
    assert main_text(f"<html><body>{menu}{LINKED[name]}</body></html>") == "\n".join(x for x in blocks if x)


@pytest.mark.parametrize("page", ["", "   ", "</p></div>", "<!-- <p>no</p>", "<script>never closed <p>x", "<p>" * 3000, "<nav>a</nav>"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_awkward_pages(spark):
    rows = [(1, None, None), (1, "u", ""), (None, None, "<p>One, two."), (3, "u", "no markup at all"), (3, "u", "no markup at all"), (4, "u", f"<p>{TEXT * 3000}")]
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted((str(r.page_id), r.text[:20], r.n_chars) for r in extracted(pages).collect())
    assert found == [("1", "", 0), ("1", "", 0), ("3", "no markup at all", 16), ("3", "no markup at all", 16), ("4", TEXT[:20], len(TEXT) * 3000), ("None", "One, two.", 9)]
    assert extracted(pages.limit(0)).count() == 0


URLS = {
    "http://a.example.org/es/1?x=1#y": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "https://EXAMPLE.org/en/1": ("example.org", "/en/1", "example.org/en/1", "block"),
    "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "https://example.org": ("example.org", "", None, "allow"),
    "https://myexample.org/es/": ("myexample.org", "/es/", "org/", "allow"),
    "http://x.com/fr/9": ("x.com", "/fr/9", "com/fr/", "allow"),
    "http://x.com/de/9#z://q": ("x.com", "/de/9", "com/de/", "block"),
    "ftp://h?q#r": ("h", "", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_hosts_paths_and_listed_rules(spark, no_labels):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in ur.url_verdicts(pages, no_labels).collect()}
    assert found == dict(enumerate(URLS.values()))


def test_mined_rules(spark):
    """Bad URLs share a host; all URLs with it are blocked, also those without a label, and no others."""
    rows = [(i, f"https://{'bad' if i % 4 == 0 else f'site{i % 7}'}.example.net/en/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 4 != 0).cast("int").alias("quality"))
    for r in ur.url_verdicts(pages, labels).collect():
        assert (r.verdict == "block") == (r.page_id % 4 == 0), r


def test_pruning_and_the_index_against_brute_force(spark):
    urls = spark.createDataFrame([(f"u{i}", [t for j, t in enumerate("abcdef") if i >> j & 1]) for i in range(1, 64)], "url string, tokens array<string>")
    rules = spark.createDataFrame([(["a"], 0.7, 0.1), (["a", "b"], 0.7, 0.1), (["a", "c"], 0.9, 0.1), (["d", "e"], 0.6, 0.1), (["z"], 0.9, 0.1)], "tokens array<string>, confidence double, support double")
    kept = ur.pruned(rules)
    assert sorted(r.rule for r in kept.collect()) == ["a", "a c", "d e", "z"]
    want = {r.url for r in urls.collect() if {"a"} <= set(r.tokens) or {"d", "e"} <= set(r.tokens)}
    assert {r.url for r in ur.matched(urls, kept).collect()} == want


def brute_rules(rows, least, confidence):
    """Every combination of tokens that can be part of a rule, counted over all rows; of tokens in the same rows the first."""
    n_bad = sum(bad for _, bad in rows)
    where = {t: frozenset(i for i, (tokens, _) in enumerate(rows) if t in tokens) for t in set().union(*(r[0] for r in rows))}
    bad = frozenset(i for i, r in enumerate(rows) if r[1])
    useful = [t for t, own in where.items() if len(own & bad) >= least and len(own & bad) * len(rows) >= ur.LIFT * n_bad * len(own)]
    useful = sorted(min(t for t in useful if where[t] == own) for own in {where[t] for t in useful})
    out = set()
    for k in range(1, len(useful) + 1):
        for some in combinations(useful, k):
            own = frozenset.intersection(*(where[t] for t in some))
            if len(own & bad) >= least and len(own & bad) >= confidence * len(own):
                out.add((some, round(len(own & bad) / len(own), 9), round(len(own & bad) / len(rows), 9)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_mining_against_counting_every_combination(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        tokens = {t for t in "abcdefgh" if rng.random() < 0.4} | {"all"}
        tokens |= {"twin"} if "a" in tokens else set()
        rows.append((sorted(tokens), rng.random() < (0.8 if {"a", "b"} <= tokens else 0.1 + 0.2 * ("c" in tokens))))
    found = ur.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), support=0.0, confidence=0.3).collect()
    want = brute_rules([(set(t), b) for t, b in rows], ur.LEAST_URLS, 0.3)
    assert {(tuple(r.tokens), round(r.confidence, 9), round(r.support, 9)) for r in found} == want and len(want) > 1


def test_long_paths_do_not_explode(spark):
    """Twenty common segments in each URL, some of them missing here and there; one host is bad."""
    rng = random.Random(1)
    rows = []
    for i in range(600):
        segments = [f"s{j}" for j in range(20) if rng.random() < 0.9]
        rows.append((i, f"https://{'bad' if i % 5 == 0 else f'site{i % 7}'}.example.net/en/{'/'.join(segments)}/{i}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 5 != 0).cast("int").alias("quality"))
    began = time.perf_counter()
    verdicts = ur.url_verdicts(pages, labels).collect()
    assert all((r.verdict == "block") == (r.page_id % 5 == 0) for r in verdicts) and time.perf_counter() - began < 60


def test_url_table_without_rows(spark, labels):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert ur.url_verdicts(pages, labels).count() == 0


def test_small_articles_beside_each_other():
    articles = "".join(f"<article><h2><a href=/{i}>Title {i}</a></h2><p>Short words {i}.</p></article>" for i in range(4))
    assert "Short words 2." in main_text(f"<body><div>{articles}</div><div><p>{TEXT * 2}</p></div></body>")
