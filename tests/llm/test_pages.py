"""URL rules against a linear scan, main texts against known pages."""

from __future__ import annotations

import random

from gridtide.llm.extraction import extract, extract_main_text
from gridtide.llm.queries_scoring import URL_RULES
from gridtide.llm.url_filter import build, filter_urls, longest, parts


def scan(rules, host, path):
    fits = [
        (len(h.split(".")), len(p), i) for i, (_, h, p) in enumerate(rules)
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (rules[max(fits)[2]][1] + rules[max(fits)[2]][2], rules[max(fits)[2]][0]) if fits else None


def test_parts():
    assert parts(None) == parts("") == parts("no scheme.org/x") == ("", "")
    assert parts("HTTP://A.Org") == ("a.org", "")
    assert parts("http://a.org?x=/y") == ("a.org", "")
    assert parts("http://a.org/P/é?x#y") == ("a.org", "/P/é")
    assert parts("x://É.Org#/p://q") == ("É.org", "")
    assert parts("http:///p") == ("", "/p")


def test_trie_against_scan():
    rng = random.Random(3)
    labels, segments = ["a", "b", "org", "com", ""], ["", "x", "xy", "y", "1", "12"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))

    def path():
        return "/" + "/".join(rng.choice(segments) for _ in range(rng.randrange(4)))

    for _ in range(60):
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p)
                      for h, p in ((host(), path()) for _ in range(rng.randrange(12)))}.values())
        trie = build(rules)
        for _ in range(60):
            h, p = host(), rng.choice(["", path(), path() + "z"])
            assert longest(trie, h, p) == scan(rules, h, p), (rules, h, p)


def test_filter_urls(spark):
    urls = ["https://www.example.org/es/5", "http://example.org/en/17", "http://example.org/en/2",
            "http://x.com/fr/1", "http://x.com/de/1", "http://x.net/", None, "", "http://notorg/", "http://org"]
    rows = [(i, u, "r", "v") for i, u in enumerate(urls)] + [(None, urls[0], "r", "v"), (0, urls[0], "r", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string")
    got = filter_urls(pages, URL_RULES)
    assert got.select("row.*").columns == pages.columns
    by_id = {r.row.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert got.count() == len(rows)
    assert by_id == {
        0: ("example.org/es/", "block"), 1: ("example.org/en/1", "block"), 2: ("org/", "allow"),
        3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 5: (None, "allow"), 6: (None, "allow"),
        7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), None: ("example.org/es/", "block"),
    }
    assert filter_urls(pages.limit(0), URL_RULES).count() == 0


PROSE = [
    "The harbour was quiet that morning, and the boats, still wet, lay side by side & waited.",
    "Nobody had told the keeper, who slept late, that the light <had> failed again in the night.",
    "By noon, when the fog lifted, three of them had already gone out to look for the buoy.",
]
NOISE = "Great read, thanks, I agree, with all, of it, and more, and I say so, again, and again."


def page(layout):
    paragraphs = "".join(f"<p>{p.replace('&', '&amp;').replace('<', '&lt;')}" for p in PROSE)
    around = {
        "article": f"<div class=c><article><h1>Title</h1>{paragraphs}</article></div>",
        "div": f"<div id='wrap'><div class='post-body'><h1>Title</h1>{paragraphs}</div></div>",
        "main": f"<main><h1>Title</h1><section>{paragraphs}</section></main>",
        "table": f"<table><tr><td><h1>Title</h1>{paragraphs}</td></tr></table>",
    }[layout]
    menu = "".join(f"<li><a href=/{i}>Entry {i}, of the menu, which is long enough</a>" for i in range(9))
    return (
        f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script>"
        f"<style>p{{}}</style></head><body><header><a href=/>Home</a></header><nav><ul>{menu}</ul></nav>"
        f"<!-- <p>hidden, comment, with commas, and more text than it needs</p> -->"
        f"<div class='cookie-banner'>{NOISE}</div><div class='ad'>{NOISE}</div>"
        f"<aside><p>{NOISE}</p></aside>{around}"
        f"<div id=comments><p>{NOISE}</p><p>{NOISE}</p><p>{NOISE}</p><p>{NOISE}</p></div>"
        f"<div style='display: none'>{NOISE}</div><form><p>{NOISE}</p><textarea>{NOISE}</textarea></form>"
        f"<ul>{menu}</ul><footer>&copy; {NOISE}</footer></body></html>"
    )


def test_layouts():
    for layout in ("article", "div", "main", "table"):
        assert extract(page(layout)) == "\n".join(["Title", *PROSE]), layout


def test_blocks_and_references():
    got = extract("<article><h2> A &amp;\n B&#33; </h2>text <b>bo</b>ld<br>next &eacute;&nbsp;x"
                  "<ul><li>one<li>two <i>2</i></ul><pre> x\n y</pre><p></p><p> </p>tail</article>")
    assert got == "A & B!\ntext bold next é x\none\ntwo 2\nx y\ntail"
    assert extract(None) == extract("") == extract("<html></html>") == ""
    assert extract("just text") == "just text"
    assert extract("<p>a<p>b<div>c</p>d") .split("\n") == ["a", "b", "c", "d"]
    assert extract("<article><p>a &lt;b&gt; 1 < 2 <b") == "a <b> 1 < 2"


def test_deep_long_and_broken_pages():
    deep = "<div>" * 5000 + "deep text" + "</div>" * 4000
    assert extract(deep) == "deep text"
    long = "<article>" + "".join(f"<p>paragraph {i}, of many</p>" for i in range(20_000))
    assert extract(long).count("\n") == 19_999
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div", ">", "<", "</", "text ", "<!--", "-->", "'", '"', "&amp", "<script>",
             "</script>", "<table>", "<td>", "<a href='", "</article>", "<article>", "<li>", "=", "/>"]
    for _ in range(500):
        extract("".join(rng.choice(parts) for _ in range(rng.randrange(60))))


def test_extract_rows(spark):
    rows = [(1, "u", page("article"), "t"), (1, "u", page("article"), "t"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = extract_main_text(pages)
    assert got.select("row.*").columns == pages.columns
    assert sorted(r.main_text for r in got.collect()) == sorted(["", *["\n".join(["Title", *PROSE])] * 2])
    assert extract_main_text(pages.limit(0)).count() == 0


def test_names_that_mislead():
    body = "".join(f"<p>{p.replace('&', '&amp;').replace('<', '&lt;')}</p>" for p in PROSE)
    want = "\n".join(PROSE)
    side = f"<div class='sidebar'><p>{NOISE}</p></div>"
    for around in ("<div class='layout has-sidebar'>", "<div class='no-comments'>", "<div class='side-by-side'>",
                   "<div class='post share-open'>", "<form id='aspnetForm'>", "<div id='sidebar-page'>"):
        end = "</form>" if around.startswith("<form") else "</div>"
        assert extract(f"<body>{around}{body}{end}</body>") == want, around
        assert extract(f"<body>{around}{side}<div>{body}</div>{end}<footer>x</footer></body>") == want, around
    assert extract(f"<body><div class='comments'><p>{NOISE}</p></div><div>{body}</div></body>") == want


def test_headings_beside_the_best_container_stay():
    body = "".join(f"<p>{p.replace('&', '&amp;').replace('<', '&lt;')}</p>" for p in PROSE)
    want = "\n".join(["Flood", *PROSE])
    assert extract(f"<body><div><h1>Flood</h1><div class='body'>{body}</div></div></body>") == want
    other = f"<body><div><h2>Links</h2><ul><li>a</ul><h1>Flood</h1><div class='body'>{body}</div><h2>More</h2></div></body>"
    assert extract(other) == want


def test_depth_costs_no_more_than_length():
    import time

    def seconds(n):
        begin = time.perf_counter()
        extract("<div>some text that is long enough to score " * n)
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(8000) < 20 * max(seconds(1000), 0.01)
