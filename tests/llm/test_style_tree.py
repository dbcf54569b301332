"""Main text of pages: written cases, the given pages by another rule, and the style tree by a plain count."""

import html
import math
import re
from collections import Counter, defaultdict

import pytest

from gearwatch.llm import style_tree
from gearwatch.llm.style_tree import Page

SCHEMA = "page_id long, url string, html string, text string, host string, key long, paths string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


CASES = {
    "plain article": ("<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>One.<p>Two &amp; <b>three</b></article><footer>f</footer>", "T\nOne.\nTwo & three"),
    "article header keeps its title": ("<header>Site</header><article><header><h1>Title</h1></header>Text<footer>Share</footer></article>", "Title\nText"),
    "comments and forms": ("<article><p>A</p><section id='comments'><p>nice</p></section><form><p>Mail <input></p></form><article><p>reply</p></article></article>", "A"),
    "no article": ("<body><div class='sidebar'>Side</div><div><p>Main &lt;text&gt;</p></div><div class=cookie-notice>We use</div></body>", "Main <text>"),
    "main element": ("<div>Before</div><main><p>In</p></main><div>After</div>", "In"),
    "form around the page": ("<form><div>Login</div><main><p>Body</p></main></form>", "Body"),
    "raw elements": ("<title>t</title><script>var a='</p><p>no';</script><style>p{}</style><textarea>x</textarea><p>yes</p><script>open", "yes"),
    "comments in markup": ("<p>a<!-- <p>no</p> -->b<!-->c<!--->d</p><!-- open <p>no</p>", "abcd"),
    "white space": ("<p> a\n\t b&nbsp;&nbsp;c<br>d </p>\n<pre>e  f</pre>", "a b c d\ne f"),
    "unclosed": ("<article><p><b>one<br><p>two<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>tail", "one\ntwo\nx\ny\n1\n2\n3\ntail"),
    "inline advert": ("<p>Read <span class='ad'>buy</span> this</p>", "Read\nthis"),
    "stray characters": ("<p>1 < 2 && 3 > 2 &bogus; &#x41;&#66;</p></div></span>", "1 < 2 && 3 > 2 &bogus; AB"),
    "hidden": ("<p hidden>a</p><div style='display: none'>b</div><p aria-hidden=false>c</p>", "c"),
    "role and class words": ("<div role=navigation>a</div><div class='has-sidebar'>b</div><div class='MainMenu'>c</div><div class='shadow'>d</div>", "b\nd"),
    "menu without a name": ("<div><ul><li><a href=1>a</a></li><li><a href=2>b</a></li><li><a href=3>c</a></li></ul></div><p>text <a href=4>link</a></p>", "text link"),
    "open quote": ("<p>a <a href=\"x>b</a> c</p>", "a b c"),
    "no element": ("just text", "just text"),
    "no text": ("<nav><a>x</a></nav>", ""),
    "nothing": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_written_cases(name):
    source, wanted = CASES[name]
    assert Page(source, {}).extract(set()) == wanted


def test_given_pages_by_another_rule(spark, folder):
    def plain(source):
        body = re.search(r"<article>(.*?)(</article>|<footer>)", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(p for p in parts if p)

    table = spark.read.parquet(f"{folder}/pages.parquet")
    wanted = {r.page_id: (r.url, plain(r.html)) for r in table.collect()}
    assert {r.page_id: (r.url, r.text) for r in style_tree.report(table).collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in style_tree.report(table).collect())


def site(count, host="a.example"):
    """Pages without any telling tag or name: a line that is the same on all pages, and a text of their own."""
    return [(k, f"http://{host}/{k}", f"<body><div class='x1'>Welcome to our site</div><div class='x2'><p>Text number {k}</p><p>More of {k * k}</p></div>"
             f"<div class='x3'><b>All rights</b> kept</div></body>") for k in range(count)]


def test_templates_of_a_site_go(spark):
    found = texts(style_tree.report(pages(spark, site(12))))
    assert found == {k: f"Text number {k}\nMore of {k * k}" for k in range(12)}


def test_copied_articles_stay(spark):
    rows = site(10) + [(100 + k, f"http://a.example/c{k}", site(4)[3][2]) for k in range(50)]
    found = texts(style_tree.report(pages(spark, rows).repartition(7)))
    assert all(found[100 + k] == "Text number 3\nMore of 9" for k in range(50))
    article = [(k, "http://b.example/", "<div class='x1'>Hello</div><article><p>The same</p></article>") for k in range(20)]
    assert set(texts(style_tree.report(pages(spark, article))).values()) == {"The same"}


def test_small_sites_and_pages_without_host_are_not_judged(spark):
    rows = site(2) + [(10 + k, None, h) for k, _, h in site(9)]
    assert all(t.startswith("Welcome to our site\nText number") for t in texts(style_tree.report(pages(spark, rows))).values())


def test_all_low_importance_stays(spark):
    rows = [(k, "http://c.example/", f"<!-- {k} --><div class='u{'abc'[k % 3]}'>Same words</div>") for k in range(9)]
    assert set(texts(style_tree.report(pages(spark, rows))).values()) == {"Same words"}


def test_odd_rows(spark):
    rows = [(None, "http://x.example/", "<p>a</p>"), (1, None, None), (1, "http://x.example/", ""), (2**62 + 1, "no host", "<p>b</p>"), (2**62 + 1, "no host", "<p>b</p>"),
            (3, "http://x.example/", "<div>" * 5000 + "deep"), (4, "http://x.example/", "<p>" + "long " * 200_000 + "</p>"), (5, "://", "<" * 1000)]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in style_tree.report(pages(spark, rows).repartition(20)).collect()), key=repr)
    long = ("long " * 200_000).strip()
    assert found == sorted([(None, "a", 1), (1, "", 0), (1, "", 0), (2**62 + 1, "b", 1), (2**62 + 1, "b", 1), (3, "deep", 4), (4, long, len(long)), (5, "<" * 1000, 1000)], key=repr)
    empty = style_tree.report(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["page_id", "url", "text", "n_chars"]


def test_importance_equals_a_plain_count(spark):
    rows = site(6) + [(k, f"http://a.example/o{k}", f"<body><div class='x2'><h2>Title</h2><p>Text number {k % 2}</p></div></body>") for k in range(6, 9)]
    held, styles, contents = defaultdict(set), defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for k, _, source in rows:
        page = Page(source, {})
        for path in page.labels:
            held[path].add(page.blocks[0].text + "|" + "\n".join(b.text for b in page.blocks))
        mark = page.blocks[0].text + "|" + "\n".join(b.text for b in page.blocks)
        for path, style in page.styles:
            styles[path][style].add(mark)
        for b in page.blocks:
            contents[b.path][b.text].add(mark)

    def importance(path):
        m = len(held[path])
        if m == 1:
            return 1.0
        counts = Counter({s: len(p) for s, p in styles[path].items()})
        total = sum(counts.values())
        shown = min(1.0, -sum(n / total * math.log(n / total, m) for n in counts.values()))
        kept = 1 - sum(math.log(len(p), m) for p in contents[path].values()) / len(contents[path]) if contents[path] else 1.0
        weight = 0.9 ** len(counts)
        return (1 - weight) * shown + weight * kept

    found = {r.path: (r.pages, r.importance) for r in style_tree.style_tree(style_tree.page_nodes(pages(spark, rows))).collect()}
    assert set(found) == set(held)
    for path, (count, value) in found.items():
        assert count == len(held[path]) and value == pytest.approx(importance(path), abs=1e-9)
