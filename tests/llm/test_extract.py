from collections import defaultdict

from pyspark.sql import functions as F

from entwine.llm import extract as X

PAGE = "page_id long, url string, html string"


def main(page):
    return [t for t, _ in X.blocks(X.read(page).parts)]


def test_structure():
    page = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header><nav><ul><li>a</ul></nav>
    <div id="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Title</h1><span>by X</span></header><p>One &amp; two<br>three&nbsp;<b>bo</b>ld
    <p><script>var t="</p>";</script>next <!-- no --> one<div class="share-bar">Share</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form>f</form>
    <section id="comments"><article><p>nice</p></article></section></article><aside>side</aside></main><div class="advert">buy</div><footer>&copy; foot</footer></body></html>"""
    assert main(page) == ["Title", "One & two three bold", "next one", "a", "b", "c", "d"]
    assert main("plain &lt;text&gt;") == ["plain <text>"] and main("") == [] and main("<p>cut <b") == ["cut"]
    assert main("<article><p>a</p><div class=x>b</article>") == ["a", "b"] and main("<p>é</i></b><p>b") == ["é", "b"]


def test_templates_go_and_copies_stay(spark):
    page = lambda i, more="": f"<article><p>Text number {i} of this page, long enough to be most of it.</p><div class=x><p>Read more on our site</p></div>{more}</article>"
    rows = [(i, "http://a.example/x", page(i)) for i in range(8)] + [(20 + i, "http://b.example/", page(0)) for i in range(8)] + [(40, "http://c.example/", page(1)), (41, None, None), (42, "http://[bad", "")]
    got = {r.id: r for r in X.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert all(got[i].text == f"Text number {i} of this page, long enough to be most of it." for i in range(8))
    assert all(got[20 + i].text.endswith("Read more on our site") for i in range(8)) and got[40].text.endswith("site")
    assert got[41].text == "" and got[42].text == ""


def test_edges(spark):
    assert X.extract(spark.createDataFrame([], PAGE)).count() == 0
    rows = spark.createDataFrame([(1, "u", "<p>a")] * 2, PAGE).withColumn("host", F.lit(1)).withColumn("blocks", F.lit(1)).withColumn("row", F.lit(1))
    assert [r.text for r in X.extract(rows).collect()] == ["a", "a"]
    assert len(main("<div>" * 3000 + "deep")) == 1


def test_templates_of_few_pages_of_a_large_host_go_and_from_short_pages_too(spark):
    page = lambda i, widget: f"<article><p>Text number {i} of this page, long enough to be most of it.</p><div class=x><p>Own {i}</p></div>{widget}</article>"
    widget = "<div class=x><p>Read more on our site</p></div>"
    rows = [(i, "http://a.example/x", page(i, widget if i < 6 else "")) for i in range(130)] + [(200, "http://a.example/x", f"<article><p>Short.</p>{widget}</article>")]
    rows += [(300 + i, "http://b.example/x", f"<article><p>{i}</p>{widget}</article>") for i in range(8)]  # most of every page
    got = {r.id: r.text for r in X.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert not any("Read more" in got[i] for i in range(130)) and all(got[i].endswith(f"Own {i}") for i in range(130))
    assert got[200] == "Short." and all(got[300 + i].endswith("Read more on our site") for i in range(8))


def test_what_no_rule_names_goes_only_by_its_template(spark, monkeypatch):
    menu, foot = "<div class=x1><ul><li>Home<li>Shop</ul></div>", "<div class=x2>All rights <b>reserved</b></div>"
    page = lambda i: f"<body>{menu}<div><h1>Title {i}</h1><p>Words of page {i} that no other page has, a good many of them.</p></div>{foot}</body>"
    rows = spark.createDataFrame([(i, "http://a.example/", page(i)) for i in range(9)], PAGE)
    got = {r.id: r for r in X.extract(rows).collect()}
    assert all(got[i].text == f"Title {i}\nWords of page {i} that no other page has, a good many of them." and got[i].n_templates for i in range(9))
    monkeypatch.setattr(X, "LEAST_TEXTS", 1 << 30)
    off = {r.id: r for r in X.extract(rows).collect()}
    assert all("Home" in off[i].text and "All rights reserved" in off[i].text and not off[i].n_templates for i in range(9))


def test_every_page_against_a_plain_count_of_its_host(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = pages.collect()
    read = {r.page_id: X.read(r.html or "") for r in rows}
    shown = {i: "\n".join(f for f in [t for t, flow in X.blocks(p.parts) if flow] or main_of(p)) for i, p in read.items()}
    around = defaultdict(set)
    for r in rows:
        parts, total = read[r.page_id].parts, sum(map(len, main_of(read[r.page_id])))
        for h, a, b in read[r.page_id].elements:
            if sum(len(p[4]) for p in parts[a:b]) <= X.MOST_OF_PAGE * total:
                around[X.host(r.url), h].add(shown[r.page_id])
    want = {}
    for r in rows:
        gone = {k for h, a, b in read[r.page_id].elements if len(around[X.host(r.url), h]) >= X.LEAST_TEXTS for k in range(a, b)}
        want[r.page_id] = "\n".join(t for t, _ in X.blocks([p for k, p in enumerate(read[r.page_id].parts) if k not in gone]))
    got = X.extract(pages).collect()
    assert {r.id: r.text for r in got} == want and sum(r.n_templates > 0 for r in got) > 0


def main_of(page):
    return [t for t, _ in X.blocks(page.parts)]


def test_a_repeated_paragraph_of_articles_stays(spark):
    page = lambda i: f"<article><p>Text number {i} of this page.</p><p>Shared under the same licence.</p></article><div>Ring us</div>"
    got = X.extract(spark.createDataFrame([(i, "http://a.example/", page(i)) for i in range(9)], PAGE)).collect()
    assert all(r.text.endswith("page.\nShared under the same licence.") for r in got)
