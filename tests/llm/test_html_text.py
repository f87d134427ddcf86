"""Main text of pages: blocks, the labeller's gradients and what it learns, odd pages."""

import numpy as np
import pytest

from millrace.llm import html_text
from millrace.llm.common import table
from millrace.llm.html_blocks import blocks


@pytest.mark.parametrize("html, texts", [
    ("<p>a  b\n c</p><p>d", ["a b c", "d"]),
    ("x<br>y<b>z</b>w", ["x", "yzw"]),
    ("<script>var t='</p>';</script>k<style>p{}</style><!-- <p>no</p> -->l", ["kl"]),
    ("a &amp;&lt; b &eacute;&#x41;&nbsp;c 3 < 4", ["a &< b éA c 3 < 4"]),
    ("<p title='a>b'>t</p><script>open", ["t"]),
    ("", []), (None, []), ("<p> </p><div></div>", []), ("plain", ["plain"]), ("<!-- open", []), ("<p", ["<p"]),
])
def test_blocks(html, texts):
    assert [b.text for b in blocks(html)] == texts


def test_paths_follow_implied_ends():
    page = blocks("<article class='Post-body x'><p><b>one<br><p>two</article><ul><li><a href=1>three</a><li>four</ul>five")
    assert [b.path for b in page] == [("article", ".post", ".body", ".x", "p")] * 2 + [("ul", "li")] * 2 + [()]
    assert [b.linked for b in page] == [0, 0, 5, 0, 0]


@pytest.mark.parametrize("unit, tail", [
    ("<a ", ""), ("<a ", ">"), ("<div><p>x", ""), ("<span>x", ""), ('<a ">"', ""), ("<script ", ""), ("<!-- ", ""), ("</x>", ""),
    ("<foo><dd><div><foo><dt></dt>", ""), ("<a '>x", '"'), ("< ", ">"), ("<b x=\"'>y", ""), ("<li><ul>x", "</ul>" * 9000)])
def test_time_is_in_proportion_to_broken_pages(unit, tail):
    import time
    took = []
    for n in (8_000, 32_000):
        began = time.perf_counter()
        page = blocks(unit * n + tail)
        html_text.vectors(page[-50:])
        html_text.ruled(page)
        took.append(time.perf_counter() - began)
    assert took[1] < 5 and took[1] < 7 * took[0] + 0.1  # the largest page has 0.9 MB


def test_tags_without_an_end_among_others():
    page = "<p>one</p><a \">\"<p>two</p><a \">\"<b>three</b> <i x='>four"
    assert [b.text for b in blocks(page)] == ["one", "two", "three four"] == plain_texts(page)
    rng = np.random.default_rng(5)
    for _ in range(300):  # what a plain reading of the same rules finds
        html = "".join(rng.choice(["<p>", "</p>", "<a '", '<b "', ">", "'", '"', "x", "<li>", "<ul>", "</ul>", "<!--", "-->", "<div>"], 30))
        assert [b.text for b in blocks(html)] == plain_texts(html)


def plain_texts(html):
    """Texts between markup, read with no memory of what failed before."""
    from html import unescape

    from millrace.llm import html_blocks as hb
    out, parts, at = [], [], 0
    begin = html.find("<")
    while begin >= 0:
        mark = hb._MARKUP.match(html, begin)
        if mark is None:
            begin = html.find("<", begin + 1)
            continue
        parts.append(html[at:begin])
        at = mark.end()
        begin = html.find("<", at)
        if mark[3] and mark[3].lower() not in hb.INLINE:
            out.append("".join(parts))
            parts = []
    out.append("".join(parts) + html[at:])
    return [t for t in (" ".join(unescape(x).split()) for x in out) if t]


# Pages written by hand, in layouts that no training page has.
FOREIGN = [
    ("""<html><body bgcolor=white><table width=100%><tr><td colspan=2><font size=5>Harbour Gazette</font></td></tr>
     <tr><td><ul class=nav><li><a href=/>Start</a><li><a href=/sport>Sport</a><li><a href=/shop>Shop</a></ul></td>
     <td class="text story"><h2>Ferry service returns after the storm</h2>
     <p>The morning ferry left the harbour on time for the first time in nine days, with forty passengers on board.</p>
     <p>Crews had worked through three nights to clear the channel, the harbour master said, and more work is planned.</p></td></tr>
     <tr><td colspan=2 class=footer><a href=/imprint>Imprint</a> <a href=/privacy>Privacy</a></td></tr></table></body></html>""",
     ["Ferry service returns", "The morning ferry left", "Crews had worked"], ["Sport", "Imprint"]),
    ("""<body><header class=masthead><h3>Notes</h3></header><div class="cookie-banner"><p>We use cookies.</p><button>Accept</button></div>
     <main><article><h1>A walk along the old canal</h1><p>The towpath begins behind the mill, where two stone bridges cross the water.</p>
     <aside class="ad"><p>Buy boots today!</p></aside><p>After a mile the trees close in, and the noise of the road is gone for good.</p></article></main>
     <section id=comments class=comments><p>Great walk, did it last week with the dog.</p></section><footer><p>All rights reserved</p></footer></body>""",
     ["A walk along", "The towpath begins", "After a mile"], ["We use cookies", "Buy boots", "Great walk", "All rights"]),
]


@pytest.mark.parametrize("html, main, rest", FOREIGN)
def test_foreign_layouts(trained, html, main, rest):
    page = blocks(html)
    chosen = " ".join(b.text for b, c in zip(page, trained.chances([html_text.vectors(page)])[0]) if c >= 0.5)
    assert all(m in chosen for m in main) and not any(r in chosen for r in rest), chosen


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = html_text.Labeller.fresh()
    params = [model.ahead.w, model.ahead.u, model.ahead.b, model.back.u, model.out]
    for p in params:
        p[...] = rng.normal(0, .3, p.shape)
    pages = [rng.normal(size=(n, html_text.WIDTH)).astype(np.float32) for n in (3, 5)]
    wanted = [rng.integers(0, 2, len(p)) for p in pages]

    def loss():
        chance = model._run(pages)[3].astype(float)
        return -sum(np.log(c if y else 1 - c) for k, ys in enumerate(wanted) for c, y in zip(chance[:, k], ys)) / 8

    x, real, both, chance, one, two = model._run(pages, True)
    target = np.zeros_like(chance)
    for k, ys in enumerate(wanted):
        target[:len(ys), k] = ys
    error = np.where(real, chance - target, 0) / real.sum()
    d = error[:, :, None] * model.out
    grads = [*model.ahead.backward(x, one, d[:, :, :html_text.HIDDEN]),
             model.back.backward(x[::-1], two, d[::-1, :, html_text.HIDDEN:])[1], (error[:, :, None] * both).sum(axis=(0, 1))]
    for p, g in zip(params, grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            kept, step = p[at], 1e-2
            p[at] = kept + step
            up = loss()
            p[at] = kept - step
            down = loss()
            p[at] = kept
            assert abs((up - down) / (2 * step) - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_padding_changes_nothing():
    rng = np.random.default_rng(0)
    model = html_text.Labeller.fresh()
    pages = [rng.normal(size=(n, html_text.WIDTH)).astype(np.float32) for n in (7, 1, 0, 30)]
    together = model.chances(pages)
    for page, chance in zip(pages, together):
        alone = model.chances([page])[0]
        assert len(chance) == len(page) and np.allclose(alone, chance, atol=1e-5)


@pytest.fixture(scope="module")
def trained(spark, sf):
    return html_text.fit(table(spark, sf, "pages"))


def test_main_text_of_the_given_pages(spark, sf, trained):
    pages = table(spark, sf, "pages")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract(pages, trained, also=["url"]).collect():
        page = blocks(source[r["page_id"]])
        assert r["text"] == " ".join(b.text for b, m in zip(page, html_text.ruled(page)) if m)
        assert r["n_chars"] == len(r["text"])


def test_layouts_it_never_saw(spark, sf, trained):
    rng, right, all_ = np.random.default_rng(77), 0, 0
    for r in table(spark, sf, "pages").limit(60).collect():
        page = blocks(r["html"])
        marks = html_text.ruled(page) > 0
        html, known = html_text.relaid([b.text for b, m in zip(page, marks) if m],
                                       [b.text for b, m in zip(page, marks) if not m], rng)
        again = blocks(html)
        if len(again) == len(known):
            right += ((trained.chances([html_text.vectors(again)])[0] >= 0.5) == np.array(known)).sum()
            all_ += len(known)
    assert right / all_ > 0.97


def test_odd_pages(spark, trained):
    pages = spark.createDataFrame(
        [(1, None, "u", "t"), (2, "", None, "t"), (None, "<article><p>Some words here.</article>", "u", "t"),
         (3, "<article>" + "<p>Some words stand in here.</p>" * 5000 + "</article>", "u", "t"), (3, "", "u", "t")],
        "page_id bigint, html string, url string, text string")
    rows = html_text.extract(pages, trained, also=["url"]).collect()
    assert len(rows) == 5
    assert [r["text"] for r in rows if r["page_id"] in (1, 2)] == ["", ""]
    assert max(r["n_chars"] for r in rows) >= 5000 * 20
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0
