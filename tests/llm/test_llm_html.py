import random
import time

import pandas as pd
import pytest

from conftest import SF_SMALL
from lanekit.llm import html
from lanekit.llm.queries import QUERIES


def page(body, host="a.example", n=0):
    return f"https://{host}/p/{n}", f"<!doctype html><html><head><title>T</title></head><body>{body}</body></html>"


def run(spark, pages, **kw):
    rows = [(i, url, h) for i, (url, h) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html.main_text(df, **kw).collect()}


def test_articles_of_the_table(spark):
    """Every page's article, block by block, and nothing else."""
    got = QUERIES["op3_html_main_text"](spark, SF_SMALL).toPandas().set_index("page_id")
    pages = pd.read_parquet(f"{SF_SMALL}/pages.parquet").set_index("page_id")
    assert len(got) == len(pages)
    for i, source in pages.html.items():
        inner = source.split("<article>")[1].split("</article>")[0]
        for tag in ("<h1>", "</h1>", "<p>", "</p>", "<br>"):
            inner = inner.replace(tag, "\n")
        inner = inner.replace("<b>", "")
        assert "<" not in inner
        import html as h
        wanted = "\n".join(t for t in (" ".join(h.unescape(x).split()) for x in inner.split("\n")) if t) \
            if "\n" not in source.split("<article>")[1].split("</article>")[0] else None
        if wanted is not None:
            assert got.text[i] == wanted
        assert got.n_chars[i] == len(got.text[i])


def test_boilerplate_without_an_article_element(spark):
    pages = [page(f"<div id=top class='site-menu'><a href=/>Home {i}</a></div><div id=wrap><div class=cookie-notice>We "
                  f"use cookies</div><div class=main><h2>Head {i}</h2><p>First text of page {i} with <a href=x>a link</a> "
                  f"inside &amp; more<p>Second\n  text {i}</div><div class='side bar'><p>Always the same line</p></div></div>"
                  f"<div class=comments><p>Reader {i} says no</p></div><form>Mail <input></form><footer>(c) {i}</footer>",
                  n=i) for i in range(6)]
    got = run(spark, pages)
    for i, text in got.items():
        assert text == f"Head {i}\nFirst text of page {i} with a link inside & more\nSecond text {i}"


def test_notices_inside_the_container(spark):
    """A block that is the same on every page is a template token."""
    pages = [page(f"<div><p>Subscribe now to read on</p><p>Story {i} begins here and goes on</p></div>", n=i) for i in range(5)]
    assert run(spark, pages) == {i: f"Story {i} begins here and goes on" for i in range(5)}


def test_repeated_article_text_stays(spark):
    pages = [page("<nav>x</nav><article><p>The same story everywhere</p></article>", n=i) for i in range(5)]
    assert set(run(spark, pages).values()) == {"The same story everywhere"}


@pytest.mark.parametrize("body, text", [
    ("<article><p>a<script>if (a</p> < b) {}</script>b<style>p{}</style></p></article>", "a\nb"),
    ("<article><p>1 &lt; 2 &copy; &#x41;&#66; &nbsp; end</article>", "1 < 2 © AB end"),
    ("<article><p>a <!-- <p>no</p> --> b <b>c</b>d</p></article>", "a b cd"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x\ny\n1\n2"),
    ("<article><p title='a > b'>t</p><p hidden>no</p><aside>no</aside></article>", "t"),
    ("<article><p>open <b>bold<br><p>next</article><footer>no</footer>", "open bold\nnext"),
    ("<main><section class=comments><p>no</p></section><p>yes</p></main>", "yes"),
    ("<p>plain 3 < 4 text", "plain 3 < 4 text"), ("", ""), ("<!-- never closed", "")])
def test_single_pages(spark, body, text):
    assert html.extract(page(body)[1], None, frozenset()) == text


def test_edge_rows(spark):
    rows = [(1, None, None, 1), (2, "no url", "", 1), (None, "http://h/1", "<article>x</article>", 1),
            (3, "http://h/1", "<article>x</article>", 1), (3, "http://h/1", "<article>x</article>", 1),
            (4, None, "just text", 1), (5, "http://H:80/2", "<div>" * 3000 + "deep" + "</div>" * 10, 1),
            (6, "http://u@h/3", "<p>" + "long " * 50_000, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host bigint")
    got = html.main_text(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [
        (0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 9), (5, 4), (6, 249_999)]
    assert html.main_text(pages.limit(0)).count() == 0


def test_vectors_make_the_classes():
    rows = pd.DataFrame(
        [(0, -1, 0, 1, 100, 4, 4, "one"), (10, 0, 1, 1, 95, 4, 4, "one"), (11, 10, 2, 1, 95, 4, 9, "many"),
         (12, 0, 1, 1, 5, 4, 4, "one"), (13, 10, 2, 0, 0, 4, 4, "one"), (14, 99, 3, 1, 99, 4, 4, "one")],
        columns=["token", "parent", "depth", "kind", "clean", "pages", "times", "vector"])
    assert html.deduce(rows, 4) == (10, [13])


def test_template_survives_blank_and_odd_pages(spark):
    """An error page, blank pages and a second layout leave the template."""
    pages = [page(f"<div class=w><p>Read more on our site</p><p>Story {i} begins here and goes on for a while</p></div>")
             for i in range(6)]
    odd = [("https://a.example/e", None), ("https://a.example/f", " "), page("<h1>Not found</h1>"),
           page("<section><p>Another layout altogether</p></section>")]
    got = run(spark, pages + odd)
    assert [got[i] for i in range(6)] == [f"Story {i} begins here and goes on for a while" for i in range(6)]
    assert [got[i] for i in range(6, 10)] == ["", "", "Not found", "Another layout altogether"]


def test_copies_are_no_notices(spark):
    pages = [page("<p>The same page</p><p>under many addresses</p>") for _ in range(4)]
    assert set(run(spark, pages + [page("<p>Another one</p>"), page("<p>One more</p>")]).values()) == {
        "The same page\nunder many addresses", "Another one", "One more"}


def test_repeated_blocks_inside_the_article(spark):
    """Unnamed adverts and sign-up lines that change their neighbours go, also
    two in a row; an article published on most pages stays whole."""
    pages = [page(f"<article><h1>Head {i}</h1><p>Story {i} begins here and goes on for quite a while, as stories do</p>"
                  f"<p>Our letter, every day</p><div><p>Buy it now</p></div><p>Its end {i}</p></article>") for i in range(5)]
    got = run(spark, pages + [page("<p>Not found</p>")])
    assert got.pop(5) == "Not found"
    assert got == {i: f"Head {i}\nStory {i} begins here and goes on for quite a while, as stories do\nIts end {i}"
                   for i in range(5)}
    copies = [page(f"<article><h1>Same head</h1><p>The same long story on all of these pages</p><p>At {i}</p></article>",
                   "b.example") for i in range(4)]
    assert run(spark, copies) == {i: f"Same head\nThe same long story on all of these pages\nAt {i}" for i in range(4)}


LONG = "A long text that goes on and on, with many words, until nobody can doubt that it is the main text. " * 4


@pytest.mark.parametrize("body, text", [
    ("<div class='layout has-sidebar'><article><p>a</p></article><div class=sidebar>no</div></div>", "a"),
    ("<div id=search-results-article><main><p>a</p></main></div><p class=footer>no</p>", "a"),
    ("<article><header><h1>Head</h1></header><p>a</p></article><header>no</header>", "Head\na"),
    ("<article><div class=article-header><h1>Head</h1></div><p>a</p></article><div class=page-header>no</div>", "Head\na"),
    ("<div class=comments><article>no</article><article>no</article></div><p>The text itself, longer</p>",
     "The text itself, longer"),
    (f"<div class=social-policy><p>{LONG}</p></div><div class=footer>no</div>", LONG.strip())])
def test_names_are_hints(body, text):
    assert html.extract(page(body)[1], None, frozenset()) == text


def test_host_decides_on_names(spark):
    """Long comments of one page do not become its text; a short page of a
    host whose texts stand in a named element keeps its text."""
    story = [page(f"<div class=text><p>Story {i} begins here. {LONG}</p></div><div class=comments><p>Says {i} "
                  f"{LONG * 9 * (i == 0)}</p></div>") for i in range(5)]
    policy = [page(f"<div class=policy-notice><p>Rule {i} {LONG * (i > 0)}</p></div><p>Hint {i}</p>", "b.example")
              for i in range(5)]
    got = run(spark, story + policy)
    assert [got[i] for i in range(5)] == [f"Story {i} begins here. {LONG}".strip() for i in range(5)]
    assert got[5].startswith("Rule 0")


@pytest.mark.parametrize("body, text", [
    ("<p>super<wbr>cali word and <img src='a>b'> more</p>", "supercali word and more"),
    ("<p>a<br>b<hr>c<embed>d", "a\nb\ncd"),
    ("<p title=\"never closed>x <i class='y'>t", "x t")])
def test_void_elements_and_open_quotes(spark, body, text):
    assert html.extract(f"<article>{body}</article>", None, frozenset()) == text


def test_inline_void_elements_lose_no_text(spark):
    """What stands before one is no block of its own, so no notice either."""
    pages = [page(f"<article><h1>Head {i}</h1><p>extra<wbr>ordinary {i}</p><p>So <img src=x>it goes {i}</p></article>")
             for i in range(5)]
    assert run(spark, pages) == {i: f"Head {i}\nextraordinary {i}\nSo it goes {i}" for i in range(5)}


@pytest.mark.parametrize("odd", [
    "<a " * 300_000, "<a \"" * 250_000 + "'", "<a \"'>" * 150_000, "<a '\"> \" '>" * 80_000 + "'", "<" * 1_000_000,
    "<div>" * 40_000 + "</p>" * 40_000, "<div class=x>" * 20_000 + "<article></article>" * 20_000, "<p class='" * 100_000])
def test_odd_pages_take_linear_time(odd):
    begin = time.process_time()
    html.extract(odd, None, frozenset())
    assert time.process_time() - begin < 10


def explicit(pages):
    """(container, notices) of one host from whole occurrence vectors."""
    found = [t for t in map(html.tokens, pages) if t]
    n = len(found)
    vector = {t: tuple(f[t][0] if t in f else 0 for f in found) for t in {t for f in found for t in f}}
    pages_of = {t: sum(map(bool, v)) for t, v in vector.items()}
    valid = {t for t in vector if 2 * pages_of[t] >= n}
    some = {t: next(f[t] for f in found if t in f) for t in valid}
    total = {t: sum(f[t][3] for f in found if t in f) for t in valid}
    whole = {t: sum(f[t][4] for f in found if t in f) for t in valid}
    template, grown = {0}, True
    while grown:
        more = {t for t in valid - template if some[t][5] in (1, 2) and some[t][1] in template}
        template, grown = template | more, bool(more)
    once = [t for t in template if max(vector[t]) == 1 and total[t] >= 0.8 * whole[t]]
    container = max(once, key=lambda t: (some[t][2], total[t], -t), default=0)
    classes = {}
    for t in valid:
        if some[t][5] == 0:
            classes.setdefault(vector[t], []).append(t)
    notices = []
    for v, members in classes.items():
        if sum(map(bool, v)) >= 0.9 * n or 2 * sum(total[t] for t in members) <= max(whole[t] for t in members):
            notices += members
    return container, sorted(notices)


def test_deduction_equals_explicit_vectors(spark):
    """Random hosts of nested frames, optional parts, lists and notices."""
    rng = random.Random(5)
    sites = {}
    for site in range(6):
        words = lambda n: " ".join(rng.choice(LONG.split()) for _ in range(n))

        def frame(depth):
            tag = f"div class={rng.choice('pqrs')}{rng.randrange(3)}"
            inner = [frame(depth - 1) for _ in range(rng.randint(1, 3))] if depth else []
            return tag, rng.choice((1, 1, 1, 0.7, 0.3)), rng.choice(("", "", words(4))), rng.choice((0, 3, 30)), inner

        def draw(part):
            tag, chance, notice, length, inner = part
            if rng.random() > chance:
                return ""
            lines = "".join(f"<p>{words(rng.randint(1, length))}</p>" for _ in range(rng.randint(1, 3))) if length else ""
            return f"<{tag}>" + (f"<p>{notice}</p>" if notice else "") + "".join(map(draw, inner)) + lines + "</div>"

        shape = frame(3)
        sites[f"s{site}.example"] = [page(draw(shape))[1] for _ in range(rng.randint(4, 12))] + ["", " "]
    rows = [(i, f"http://{host}/{i}", text) for host, texts in sites.items() for i, text in enumerate(texts)]
    got = html.templates(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.host: (r.container, r.notices) for r in got} == {h: explicit(t) for h, t in sites.items()}
    assert sum(r.container != 0 for r in got) >= 3 and any(r.notices for r in got)
