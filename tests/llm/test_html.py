from __future__ import annotations

import html
import math
import random
import re
import time

import pytest

from sparkwh.llm.html_text import Page, chosen_nodes, densities, main_text, page_texts

from .helpers import SF, table

CASES = {
    "": "", "plain &amp; text": "plain & text", "<p>a<p>b<br>c": "a\nb c", "<div hidden>q</div><script>if(a<b){}</script>t<b>u": "tu",
    "<article><h1>T</h1><p>x &lt; y&nbsp;z &#65;&#x42; &copy 1</p><!-- no --><aside>s</aside></article>": "T\nx < y z AB © 1",
    "<article><header><h1>T</h1></header><p>one</p><form>q<input></form><section class=\"comments\"><p>c</p></section></article>": "T\none",
    "<header><p>top</p></header><main><p>the text</p><ul><li>i<li>j</ul></main><footer>f</footer>": "the text\ni\nj",
    "<article><table><tr><td>a<td>b<tr><td>c</table><p>1 < 2 and <3</article>": "a b\nc\n1 < 2 and <3",
    "<article><p>a<div class=ad>buy</div>b</article>": "a\nb", "<ARTICLE><P TITLE='a > b'>x</P></ARTICLE>": "x",
}


@pytest.mark.parametrize("source", CASES)
def test_small_pages(source):
    assert main_text(source) == CASES[source]


def sentence(rng) -> str:
    return " ".join(f"word{rng.randrange(999)}" for _ in range(rng.randrange(8, 40))) + "."


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div>{}</div></main>", "<div id=\"content\">{}</div>", "<div><div class=\"post\">{}</div></div>"])
def test_article_among_the_usual_surroundings(wrap):
    rng = random.Random(len(wrap))
    for _ in range(20):
        blocks = [sentence(rng) for _ in range(rng.randrange(3, 12))]
        body = "".join(f"<p>{b}</p>" for b in blocks)
        links = "".join(f"<li><a href='/{k}'>{k} link</a></li>" for k in range(12))
        page = (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul>{links}</ul></nav><div class='site-header'><a href='/'>home</a></div>"
                f"<div class='cookie-notice'>We use cookies. {sentence(rng)}</div>{wrap.format(body)}<div class='sidebar'><ul>{links}</ul></div>"
                f"<div id='comments'><p>{sentence(rng)}</p></div><form>Name <input></form><footer>{sentence(rng)}</footer></body></html>")
        assert main_text(page) == "\n".join(blocks)


def test_whole_table(spark):
    pages = table(spark, "pages", SF)
    got = {r["page_id"]: r for r in page_texts(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_edge_rows(spark):
    deep = "<div>" * 5_000 + "deep text" + "</div>" * 5_000
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>x"), (3, "u", "<" * 2_000 + "a"), (4, "u", deep), (5, "u", "<p>w " + "word " * 200_000),
            (6, "u", "<p>same"), (6, "u", "<p>same"), (7, "u", "<!-- never closed <p>x"), (8, "u", "<script>never closed")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = page_texts(frame).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[7] == by[8] == "" and by[None] == "x" and by[4] == "deep text" and by[6] == "same"
    assert by[5].count("word") == 200_000
    assert page_texts(frame.limit(0)).count() == 0


LINES = ["The first paragraph of the text, long enough to count.", "The second one is about as long as the first one was.",
         "And the third says that this is where the text ends."]


@pytest.mark.parametrize("wrapper", ["container no-sidebar", "has-sidebar", "layout sidebar", "search", "form side"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_of_wrappers_do_not_bar_the_article(wrapper, tag):
    body = "".join(f"<p>{x}</p>" for x in LINES)
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(9))
    page = f"<body><ul class='menu'>{links}</ul><div class='{wrapper}'><{tag}>{body}</{tag}></div><div class='sidebar'>{links}</div></body>"
    assert main_text(page) == "\n".join(LINES)


@pytest.mark.parametrize("inner", [
    '<section id="related-work">{}</section>', '<section id="search">{}</section>', '<div class="section" id="comments">{}</div>',
    '<div class="side-by-side">{}</div>', '<div class="search form">{}</div>', '<div class="notice">{}</div>', '<div role="alert">{}</div>'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_names_inside_the_article_do_not_bar_its_parts(inner, tag):
    one, two, three = (f"<p>{x}</p>" for x in LINES)
    page = f"<body><{tag}><h2 id='search'>Search</h2>{one}{inner.format(two)}<h3 id='popular'>Popular</h3>{three}</{tag}></body>"
    assert main_text(page) == "\n".join(["Search", LINES[0], LINES[1], "Popular", LINES[2]])


def test_articles_that_reach_the_threshold_are_all_kept():
    parts = [f"<article><p>{LINES[k]}</p><p>{LINES[k]} Again.</p></article>" for k in range(3)]
    page = f"<body><div>{''.join(parts)}</div><div id='comments'><article class='comment'><p>{LINES[0] * 9}</p></article></div></body>"
    assert main_text(page).split("\n") == [y for x in LINES for y in (x, x + " Again.")]
    longer = "".join(f"<p>{x}</p>" for x in LINES * 3)
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(9))
    assert main_text(f"<body><div><ul>{links}</ul><article>{longer}</article>{parts[1]}</div></body>").split("\n") == [
        *LINES * 3, LINES[1], LINES[1] + " Again."]


LINKS = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(9))
BODY = "".join(f"<p>{x}</p>" for x in LINES)


def test_elements_are_no_verdicts():
    form = f"<body><form id='page'><ul class='menu'>{LINKS}</ul><div>{BODY}</div><div class='sidebar'>{LINKS}</div></form></body>"
    assert main_text(form) == "\n".join(LINES)
    assert main_text(f"<body><aside><ul>{LINKS}</ul></aside><div>{BODY}</div><form>Your name <label>name</label><input></form>"
                     f"<footer><p>{LINES[0] * 3}</p></footer></body>") == "\n".join(LINES)
    quoted = f"<article><p>Press <label>Enter</label> and now</p><blockquote><p>said</p><footer>by me</footer></blockquote>{BODY}<footer>f</footer></article>"
    assert main_text(quoted) == "\n".join(["Press Enter and now", "said", "by me", *LINES])


def brute_densities(page: Page) -> tuple[list[float], list[float]]:
    """Every node's figures by walking over all nodes and texts below it."""
    n = len(page.tag)

    def below(i):
        found, k = set(), i
        for k in range(n):
            up = k
            while up not in (-1, i):
                up = page.parent[up]
            if up == i:
                found.add(k)
        return found

    def linked(i):
        while i >= 0:
            if page.tag[i] == "a":
                return True
            i = page.parent[i]
        return False

    def chars(nodes, only_links=False):
        return sum(len("".join(t.split())) for k, t in page.items if k in nodes and not page.barred[k] and (linked(k) or not only_links))
    whole, density = below(0), []
    for i in range(n):
        nodes = below(i)
        c, lc = chars(nodes), chars(nodes, True)
        inner = [k for k in nodes if k != i and not page.barred[k]]
        t, lt = max(len(inner), 1), max(sum(page.tag[k] == "a" for k in inner), 1)
        share = chars(whole, True) / max(chars(whole), 1)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        density.append(c / t * max(0.0, math.log(c / max(lc, 1) * t / lt + 1) / max(base, 1e-9)) if c else 0.0)
    return density, [sum(density[k] for k in range(n) if page.parent[k] == i) for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_densities_of_pages_without_article_elements(seed):
    rng = random.Random(seed)

    def part(depth):
        if depth == 0 or rng.random() < 0.2:
            return sentence(rng) if rng.random() < 0.7 else f"<a href='/'>{sentence(rng)}</a>"
        tag = rng.choice(["div", "p", "ul", "span", "b", "td", "nav", "form", "label"])
        return f"<{tag}>" + "".join(part(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{tag}>"
    page = Page("<body>" + "".join(part(4) for _ in range(4)) + "</body>")
    got, want = densities(page), brute_densities(page)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
    heart = max((i for i in range(len(page.tag)) if not page.barred[i]), key=lambda i: (round(want[1][i], 6), -i))
    inside, up = set(), heart
    while up >= 0:
        inside.add(up)
        up = page.parent[up]
    roots = chosen_nodes(page)
    assert heart in roots or inside & roots  # the densest subtree is in what is chosen


@pytest.mark.parametrize("source", ["<a " * 100_000, '<a "' * 100_000, "<b>" * 60_000 + "x", "<div>" * 30_000 + "<li>x</li>" * 30_000,
                                    "<p><table><tr><td>" + "<div>" * 40_000, "<i>" * 30_000 + "</b>" * 30_000, "<!--" * 50_000,
                                    "<p>" + "<b>" * 20_000 + "<div>x</div>" * 20_000, "<![CDATA[" * 30_000])
def test_time_does_not_grow_with_the_square(source):
    begin = time.perf_counter()
    main_text(source)
    assert time.perf_counter() - begin < 10
