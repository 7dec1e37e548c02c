"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, adjusted for links: text in links counts against a node the more
of it there is. The densities of a node's children are added up; the node of the largest sum is the heart of the article.
The least density on the path from it up to the body is the threshold, and below the body the node of the largest sum of
every subtree that reaches the threshold is kept; if the heart is in an article element (or main), that element and all
others of its kind that reach the threshold are kept whole.
"""

from __future__ import annotations

import bisect
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import tidy

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
# What counts without a closing ">": to the end of the page.
_UNCLOSED = re.compile(r"<(?:!--|!\[CDATA\[|[!?]).*\Z", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in
            ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp")}

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
                   "caption tbody tfoot thead tr ul".split())
_CELL = frozenset(("td", "th"))
# Elements that never belong to an article's text.
_NEVER = frozenset("script style noscript template iframe object embed applet svg math canvas audio video map button select input "
                   "textarea datalist output progress meter dialog head title frameset noframes noembed xmp".split())
# Elements that rarely do: left out unless they hold an article or main element or the densest subtree.
_RARELY = frozenset("form fieldset nav aside footer menu".split())
# In these a label is part of a sentence, not of a form.
_SENTENCES = frozenset("p li dd blockquote h1 h2 h3 h4 h5 h6".split())
# What the densities under a name or element of what surrounds an article count when the densest subtree is looked for.
_DOUBT = 0.25
# Whole names of a class, id or role ("_" counts as "-"). The first are names of what surrounds an article wherever they are, the
# second only outside an article or main element and the densest subtree, the third are threads of comments.
_AROUND = frozenset("ad ads advert adverts advertisement advertising sidebar primary-sidebar secondary-sidebar nav navbar navigation "
                    "site-nav site-navigation main-nav main-navigation breadcrumb breadcrumbs topbar footer footnav site-footer page-footer "
                    "masthead pager pagination cookie-notice cookie-banner cookie-consent cookie-bar gdpr popup lightbox share-buttons "
                    "social-share social-links related-posts related-articles newsletter-signup hidden".split())
_OUTSIDE = frozenset("side rail menu banner sponsor sponsored promo promotion toolbar notice notices alert overlay modal dialog newsletter "
                     "subscribe subscription signup login register search social share sharing related recommended recommendations trending "
                     "popular widget widgets cookie cookies consent form respond reply replies header site-header page-header main-header "
                     "global-header top-header".split())
_THREADS = frozenset("comment comments commentlist comment-list comments-area comment-body disqus disqus-thread".split())
_ROLES = {**dict.fromkeys("navigation complementary contentinfo menu menubar search dialog alertdialog".split(), 2),
          **dict.fromkeys("banner form alert".split(), 1)}
# Elements whose ids are names of layout; elsewhere, and in sections, they are made from headings.
_LAYOUT = frozenset("div ul ol dl table tr td center".split())
_SECTIONS = frozenset("section chapter level1 level2 level3 level4 level5 level6".split())
_CLOSED_BY = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
              "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",)),
              "tbody": frozenset(("tbody", "thead", "tfoot", "tr", "td", "th")), "tfoot": frozenset(("tbody", "thead", "tr", "td", "th"))}
_SCOPES = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)),
           "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")), "option": frozenset(("select",)),
           "tbody": frozenset(("table",)), "tfoot": frozenset(("table",))}
_BETWEEN_P = frozenset(("button", "table", "td", "th", "caption", "object", "template"))


class Page:
    """The tree as parallel lists in document order: ``tag``, ``parent``, ``barred`` (not the article's), ``items``: (node, text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.barred = ["#root"], [-1], [False]
        self.items: list[tuple[int, str]] = []
        self._inside = [False]  # within an article or main element
        self._named = {}  # what names say of nodes
        self._build(source)
        if self._named:
            self._bar_named()

    def _open(self, tag: str, attributes: str, stack: list[int]) -> None:
        top = stack[-1]
        inside = self._inside[top] or tag in ("article", "main")
        bad = self.barred[top] or tag in _NEVER or (tag == "header" and not self._inside[top]) or (
            tag == "label" and self.tag[top] not in _SENTENCES)
        if not bad and attributes and tag not in ("html", "body", "main"):
            level = _named(tag, attributes)
            if tag == "article":  # only whether it is somebody's comment; its text is chosen by density
                level = level if level == 3 else 0
            bad = level == 4
            if 0 < level < 4:
                self._named[len(self.tag)] = level
        if not bad and tag in _RARELY and not (tag == "footer" and self.tag[top] == "blockquote"):
            self._named[len(self.tag)] = max(2, self._named.get(len(self.tag), 0))
        self.tag.append(tag)
        self.parent.append(top)
        self.barred.append(bad)
        self._inside.append(inside)

    def _bar_named(self) -> None:
        """Bar named nodes and rare elements with what they hold, unless they hold an article or main element or the densest
        subtree, for which what they hold counts ``_DOUBT``."""
        n, visible = len(self.tag), self.barred
        spared: set[int] = set()

        def spare(node: int) -> None:
            while node > 0 and node not in spared:
                spared.add(node)
                node = self.parent[node]

        for i in range(n):
            if self.tag[i] in ("article", "main") and not visible[i] and self._named.get(i) != 3:
                spare(i)

        def barred(least) -> list[bool]:
            out = list(visible)
            for i in range(1, n):
                out[i] = out[i] or out[self.parent[i]] or i not in spared and self._named.get(i, 0) >= least(i)
            return out

        self.barred = barred(lambda i: 3)
        doubt = [1.0] * n
        for i in range(1, n):
            doubted = i not in spared and self._named.get(i) == 2
            doubt[i] = min(doubt[self.parent[i]], _DOUBT if doubted else 1.0)
        heart = _heart(self, densities(self, doubt)[1])
        spare(heart)
        dense = [False] * n
        if self.tag[heart] not in ("#root", "html", "body"):
            dense[heart] = True
            for i in range(heart + 1, n):
                dense[i] = dense[self.parent[i]]
        self.barred = barred(lambda i: 2 if self._inside[i] or dense[i] else 1)

    def _build(self, source: str) -> None:
        stack, at, find, last = _Stack(self.tag), 0, _TOKEN.search, source.rfind(">")
        while True:
            m = find(source, at) if at <= last else _UNCLOSED.search(source, at)
            if m is None:
                break
            if m.start() > at:
                self.items.append((stack.nodes[-1], source[at:m.start()]))
            at = m.end()
            if m.group().startswith("<![CDATA["):
                self.items.append((stack.nodes[-1], html.escape(m.group()[9:].removesuffix("]]>"))))
            if m.group().startswith("<!") or m.group().startswith("<?"):
                continue
            closing, name, attributes = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
            name = name.lower()
            if closing:
                stack.close(name)
                continue
            stack.make_way(name)
            self._open(name, attributes, stack.nodes)
            node = len(self.tag) - 1
            self.items.append((node, ""))
            if name in _VOID or attributes.endswith("/") and name not in _BLOCK and name not in _RAW_END:
                continue
            if name in _RAW_END:
                end = _RAW_END[name].search(source, at)
                at = len(source) if end is None else end.end()
                continue
            if name == "plaintext":
                self.items.append((node, html.escape(source[at:])))
                at = len(source)
                break
            stack.push(node)
        if at < len(source):
            self.items.append((stack.nodes[-1], source[at:]))


class _Stack:
    """The open elements. Where each name is open, the innermost block and the paragraph in reach are kept at hand, so that no
    step looks through the stack."""

    def __init__(self, tags: list[str]):
        self.tags, self.nodes = tags, [0]
        self.block, self.paragraph = [0], [0]  # per depth: innermost block at or above it, open paragraph in reach; 0 is none
        self.places: dict[str, list[int]] = {}

    def push(self, node: int) -> None:
        name, depth = self.tags[node], len(self.nodes)
        self.nodes.append(node)
        self.block.append(depth if name in _BLOCK or name in _CELL else self.block[-1])
        self.paragraph.append(depth if name == "p" else 0 if name in _BETWEEN_P else self.paragraph[-1])
        self.places.setdefault(name, []).append(depth)

    def _cut(self, depth: int) -> None:
        for node in self.nodes[depth:]:
            self.places[self.tags[node]].pop()
        del self.nodes[depth:], self.block[depth:], self.paragraph[depth:]

    def close(self, name: str) -> None:
        """An end tag closes the innermost element of its name; an inline one does not close a block on the way."""
        places = self.places.get(name)
        if places and (name in _BLOCK or name in _CELL or places[-1] > self.block[-1]):
            self._cut(places[-1])

    def make_way(self, name: str) -> None:
        """Close what cannot hold a new element: a paragraph before a block, the element before in a list or table."""
        if name in _BLOCK and self.paragraph[-1]:
            self._cut(self.paragraph[-1])
        if name in _CLOSED_BY:
            scope = max((self.places[s][-1] for s in _SCOPES[name] if self.places.get(s)), default=0)
            found = []
            for closed in _CLOSED_BY[name]:
                places = self.places.get(closed, [])
                k = bisect.bisect_right(places, scope)
                found += places[k:k + 1]
            if found:
                self._cut(min(found))


def _named(tag: str, attributes: str) -> int:
    """What class, id, role and visibility say: 4 not to be seen, 3 comments, 2 not an article's, 1 not one's outside it, 0 nothing."""
    level, names, own_id = 0, [], []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "class":
            names += value.replace("_", "-").split()
        elif name == "id":
            own_id = value.replace("_", "-").split()
        elif name == "role":
            level = max([level, *(_ROLES.get(x, 0) for x in value.split())])
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return 4
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 4
    if tag in _LAYOUT and _SECTIONS.isdisjoint(names):
        names += own_id
    for k, known in ((3, _THREADS), (2, _AROUND), (1, _OUTSIDE)):
        if not known.isdisjoint(names):
            return max(k, level)
    return level


def _heart(page: Page, total: list[float]) -> int:
    """The node of the largest sum."""
    return max((i for i in range(len(page.tag)) if not page.barred[i]), key=lambda i: (total[i], -i))


def densities(page: Page, doubt: list[float] | None = None) -> tuple[list[float], list[float]]:
    """Composite density of every node, times its ``doubt``, and the sum of its children's densities."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    for node, text in page.items:
        if text and not page.barred[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if in_link[node]:
                links[node] += size
    for i in range(n - 1, 0, -1):  # parents come before their children
        up = page.parent[i]
        chars[up] += chars[i]
        links[up] += links[i]
        if not page.barred[i]:
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    share = links[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c, lc, t, lt = chars[i], links[i], max(tags[i], 1), max(link_tags[i], 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            density[i] = c / t * max(0.0, math.log(c / max(lc, 1) * t / lt + 1) / max(base, 1e-9))
            if doubt:
                density[i] *= doubt[i]
        if i:
            total[page.parent[i]] += density[i]
    return density, total


def chosen_nodes(page: Page) -> set[int]:
    """The roots of the subtrees that make the article."""
    density, total = densities(page)
    n = len(page.tag)
    heart = _heart(page, total)
    path, up = [], heart
    while up > 0 and page.tag[up] not in ("body", "html"):
        path.append(density[up])
        up = page.parent[up]
    if not path:
        return {heart}
    threshold = min(path)
    for kind in ("article", "main"):
        above, found = heart, None
        while above > 0:
            if page.tag[above] == kind:
                found = above
            above = page.parent[above]
        if found is not None:  # with it, all others of the kind that reach the threshold
            within, picked = [False] * n, {found}
            for i in range(1, n):
                outer = within[page.parent[i]]
                within[i] = outer or page.tag[i] == kind
                if page.tag[i] == kind and not outer and not page.barred[i] and density[i] >= threshold and density[i] > 0:
                    picked.add(i)
            return picked
    # The node of the largest sum at or below every node.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        up_ = page.parent[i]
        if not page.barred[i] and (total[best[i]], -best[i]) > (total[best[up_]], -best[up_]):
            best[up_] = best[i]
    picked: set[int] = set()
    skip = [False] * n
    for i in range(up + 1, n):
        above = page.parent[i]
        skip[i] = skip[above] or above in picked
        if not skip[i] and not page.barred[i] and density[i] >= threshold and page.tag[i] not in ("body", "html"):
            # A node without denser parts of its own is kept itself.
            node = best[i] if total[best[i]] > density[i] else i
            picked.add(node)
            if node != i:
                skip[i] = True
    return picked


def main_text(source: str | None) -> str:
    """Blocks of the article in page order, one per line."""
    if not source:
        return ""
    page = Page(source)
    roots = chosen_nodes(page)
    n = len(page.tag)
    taken, block = [False] * n, [0] * n
    taken[0] = 0 in roots
    for i in range(1, n):
        taken[i] = taken[page.parent[i]] or i in roots
        block[i] = i if page.tag[i] in _BLOCK else block[page.parent[i]]
    lines, current, parts = [], None, []
    for node, text in page.items:
        if page.barred[node]:
            # What is left out still ends a line if it is a block.
            if page.tag[node] in _BLOCK and parts:
                lines.append("".join(parts))
                parts, current = [], None
            continue
        if block[node] != current or not text and page.tag[node] in _BLOCK:
            if parts:
                lines.append("".join(parts))
            parts, current = [], block[node]
        if taken[node]:
            parts.append(text or (" " if page.tag[node] == "br" or page.tag[node] in _CELL else ""))
    if parts:
        lines.append("".join(parts))
    lines = [" ".join(html.unescape(x).split()) for x in lines]
    return "\n".join(x for x in lines if x)


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages`` (``page_id``, ``url``, ``html``; others are ignored).

    NULL counts as the empty page, whose text is empty; NULL ids and urls pass through; repeated rows get equal rows; an
    empty table gives none. Broken markup is read the way browsers recover from it; nothing is cut.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(tidy(run), "page_id long, url string, text string, n_chars long")
