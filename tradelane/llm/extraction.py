"""Main text of web pages by composite text density.

Every DOM node gets its characters per tag, adjusted by its links; the node whose children have
the largest sum of densities holds the article. If its parent has further children that are as dense as the
path to the body, such as the sections of a split article, the parent is the article. It is taken
whole; the least density on its path to the body is the threshold by which the parts beside it, such
as a title or a further article, belong or not.

Before that, parts go by what they say they are. Hidden elements and reader comments go first and do not
compete for the article, then elements whose tag, role or name tells a part of the site (menus, footers,
sidebars, notices, adverts, forms). An element around an article element stays, and so does one around the
densest node if nothing outside of all such parts reads like prose: a page in a wrapper. Names that may as well
belong to an article (share, related, notice) are weaker: such an element goes only if it stands outside the
article elements of its page, is linked text for the most part, or is much less dense than the article.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe object svg title textarea xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
_PRUNED = frozenset(
    "nav footer header aside form menu button select option label input dialog head audio video canvas "
    "map datalist fieldset".split())
_PRUNED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer "
    "masthead menu modal nav navbar navigation newsletter pagination popup promo promotion sidebar sponsor sponsored "
    "subscribe subscription toolbar".split())
_HINT_NAMES = frozenset("header notice notices related share sharing social widget".split())
_COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())  # they read like articles
_COMMENT_ARTICLES = frozenset("comment comment-body comment-item reply".split())  # classes of article elements
# words beside a name that tell something about a whole page or post instead
_BEFORE, _AFTER = frozenset("with has no without".split()), frozenset("open closed off on enabled disabled".split())
_PRUNED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NEVER_PRUNED = frozenset("html body article main".split())
_SITE_PARTS = frozenset("nav footer header aside menu dialog head".split())  # never around a whole page
_HINT, _PART, _COMMENTS, _HIDDEN = 1, 2, 3, 4  # what tag and attributes say of an element
PROSE = 60  # characters outside links with which a block of text reads like prose
# a start tag that ends an open element of these kinds
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
# ... but no further out than to these
_SCOPE = frozenset("html body table td th ul ol dl div article section main button".split())


def _named(value: str) -> int:
    """What the words of a class or id say."""
    mark = 0
    for token in value.split():
        words = [w.lower() for w in _WORD.findall(token)]
        for i, word in enumerate(words):
            if i and words[i - 1] in _BEFORE or i + 1 < len(words) and words[i + 1] in _AFTER:
                continue
            mark = max(mark, _COMMENTS if word in _COMMENT_NAMES else _PART if word in _PRUNED_NAMES
                       else _HINT if word in _HINT_NAMES else 0)
    return mark


def _mark(tag: str, attrs: str) -> int:
    mark = _PART if tag in _PRUNED else 0
    if "=" not in attrs and "hidden" not in attrs:
        return mark
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if tag not in _NEVER_PRUNED:
                mark = max(mark, _named(value))
            elif tag == "article" and not _COMMENT_ARTICLES.isdisjoint(value.lower().split()):
                mark = _COMMENTS
        elif tag in _NEVER_PRUNED:
            continue
        elif name == "role" and value.strip().lower() in _PRUNED_ROLES:
            mark = max(mark, _PART)
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            mark = _HIDDEN
    return mark


class _Page:
    """Nodes in page order (a parent before its children) and the text between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.mark, self.gone = ["#root"], [-1], [0], [False]
        self.texts: list[tuple[int, str]] = []  # node, text; an empty text marks a break
        # open elements, and by name the depths at which they stand, so that no tag walks the whole stack
        self.open_at: dict[str, list[int]] = {}
        stack, at = [0], 0
        for m in _TOKEN.finditer(source):
            if m.start() < at:
                continue  # inside a raw element
            self._text(stack[-1], source[at:m.start()])
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if m["end"]:
                if self.open_at.get(tag):
                    self._pop(stack, self.open_at[tag][-1])
            else:
                self._close(stack, tag)
                node = self._open(stack[-1], tag, _mark(tag, m["attrs"]))
                if tag in _RAW:
                    self.gone[node] = True
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.I).search(source, at)
                    at = end.end()
                elif tag not in _VOID and (tag in _BLOCK or not m["attrs"].endswith("/>")):
                    self.open_at.setdefault(tag, []).append(len(stack))
                    stack.append(node)  # "/>" means nothing on blocks
            if tag in _BLOCK:
                self.texts.append((stack[-1], ""))
            elif tag == "br":
                self.texts.append((stack[-1], " "))
        self._text(stack[-1], source[at:])

    def _open(self, parent: int, tag: str, mark: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.mark.append(mark)
        self.gone.append(False)
        return len(self.tag) - 1

    def _text(self, node: int, text: str) -> None:
        if text:
            self.texts.append((node, html.unescape(text)))

    def _pop(self, stack: list[int], depth: int) -> None:
        """Close all elements from this depth on."""
        while len(stack) > depth:
            self.open_at[self.tag[stack.pop()]].pop()

    def _deepest(self, tags: frozenset | set) -> int:
        return max((self.open_at[t][-1] for t in tags if self.open_at.get(t)), default=0)

    def _close(self, stack: list[int], tag: str) -> None:
        ends = _ENDS.get(tag) or ({"p"} if tag in _BLOCK else None)
        while ends and (depth := self._deepest(ends)) and depth > self._deepest(_SCOPE - ends):
            self._pop(stack, depth)
            if tag not in ("tr", "td", "th"):
                return


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body: float) -> float:
    if not chars:
        return 0.0
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + body * chars + math.e)
    ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    return chars / max(tags, 1) * math.log(max(ratio, 1.0)) / max(math.log(base), 0.5)


class _Weights:
    """Characters, tags and densities of the nodes that are not gone, and the densest one."""

    def __init__(self, page: _Page):
        n, parent, tag = len(page.tag), page.parent, page.tag
        chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
        for node, text in page.texts:
            chars[node] += len(text.strip())
        for i in range(n - 1, 0, -1):
            p = parent[i]
            if page.gone[i]:
                continue
            if tag[i] == "a":
                link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
        body = next((i for i in range(n) if tag[i] == "body"), 0)
        if not chars[body]:
            body = 0
        share = link_chars[body] / max(chars[body], 1)
        density = [0.0 if page.gone[i] else _density(chars[i], tags[i], link_chars[i], link_tags[i], share)
                   for i in range(n)]
        sums = [0.0] * n
        for i in range(1, n):
            sums[parent[i]] += density[i]
        inside = [False] * n
        inside[body] = True
        for i in range(body + 1, n):
            inside[i] = inside[parent[i]] and not page.gone[i]
        self.chars, self.link_chars, self.density, self.body, self.inside = chars, link_chars, density, body, inside
        self.best = max((i for i in range(n) if inside[i]), key=lambda i: (sums[i], density[i], -i))


def _go(page: _Page, own: list[bool]) -> None:
    """These nodes and all below them are gone."""
    page.gone = own
    for i in range(1, len(own)):
        own[i] = own[i] or own[page.parent[i]]


def _holders(page: _Page, nodes: list[int]) -> list[bool]:
    holds = [False] * len(page.tag)
    for i in nodes:
        while i >= 0 and not holds[i]:
            holds[i], i = True, page.parent[i]
    return holds


def _any_text(page: _Page) -> bool:
    return any(text.strip() and not page.gone[node] for node, text in page.texts)


def _linked(page: _Page) -> list[bool]:
    out = [False] * len(page.tag)
    for i in range(1, len(out)):
        out[i] = page.tag[i] == "a" or out[page.parent[i]]
    return out


def _prose(page: _Page, linked: list[bool]) -> bool:
    """Whether any block that is left has PROSE characters outside links."""
    now = 0
    for node, text in [*page.texts, (0, "")]:
        if not text:
            if now >= PROSE:
                return True
            now = 0
        elif not page.gone[node] and not linked[node]:
            now += len(text.strip())
    return False


def _prune(page: _Page) -> None:
    n, nodes, raw, linked = len(page.tag), range(len(page.tag)), page.gone, _linked(page)
    _go(page, [raw[i] or page.mark[i] == _HIDDEN for i in nodes])
    if not _any_text(page):
        page.gone = raw
    shown, w = page.gone, _Weights(page)

    commented = [False] * n
    for i in nodes[1:]:
        commented[i] = page.mark[i] == _COMMENTS or commented[page.parent[i]]
    articles = [i for i in nodes if page.tag[i] in ("article", "main") and page.mark[i] != _COMMENTS
                and w.link_chars[i] * 2 < w.chars[i]]
    articles = [i for i in articles if not commented[i]] or articles
    holds = _holders(page, articles)
    _go(page, [shown[i] or page.mark[i] == _COMMENTS and not holds[i] for i in nodes])
    if not _any_text(page):
        page.gone = shown
    visible = page.gone

    telling = [page.mark[i] == _PART and not holds[i] and not visible[i] for i in nodes]
    while True:
        _go(page, [visible[i] or telling[i] for i in nodes])
        if _prose(page, linked) or any(page.tag[node] == "h1" and text.strip() and not page.gone[node]
                                       for node, text in page.texts):
            break
        pruned, page.gone = page.gone, visible
        at, around = _Weights(page).best, []
        while at >= 0:
            if telling[at] and page.tag[at] not in _SITE_PARTS:
                around.append(at)
            at = page.parent[at]
        if not around:
            page.gone = pruned
            break
        for i in around:
            telling[i] = False
    if not _any_text(page):
        page.gone = visible
    visible, w = page.gone, _Weights(page)

    own, within = set(articles), [False] * n
    for i in nodes[1:]:
        within[i] = i in own or within[page.parent[i]]
    holds = _holders(page, [*articles, w.best])
    _go(page, [visible[i] or page.mark[i] == _HINT and not holds[i] and (
        own and not within[i] or w.link_chars[i] * 3 > w.chars[i] or w.density[i] * 2 < w.density[w.best])
        for i in nodes])
    if not _any_text(page):
        page.gone = visible


def _article(page: _Page) -> list[bool]:
    """Which nodes belong to the article."""
    n, parent, tag, w = len(page.tag), page.parent, page.tag, _Weights(page)
    path = [w.best]
    while path[-1] != w.body:
        path.append(parent[path[-1]])
    threshold = min(w.density[i] for i in path)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        if not page.gone[i]:
            children[parent[i]].append(i)

    def dense(i: int) -> bool:
        return w.density[i] >= threshold and w.link_chars[i] * 2 < w.chars[i]

    top = next((i for i in path if tag[i] in ("article", "main")), None)
    if top is None:
        top = w.best
        # the sections of a split article are the dense children of one element, which is taken as a whole
        while top != w.body and (up := parent[top]) != w.body and sum(
                i == top or dense(i) and tag[i] not in _HEADINGS for i in children[up]) > 1:
            top = up
    path = path[path.index(top):]
    on_path, loose = set(path), [0] * n
    for node, text in page.texts:
        loose[node] += len(text.strip())
    beside = set()  # between the first and the last dense part beside the path nothing is left out but link lists
    for up in path[1:]:
        at = [k for k, i in enumerate(children[up]) if i in on_path or dense(i) and tag[i] not in _HEADINGS]
        beside.update(i for i in children[up][at[0]:at[-1] + 1] if w.link_chars[i] * 2 < w.chars[i] or tag[i] == "p")
    taken, whole = [False] * n, [False] * n
    for i in range(n):
        if page.gone[i] or not w.inside[i]:
            continue
        if i == top or i and whole[parent[i]]:
            whole[i] = True
        elif i in on_path:  # its loose text, without its other children
            taken[i] = loose[i] >= threshold > 0
        elif parent[i] in on_path:
            whole[i] = i in beside or tag[i] in _HEADINGS and w.link_chars[i] * 2 < w.chars[i]
    return [a or b for a, b in zip(taken, whole, strict=True)]


def main_text(source: str) -> str:
    r"""Blocks of the article in page order, white space made one space, joined by two \n."""
    page = _Page(source)
    _prune(page)
    taken, blocks, now = _article(page), [], []
    for node, text in [*page.texts, (0, "")]:
        if not text:
            blocks.append(" ".join("".join(now).split()))
            now = []
        elif taken[node]:
            now.append(text)
    return "\n\n".join(b for b in blocks if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, 256):
            rows = b.slice(a, 256)
            found = [main_text(h) for h in rows.column("html").to_pylist()]
            yield pa.record_batch([rows.column("page_id"), rows.column("url"), pa.array(found, pa.string()),
                                   pa.array([len(t) for t in found], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (empty if there is none), n_chars.

    Null and empty html has no text; long and deeply nested pages are read whole, in time that grows with
    their length. Of nodes that are equally dense the first one counts. Rows that repeat give rows that
    repeat; other columns are not looked at; an empty table gives no rows.
    """
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce("html", F.lit("")).alias("html"))
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
