"""Main text of web pages by composite text density over the DOM."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript template xmp svg math".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body div dl html main ol section table ul td th blockquote form".split())
# Parts of a page that are no article, by element, role and words of class and id.
APART = frozenset("nav footer aside form button select dialog menu object audio video canvas head".split())
# Some of them can hold the page itself, as one form around everything does.
HOLDERS = frozenset("form dialog menu object".split())
CONTROLS = frozenset("button select audio video canvas head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset("""ad ads adv adsense alert banner consent disqus footer gdpr masthead menu menus modal nav navbar
navigation notice notices notification overlay pagination pager paywall popup promo promoted promotion recommended
related reply replies responses search share sharing sidenav signup skip social toolbar topbar widget widgets""".split())
STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor", "subscri")
KEEPS = frozenset("has no with without".split())       # as in "with-sidebar": the name is about another part
TITLES = frozenset("article content entry post story".split())  # their headers hold a title

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named_apart(value: str, in_article: bool) -> bool:
    """Whether a class or id names a part that is no article."""
    words = {w.lower() for w in _WORDS.findall(value)}
    if not KEEPS.isdisjoint(words):
        return False
    if "header" in words and not in_article and TITLES.isdisjoint(words):
        return True
    return not NAMES.isdisjoint(words) or any(w.startswith(STARTS) and w != "commentary" for w in words)


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is a part of the page that is no article, whatever it holds."""
    if (name in APART and name not in HOLDERS) or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for mark, *values in _MARKS.findall(attributes):
        mark, value = mark.lower(), "".join(values)
        if mark == "hidden" or (mark == "aria-hidden" and value == "true"):
            return True
        if mark == "role" and value.lower() in ROLES and not (name in HOLDERS and value.lower() == name):
            return True
        if mark in ("class", "id") and name not in ("article", "main") and _named_apart(value, in_article):
            return True
    return False


class Page:
    """The DOM of one page as flat lists; a child always comes after its parent.

    `by_name` minds classes, ids and roles, `by_element` the elements that are set
    apart; without it only controls are.
    """

    def __init__(self, html: str, by_name: bool = True, by_element: bool = True) -> None:
        self._by_name, self._by_element = by_name, by_element
        self.names, self.parents, self.apart = ["#"], [-1], [False]
        self.blocks: list[list[tuple[int, str]]] = []
        self._stack, self._open, self._block = [0], Counter({"#": 1}), []
        self._parse(html)
        self._end_block()
        self._settle()

    def _end_block(self) -> None:
        if self._block:
            self.blocks.append(self._block)
            self._block = []

    def _text(self, text: str) -> None:
        if text and not self.apart[self._stack[-1]]:
            self._block.append((self._stack[-1], unescape(text) if "&" in text else text))

    def _settle(self) -> None:
        """Set holders apart, unless one holds the only article or most of the text."""
        n = len(self.names)
        if not self._by_element or HOLDERS.isdisjoint(self.names):
            return
        chars, articles = [0] * n, [name in ("article", "main") and not part for name, part in zip(self.names, self.apart)]
        for block in self.blocks:
            for node, text in block:
                chars[node] += len(" ".join(text.split()))
        for i in range(n - 1, 0, -1):
            chars[self.parents[i]] += chars[i]
            articles[i] = articles[i] and chars[i] > 0
        held, free = [False] * n, False
        for i in range(1, n):
            held[i] = held[self.parents[i]] or self.names[i] in HOLDERS
            free = free or (articles[i] and not held[i])
        for i in range(n - 1, 0, -1):
            articles[self.parents[i]] |= articles[i]
        for i in range(1, n):
            lifted = 2 * chars[i] > chars[0] or (articles[i] and not free)
            self.apart[i] |= self.apart[self.parents[i]] or (self.names[i] in HOLDERS and not lifted)
        blocks = ([(node, text) for node, text in block if not self.apart[node]] for block in self.blocks)
        self.blocks = [block for block in blocks if block]

    def _pop(self) -> str:
        name = self.names[self._stack.pop()]
        self._open[name] -= 1
        if name in BLOCK:
            self._end_block()
        return name

    def _close(self, names: set[str] | frozenset[str]) -> None:
        """End the innermost open element of these names, unless a scope lies in between."""
        for at in range(len(self._stack) - 1, 0, -1):
            if self.names[self._stack[at]] in names:
                while len(self._stack) > at:
                    self._pop()
                return
            if self.names[self._stack[at]] in SCOPE:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._end_block()
            if self._open["p"]:
                self._close({"p"})
        if name in CLOSES and any(self._open[n] for n in CLOSES[name]):
            self._close(CLOSES[name])
        if name in VOID:
            self._text(" ")
            return
        parent = self._stack[-1]
        in_article = bool(self._open["article"] or self._open["main"])
        self.names.append(name)
        self.parents.append(parent)
        own = _apart(name, attributes if self._by_name else "", in_article) if self._by_element else name in CONTROLS
        self.apart.append(self.apart[parent] or own)
        self._stack.append(len(self.names) - 1)
        self._open[name] += 1

    def _end(self, name: str) -> None:
        if name == "p" and not self._open["p"]:
            self._end_block()
        if self._open[name] and name not in ("html", "body"):
            while self._pop() != name:
                pass

    def _parse(self, html: str) -> None:
        at, size, tag = 0, len(html), _TAG
        while at < size:
            to = html.find("<", at)
            if to < 0:
                to = size
            self._text(html[at:to])
            at = to
            if at >= size:
                return
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = size if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), at):
                end = html.find(">", at)
                at = size if end < 0 else end + 1
                continue
            found = tag.match(html, at)
            if not found and tag is _TAG and (found := _PLAIN.match(html, at)):
                tag = _PLAIN  # a quote is never closed: from here on a tag ends at the first >
            if not found:
                if html.find(">", at) < 0 and re.match(r"</?[a-zA-Z]", html[at:at + 3]):
                    return  # the page ends within a tag
                self._text("<")
                at += 1
                continue
            at, name = found.end(), found[2].lower()
            if found[1]:
                self._end(name)
            elif name in RAW:
                if not found[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                    at = end.end() if end else size
            else:
                self._start(name, found[3])

    def has_text(self) -> bool:
        return any(text.strip() for block in self.blocks for _, text in block)

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite text density of every node, and the sum over its children."""
        n = len(self.names)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parents[i]] or self.names[i] == "a"
        for block in self.blocks:
            for node, text in block:
                size = len(" ".join(text.split()))
                chars[node] += size
                link_chars[node] += size if in_link[node] else 0
        for i in range(n - 1, 0, -1):
            p, own = self.parents[i], not self.apart[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + own
            link_tags[p] += link_tags[i] + (own and self.names[i] == "a")
        share = link_chars[0] / max(chars[0], 1)
        density = [0.0] * n
        for i in range(n):
            c, lc = chars[i], link_chars[i]
            if c:
                t, lt = max(tags[i], 1), max(link_tags[i], 1)
                base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
                density[i] = c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0)) / max(math.log(base), 0.1)
        total = [0.0] * n
        for i in range(1, n):
            total[self.parents[i]] += density[i]
        return density, total


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, one per line; empty if there is none.

    The node with the largest sum of its children's densities is the article. The
    least density on its path to the body is the threshold that a part of the page
    outside it must reach to count as well.
    """
    page = Page(html or "")
    if not page.has_text():
        page = Page(html or "", by_name=False)  # the names were about something else
    if not page.has_text():
        page = Page(html or "", by_name=False, by_element=False)  # and so were the elements
    if not page.has_text():
        return ""
    density, total = page.densities()
    n = len(page.names)
    best = max(range(n), key=lambda i: (total[i], i))
    if not total[best]:
        best = 0  # text without elements
    path, i = [], best
    while i >= 0:
        path.append(i)
        i = page.parents[i]
    threshold = min((density[i] for i in path if density[i]), default=0.0)
    top = list(range(n))  # the node with the largest sum below each one
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        if total[top[i]] > total[top[p]]:
            top[p] = top[i]
    chosen, walked, kept = [False] * n, [False] * n, set(path)
    chosen[best] = True
    for i in range(n):  # from the top: what is in a chosen node, or reaches the threshold beside the path
        p = page.parents[i]
        if p >= 0 and chosen[p]:
            chosen[i] = True
        elif i in kept or (p >= 0 and walked[p]):
            walked[i] = True
            if i not in kept and density[i] >= threshold:
                chosen[top[i] if total[top[i]] else i] = True
    lines = (" ".join("".join(text for node, text in block if chosen[node]).split()) for block in page.blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row.

    Null and empty pages have an empty text. Repeated rows stay, each with its
    text; other columns are not read. A page is parsed in one pass, and a malformed
    one as far as its tags can be read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"].cast(pa.int64()), batch["url"].cast(pa.string()), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
