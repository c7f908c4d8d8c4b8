"""Main text of web pages by composite text density.

A tree is built from the tags. For every node the characters per tag are computed, adjusted by the share of link text
(Sun, Song and Liao, 2011); the densities of a node's children are summed, and the largest sum shows where the article
is. On a page with article or main elements the enclosing one is taken whole; otherwise the node itself and, along the
path from there to the body, the neighbours that reach the lowest density on that path. That threshold alone loses
headings, leads and short paragraphs beside a dense part, so neighbours below it stay too unless half of their text or
more is links.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are cut out by their tag,
role, class or id before anything is measured, whatever their length, but not an element that holds the chosen article:
the largest article or main element outside of them, or else the densest node outside of them or the largest article
inside of one, whichever has more text; what readers' comments hold is chosen only where there is nothing else. A name of several words counts when all of its words do
(``related-posts``, not ``related-work``); with other words beside them, only what is a third of links or more is cut.

Defined results: null or empty html, and a page without text, give an empty text; broken markup is read as far as it
goes (an unclosed comment, quoted value or raw text such as a script ends with the page; an unclosed button, select or
object is read on); a quote opens a value only behind an equals sign; rows that repeat give a row each; a page of any
length and depth is read whole, in time linear in its length; an empty table gives no rows; other columns are ignored.
``extract`` raises a ValueError where a kept column is named text or n_chars.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import map_rows

# Parts of the HTML standard that matter here, and names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr del "
                   "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
                   "msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
FOREIGN = frozenset("svg math".split())
GONE = frozenset("nav footer aside head dialog menu canvas audio video template annotation annotation-xml".split())
CONTROLS = frozenset("button select object svg noscript".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("body html article section main div table ul ol dl td th blockquote".split())
CUT_NAMES = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
                      "cookies disclaimer footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
                      "recommended related replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
COMMENT_NAMES = frozenset("comment comments replies".split())
# Words beside such a name that do not change what it names. A part of digits is one, too.
COMPANIONS = frozenset("area bar block body bottom box buttons card carousel column container entry form grid group holder icons inner item items "
                       "leaderboard left links list lower module panel posts reader readers region right row section site slot stories story "
                       "thread top unit upper user users wrap wrapper".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
PAGE_HEADER_INSIDE = frozenset("article main section".split())
BODIES = frozenset("article main".split())
CONTENT_NAMES = frozenset("article article-body article-content content entry-content main main-content page-content post-body post-content story-body".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
SPACES = re.compile(r"\s+")


def _visible(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n")


class Page:
    """Nodes in order of their start; node 0 stands for the document."""

    def __init__(self, source: str):
        self.tag, self.parent, self.mark, self.content, self.closed = ["#"], [-1], [""], [False], [False]
        self.pieces: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a block begins or ends
        self.open = [0]
        self.places: dict[str, list[int]] = {}  # where in ``open`` the elements of a name stand
        self.scopes: list[int] = []
        at = 0
        while m := TOKEN.search(source, at):
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if m[3].rstrip().endswith("/") and (name in RAW or name in FOREIGN):
                self._end(name)
            elif name in RAW:
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.IGNORECASE).search(source, at)
                at = close.end() if close else len(source)
                self._end(name)
        if at < len(source):
            self._text(source[at:])
        self._cut()

    def _text(self, text: str) -> None:
        self.pieces.append((self.open[-1], html.unescape(text)))

    def _start(self, name: str, attributes: str) -> None:
        if name not in IN_HEAD and self.tag[self.open[-1]] == "head":  # its end tag may be left out
            self.closed[self.open[-1]] = True
            self._pop(len(self.open) - 1)
        if name not in INLINE:
            if name not in VOID:
                self._leave("p" if name not in CLOSED_BY_SAME else name)
            self.pieces.append((self.open[-1], None))
        if name in VOID:
            return
        parent = self.open[-1]
        self.tag.append(name)
        self.parent.append(parent)
        self.mark.append(self._mark(name, attributes))
        self.closed.append(False)
        self.content.append(name not in ("body", "html") and any(not CONTENT_NAMES.isdisjoint(v) for _, v in self._named(attributes)))
        self.places.setdefault(name, []).append(len(self.open))
        if name in SCOPES:
            self.scopes.append(len(self.open))
        self.open.append(len(self.tag) - 1)

    def _pop(self, place: int) -> None:
        """Takes the open elements from ``place`` on from the stack."""
        while len(self.open) > place:
            name = self.tag[self.open.pop()]
            self.places[name].pop()
            if name in SCOPES:
                self.scopes.pop()

    @staticmethod
    def _named(attributes: str) -> Iterator[tuple[str, list[str]]]:
        """The classes, ids and roles."""
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            yield m[1].lower(), (m[2] or m[3] or m[4] or "").lower().split()

    def _mark(self, name: str, attributes: str) -> str:
        """What tag, role, class and id say against an element: raw, gone, control, comment, named, part."""
        if name in RAW:
            return "raw"
        if name in GONE:
            return "gone"
        if name in CONTROLS:
            return "control"
        if name == "header":  # of the page; an article may head its text with one
            return "" if any(self.places.get(tag) for tag in PAGE_HEADER_INSIDE) else "gone"
        found = {"named"} if name == "form" else set()
        if name not in ("body", "html", "main"):
            for kind, values in self._named(attributes):
                if kind == "role" and CUT_ROLES.intersection(values):
                    found.add("named")
                for value in values:
                    parts = [part for part in re.split("[-_]+", value) if part]
                    if CUT_NAMES.isdisjoint(parts):
                        continue
                    if all(part in CUT_NAMES or part in COMPANIONS or part.isdigit() for part in parts):
                        found.add("named" if COMMENT_NAMES.isdisjoint(parts) else "comment")
                    elif name != "article":
                        found.add("part")
        return next((m for m in ("comment", "named", "part") if m in found), "")

    def _cut(self) -> None:
        """Marks what is not the article, but nothing that holds the chosen one."""
        n = len(self.tag)
        chars, links = [0] * n, [0] * n
        gone, doubted = [False] * n, [False] * n  # out in any case; out unless it holds the chosen article
        for node in range(1, n):
            mark, up = self.mark[node], self.parent[node]
            gone[node] = gone[up] or mark == "raw" or mark == "gone" and self.closed[node]
        for node, text in self.pieces:
            if text and not gone[node]:
                chars[node] += _visible(text)
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            if self.tag[node] == "a":
                links[node] = chars[node]
            chars[up], links[up] = chars[up] + chars[node], links[up] + links[node]
        against = [False] * n
        for node in range(1, n):
            mark = self.mark[node]
            against[node] = (mark in ("gone", "comment", "named") or mark == "control" and self.closed[node]
                             or mark == "part" and 3 * links[node] >= max(1, chars[node]))
            doubted[node] = doubted[self.parent[node]] or against[node]
        chosen = self._chosen(gone, doubted, chars, links)
        holds = set(self._path(chosen)) if chosen else set()
        self.cut = [False] * n
        for node in range(1, n):
            self.cut[node] = gone[node] or self.cut[self.parent[node]] or against[node] and node not in holds

    def _chosen(self, gone: list[bool], doubted: list[bool], chars: list[int], links: list[int]) -> int:
        """The article: an article or main element with the most text, or the densest node; if possible an undoubted one."""
        bodies = [i for i, tag in enumerate(self.tag) if tag in BODIES and not gone[i] and chars[i]]
        comments = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            comments[node] = comments[self.parent[node]] or self.mark[node] == "comment"
        text = lambda i: chars[i] - links[i]
        if free := [i for i in bodies if not doubted[i]]:
            return max(free, key=text)
        inner = max((i for i in bodies if not comments[i]), key=text, default=None)
        for barred in (doubted, comments, gone):
            self.cut = [g or b for g, b in zip(gone, barred)]
            sums, _, own, linked = self.densities()
            best = max(range(len(sums)), key=sums.__getitem__)
            if sums[best]:
                return best if inner is None or own[best] - linked[best] >= text(inner) else inner
        return inner or 0

    def _leave(self, name: str) -> None:
        """Closes an open ``name`` of the current scope, as the start of a block does."""
        places = self.places.get(name)
        if places and places[-1] >= (self.scopes[-1] if self.scopes else 0):
            self._pop(places[-1])

    def _end(self, name: str) -> None:
        if name not in INLINE:
            self.pieces.append((self.open[-1], None))
        if places := self.places.get(name):
            self.closed[self.open[places[-1]]] = True
            self._pop(places[-1])

    def densities(self) -> tuple[list[float], list[float], list[int], list[int]]:
        """Sum of the composite text densities of each node's children, its own, its characters, and those of its links."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.pieces:
            if text and not self.cut[node]:
                chars[node] += _visible(text)
        for node in range(n - 1, 0, -1):
            if self.cut[node]:
                continue
            up = self.parent[node]
            if self.tag[node] == "a":
                link_chars[node], link_tags[node] = chars[node], link_tags[node] + 1
            chars[up] += chars[node]
            tags[up] += tags[node] + 1
            link_chars[up] += link_chars[node]
            link_tags[up] += link_tags[node]
        overall = link_chars[0] / max(1, chars[0])
        sums, own = [0.0] * n, [0.0] * n
        for node in range(n - 1, 0, -1):
            c, t, lc, lt = chars[node], max(1, tags[node]), max(1, link_chars[node]), max(1, link_tags[node])
            if c and not self.cut[node]:
                base = math.log(c / max(1, c - link_chars[node]) * link_chars[node] + overall * c + math.e)
                own[node] = c / t * max(0.0, math.log(c / lc * t / lt + 1)) / max(base, 1.0)
                sums[self.parent[node]] += own[node]
        return sums, own, chars, link_chars

    def _path(self, node: int) -> list[int]:
        """The node and its ancestors up to the document."""
        path = [node]
        while path[-1]:
            path.append(self.parent[path[-1]])
        return path

    def _article(self, best: int, chars: list[int]) -> tuple[int, int]:
        """The node whose whole subtree is the article, and the one up to which its neighbours may belong to it."""
        path = self._path(best)
        if not any(self.tag[i] in BODIES for i in path):
            inside = [False] * len(self.tag)
            for node in range(best, len(self.tag)):
                inside[node] = node == best or node > best and inside[self.parent[node]]
            held = [i for i, tag in enumerate(self.tag) if tag in BODIES and inside[i] and not self.cut[i]]
            top = max(held, key=lambda i: chars[i], default=best)
            if 2 * chars[top] >= chars[best]:
                path = self._path(top)
        articles = [i for i in path if self.tag[i] == "article"]
        marked = [i for i in path if self.tag[i] in BODIES or self.content[i]]
        inner = articles[-1] if articles else next((i for i in path if self.content[i]), path[0])
        return inner, marked[-1] if marked else 0

    def main_text(self) -> str:
        sums, density, chars, link_chars = self.densities()
        n = len(self.tag)
        best = max(range(n), key=lambda i: (not self.cut[i], sums[i]))
        if not sums[best]:
            wanted = [not c for c in self.cut]
        else:
            inner, outer = self._article(best, chars)
            between, node = set(), inner  # the path from above the article to ``outer``
            while node != outer:
                node = self.parent[node]
                between.add(node)
            least = min((density[i] for i in self._path(best)[:-1] if self.tag[i] not in ("html", "body")), default=0.0)
            sought = not any(tag in BODIES and not self.cut[i] for i, tag in enumerate(self.tag))
            own, own_links = [0] * n, [0] * n
            for node, text in self.pieces:
                own[node] += len((text or "").strip())
            for node in range(1, n):
                own_links[self.parent[node]] += chars[node] if self.tag[node] == "a" else 0
            kept, wanted = [False] * n, [False] * n
            for node in range(n):
                up = self.parent[node]
                if not self.cut[node]:
                    kept[node] = (node == inner or up >= 0 and kept[up]
                                  or up in between and node not in between
                                  and (own[up] > own_links[up] if self.tag[node] == "a"
                                       else 2 * link_chars[node] < max(1, chars[node]) or sought and density[node] >= least > 0))
                    wanted[node] = kept[node] or node in between
        blocks, block = [], []
        for node, text in [*self.pieces, (0, None)]:
            if text is None:
                if block and (joined := SPACES.sub(" ", "".join(block)).strip()):
                    blocks.append(joined)
                block = []
            elif wanted[node]:
                block.append(text)
        return " ".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(df: DataFrame, keep: list[str], html_column: str = "html") -> DataFrame:
    """Columns ``keep`` of ``df`` with text and n_chars."""
    if clash := {"text", "n_chars"} & set(keep):
        raise ValueError(f"columns {sorted(clash)} are there already")

    def rows(pages: Iterator[tuple]) -> Iterator[tuple]:
        for source, *rest in pages:
            text = main_text(source)
            yield *rest, text, len(text)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    return map_rows(df, [F.col(html_column), *[F.col(c) for c in keep]], f"{fields}, text string, n_chars bigint", rows, spread=True)
