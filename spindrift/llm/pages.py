"""Main text of web pages by consensus of a host's pages.

Each page's containers are scored by the text they hold outside links. Pages of a host vote for the
generalised path (tags and classes, numbers removed) of their containers, and every page
is extracted anew from the path that wins on its host, with the article around it.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.cut import table
from ..plans.skew import attach

VOTES = 1_000  # of a page, dealt to its containers
CANDIDATES = 5  # containers of a page that get votes
PATH_STEPS = 10  # a path keeps its last steps
LINK_SHARE = 0.5  # what surrounds a container is taken in unless so much of it is link text
OWN_SHARE = 0.6  # a page whose winning path holds less of its best container's text stays with its own

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+)(?:[^<>]*>)?", re.S
)
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NUMBER = re.compile(r"\d+")

# fixed values: HTML elements by what they mean here
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "canvas"}
SKIPPED = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "blockquote", "center"}
BLOCKS = CONTAINERS | SKIPPED | {
    "form", "html", "header", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "pre", "table", "thead",
    "tbody", "tfoot", "tr", "th", "caption", "figure", "figcaption", "fieldset", "legend", "address", "details", "summary",
    "hgroup", "option",
}
# an opening tag of the key ends an open one of these, but not beyond the elements after the bar
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# fixed values: words of classes, ids and roles of what is no main text
OTHER = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promoted",
    "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "sidebar",
    "sidenav", "complementary", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "contentinfo",
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related",
    "recommended", "recommendations", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal",
    "overlay", "widget", "widgets", "pagination", "pager", "toolbar", "search", "form",
}
HEADERS = {"header", "masthead", "topbar"}  # no main text unless inside an article
REMARKS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}
# words beside which the others say nothing: no-sidebar, form-free, alert-level
DENIED = {"no", "not", "non", "without", "with", "has", "is", "free", "level", "less"}
LONGEST_NAME = 2  # words of a class that names what the element is; search-results-page is more than a search
RESCUE = 0.2  # a doubtful element stays if all the rest holds less than this share of its text
_WORDS = re.compile(r"[a-z]+")


def named(value: str) -> set[str]:
    """Words of the names in a class, id or role that can tell what an element is."""
    found: set[str] = set()
    for name in value.split():
        words = _WORDS.findall(name)
        if len(words) <= LONGEST_NAME and not DENIED.intersection(words):
            found.update(words)
    return found


class _Page:
    """Text blocks of a page with the element that holds each."""

    def __init__(self, html: str):
        self.parents, self.paths, self.tags = [-1], [""], [""]
        self.doubts = [""]  # why an element may be no main text: "" no doubt, "other" or "remark"
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._read(html)
        self._settle()

    def _settle(self) -> None:
        """Drop the blocks of doubtful elements, but for those that hold the article or nearly all the text.

        An element around an article or main that is not doubtful itself is kept. If what is kept is little
        beside the largest doubtful element, that one stays, and what is doubtful inside it is
        looked at in turn. Remarks of readers stay only if there is nothing else.
        """
        n = len(self.parents)
        if not any(self.doubts):
            return
        size, holds = [0] * n, [False] * n
        for element, text, links in self.blocks:
            size[element] += len(text) - links
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            size[up] += size[i]
            holds[up] |= holds[i] or self.tags[i] in ("article", "main") and not self.doubts[i]
        kept = [d != "other" or h for d, h in zip(self.doubts, holds)]
        kept = [k and d != "remark" for k, d in zip(kept, self.doubts)]
        while True:
            gone, outer = [False] * n, []
            for i in range(1, n):
                above = gone[self.parents[i]]
                gone[i] = above or not kept[i]
                if gone[i] and not above and size[i]:
                    outer.append(i)
            left = sum(len(text) - links for element, text, links in self.blocks if not gone[element])
            best = min((e for e in outer if self.doubts[e] == "other" or not left), key=lambda e: (-size[e], e), default=None)
            if best is None or left >= RESCUE * size[best]:
                break
            kept[best] = True
        self.blocks = [b for b in self.blocks if not gone[b[0]]]

    def _read(self, html: str) -> None:
        # open elements: tag, element, whether its text is skipped, whether it is inside an article
        stack = [("", 0, False, False)]
        buffer: list[str] = []
        link_from, link_chars, position = -1, 0, 0

        def flush():
            nonlocal link_chars, link_from
            if buffer:
                raw = "".join(buffer)
                text = " ".join(entities.unescape(raw).split())
                if text and not stack[-1][2]:
                    links = link_chars + (len(raw) - link_from if link_from >= 0 else 0)
                    self.blocks.append((stack[-1][1], text, min(len(text), links)))
                buffer.clear()
            link_chars = 0
            link_from = 0 if link_from >= 0 else -1

        def close(at):
            flush()
            del stack[at:]

        while True:
            m = _TOKEN.search(html, position)
            if m is None:
                buffer.append(html[position:])
                break
            if m.start() > position:
                buffer.append(html[position : m.start()])
            position = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag in RAW:
                if not closing and not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, position)
                    position = end.end() if end else len(html)
                continue
            if tag == "br":
                buffer.append(" ")
                continue
            if tag == "a":
                size = sum(map(len, buffer))
                if closing and link_from >= 0:
                    link_chars += size - link_from
                    link_from = -1
                elif not closing:
                    link_from = size
                continue
            if tag == "hr":
                flush()
                continue
            if tag in VOID:
                continue
            if closing:
                for at in range(len(stack) - 1, 0, -1):
                    if stack[at][0] == tag:
                        close(at)
                        break
                else:
                    if tag in BLOCKS:
                        flush()
                continue
            classes, doubt, skip = self._attributes(tag, m[3], stack[-1][3])
            if tag not in BLOCKS and not skip:
                continue  # inline, whatever its class
            self._imply(tag, stack, close)
            flush()
            inside = stack[-1][3] or tag in ("article", "main")
            skip = skip or stack[-1][2] or tag in SKIPPED or tag == "header" and not stack[-1][3]
            if tag == "body":
                skip = False
            step = ".".join([tag, *classes])
            path = "/".join([*self.paths[stack[-1][1]].split("/")[-PATH_STEPS + 1 :], step])
            self.parents.append(stack[-1][1]), self.paths.append(path), self.tags.append(tag), self.doubts.append(doubt)
            if not m[3].rstrip().endswith("/") or tag in BLOCKS:
                stack.append((tag, len(self.tags) - 1, skip, inside))
        flush()

    @staticmethod
    def _attributes(tag: str, text: str, inside: bool) -> tuple[list[str], str, bool]:
        """Generalised classes, a doubt (see ``doubts``), and whether the element is hidden."""
        classes, words, whole, hidden = [], set(), set(), False
        if text.strip(" /"):
            for name, *values in _ATTRIBUTE.findall(text):
                name, value = name.lower(), "".join(values).lower()
                if name == "class":
                    classes = sorted({_NUMBER.sub("#", c) for c in value.split()})[:4]
                if name in ("class", "id", "role"):
                    words |= named(value)
                    whole.update(value.split())
                hidden |= name == "hidden" or name == "style" and "display:none" in value.replace(" ", "")
        if tag == "form":
            return classes, "other", hidden
        if tag in ("html", "body", "main", "h1"):
            words = set()
        elif tag == "article":
            words &= REMARKS | {"related"}
        elif tag == "p":
            words &= whole  # a paragraph must be called so outright
        if words & REMARKS:
            return classes, "remark", hidden
        return classes, "other" if words & OTHER or words & HEADERS and not inside else "", hidden

    @staticmethod
    def _imply(tag: str, stack: list, close) -> None:
        """End the elements that an opening tag ends."""
        ends, stops = ENDS.get(tag, (set(), set()))
        if tag == "body":
            ends, stops = {"head"}, set()
        if tag in BLOCKS:
            ends = ends | {"p"}
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in ends:
                close(at)
                if stack[at - 1][0] not in ends:
                    break
            elif stack[at][0] in stops or stack[at][0] in CONTAINERS and tag not in ENDS:
                break

    def scores(self) -> dict[int, float]:
        """Score by container: its text outside links, and half of what containers in it hold directly."""
        out: dict[int, float] = {}
        for element, text, links in self.blocks:
            share, own = 1.0, len(text) - links
            while element > 0 and share >= 0.25:
                if self.tags[element] in CONTAINERS:
                    bonus = {"article": 1.5, "main": 1.25, "body": 0.5}.get(self.tags[element], 1.0)
                    out[element] = out.get(element, 0.0) + own * share * bonus
                    share /= 2
                element = self.parents[element]
        return out

    def _inside(self, elements: set[int]) -> list[bool]:
        inside = [False] * len(self.parents)
        for i, parent in enumerate(self.parents):  # parents come first
            inside[i] = i in elements or parent >= 0 and inside[parent]
        return inside

    def around(self, elements: set[int]) -> set[int]:
        """The elements, or the articles, mains and other containers below the body around them.

        A container around is taken unless what it adds is link text; so is a body's h1 before it.
        """
        if not elements:
            return elements
        inside = self._inside(elements)
        outer = [e for e in elements if not inside[self.parents[e]]]
        # below each element: characters, those in links, and both of what is chosen there
        size = [[0, 0, 0, 0] for _ in self.parents]
        for element, text, links in self.blocks:
            size[element][0] += len(text)
            size[element][1] += links
        chosen = set(outer)
        for i in range(len(self.parents) - 1, 0, -1):
            if i in chosen:
                size[i][2:] = size[i][:2]
            above = size[self.parents[i]]
            above[:] = [x + y for x, y in zip(above, size[i])]
        reached = [-1] * len(self.parents)  # the outermost container taken from an element on, itself included
        for i in range(1, len(self.parents)):
            total, linked, held, held_linked = size[i]
            stops = total > held and linked - held_linked >= LINK_SHARE * (total - held)
            if not stops and self.tags[i] not in ("body", "html"):
                above = reached[self.parents[i]]
                reached[i] = above if above >= 0 else i if self.tags[i] in CONTAINERS else -1
        tops = {reached[self.parents[e]] if reached[self.parents[e]] >= 0 else e for e in outer}
        last = max(tops)
        return tops | {e for e, t in enumerate(self.tags) if t == "h1" and e < last and self.tags[self.parents[e]] in ("body", "html")}

    def within(self, elements: set[int]) -> list[str]:
        """The blocks inside any of the elements, in page order."""
        inside = self._inside(elements)
        return [text for element, text, _ in self.blocks if inside[element]]

    def votes(self) -> dict[str, int]:
        by_path: dict[str, float] = {}
        for element, score in self.scores().items():
            by_path[self.paths[element]] = by_path.get(self.paths[element], 0.0) + score
        best = sorted(by_path.items(), key=lambda x: (-x[1], x[0]))[:CANDIDATES]
        total = sum(s for _, s in best)
        return {p: int(VOTES * s / total) for p, s in best if total}

    def text(self, path: str | None) -> str:
        scores = self.scores()
        own = self.within(self.around({min(scores, key=lambda e: (-scores[e], e))})) if scores else [t for _, t, _ in self.blocks]
        voted = self.within(self.around({e for e, p in enumerate(self.paths) if e and p == path}))
        size = lambda texts: sum(map(len, texts))
        return "\n\n".join(voted if voted and size(voted) >= OWN_SHARE * size(own) else own)


def host_of(url: Column) -> Column:
    """Host of a URL without user and port, in lower case; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, _n of each host: the path with most votes of its pages (ties: the smaller path), pages counted."""
    rows = df.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches):
        for batch in batches:
            at, paths, votes, pages = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                # a page votes for no path at least, so each host has a row
                for k, (path, n) in enumerate([("", 0), *_Page(text.as_py()).votes().items()]):
                    at.append(i), paths.append(path), votes.append(n), pages.append(int(k == 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(paths, pa.string()), pa.array(votes, pa.int64()), pa.array(pages, pa.int64())],
                names=["host", "path", "votes", "pages"],
            )

    votes = rows.mapInArrow(run, "host string, path string, votes long, pages long")
    by_path = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages"))
    best = F.min(F.struct(-F.col("votes"), "path"))
    return by_path.groupBy("host").agg(best["path"].alias("path"), F.sum("pages").alias("_n"))


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of ``df``.

    Blocks are joined by an empty line; within one, references are decoded and white space is one space.
    Menus, headers outside articles, footers, asides, forms, adverts, notices, comments, scripts,
    styles and hidden parts are left out. What only a class, id or role (or a form) tells so is kept if
    it holds the article, or if nearly nothing else is left of the page. The containers around the path go with it up to
    the body, as far as they don't add link text. A page where that holds too little is
    extracted from its own best container and those around. Null and empty pages, and those without text, give
    ''. Pages without a host share the host ''. Repeated rows are extracted each.
    """
    paths = table(host_paths(df, url_col, html_col))
    rows = df.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    placed = attach(rows, paths, ["host"], "_n").select("page_id", "url", "html", "path")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}

    def run(batches):
        for batch in batches:
            texts = [_Page(h.as_py()).text(p.as_py()) for h, p in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return placed.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
