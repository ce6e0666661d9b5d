"""A page's containers: a forgiving HTML reader, scores of containers, and the text under one.

Plain Python on one page at a time, for use inside tasks. A page becomes a list
of text items and a list of elements, each covering a run of items. Elements
that hold menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or reader comments are marked; their items are never part of a text.
"""

from __future__ import annotations

import re
from html import unescape

# ---- fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav noscript ol optgroup option p pre search section "
                   "summary table tbody td template tfoot th thead title tr ul").split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
# an open element of the second set ends where one of the first starts, unless one of the third lies between
CLOSES = [({"li"}, {"li"}, {"ul", "ol", "menu", "dir"}), ({"dd", "dt"}, {"dd", "dt"}, {"dl"}), ({"option", "optgroup"}, {"option"}, {"select"}),
          ({"td", "th"}, {"td", "th"}, {"tr", "table"}), ({"tr"}, {"tr"}, {"table"}), ({"tbody", "thead", "tfoot"}, {"tbody", "thead", "tfoot"}, {"table"})]

# ---- what is not the article
DROPPED = frozenset("head nav header footer aside menu dialog search noscript template button select datalist svg canvas object audio video map applet".split())
DOUBTFUL = frozenset("form fieldset".split())           # may wrap a whole page
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar".split())
COMMENTS = frozenset("comment comments commentlist commentary disqus replies reply respond".split())
ASIDE = frozenset(("ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner breadcrumb breadcrumbs colophon consent cookie cookies "
                   "copyright footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications outbrain "
                   "overlay pager pagination paywall popup promo promos promoted promotion rail recommended related search share sharing sidebar sidebars signin signup "
                   "social sponsor sponsored sponsors submenu subscribe subscription taboola toolbar topbar trending widget widgets").split())
STATES = ("has-", "with-", "without-", "no-", "is-", "js-")     # say how a wrapper looks, not what it is
GOOD = frozenset("article body content entry main post story text".split())
CONTAINERS = frozenset("article body center div html main section td".split())

TOKEN = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(?:>|\Z)"""
                   r"""|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LONG_NUMBER = re.compile(r"\d{3,}|(?=[a-z\d]*\d[a-z]*\d)(?=[a-z\d]*[a-z])[a-z\d]{6,}")
SMOOTH = 25                     # characters: a text block of so many counts half
WRAPPER = 0.85                  # a doubtful mark on an element with such a share of the page's text is none
LEVELS = 6


class Page:
    """Elements (parallel lists, parents first) and text items of one page."""

    def __init__(self, html: str):
        self.tag, self.parent, self.step, self.mark = ["html"], [-1], ["html"], [0]     # mark: 1 not the article, 2 doubtful, 3 comments, -1 main part
        self.first, self.last = [0], [0]
        self.items: list[str] = []
        self.owner: list[int] = []          # element of each item; -1 between blocks
        self.linked: list[bool] = []
        self._read(html)
        self._settle()

    # -------------------------------------------------------------- reading
    def _open(self, tag: str, attributes: str, stack: list[int], inline: bool) -> bool:
        """Push an element; an inline one only if it matters (a mark, a link)."""
        names, ident, role = "", "", ""
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
                kind = m[1].lower()
                if kind == "class":
                    names = names or unescape(value)
                elif kind == "id":
                    ident = ident or unescape(value)
                else:
                    role = role or value.strip().lower()
        mark = self._mark(tag, names, ident, role)
        if inline and mark < 1 and tag != "a":
            return False
        words = sorted({LONG_NUMBER.sub("#", w.lower()) for w in names.split()})
        step = tag + "".join(f".{w}" for w in words) if words else f"{tag}#{LONG_NUMBER.sub('#', ident.lower())}" if ident.strip() else tag
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.step.append(step.replace(" ", "_"))
        self.mark.append(mark)
        self.first.append(len(self.items))
        self.last.append(len(self.items))
        stack.append(len(self.tag) - 1)
        return True

    @staticmethod
    def _mark(tag: str, names: str, ident: str, role: str) -> int:
        if tag in DROPPED or role in ROLES:
            return 1
        if tag in DOUBTFUL:
            return 2
        if tag not in ("html", "body", "main") and (names or ident):
            seen = {w.lower() for name in (*names.split(), ident) if not name.lower().startswith(STATES) for w in WORD.findall(name)}
            if tag in HEADINGS:
                seen.discard("header")
            if seen & COMMENTS:
                return 3
            if seen & ASIDE:
                return 2
        return -1 if tag in ("article", "main") or role == "main" else 0

    def _read(self, html: str) -> None:
        stack, tags, at = [0], self.tag, 0
        links = 0

        def leave(depth: int) -> int:
            """Close the elements from stack place ``depth`` on; how many links that ends."""
            ended = 0
            for e in stack[depth:]:
                self.last[e] = len(self.items)
                ended += tags[e] == "a"
            del stack[depth:]
            return ended

        def find(among, barrier) -> int:
            """Stack place of the innermost element in ``among``, 0 if an element of ``barrier`` comes first."""
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] in among:
                    return depth
                if tags[stack[depth]] in barrier:
                    return 0
            return 0

        def text(piece: str) -> None:
            if not piece:
                return
            if "&" in piece:
                piece = unescape(piece)
            nonlocal links
            if tags[stack[-1]] == "head" and not piece.isspace():
                links -= leave(len(stack) - 1)
            self.items.append(piece)
            self.owner.append(stack[-1])
            self.linked.append(links > 0)

        def apart() -> None:
            self.items.append(" ")
            self.owner.append(-1)
            self.linked.append(False)

        while True:
            m = TOKEN.search(html, at)
            if m is None:
                text(html[at:])
                break
            text(html[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if closing and tag not in ("br", "p"):
                if tag in ("html", "body"):
                    continue
                block = tag in BLOCK
                depth = find((tag,), (() if tag in TABLE else ("td", "th", "caption", "table")) if block else BLOCK)
                if tag in HEADINGS and not depth:
                    depth = find(HEADINGS, CONTAINERS)
                if depth:
                    links -= leave(depth)
                if block:
                    apart()
                continue
            if closing and tag == "p":
                depth = find(("p",), CONTAINERS)
                if depth:
                    links -= leave(depth)
                apart()
                continue
            block = tag in BLOCK
            if tags[stack[-1]] == "head" and tag not in IN_HEAD:
                links -= leave(len(stack) - 1)
            if block or tag == "table":
                depth = find(("p",), CONTAINERS | TABLE | {"button", "object"})
                if depth and tag not in ("html", "head", "body"):
                    links -= leave(depth)
                apart()
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    apart()
                continue
            if tag == "html" or tag == "body" and "body" in (tags[e] for e in stack):
                continue
            for starts, ends, barrier in CLOSES:
                if tag in starts:
                    depth = find(ends, barrier)
                    if depth:
                        links -= leave(depth)
            if tag in HEADINGS and tags[stack[-1]] in HEADINGS:
                links -= leave(len(stack) - 1)
            if tag == "a":
                depth = find(("a",), BLOCK)
                if depth:
                    links -= leave(depth)
                if "href" not in m[3].lower():
                    continue
                links += 1
            if tag in ("svg", "math") and m[3].endswith("/"):
                continue
            self._open(tag, m[3], stack, not block and tag not in DROPPED)
        leave(0)

    # -------------------------------------------------------------- scores
    def _settle(self) -> None:
        """Decide the doubtful marks and book each text block on the containers around it."""
        n = len(self.tag)
        plain, link = [0] * n, [0] * n
        for item, e, linked in zip(self.items, self.owner, self.linked, strict=True):
            if e >= 0:
                size = len(item.strip())
                if size:
                    (link if linked else plain)[e] += size
        total, main = [a + b for a, b in zip(plain, link, strict=True)], [m == -1 for m in self.mark]
        for e in range(n - 1, 0, -1):
            p = self.parent[e]
            total[p] += total[e]
            main[p] = main[p] or (main[e] and self.mark[e] <= 0)
        headed = sum(total[e] for e in range(n) if self.tag[e] == "head" and self.parent[e] == 0)
        whole = max(total[0] - headed, 1)
        out = [False] * n
        for e in range(1, n):
            mark = self.mark[e]
            if mark == 2 and (main[e] and self.tag[e] != "article" or total[e] >= WRAPPER * whole):
                mark = 0
            out[e] = out[self.parent[e]] or mark > 0
        self.out = out
        near = [0] * n                      # innermost container, the element itself included
        score = [0.0] * n
        content, linking, heading = [0] * n, [0] * n, [0] * n
        for e in range(n):
            near[e] = e if self.tag[e] in CONTAINERS else near[self.parent[e]] if e else 0
        for e in range(n):
            if out[e] or not plain[e] + link[e]:
                continue
            content[e] += plain[e] + link[e]
            linking[e] += link[e]
            up = e
            while up > 0 and self.tag[up] not in CONTAINERS and self.tag[up] not in HEADINGS:
                up = self.parent[up]
            if self.tag[up] in HEADINGS:
                heading[e] += plain[e] + link[e]
            worth, c, share = plain[e] * plain[e] / (plain[e] + SMOOTH), near[e], 1.0
            for _ in range(LEVELS):
                score[c] += worth * share
                if c == 0:
                    break
                share /= 2
                c = near[self.parent[c]]
        for e in range(n - 1, 0, -1):
            p = self.parent[e]
            content[p] += content[e]
            linking[p] += linking[e]
            heading[p] += heading[e]
        self.content, self.heading, self.linking = content, heading, linking
        path = [""] * n
        path[0] = "html"
        for e in range(1, n):
            path[e] = f"{path[self.parent[e]]}>{self.step[e]}"
        self.path = path
        best: dict[str, float] = {}
        self.members: dict[str, list[int]] = {}
        self.worth = [0.0] * n
        for e in range(n):
            if out[e] or self.tag[e] not in CONTAINERS or not content[e]:
                continue
            tag = self.tag[e]
            value = content[e] * 2.0 if tag == "article" else score[e] * 2.0 if self.mark[e] == -1 else score[e] * 0.5 if tag in ("html", "body") else score[e]
            if tag not in ("article", "main", "html", "body") and any(w in GOOD for w in WORD.findall(self.step[e][len(tag):])):
                value *= 1.5
            self.worth[e] = value * (1 - linking[e] / content[e])
            self.members.setdefault(path[e], []).append(e)
        for p, members in self.members.items():
            if self._plain(members[0]) and len(members) > 1:        # nothing tells such siblings apart: the best alone
                members[:] = [max(members, key=lambda e: (self.worth[e], -e))]
            elif len(members) > 1:
                members[:] = [e for e in members if 2 * linking[e] < content[e]] or members
            best[p] = sum(self.worth[e] for e in members)
        self.scores = best

    def _plain(self, e: int) -> bool:
        return self.step[e] == self.tag[e] and self.tag[e] not in ("article", "main")

    def best(self) -> str | None:
        """Path of the best container, raised to its parent where only headings are added; None without text."""
        if not self.scores:
            return None
        path = min(self.scores, key=lambda p: (-self.scores[p], p))
        while True:
            members = self.members[path]
            parents = {self.parent[e] for e in members}
            up = next(iter(parents))
            if len(parents) > 1 or up <= 0 or self.tag[up] not in CONTAINERS or self.tag[up] in ("html", "body") or self.path[up] not in self.scores or up not in self.members[self.path[up]]:
                return path
            more = self.content[up] - sum(self.content[e] for e in members)
            if more <= 0 or more != self.heading[up] - sum(self.heading[e] for e in members):
                return path
            path = self.path[up]

    def text(self, path: str) -> str:
        """Text under a path: items of its elements outside marked ones, white space collapsed."""
        members = self.members.get(path, [])
        taken = []
        reached = 0
        for e in sorted(members, key=lambda e: (self.first[e], -self.last[e])):
            menus = self._menus(e) if self._plain(e) or self.tag[e] in ("html", "body") else []
            for i in range(max(self.first[e], reached), self.last[e]):
                owner = self.owner[i]
                if owner < 0 or not self.out[owner] and not any(a <= i < b for a, b in menus):
                    taken.append(self.items[i])
            reached = max(reached, self.last[e])
            taken.append(" ")
        return " ".join("".join(taken).split())

    def _menus(self, top: int) -> list[tuple[int, int]]:
        """Runs of lists of nothing but links, under a container that nothing tells from the page itself."""
        return [(self.first[e], self.last[e]) for e in range(top + 1, len(self.tag))
                if self.tag[e] in ("ul", "ol") and self.first[top] <= self.first[e] and self.last[e] <= self.last[top]
                and self.content[e] and self.linking[e] >= 0.9 * self.content[e]]


def loosen(path: str) -> str:
    """The path with every number generalised."""
    return re.sub(r"\d+", "#", path)


def choose(page: Page, strict: list[str], loose: list[str], votes: dict[str, int]) -> str | None:
    """The path to extract: the host's most voted one that the page has, the page's own best without any.

    A winner inside it that suits the page better and has at least a fifth of
    its votes goes before it (another template that shares the outer wrapper).
    """
    at = next((p for p in strict if p in page.scores), None)
    if at is None and loose:
        by_loose: dict[str, str] = {}
        for p in sorted(page.scores, key=lambda p: (-page.scores[p], p)):
            by_loose.setdefault(loosen(p), p)
        at = next((by_loose[p] for p in loose if p in by_loose), None)
        return at if at is not None else page.best()
    if at is None:
        return page.best()
    for p in strict:
        if p.startswith(at + ">") and p in page.scores and page.scores[p] > page.scores[at] and 5 * votes[p] >= votes[at]:
            at = p
    return at
