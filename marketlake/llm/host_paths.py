"""Main text of web pages by consensus: each page scores its containers, hosts vote on their paths, pages follow the vote.

A path is the chain of tags from the body down, each with its first class or id, digits generalised. In the first pass a
page votes for the deepest container outside of which nothing is left but junk and lists of links, and names what lies side by
side in it. Votes add up for each host and path in Spark; a host keeps its leading paths, and the parts that several of its pages
have beside others. In the second pass a page's text comes from all containers on the leading path that suits it best; readable
parts outside of these are left out if the host's other pages have them too, and kept if only this page has them. Where the page
has none of the leading paths, its text comes from its own best container.

Work on a page is linear in its size, however deep its elements nest and whatever is left unclosed.
"""

from __future__ import annotations

import html as html_
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import text_slices, written

#: Share of a page's readable text that an element must hold to be taken for the article because it calls itself so.
MOST = 0.35
#: A path of more characters than this is told by its start and a hash.
LONGEST = 400
#: Hosts whose paths are broadcast: those with the most votes. Pages of all others are joined to theirs by host.
LARGE_HOSTS = 20_000
#: Paths that a host keeps, and the least share of its votes for one.
LEADERS, LEAST_VOTES = 5, 0.02
#: Pages of a host that must have a part beside others for it to be known, and the parts that a host keeps, the most frequent.
KNOWN, BESIDE = 2, 20
#: Characters of a list's items on average, from which on a list of links is no menu.
LONG_ITEM = 40

# Elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe xmp".split())
SKIPPED = set("noscript template svg math object select button canvas audio video".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img br".split())
DROPPED = set("nav header footer aside form fieldset menu dialog head".split())
CONTAINERS = set("body main article section div td center blockquote table tbody tr ul ol dl figure details".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# Words in classes, ids and roles of parts that are not the article. A name is whole, or made of such words and
# of words of place only, or ends in one that says what the part is (article-share, but not tag-news or review-body).
JUNK = re.compile(
    r"ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|notices?|alerts?|nav|navbar|navigation|navi|menus?|breadcrumbs?|crumbs|sidebars?|side|aside|footers?|masthead|topbar|header|(?:site|page|main|top|global)-header"
    r"|comments?|commentlist|disqus|respond|replies|reply|reviews?|related|recommended|recommendations?|teasers?|more-stories|read-more|share|sharing|social|newsletters?|subscribe|subscription|signup|sign-up|login|paywall|popups?|modals?|overlay|widgets?|tags?|tagcloud|pagination|pager|toolbar|search|searchform|form|skip|skip-link|copyright|legal|disclaimer|byline-links|complementary|contentinfo|dialog|alert|print-only",
    re.I,
)
PLACE = re.compile(r"|site|page|main|top|bottom|left|right|global|primary|secondary|area|box|list|wrap|wrapper|container|section|block|bar|inner|outer|slot|unit|items?|links?|posts|articles|stories|icons?|buttons?|desktop|mobile|sticky|fixed|\d+|[a-z]", re.I)
TAILS = re.compile(r"ads?|adverts?|breadcrumbs?|comments|commentlist|disqus|footer|nav|navbar|navigation|newsletter|pagination|pager|related|respond|share|sharing|social|tags|disclaimer|copyright", re.I)
UNSEEN = re.compile(r"(?:^|[_-])hidden|sr-only|visually-hidden", re.I)
#: Names that an article may bear too: such a part is kept if it holds at least as much text as all that is kept without it.
DOUBTFUL = re.compile(r"(?:reviews?|legal|notices?|alerts?|side|form|search|tags?|widgets?|teasers?|promo(?:tion)?s?|newsletters?|disclaimer|share|social|sponsor(?:ed)?|overlay|modals?|header)(?:$|[_-])", re.I)
#: Why a part is left out: in doubt, by its name, or for good.
DOUBT, NAMED, OUT = 1, 2, 3


def junk_name(word: str) -> int:
    """What a class, id or role says of its element: 0, DOUBT, NAMED or OUT."""
    if UNSEEN.fullmatch(word):
        return OUT
    if not JUNK.fullmatch(word):
        parts = re.split("[_-]", word)
        own = [w for w in parts if not PLACE.fullmatch(w)]
        if not own or not (all(JUNK.fullmatch(w) for w in own) or TAILS.fullmatch(own[-1])):
            return 0
    return DOUBT if DOUBTFUL.fullmatch(word) else NAMED


_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile("[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMED = {"class", "id", "role", "style", "hidden", "aria-hidden"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")


class Scanner:
    """Tags of a page, one after another; every part of the page is looked at a bounded number of times."""

    def __init__(self, source: str):
        self.source, self.size = source, len(source)
        self.last = source.rfind(">")
        self.dead: set[int] = set()  # quotes from which no tag ends
        self.absent: set[str] = set()  # what was searched for and does not come any more

    def next(self, at: int) -> tuple[int, int, str, str]:
        """start, end, name (with a slash before it for an end tag; empty for comments and the like) and attributes of the next tag."""
        s = self.source
        while True:
            lt = s.find("<", at)
            if lt < 0 or lt > self.last and not s.startswith("<!--", lt):
                return self.size, self.size, "", ""
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                return lt, end + 3 if end >= 0 else self.size, "", ""
            slash = s.startswith("/", lt + 1)
            m = _TAG_NAME.match(s, lt + 1 + slash)
            if m:
                end = self._end(m.end())
                if end < 0:  # its quotes do not close
                    return lt, s.find(">", lt) + 1, "", ""
                return lt, end, "/" * slash + m[0].lower(), s[m.end() : end - 1]
            if slash or s.startswith(("!", "?"), lt + 1):
                return lt, s.find(">", lt) + 1, "", ""
            at = lt + 1

    def _end(self, at: int) -> int:
        """The place after the tag's `>`, that inside of quotes not counted; -1 if there is none."""
        quotes: list[int] = []
        while True:
            m = _SPECIAL.search(self.source, at)
            if m and m[0] == ">":
                return m.end()
            close = self.source.find(m[0], m.end()) if m and m.start() not in self.dead else -1
            if m:
                quotes.append(m.start())
            if close < 0:
                self.dead.update(quotes)
                return -1
            at = close + 1

    def after(self, pattern: str, at: int) -> re.Match | None:
        """The next match of a pattern."""
        if pattern in self.absent:
            return None
        m = re.compile(pattern, re.I).search(self.source, at)
        if not m:
            self.absent.add(pattern)
        return m


class Stack:
    """Open elements with their containers; the topmost of a kind is found without a walk."""

    def __init__(self):
        self.items: list[tuple[str, int]] = [("body", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag not in INLINE:
            self.blocks.append(len(self.items))
        self.items.append((tag, node))

    def close(self, down_to: int) -> None:
        while len(self.items) > down_to:
            tag, _ = self.items.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def top(self, tags: Iterable[str]) -> int:
        """Place of the topmost of some elements, 0 if none is open."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    @property
    def node(self) -> int:
        return self.items[-1][1]


class Page:
    """Containers and blocks of a page. A block is a run of text between two borders of block elements."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.label: list[str] = ["body"]
        self.own: list[int] = [0]  # why each container is left out, without those above it
        self.blocks: list[tuple[int, str, float, str]] = []  # container, text, share of it in links, element
        self._parse(source)
        self._keep_doubtful()
        self.junk: list[int] = []
        self.path: list[str] = []
        for up, own, label in zip(self.parent, self.own, self.label, strict=True):
            self.junk.append(max(own, self.junk[up] if up >= 0 else 0))
            path = f"{self.path[up]}>{label}" if up >= 0 else label
            self.path.append(path if len(path) <= LONGEST else f"{path[: LONGEST // 2]}>#{xxhash.xxh3_64_hexdigest(path)}")

    def _parse(self, source: str) -> None:
        scan, stack = Scanner(source), Stack()
        held: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if held:
                text = " ".join(html_.unescape("".join(held)).split())
                if text:
                    self.blocks.append((stack.node, text, min(1.0, linked / len(text)), stack.items[stack.blocks[-1]][0]))
                held.clear()
            linked = 0

        at, size = 0, len(source)
        while at < size:
            start, end, tag, attrs = scan.next(at)
            if start > at:
                held.append(source[at:start])
                if stack.places.get("a"):
                    linked += len(source[at:start].strip())
            at = end
            if not tag:
                continue
            if tag in RAW or tag in SKIPPED:
                close = scan.after(rf"</{tag}\s*>", at)
                if tag not in ("script", "style", "svg", "math", "button", "noscript", "template"):
                    flush()
                at = close.end() if close else size if tag in RAW else at
                continue
            name = tag.removeprefix("/")
            if name in ("html", "head", "body"):
                if tag == "head":
                    close = scan.after(r"</head\s*>|<body\b", at)
                    at = (close.end() if close[0][1] == "/" else close.start()) if close else at
                elif tag == "body":
                    flush()
                    self.label[0] = "body" + self._name(attrs)[0]
                continue
            if tag != name:
                place = stack.top((name,))
                if name in INLINE:
                    if place > stack.blocks[-1]:
                        stack.close(place)
                    continue
                flush()
                if place:
                    stack.close(place)
                continue
            if tag == "br":
                held.append(" ")
                continue
            if tag in INLINE:
                if tag not in VOID:
                    name, junk = self._name(attrs)
                    stack.push(tag, self._node(stack.node, tag + name, junk) if junk and tag == "span" and not held else stack.node)
                continue
            flush()
            if tag in VOID:
                continue
            # a block ends an open paragraph and what is inline in it
            block = stack.blocks[-1]
            if block and (stack.items[block][0] == "p" or stack.items[block][0] in HEADINGS and tag in HEADINGS):
                stack.close(block)
            elif block:
                while stack.items[-1][0] in INLINE and stack.items[-1][0] != "a":
                    stack.close(len(stack.items) - 1)
            if tag in CLOSES:
                place = stack.top(CLOSES[tag])
                if place > stack.top(SCOPES[tag]):
                    stack.close(place)
            node = stack.node
            if tag not in ("p", "pre") and tag not in HEADINGS:
                name, junk = self._name(attrs)
                # the header of an article may hold its heading
                inside = tag == "header" and stack.top(("article", "main")) > 0
                if tag in ("article", "main") and junk < OUT:
                    junk = min(junk, DOUBT) if tag == "article" else 0
                if tag in DROPPED and not inside:
                    junk = max(junk, DOUBT if tag == "form" else OUT)
                node = self._node(node, tag + name, junk, inside)
            elif attrs:
                name, junk = self._name(attrs)
                if junk:
                    node = self._node(node, tag + name, junk)
            stack.push(tag, node)
        flush()

    def _node(self, parent: int, label: str, junk: int, heading_only: bool = False) -> int:
        self.parent.append(parent)
        self.label.append(label + ("^" if heading_only else ""))
        self.own.append(junk)
        return len(self.parent) - 1

    @staticmethod
    def _name(attrs: str) -> tuple[str, int]:
        """The name for the path (a class, else the id), and what its attributes say against the element."""
        if not attrs or "=" not in attrs and "hidden" not in attrs:
            return "", 0
        got: dict[str, str] = {}
        for m in _ATTR.finditer(attrs):
            if m[1].lower() in _NAMED:
                got.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        first = (got.get("class", "").split() or got.get("id", "").split() or [""])[0]
        words = f"{got.get('class', '')} {got.get('id', '')} {got.get('role', '')}"
        junk = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(got.get("style", "")))
        # names such as with-sidebar tell of a neighbour
        own = [w for w in words.split() if not re.match(r"(?:with|has|no)[-_]", w, re.I)]
        junk = OUT if junk else max((junk_name(w) for w in own), default=0)
        return ("." + _DIGITS.sub("#", first).lower() if first else ""), junk

    def _keep_doubtful(self) -> None:
        """Containers in doubt are kept if they hold at least as much text as all that is kept without them."""
        for _ in range(8 if DOUBT in self.own else 0):  # what is kept doubles each time
            first: list[int] = []  # the topmost container left out, or -1
            hard: list[bool] = []  # left out for more than doubt
            for n, (up, own) in enumerate(zip(self.parent, self.own, strict=True)):
                above = first[up] if up >= 0 else -1
                first.append(above if above >= 0 else n if own else -1)
                hard.append(own > DOUBT or up >= 0 and hard[up])
            kept, held = 0.0, dict.fromkeys((n for n in set(first) if n >= 0 and self.own[n] == DOUBT), 0.0)
            for node, text, linked, _ in self.blocks:
                w = len(text) * (1 - linked)
                if first[node] < 0:
                    kept += w
                elif first[node] in held and not hard[node]:
                    held[first[node]] += w
            top = max(held, key=lambda n: (held[n], -n), default=-1)
            if top < 0 or not held[top] or held[top] < kept:
                return
            self.own[top] = 0

    def readable(self) -> list[int]:
        """Blocks that may belong to the article: not in junk, not a list of links. Names count less where nothing is left."""
        return next((found for level in (0, DOUBT, NAMED) if (found := self._readable(level))), [])

    def _readable(self, level: int) -> list[int]:
        out = []
        lists: dict[int, list[int]] = {}
        for k, (node, text, linked, tag) in enumerate(self.blocks):
            if self.junk[node] > level or self.label[node].endswith("^") and tag not in HEADINGS:
                continue
            if tag == "li" or self.label[node].startswith(("li", "td", "dd")):
                lists.setdefault(self.parent[node], []).append(k)
            out.append(k)
        gone = set()
        for items in lists.values():
            size = sum(len(self.blocks[k][1]) for k in items)
            if size < LONG_ITEM * len(items) and sum(len(self.blocks[k][1]) * self.blocks[k][2] for k in items) > 0.7 * size:
                gone.update(items)
        return [k for k in out if k not in gone]

    def weights(self, blocks: list[int]) -> list[float]:
        """Readable text under each container; blocks that are links for the most part are left out."""
        total = [0.0] * len(self.parent)
        for k in blocks:
            node, text, linked, _ = self.blocks[k]
            total[node] += len(text) * (linked < 0.5)
        for n in range(len(total) - 1, 0, -1):  # a container comes after the one it lies in
            total[self.parent[n]] += total[n]
        return total

    def best(self, total: list[float]) -> int:
        """The deepest container with all of the readable text, or the one element inside it that calls itself article or main."""
        below: list[list[int]] = [[] for _ in total]
        for n in range(1, len(total)):
            if total[n] > 0:
                below[self.parent[n]].append(n)
        node = 0
        while not self._is(node, "article"):
            called = [n for n in below[node] if self._is(n, "article", "main")]
            # what a main holds beside its article belongs to it
            if len(called) == 1 and total[called[0]] >= (total[node] if self._is(node, "main") else MOST * total[0]):
                node = called[0]
                continue
            whole = [n for n in below[node] if self._holds(n) and total[n] >= total[node]]
            if not whole:
                break
            node = whole[0]
        return node

    def _holds(self, n: int) -> bool:
        return self.label[n].split(".")[0].split("^")[0] in ("main", "article", "section", "div", "td", "table", "tbody", "tr", "center", "blockquote")

    def _is(self, n: int, *tags: str) -> bool:
        return self.label[n].split(".")[0] in tags


def mark(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) - (1 << 63)


def ballot(source: str | None) -> tuple[str, float, list[int]] | None:
    """The path that a page votes for, with the share of its readable text as weight, and marks of the parts side by side in it."""
    if not source:
        return None
    page = Page(source)
    total = page.weights(page.readable())
    if not total[0]:
        return None
    node = page.best(total)
    parts = {mark(page.path[n]) for n in range(1, len(total)) if page.parent[n] == node and total[n] > 0}
    return page.path[node], total[node] / total[0], sorted(parts) if len(parts) > 1 else []


def vote(source: str | None) -> tuple[str, float] | None:
    found = ballot(source)
    return found and found[:2]


def extract(source: str | None, leaders: list[str], votes: list[float], beside: list[int] | None = None) -> str:
    """Text of a page by the paths that its host voted for, best first.

    beside: marks of parts that several pages of the host have beside others. Without it all parts outside of the path count as such.
    """
    if not source:
        return ""
    page = Page(source)
    blocks = page.readable()
    if not blocks:
        return ""
    total = page.weights(blocks)
    suits = dict.fromkeys(leaders, 0.0)
    held: list[str | None] = []  # the path among the leaders' whose container is nearest above, or here
    for n, path in enumerate(page.path):
        up = held[page.parent[n]] if n else None
        held.append(path if path in suits else up)
        if path in suits and up != path:
            suits[path] += total[n]
    ranked = [(v * suits[p], p) for p, v in zip(leaders, votes, strict=True) if suits[p]]
    if ranked:
        chosen = max(ranked)[1]
        inside = [p == chosen for p in page.path]
    else:
        own = page.best(total)
        inside = [n == own for n in range(len(page.path))]
    for n in range(1, len(inside)):
        inside[n] = inside[n] or inside[page.parent[n]]
    if ranked and beside is not None:
        known = set(beside)
        out = [False] * len(inside)
        holds = [False] * len(inside)  # containers above what is chosen are no parts beside it
        for n in range(len(inside) - 1, 0, -1):
            if inside[n] or holds[n]:
                holds[page.parent[n]] = True
        for n in range(1, len(inside)):
            out[n] = not inside[n] and not holds[n] and (out[page.parent[n]] or mark(page.path[n]) in known)
        inside = [not o for o in out]
    taken = [k for k in blocks if inside[page.blocks[k][0]]]
    # the title may stand right before the container
    if taken and (place := blocks.index(taken[0])) and page.blocks[blocks[place - 1]][3] == "h1":
        taken.insert(0, blocks[place - 1])
    return " ".join(page.blocks[k][1] for k in taken)


def host_of(url: str | None) -> str:
    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "", re.I)
    return m[1].lower() if m else ""


def leading_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, paths, votes, all, beside: a host's leading paths, best first, with their shares of its votes, and these; marks of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "html"):
            hosts, paths, weights, marks = [], [], [], []
            for u, h in zip(b.column("url").to_pylist(), b.column("html").to_pylist(), strict=True):
                if v := ballot(h):
                    n = len(v[2])
                    hosts += [host_of(u)] * (1 + n)
                    paths += [v[0], *[None] * n]
                    weights += [v[1], *[0.0] * n]
                    marks += [None, *v[2]]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(weights, pa.float64()), pa.array(marks, pa.int64())], ["host", "path", "weight", "mark"])

    votes = pages.select(pages[url_col].alias("url"), pages[html_col].alias("html")).mapInArrow(run, "host string, path string, weight double, mark long")
    sums = written(votes.groupBy("host", "path", "mark").agg(F.sum(F.round(F.col("weight") * 1000).cast("long")).alias("votes"), F.count("*").alias("pages")), "votes")
    by = sums.where("mark is null").select("host", "path", "votes")
    first = by.withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))).where(F.col("place") <= LEADERS)
    all_ = by.groupBy("host").agg(F.sum("votes").alias("all"))
    kept = first.join(all_, "host").where(F.col("votes") >= LEAST_VOTES * F.col("all"))
    lists = kept.groupBy("host").agg(F.first("all").alias("all"), F.sort_array(F.collect_list(F.struct("place", "path", (F.col("votes") / F.col("all")).alias("share")))).alias("l"))  # LEADERS rows at most
    parts = sums.where(F.col("mark").isNotNull() & (F.col("pages") >= KNOWN)).withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), "mark")))
    parts = parts.where(F.col("place") <= BESIDE).groupBy("host").agg(F.sort_array(F.collect_list("mark")).alias("beside"))  # BESIDE rows at most
    return lists.join(parts, "host", "left").select("host", F.col("l.path").alias("paths"), F.col("l.share").alias("votes"), "all", F.coalesce("beside", F.array().cast("array<long>")).alias("beside"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty page, or one without readable text, has an empty text. Pages without a host in their url vote together.
    Repeated rows vote and are extracted each; other columns are not read.
    """
    leaders = written(leading_paths(pages, url_col, html_col), "paths")
    # at most LARGE_HOSTS rows of at most LEADERS paths of bounded length; every other host has fewer votes than these
    large = written(leaders.orderBy(F.desc("all"), "host").limit(LARGE_HOSTS), "large-hosts")
    small = leaders.join(F.broadcast(large.select("host")), "host", "left_anti")
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?i)[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = rows.withColumn("host", host)
    at_large = rows.join(F.broadcast(large), "host")
    others = rows.join(F.broadcast(large.select("host")), "host", "left_anti").join(small, "host", "left")
    joined = at_large.unionByName(others).select("page_id", "url", "html", "paths", "votes", "beside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "html"):
            cols = [b.column(c).to_pylist() for c in ("html", "paths", "votes", "beside")]
            texts = [extract(h, p or [], v or [], o or []) for h, p, v, o in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
