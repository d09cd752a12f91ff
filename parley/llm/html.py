"""Operator 8, HTML extraction by consensus host paths.

1. Pages are parsed once in an Arrow-batched function. Every container (element that directly holds text blocks) has a generalised path:
   tags with their classes, digits replaced, from the root. A container's score is its text outside links, by length and number of blocks.
   The best container is lifted to the ancestor that holds the article's other parts (``lift``: title, lead, sections in containers of their
   own), by scores summed over all that lies below each ancestor.
2. Each page votes for the path of its best region; votes are summed by host and path in Spark, and each host's path with the most votes
   wins (ties: the larger text, then the path). Hot hosts are partial sums.
3. Pages are extracted again from every element on the host's winning path. A page uses its own best region where that lies above the
   winning path, where the winning path has no blocks or (another template of the host) less than half of its score. A page without any
   container gives its whole body.

Scripts, styles, controls and hidden elements are dropped. Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are set
aside by tag, role or class and id words, and left out unless the article can only be in them (``Page.kept_parts``: a form around the whole page, an
unclosed menu, a wrapper called ``sidebar-layout``). A class that tells of a state (``has-sidebar``, ``no-comments``) names nothing, and the header
of an article belongs to it. Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.

Work is linear in the page's length and nesting; unclosed and stray tags are read as far as they go. Null html gives empty text. The host is the lower-cased name in the url without port or user; a null or malformed url votes under
the empty host. Repeated rows each return a row.
"""
from __future__ import annotations

import heapq
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C

BROADCAST_ROWS = 200_000
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe object svg canvas button select textarea head title audio video map".split())
SET_ASIDE = frozenset("nav header footer aside form menu dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
                   "wbr img".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table thead tbody tfoot tr td th caption figure figcaption hr address center".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
READERS = r"comment|comments|commentlist|discussion|disqus|replies|reply|respond"
NOTICES = (r"ad|ads|adv|advert|adverts|advertisement|advertising|adsense|adbox|sponsor|sponsored|promo|promotion|promoted|cookie|cookies|consent|gdpr|popup|modal|overlay|"
           r"newsletter|subscribe|signup|login")
PLACES = (r"banner|nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs|sidebar|side|aside|footer|header|masthead|notice|notices|notification|alert|related|recommended|"
          r"share|sharing|social|toolbar|widget|pagination|pager|form|search|skip")
NAMES = re.compile(rf"(?:^|[^a-z])(?:(?P<readers>{READERS})|(?P<notices>{NOTICES})|{PLACES})(?:$|[^a-z])")
#: A class that says whether a page has or shows such a part does not name the element itself.
STATE = re.compile(r"^(?:has|have|no|not|with|without|is|hide|show)[-_]|[-_](?:enabled|disabled|open|opened|closed|on|off|active|inactive|visible|hidden|collapsed|expanded)$")
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
                     "table ul li dd dt".split())
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
LEAST = 100
SPACE = re.compile(r"\s+")
NUMBER = re.compile(r"\d+")
CAMEL = re.compile(r"([a-z])([A-Z])")


@lru_cache(maxsize=4_096)
def named(classes: str, name: str) -> str:
    """What the class and id words call an element: ``readers``, ``notices``, ``places`` or nothing."""
    kinds = set()
    for word in [*classes.split(), name]:
        label = NUMBER.sub("", CAMEL.sub(r"\1-\2", word)).lower()
        found = None if STATE.search(label) else NAMES.search(label)
        if found:
            kinds.add(found.lastgroup or "places")
    return min(kinds, key=("readers", "notices", "places").index, default="")


@lru_cache(maxsize=4_096)
def generalised(classes: str) -> str:
    return "".join(sorted("." + NUMBER.sub("N", c).replace("/", "_") for c in classes.split()))


class Page:
    """The blocks of a page and the tree of their generalised paths.

    Node 0 is the root; ``parent[n] < n``. ``parts`` are the elements that a tag, role or name sets aside: (outer part, needs a mark, own text, own h1
    blocks, own article and main elements)."""

    def __init__(self) -> None:
        self.parent, self.step, self.inside = [-1], [""], [False]  # inside: below an article or main
        self.children: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int, int]] = []  # node, text, link characters, part
        self.parts: list[list[int]] = [[-1, 0, 0, 0, 0]]  # part 0: what is not set aside

    def tag(self, node: int) -> str:
        return self.step[node].partition(".")[0]

    def child(self, node: int, step: str) -> int:
        at = self.children.get((node, step))
        if at is None:
            at = self.children[node, step] = len(self.parent)
            self.parent.append(node)
            self.step.append(step)
            self.inside.append(self.inside[node] or step.partition(".")[0] in ("article", "main"))
        return at

    def path(self, node: int) -> str:
        steps = []
        while node > 0:
            steps.append(self.step[node])
            node = self.parent[node]
        return "/".join(reversed(steps))

    def node(self, path: str) -> int | None:
        at: int | None = 0
        for step in path.split("/"):
            at = self.children.get((at, step))
            if at is None:
                return None
        return at

    def kept_parts(self) -> set[int]:
        """The parts that are not set aside after all: part 0, and parts that can only be the article.

        While what is kept has no h1, article or main, the largest part left is looked at. It is kept if what is kept has at most a tenth of its unlinked
        text and if it holds an article or main; or if it has ``LEAST`` characters and holds an h1 or is set aside by a place name only (``sidebar``,
        ``share``). Parts in it are then looked at in the same way."""
        text, h1, marks = ([p[i] for p in self.parts] for i in (2, 3, 4))
        below: dict[int, list[int]] = {}
        for at in range(len(self.parts) - 1, 0, -1):
            outer = self.parts[at][0]
            for count in (text, h1, marks):
                count[outer] += count[at]
            below.setdefault(outer, []).append(at)
        kept, plain, seen = {0}, self.parts[0][2], self.parts[0][3] + self.parts[0][4]
        left = [(-text[at], at) for at in below.get(0, ())]
        heapq.heapify(left)
        while left and not seen:
            size, at = heapq.heappop(left)
            if -size >= max(1, 10 * plain) and (marks[at] or (-size >= LEAST and (h1[at] or not self.parts[at][1]))):
                kept.add(at)
                plain, seen = plain + self.parts[at][2], seen + self.parts[at][3] + self.parts[at][4]
                for inner in below.get(at, ()):
                    heapq.heappush(left, (-text[inner], inner))
        return kept


class PageParser(HTMLParser):
    """Fills a ``Page`` with the blocks outside dropped elements, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.stack: list[tuple[str, int, bool, int]] = []  # tag, node, whether it is dropped, part
        self.open: Counter[str] = Counter()
        self.buffer: list[str] = []
        self.link_chars = 0
        self.skip = 0

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.buffer)).strip()
        if text:
            _, node, _, part = self.stack[-1] if self.stack else ("", 0, False, 0)
            linked = min(self.link_chars, len(text))
            self.page.blocks.append((node, text, linked, part))
            self.page.parts[part][2] += len(text) - linked
            self.page.parts[part][3] += self.page.tag(node) == "h1" and 2 * linked < len(text)
        self.buffer, self.link_chars = [], 0

    def _pop(self, at: int) -> None:
        for tag, _, out, _ in self.stack[at:]:
            self.skip -= out
            self.open[tag] -= 1
        del self.stack[at:]

    def _close_open(self, tag: str) -> None:
        """End tags that may be left out: p before a block, items before the next item."""
        if tag in CLOSES_P and self.open["p"]:
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at][0] == "p":
                    self._pop(at)
                    break
                if self.stack[at][0] not in INLINE:
                    break
        if tag in ITEMS:
            ends = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            if any(self.open[x] for x in ends):
                for at in range(len(self.stack) - 1, -1, -1):
                    if self.stack[at][0] in ITEMS[tag]:
                        break
                    if self.stack[at][0] in ends:
                        self._pop(at)
                        break

    def _part(self, tag: str, attrs: dict[str, str], outer: int) -> int:
        kind = named(attrs.get("class", ""), attrs.get("id", ""))
        if tag in ("article", "main") and kind != "readers":
            self.page.parts[outer][4] += 1
        by_tag = (tag in SET_ASIDE and not (tag == "header" and self.open["article"])) or attrs.get("role", "").lower() in ROLES
        if not by_tag and (not kind or tag in ("html", "body", "article", "main")):
            return outer
        self.page.parts.append([outer, by_tag or kind != "places", 0, 0, 0])
        return len(self.page.parts) - 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
        self._close_open(tag)
        if tag in VOID:
            return
        given = {k: v or "" for k, v in reversed(attrs)}
        _, node, _, part = self.stack[-1] if self.stack else ("", 0, False, 0)
        out = tag in DROPPED or "hidden" in given or given.get("aria-hidden") == "true"
        if tag in INLINE:
            out = out or given.get("role", "").lower() in ROLES or bool(given and named(given.get("class", ""), given.get("id", "")))
        elif not self.skip and not out:
            part = self._part(tag, given, part)
            node = self.page.child(node, tag + generalised(given["class"]) if "class" in given else tag)
        self.stack.append((tag, node, out, part))
        self.skip += out
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._pop(at)
                return
            if tag in INLINE and self.stack[at][0] not in INLINE:
                return  # a stray end tag of an inline element does not close blocks

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        self.buffer.append(data)
        if self.open["a"]:
            self.link_chars += len(data)


def parse(html: str) -> Page:
    """The page's tree, with the blocks of kept parts only."""
    parser = PageParser()
    parser.feed(html)
    parser.close()
    parser.flush()
    page = parser.page
    kept = page.kept_parts()
    page.blocks = [b for b in page.blocks if b[3] in kept]
    return page


def containers(page: Page) -> dict[int, tuple[int, int]]:
    """Of each element that holds blocks (the nearest ancestor that is not itself a paragraph, heading, list, table or quote part): characters outside
    links, with a bonus for each block of some length, less twice the linked ones; and its unlinked h1 blocks."""
    out: dict[int, tuple[int, int]] = {}
    place = [0] * len(page.parent)
    for at in range(1, len(place)):
        outer = page.parent[at]
        place[at] = place[outer] if outer and page.tag(at) in LEAVES else at
    for node, text, linked, _ in page.blocks:
        plain = len(text) - linked
        net, titles = out.get(place[node], (0, 0))
        out[place[node]] = net + plain + (25 if plain > 25 else 0) - 2 * linked, titles + (page.tag(node) == "h1" and plain > linked)
    return out


def lift(page: Page, best: int, own: dict[int, tuple[int, int]]) -> int:
    """The ancestor of ``best`` (or itself) that holds the article's parts in other containers, too.

    Each ancestor has the summed score of what lies below it. Inside an article any unlinked text is a part. Inside main it is one if the score
    rises or the missing h1 is found; above both, if that h1 is found or less than half of the score is inside; without either, from a tenth on."""
    chain = [best]
    while chain[-1]:
        chain.append(page.parent[chain[-1]])
    chain.reverse()
    depth = {node: d for d, node in enumerate(chain)}
    shared = [0] * len(page.parent)  # the depth at which a node's path leaves that of ``best``
    for at in range(1, len(shared)):
        shared[at] = depth[at] if at in depth else shared[page.parent[at]]
    net, text, titles = ([0] * len(chain) for _ in range(3))
    for node, (score, h1) in own.items():
        net[shared[node]] += score
        text[shared[node]] += max(score, 0)
        titles[shared[node]] += h1
    tags = [page.tag(x) for x in chain]
    article, main = ([False] * len(chain) for _ in range(2))
    for d in range(1, len(chain)):
        article[d], main[d] = article[d - 1] or tags[d] == "article", main[d - 1] or tags[d] == "main"
    at = len(chain) - 1
    inside, title = net[at], titles[at]
    more = part = h1 = 0
    for d in range(len(chain) - 2, 0, -1):
        more, part, h1 = more + net[d], part + text[d], h1 + titles[d]
        if article[d]:
            up = part > 0
        elif main[d]:
            up = more > 0
        else:
            up = more > 0 and more >= (inside if article[-1] or main[-1] else inside / 10)
        if up or (h1 and not title):
            at, inside, title = d, inside + more, title + h1
            more = part = h1 = 0
    return chain[at]


def subtree(page: Page, node: int) -> list[bool]:
    """Of each node, whether it is ``node`` or below it."""
    out = [False] * len(page.parent)
    out[node] = True
    for at in range(node + 1, len(out)):
        out[at] = out[page.parent[at]]
    return out


def below(own: dict[int, tuple[int, int]], inside: list[bool]) -> tuple[int, int]:
    """The summed score and h1 blocks of the containers marked ``inside``."""
    mine = [v for at, v in own.items() if inside[at]]
    return sum(v[0] for v in mine), sum(v[1] for v in mine)


def best_region(page: Page, own: dict[int, tuple[int, int]]) -> int:
    """The container of highest score (ties: the first on the page), lifted to the ancestor with the article's other parts; 0 for none."""
    if not own:
        return 0
    score = {at: v[0] + 50 * page.inside[at] for at, v in own.items()}
    top = max(score.values())
    best = min(at for at, v in score.items() if v == top)
    return lift(page, best, own)


def best_container(page: Page) -> tuple[str, int]:
    """The path of the page's best region and its summed score."""
    own = containers(page)
    best = best_region(page, own)
    return page.path(best), below(own, subtree(page, best))[0]


def extract(html: str, path: str | None) -> str:
    """The text on ``path`` and below it, or on the page's own best path: if that is above ``path``, or elsewhere and has more than twice its
    score (``path`` is of another template; not if the h1 is on ``path`` only), or ``path`` has no blocks. Without any container, the whole page."""
    page = parse(html)
    own = containers(page)
    best = best_region(page, own)
    mine = subtree(page, best)
    at = page.node(path) if path else None
    chosen = mine
    if at is not None:
        given = subtree(page, at)
        (here, title), (there, other) = below(own, given), below(own, mine)
        other_template = not given[best] and (mine[at] or (2 * here < there and not (title and not other)))
        if not other_template and any(given[b[0]] for b in page.blocks):
            chosen = given
    return " ".join(b[1] for b in page.blocks if chosen[b[0]])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _vote(html: Column) -> Column:
    @F.pandas_udf("path string, score long")
    def vote(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_container(parse(x)) for x in pages], columns=["path", "score"])
    return vote.asNondeterministic()(html)  # evaluated once, not again for the filter on its path


def _extract(html: Column, path: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(h, p) for h, p in zip(pages, paths, strict=True)], dtype=object)
    return run(html, path)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes): the winning container path of each host."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    votes = (pages.select(host_of(F.col(url_col)).alias("host"), _vote(html).alias("v")).filter("v.path <> ''")
             .groupBy("host", "v.path").agg(F.count(F.lit(1)).alias("votes"), F.sum("v.score").alias("score")))
    order = F.max_by(F.struct("path", "votes"), F.struct("votes", "score", "path"))
    return votes.groupBy("host").agg(order.alias("w")).select("host", "w.path", "w.votes")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, host_path, text, n_chars of each row of ``pages``."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    winners = host_paths(pages, url_col, html_col).select(F.col("host").alias("__host"), F.col("path").alias("host_path")).checkpoint()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), host_of(F.col(url_col)).alias("host"))
    joined = rows.join(C.small_side(winners, BROADCAST_ROWS), F.col("host") == F.col("__host"), "left")
    out = joined.select("page_id", "url", "host_path", _extract(F.col("html"), F.coalesce("host_path", F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
