"""Main text of web pages by consensus of container paths per host.

Pass one scores each page's containers (how much unlinked text stands in their
own paragraphs) and votes for the best one's generalised path: the tags from
the root with their classes, digits as ``#``.  Votes are summed per host in
Spark (partial sums, so a host may have any share of the pages).  Pass two extracts
every page again from its host's winning path, the first of the host's ranking
that the page has with any text; a page that has none of them uses its own best
container, and one without any container all text that is not boilerplate.

Inside the container, menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out.  Words of class and id
do not mark html, body, main or an outermost article that is not named another
kind of article; how other marked elements are judged stands at ``_settle``.  If
marks leave a page no text, the largest marked elements are read.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomweave.llm.io import OWN, saved

#: Paths of a host that count, and the least share of its votes that each needs.
PATHS = 4
LEAST_SHARE = 0.1
#: Winners are broadcast as 24 bytes a host up to this many hosts and bytes of distinct paths; larger ones are joined by page.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 16 << 20

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+)>")
_STOP = re.compile("[\"'>]")
#: A tag up to this long is matched at once; a longer one is first looked through for its end, see _Tokens.
_SHORT = 512
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math")}
#: Left out as elements, since their end tag may be missing; they break no line and an inline end tag reaches out of them.
_LOOSE = frozenset("select optgroup option button svg math".split())
_QUIET = frozenset("button svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var big acronym nobr ruby rt rp".split())
_CONTAINER = frozenset("body div article section main td center blockquote figure".split())
#: A start tag of the left closes an open element of the right, up to the nearest container.
_CLOSES = {t: frozenset(["p"]) for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()}
_CLOSES |= {"li": frozenset(["li", "p"]), "dd": frozenset(["dd", "dt", "p"]), "dt": frozenset(["dd", "dt", "p"]),
            "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
            "option": frozenset(["option"]), "select": frozenset(["select", "option"]), "button": frozenset(["button"])}
_STOPS = {"li": frozenset("ul ol menu".split()), "dd": frozenset(["dl"]), "dt": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"]),
           "option": _CONTAINER | {"select", "datalist"}, "button": _CONTAINER | {"table", "li"}, "select": _CONTAINER | {"table", "li"}}
_SCOPE_STOPS = _CONTAINER | {"button", "table", "li"}
_BOILER_TAGS = frozenset("nav footer aside dialog menu head".split()) | _LOOSE
_FORMS = frozenset("form fieldset".split())
#: Words of class and id values that mark parts other than the article.
_BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay
nav navbar navigation menu breadcrumb breadcrumbs sidebar rail widget related recommended share sharing social comment comments disqus reply replies footer masthead topbar toolbar
newsletter subscribe subscription signup login pagination pager copyright tags""".split())
#: Those of them that also say how a page is laid out; and those that mark lists of links.
_LAYOUT_WORDS = frozenset("banner nav navbar navigation menu breadcrumb breadcrumbs sidebar rail widget masthead topbar toolbar social share sharing tags pagination pager".split())
_LINK_WORDS = frozenset("social share sharing tags menu toolbar pager pagination".split())
#: A class beside one of these words speaks of another element (has-sidebar); a class of these words alone names content.
_MODIFIERS = frozenset("has with no not without hide show".split())
_CONTENT_WORDS = frozenset("content article post entry story main page layout text body".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A marked list inside an article with as many unlinked characters, and few linked ones, is part of it.
_LONG = 100
#: Those that name another kind of article.
_OTHER_ARTICLES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended comment comments disqus reply replies".split())
_WORDS = re.compile(r"[a-z]+|\d+")


class _Node:
    __slots__ = ("tag", "label", "parent", "boiler", "marked", "path", "key", "text", "linked", "score", "inner")

    def __init__(self, tag: str, label: str, parent: _Node | None, boiler: bool, marked: int, inner: bool = False):
        self.tag, self.label, self.parent, self.boiler, self.marked, self.inner = tag, label, parent, boiler, marked, inner
        self.path = self.text = self.linked = 0
        self.key = (0, 0)       # CRC and length of the path as _path writes it
        self.score = 0.0


#: Marks: none, a form's tag, words that may mean the layout, words of lists of links, other words.
_FORM, _LAYOUT, _LIST, _SURE = 1, 2, 3, 4


def _marked(tag: str, classes: str, name: str, in_article: bool) -> int:
    """What class and id values or a form's tag say of an element; only a mark, see _settle."""
    if tag in ("html", "body", "main"):
        return 0
    words, content = set(), False
    for value in [*classes.split(), *([] if tag in _HEADINGS else [name])]:       # a heading's id is made of its text
        own = _WORDS.findall(value)
        content |= bool(own) and _CONTENT_WORDS.issuperset(own)
        if not _MODIFIERS.intersection(own):
            words.update(own)
    words &= _OTHER_ARTICLES if tag == "article" and not in_article else _BOILER_WORDS
    if words - _LAYOUT_WORDS:
        return _SURE
    if words and not content:
        return _LIST if words <= _LINK_WORDS else _LAYOUT
    return _FORM if tag in _FORMS else 0


def _settle(nodes: list[_Node], leads: list[_Node], texts: list[tuple[_Node, str, bool, int]]) -> None:
    """Takes back marks that would drop the article, then hands boilerplate down; ``nodes`` in page order, the root first.

    A marked element is judged by its share of the page's unlinked text and of links in its own: one with
    most of that text stays if it is a form or leads (an h1, main or article inside), or if its words may mean
    the layout, its links are few and no heading or article stands elsewhere.  Inside an article a marked
    list of links stays if it is long and holds few links.
    """
    marks = [n for n in nodes if n.marked]
    if not marks:
        return
    sure = {id(n) for n in nodes if n.boiler}
    held = dict.fromkeys(map(id, nodes), 0)       # unlinked text inside
    links = dict.fromkeys(map(id, nodes), 0)      # linked text inside
    for node, text, linked, _ in texts:
        if not node.boiler:
            (links if linked else held)[id(node)] += len(text.strip())
    for n in reversed(nodes[1:]):
        held[id(n.parent)] += held[id(n)]
        links[id(n.parent)] += links[id(n)]
    total = held[id(nodes[0])]
    leading: set[int] = set()
    heads = 0
    inside = dict.fromkeys(map(id, nodes), 0)     # leads inside
    for n in leads:
        if n.marked and 2 * held[id(n)] > total:
            n.marked = 0
        if n.marked or n.boiler:
            continue
        heads += 1
        inside[id(n)] += 1
        up = n
        while up is not None and id(up) not in leading:
            leading.add(id(up))
            up = up.parent
    for n in reversed(nodes[1:]):
        inside[id(n.parent)] += inside[id(n)]
    for n in marks:
        most, few = 2 * held[id(n)] > total, links[id(n)] < held[id(n)]
        if most and (n.marked == _FORM or id(n) in leading):
            n.marked = 0
        elif most and few and n.marked in (_LAYOUT, _LIST) and inside[id(n)] == heads:
            n.marked = 0
        elif n.marked == _LIST and n.inner and held[id(n)] >= _LONG and 3 * links[id(n)] < held[id(n)]:
            n.marked = 0

    def hand_down() -> None:
        for n in nodes[1:]:
            n.boiler = id(n) in sure or n.marked > 0 or n.parent.boiler

    hand_down()
    if total and all(node.boiler or text.isspace() for node, text, _, _ in texts):
        largest = max((held[id(n)] for n in marks if n.marked), default=0)
        for n in marks:
            n.marked = n.marked if 2 * held[id(n)] <= largest else 0
        hand_down()


class _Tokens:
    """The tags and comments of a page, in time that grows with its length whatever stands in it.

    A tag's end is the next ``>`` outside quotes.  Where a start has none (no ``>`` follows, or a quote is
    not closed), the quotes that were looked through are remembered, as no other tag ends by way of them.
    """

    def __init__(self, page: str):
        self.page, self.lost = page, set()
        self.last = page.rfind(">")         # no tag ends after it
        self.stop = -1                      # the first stop at or after where the last tag began

    def _ends(self, at: int) -> bool:
        if self.stop < at:
            found = _STOP.search(self.page, at)
            self.stop = found.start() if found else len(self.page)
        seen, stop = [], self.stop
        while stop < self.last and self.page[stop] != ">" and stop not in self.lost:
            seen.append(stop)
            close = self.page.find(self.page[stop], stop + 1)
            found = _STOP.search(self.page, close + 1) if close >= 0 else None
            stop = found.start() if found else len(self.page)
        if stop <= self.last and self.page[stop] == ">":
            return True
        self.lost.update(seen)
        return False

    def next(self, at: int) -> tuple[int, int, re.Match | None]:
        """Where the next tag or comment after ``at`` begins and ends, and the match of a tag; (-1, -1, None) without one."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at < 0:
                return -1, -1, None
            after = page[at + 1:at + 2]
            if page.startswith("!--", at + 1):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, None
            if at < self.last:
                m = _TAG.match(page, at, at + _SHORT)
                if not m and (after.isascii() and after.isalpha() or after == "/") and self._ends(at + 1):
                    m = _TAG.match(page, at)
                if m:
                    return at, m.end(), m
                if after and after in "!?/":
                    return at, page.find(">", at) + 1, None
            at += 1


def _self_closing(attrs: str) -> bool:
    """Whether a start tag ends in a slash that is not the end of an unquoted value."""
    last = "" if attrs[-2:-1].isspace() else (attrs[:-1].rsplit(None, 1) or [""])[-1]
    return attrs.endswith("/") and not ("=" in last and last[-1] not in "\"'")


def parse(page: str) -> tuple[list[tuple[_Node, str, bool, int]], list[_Node]]:
    """Text pieces as (element, text, inside a link, block number), and all container elements, in page order.

    A new block number begins at every start or end of an element that is not inline; br is white space.
    """
    root = _Node("#", "", None, False, 0)
    stack, texts, nodes, leads, block, at = [root], [], [root], [], 0, 0
    tokens, unclosed = _Tokens(page), set()
    opens: dict[str, list[int]] = {t: [] for t in ("a", "button", "article", "main")}       # depths of the open elements of a tag
    walls: list[int] = [0]                        # depths of open elements that an inline end tag does not reach out of
    numbers: dict[tuple[int, str], int] = {}      # of the page's paths, as _path writes them

    def add(text: str) -> None:
        if text and not text.isspace():
            texts.append((stack[-1], html.unescape(text), bool(opens["a"]), block))
        elif text:
            texts.append((stack[-1], " ", bool(opens["a"]), block))

    def pop_to(depth: int) -> None:
        for n in reversed(stack[depth:]):
            opens[n.tag].pop()
        while walls[-1] >= depth:
            walls.pop()
        del stack[depth:]

    while True:
        begin, end, m = tokens.next(at)
        add(page[at:begin] if begin >= 0 else page[at:])
        if begin < 0:
            break
        at = end
        if m is None:
            continue
        name = m.group(2)
        tag, inline = name.lower(), name.lower() in _INLINE
        if m.group(1):
            # an inline end tag reaches out of no block, a block's end tag closes what is open inside
            if opens.get(tag) and not (inline and walls[-1] > opens[tag][-1]):
                pop_to(opens[tag][-1])
            block += not (inline or opens["button"] or tag in _QUIET)
            continue
        if tag == "br":
            texts.append((stack[-1], " ", bool(opens["a"]), block))
            continue
        if tag in ("svg", "math") and _self_closing(m.group(3)):
            continue
        if stack[-1].tag in ("svg", "math"):
            # one without an end tag: elements of a page end it, others are its own
            if tag not in _CLOSES and tag not in _CONTAINER and (tag not in _INLINE or tag == "a"):
                continue
            pop_to(len(stack) - 1)
        if tag in _RAW and tag not in unclosed:
            raw = _RAW[tag].search(page, at, tokens.last + 1)        # a > follows every place that it tries
            if raw or tag not in _LOOSE:
                at = raw.end() if raw else len(page)
                block += not (opens["button"] or tag in _QUIET)
                continue
            unclosed.add(tag)
        if tag in _CLOSES:
            stop = max((opens[t][-1] for t in _STOPS.get(tag, _SCOPE_STOPS) if opens.get(t)), default=0)
            hit = len(stack)
            for t in _CLOSES[tag]:
                own = opens.get(t)
                if own and own[-1] > stop:
                    hit = min(hit, own[bisect_right(own, stop)])
            if hit < len(stack):
                pop_to(hit)
        block += not (inline or opens["button"] or tag in _QUIET)
        if tag in _VOID:
            continue
        classes, ident, label, hidden = "", "", tag, False
        if m.group(3) and not m.group(3).isspace():
            attrs = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(m.group(3))}
            classes, ident = attrs.get("class", ""), attrs.get("id", "")
            hidden = (attrs.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert") or "hidden" in attrs or attrs.get("aria-hidden") == "true") and tag not in ("html", "body")
            label = ".".join([tag, *sorted(re.sub(r"\d+", "#", c) for c in classes.split())])
        top, article = stack[-1], bool(opens["article"])
        inner = article or bool(opens["main"])
        sure = top.boiler or hidden or tag in _BOILER_TAGS or (tag == "header" and not inner)
        node = _Node(tag, label, top, sure, _marked(tag, classes, ident, article), inner)
        if inline:
            node.path, node.key = top.path, top.key
        else:
            node.path = numbers.setdefault((top.path, label), len(numbers) + 1)
            node.key = _key(("/" if top.path else "") + label, top.key)
        nodes.append(node)
        if tag in ("h1", "main") or (tag == "article" and not article):
            leads.append(node)
        if not (inline or tag in _LOOSE):
            walls.append(len(stack))
        opens.setdefault(tag, []).append(len(stack))
        stack.append(node)
    _settle(nodes, leads, texts)
    return texts, [n for n in nodes if n.tag in _CONTAINER and not n.boiler]


def _key(text: str, before: tuple[int, int] = (0, 0)) -> tuple[int, int]:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data, before[0]), before[1] + len(data)


def _path(node: _Node) -> str:
    labels = []
    while node is not None and node.parent is not None:
        if node.tag not in _INLINE:
            labels.append(node.label)
        node = node.parent
    return "/".join(reversed(labels))


def best_path(page: str) -> str | None:
    """The generalised path of the best container; None where no container holds text."""
    best = _best(*parse(page))
    return _path(best) if best else None


def _best(texts: list[tuple[_Node, str, bool, int]], containers: list[_Node]) -> _Node | None:
    if not containers:
        return None
    known = set(map(id, containers))
    for node, text, linked, _ in texts:
        if node.boiler:
            continue
        n, share = len(text.strip()), 1.0
        while node is not None and share > 0.2:
            if id(node) in known:
                node.text += n
                node.linked += n * linked
                node.score += 0 if linked else n * share
                share /= 2
            node = node.parent
    best = max(containers, key=lambda c: c.score * (1 - c.linked / c.text if c.text else 0))
    # the article or main around it, if that adds little: its first or last words stand beside the container
    up = best.parent
    while up is not None and id(up) in known and up.text - up.linked <= 1.25 * (best.text - best.linked) and 2 * up.linked <= up.text:
        if up.tag in ("article", "main"):
            return up
        up = up.parent
    return best if best.score > 0 else None


def extract(page: str, paths: list[str]) -> str:
    """Text of the elements on the first of ``paths`` that the page has with any text.

    Else of the page's own best container, and of those on the same path that
    are not mostly links; else of all that is not boilerplate.
    """
    texts, containers = parse(page)
    by_path: dict[str, set[int]] = {}
    wanted = {_key(p) for p in paths}
    written: dict[int, str] = {}        # a path is written out once, and only if its key is wanted
    for c in containers:
        if c.key in wanted:
            p = written.get(c.path) or written.setdefault(c.path, _path(c))
            by_path.setdefault(p, set()).add(id(c))
    for p in paths:
        if p in by_path and (whole := _inside(texts, by_path[p])):
            return whole
    own = _best(texts, containers)
    if own:
        if whole := _inside(texts, {id(c) for c in containers if c.path == own.path and 2 * c.linked <= c.text} | {id(own)}):
            return whole
    return _inside(texts, None)


def _inside(texts: list[tuple[_Node, str, bool, int]], chosen: set[int] | None) -> str:
    """Text inside the chosen elements (None: anywhere) that is not boilerplate."""
    inside, blocks, now = {}, [], None
    for node, text, _, block in texts:
        if node.boiler:
            continue
        if chosen is not None:
            chain, n = [], node
            while n is not None and id(n) not in inside:
                chain.append(n)
                if id(n) in chosen:
                    break
                n = n.parent
            hit = n is not None and (id(n) in chosen or inside.get(id(n), False))
            for c in chain:
                inside[id(c)] = hit
            if not hit:
                continue
        if block != now:
            blocks.append([])
            now = block
        blocks[-1].append(text)
    return "\n\n".join(t for t in (_SPACE.sub(" ", "".join(b)).strip() for b in blocks) if t)


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes: one vote a page, summed per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                found = [(host(u), best_path(h.as_py())) for u, h in zip(part.column(0).to_pylist(), part.column(1), strict=True) if h.as_py()]
                found = [x for x in found if x[1] is not None]
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.string())], names=["host", "path"])

    src = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "host string, path string").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))


def winners(counted: DataFrame) -> DataFrame:
    """host, paths: each host's leading paths, most votes first."""
    total = counted.groupBy("host").agg(F.sum("votes").alias("all")).withColumnRenamed("host", f"{OWN}h")
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    led = counted.withColumn("r", rank).filter(F.col("r") <= PATHS).join(total, F.col("host") == F.col(f"{OWN}h"))
    led = led.filter((F.col("r") == 1) | (F.col("votes") >= LEAST_SHARE * F.col("all")))
    return led.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "path"))), lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    Null or empty html gives empty text; a null or odd url belongs to the host
    "".  Rows that repeat are extracted each.  Other columns are not read.  An
    empty table gives no rows.
    """
    won = saved(winners(saved(votes(pages, url_col, html_col))))
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    packed = _packed(won)
    if packed:
        table = pages.sparkSession.sparkContext.broadcast(packed)
        ready, look = src.withColumn("paths", F.lit(None).cast("array<string>")), lambda u, given: _looked_up(table.value, host(u))
    else:
        ready = _with_paths(src, won)
        look = lambda u, given: given or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                out = []
                for u, h, given in zip(part.column(1).to_pylist(), part.column(2), part.column(3).to_pylist(), strict=True):
                    page = h.as_py() or ""
                    paths = look(u, given)
                    out.append(_page_text(page, paths))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return ready.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def _page_text(page: str, paths: list[str]) -> str:
    return extract(page, paths) if page else ""


def _packed(won: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str]] | None:
    """Sorted host hashes, the numbers of each one's paths and the distinct paths; None beyond the bounds.

    Hosts of one template share their paths, so these are kept once.  Two hosts with one 64-bit hash
    give None as well: the join compares whole names.
    """
    names = saved(won.select(F.explode("paths").alias("path")).distinct())
    bounds = names.agg(F.sum(F.octet_length("path") + 64).alias("bytes")).first()
    if won.count() > BROADCAST_ROWS or (bounds["bytes"] or 0) > BROADCAST_BYTES:
        return None
    paths = sorted(r["path"] for r in names.collect())
    number = won.sparkSession.createDataFrame(list(enumerate(paths)), "id int, path string")
    placed = won.select(F.xxhash64("host").alias("h"), F.posexplode("paths").alias("i", "path")).join(number, "path")
    rows = placed.select("h", "i", "id").toArrow()
    hashes, which = np.unique(rows["h"].to_numpy(), return_inverse=True)
    if len(hashes) != won.count():
        return None
    ids = np.full((len(hashes), PATHS), -1, np.int32)
    ids[which, rows["i"].to_numpy()] = rows["id"].to_numpy()
    return hashes, ids, paths


def _looked_up(packed: tuple[np.ndarray, np.ndarray, list[str]], name: str) -> list[str]:
    hashes, ids, paths = packed
    h = xxhash.xxh64_intdigest(name.encode(), 42)
    h -= (h >> 63) << 64        # as the signed number that Spark's xxhash64 gives
    at = int(np.searchsorted(hashes, h))
    return [paths[i] for i in ids[at] if i >= 0] if at < len(hashes) and hashes[at] == h else []


def _with_paths(src: DataFrame, won: DataFrame) -> DataFrame:
    """Beyond the broadcast: paths are joined to the distinct urls, then to the pages by url, html included.

    Pages are spread by url, so no host gathers its pages.
    """
    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([host(u) for u in b.column(0).to_pylist()], pa.string())], names=["u", "host"])

    by_url = (src.select(F.col("url").alias("u")).distinct().mapInArrow(hosts, "u string, host string")
              .join(won, "host", "left").select("u", "paths"))
    return src.join(by_url, F.col("url").eqNullSafe(F.col("u")), "left").select("page_id", "url", "html", "paths")
