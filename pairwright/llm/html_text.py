"""HTML extraction by consensus paths of a host.

First pass: each page is parsed into blocks of text below a tree of containers; a container's score is the text below
it that is neither linked nor in boilerplate (menus, headers, footers, sidebars, notices, adverts, forms, comments),
less the text that is. Containers are named by their generalised path of tags and classes (digits become #, positions
are left out). A page's best containers vote, by their share of the page's text, in Spark; each host's winner is the
path with most votes. Second pass: a page's text is what stands below the containers with its host's winning path, or
below its own best container where the winner holds less than half of that one's score.

A mark doesn't hold for a wrapper of the article. One whose name only contains a marking word (has-sidebar), and a form,
is no boilerplate if it holds main, the only articles, or most of the page's unlinked text in two blocks or more; one of
any name, if it holds main. Where all h1 with text stand below marks, so is one with an h1 and a quarter of that text.
Elements that say what they are (nav, footer, aside), headers, comments and what is hidden stay marked.

Votes are summed in each batch before the shuffle, so a host with a third of all pages sends a few rows a batch. A path
is named by a digest of its parent's name and its own label, so paths of any depth cost the same and none is cut; all
work on a page is linear in its length but for end tags that match nothing near them.

Defined results: null or empty html and pages without text give an empty text; an unknown or null url votes with the
pages of no host; comments, scripts, styles and the head never count, and an unclosed script or style takes the rest of
the page, as in HTML; what is drawn or chosen and not read (svg, canvas, object, select, template, iframe, textarea) is
left out with all it holds, nested ones included, and where such an element isn't closed only its tag goes; formulas
(math) are text; a button inside a paragraph is part of it, any other one goes; a tag cut off at the end of a page is
dropped; unclosed and misnested tags close where their block ends; repeated pages are extracted each; an empty table
gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import lean_batches, materialize, table

TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*'|["'])*?)(?:>|$)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: What HTML says of its elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style".split())
UNREAD = set("noscript textarea title iframe xmp noembed noframes template svg canvas object select annotation annotation-xml audio video datalist map".split())
TEXT_BLOCKS = set("p li dt dd h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption caption td th tr tbody thead summary".split())
BLOCKS = set("address blockquote center dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr li ol p pre summary table tbody td tfoot th thead tr ul caption".split())
CONTAINERS = set("html body main article section div td blockquote ul ol dl table tbody tr center nav header footer aside form menu dialog details figure fieldset search".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead"}, "tfoot": {"tbody", "thead"}}
STOPS_CLOSING = {"p": CONTAINERS - {"html", "body"}, "li": {"ul", "ol", "menu", "div"}, "dt": {"dl"}, "dd": {"dl"}}
#: Elements, roles and words of class or id that mark what isn't the article.
OUTSIDE = set("nav footer aside form menu dialog button head search".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MARKS = set("""ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices newsletter subscribe subscription signup login sidebar sidebars side aside rail menu menus nav navbar navigation
topnav breadcrumb breadcrumbs footer foot comment comments commentlist disqus replies respond related recommended share sharing social
popup modal overlay toolbar pagination pager widget widgets masthead copyright disclaimer alert skip hidden""".split())
#: Marks of replies of readers, which may be longer than the article and be articles themselves.
REPLIES = set("comment comments commentlist disqus replies respond".split())
#: Marks that also hold for a single block of text; the others name parts of a layout.
BLOCK_MARKS = set("""ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo cookie cookies consent gdpr
newsletter breadcrumb breadcrumbs pagination pager navbar navigation topnav commentlist disqus popup modal hidden""".split())
HEADERS = {"header", "site-header", "page-header", "siteheader", "pageheader", "top-header", "topbar", "top-bar"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: So many winning paths are broadcast at most; more are joined by a shuffle, which splits hot hosts.
MOST_HOSTS = 200_000


def matching_ends(html: str, tag: str) -> dict[int, int]:
    """Where each element of a name that is closed ends, by the place where it starts; nested ones belong to each other."""
    found, starts = {}, []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])([^>]*)>", html, re.I):
        if not m[1] and not m[2].endswith("/"):
            starts.append(m.start())
        elif m[1] and starts:
            found[starts.pop()] = m.end()
    return found


class Page:
    """Blocks of a page's text, each below a node; nodes have a parent, a path, a depth and whether they are boilerplate."""

    def __init__(self, html: str):
        self.parent, self.path, self.label, self.depth, self.outside, self.head = [-1], [0], ["#"], [0], [False], [False]
        self.blocks: list[tuple[str, int, int, bool]] = []
        self.tags, self.titles = [""], []
        self.marks: dict[int, int] = {}  # marked nodes: 0 for good, 1 by a whole name, 2 by a part of a name or a form
        self._parse(html)
        self._unmark()

    def _node(self, tag: str, attributes: str, parent: int, in_article: bool) -> int:
        label, marked, header = tag, tag in OUTSIDE, False
        kind = 2 if tag == "form" else 0
        if attributes and not attributes.isspace():
            found = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)}
            names = [n for n in (found.get("class", "") + " " + found.get("id", "")).lower().split()]
            words = {w for n in names for w in re.split(r"[^a-z]+", n)}
            if tag in TEXT_BLOCKS:
                words &= BLOCK_MARKS
            style = found.get("style", "").replace(" ", "").lower()
            sure = found.get("role", "").lower() in ROLES - {"form"} or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
            if words & MARKS and not sure and (tag == "form" or not marked):
                kind = 1 if words & REPLIES or MARKS & set(names) else 2
            elif found.get("role", "").lower() == "form" and not sure and not marked:
                kind = 2
            elif sure:
                kind = 0
            marked = marked or bool(words & MARKS) or found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
            header = bool(set(names) & HEADERS)
            label += "".join("." + n for n in sorted({re.sub(r"\d+", "#", n) for n in found.get("class", "").lower().split()}))
        if tag == "header" or header:
            if not in_article:
                marked, kind = True, 0
            else:
                header = True
        if tag in ("body", "html", "main", "article"):
            marked = False
        if marked:
            self.marks[len(self.parent)] = kind
        self.tags.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.path.append(xxhash.xxh3_64_intdigest(label, seed=self.path[parent]))
        self.label.append(label)
        self.outside.append(marked or self.outside[parent])
        self.head.append(header or self.head[parent])
        return len(self.parent) - 1

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # open elements but inline ones, with the node below which their text stands, and whether an article is open
        opened: dict[str, int] = defaultdict(int)  # how many elements of a name are open
        ends: dict[str, dict[int, int]] = {}
        node, links, at, end = 0, 0, 0, len(html)
        pieces: list[str] = []
        linked, heading = 0, False

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    if stack and stack[-1][0] == "h1":
                        self.titles.append(node)
                    self.blocks.append((text, node, min(linked, len(text)), heading))
                pieces.clear()
            linked = 0

        def shut_to(k: int) -> None:
            for name, *_ in stack[k:]:
                opened[name] -= 1
            del stack[k:]

        while at < end:
            m = TAG.search(html, at)
            text = html[at : m.start() if m else end]
            if text:
                if "&" in text:
                    text = unescape(text)
                pieces.append(text)
                if links:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag, closing = m[2].lower(), m[1]
            if tag in RAW and not closing:
                if not m[3].endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.I).search(html, at)
                    at = stop.start() if stop else end
                continue
            if tag in UNREAD:
                if not closing:
                    if tag not in ends:
                        ends[tag] = matching_ends(html, tag)
                    at = ends[tag].get(m.start(), at)
                continue
            if tag == "a":
                links = 0 if closing else 1
                continue
            if tag == "br":
                pieces.append(" ")
                continue
            if tag == "hr":
                flush()
                continue
            if tag not in CONTAINERS and tag not in BLOCKS and tag != "head" and tag != "button":
                continue  # inline or void
            if tag == "button" and (not opened["button"] if closing else stack and stack[-1][0] in TEXT_BLOCKS):
                continue  # part of its paragraph
            if tag in ("td", "th"):
                pieces.append(" ")
            flush()
            if closing:
                for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                    if stack[k][0] == tag:
                        shut_to(k)
                        break
                    if stack[k][0] in ("article", "body") and tag != "html" and tag != "body":
                        break  # an end tag that has no start in here
            else:
                shut = CLOSES.get(tag) or (CLOSES["p"] if tag in BLOCKS or tag in CONTAINERS else set())
                limit = STOPS_CLOSING.get(tag, CONTAINERS)
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in shut:
                        shut_to(k)
                        break
                    if stack[k][0] in limit:
                        break
                if tag == "body":
                    while stack and stack[-1][0] == "head":
                        shut_to(len(stack) - 1)
                below, inside = stack[-1][1:] if stack else (0, False)
                if tag in CONTAINERS or tag in ("head", "button") or re.search("class|id|role|hidden|style", m[3]):
                    below = self._node(tag, m[3], below, inside)
                stack.append((tag, below, inside or tag in ("article", "main")))
                opened[tag] += 1
            node = stack[-1][1] if stack else 0
            links = 0
            heading = bool(stack) and stack[-1][0] in HEADINGS
        flush()

    def _unmark(self) -> None:
        """Take the marks off wrappers of the article."""
        soft = [k for k, kind in self.marks.items() if kind]
        if not soft:
            return
        size = len(self.parent)
        good, count, mains, articles, h1 = [0] * size, [0] * size, [0] * size, [0] * size, [0] * size
        for text, k, linked, _ in self.blocks:
            if len(text) > linked:
                good[k] += len(text) - linked
                count[k] += 1
        for k in self.titles:
            h1[k] += 1
        for k in range(size - 1, 0, -1):
            if self.marks.get(k, 2) < 2:  # what stands in surer marks doesn't speak for a wrapper, but main and h1 do
                good[k], count[k], articles[k], own = 0, 0, 0, good[k]
            else:
                own = good[k]
            mains[k] += self.tags[k] == "main" and own > 0
            articles[k] += self.tags[k] == "article" and own > 0
            for held in (good, count, mains, articles):
                held[self.parent[k]] += held[k]
            h1[self.parent[k]] += h1[k] if self.marks.get(k) != 0 else 0
        whole = [0] * size  # all unlinked text but that below marks for good
        for text, k, linked, _ in self.blocks:
            whole[k] += len(text) - linked
        for k in range(size - 1, 0, -1):
            whole[self.parent[k]] += whole[k] if self.marks.get(k) != 0 else 0
        clear = any(not self.outside[k] for k in self.titles)
        lifted = set()
        for k in soft:
            part = self.marks[k] == 2
            if mains[k] or part and articles[k] == articles[0] > 0 or part and count[k] > 1 and 2 * good[k] > good[0]:
                lifted.add(k)
            elif not clear and h1[k] and 4 * whole[k] >= whole[0] > 0:
                lifted.add(k)
        if lifted:
            for k in range(1, size):
                self.outside[k] = self.outside[self.parent[k]] or k in self.marks and k not in lifted

    def kept(self, block: tuple[str, int, int, bool]) -> bool:
        return not self.outside[block[1]] and (block[3] or not self.head[block[1]])

    def scores(self) -> dict[int, int]:
        """Score of every node that holds text of the article kind."""
        good, held = [0] * len(self.parent), [False] * len(self.parent)
        for b in self.blocks:
            good[b[1]] += len(b[0]) - 2 * b[2] if self.kept(b) else -len(b[0])
            held[b[1]] = True
        for k in range(len(self.parent) - 1, 0, -1):  # children come after their parents
            good[self.parent[k]] += good[k]
            held[self.parent[k]] |= held[k]
        return {k: good[k] for k in range(len(good)) if held[k] and not self.outside[k]}

    def below(self, roots: set[int]) -> list[str]:
        """The kept blocks that stand below any of the nodes, in page order."""
        inside = [False] * len(self.parent)
        for k in range(len(self.parent)):
            inside[k] = k in roots or (k > 0 and inside[self.parent[k]])
        return [b[0] for b in self.blocks if inside[b[1]] and self.kept(b)]


def best_node(page: Page, scores: dict[int, int]) -> int:
    """The node of the highest score, the deepest of equals, then the first."""
    return max(scores, key=lambda k: (scores[k], page.depth[k], -k), default=0)


def votes(html: str | None) -> dict[str, float]:
    """Share of the page's article text by path, for paths with at least half of it."""
    if not html:
        return {}
    page = Page(html)
    scores = page.scores()
    total = sum(len(b[0]) for b in page.blocks if page.kept(b))
    if not scores or total <= 0:
        return {}
    found: dict[int, float] = defaultdict(float)
    node = {}
    for k, n in scores.items():
        found[page.path[k]] += n / total
        node[page.path[k]] = k
    top = max(found.values())
    return {name_of(page, node[p]): min(v, 1.0) + (0.001 * page.depth[node[p]] if v == top else 0.0) for p, v in found.items() if v >= 0.5}


def name_of(page: Page, k: int) -> str:
    """A node's path as votes have it: its digest and its own label."""
    return f"{page.path[k]:016x}>{page.label[k]}"


def extract(html: str | None, winner: str | None) -> str:
    if not html:
        return ""
    page = Page(html)
    scores = page.scores()
    if not scores:
        return ""
    own = best_node(page, scores)
    path = int(winner[:16], 16) if winner else None
    roots = {k for k in scores if page.path[k] == path}
    if not roots or 2 * sum(scores[k] for k in roots) < scores[own]:
        roots = {own}
    return "\n".join(page.below(roots))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winner): the path with most votes of each host; equal votes go to the first path."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], list] = {}
            for host, html in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for path, share in votes(html.as_py()).items():
                    s = sums.setdefault((host, path), [0, 0])
                    s[0] += round(share * 1_000_000)
                    s[1] += 1
            keys = list(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k][0] for k in keys], pa.int64())], names=["host", "path", "votes"])

    cast = pages.select("host", "html").mapInArrow(vote, "host string, path string, votes long")
    ballots = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return ballots.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("w")).select("host", F.col("w.path").alias("winner"))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    named = pages.select("page_id", "url", "html", F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit("")).alias("host"))
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array((extract(h.as_py(), w.as_py()) for h, w in zip(b.column(2), b.column(3), strict=True)), pa.string(), size=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), text], names=["page_id", "url", "text"])

    lean_batches(pages.sparkSession)
    winners = materialize(host_paths(named), "html-hosts")
    few = winners.count() <= MOST_HOSTS
    return named.join(F.broadcast(winners) if few else winners, "host", "left").select("page_id", "url", "html", "winner").mapInArrow(run, f"page_id {kind}, url string, text string")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
