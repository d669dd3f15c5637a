"""Main text of web pages by the container path that the pages of a host agree on.

Every page scores its containers by the text of their own blocks outside links
and boilerplate, and votes for the path of tags and generalised classes of the
best one, or of the container around it that is the article in full: one with a
title, a lead or other text of its own, or with further sections or containers
of the same step beside the best one. Spark adds up the votes of each host; pages then take the
text of all containers on their host's path in page order, or on their own best
path where the page has no such container. A host of any size only meets its votes, added up before the
shuffle, and one row with its path. The table of paths is broadcast if it has
few rows; else pages and paths meet by host and salt, so that a host with a
third of all pages is spread over many tasks.

Left out: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments, by element, by role, and by class or id. A class or id
counts if it consists of boilerplate words and words of layout only ("ad-slot-2",
not "share-of-votes"); a name with other words beside a boilerplate one
only marks a box outside articles, which goes if half of its text is links. Ids of
headings, sections and text blocks never count, as they are made from titles. Character
references are decoded, white space in a block becomes one space, blocks are
joined by an empty line. Formulas, labels of drawings and the fallback text of
objects, canvases and media are text like any other; of a formula only its
annotations go, which repeat it in another notation and are not shown.

Defined cases: null and empty pages, and pages without text, give the empty
text; a null url is a host of its own; a null page_id stays null; repeated rows
are kept; of equally voted paths the one with the smaller text wins; an empty
table gives no rows; other columns are ignored. A page of any length or nesting
is read in time and memory in proportion to it.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import ready, slices, work_dir, written

#: Hosts whose paths are broadcast (a row is a few hundred bytes); beyond that, the salts of a host.
BROADCAST_HOSTS, SALTS = 200_000, 32

_MARKUP = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*>)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"""
                     r"""(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements of the HTML standard, by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes noembed iframe xmp".split())
SKIPPED = frozenset("script style textarea title noscript template head nav footer aside form button select option "
                    "iframe embed dialog menu noframes noembed datalist annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("html body main article section div td center".split())
#: Labels of drawings and cells of formulas, set apart by white space.
SPACED = frozenset("text mtr mtd".split())
#: An open element of the key is closed by the start of one of these.
CLOSED_BY = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody"},
             "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "option": {"option"}, "head": {"body"}}
#: Elements that hide open elements outside them from a start tag that would close those.
SCOPES = CONTAINERS | {"table", "ul", "ol", "dl", "blockquote"}
_RAW_END = {tag: re.compile(rf"</{tag}\s*>?", re.I) for tag in RAW}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of classes and ids that mark boilerplate, and words that overrule them.
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
                        "aside menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer comment "
                        "comments disqus replies respond cookie cookies consent gdpr notice popup modal overlay newsletter "
                        "subscribe signup share sharing social related recommended recommendations widget toolbar "
                        "pagination pager login search form".split())
CONTENT = frozenset("article content main post entry story text body column page wrapper container".split())
#: Words that say where a box stands or how it looks; a name of these and boilerplate words means boilerplate.
LAYOUT = frozenset("area bar block box bottom button buttons card center col column container desktop fixed floating form global "
                   "grid icon icons inner item items js latest layout left link links list main mobile module outer page "
                   "panel popular posts primary recent right row secondary section site slot sticky stories strip "
                   "top unit wrap wrapper".split())
#: Elements whose ids are made from the titles of the text.
TITLED = HEADINGS | frozenset("section p table li dt dd td th tr pre blockquote figure span a caption code".split())
#: Share of a doubtful box's text that is links, from which on it is left out.
LINKED = 0.5
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())


class Element:
    __slots__ = ("tag", "path", "parent", "skipped", "container", "in_article", "in_link", "closable", "doubt")

    def __init__(self, tag, path, parent, skipped, in_article, in_link):
        self.tag, self.path, self.parent, self.skipped = tag, path, parent, skipped
        self.in_article, self.in_link = in_article, in_link
        self.container = self.closable = self.doubt = None


def _step(tag: str, classes: str) -> str:
    """One step of a path: the tag and its classes in order, with digits generalised."""
    return ".".join([tag, *sorted({_DIGITS.sub("#", c.lower()) for c in classes.split()})])


def _ends_in_value(rest: str) -> bool:
    """True if a tag's last slash belongs to a value without quotes and does not close the element."""
    last = rest.split()[-1]
    return "=" in last and last[-2:-1] not in ("'", '"')


KEPT, DOUBTFUL, DROPPED = 0, 1, 2


def _named(name: str) -> int:
    """What a class or id says: boilerplate by all of its words, by some of them, or not at all."""
    words = {w.lower() for w in _WORDS.findall(name) if not w.isdigit()}
    if not words & BOILERPLATE:
        return KEPT
    return DROPPED if words <= BOILERPLATE | LAYOUT else DOUBTFUL


def _judged(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """Whether an element is boilerplate by what it is and how it is named."""
    if tag in SKIPPED or (tag == "header" and not in_article):
        return DROPPED
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return DROPPED
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return DROPPED
    if tag in ("html", "body", "main", "article"):
        return KEPT
    classes = attributes.get("class", "").split()
    if any({w.lower() for w in _WORDS.findall(c)} & CONTENT and _named(c) == KEPT for c in classes):
        return KEPT
    names = classes if tag in TITLED else [*classes, attributes.get("id", "")]
    said = max(map(_named, names), default=KEPT)
    return KEPT if said == DOUBTFUL and (in_article or tag in TITLED) else said


class Page:
    """Text pieces of a page with the element they stand in and the block they belong to."""

    def __init__(self, source: str):
        self.steps: dict[tuple[int, str], int] = {}  # number of a path by that of the path above it and its last step
        self.paths: list[tuple[int, str]] = [(-1, "")]
        self.root = Element("", 0, None, False, False, False)
        self.root.container, self.root.closable = self.root, {}
        self.elements: list[Element] = [self.root]
        self.pieces: list[tuple[Element, int, str]] = []
        self.block = 0
        self._read(source)
        self._settle_doubts()

    def path_of(self, element: Element) -> str:
        at, steps = element.path, []
        while at > 0:
            at, step = self.paths[at]
            steps.append(step)
        return "".join(f"/{step}" for step in reversed(steps))

    def _open(self, top: Element, tag: str, rest: str) -> Element:
        attributes = {}
        if "=" in rest or rest.strip(" /\n"):
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), html.unescape(a or b or c))
        in_article = top.in_article or tag in ("article", "main")
        said = KEPT if top.skipped else _judged(tag, attributes, in_article)
        key = (top.path, _step(tag, attributes.get("class", "")))
        path = self.steps.get(key)
        if path is None:
            path = self.steps[key] = len(self.paths)
            self.paths.append(key)
        own = Element(tag, path, top, top.skipped or said == DROPPED, in_article, top.in_link or tag == "a")
        own.container = own if tag in CONTAINERS else top.container
        own.doubt = own if said == DOUBTFUL else top.doubt
        # of the open elements that a start tag may close the innermost of each kind; containers and tables hide those outside
        own.closable = {} if tag in SCOPES else top.closable
        if tag in CLOSED_BY:
            own.closable = {t: e for t, e in own.closable.items() if t != tag} | {tag: own}
        self.elements.append(own)
        return own

    def _read(self, source: str) -> None:
        at, top, n = 0, self.root, len(source)
        open_tags: Counter[str] = Counter()

        def closed_up_to(node: Element) -> Element:
            """Close the elements from ``top`` up to ``node``; what was around that one."""
            e = top
            while True:
                open_tags[e.tag] -= 1
                if e is node:
                    return e.parent
                e = e.parent

        while at < n:
            m = _MARKUP.search(source, at)
            stop = m.start() if m else n
            if stop > at and not top.skipped:
                self.pieces.append((top, self.block, source[at:stop]))
            if not m:
                break
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if tag in BLOCKS:
                self.block += 1
            elif tag in SPACED and not top.skipped:
                self.pieces.append((top, self.block, " "))
            if m["close"]:
                if open_tags[tag] > 0:
                    node = top
                    while node.tag != tag:
                        node = node.parent
                    top = closed_up_to(node)
                continue
            while ended := self._ended(top, tag):
                top = closed_up_to(ended)
            if tag in VOID:
                if tag == "br" and not top.skipped:
                    self.pieces.append((top, self.block, " "))
                continue
            if tag in ("html", "body") and open_tags[tag] > 0:
                continue
            own = self._open(top, tag, m["rest"])
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.end() if end else n
                continue
            if not m["rest"].endswith("/") or tag in BLOCKS or _ends_in_value(m["rest"]):
                top = own
                open_tags[tag] += 1

    @staticmethod
    def _ended(top: Element, tag: str) -> Element | None:
        """The innermost open element that the start of ``tag`` closes."""
        found = None
        for open_tag, element in top.closable.items():  # outer ones first
            if tag in CLOSED_BY[open_tag]:
                found = element
        return found

    def _settle_doubts(self) -> None:
        """Doubtful boxes whose text is links for the most part are boilerplate, the others are not."""
        texts: dict[Element, list[int]] = {}
        for node, _, text in self.pieces:
            if node.doubt:
                held = texts.setdefault(node.doubt, [0, 0])
                size = len(text.strip())
                held[0] += size
                held[1] += size * node.in_link
        if not texts:
            return
        gone = set()
        for e in reversed(self.elements):  # inner boxes before those around them
            if e.doubt is e and e in texts:
                total, linked = texts[e]
                if linked >= LINKED * total:
                    gone.add(e)
                outer = e.parent.doubt
                if outer:
                    held = texts.setdefault(outer, [0, 0])
                    held[0] += total
                    held[1] += linked
        if gone:
            for e in self.elements[1:]:
                e.skipped = e.skipped or e in gone or e.parent.skipped
            self.pieces = [p for p in self.pieces if not p[0].skipped]

    def _ancestors(self, node: Element):
        while node is not None:
            yield node
            node = node.parent

    def scores(self) -> dict[Element, float]:
        """Text of each container: its own blocks in full, those of the containers in it by half, and so on."""
        out: dict[Element, float] = {}
        for node, _, text in self.pieces:
            if node.in_link:
                continue
            weight = float(len(text.strip()))
            box = node.container
            while weight >= 1 and box is not None:
                out[box] = out.get(box, 0.0) + weight
                weight /= 2
                box = box.parent.container if box.parent else None
        return out

    def holding(self) -> set[Element]:
        """Containers with text outside links, their own or that of containers in them."""
        out: set[Element] = set()
        for node, _, text in self.pieces:
            box = node.container
            if node.in_link or box in out or not html.unescape(text).strip():
                continue
            while box is not None and box not in out:
                out.add(box)
                box = box.parent.container if box.parent else None
        return out

    def speaking(self) -> set[Element]:
        """Containers with text outside links of their own, not only in containers in them."""
        return {node.container for node, _, text in self.pieces if not node.in_link and html.unescape(text).strip()}

    def best(self) -> tuple[Element, float] | None:
        """The container with the most text, the first of equals, or the container around it that is the whole article.

        Of an article or main element around it the innermost one counts at least.
        From there on the container around it counts as long as it has text of its own
        (a title, a lead), or other sections, articles or containers of the same
        step as the one before with text.
        """
        scores = {e: s for e, s in self.scores().items() if s > 0}
        if not scores:
            return None
        own = max(scores, key=scores.get)
        holding, speaking = self.holding(), self.speaking()
        beside = Counter((e.parent.container, e.path) for e in holding if e.parent)
        held = Counter(e.parent.container for e in holding if e.parent)
        parts = Counter(e.parent.container for e in holding if e.parent and e.tag in ("section", "article"))
        inner = [e for e in self._ancestors(own) if e.tag in ("article", "main")]
        box = at = inner[0] if inner else own
        while at.parent:
            outer = at.parent.container
            if outer in speaking or beside[outer, at.path] > 1 or parts[outer] > (at.tag in ("section", "article")):
                box = outer
            elif held[outer] > 1:
                break
            at = outer  # one that only wraps the last one is passed
        return box, scores[own]

    def _matching(self, path: str) -> list[bool]:
        """For each of the page's paths whether it is ``path``."""
        upto, out = [0], [path == ""]  # how much of ``path`` a path covers; -1: it differs
        for above, step in self.paths[1:]:
            begin = upto[above]
            upto.append(begin + len(step) + 1 if begin >= 0 and path.startswith(f"/{step}", begin) else -1)
            out.append(upto[-1] == len(path))
        return out

    def holds(self, path: str) -> bool:
        """True if a container on the path has text outside links."""
        on_path = self._matching(path)
        return any(on_path[e.path] for e in self.holding())

    def text(self, path: str) -> str:
        """Blocks of all containers on the path, in page order and without boilerplate.

        A header of the article goes except for its headline.
        """
        on_path = self._matching(path)
        taken: dict[Element, bool] = {}
        in_header: dict[Element, bool] = {}
        for e in self.elements:  # outer ones first
            begins = on_path[e.path]
            taken[e] = begins or (e.parent is not None and taken[e.parent])
            in_header[e] = not begins and (e.tag == "header" or (
                e.parent is not None and in_header[e.parent] and e.tag not in HEADINGS))
        blocks: list[tuple[int, list[str]]] = []
        for node, number, piece in self.pieces:
            if not taken[node] or in_header[node]:
                continue
            if not blocks or blocks[-1][0] != number:
                blocks.append((number, []))
            blocks[-1][1].append(piece)
        lines = (" ".join(html.unescape("".join(pieces)).split()) for _, pieces in blocks)
        return "\n\n".join(line for line in lines if line)


def vote(source: str | None) -> tuple[str, float] | None:
    """Path and score of the page's best container."""
    page = Page(source or "")
    best = page.best()
    return (page.path_of(best[0]), best[1]) if best else None


def extract(source: str | None, path: str | None = None) -> str:
    """Main text of a page from the containers on ``path``, or on the path of its best one."""
    page = Page(source or "")
    if path is None or not page.holds(path):
        best = page.best()
        if best is None:
            return ""
        path = page.path_of(best[0])
    return page.text(path)


def host_of(url: Column) -> Column:
    """Lower-case host of a url, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """host and path: of each host the path with the most votes, by the score that its pages give it."""

    def run(batches):
        for part in slices(batches, "html"):
            votes: dict[tuple[str, str], float] = {}
            for host, source in zip(part["host"].to_pylist(), part["html"].to_pylist()):
                if own := vote(source):
                    # a page's length counts by its logarithm only, so that many pages outvote a long one
                    key = (host, own[0])
                    votes[key] = votes.get(key, 0.0) + float(int(own[1]).bit_length())
            if votes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()),
                     pa.array(list(votes.values()), pa.float64())], names=["host", "path", "votes"])

    return (pages.select("host", "html").mapInArrow(run, "host string, path string, votes double")
            .groupBy("host", "path").agg(F.sum("votes").alias("votes"))
            .groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("votes"), "path")).alias("best"))
            .select("host", F.col("best.path").alias("path")))


def with_paths(pages: DataFrame, paths: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Pages (with host) and their host's path; ``paths`` is a table on shared storage."""
    if paths.count() <= broadcast_hosts:
        return pages.join(F.broadcast(paths), "host", "left")
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    copies = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["host", "salt"], "left")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ready(pages.sparkSession)
    table = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))

    def run(batches):
        for part in slices(batches, "html"):
            texts = [extract(s, p) for s, p in zip(part["html"].to_pylist(), part["path"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    paths = written(host_paths(table), work_dir(pages.sparkSession, "host-paths"))
    return (with_paths(table, paths, broadcast_hosts).select("page_id", "url", "html", "path")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
