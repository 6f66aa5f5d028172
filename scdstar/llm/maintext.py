"""HTML extraction by line-block distribution.

1. **Strip markup.** A page becomes lines: block elements end a line; comments, scripts,
   styles and the head go, and so do menus, headers, footers, asides, hidden elements, forms and
   elements whose class, id or role names boilerplate (compounds such as ``with-sidebar`` or
   ``share-enabled`` name a state, not the element). A form or an element with a name is taken
   for a wrapper, and stays, if it holds most of the page's text and all of its articles, and is
   rich neither in links nor in controls; names of what can be long, such as comments or adverts,
   only with a ``main`` or ``h1`` inside. If too little is left to surge, wrappers that hold more
   than that together stay; if nothing is left, whatever holds text, but for menus and the like.
2. **Distribution.** A line weighs its characters outside links. Weights are added over windows
   of ``WINDOW`` lines. Page furniture and the bounds of an ``article`` or ``main`` stand as
   ``WINDOW`` empty lines; adverts, forms and the like within a text leave no gap.
3. **Surge and dive.** A region starts with the first line of a window that rises over ``SURGE``,
   and ends where a window falls to zero. The heaviest stays, and those at least ``RIVAL`` times
   as heavy. Text in an ``article`` or ``main`` counts ``FAVOUR`` times for surges and for
   which is the heaviest; it takes nothing from the lines outside.
4. **Container.** With the heaviest region stays what shares its container: all of its ``main``, or
   its ``article`` and the articles beside that; elsewhere the lines with text outside links of the
   innermost element that holds most of the region, but for articles inside. Of the body itself,
   those are the lines that no other element holds.

Kept lines have character references decoded, white space turned into single spaces, and are
joined by newlines in page order. Nothing is cut to a length.

Malformed pages: an unclosed comment or script runs to the end, an end tag closes what is
open inside its element or is ignored, a paragraph ends where the next block starts, and an
article that starts inside a menu, a header or a control ends that.

Defined results: a null or empty html gives an empty text, as does a page in which no window
surges, unless it has any text outside boilerplate: then all of that. Rows stay as many as they
were. Further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from scdstar.llm.shingles import arrow_batches

#: Lines to a window, characters that make a surge, share of the heaviest region.
WINDOW, SURGE, RIVAL = 3, 80, 0.3
#: How often text in an article counts, and characters to a control of a form that is text.
FAVOUR, CONTROL = 2, 60

#: What a page's markup consists of: raw elements whole, then comments, tags, declarations.
_MARKUP = re.compile(
    r"<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|object"
    r"|annotation(?:-xml)?)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)|<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: The attribute itself; a class may be called so for small screens only.
_HIDDEN = re.compile(r"(?:\s|^)hidden(?:[\s=/]|$)", re.I)
_UNSHOWN = re.compile(r"\bstyle\s*=\s*[\"']?[^\"']*display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_VALUES = re.compile(r"\"[^\"]*\"|'[^']*'")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_DROPPED = frozenset(
    "head nav header footer aside button select menu dialog audio video canvas map"
    " search option datalist".split()
)
_FORMS = frozenset(("form", "fieldset"))
#: Words in a class, id or role that mark boilerplate, but that wrappers of a page have as well.
_LOOSE = frozenset(
    "alert banner footer form header login masthead menu menubar modal nav navbar navigation newsletter"
    " notice notification pagination popup reviews search share sharing sidebar signup skip social subscribe"
    " tags toolbar widget".split()
)
#: Words that mark boilerplate however long it is.
_FIRM = frozenset(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs comment comments"
    " commentlist complementary contentinfo cookie cookies consent copyright disclaimer disqus"
    " discussion feedback gdpr paywall promo promotion recommended related replies respond responses"
    " sponsor sponsored".split()
)
#: Of these, words that are headings of texts as well: judged by what a section holds.
_HEADINGS = frozenset(("discussion", "related"))
#: First and last words of compounds that name a state or a subject.
_STATE_FIRST = frozenset("with without no not has have hide".split())
_STATE_LAST = frozenset("enabled disabled open opened closed on off".split())
_SUBJECT_FIRST = frozenset(("tag", "category"))
#: What stands inside a text, so that its removal leaves no gap.
_INLINE = frozenset(
    "form fieldset aside button select audio video canvas map option datalist dialog alert"
    " ad ads advert adverts advertisement advertising adsense banner login newsletter notice"
    " notification pagination paywall popup promo promotion recommended related share sharing signup"
    " social sponsor sponsored subscribe tags toolbar widget".split()
)
_MAIN = frozenset(("article", "main"))
_CONTROLS = frozenset("input button select textarea option label".split())
#: Elements that can hold a whole text.
_HOLDERS = frozenset("html body div section article main form fieldset center td details".split())
_OWN_CLOSE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
              "td": ("tr",), "th": ("tr",), "option": ("select",)}


#: Why an element may be dropped: not, by what it is, by a word of either kind or as a form, hidden, or
#: as a section whose name may be a heading.
STAYS, ALWAYS, FIRM, LOOSE, HIDDEN, HEADING = range(6)


def _words(tag: str, attributes: str) -> Iterator[str]:
    """Words of the classes, ids and roles, without compounds that name a state, or for an
    article its subject."""
    for found in _NAMES.findall(attributes):
        for name in "".join(found).split():
            words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
            words = [w for w in words if w]
            if len(words) > 1 and (words[0] in _STATE_FIRST or words[-1] in _STATE_LAST):
                continue
            if len(words) > 1 and tag in _MAIN and words[0] in _SUBJECT_FIRST:
                continue
            yield from words


def _boilerplate(tag: str, attributes: str) -> tuple[int, bool]:
    """Why an element may have to go, and whether that leaves a gap."""
    if tag in _DROPPED:
        return ALWAYS, tag not in _INLINE
    kind, gap = (LOOSE, False) if tag in _FORMS else (STAYS, False)
    if not attributes or tag in ("html", "body"):
        return kind, gap
    if tag not in _MAIN and (
        _HIDDEN.search(_VALUES.sub('""', attributes)) or _UNSHOWN.search(attributes)
    ):
        return HIDDEN, False
    for word in _words(tag, attributes):
        if word in _FIRM or word in _LOOSE:
            gap = gap or word not in _INLINE
            if tag == "section" and word in _HEADINGS and kind in (STAYS, HEADING):
                kind = HEADING
            else:
                kind = FIRM if word in _FIRM or kind in (FIRM, HEADING) else LOOSE
    return kind, gap


class _Node:
    """A block or a possibly dropped element."""

    __slots__ = ("tag", "up", "kind", "gap", "plain", "linked", "controls", "heads", "lines",
                 "sheltered", "inside", "kept", "dropped", "article", "main", "held", "part")

    def __init__(self, tag: str, up: int, kind: int = STAYS, gap: bool = False) -> None:
        self.tag, self.up, self.kind, self.gap = tag, up, kind, gap
        self.plain = self.linked = self.controls = self.heads = self.lines = self.part = 0
        #: Characters in articles, and whether one is around; those of the wrapper around.
        self.sheltered, self.inside, self.kept = 0, False, 0
        self.dropped = False
        #: The outermost article and main, and the innermost holder of several lines; or -1.
        self.article = self.main = self.held = -1


class _Lines:
    """The lines of a page, each with its weight and node, and the tree of nodes."""

    def __init__(self) -> None:
        #: Text, weight, node; a text of None is where a gap may be.
        self.done: list[tuple[str | None, int, int]] = []
        self.held: list[str] = []
        self.linked = 0
        self.nodes = [_Node("", -1)]
        #: Open elements, each with its node or the one it lies in, and whether a link holds it.
        self.open: list[tuple[str, int, bool]] = []
        self.at, self.link = 0, False

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        if text:
            weight, node = max(len(text) - self.linked, 0), self.nodes[self.at]
            self.done.append((text, weight, self.at))
            node.plain += weight
            node.linked += len(text) - weight
            node.heads += node.tag == "h1"
        self.held, self.linked = [], 0

    def text(self, raw: str) -> None:
        if raw:
            found = html.unescape(raw)
            self.held.append(found)
            if self.link:
                self.linked += len(" ".join(found.split()))

    def _pop(self, at: int) -> None:
        if any(e[0] in _BLOCKS or self.nodes[e[1]].kind and self.nodes[e[1]].tag == e[0] for e in self.open[at:]):
            self.flush()
        for _, k, _ in reversed(self.open[at:]):
            if self.nodes[k].gap:
                self.done.append((None, 0, k))
        del self.open[at:]
        self.at, self.link = self.open[-1][1:] if self.open else (0, False)

    def _find(self, tag: str, barriers: tuple[str, ...] = ()) -> int | None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                return k
            if self.open[k][0] in barriers:
                return None
        return None

    def start(self, tag: str, attributes: str) -> None:
        if tag in _BLOCKS:
            if (at := self._find("p", ("table", "button", "object"))) is not None:
                self._pop(at)
            self.flush()
        if tag in _OWN_CLOSE and (at := self._find(tag, _OWN_CLOSE[tag])) is not None:
            self._pop(at)
        if tag == "br":
            self.text(" ")
        if tag in _CONTROLS and not re.search(r"type\s*=\s*[\"']?hidden", attributes, re.I):
            self.nodes[self.at].controls += 1
        if tag in _VOID:
            return
        if tag in _MAIN:  # these hold none, so their end tag is missing
            for k, (name, _, _) in enumerate(self.open):
                if name in ("nav", "menu", "header", "button", "select"):
                    self._pop(k)
                    break
        kind, gap = _boilerplate(tag, attributes)
        if kind:
            self.flush()
        if kind or tag in _BLOCKS:
            self.nodes.append(_Node(tag, self.at, kind, gap or tag in _MAIN))
            self.at = len(self.nodes) - 1
            self.nodes[self.at].heads += tag == "main"
            if tag in _MAIN:
                self.done.append((None, 0, self.at))
        self.link = self.link or tag == "a"
        self.open.append((tag, self.at, self.link))

    def end(self, tag: str) -> None:
        at = self._find(tag)
        if at is None:
            if tag in _BLOCKS:
                self.flush()
        else:
            self._pop(at)

    def _drop(self, stays: Callable[[_Node], bool], freed: frozenset[str] = frozenset()) -> bool:
        """Mark nodes as dropped unless they stay, and what is around them stays or they
        are of the ``freed`` tags; whether a line is left."""
        for node in self.nodes[1:]:
            up = self.nodes[node.up]
            node.kept, node.dropped = up.kept, up.dropped and node.tag not in freed
            if node.kind and not node.dropped:
                if stays(node) and 2 * node.plain > up.kept:
                    node.kept = node.plain
                else:
                    node.dropped = True
        return any(text and not self.nodes[k].dropped for text, _, k in self.done)

    def judge(self) -> None:
        """Tell wrappers from boilerplate, with what nodes hold."""
        nodes = self.nodes
        for node in nodes[1:]:
            node.inside = node.tag in _MAIN or nodes[node.up].inside
        for node in reversed(nodes[1:]):  # what a node holds comes after it
            if node.kind == HEADING:  # prose of the article around it, without links, forms or cards
                prose = node.inside and node.plain > 0 and not node.linked + node.controls + node.sheltered
                node.kind = STAYS if prose else FIRM
            if node.tag in _MAIN:
                node.sheltered = node.plain
            if node.kind in (ALWAYS, HIDDEN) or node.kind == FIRM and not node.heads:
                continue
            up = nodes[node.up]
            up.plain += node.plain
            up.linked += node.linked
            up.controls += node.controls
            up.heads += node.heads
            up.sheltered += node.sheltered
        total, sheltered = nodes[0].plain, nodes[0].sheltered

        def texts(node: _Node) -> bool:
            return 0 < node.plain >= max(node.linked, CONTROL * node.controls)

        def wraps(node: _Node) -> bool:
            return (
                (node.kind == LOOSE or node.kind == FIRM and node.heads > 0)
                and node.plain > SURGE and 2 * node.plain > total and texts(node)
                and (node.inside or node.sheltered == sheltered)
            )

        def loose(node: _Node) -> bool:
            return node.kind == LOOSE and texts(node)

        if self._drop(wraps):
            left = [(w, nodes[k]) for text, w, k in self.done if text and not nodes[k].dropped]
            few = sum(w for w, _ in left)
            if few > SURGE or total - few <= SURGE or any(n.inside for _, n in left):
                return
            self._drop(loose)
        elif not (
            self._drop(loose)
            or self._drop(lambda n: n.kind in (FIRM, LOOSE) and texts(n))
            or self._drop(lambda n: n.kind in (FIRM, LOOSE) and n.plain > 0)
            or self._drop(lambda n: False, _MAIN)
        ):
            self._drop(lambda n: n.kind == HIDDEN and texts(n))

    def rows(self) -> list[tuple[str, int, int]]:
        """Lines that are left, with empty ones for gaps."""
        out = []
        for text, weight, k in self.done:
            node = self.nodes[k]
            if text is None:
                if not self.nodes[node.up].dropped and (node.dropped or node.tag in _MAIN):
                    out += [("", 0, 0)] * WINDOW
            elif not node.dropped:
                out.append((text, weight, k))
        return out

    def place(self, rows: list[tuple[str, int, int]]) -> None:
        """Tell each node its article, main and holder."""
        nodes = self.nodes
        for text, _, k in rows:
            nodes[k].lines += text != ""
        for node in reversed(nodes[1:]):
            nodes[node.up].lines += node.lines
        nodes[0].held = 0
        for k, node in enumerate(nodes[1:], 1):
            up = nodes[node.up]
            node.article = k if up.article < 0 and node.tag == "article" else up.article
            node.main = k if up.main < 0 and node.tag == "main" else up.main
            node.held = k if node.tag in _HOLDERS and node.lines > 1 else up.held


def _beside(lines: _Lines, rows: list[tuple[str, int, int]], region: tuple[int, int]) -> set[int]:
    """Rows that share the container of a region."""
    nodes, first = lines.nodes, lines.nodes[rows[region[0]][2]]
    if first.main >= 0:
        return {i for i, (text, _, k) in enumerate(rows) if text and nodes[k].main == first.main}
    if first.article >= 0:
        up = nodes[first.article].up
        return {
            i for i, (text, _, k) in enumerate(rows)
            if text and nodes[k].article >= 0 and nodes[nodes[k].article].up == up
        }
    for text, weight, k in rows[slice(*region)]:
        nodes[k].part += weight
    for node in reversed(nodes[1:]):
        nodes[node.up].part += node.part
    held = max((k for k, n in enumerate(nodes) if n.held == k and 2 * n.part > nodes[0].part), default=0)
    whole = nodes[held].tag not in ("", "html", "body")
    within = [False] * len(nodes)
    for k, node in enumerate(nodes):
        within[k] = node.held == held or whole and (k == held or k > 0 and within[node.up])
    out: set[int] = set()
    linked: list[int] = []
    for i, (text, weight, k) in enumerate(rows):
        if not text or not within[k] or nodes[k].article >= 0 or nodes[k].main >= 0:
            continue
        if weight:
            out.add(i)
            if 0 < len(linked) < WINDOW and len(out) > 1:
                out.update(linked)
            linked = []
        else:
            linked.append(i)
    if len(linked) == 1 and out and nodes[rows[linked[0]][2]].tag == "p":
        out.update(linked)  # a paragraph that is one link, where menus are lists
    return out


def _regions(weights: list[int]) -> list[tuple[int, int]]:
    """Half-open ranges of lines between a surge and the dive after it."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    out, start = [], None
    for i, total in enumerate(sums):
        if start is None and total > SURGE:
            start = next(k for k in range(i, len(weights)) if weights[k])
        elif start is not None and total == 0 and i >= start:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, len(weights)))
    return out


def main_text(page: str | None) -> str:
    lines, at, page = _Lines(), 0, page or ""
    for m in _MARKUP.finditer(page):
        lines.text(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if (m["raw"] or "").lower() in ("textarea", "iframe", "title"):
                lines.flush()
        elif m["end"]:
            lines.end(tag)
        else:
            lines.start(tag, m["attributes"])
    lines.text(page[at:])
    lines.flush()
    lines.judge()
    rows = lines.rows()
    lines.place(rows)
    nodes = lines.nodes
    favoured = [
        w * FAVOUR if nodes[k].article >= 0 or nodes[k].main >= 0 else w for _, w, k in rows
    ]
    regions = _regions(favoured)
    if not regions:
        return "\n".join(text for text, _, _ in rows if text)
    heaviest = max(regions, key=lambda r: sum(favoured[slice(*r)]))
    least = RIVAL * sum(w for _, w, _ in rows[slice(*heaviest)])
    kept = _beside(lines, rows, heaviest)
    for a, b in regions:
        if (a, b) == heaviest or sum(w for _, w, _ in rows[a:b]) >= least:
            kept.update(range(a, b))
    return "\n".join(rows[i][0] for i in sorted(kept) if rows[i][0])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of ``pages(page_id, url, html)``."""
    arrow_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    )
