"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding."""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import hashed_sample, schema

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style template svg iframe select textarea button title annotation annotation-xml".split())
RAW = {"script", "style", "iframe", "textarea", "title"}  # their content is no markup
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BLOCKS = ENDS_P | set("body caption dd dt li tbody td tfoot th thead tr".split())
SCOPES = set("ul ol dl table article section div body html td th main aside nav".split())
MAIN_WORDS = tuple("article content entry main post story text body blog".split())
SIDE_WORDS = tuple(
    "ad ads advert advertisement banner breadcrumb comment comments consent cookie disqus footer form header login menu "
    "modal nav navbar navigation newsletter notice pager pagination popup promo recommended related reply share sidebar "
    "signup social sponsor sponsored subscribe tags toolbar widget".split()
)
FAMILIES = (
    {"article", "main"}, {"nav", "footer", "header", "aside", "menu", "dialog"}, {"form", "fieldset", "input"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"p", "blockquote", "pre"}, {"ul", "ol", "li", "dl", "dt", "dd"},
    {"table", "tr", "td", "th", "tbody", "thead"},
)
GROUP = 200  # pages judged at a time
SPACE = re.compile(r"\s+")
TOKEN = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "depth")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []
        self.depth = parent.depth + 1 if parent else 0


def _skips(events: list[tuple]) -> dict[int, int]:
    """For the start of each skipped element, the place of the first event after it and its content.

    An element with an end tag of its own reaches up to that. One without ends before the
    next block tag or its parent's end tag, but script and style take all the rest.
    """
    blocks = [i for i, (kind, tag, _) in enumerate(events) if kind == "start" and tag in BLOCKS]
    raw = {tag: [i for i, e in enumerate(events) if e[0] != "data" and e[1] == tag] for tag in RAW}
    out, stack, count, i = {}, [], Counter(), 0

    def unclosed(at: int, end: int) -> None:
        block = bisect_right(blocks, at)
        out[at] = min(end, blocks[block] if block < len(blocks) else end)

    while i < len(events):
        kind, tag, _ = events[i]
        i += 1
        if kind == "start" and tag in RAW:
            after = bisect_right(raw[tag], i - 1)
            end = raw[tag][after] if after < len(raw[tag]) else None
            if end is not None and events[end][0] == "end":
                out[i - 1] = i = end + 1
            elif tag in ("script", "style"):
                out[i - 1] = i = len(events)
            else:
                stack.append((tag, i - 1))
                count[tag] += 1
        elif kind == "start" and tag not in VOID:
            stack.append((tag, i - 1))
            count[tag] += 1
        elif kind == "end" and count[tag]:
            while True:
                last, at = stack.pop()
                count[last] -= 1
                if last == tag:
                    if tag in SKIPPED:
                        out[at] = i
                    break
                if last in SKIPPED:
                    unclosed(at, i - 1)
    for last, at in stack:
        if last in SKIPPED:
            unclosed(at, len(events))
    return out


class _Builder(HTMLParser):
    """A tree of block nodes; ``items`` holds child nodes and (text, in a link) in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html")
        self.events: list[tuple] = []
        self.links = 0
        self.open: Counter = Counter()  # tags of the nodes from the root to ``at``

    def parse_marked_section(self, i, report=1):
        """``<![...`` of any kind is a comment up to the next ``>``, as in browsers."""
        return self.parse_bogus_comment(i, 0)

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, attrs))

    def handle_endtag(self, tag):
        self.events.append(("end", tag, None))

    def handle_data(self, data):
        self.events.append(("data", data, None))

    def build(self) -> Node:
        skips, i = _skips(self.events), 0
        while i < len(self.events):
            kind, tag, attrs = self.events[i]
            if i in skips:
                i = skips[i]
                continue
            if kind == "start":
                self._start(tag, attrs)
            elif kind == "end":
                self._end(tag)
            elif tag:
                self.at.items.append((tag, self.links))
            i += 1
        return self.root

    def _start(self, tag, attrs):
        if tag == "a":
            self.links = 1
        elif tag in VOID:
            if tag in ("br", "hr", "img"):
                self.at.items.append((" ", 0))
        elif tag not in INLINE and tag not in ("html", "head", "body"):
            if tag in ENDS_P:
                self._close({"p"}, SCOPES)
            if tag in SIBLINGS:
                self._close(SIBLINGS[tag], SCOPES - SIBLINGS[tag])
            named = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label"))
            hidden = any(k == "hidden" or k == "style" and v and "display:none" in v.replace(" ", "").lower() for k, v in attrs)
            node = Node(tag, named + (" popup" if hidden else ""), self.at)
            self.at.items.append(node)
            self.at, self.links = node, 0
            self.open[tag] += 1

    def _leave(self, node) -> None:
        """Go up to the parent of ``node``, an open one."""
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _close(self, tags, scopes) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self._leave(node)
                return
            if node.tag in scopes:
                return
            node = node.parent

    def _end(self, tag):
        if tag == "a":
            self.links = 0
            return
        if not self.open[tag]:
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._leave(node)
        self.links = 0


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.build()


def nodes_of(root: Node) -> list[Node]:
    """All nodes, parents first, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def _words(attrs: str) -> tuple[int, int]:
    tokens = TOKEN.findall(attrs)
    return sum(t in MAIN_WORDS for t in tokens), sum(t in SIDE_WORDS for t in tokens)


def features(nodes: list[Node]) -> np.ndarray:
    """One row a node: subtree density, attribute words, depth, siblings, tag family; also of the ancestors."""
    place = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    own, linked, count, marks = (np.zeros(n) for _ in range(4))
    for i, node in enumerate(nodes):
        for x in node.items:
            if not isinstance(x, Node):
                text = x[0].strip()
                own[i] += len(text)
                linked[i] += len(text) * x[1]
                marks[i] += sum(text.count(c) for c in ".,;:")
    total, links, ends, kids = own.copy(), linked.copy(), marks.copy(), np.ones(n)
    for i in range(n - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        for array in (total, links, ends, kids):
            array[up] += array[i]
        count[up] += 1
    out = np.zeros((n, 16 + 2 * len(FAMILIES)))
    inherited = np.zeros((n, 3 + len(FAMILIES)))
    seen: dict[int, int] = {}
    for i, node in enumerate(nodes):
        good, bad = _words(node.attrs)
        up = place[id(node.parent)] if node.parent else 0
        order = seen[up] = seen.get(up, -1) + 1 if i else 0
        brothers = max(1.0, count[up])
        family = np.array([node.tag in f for f in FAMILIES], float)
        above = inherited[up] if i else np.zeros(3 + len(FAMILIES))
        out[i] = np.concatenate([
            [
                np.log1p(total[i]), np.log1p(own[i]), links[i] / max(1.0, total[i]), np.log1p(total[i] / kids[i]),
                min(node.depth, 30), min(brothers, 50), order / brothers, total[i] / max(1.0, total[0]),
                total[i] / max(1.0, total[up]), 100 * ends[i] / max(1.0, total[i]), np.log1p(kids[i]), good, bad,
                above[0], above[1], above[2],
            ],
            family, above[3:],
        ])
        inherited[i] = np.concatenate([[above[0] + good, above[1] + bad, max(above[2], links[i] / max(1.0, total[i]))], np.maximum(above[3:], family)])
    return out


class Boosted:
    """Gradient-boosted trees for a yes/no answer: second-order gains on quantile bins."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.model: list[tuple] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        coded = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(self.cuts, x.T)], axis=1)
        margin = np.zeros(len(y))
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            self.model.append(tree := self._grow(coded, y - p, p * (1 - p), np.arange(len(y)), self.depth))
            margin += self._walk(tree, x)
        return self

    def _grow(self, coded, gradient, hessian, rows, depth):
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, None, None)
        if depth and len(rows) > 10:
            for f, cut in enumerate(self.cuts):
                if not len(cut):
                    continue
                left_g = np.cumsum(np.bincount(coded[rows, f], gradient[rows], len(cut) + 1))[:-1]
                left_h = np.cumsum(np.bincount(coded[rows, f], hessian[rows], len(cut) + 1))[:-1]
                gains = (
                    left_g**2 / (left_h + self.ridge)
                    + (g - left_g) ** 2 / (h - left_h + self.ridge)
                    - g**2 / (h + self.ridge)
                )
                if gains.max() > best[0]:
                    best = (gains.max(), f, int(gains.argmax()))
        if best[1] is None:
            return float(self.rate * g / (h + self.ridge))
        goes = coded[rows, best[1]] <= best[2]
        if goes.all() or not goes.any():
            return float(self.rate * g / (h + self.ridge))
        return (
            best[1],
            float(self.cuts[best[1]][best[2]]),
            self._grow(coded, gradient, hessian, rows[goes], depth - 1),
            self._grow(coded, gradient, hessian, rows[~goes], depth - 1),
        )

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        goes = x[:, tree[0]] <= tree[1]
        out = np.empty(len(x))
        for side, mask in ((tree[2], goes), (tree[3], ~goes)):
            if mask.any():
                out[mask] = self._walk(side, x[mask])
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        return sum((self._walk(tree, x) for tree in self.model), np.zeros(len(x)))


def decode(nodes: list[Node], margins: np.ndarray) -> set[int]:
    """Nodes to keep: the likeliest choice in which nothing kept stands below anything dropped.

    The root is always kept. Works upwards: a node's subtree is worth keeping if its own
    evidence and that of its best subtrees outweigh dropping them all.
    """
    place = {id(n): i for i, n in enumerate(nodes)}
    yes, no = -np.logaddexp(0, -margins), -np.logaddexp(0, margins)
    for i in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        yes[up] += max(yes[i], no[i])
        no[up] += no[i]
    kept = {0}
    for i in range(1, len(nodes)):
        if place[id(nodes[i].parent)] in kept and yes[i] >= no[i]:
            kept.add(i)
    return kept


def blocks_of(nodes: list[Node], kept: set[int]) -> str:
    """Text of the kept nodes: runs of text between block boundaries, white space made one space, joined by newlines."""
    place = {id(n): i for i, n in enumerate(nodes)}
    out, run, todo = [], [], [iter(nodes[0].items)]

    def flush():
        if text := SPACE.sub(" ", "".join(run)).strip():
            out.append(text)
        run.clear()

    while todo:
        x = next(todo[-1], None)
        if x is None:
            flush()
            todo.pop()
        elif isinstance(x, Node):
            flush()
            if place[id(x)] in kept:
                todo.append(iter(x.items))
        else:
            run.append(x[0])
    flush()
    return "\n".join(out)


def _training_pages(pages: list[str], seed: int = 7) -> list[tuple[Node, set[int], set[int]]]:
    """Pages made of the sample's own articles, with boilerplate in many dresses; ids of main nodes and of those around them."""
    pick = random.Random(seed)
    articles = []
    for html in pages:
        root = parse(html)
        for node in nodes_of(root):
            if node.tag in ("article", "main"):
                texts = blocks_of(every := nodes_of(node), set(range(len(every)))).split("\n")
                articles.append([t for t in texts if t])
    articles = [a for a in articles if a] or [["A short page about rivers.", "Water runs from the hills to the sea, and on its way it turns mills, feeds fields and carries boats."] * 3]
    sentences = [s for a in articles for t in a for s in re.findall(r"[^.]+\.?", t)[:3]]
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")

    def side(word: str) -> str:
        line = lambda: escape(pick.choice(sentences)[: pick.choice((20, 60, 120))])
        listed = "".join(f'<li><a href="/x">{line()}</a></li>' for _ in range(pick.randint(2, 8)))
        body = pick.choice((f"<ul>{listed}</ul>", f"<p>{line()}</p>" * pick.randint(1, 3), line(), f"<p>{line()} <a href='/y'>{line()}</a></p>"))
        tag = pick.choice(("div", "div", "section", "aside", "ul" if body.startswith("<ul") else "div"))
        plain = {"nav": "nav", "footer": "footer", "header": "header", "sidebar": "aside", "form": "form"}.get(word)
        if plain and pick.random() < 0.6:
            return f"<{plain}>{body}</{plain}>"
        name = pick.choice((word, f"{word}-box", f"site-{word}", f"{word} wide"))
        return f"<{tag} {pick.choice(('class', 'id'))}='{name}'>{body}</{tag}>"

    made = []
    for texts in articles:
        for _ in range(2):
            parts = [f"<h1>{escape(texts[0])}</h1>"]
            for text in texts[1:] or texts:
                parts.append(pick.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<h2>{}</h2>" if len(text) < 80 else "<p>{}</p>")).format(escape(text)))
            for _ in range(pick.choice((0, 0, 1, 2))):  # boilerplate inside the article
                parts.insert(pick.randint(1, len(parts)), side(pick.choice(SIDE_WORDS)))
            opening, closing = pick.choice((("<article>", "</article>"), ("<main>", "</main>"), (f"<div class='{pick.choice(MAIN_WORDS)}'>", "</div>"), (f"<div id='{pick.choice(MAIN_WORDS)}'>", "</div>"), ("<div>", "</div>")))
            before = [side(w) for w in ["nav", *pick.sample(SIDE_WORDS, pick.randint(0, 2))]]
            after = [side(w) for w in [*pick.sample(SIDE_WORDS, pick.randint(0, 3)), "footer"]]
            mark = "<x-main>"
            html = "".join([*before, f"{mark}{opening}", *parts, f"{closing}</x-main>", *after])
            if pick.random() < 0.4:
                html = f"<div class='{pick.choice(('page', 'wrapper', 'container'))}'>{html}</div>"
            root = parse(html)
            nodes = nodes_of(root)
            good: set[int] = set()
            wrapper = next(n for n in nodes if n.tag == "x-main")
            inside = {id(wrapper)}
            for n in nodes:
                if n.parent is not None and id(n.parent) in inside:
                    if not _words(n.attrs)[1] and n.tag not in ("nav", "footer", "header", "aside", "form"):
                        inside.add(id(n))
                        good.add(id(n))
            up = wrapper.parent
            where = up.items.index(wrapper)
            for child in (moved := [x for x in wrapper.items]):
                if isinstance(child, Node):
                    child.parent = up
            up.items[where : where + 1] = moved
            for node in nodes_of(root)[1:]:
                node.depth = node.parent.depth + 1
            made.append((root, good, {id(a) for a in _ancestors(up)}))
    return made


def _ancestors(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def fit_extractor(pages: DataFrame, sample: int = 300) -> Boosted:
    """Trees fitted on at most ``sample`` pages with an article, chosen by hash of the html.

    The articles of these pages are dressed anew, with and without telling tags and names
    and among boilerplate of many kinds, so that the model must use more than one sign.
    """
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]")).select("html")
    found = [row["html"] for row in hashed_sample(marked, ["html"], sample).collect()]
    xs, ys = [], []
    for root, good, above in _training_pages(found):
        nodes = nodes_of(root)
        kind = features(nodes)
        for i, node in enumerate(nodes):
            if i:
                xs.append(kind[i])
                ys.append(1.0 if id(node) in good or id(node) in above else 0.0)
    return Boosted().fit(np.array(xs), np.array(ys))


def main_texts(pages: list[str | None], model: Boosted) -> list[str]:
    """Main text of each page; the trees are walked once for all nodes of ``GROUP`` pages."""
    out = []
    for at in range(0, len(pages), GROUP):
        trees = [nodes_of(parse(html)) for html in pages[at : at + GROUP]]
        margins = model.margin(np.concatenate([features(nodes) for nodes in trees]))
        cuts = np.cumsum([len(nodes) for nodes in trees])[:-1]
        for nodes, margin in zip(trees, np.split(margins, cuts)):
            out.append(blocks_of(nodes, decode(nodes, margin)))
    return out


def extract_text(pages: DataFrame, model: Boosted) -> DataFrame:
    """(page_id, url, text), one row per row of ``pages``; null or empty html has empty text.

    Scripts, styles, comments, titles, templates, drawings, frames and the fields and buttons
    of forms never count as text; one without its end tag ends at the next block tag or at
    its parent's end tag (script and style do not). Text of noscript, object and math is
    judged like other text. Character references are
    decoded, white space within a block is one space, blocks are joined by one newline in
    page order. Text that stands in no block is kept. Other columns are not read.
    """
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches):
        for batch in batches:
            texts = main_texts(batch.column("html").to_pylist(), model)
            # ids stay Arrow columns: as numbers beside a null they would be rounded
            given = [batch.column("page_id"), batch.column("url")]
            yield pa.RecordBatch.from_arrays([*given, pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema(f"{kinds}, text string"))


def extraction_digest(pages: DataFrame) -> DataFrame:
    """``extract_text`` with a model fitted on the pages, and the length of each text."""
    return extract_text(pages, fit_extractor(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
