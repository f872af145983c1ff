"""Main text of web pages by gradient-boosted trees over DOM-node features.

A page is read into a flat list of nodes, elements and runs of text, in page order. Trees give each
node the log-odds that it belongs to the article, from its subtree's density, its attribute
tokens, its depth and its siblings. Decoding is hierarchical: a node that is kept has kept
ancestors, a node that is dropped has dropped descendants, and the choice with
the largest total of log-odds under that rule wins.

Nobody labels the nodes of the pages, so the trees learn from seeds: pages that mark their
article (``article``, ``main``, ``role=main``, ``itemprop=articleBody``), in a bounded sample of
the table. From each such page variants are made in which the marks are gone or
renamed and blocks of other kinds, filled with text of the page itself, are put in
between. So the trees must learn from structure and text too, not only from the marks.
"""

from __future__ import annotations

import html as markup
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages to learn from, in the order of a hash of id and address, and the longest of them in characters.
SAMPLE_PAGES, SAMPLE_CHARS = 160, 1 << 16
VARIANTS = 4

# Fixed values of HTML: elements without content, elements whose content is no text, elements within a line,
# elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select option object head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr #text".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_ENDING = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

# Words of names that web pages give to blocks, by the kind of block.
KINDS: dict[str, tuple[str, ...]] = {
    "article": ("article", "content", "main", "post", "entry", "story", "body", "text", "articlebody"),
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "pagination", "toc"),
    "head": ("header", "banner", "masthead", "topbar", "logo", "branding"),
    "foot": ("footer", "foot", "bottom", "copyright", "colophon", "legal", "contentinfo"),
    "side": ("sidebar", "aside", "side", "widget", "related", "recommended", "rail", "complementary", "popular", "trending"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner-ad", "adsense"),
    "notice": ("notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "disclaimer"),
    "form": ("form", "search", "login", "signup", "register", "contact"),
    "comments": ("comment", "comments", "reply", "replies", "respond", "discussion", "disqus"),
    "share": ("share", "social", "tags", "byline", "meta", "author"),
}
KIND_OF = {w: k for k, words in KINDS.items() for w in words}
KIND_NAMES = tuple(KINDS)
TAGS = ("article", "main", "nav", "header", "footer", "aside", "form", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "a", "b", "table", "blockquote", "pre", "figure", "button", "label", "body", "#text")
TAG_NUMBER = {t: i + 1 for i, t in enumerate(TAGS)}
#: Elements that hold no article text, and marks of the article, for the seeds only.
SEED_OUT = frozenset("nav header footer aside form button".split())
SEED_IN = frozenset("article main".split())
OUT_KINDS = frozenset(k for k in KINDS if k != "article")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = frozenset(("class", "id", "role", "itemprop", "aria-label", "data-role"))
_SENTENCE = re.compile(r"[.,;:!?]")


@dataclass
class Page:
    """Nodes in page order; a parent comes before its children. ``text`` is decoded, only runs of text have one."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    kinds: list[frozenset] = field(default_factory=list)
    text: list[str] = field(default_factory=list)

    def add(self, tag: str, parent: int, kinds: frozenset = frozenset(), text: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.kinds.append(kinds)
        self.text.append(text)
        return len(self.tag) - 1


def _kinds(attributes: str) -> frozenset:
    found = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in _NAMES:
            for word in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", "".join(values)).lower()):
                if word in KIND_OF:
                    found.add(KIND_OF[word])
    return frozenset(found)


def parse(source: str) -> Page:
    """The nodes of a page. Comments, scripts, styles, heads and the like have no text; missing end tags are supplied as HTML does."""
    page = Page()
    page.add("html", -1)
    open_: list[int] = [0]
    tags = page.tag
    at, end = 0, len(source)
    opened: Counter[str] = Counter()

    def close(until: int) -> None:
        opened.subtract(tags[i] for i in open_[until:])
        del open_[until:]

    while at < end:
        mark = source.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            run = source[at:mark]
            if run.strip():
                page.add("#text", open_[-1], text=markup.unescape(run))
            elif tags[-1] == "#text":
                page.text[-1] += " "
            else:
                page.add("#text", open_[-1], text=" ")
            at = mark
            continue
        m = _TOKEN.match(source, at)
        if m is None:  # a lone <
            after = source.find("<", at + 1)
            after = end if after < 0 else after
            page.add("#text", open_[-1], text=markup.unescape(source[at:after]))
            at = after
            continue
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag in ("html",):
            continue
        if m[1]:
            if not opened[tag]:
                continue
            for i in range(len(open_) - 1, 0, -1):
                own = tags[open_[i]]
                if own == tag:
                    close(i)
                    break
                if tag in INLINE and own not in INLINE:
                    break  # an inline end does not close a block
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            if tag == "head" and stop is None:  # no end: the body begins it
                stop = re.compile(r"(?=<body)", re.I).search(source, at)
            at = stop.end() if stop else (at if tag == "head" else end)
            continue
        if tag in ENDS_P and opened["p"]:  # an open paragraph ends, with what is open in it
            for i in range(len(open_) - 1, 0, -1):
                if tags[open_[i]] == "p":
                    close(i)
                    break
                if tags[open_[i]] not in INLINE:
                    break
        if tag in SELF_ENDING:
            names, walls = SELF_ENDING[tag]
            for i in range(len(open_) - 1, 0, -1):
                if tags[open_[i]] in names.split():
                    close(i)
                    break
                if tags[open_[i]] in walls:
                    break
        if tag == "body" and "body" in tags[:3]:
            continue
        node = page.add(tag, open_[-1], _kinds(m[3]) if m[3] else frozenset())
        if tag not in VOID and not m[3].endswith("/"):
            open_.append(node)
            opened[tag] += 1
    return page


# --- features ----------------------------------------------------------------------------

FEATURES = (
    ["tag", "parent tag", "depth", "place", "place from the end", "siblings", "siblings of its tag", "chars", "share of the page", "share of the parent", "density", "links", "sentences a char",
     "words a run", "mean chars of siblings", "elements", "before", "letters"]
    + [f"own {k}" for k in KIND_NAMES] + [f"above {k}" for k in KIND_NAMES] + ["under article mark", "under other mark", "own other mark", "below article mark", "below other mark"]
)

CHARS = FEATURES.index("chars")


def features(page: Page) -> np.ndarray:
    """One row of FEATURES for each node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    chars = np.array([len(t.strip()) for t in page.text], float)
    stops = np.array([len(_SENTENCE.findall(t)) if t else 0 for t in page.text], float)
    words = np.array([len(t.split()) for t in page.text], float)
    tag = np.array([TAG_NUMBER.get(t, 0) for t in page.tag])
    link = np.array([t == "a" for t in page.tag])
    element = np.array([t != "#text" for t in page.tag], float)
    run = (1 - element) * (chars > 0)
    depth, under_link = np.zeros(n), link.copy()
    own = np.zeros((n, len(KIND_NAMES)), bool)
    for i, kinds in enumerate(page.kinds):
        for k in kinds:
            own[i, KIND_NAMES.index(k)] = True
    article = KIND_NAMES.index("article")
    other = own.copy()
    other[:, article] = False
    in_mark = np.array([t in SEED_IN for t in page.tag]) | own[:, article]
    out_mark = np.array([t in SEED_OUT for t in page.tag]) | (other.any(1) & ~own[:, article])
    above = np.zeros_like(own)
    under_in, under_out = np.zeros(n, bool), np.zeros(n, bool)
    place, count = np.zeros(n), np.zeros(n)
    for i in range(1, n):  # parents come first
        p = parent[i]
        depth[i] = depth[p] + 1
        under_link[i] |= under_link[p]
        above[i] = above[p] | own[p]
        under_in[i] = under_in[p] | in_mark[p]
        under_out[i] = under_out[p] | out_mark[p]
        place[i] = count[p]
        count[p] += 1
    linked = chars * under_link
    before = np.cumsum(chars) - chars
    sums = np.stack([chars, linked, stops, words, run, element, in_mark.astype(float), out_mark.astype(float)], 1)
    for i in range(n - 1, 0, -1):
        sums[parent[i]] += sums[i]
    total, total_links, total_stops, total_words, total_runs, total_elements, marks, others = sums.T
    up = np.maximum(parent, 0)
    siblings = count[up]
    same = np.unique(up * (len(TAGS) + 1) + tag, return_inverse=True, return_counts=True)
    page_chars = max(total[0], 1)
    columns = [
        tag, tag[up], depth, place, siblings - place, siblings, same[2][same[1]], total, total / page_chars, total / np.maximum(total[up], 1), total / (total_elements + 1), total_links / np.maximum(total, 1),
        total_stops / np.maximum(total, 1), total_words / np.maximum(total_runs, 1), (total[up] - total) / np.maximum(siblings - 1, 1), total_elements, before / page_chars, total / np.maximum(total_words, 1),
    ]
    rest = [under_in, under_out, out_mark, marks > in_mark, others > out_mark]
    return np.column_stack([*columns, own, above, *rest]).astype(np.float32)


# --- trees -------------------------------------------------------------------------------

TREES, DEPTH, RATE, BINS, SMOOTH = 40, 4, 0.3, 32, 1.0
LIMIT = 6.0


@dataclass
class Trees:
    """Complete binary trees: at inner node k of a tree, a value over ``cut`` goes to 2k + 2, else to 2k + 1."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return np.clip(out, -LIMIT, LIMIT)


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosting of the logistic loss by Newton steps, over at most BINS quantile bins a feature; deterministic."""
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    base = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    trees = Trees(base, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf, np.float32), np.zeros((TREES, inner + 1)))
    if len(labels) == 0 or labels.min() == labels.max():
        return trees
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in rows.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T)], 1)  # bin <= b exactly if value <= edges[b]
    width = BINS + 1
    flat = binned + np.arange(rows.shape[1]) * width
    score = np.full(len(rows), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, curve = labels - p, p * (1 - p)
        at = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                inside = np.flatnonzero(at == node)
                if len(inside) < 8:
                    at[inside] = 2 * node + 1
                    continue
                cells = flat[inside].ravel()
                shape = (rows.shape[1], width)
                g = np.bincount(cells, np.repeat(gradient[inside], rows.shape[1]), shape[0] * width).reshape(shape).cumsum(1)
                h = np.bincount(cells, np.repeat(curve[inside], rows.shape[1]), shape[0] * width).reshape(shape).cumsum(1)
                all_g, all_h = g[0, -1], h[0, -1]
                gain = g**2 / (h + SMOOTH) + (all_g - g) ** 2 / (all_h - h + SMOOTH) - all_g**2 / (all_h + SMOOTH)
                for f, e in enumerate(edges):
                    gain[f, len(e):] = -1
                f, b = divmod(int(gain.argmax()), width)
                if gain[f, b] <= 1e-6:
                    at[inside] = 2 * node + 1
                    continue
                trees.feature[t, node], trees.cut[t, node] = f, edges[f][b]
                at[inside] = 2 * node + 1 + (rows[inside, f] > edges[f][b])
        for leaf in range(inner + 1):
            inside = at == leaf + inner
            if inside.any():
                trees.leaf[t, leaf] = RATE * gradient[inside].sum() / (curve[inside].sum() + SMOOTH)
        score += trees.leaf[t, at - inner]
    return trees


# --- decoding ----------------------------------------------------------------------------


def decode(parent: list[int], logits: np.ndarray) -> list[bool]:
    """Which nodes are kept: the best total of log-odds such that no kept node lies under a dropped one. The root is kept."""
    n = len(parent)
    gain = [0.0] * n  # best total of the subtree if its node is kept
    for i in range(n - 1, -1, -1):
        gain[i] += float(logits[i])
        if i and gain[i] > 0:
            gain[parent[i]] += gain[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[parent[i]] and gain[i] > 0
    return kept


def text_of_nodes(page: Page, kept: list[bool]) -> str:
    """The kept runs in page order; blocks and line breaks part words, inline elements do not, any white space is one space."""
    out: list[str] = []
    block, last = [0] * len(page.tag), 0
    for i, tag in enumerate(page.tag):
        block[i] = block[page.parent[i]] if tag in INLINE and i else i
        if tag == "#text":
            if kept[i]:
                if block[i] != last:
                    out.append(" ")
                    last = block[i]
                out.append(page.text[i])
        elif tag == "br":
            out.append(" ")
    return " ".join("".join(out).split())


# --- seeds -------------------------------------------------------------------------------


def seeds(page: Page) -> list[bool] | None:
    """Whether a node holds or is article text, by the page's own marks; None for a page that marks no article."""
    n = len(page.tag)
    inside, out = [False] * n, [False] * n
    marked = False
    for i in range(1, n):
        p = page.parent[i]
        inside[i] = inside[p] or page.tag[i] in SEED_IN
        marked |= page.tag[i] in SEED_IN
        out[i] = out[p] or page.tag[i] in SEED_OUT or (page.tag[i] not in SEED_IN and page.tag[i] != "body" and bool(page.kinds[i] & OUT_KINDS) and "article" not in page.kinds[i])
    if not marked:
        return None
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        if page.tag[i] == "#text" and inside[i] and not out[i] and page.text[i].strip():
            holds[i] = True
        if holds[i]:
            holds[page.parent[i]] = True
    return holds


_BLOCKS = {  # tag and name of a block of each kind that is not the article, and of its items
    "menu": (("nav", "ul", "div"), ("li", "a")), "head": (("header", "div"), ("a", "p")), "foot": (("footer", "div"), ("p", "a")), "side": (("aside", "div"), ("li", "p")),
    "advert": (("div", "section", "aside"), ("p", "#text")), "notice": (("div", "section"), ("p", "#text")), "form": (("form",), ("label", "button")),
    "comments": (("section", "div", "ol"), ("p", "li")), "share": (("div", "p"), ("a", "#text")),
}
_ARTICLE_TAGS = ("article", "main", "div", "section", "div")


def variant(page: Page, holds: list[bool], rng: random.Random) -> tuple[Page, list[bool]]:
    """The page with its article's mark changed and blocks of other kinds put before, into and behind it; text comes from the page."""
    out, told, at = Page(), [], {-1: -1}
    pool = [w for t in page.text for w in t.split()][:400] or ["text"]
    roots = {i for i in range(len(page.tag)) if page.tag[i] in SEED_IN}
    children: dict[int, list[int]] = {}
    for i, p in enumerate(page.parent):
        children.setdefault(p, []).append(i)

    def block(parent: int) -> None:
        kind = rng.choice(list(_BLOCKS))
        tags, items = _BLOCKS[kind]
        tag = rng.choice(tags)
        links = kind in ("menu", "side") and tag in ("ul", "div") and rng.random() < 0.2  # without a name, told by its links alone
        named = frozenset([kind]) if not links and (tag in ("div", "section", "p", "ul", "ol") or rng.random() < 0.5) else frozenset()
        node = out.add(tag, parent, named)
        told.append(False)
        for _ in range(rng.randrange(1, 8)):
            item = "a" if links else rng.choice(items)
            start = rng.randrange(len(pool))
            length = rng.randrange(1, 4) if item in ("a", "label", "button", "li") else rng.randrange(3, 60)
            holder = node if item == "#text" else out.add(item, node)
            if item != "#text":
                told.append(False)
            out.add("#text", holder, text=" ".join(pool[start: start + length]))
            told.append(False)

    renamed = rng.random() < 0.6
    stack = [(0, 0)]
    while stack:
        i, closing = stack.pop()
        if closing:
            block(closing - 1)
            continue
        parent = at[page.parent[i]] if page.parent[i] >= 0 else -1
        tag, kinds = page.tag[i], page.kinds[i]
        if i in roots and renamed:
            tag = rng.choice(_ARTICLE_TAGS)
            kinds = frozenset(["article"]) if tag == "div" and rng.random() < 0.8 else frozenset()
        elif tag in SEED_OUT and renamed and not holds[i]:
            kinds = kinds | frozenset([{"nav": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form"}.get(tag, "share")])
            tag = "div" if rng.random() < 0.5 else tag
        if tag == "p" and holds[i] and rng.random() < 0.2:
            tag = rng.choice(("li", "blockquote", "h2", "h3", "pre", "td", "dd", "figure"))
        words = page.text[i].split(" ") if tag == "#text" and holds[i] and rng.random() < 0.4 else ()
        if len(words) > 8:  # a link or stressed words within the prose
            begin = rng.randrange(1, len(words) - 4)
            end = begin + rng.randrange(1, 4)
            out.add("#text", parent, text=" ".join(words[:begin]) + " ")
            inline = out.add(rng.choice(("a", "a", "em", "strong", "i", "code")), parent)
            out.add("#text", inline, text=" ".join(words[begin:end]))
            at[i] = out.add("#text", parent, text=" " + " ".join(words[end:]))
            told.extend([True] * 4)
            continue
        at[i] = out.add(tag, parent, kinds, page.text[i])
        told.append(holds[i])
        for c in reversed(children.get(i, [])):
            if c not in roots and page.tag[c] != "#text" and page.tag[i] in ("body", "article", "main") and rng.random() < (0.3 if page.tag[i] == "body" else 0.06):
                stack.append((c, at[i] + 1))
            stack.append((c, 0))
    return out, told


def learn(sources: list[str]) -> Trees:
    """Trees from the pages that mark their article and their variants; without such pages all nodes are kept."""
    rows, labels = [], []
    for number, source in enumerate(sources):
        page = parse(source)
        holds = seeds(page)
        if holds is None:
            continue
        rng = random.Random(number)
        for own, told in [(page, holds), *(variant(page, holds, rng) for _ in range(VARIANTS))]:
            told_rows = features(own)
            used = told_rows[:, CHARS] > 0  # a node without text says nothing
            rows.append(told_rows[used])
            labels.append(np.array(told, float)[used])
    if not rows:
        return Trees(LIMIT, np.zeros((0, 1), np.int64), np.zeros((0, 1), np.float32), np.zeros((0, 2)))
    return fit(np.concatenate(rows), np.concatenate(labels))


#: Nodes that are scored together.
NODES = 1 << 15


def extract(sources: list[str | None], trees: Trees) -> Iterator[str]:
    """The main text of each page."""
    held: list[tuple[Page, np.ndarray]] = []

    def ready() -> Iterator[str]:
        rows = np.concatenate([rows for _, rows in held])
        logits = np.where(rows[:, CHARS] > 0, trees.logits(rows), 0.0)
        at = 0
        for page, rows in held:
            yield text_of_nodes(page, decode(page.parent, logits[at: at + len(rows)]))
            at += len(rows)
        held.clear()

    nodes = 0
    for source in sources:
        page = parse(source or "")
        held.append((page, features(page)))
        nodes += len(page.tag)
        if nodes >= NODES:
            yield from ready()
            nodes = 0
    if held:
        yield from ready()


def training_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> list[str]:
    """At most SAMPLE_PAGES whole pages of at most SAMPLE_CHARS characters, in the order of a hash of id and page."""
    ident, source = F.col(id_col).cast("string"), F.col(html_col).cast("string")
    fit_in = pages.select(F.xxhash64(ident, source).alias("hash"), source.alias("source")).filter(F.char_length("source").between(1, SAMPLE_CHARS))
    chosen = fit_in.select("hash").distinct().orderBy("hash").limit(SAMPLE_PAGES)
    rows = fit_in.join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).orderBy("hash")
    return [r.source for r in rows.collect()]


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string()), ("n_chars", pa.int64())])


def main_texts(pages: DataFrame, trees: Trees | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: page_id, url, text, n_chars (code points).

    Character references are decoded, white space (as Unicode has it) inside a block becomes one space, blocks are joined by
    one space in page order. A null or empty page, and one without an article, have an empty text. Repeated rows
    come back as often as they are given; an empty table gives none; other columns are not read.
    """
    trees = trees or learn(training_pages(pages, id_col, html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(extract(batch.column(2).to_pylist(), trees))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.large_string()), pa.array([len(t) for t in texts], pa.int64())], schema=OUT)

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
