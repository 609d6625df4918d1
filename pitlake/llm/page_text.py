"""Main text of web pages by a tree-structured graphical model.

The nodes are a page's block elements, each content or not. A node's own potential is a linear score of its
tag, names, text and links; a potential joins each child to its parent. Messages passed up from the leaves and
down from the root give every node's marginal, and the text of nodes over one half is kept.

The weights are fitted on pages that label themselves, by one article or main element, starting from prior weights
that stand for what those pages don't show. In half of them the labelling element is taken for a plain one,
so that the model learns to do without it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, sample_of, slices, text_frame

TRAIN_PAGES = 3_000  # pages the weights are fitted on, at most; those of the least hashes
PRIOR_STRENGTH = 0.02  # pull towards the prior weights, per labelled node
LIMIT = 30.0

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title textarea select option button svg math iframe object canvas audio video map".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: A start tag of these ends an open paragraph; those with a list end an open one of that list, inside the list's bounds.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
ENDS_OPEN = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "body": (("head",), ()),
}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_ENDS = re.compile(r"[.!?;:。！？]")

#: Words in class, id, role and label attributes, by what they tell. Fixed values.
NAMES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs toolbar skip sitemap",
    "header": "header masthead banner topbar logo branding",
    "footer": "footer copyright colophon legal contentinfo bottom",
    "sidebar": "sidebar aside rail related recommended recommendation recommendations popular trending widget complementary more teaser",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall warning disclaimer",
    "form": "form search login signin signup subscribe subscription newsletter share sharing social button register",
    "comments": "comment comments reply replies respond discussion disqus reviews feedback",
    "content": "article content entry post story main body text articlebody maincontent",
}
NAME_GROUPS = list(NAMES)
GROUP_OF = {word: i for i, group in reversed(list(enumerate(NAMES))) for word in NAMES[group].split()}
#: Prior weights of tags, per node that is one; of groups of names, in the order above; of measures, as named.
TAG_PRIOR = {
    "article": 3.0, "main": 2.0, "p": 1.0, "h1": 0.8, "h2": 0.5, "h3": 0.5, "h4": 0.3, "blockquote": 0.8, "pre": 0.8, "figure": 0.0,
    "figcaption": 0.3, "section": 0.3, "div": 0.0, "ul": -0.3, "ol": -0.1, "li": -0.2, "dl": 0.0, "dt": 0.0, "dd": 0.0, "table": 0.0,
    "thead": 0.0, "tbody": 0.0, "tr": 0.0, "td": 0.0, "th": 0.0, "html": -3.0, "body": -3.0, "nav": -9.0, "aside": -9.0, "header": -5.0,
    "footer": -9.0, "form": -9.0, "fieldset": -6.0, "dialog": -8.0, "menu": -8.0, "address": -2.0, "hr": 0.0, "details": 0.0, "summary": 0.0,
}
TAGS = {tag: i for i, tag in enumerate(TAG_PRIOR)}
GROUP_PRIOR = [-9.0, -6.0, -9.0, -9.0, -9.0, -9.0, -7.0, -9.0, 1.5]
MEASURES = {"bias": -0.5, "own words": 0.5, "words below": 0.3, "own links": -3.0, "links below": -3.0, "sentence ends": 0.8, "share of page": 1.0, "hidden": -9.0, "skipped": -LIMIT}
PRIOR = np.array([*TAG_PRIOR.values(), 0.0, *GROUP_PRIOR, *MEASURES.values()])
#: Prior counts of (parent, child) labels.
PAIR_PRIOR = np.array([[40.0, 2.0], [4.0, 60.0]])


@dataclass
class Page:
    """Block elements of a page in order, and its text runs."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    groups: list[frozenset[int]] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    labels: list[bool] = field(default_factory=list)  # says that it holds the main content
    runs: list[tuple[int, int, str, bool]] = field(default_factory=list)  # (node, block, text, inside a link)


def attributes(source: str) -> tuple[frozenset[int], bool, bool]:
    """(groups of names, hidden, labelled as main content) of an element."""
    groups, hidden, main = set(), False, False
    for name, value in ATTRIBUTE.findall(source):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role", "aria-label", "itemprop", "data-role"):
            groups.update(GROUP_OF[word] for word in map(str.lower, NAME.findall(value)) if word in GROUP_OF)
            main |= (name == "role" and value.lower() == "main") or (name == "itemprop" and value.lower() == "articlebody")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return frozenset(groups), hidden, main


def parse(source: str) -> Page:
    """A tolerant reading: unknown and unclosed tags are taken as they come, as browsers do."""
    page = Page()
    nothing = frozenset()

    def add(tag: str, parent: int, groups=nothing, hidden=False, main=False) -> int:
        page.tag.append(tag)
        page.parent.append(parent)
        page.groups.append(groups)
        page.hidden.append(hidden)
        page.labels.append(main or tag in ("article", "main"))
        return len(page.tag) - 1

    stack: list[tuple[str, int]] = [("", add("html", -1))]  # (tag, its block node)
    open_tags: Counter[str] = Counter()
    block, links, at = 0, 0, 0

    def push(tag: str, node: int) -> None:
        stack.append((tag, node))
        open_tags[tag] += 1

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            page.runs.append((stack[-1][1], block, entities.unescape(piece) if "&" in piece else piece, links > 0))
        elif piece and page.runs and page.runs[-1][1] == block:
            page.runs.append((stack[-1][1], block, " ", False))

    def close(depth: int) -> None:
        nonlocal links, block
        for tag, _ in stack[depth:]:
            links -= tag == "a"
            block += tag not in INLINE
            open_tags[tag] -= 1
        del stack[depth:]

    def open_one(tags: tuple[str, ...], bounds: tuple[str, ...]) -> int | None:
        if not any(open_tags[tag] for tag in tags):
            return None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                return depth
            if stack[depth][0] in bounds:
                return None
        return None

    while True:
        match = TOKEN.search(source, at)
        if match is None:
            text(source[at:])
            return page
        text(source[at : match.start()])
        at = match.end()
        if match[1]:
            tag = match[1].lower()
            if tag == "br":
                text(" ")
                page.runs.append((stack[-1][1], block, " ", False))
                continue
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), None) if open_tags[tag] else None
            # An inline end tag doesn't reach beyond the block it stands in.
            if depth is not None and not (tag in INLINE and any(t not in INLINE for t, _ in stack[depth:])):
                close(depth)
            elif tag == "p":
                block += 1
            continue
        tag = (match[2] or match[4] or "").lower()
        if not tag:
            continue
        source_of = match[3] if match[2] else match[5]
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                if tag == "br":
                    page.runs.append((stack[-1][1], block, " ", False))
                continue
            groups, hidden, _ = attributes(source_of) if source_of.strip() else (nothing, False, False)
            if hidden:  # an inline element that isn't shown is a node of its own
                push(tag, add(tag, stack[-1][1], groups, True))
            else:
                push(tag, stack[-1][1])
            links += tag == "a"
            continue
        if tag in ENDS_PARAGRAPH:
            depth = open_one(("p",), ("button", "td", "th", "caption", "object", "table"))
            if depth is not None:
                close(depth)
        if tag in ENDS_OPEN:
            depth = open_one(*ENDS_OPEN[tag])
            while depth is not None:
                close(depth)
                depth = open_one(*ENDS_OPEN[tag])
        if tag == "html":
            continue
        block += 1
        groups, hidden, main = attributes(source_of) if source_of.strip() else (nothing, False, False)
        if tag in VOID:
            continue
        node = add(tag, stack[-1][1], groups, hidden, main)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            stop = end.start() if end else len(source)
            close_at = source.find(">", stop)
            at = close_at + 1 if end and close_at >= 0 else len(source)
            continue
        if not source_of.rstrip().endswith("/") or tag in ENDS_PARAGRAPH:
            push(tag, node)


@dataclass
class Forest:
    """The nodes of many pages as arrays; parents stand before their children."""

    parent: np.ndarray
    depth: np.ndarray
    features: np.ndarray
    group: np.ndarray  # of the pair potential: 0 for containers of content, 1 for the rest
    first: np.ndarray  # first node of each page, and the number of all at the end


def forest(pages: list[Page], masked: np.ndarray | None = None) -> Forest:
    """masked: pages whose article and main elements count as plain ones, without names."""
    count = np.array([len(p.tag) for p in pages], np.int64)
    first = np.concatenate(([0], np.cumsum(count)))
    total = int(first[-1])
    parent, depth = np.full(total, -1, np.int64), np.zeros(total, np.int64)
    x = np.zeros((total, len(PRIOR)))
    words, linked, ends = np.zeros(total), np.zeros(total), np.zeros(total)
    group = np.ones(total, np.int64)
    names_at, measures_at = len(TAGS) + 1, len(TAGS) + 1 + len(NAME_GROUPS)
    column = {name: measures_at + i for i, name in enumerate(MEASURES)}
    for k, page in enumerate(pages):
        base, hide = int(first[k]), masked is not None and masked[k]
        for i, tag in enumerate(page.tag):
            node = base + i
            above = page.parent[i]
            if above >= 0:
                parent[node], depth[node] = base + above, depth[base + above] + 1
            plain = hide and page.labels[i]
            x[node, TAGS["div"] if plain else TAGS.get(tag, len(TAGS))] = 1
            if page.groups[i] and not plain:
                x[node, [names_at + g for g in page.groups[i]]] = 1
            if page.hidden[i]:
                x[node, column["hidden"]] = 1
            if tag in SKIPPED:
                x[node, column["skipped"]] = 1
            if tag in ("article", "main", "section", "div", "body", "html"):
                group[node] = 0
        for node, _, run, link in page.runs:
            n = run.count(" ") + 1 if not run.isspace() else 0
            words[base + node] += n
            linked[base + node] += n if link else 0
            ends[base + node] += len(SENTENCE_ENDS.findall(run))
    below, linked_below = words.copy(), linked.copy()
    for level in range(int(depth.max()) if total else 0, 0, -1):
        at = np.flatnonzero(depth == level)
        np.add.at(below, parent[at], below[at])
        np.add.at(linked_below, parent[at], linked_below[at])
    page_words = np.repeat(below[first[:-1]], count)
    x[:, column["bias"]] = 1
    x[:, column["own words"]] = np.log1p(words) / 3
    x[:, column["words below"]] = np.log1p(below) / 5
    x[:, column["own links"]] = linked / np.maximum(words, 1)
    x[:, column["links below"]] = linked_below / np.maximum(below, 1)
    x[:, column["sentence ends"]] = np.minimum(ends, 3) / 3
    x[:, column["share of page"]] = below / np.maximum(page_words, 1)
    return Forest(parent, depth, x, group, first)


@dataclass
class Potentials:
    weights: np.ndarray
    pair: np.ndarray  # [group of the child, parent's label, child's label], logs


def pair_potentials(counts: np.ndarray) -> np.ndarray:
    joint = counts / counts.sum(axis=(1, 2), keepdims=True)
    return np.log(joint / (joint.sum(axis=2, keepdims=True) * joint.sum(axis=1, keepdims=True)))


def prior_potentials() -> Potentials:
    return Potentials(PRIOR.copy(), pair_potentials(np.stack((PAIR_PRIOR, PAIR_PRIOR))))


def marginals(trees: Forest, model: Potentials) -> np.ndarray:
    """Probability that each node is content: sum-product, once up and once down."""
    n = len(trees.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.clip(trees.features @ model.weights, -LIMIT, LIMIT)
    pair = model.pair[trees.group]
    collected, up = own.copy(), np.zeros((n, 2))  # own potential and children's messages; message to the parent
    levels = [np.flatnonzero(trees.depth == d) for d in range(int(trees.depth.max()) + 1 if n else 0)]
    for at in reversed(levels[1:]):
        message = np.logaddexp.reduce(collected[at][:, None, :] + pair[at], axis=2)
        up[at] = message - message.max(axis=1, keepdims=True)
        np.add.at(collected, trees.parent[at], up[at])
    belief = collected.copy()
    for at in levels[1:]:
        above = belief[trees.parent[at]] - up[at]
        message = np.logaddexp.reduce(above[:, :, None] + pair[at], axis=1)
        belief[at] = collected[at] + message - message.max(axis=1, keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -LIMIT * 4, LIMIT * 4)))


def own_labels(page: Page) -> np.ndarray | None:
    """Labels of a page with one outermost article, or else main, element; None if it has none or several."""
    for wanted in ("article", None, "main"):
        roots = [i for i, tag in enumerate(page.tag) if (page.labels[i] and tag not in ("article", "main") if wanted is None else tag == wanted)]
        if len(roots) == 1:
            break
        if roots:
            return None
    else:
        return None
    strong = {tag for tag, weight in TAG_PRIOR.items() if weight <= -5}
    label = np.zeros(len(page.tag), np.bool_)
    for i, tag in enumerate(page.tag):
        inside = i == roots[0] or (page.parent[i] >= 0 and label[page.parent[i]])
        names = any(GROUP_PRIOR[g] < 0 for g in page.groups[i])
        label[i] = inside and (i == roots[0] or not (tag in strong or tag in SKIPPED or names or page.hidden[i]))
    return label


def fit(sources: list[str]) -> Potentials:
    """Potentials from the pages that label themselves: a logistic score with a pull to the prior weights, and counted pairs."""
    pages, labels = [], []
    for source in sources:
        page = parse(source)
        label = own_labels(page)
        if label is not None:
            pages.append(page)
            labels.append(label)
    if not pages:
        return prior_potentials()
    trees = forest(pages, np.arange(len(pages)) % 2 == 1)
    y = np.concatenate(labels).astype(np.float64)
    x, weights = trees.features, PRIOR.copy()
    shown = np.abs(x).sum(axis=0) > 0
    for _ in range(30):  # Newton's steps; the pull keeps them bounded
        z = np.clip(x @ weights, -LIMIT, LIMIT)
        p = 1 / (1 + np.exp(-z))
        gradient = x.T @ (p - y) / len(y) + PRIOR_STRENGTH * (weights - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + PRIOR_STRENGTH * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        step[~shown] = 0
        weights -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    counts = np.stack((PAIR_PRIOR, PAIR_PRIOR))
    child = np.flatnonzero(trees.parent >= 0)
    np.add.at(counts, (trees.group[child], y[trees.parent[child]].astype(int), y[child].astype(int)), 1)
    return Potentials(weights, pair_potentials(counts))


def texts(sources: list[str], model: Potentials) -> list[str]:
    """The main text of each page: blocks in order, one line each."""
    pages = [parse(source) for source in sources]
    trees = forest(pages)
    content = marginals(trees, model) >= 0.5
    skipped = trees.features[:, -1] > 0
    for at in np.flatnonzero(trees.parent >= 0):
        skipped[at] |= skipped[trees.parent[at]]
    content &= ~skipped
    out = []
    for k, page in enumerate(pages):
        base, blocks, last = trees.first[k], [], None
        for node, block, run, _ in page.runs:
            if content[base + node]:
                if block != last:
                    blocks.append([])
                    last = block
                blocks[-1].append(run)
        lines = (" ".join("".join(parts).split()) for parts in blocks)
        out.append("\n".join(line for line in lines if line))
    return out


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Potentials:
    """Potentials fitted on at most train_pages whole pages, which come to the driver one by one."""
    source = text_frame(pages, "page_id", "html")
    rows = sample_of(source, train_pages, "doc_id", "text")
    return fit([row["text"] for row in rows.toLocalIterator()])


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A page without main text has the empty one, as have null and empty pages. Broken markup is read as far as
    it goes. Repeated rows are read each; a null url stays null; rows without a page_id are left out; other columns are ignored; an empty table
    gives an empty one.
    """
    model = train(pages, train_pages)
    weights, pair = model.weights, model.pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            found = texts([x or "" for x in batch.column("html").to_pylist()], Potentials(weights, pair))
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.where(F.col("page_id").isNotNull()).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return mapped(rows, run, "page_id long, url string, text string, n_chars long")
