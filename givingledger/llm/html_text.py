"""Main text of web pages by a tree-structured graphical model.

A page is a tree: elements, and as leaves its runs of inline text (blocks). Each node is content or not. Node potentials come
from features (tag, kind of class words, length, share of link text), parent-child potentials from how labels pass from
parents to children. Sum-product messages go up and down the tree; a block whose content marginal is at least `threshold`
belongs to the main text.

Both kinds of potentials are counted on labelled pages: pages of the corpus that mark their main text themselves (`article`
or `main`), at most about `max_pages`, chosen by hashed id. Elements that say they are something else (by tags and class words
of fixed meaning: navigation, comments, adverts) are observed as not content, in training and later, unless they wrap an
`article` or `main`. Passing is counted apart for containers, where main text may begin or end, and for all that is inside
them. Fixed pseudo counts let a corpus without labelled pages get an answer. Features are of fixed kinds, so the counts have a
bounded size.

A quote begins a value only after "=", as in browsers. Class words of readers' comments always tell of noise, also at an `article`;
other words never do at an `article` or `main`. A noisy element that wraps a page's outermost `article` or `main` is no noise if the page
has none outside such elements.

Scripts, forms' controls, drawings and media are dropped: raw text up to its own end tag, other elements up to theirs or to the
end of their container. A self-closed svg or math is empty; the text of math and object is kept.

Null or empty html: empty text. Cut-off pages: a tag without end is dropped, open elements end with the page. Repeated rows
and null ids are kept row by row; only the listed columns are read. Very long pages take memory in proportion.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]|=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)?)*+)(?P<shut>>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Kinds of tags.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe".split())  # hold text up to their own end tag, else the rest of the page
SKIPPED = set("template noscript select button svg canvas video audio".split())  # dropped whole, at most up to their container's end
# Neither blocks nor dropped: their text belongs to the text around.
INLINE |= set("object math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mspace mpadded mphantom menclose merror mmultiscripts mprescripts mtable mtr mtd semantics annotation annotation-xml maction".split())
SVG_HTML = set("foreignobject desc title".split())  # elsewhere in svg, a block ends the svg
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NOISY_TAGS = set("nav header footer aside form menu dialog fieldset".split())
CONTENT_TAGS = set("article main".split())
NOISY_WORDS = set("ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended comment comments disqus reply replies respond share sharing social cookie cookies consent notice alert popup modal newsletter subscribe signup login form search pagination pager copyright legal disclaimer toolbar skip".split())
COMMENT_WORDS = set("comment comments disqus reply replies respond".split())
CONTENT_WORDS = set("article articlebody content entry main post story".split())
# An element that begins ends the open ones named here, up to its own container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
KEEPS_P = {"td", "th", "li", "dd", "dt", "article", "section", "div", "body", "html", "table", "blockquote", "main", "aside", "nav", "footer", "header", "form"}
CONTAINERS = set("article aside body center dialog div fieldset footer form header html main menu nav section td".split())
PSEUDO = 4.0
# An observed element tells nothing of its parent: such elements stand in main texts and beside them.
OBSERVED, OBSERVED_ODDS, UNTOLD = "noise", -1e6, ((0.5, 0.5), (0.5, 0.5))


@dataclass
class Node:
    parent: int
    tag: str
    features: list[str]
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def element_features(tag: str, attributes: str) -> list[str]:
    found = [f"tag:{tag if tag in BLOCKS else 'other'}"]
    if attributes:
        words = set(re.findall(r"[a-z]+", " ".join("".join(m[1:]) for m in ATTRIBUTE.findall(attributes)).lower()))
        if words & COMMENT_WORDS:
            found.append("words:comments")
        elif words & NOISY_WORDS and tag not in CONTENT_TAGS:
            found.append("words:noisy")
        elif words & CONTENT_WORDS:
            found.append("words:content")
    return found


def leaf_features(node: Node, parent_tag: str) -> list[str]:
    text = node.text
    share = node.linked / max(len(text), 1)
    return [f"in:{parent_tag if parent_tag in BLOCKS else 'other'}", f"length:{min(len(text).bit_length(), 10)}",
            f"links:{0 if share == 0 else 1 if share < 0.5 else 2}"]


def tree(source: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 is the page. Text leaves have the tag '#'."""
    nodes = [Node(-1, "html", ["tag:html"])]
    stack, leaf, in_link, at = [0], None, False, 0
    dropped: list[str] = []  # the open skipped element and the open elements in it
    inline: Counter = Counter()  # open inline elements

    def add_text(text: str) -> None:
        nonlocal leaf
        if dropped:
            return
        if leaf is None:
            if not text.strip():
                return
            leaf = len(nodes)
            nodes.append(Node(stack[-1], "#", []))
        nodes[leaf].pieces.append(text)
        if in_link:
            nodes[leaf].linked += len(text.strip())

    while True:
        match = MARKUP.search(source, at)
        if match is None:
            add_text(source[at:])
            break
        if match.start() > at:
            add_text(source[at : match.start()])
        at = match.end()
        tag = (match["tag"] or "").lower()
        if not tag or not match["shut"]:
            continue
        closing = bool(match["end"])
        in_svg = bool(dropped) and dropped[0] == "svg"
        if not closing and tag in RAW and not in_svg:
            shut = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = shut.end() if shut else len(source)
            continue
        if dropped:
            if not closing:
                broken = in_svg and tag in BLOCKS and not SVG_HTML & set(dropped)
                if not broken and not (tag in CONTENT_TAGS and dropped[0] not in ("template", "noscript")):
                    if tag not in VOID and not (in_svg and match["attributes"].endswith("/")):
                        dropped.append(tag)
                    continue
                dropped.clear()
            elif tag in dropped:
                while dropped.pop() != tag:
                    pass
                continue
            elif any(nodes[i].tag == tag for i in stack[1:]) or inline[tag]:
                dropped.clear()  # ends with its container
            else:
                continue
        if tag in RAW or tag == "head":
            continue
        if tag in SKIPPED:
            if not closing and not (tag == "svg" and match["attributes"].endswith("/")):
                dropped.append(tag)
            continue
        if tag == "br":
            add_text(" ")
            continue
        if tag in INLINE:
            in_link = not closing if tag == "a" else in_link
            if tag not in VOID and not closing:
                inline[tag] += 1
            elif inline[tag]:
                inline[tag] -= 1
            continue
        leaf = None
        if tag in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
            continue
        for depth in range(len(stack) - 1, 0, -1):
            opened = nodes[stack[depth]].tag
            if opened in ENDS.get(tag, ()) or (opened == "p" and tag in BLOCKS):
                del stack[depth:]
                break
            if opened in KEEPS_P and opened not in ENDS.get(tag, ()):
                break
        nodes.append(Node(stack[-1], tag, element_features(tag, match["attributes"])))
        stack.append(len(nodes) - 1)
    told_apart, below = wrappers(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        below[i] = node.parent >= 0 and below[node.parent]
        if node.tag == "#":
            node.features = leaf_features(node, nodes[node.parent].tag)
        elif (noisy(node) and i not in told_apart) or (below[i] and node.tag in CONTENT_TAGS):
            node.features, below[i] = [OBSERVED], True
    return nodes


def noisy(node: Node) -> bool:
    return node.tag in NOISY_TAGS or "words:noisy" in node.features or "words:comments" in node.features


def wrappers(nodes: list[Node]) -> set[int]:
    """Noisy elements around a page's outermost `article` or `main`, if it has none outside noisy elements and comments."""
    inside, hidden, found = [False] * len(nodes), [False] * len(nodes), []
    for i, node in enumerate(nodes):
        if node.parent >= 0:
            up = nodes[node.parent]
            inside[i] = inside[node.parent] or up.tag in CONTENT_TAGS
            hidden[i] = hidden[node.parent] or noisy(up)
        if node.tag in CONTENT_TAGS and not inside[i] and "words:comments" not in node.features:
            if not hidden[i]:
                return set()
            found.append(i)
    around: set[int] = set()
    for i in found:
        above, up = [], nodes[i].parent
        while up >= 0:
            above.append(up)
            up = nodes[up].parent
        if not any("words:comments" in nodes[k].features for k in above):
            around.update(above)
    return around


def marked_labels(nodes: list[Node]) -> list[bool] | None:
    """Labels of a page that marks its main text, else None."""
    if not any(n.tag in CONTENT_TAGS for n in nodes):
        return None
    inside, noise = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        up = node.parent
        noise[i] = (up >= 0 and noise[up]) or OBSERVED in node.features
        inside[i] = (up >= 0 and inside[up]) or node.tag in CONTENT_TAGS
    return [a and not b for a, b in zip(inside, noise, strict=True)]


@dataclass(frozen=True)
class Model:
    """Log odds of content by feature; passed[is container][parent label][label]: chance of a child's label."""

    odds: dict[str, float]
    passed: tuple[tuple[tuple[float, float], tuple[float, float]], ...]


def prior_counts() -> Counter:
    counts: Counter = Counter()
    for container, parent, label, n in ((1, 0, 0, 85), (1, 0, 1, 15), (1, 1, 0, 5), (1, 1, 1, 95), (0, 0, 0, 100), (0, 1, 1, 100)):
        counts["pass", f"{container}{parent}", label] += n
    for tag in CONTENT_TAGS:
        counts["feature", f"tag:{tag}", 1] += PSEUDO
    for word, label in (("words:content", 1), ("in:p", 1), ("links:2", 0)):
        counts["feature", word, label] += PSEUDO
    return counts


def count_page(nodes: list[Node], labels: list[bool]) -> Counter:
    counts: Counter = Counter()
    for node, label in zip(nodes, labels, strict=True):
        if node.parent >= 0 and OBSERVED not in node.features:
            counts["pass", f"{int(node.tag in CONTAINERS)}{int(labels[node.parent])}", int(label)] += 1
        for feature in node.features:
            counts["feature", feature, int(label)] += 1
    return counts


def make_model(counts: Counter) -> Model:
    totals = [sum(n for (kind, _, label), n in counts.items() if kind == "feature" and label == k) for k in (0, 1)]
    names = {name for kind, name, _ in counts if kind == "feature"}
    odds = {}
    for name in names:
        share = [(counts["feature", name, k] + 0.5) / (totals[k] + 0.5 * len(names)) for k in (0, 1)]
        odds[name] = math.log(share[1] / share[0])
    odds[OBSERVED] = OBSERVED_ODDS
    chances = {}
    for case in ("00", "01", "10", "11"):
        both = [counts["pass", case, k] + 0.5 for k in (0, 1)]
        chances[case] = (both[0] / sum(both), both[1] / sum(both))
    return Model(odds, ((chances["00"], chances["01"]), (chances["10"], chances["11"])))


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Chance that each node is content, by one pass of messages up the tree and one down."""
    passed = [UNTOLD if OBSERVED in node.features else model.passed[node.tag in CONTAINERS] for node in nodes]
    limit = lambda x: max(-500.0, min(500.0, x))
    belief = [sum(model.odds.get(f, 0.0) for f in node.features) for node in nodes]
    sent = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        (t00, t01), (t10, t11) = passed[i]
        e = math.exp(limit(belief[i]))
        sent[i] = math.log((t10 + t11 * e) / (t00 + t01 * e))
        belief[nodes[i].parent] += sent[i]
    for i in range(1, len(nodes)):
        (t00, t01), (t10, t11) = passed[i]
        e = math.exp(limit(belief[nodes[i].parent] - sent[i]))
        belief[i] += math.log((t01 + t11 * e) / (t00 + t10 * e))
    return [1.0 / (1.0 + math.exp(-limit(b))) for b in belief]


def main_text(source: str | None, model: Model, threshold: float = 0.5) -> str:
    nodes = tree(source or "")
    blocks = [node.text for node, p in zip(nodes, marginals(nodes, model), strict=True) if node.tag == "#" and p >= threshold]
    return "\n".join(b for b in blocks if b)


def fit(pages: DataFrame, max_pages: int = 2000) -> Model:
    """Counts the potentials on labelled pages of (page_id, html)."""
    marked = pages.select("page_id", "html").filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    n = marked.count()
    chosen = marked.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < min(1.0, max_pages / max(n, 1)) * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for source in batch.column("html").to_pylist():
                nodes = tree(source)
                if labels := marked_labels(nodes):
                    counts += count_page(nodes, labels)
        rows = [(*key, float(n)) for key, n in counts.items()]
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([r[0] for r in rows], pa.string()), "name": pa.array([r[1] for r in rows], pa.string()),
            "label": pa.array([r[2] for r in rows], pa.int32()), "n": pa.array([r[3] for r in rows], pa.float64())})

    summed = chosen.select("html").mapInArrow(count, "kind string, name string, label int, n double").groupBy("kind", "name", "label").agg(F.sum("n").alias("n"))
    counts = prior_counts()
    for row in summed.collect():
        counts[row["kind"], row["name"], row["label"]] += row["n"]
    return make_model(counts)


def extract(pages: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(source, shared.value, threshold) for source in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(texts, rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))


def main_texts(pages: DataFrame) -> DataFrame:
    return extract(pages, fit(pages))
