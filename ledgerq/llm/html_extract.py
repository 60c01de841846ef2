"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the nodes of a tree. Each node is main text or not; what is seen at a node (kind of
element, words of its class, id and role, length and link share of its own text, punctuation) weighs the two states, and every
parent and child share a potential on their pair of states. Sum-product messages pass up to the root and down again, so that the marginal of
every node takes the whole page into account. A block whose marginal is at least one half is kept. The potentials are
smoothed log counts from labelled pages (``html_pages`` unless others are given), counted by Spark.

Scripts, styles, forms' controls and the like are no text at any marginal. Character references are decoded, white space in a
block becomes one space, blocks follow in page order, one line each; a line break element is white space. A tag cut off by
the end of the page is dropped, as browsers do; a quote in a tag counts only where a value starts and if it is closed.
Parsing takes time in proportion to the page, whatever its markup. Rows with repeated or null keys are extracted each by itself, an
empty table gives no rows, and columns other than the key, the address and the page are not looked at. Null and empty pages have an empty text; elements nest to any depth.
A head without an end tag ends at the first text or start tag that it can't hold; self-closed svg and math elements are empty.
"""

from __future__ import annotations

import html as references
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerq.llm.common import mapped
from ledgerq.llm.html_pages import LABELLED

#: Elements of the language by how they behave.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_NO_TEXT = frozenset(
    "head script style noscript template textarea title select option button iframe object svg math canvas audio video "
    "noembed noframes datalist".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th "
    "thead tr ul".split()
)
#: What an open head may hold; text or any other start tag ends it.
_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_FOREIGN = frozenset(["svg", "math"])
_ENDS_P = _BLOCK - frozenset("td th tr tbody thead tfoot caption html body legend summary".split())
#: An element of these kinds ends an open one of the same group, up to the nearest boundary.
_IMPLIED = (
    (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    (frozenset(["dt", "dd"]), frozenset(["dl"])),
    (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    (frozenset(["option"]), frozenset(["select", "datalist"])),
)
_KIND = {
    **dict.fromkeys("nav menu dir".split(), "nav"),
    **dict.fromkeys("header hgroup".split(), "header"),
    **dict.fromkeys("aside dialog".split(), "aside"),
    **dict.fromkeys("form fieldset legend search".split(), "form"),
    **dict.fromkeys("article main".split(), "article"),
    **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), "heading"),
    **dict.fromkeys("ul ol dl".split(), "list"),
    **dict.fromkeys("li dd dt".split(), "item"),
    **dict.fromkeys("table caption tbody thead tfoot tr td th".split(), "table"),
    **dict.fromkeys("blockquote figure figcaption pre details summary".split(), "quote"),
    **dict.fromkeys("html body".split(), "page"),
    "footer": "footer",
    "p": "p",
    "section": "div",
    "div": "div",
}
_BAD_WORDS = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav\w*|breadcrumbs?|foot\w*|sidebar|side|widget\w*|aside|comments?|"
    r"respond|reply|replies|discussion|disqus|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|signup|login|search|form|header|topbar|toolbar|pagination|pager|tags?|meta|byline|copyright|legal|hidden)(?![a-z])"
)
_GOOD_WORDS = re.compile(r"(?<![a-z])(?:article|content|post|entry|story|main|body|text|blog|prose)(?![a-z])")
_name = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_comment_end = re.compile(r"--!?>")
_value_or_end = re.compile(r"[>=]")
_blank = re.compile(r"[ \t\n\r\f]*")
_unquoted = re.compile(r"[^\s>]*")
_attribute = re.compile(r"(?:^|[\s/\"'])(class|id|role|data-y|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?(?=[\s/>]|$)", re.I)
_quoted = re.compile(r"\"[^\"]*\"|'[^']*'")
_stop = re.compile(r"[.!?…,;:]")
_space = re.compile(r"[ \t\n\r\f\v\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class Node:
    __slots__ = ("children", "kind", "label", "link", "parent", "sign", "texts")

    def __init__(self, parent: int, kind: str, sign: str, label: int | None):
        self.parent, self.kind, self.sign, self.label = parent, kind, sign, label
        self.texts: list[str] = []
        self.link = 0
        self.children: list[int] = []


def _attributes(source: str) -> tuple[str, int | None]:
    """(what class, id and role say, the label if there is one)."""
    words, label, hidden = [], None, False
    for name, value in _attribute.findall(source):
        name, value = name.lower(), value.strip("\"'")
        if name == "data-y":
            label = int(value == "1")
        elif name == "hidden" or name == "aria-hidden":
            hidden |= name == "hidden" or value.lower() == "true"
        else:
            words.append(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value))
    found = " ".join(words).lower()
    if hidden or _BAD_WORDS.search(found):
        return "bad", label
    return ("good" if _GOOD_WORDS.search(found) else "none" if not found else "other"), label


def _self_closed(attributes: str) -> bool:
    """Whether a start tag ends with a slash that isn't the end of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    *before, last = _quoted.sub('""', attributes).rsplit(None, 1)
    name, equals, value = last.partition("=")
    if equals:
        return value.startswith('"')
    return not (before and before[0].endswith("="))


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """The place behind the tag whose name ends at ``at``; -1 if the page ends first.

    Quotes count only where a value starts. One that the page never closes (``last``: its last place) is an ordinary character.
    """
    while found := _value_or_end.search(page, at):
        at = found.end()
        if found.group() == ">":
            return at
        at = _blank.match(page, at).end()
        quote = page[at : at + 1]
        if quote in last and last[quote] > at:
            at = page.index(quote, at + 1) + 1
        else:
            at = _unquoted.match(page, at).end()
    return -1


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order and the blocks of text: (node, raw text)."""
    nodes = [Node(-1, "page", "none", 0)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements: (name, node they belong to; -1: no text)
    opened: dict[str, list[int]] = {}  # depths of the open elements of a name
    walls: list[int] = [0]  # depths of the open block elements
    blocks: list[tuple[int, list[str]]] = []
    fresh = True  # the next text starts a block
    in_link = 0
    last_quote = {quote: page.rfind(quote) for quote in "\"'"}

    def depth_of(*names: str) -> int:
        """The depth of the innermost open element of these names; 0: none."""
        return max(opened[n][-1] if opened.get(n) else 0 for n in names)

    def text(piece: str) -> None:
        nonlocal fresh
        if stack[-1][0] == "head" and piece.strip():
            close(len(stack) - 1)
        owner = stack[-1][1]
        if owner < 0 or not piece:
            return
        if fresh or not blocks or blocks[-1][0] != owner:
            if not piece.strip():
                return
            blocks.append((owner, []))
            fresh = False
        blocks[-1][1].append(piece)
        nodes[owner].texts.append(piece)
        if in_link:
            nodes[owner].link += len(piece)

    def close(depth: int) -> None:
        nonlocal fresh, in_link
        while len(stack) > depth:
            name, _ = stack.pop()
            if name in opened:
                opened[name].pop()
            if name in _BLOCK:
                walls.pop()
                fresh = True
            in_link -= name == "a"

    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        text(page[at:start])
        found = _name.match(page, start)
        if not found:
            if page.startswith("<!--", start):
                stop = _comment_end.search(page, start + 2)
                at = stop.end() if stop else len(page)
            elif page[start + 1 : start + 2] in ("!", "?", "/"):
                at = page.find(">", start) + 1 or len(page)
            else:
                text("<")
                at = start + 1
            continue
        slash, name = found.groups()
        at = _tag_end(page, found.end(), last_quote)
        if at < 0:
            break
        attributes, name = page[found.end() : at - 1], name.lower()
        if slash:
            # A stray end tag of an inline element doesn't reach out of its block.
            depth = depth_of(name)
            if depth and (name in _BLOCK or depth > walls[-1]):
                close(depth)
            continue
        if name in ("html", "body") and depth_of(name):
            continue
        if name == "head" and len(stack) > 1 + (depth_of("html") > 0):
            continue
        if stack[-1][0] == "head" and name not in _HEAD:
            close(len(stack) - 1)
        elif name == "body" and depth_of("head"):
            close(depth_of("head"))
        # In foreign content a slash closes any element.
        if _self_closed(attributes) and (name in _FOREIGN or depth_of(*_FOREIGN)):
            continue
        if name in _ENDS_P and stack[walls[-1]][0] == "p":
            close(walls[-1])
        for group, bounds in _IMPLIED:
            if name in group and depth_of(*group) > depth_of(*bounds):
                close(depth_of(*group))
        if name == "a" and in_link:
            depth = opened["a"].pop()
            stack[depth] = ("#closed", stack[depth][1])
            in_link -= 1
        owner = stack[-1][1]
        if name in _BLOCK:
            fresh = True
            if owner >= 0:
                sign, label = _attributes(attributes) if attributes else ("none", None)
                nodes.append(Node(owner, _KIND.get(name, "div"), sign, label))
                nodes[owner].children.append(len(nodes) - 1)
                owner = len(nodes) - 1
        if name == "br":
            text(" ")
        if name in _VOID:
            continue
        if name in _NO_TEXT:
            owner = -1
        if name in _RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            at = stop.start() if stop else len(page)
        opened.setdefault(name, []).append(len(stack))
        if name in _BLOCK:
            walls.append(len(stack))
        stack.append((name, owner))
        in_link += name == "a"
    return nodes, [(owner, "".join(parts)) for owner, parts in blocks]


#: Kinds of elements that hold no main text by their meaning.
_APART = frozenset("nav header footer aside form".split())


def around(node: Node) -> str:
    """What a node's own markup says about its children: the potential of parent and child depends on it."""
    return "apart" if node.sign == "bad" or node.kind in _APART else "open"


def weight(name: str) -> float:
    """Length, links and punctuation go together and count half each."""
    return 0.5 if name.startswith(("size:", "link:", "stop:")) else 1.0


def seen(node: Node) -> list[str]:
    """What is seen at a node."""
    own = "".join(node.texts)
    size = len(own.strip())
    out = [f"kind:{node.kind}", f"sign:{node.sign}"]
    if size:
        share = node.link / max(len(own), 1)
        out.append(f"size:{min(int(math.log2(size + 1)) // 2, 4)}")
        out.append(f"link:{0 if share < 0.1 else 1 if share < 0.6 else 2}")
        out.append(f"stop:{bool(_stop.search(own))}")
    else:
        out.append("size:none")
    return out


def potentials(counts: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    """Log potentials of both states from counts of what was seen with each; ``pair:`` keys count pairs of states."""
    out = {}
    totals: dict[str, list[float]] = {}
    for name, (no, yes) in counts.items():
        total = totals.setdefault(name.partition(":")[0] if not name.startswith("pair:") else name, [0.0, 0.0])
        total[0] += no
        total[1] += yes
    for name, (no, yes) in counts.items():
        if name.startswith("pair:"):
            out[name] = (math.log((no + 0.5) / (no + yes + 1)), math.log((yes + 0.5) / (no + yes + 1)))
        else:
            total = totals[name.partition(":")[0]]
            out[name] = (math.log((no + 0.5) / (total[0] + 5)), math.log((yes + 0.5) / (total[1] + 5)))
    return out


_EVEN = (0.0, 0.0)


def marginals(nodes: list[Node], weights: dict[str, tuple[float, float]]) -> list[float]:
    """Each node's probability of main text: sum-product messages up the tree, then down."""
    n = len(nodes)
    pairs = {a: (weights.get(f"pair:0:{a}", _EVEN), weights.get(f"pair:1:{a}", _EVEN)) for a in ("apart", "open")}
    kinds = [pairs[around(node)] for node in nodes]
    own = []
    for node in nodes:
        no = yes = 0.0
        for name in seen(node):
            w = weights.get(name, _EVEN)
            no += weight(name) * w[0]
            yes += weight(name) * w[1]
        own.append([no, yes])

    def add(a: float, b: float) -> float:
        return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))

    below = [list(x) for x in own]  # with all messages from children
    up = [_EVEN] * n
    for i in range(n - 1, 0, -1):
        no, yes = below[i]
        pair = kinds[nodes[i].parent]
        up[i] = (add(pair[0][0] + no, pair[0][1] + yes), add(pair[1][0] + no, pair[1][1] + yes))
        parent = below[nodes[i].parent]
        parent[0] += up[i][0]
        parent[1] += up[i][1]
    belief = [list(x) for x in below]
    for i in range(1, n):
        pair, above = kinds[nodes[i].parent], belief[nodes[i].parent]
        no, yes = above[0] - up[i][0], above[1] - up[i][1]  # the parent's belief without this child
        belief[i][0] += add(pair[0][0] + no, pair[1][0] + yes)
        belief[i][1] += add(pair[0][1] + no, pair[1][1] + yes)
    return [1 / (1 + math.exp(min(max(no - yes, -700), 700))) for no, yes in belief]


def extract(page: str | None, weights: dict[str, tuple[float, float]]) -> str:
    if not page:
        return ""
    nodes, blocks = parse(page)
    found = marginals(nodes, weights)
    lines = []
    for owner, raw in blocks:
        if found[owner] >= 0.5:
            line = _space.sub(" ", references.unescape(raw) if "&" in raw else raw).strip(" ")
            if line:
                lines.append(line)
    return "\n".join(lines)


def observations(page: str) -> list[tuple[str, int]]:
    """(what was seen, state) for every node of a labelled page, pairs of states included."""
    nodes, _ = parse(page)
    out = []
    for i, node in enumerate(nodes):
        if node.label is None:
            node.label = nodes[node.parent].label
        out += [(name, node.label) for name in seen(node)]
        if i:
            out.append((f"pair:{nodes[node.parent].label}:{around(nodes[node.parent])}", node.label))
    return out


def learn(labelled: DataFrame, html: str = "html") -> dict[str, tuple[float, float]]:
    """Potentials from labelled pages; a row per distinct observation reaches the driver, of which the model has a fixed few."""

    def rows(batches):
        for batch in batches:
            found = [o for page in batch["_html"] for o in observations(page.as_py() or "")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32())], ["name", "state"]
            )

    counts = mapped(labelled.select(F.col(html).alias("_html")), rows, "name string, state int").groupBy("name").agg(
        F.count(F.when(F.col("state") == 0, 1)).alias("no"), F.count(F.when(F.col("state") == 1, 1)).alias("yes")
    )
    return potentials({r["name"]: (float(r["no"]), float(r["yes"])) for r in counts.collect()})


def built_in(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in LABELLED], "html string")


def main_texts(
    pages: DataFrame, weights: dict[str, tuple[float, float]], key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per row: key, url, text and n_chars."""
    model = pages.sparkSession.sparkContext.broadcast(weights)

    def rows(batches):
        for batch in batches:
            texts = [extract(p.as_py(), model.value) for p in batch["_html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["_id", "_url", "text", "n_chars"],
            )

    return mapped(
        pages.select(F.col(key).cast("long").alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html")),
        rows,
        "_id long, _url string, text string, n_chars long",
    ).withColumnsRenamed({"_id": key, "_url": url})
