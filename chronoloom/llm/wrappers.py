"""Main text of web pages through wrappers inferred for each host.

A wrapper is a union-free regular expression over the tokens of a host's pages: tags, text, optional groups and repeated
groups, and no alternatives. Tags nest, so it is kept as a tree of groups; each level of a page is aligned with the same level
of the wrapper, token by token. Text that all pages of the host agree on is part of the template; text that differs is a slot. Where a
host marks its articles, the wrapper says where they are; elsewhere its slots do: the main text is what the pages do not share.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm import arrowtext
from chronoloom.llm.stored import stored
from chronoloom.llm.tasks import tidy
from chronoloom.llm.urls import with_url_parts

HOSTS_AT_ONCE = 512
"""Wrappers a task holds before it sends them on; hosts are merged again later, so this changes no result."""
SPREAD = 16

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""", re.I)

# Facts of HTML: elements without content, elements whose content is no markup, elements that break lines, and what a start tag ends.
_EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "template", "svg", "math", "noframes", "noembed"}
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - {"html", "head", "body", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "body": ({"head"}, {"html"}),
}

# What is no main text, by element and by words of class, id and role.
_OUTSIDE = {"nav", "footer", "aside", "form", "script", "style", "head", "noscript", "iframe", "button", "select", "input", "textarea", "dialog", "menu", "template", "object", "svg", "title"}
_OUTSIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navigation navbar menu breadcrumb breadcrumbs sidebar sidebars footer header masthead topbar toolbar comment comments reply replies respond disqus share sharing "
    "social related recommended newsletter subscribe subscription signup login search widget pagination pager skip".split()
)
_MAIN_TAGS = {"article", "main"}
_MAIN_WORDS = {"articlebody", "main", "article"}


TEMPLATE_PAGES = 3
"""Pages, at least, that a text must be equal on to count as part of the template."""


class Node:
    """An element of a page or a group of a wrapper; ``label`` "#" is text.

    ``pages`` counts the pages that have the group, ``size`` their text in it. ``said`` is the hash of a text that they agree on, None where they differ.
    ``text`` of a wrapper's group says what ``choose`` made of it: "main", or "own" for main text less the template's.
    """

    __slots__ = ("label", "children", "text", "optional", "repeated", "size", "pages", "said")

    def __init__(self, label: str, children=None, text: str = "", optional: bool = False, repeated: bool = False, size: int = 0, pages: int = 1, said: int | None = None):
        self.label, self.children, self.text = label, children if children is not None else [], text
        self.optional, self.repeated, self.size, self.pages, self.said = optional, repeated, size, pages, said

    def packed(self) -> list:
        return [self.label, int(self.optional), int(self.repeated), self.size, self.pages, self.said, [c.packed() for c in self.children]]

    @staticmethod
    def unpacked(data: list) -> Node:
        return Node(data[0], [Node.unpacked(c) for c in data[6]], "", bool(data[1]), bool(data[2]), data[3], data[4], data[5])

    @property
    def template(self) -> bool:
        """Text that enough pages have, all of them the same."""
        return self.said is not None and self.pages >= TEMPLATE_PAGES


def said(text: str) -> int:
    """A hash of a text with its white space made one space."""
    return int.from_bytes(hashlib.blake2b(" ".join(text.split()).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _label(name: str, attrs: str) -> str:
    """An element's label: its name, and its words of class, id, role and itemprop without numbers."""
    if "=" not in attrs and "hidden" not in attrs:
        return name
    words = []
    for key, *values in _ATTRIBUTE.findall(attrs):
        value = next((v for v in values if v), "")
        if key.lower() in ("hidden", "aria-hidden"):
            if key.lower() == "hidden" or value.lower() == "true":
                words.append("hidden")
            continue
        words += [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower() if key.lower() != "itemprop" else value.lower()) if w]
    return name + "." + ".".join(sorted(set(words))) if words else name


def parse(page: str) -> Node:
    """The tree of a page. End tags that are left out are put in where a following tag calls for them; stray ones are passed over."""
    root = Node("")
    stack = [root]
    names = [""]
    at, size = 0, len(page)
    lowered = None
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            stack[-1].children.append(Node("#", text=page[at:mark]))
        if mark == size:
            break
        hit = _TOKEN.match(page, mark)
        if hit is None:
            following = page.find("<", mark + 1)
            end = size if following < 0 else following
            stack[-1].children.append(Node("#", text=page[mark:end]))
            at = end
            continue
        at = hit.end()
        name = hit["name"]
        if name is None:
            continue
        name = name.lower()
        if hit["close"]:
            if name in names:
                while names.pop() != name:
                    stack.pop()
                stack.pop()
            continue
        if name in _ENDS_P and "p" in names:
            for k in range(len(names) - 1, 0, -1):
                if names[k] == "p":
                    del names[k:], stack[k:]
                    break
                if names[k] in ("button", "td", "th", "table", "object", "caption"):
                    break
        if name in _ENDS:
            ends, within = _ENDS[name]
            for k in range(len(names) - 1, 0, -1):
                if names[k] in within:
                    break
                if names[k] in ends:
                    lowest = k
                    while names[lowest - 1] in ends and names[lowest - 1] not in within:
                        lowest -= 1
                    del names[lowest:], stack[lowest:]
                    break
        node = Node(_label(name, hit["attrs"] or ""))
        stack[-1].children.append(node)
        if name in _RAW:
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find("</" + name, at)
            close = -1 if end < 0 else page.find(">", end)
            at = size if close < 0 else close + 1
        elif name not in _EMPTY and not (hit["attrs"] or "").endswith("/"):
            stack.append(node)
            names.append(name)
    return root




def fold(node: Node) -> Node:
    """A page's tree as a wrapper: neighbours with one label become one repeated group, text a slot with its length."""
    if node.label == "#":
        return Node("#", size=len(node.text.strip()), said=said(node.text))
    out: list[Node] = []
    for run in runs(node):
        if run[0].label == "#":
            out.append(fold(Node("#", text="".join(c.text for c in run))))
            continue
        folded = fold(run[0])
        for child in run[1:]:
            folded = merge(folded, fold(child), one_page=True)
            folded.repeated = True
        if len(run) > 1:
            _one_page(folded)
        out.append(folded)
    return Node(node.label, out)


def runs(node: Node) -> list[list[Node]]:
    """The children of a page's element, neighbours with one label together, text without any left out."""
    out: list[list[Node]] = []
    for child in node.children:
        if child.label == "#" and not child.text.strip():
            continue
        if out and out[-1][0].label == child.label:
            out[-1].append(child)
        else:
            out.append([child])
    return out


def _one_page(node: Node) -> None:
    """A group merged from neighbours of one page is still that page's."""
    node.pages = 1
    for child in node.children:
        _one_page(child)


def align(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence of two label lists, as pairs of places, after common ends are taken off."""
    low = 0
    while low < min(len(left), len(right)) and left[low] == right[low]:
        low += 1
    high = 0
    while high < min(len(left), len(right)) - low and left[-1 - high] == right[-1 - high]:
        high += 1
    a, b = left[low : len(left) - high], right[low : len(right) - high]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    pairs = [(k, k) for k in range(low)]
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((low + i, low + j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + [(len(left) - k, len(right) - k) for k in range(high, 0, -1)]


def merge(left: Node, right: Node, one_page: bool = False) -> Node:
    """The wrapper of both. Tokens that only one has become optional groups; neighbours that then have one label, a repeated group; texts share a slot.

    Of ``one_page`` the texts of a repeated group count as one text, so that copies of a page agree in all they say.
    """
    children: list[Node] = []
    at_left = at_right = 0
    pairs = align([c.label for c in left.children], [c.label for c in right.children])
    for i, j in [*pairs, (len(left.children), len(right.children))]:
        for only in left.children[at_left:i] + right.children[at_right:j]:
            only.optional = True
            children.append(only)
        if i < len(left.children):
            children.append(merge(left.children[i], right.children[j], one_page))
        at_left, at_right = i + 1, j + 1
    joined: list[Node] = []
    for child in children:
        if joined and joined[-1].label == child.label:
            joined[-1] = merge(joined[-1], child, one_page)
            joined[-1].repeated = child.label != "#"
        else:
            joined.append(child)
    agreed = left.said if left.said == right.said else None
    if one_page and left.said is not None and right.said is not None:
        agreed = said(f"{left.said} {right.said}")
    return Node(left.label, joined, "", left.optional or right.optional, left.repeated or right.repeated, left.size + right.size, left.pages + right.pages, agreed)


def outside(label: str) -> bool:
    """Whether an element is no main text by its name, class, id or role."""
    name, *words = label.split(".")
    return name in _OUTSIDE or "hidden" in words or not _OUTSIDE_WORDS.isdisjoint(words) and name not in ("html", "body", "article", "main")


def _is_main(label: str) -> bool:
    name, *words = label.split(".")
    return name in _MAIN_TAGS or not _MAIN_WORDS.isdisjoint(words)


def _text_size(node: Node) -> int:
    return node.size if node.label == "#" else 0 if outside(node.label) else sum(_text_size(c) for c in node.children)


def _own_size(node: Node) -> int:
    """Text of a group that is not the template's; all of it where too few pages were seen to tell."""
    if node.label == "#":
        return 0 if node.template else node.size
    return 0 if outside(node.label) else sum(_own_size(c) for c in node.children)


_PLAIN = {"#", "p", "pre", "blockquote", "ul", "ol", "table", "h1", "h2", "h3", "h4", "b", "i", "em", "strong", "a", "span", "br", "dl"}


def choose(wrapper: Node) -> None:
    """Mark the groups of a wrapper that hold the main text.

    These are the outermost article and main elements with text (``text`` "main"). Without any, the slots decide: the group whose own paragraphs hold most of
    the text that pages do not share, and the groups beside it that hold some such text too (``text`` "own"); a group that a minority of the
    pages have is beside it only where it holds as much text on these pages as a paragraph does.
    """
    found: list[Node] = []
    best: list[tuple[int, Node, Node | None]] = []

    def walk(node: Node, parent: Node | None) -> None:
        if outside(node.label) or node.label.split(".")[0] == "header":
            return
        if _is_main(node.label) and _text_size(node):
            found.append(node)
            return
        best.append((sum(_own_size(c) for c in node.children if c.label.split(".")[0] in _PLAIN), node, parent))
        for child in node.children:
            walk(child, node)

    walk(wrapper, None)
    if found:
        inner = [n for f in found if f.label.split(".")[0] != "article" for n in _articles(f)]
        mains = [f for f in found if f.label.split(".")[0] == "article"] + inner
        for node in mains or found:
            node.text = "main"
    elif best and (top := max(best, key=lambda x: x[0]))[0]:
        _, chosen, parent = top
        beside = [chosen] if parent is None else [c for c in parent.children if c is chosen or _goes_beside(c, chosen)]
        for node in beside:
            node.text = "own"


PARAGRAPH = 40
"""Characters a page that a group beside the main one holds, if not most pages have it."""


def _goes_beside(node: Node, chosen: Node) -> bool:
    """Whether a neighbour of the chosen group is main text as well."""
    name = node.label.split(".")[0]
    if name in ("#", "header") or outside(node.label) or not _own_size(node):
        return False
    common = 2 * node.pages >= chosen.pages and not (node.optional and node.repeated)
    return common or _own_size(node) >= PARAGRAPH * node.pages


def _articles(node: Node) -> list[Node]:
    out = []
    for child in node.children:
        if outside(child.label):
            continue
        if child.label.split(".")[0] == "article" and _text_size(child):
            out.append(child)
        else:
            out += _articles(child)
    return out


def extract(page: Node, wrapper: Node) -> list[str]:
    """Blocks of a page's main text, by aligning the page with its host's wrapper and reading the slots of the marked groups."""
    blocks: list[list[str]] = [[]]

    def read(node: Node, group: Node | None = None) -> None:
        """Read an element; with its ``group``, without text that is the template's."""
        if node.label == "#":
            blocks[-1].append(node.text)
            return
        name = node.label.split(".")[0]
        if outside(node.label) or name == "header" and any(w in node.label for w in (".site", ".page", ".top")):
            if name in _BLOCK:
                blocks.append([])
            return
        if name == "br":
            blocks[-1].append(" ")
        block = name in _BLOCK
        if block:
            blocks.append([])
        if group is None:
            for child in node.children:
                read(child)
        else:
            together = runs(node)
            found = dict(align([r[0].label for r in together], [c.label for c in group.children]))
            for k, run in enumerate(together):
                known = group.children[found[k]] if k in found else None
                if known is not None and known.template and known.said == said("".join(c.text for c in run)):
                    continue
                for child in run:
                    read(child, known if child.label != "#" else None)
        if block:
            blocks.append([])

    def descend(node: Node, group: Node) -> None:
        if group.text:
            read(node, group if group.text == "own" else None)
            return
        together = runs(node)  # neighbours with one label stand for one repeated group
        for i, j in align([r[0].label for r in together], [c.label for c in group.children]):
            for child in together[i]:
                if child.label != "#":
                    descend(child, group.children[j])

    descend(page, wrapper)
    texts = [" ".join(html.unescape("".join(b)).split()) for b in blocks]
    return [t for t in texts if t]


def main_text(page: str, wrapper: Node | None) -> str:
    """Main text of a page. A page in which its host's wrapper finds none is read by a wrapper of its own."""
    tree = parse(page)
    blocks = extract(tree, wrapper) if wrapper is not None else []
    if not blocks:
        own = fold(tree)
        choose(own)
        blocks = extract(tree, own)
    return "\n\n".join(blocks)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of the hosts of a partition, each page merged into its host's."""
    held: dict[str, Node] = {}

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(n.packed()) for n in held.values()], pa.string())], names=["host", "wrapper"])

    for batch in arrowtext.slices(batches, "html"):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if not page:
                continue
            new = fold(parse(page))
            held[host] = merge(held[host], new) if host in held else new
            if len(held) >= HOSTS_AT_ONCE:
                yield packed()
                held.clear()
    if held:
        yield packed()


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """One wrapper of several of a host, in a fixed order."""
    merged = None
    for text in sorted(frame["wrapper"]):
        node = Node.unpacked(json.loads(text))
        merged = node if merged is None else merge(merged, node)
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [json.dumps(merged.packed())]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """A wrapper for each host of ``pages(host, html)``: (host, wrapper as JSON).

    Pages are merged where they are read, then wrappers in SPREAD groups a host, then per host; so a host with a third of all pages sends
    one wrapper a task and no task gathers its pages.
    """
    partial = pages.mapInArrow(tidy(_infer), "host string, wrapper string")
    spread = partial.withColumn("spread", F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD)))
    some = spread.groupBy("host", "spread").applyInPandas(_merged, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(_merged, "host string, wrapper string")


@lru_cache(maxsize=256)
def _chosen(wrapper: str | None) -> Node | None:
    if wrapper is None:
        return None
    node = Node.unpacked(json.loads(wrapper))
    choose(node)
    return node


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrowtext.slices(batches, "html"):
        pages = pc.fill_null(batch.column("html").cast(pa.large_string()), "").to_pylist()
        texts = [main_text(page, _chosen(wrapper)) if page else "" for page, wrapper in zip(pages, batch.column("wrapper").to_pylist())]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages(page_id, url, html)``: page_id, url, text, n_chars.

    The host's wrapper tells which groups of a page hold its main text: articles, or else the groups with the most text that the host's pages do not
    share, without what they do share (``choose``); menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments within are left out.
    Character references are decoded, white space in a block is one space, blocks are joined by two newlines. ``n_chars`` counts code points.

    Null and empty html has an empty text. Pages without a host, such as null urls, share a wrapper. A page with no place in its host's wrapper is read
    by itself. Repeated rows and ids each get their row; long pages are read whole; other columns are ignored.
    """
    named = with_url_parts(pages.select("page_id", "url", "html"), F.col("url")).select("page_id", "url", "html", "host")
    wrappers = stored(infer_wrappers(named.select("host", "html")), "page-wrappers")
    joined = named.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(tidy(_texts), "page_id long, url string, text string, n_chars long")
