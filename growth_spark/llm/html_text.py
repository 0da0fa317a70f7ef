"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is read as a sequence of tokens. A word scores by the features of where it stands (elements around it, words in
their class, id and role, whether it is in a link, how deep it lies, whether the page names a content element and this is
outside of it), a tag always costs, and both weights are log odds learned from labelled pages. One linear scan finds the
contiguous region of greatest score. Blocks of menus, headers, footers, sidebars, notices, adverts, forms and comments
inside the region are left out. From the first to the last token of a page's content elements (anywhere, on a page that
names none) such blocks cost nothing, so that no text around them is lost.

Labelled pages are those whose markup names its content element (``article`` or ``main``): what lies in it counts as
content, all else as not. About ``LABELLED`` of them are learned from.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Labelled pages that the weights are learned from (all, where there are no more), and pages that a feature must be on.
LABELLED, SEEN = 2000, 3
#: Score of a word that no feature speaks for, and of such a tag; greatest say of a feature, of one that tells of content
#: elements, and greatest score.
WORD, TAG = 0.3, -0.1
SAY, CONTENT_SAY, MOST = 1.5, 8.0, 2.0
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"\S+")
# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("script style noscript template svg math canvas object iframe select option button textarea form nav aside menu head title audio video dialog".split())
# Words in class, id or role that mark what is no main text.
BAD = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu menubar breadcrumb breadcrumbs sidebar aside complementary widget footer foot contentinfo masthead comment comments respond reply replies disqus cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup login search form share sharing social related recommended pager pagination toolbar skip".split())
BAD_OUTSIDE = frozenset("header top topbar topnav side sidenav alert warning toc meta byline legal copyright disclaimer".split())
# Beginnings of names that tell of a layout, not of what an element holds; elements that hold anything.
LAYOUT = ("with", "without", "no", "has", "is")
PLAIN = frozenset("html body div span section font center".split())
CONTENT = frozenset(("article", "main"))
CONTENT_NAMES = frozenset("article content main post entry story".split())
# Words that say nothing of what a named part holds; a name of a word above and others than these tells of
# something else (related-work, share-price), and is no mark.
NEUTRAL = frozenset("area articles bar block blocks box btn button buttons card cards col column container content count counts group header heading holder icon icons inner inside item items label large left line link links list main module outer page panel post posts right row section slot small stories story text title toggle tools top unit units wrap wrapper".split())
# Elements that hold an author's text, whatever they are called.
OWN_TEXT = frozenset(("blockquote", "pre"))
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)


def hidden(attributes: str) -> bool:
    """Whether an attribute is named ``hidden``, or a style says that nothing is displayed."""
    low = attributes.lower()
    if "hidden" not in low and "display" not in low:
        return False
    return any(name.lower() == "hidden" or name.lower() == "style" and _NONE.search(value) for name, value in _ATTRIBUTE.findall(attributes))


def marked(token: list[str], marks: frozenset[str]) -> bool:
    """Whether the words of one name hold a mark, and beside marks only words that say nothing."""
    return not marks.isdisjoint(token) and all(w in marks or w in NEUTRAL or w.isdigit() for w in token)


#: Elements that end an open paragraph or list item of the same kind (their end tags may be missing).
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An open element: its name, whether it (or one around it) is left out, whether it is in a content element, and the
    features that weights are learned for."""

    __slots__ = ("bad", "depth", "features", "inside", "name")

    def __init__(self, name: str, attributes: str, parent: "Node | None") -> None:
        called: list[list[str]] = []
        if attributes and "=" in attributes:
            words = (w.split("-") for m in _NAMES.findall(attributes) for w in (m[0] or m[1] or m[2]).lower().replace("_", "-").split())
            called = [[x for x in w if x] for w in words if w[0] not in LAYOUT]
        names = [x for w in called for x in w]
        self.name = name
        self.inside = bool(parent and parent.inside) or name in CONTENT or not CONTENT_NAMES.isdisjoint(names)
        chrome = name in NEVER or name == "footer" or (name == "header" and not self.inside)
        chrome = chrome or bool(called) and name not in OWN_TEXT and any(marked(w, BAD) for w in called)
        chrome = chrome or bool(attributes) and hidden(attributes) or not (self.inside or BAD_OUTSIDE.isdisjoint(names))
        self.bad = bool(parent and parent.bad) or (chrome and name not in ("html", "body") and not (name in CONTENT))
        self.depth = parent.depth + (name not in INLINE) if parent else 0
        own = ([] if name in PLAIN or name in INLINE and name != "a" else [f"e:{name}"]) + [f"c:{x}" for x in names if not x.isdigit()]
        have = parent.features if parent else ()
        self.features = have + tuple(x for x in dict.fromkeys(own) if x not in have) if own else have

    def all_features(self, named: bool) -> tuple[str, ...]:
        """With those that hang on the page: how deep, and whether it is outside of the content that the page names."""
        place = "x:in" if self.inside else "x:out" if named else "x:"
        return (*self.features, f"d:{min(self.depth // 3, 4)}", place)


def tokens(page: str) -> Iterator[tuple[str, Node, str]]:
    """("tag", node, "") for tags that begin or end a block, ("br", …) for line breaks, ("text", node, text) for text."""
    root = Node("", "", None)
    stack = [root]
    blocks: list[int] = []  # where blocks stand in the stack
    opened: Counter = Counter()
    at = 0

    def close(k: int) -> None:
        for node in stack[k:]:
            opened[node.name] -= 1
        del stack[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", stack[-1], page[at:]
            return
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()]
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                node = stack[k]
                close(k)
                yield ("in" if name in INLINE else "tag"), node, ""
            continue
        if name in VOID:
            yield ("br" if name == "br" else "in" if name in INLINE else "tag"), Node(name, "", stack[-1]), ""
            continue
        if name not in INLINE:
            # A block ends a paragraph that is open, with the inline elements left open in it.
            if blocks and (stack[blocks[-1]].name == "p" or stack[blocks[-1]].name in CLOSES.get(name, ())):
                close(blocks[-1])
        node = Node(name, m.group(3), stack[-1])
        yield ("in" if name in INLINE else "tag"), node, ""
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            yield "text", node if node.bad else Node("script", "", stack[-1]), page[at : end.start() if end else len(page)]
            at = end.end() if end else len(page)
        elif not m.group(3).rstrip().endswith("/") or name not in ("svg",):
            if name not in INLINE:
                blocks.append(len(stack))
            opened[name] += 1
            stack.append(node)


Counts = dict[tuple[str, str, bool], int]


def learn_counts(page: str) -> Counter:
    """How many words and tags have each feature (and how many there are), in content and outside of it."""
    found: Counter = Counter()
    parts = list(tokens(page))
    named = any(node.inside for _, node, _ in parts)
    for kind, node, text in parts:
        n = len(_WORDS.findall(text)) if kind == "text" else 1
        label = node.inside and not node.bad
        for f in ("", *node.all_features(named)) if n else ():
            found["word" if kind == "text" else "tag", f, label] += n
    return found


class Weights:
    """Scores of words and tags: sums of the log odds of their features, each within its say."""

    def __init__(self, counts: Counts) -> None:
        total = {(kind, label): counts.get((kind, "", label), 0) + 2 for kind in ("word", "tag") for label in (True, False)}
        self.odds: dict[tuple[str, str], float] = {}
        for kind, f in {k[:2] for k in counts if k[1]}:
            odds = math.log((counts.get((kind, f, True), 0) + 1) / total[kind, True]) - math.log((counts.get((kind, f, False), 0) + 1) / total[kind, False])
            say = CONTENT_SAY if f in ("x:in", "x:out") else SAY
            self.odds[kind, f] = min(max(odds, -say), say)
        self.known: dict[tuple[str, tuple[str, ...], bool], float] = {}

    def of(self, kind: str, node: Node, named: bool) -> float:
        key = (kind, node.all_features(named), node.bad)
        score = self.known.get(key)
        if score is None:
            score = sum(self.odds.get((kind, f), 0.0) for f in key[1])
            score = (min(WORD + score, MOST) if not node.bad else -1.0) if kind == "word" else min(TAG + min(score, TAG / -2), TAG / 2)
            if len(self.known) < 10_000:
                self.known[key] = score = max(score, -MOST)
        return max(score, -MOST)


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the best region, joined by empty lines; "" where no region scores above zero."""
    parts = list(tokens(page))
    named = any(node.inside for _, node, _ in parts)
    content = [i for i, (_, node, _) in enumerate(parts) if node.inside and not node.bad]
    first, last = (content[0], content[-1]) if content else (0, len(parts))
    best, best_from, best_to = 0.0, 0, 0
    score, begin = 0.0, 0
    for i, (kind, node, text) in enumerate(parts):
        if node.bad and first <= i <= last:
            continue
        if kind == "text":
            score += weights.of("word", node, named) * len(_WORDS.findall(text)) if not text.isspace() else 0.0
        else:
            score += weights.of("tag", node, named)
        if score <= 0.0:
            score, begin = 0.0, i + 1
        elif score > best:
            best, best_from, best_to = score, begin, i + 1
    blocks: list[str] = []
    own: list[str] = []
    for kind, node, text in parts[best_from:best_to]:
        if kind == "text":
            if not node.bad:
                own.append(text)
        elif kind == "br":
            own.append(" ")
        elif kind == "tag" and own:
            blocks.append("".join(own))
            own = []
    blocks.append("".join(own))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def learn(pages: DataFrame, page: str = "html", most: int = LABELLED) -> Counts:
    """Counts from about ``most`` labelled pages, those whose hash lies low enough; summed by Spark. Features of fewer
    than ``SEEN`` pages go."""
    labelled = pages.select(F.col(page).alias("_html")).filter(F.col("_html").rlike(r"(?i)<(article|main)[\s>]"))
    there = labelled.count()
    low = labelled.filter(F.pmod(F.xxhash64(F.lit("labelled"), "_html"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, most / there))) if there else labelled

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        found: Counter = Counter()
        seen: Counter = Counter()
        for batch in batches:
            for t in batch["_html"].to_pylist():
                counts = learn_counts(t)
                found.update(counts)
                seen.update(counts.keys())
        keys = list(found)
        yield {"kind": [k[0] for k in keys], "feature": [k[1] for k in keys], "content": [k[2] for k in keys], "n": [found[k] for k in keys], "pages": [seen[k] for k in keys]}

    counted = map_batches(low, body, "kind string, feature string, content boolean, n bigint, pages bigint").groupBy("kind", "feature", "content").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    return {(r["kind"], r["feature"], r["content"]): r["n"] for r in counted.filter(F.col("pages") >= SEEN).collect()}


def extract(pages: DataFrame, counts: Counts | None = None, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: key, url, text and n_chars (code points).

    Null and empty pages, and pages without any content, give an empty text. A page without markup is its own text.
    Repeated rows each give a row; other columns are not read. One pass over the pages beside the two of the learning.
    """
    shared = learn(pages, page) if counts is None else counts

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        weights = Weights(shared)
        for batch in batches:
            texts = [main_text(t, weights) for t in batch["_html"].to_pylist()]
            yield {key: batch[key], url: batch[url], "text": texts, "n_chars": list(map(len, texts))}

    rows = pages.select(F.col(key), F.col(url), F.coalesce(F.col(page), F.lit("")).alias("_html"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (key, url))
    return map_batches(rows, body, f"{kinds}, text string, n_chars bigint")
