"""Main text of web pages by the maximum-scoring run of words and tags.

A page becomes a sequence of tags and text. Words score positive, or negative where their container is boilerplate; tags
score negative. The weights come from labelled pages: pages that mark their own content with an <article> or <main>
element tell which tags and which containers (elements by name, class, id and role) lie inside and outside of it. One linear
scan finds the run with the largest sum; its words outside boilerplate containers, by block, are the text.

Weights are fitted on at most `MAX_LABELLED` pages, those with the smallest hashes of their id.

Cases: a null or empty page has an empty text, as has a page without a word of content; unclosed and stray tags,
comments and raw elements without an end are read as browsers do, roughly; repeated rows give repeated results; an empty table gives
an empty result; pages are read whole. Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import by_text_bytes, map_texts

MAX_LABELLED = 2_000
MIN_PAGES = 5

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg audio video select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary"
    " table tbody td tfoot th thead title tr ul".split()
)
SECTIONS = frozenset("nav header footer aside main article section form dialog menu head title figure button body".split())
SPACING = frozenset(["br", "wbr", "img"])
CLOSES_P = BLOCKS - frozenset(["body", "html", "head", "title", "caption", "tbody", "thead", "tfoot", "tr", "td", "th"])
CONTENT = frozenset(["article", "main"])

# Starting weights of containers, for names that the labelled pages do not settle.
OUTSIDE = (
    "nav header footer aside form dialog menu head title button .nav .navbar .navigation .menu .header .masthead .footer"
    " .sidebar .aside .widget .ad .ads .advert .adverts .advertisement .advertising .banner .promo .promotion .sponsor"
    " .sponsored .cookie .cookies .consent .notice .gdpr .popup .modal .overlay .newsletter .subscribe .subscription .signup"
    " .login .comment .comments .reply .replies .respond .disqus .discussion .feedback .share .sharing .social .related"
    " .recommended .breadcrumb .breadcrumbs .pagination .pager .toolbar .skip .copyright .legal .alert .search .hidden"
    " .complementary .contentinfo .navigation"
).split()
# Words that say where a box stands and nothing of what it holds.
LAYOUT = frozenset(
    "area bar block body bottom box btn button buttons col column container fixed form group head inner item items layout left link"
    " links list lists main nav outer page panel post right row section site small sticky strip text title top widget wrap wrapper"
    " slot unit zone spot label".split()
)
# Class words that mean boilerplate whatever stands beside them.
ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored cookie cookies consent gdpr newsletter navbar sidebar breadcrumb breadcrumbs"
    " pagination comments disqus".split()
)
INSIDE = "main article .article .content .post .entry .story .main .articlebody .maincontent".split()

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>?)",
    re.S,
)
_ATTR = re.compile(r"(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PART = re.compile(r"[a-z]+")


def names_of(tag: str, attrs: str) -> list[str]:
    """What a container is known by: its element name, and each word of its class, id and role with a dot before."""
    found = [tag] if tag in SECTIONS else []
    if "=" not in attrs and "hidden" not in attrs:
        return found
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id", "role"):
            found += ["." + word for word in value.split()]
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or "display:none" in value.replace(" ", ""):
            found.append(".hidden")
    return found


def prior(name: str) -> float:
    """The starting weight of a name that labelled pages do not settle.

    A class word is read by its parts. One part that means boilerplate is enough if it always does, or if the others say only
    where the box stands, as in `share-buttons` or `site-footer`; `share-prices` says something else.
    """
    if name in _PRIOR or not name.startswith("."):
        return _PRIOR.get(name, 0.0)
    parts = [p for p in _PART.findall(name) if p]
    weights = [_PRIOR.get("." + p, 0.0) for p in parts]
    if min(weights, default=0.0) < 0:
        return min(weights) if ALWAYS & set(parts) or all(w or p in LAYOUT for w, p in zip(weights, parts)) else 0.0
    return max(weights, default=0.0)


# Names that an article may use for parts of its own: labelled pages can overturn what is assumed of them.
DOUBTFUL = frozenset(".legal .alert .search .discussion .banner .feedback .complementary".split())
_PRIOR = {n: -2.0 for n in OUTSIDE} | {n: 1.0 for n in INSIDE}


@dataclass
class Node:
    """A tag, or a text with the names of its containers, outermost first."""

    tag: str = ""
    close: bool = False
    text: str = ""
    inside: tuple[tuple[str, ...], ...] = ()
    content: bool = False


def nodes_of(page: str) -> Iterator[Node]:
    """Tags and texts in page order; raw elements are skipped."""
    # Open elements, each with the named containers down to it and whether one of them marks content.
    stack: list[tuple[str, tuple[tuple[str, ...], ...], bool]] = []
    opened: Counter = Counter()
    at, size = 0, len(page)
    inside, content = (), False

    def close(k: int) -> None:
        opened.subtract(t for t, _, _ in stack[k:])
        del stack[k:]

    while at < size:
        m = _TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at:
            yield Node(text=page[at:end], inside=inside, content=content)
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if m["close"]:
            if opened[tag] > 0:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
                inside, content = stack[-1][1:] if stack else ((), False)
            yield Node(tag=tag, close=True)
            continue
        if tag in RAW:
            if not m["attrs"].endswith("/>"):
                over = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = over.end() if over else size
            continue
        yield Node(tag=tag)
        if tag in VOID or m["attrs"].endswith("/>"):
            continue
        if tag in CLOSES_P or tag == "li":
            wanted = "li" if tag == "li" else "p"
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == wanted:
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        inside, content = stack[-1][1:] if stack else ((), False)
        names = tuple(names_of(tag, m["attrs"]))
        inside, content = inside + (names,) if names else inside, content or tag in CONTENT
        stack.append((tag, inside, content))
        opened[tag] += 1


@dataclass
class Weights:
    """Of tags (all negative) and of container names (negative outside content)."""

    tags: dict[str, float] = field(default_factory=dict)
    # What the labelled pages say; other names have their prior.
    names: dict[str, float] = field(default_factory=dict)

    def name(self, name: str) -> float:
        weight = self.names.get(name)
        return prior(name) if weight is None else weight

    def word(self, inside: tuple[tuple[str, ...], ...]) -> float:
        """Of a word: the worst of its containers if one is boilerplate, else the best, else a little."""
        best, worst, in_article = 0.2, 0.0, False
        for names in inside:
            if "article" in names:
                in_article = True
            for name in names:
                if in_article and name.endswith("header") and self.names.get(name, -1.0) < 0:
                    continue  # an article's own heading
                weight = self.name(name)
                best, worst = max(best, weight), min(worst, weight)
        return worst if worst < 0 else min(best, 1.0)

    def score(self, inside: tuple[tuple[str, ...], ...]) -> tuple[float, float]:
        """(weight of a word, what it adds to a run): boilerplate within a content container hardly breaks a run."""
        weight = self.word(inside)
        if weight > 0:
            return weight, weight
        held = any(self.name(name) > 0 for names in inside for name in names)
        return weight, 0.01 * weight if held else 0.25 * weight

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.05)


def count_names(page: str) -> Counter:
    """(kind, name, inside?) of a page that marks its content: words by container, tags by place."""
    found: Counter = Counter()
    if not re.search(r"(?i)<(?:article|main)[\s>]", page):
        return found
    content = False
    for node in nodes_of(page):
        if node.tag:
            if node.tag in CONTENT:
                content = not node.close
            found["tag", node.tag, content] += 1
        else:
            words = len(node.text.split())
            if words:
                # Inside the content element, and in no other element or box that surely is none of the content: what
                # else stands in a box of doubtful name is evidence for that name.
                sure = any(
                    prior(n) < 0 and n not in DOUBTFUL and not (n.endswith("header") and node.content)
                    for names in node.inside
                    for n in names
                )
                for name in {n for names in node.inside for n in names}:
                    found["name", name, node.content and not sure] += words
                    found["pages", name, node.content and not sure] = 1
    return found


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MAX_LABELLED) -> Weights:
    """Weights from at most `most` pages that mark their content."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    marked = rows.where(F.rlike("html", F.lit("(?i)<(article|main)[\\s>]")))
    chosen = marked.select("id").where("id is not null").orderBy(F.xxhash64("id"), "id").limit(most)
    sample = rows.join(F.broadcast(chosen.distinct()), "id")  # at most `most` ids

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in by_text_bytes(batches, "html"):
            for page in batch["html"]:
                total.update(count_names(page))
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["kind", "name", "held", "n"])

    counts = sample.mapInPandas(work, "kind string, name string, held boolean, n bigint")
    seen: dict[tuple[str, str], list[int]] = {}
    # Names of a bounded sample that occur on several of its pages.
    grouped = counts.groupBy("kind", "name", "held").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_PAGES)
    for r in grouped.collect():
        seen.setdefault((r["kind"], r["name"]), [0, 0])[int(r["held"])] = int(r["n"])
    weights = Weights()
    for (kind, name), (out, held) in seen.items():
        odds = math.log((held + 0.5) / (out + 0.5))
        if kind == "tag":
            weights.tags[name] = -0.05 if odds > 0 else max(-1.0, -0.05 + 0.2 * odds)
        elif kind == "name" and sum(seen.get(("pages", name), (0, 0))) >= MIN_PAGES and name not in ("body",):
            # Containers that hold both kinds say nothing.
            if odds > 2:
                weights.names[name] = min(1.0, odds / 4)
            elif odds < -2:
                weights.names[name] = max(-2.0, odds / 2)
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) with the largest sum, the longest of equals; (0, 0) if no sum is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0 and score > 0:
            total, start = 0.0, k
        total += score
        if total > best + 1e-9 or (total >= best > 0 and k + 1 - start > found[1] - found[0]):
            best, found = max(best, total), (start, k + 1)
    return found


def extract_text(page: str, weights: Weights) -> str:
    """The blocks of the best run, white space collapsed, joined by line feeds."""
    nodes = list(nodes_of(page))
    known: dict[tuple, float] = {}
    words, scores = [], []
    for node in nodes:
        if node.tag:
            words.append(0.0)
            scores.append(weights.tag(node.tag))
        else:
            both = known.get(node.inside)
            if both is None:
                both = known[node.inside] = weights.score(node.inside)
            words.append(both[0])
            scores.append(len(node.text.split()) * both[1])
    start, end = best_run(scores)
    blocks, current = [], []
    for node, weight in zip(nodes[start:end], words[start:end], strict=True):
        if node.tag:
            if node.tag in BLOCKS:
                blocks.append(current)
                current = []
            elif node.tag in SPACING:
                current.append(" ")
        elif weight > 0:
            current.append(html.unescape(node.text))
    blocks.append(current)
    texts = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n".join(t for t in texts if t)


def extract(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_text_bytes(batches, "html"):
            batch["text"] = [extract_text(p, weights) for p in batch["html"]]
            yield batch[["id", "url", "text"]]

    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    return map_texts(rows, work, "url string, text string")
