"""Main text of web pages as the maximum-scoring subsequence of a page's words and tags.

Words score positive and tags negative, by weights learned from labelled pages: pages whose markup
names their own article. One linear scan finds the contiguous stretch with the largest sum.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

from pyspark.sql import DataFrame, functions as F

from lakesteps.llm.common import free_name, per_text, text_or_empty

#: Pages the weights are learned from: at most so many, chosen by a hash of the id.
SAMPLE = 400
#: Words of elements left out: small, so a notice inside an article does not cut it in two.
LEFT_OUT = -0.05
#: Words of the default score that count beside the words seen at a place.
PRIOR_WORDS = 50
#: Least words of a block outside links that make it long.
LONG = 12

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea|title)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?/a-zA-Z][^>]*\Z|<!.*?>|<\?.*?>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul caption".split())
#: Elements and names that never hold article text.
ASIDE_TAGS = frozenset("nav footer aside form button select dialog menu head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense banner promo promotion sponsor sponsored cookie "
    "cookies consent gdpr notice notices alert newsletter subscribe subscription sidebar menu "
    "navbar nav navigation breadcrumb breadcrumbs footer topbar masthead comment comments comentarios "
    "commentaires kommentare disqus reply replies respond discussion share sharing social related recommended widget popup "
    "modal overlay login signin signup search pagination pager toolbar skip".split())
#: Names of those that leave an element out also inside an article; others may name a part of one.
NEVER_ARTICLE = frozenset(
    "ad ads advert adverts advertisement adsense cookie cookies newsletter sidebar navbar breadcrumb breadcrumbs "
    "comments comentarios commentaires kommentare disqus pagination".split())
#: Words that may stand beside such a name without changing what it says.
BESIDE = frozenset(
    "area bar block bottom box container global inner left links list main outer page primary right secondary "
    "section site top wrap wrapper".split())
#: Headings and paragraphs are not left out for a name: theirs are mostly made from their words.
NAMED_BY_WORDS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
                "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


def _default(place: str) -> float:
    return -1.0 if place.endswith(" a") else 1.0


@dataclass
class Weights:
    """Score of a word by where it stands, and of a tag by its name."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, place: str) -> float:
        found = self.words.get(place)
        return _default(place) if found is None else found

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.5)


def _names_aside(value: str, names: frozenset[str]) -> bool:
    """Whether a class or id, as a whole, is one of the names, alone or with words beside it."""
    for token in value.split():
        words = [w for w in re.split(r"[-_:]+", token) if w]
        if names.intersection(words) and all(w in ASIDE_NAMES or w in BESIDE for w in words):
            return True
    return False


def _left_out(name: str, attributes: str, in_article: bool) -> bool:
    if name in ASIDE_TAGS or name == "header" and not in_article:
        return True
    if name in ("html", "body", "main", "article") or not attributes:
        return False
    given: dict[str, str] = {}
    for key, *values in ATTRIBUTE.findall(attributes):
        given.setdefault(key.lower(), "".join(values).lower())
    if given.get("role") in ASIDE_ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if NO_DISPLAY.search(given.get("style", "")):
        return True
    names = NEVER_ARTICLE if in_article else ASIDE_NAMES
    return name not in NAMED_BY_WORDS and any(_names_aside(given.get(k, ""), names) for k in ("class", "id"))


def tokens(page: str) -> list[tuple[str, str, str, bool, bool]]:
    """(kind, place, value, left out, in an article): kind text with the raw text, or tag with the name.

    The place tells the length of the block (between two block tags), and its tag or that it is in
    a link; not whether it is in an article, which pages need not name.
    """
    seen, block, words = [], [], 0

    def settle() -> None:
        nonlocal words
        length = "long" if words >= LONG else "short"
        seen.extend((kind, f"{length} {place}", *rest) for kind, place, *rest in block)
        block.clear()
        words = 0

    for token in _tokens(page):
        kind, place, value, gone, _ = token
        if kind == "tag" and value in BLOCKS:
            settle()
        elif kind == "text" and place != "a" and not gone:
            words += len(value.split())
        block.append(token)
    settle()
    return seen


def _tokens(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    stack: list[tuple[str, bool]] = []  # open elements, and whether each is left out
    out = articles = links = at = 0
    block = "body"

    def close(upto: int) -> None:
        nonlocal out, articles, links
        while len(stack) > upto:
            name, gone = stack.pop()
            out -= gone
            articles -= name in ("article", "main")
            links -= name == "a"

    place = lambda: "a" if links else block
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", place(), page[at:m.start()], out > 0, articles > 0
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
        elif name not in VOID:
            for i in range(len(stack) - 1, max(-1, len(stack) - 4), -1):
                if stack[i][0] in SELF_CLOSING.get(name, ()):
                    close(i)
                    break
            gone = _left_out(name, m[4], articles > 0)
            if not m[4].endswith("/"):
                stack.append((name, gone))
                out += gone
                articles += name in ("article", "main")
                links += name == "a"
        if name in BLOCKS:
            block = name if not m[2] else next((n for n, _ in reversed(stack) if n in BLOCKS), "body")
        yield "tag", place(), name, out > 0, articles > 0
    if at < len(page):
        yield "text", place(), page[at:], out > 0, articles > 0


def learn(pages: list[str]) -> Weights:
    """Weights from the pages that name their article; the defaults where there is none."""
    words: dict[bool, Counter] = {True: Counter(), False: Counter()}
    tags: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for page in pages:
        if not re.search(r"<(article|main)\b", page, re.I):
            continue
        for kind, place, value, gone, inside in tokens(page):
            if not gone and kind == "text":
                words[inside][place] += len(value.split())
            elif not gone:
                tags[inside][value] += 1
    learned = Weights()
    for place in words[True].keys() | words[False].keys():
        prior = PRIOR_WORDS * exp(_default(place))
        odds = log((words[True][place] + prior) / (words[False][place] + PRIOR_WORDS))
        learned.words[place] = min(2.0, max(-2.0, odds))
    for name in tags[True].keys() | tags[False].keys():
        share = tags[False][name] / (tags[True][name] + tags[False][name])
        learned.tags[name] = -0.02 - share
    return learned


def _best_span(seen: list[tuple[str, str, str, bool, bool]], weights: Weights) -> tuple[int, int]:
    """Start and end of the stretch with the largest sum; (0, 0) if none is above zero."""
    named = any(inside for *_, inside in seen)
    best, best_span, sum_, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, place, value, gone, inside) in enumerate(seen):
        if kind == "tag":
            score = LEFT_OUT if gone else weights.tag(value)
        else:
            score = len(value.split()) * (LEFT_OUT if gone else weights.word(place))
            if named and not inside and not gone:  # the page says where its article is
                score = -abs(score)
        if sum_ <= 0:
            sum_, start = 0.0, i
        sum_ += score
        if sum_ > best:
            best, best_span = sum_, (start, i + 1)
    return best_span


def main_text(page: str, weights: Weights) -> str:
    """The best region's text: one line per block; empty if no region scores above zero."""
    seen = tokens(page)
    best_span = _best_span(seen, weights)
    if best_span == (0, 0):  # a page unlike those learned from
        best_span = _best_span(seen, Weights())
    blocks, line = [], []
    for kind, _, value, gone, _ in seen[slice(*best_span)]:
        if kind == "text":
            if not gone:
                line.append(html.unescape(value))
        elif value in BLOCKS:
            blocks.append("".join(line))
            line = []
        elif value == "br":
            line.append(" ")
    blocks.append("".join(line))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def learned_weights(pages: DataFrame, id: str = "page_id", html: str = "html",
                    sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` pages that name their article."""
    marked = pages.where(F.col(f"`{html}`").rlike(r"(?i)<(article|main)\b"))
    rows = marked.orderBy(F.xxhash64(F.col(f"`{id}`"), F.lit(8)), F.col(f"`{id}`")).limit(sample)
    return learn([r[0] for r in rows.select(F.col(f"`{html}`")).collect()])


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
                 weights: Weights | None = None) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars.

    Null or empty pages, and pages without a region above zero, give an empty text. Repeated rows
    get the same answer each; other columns are ignored. Nothing is shuffled.
    """
    weights = weights or learned_weights(pages, id, html)
    source = free_name(pages, "__html")
    rows = pages.select(F.col(f"`{id}`"), F.col(f"`{url}`"), text_or_empty(html).alias(source))

    def work(texts: list[str]) -> list[tuple]:
        found = (main_text(t, weights) for t in texts)
        return [(t, len(t)) for t in found]

    return per_text(rows, work, "text string, n_chars long", source)
