"""Main text of web pages by tag-path ratios.

A page's text falls into blocks at the tags of block elements. A block's path is the chain of block elements above it,
with their classes. The ratios decide between regions, and every block of a region that is content is kept, however short.

A path's ratios are its text length outside links and its punctuation per block, smoothed over neighbouring blocks, the more the
longer the stretch of path they share. The sum of their logarithms is the path's score; a path through an element that says
it is something else (nav, footer, class "comments", "user-comments", role "banner") keeps SIGNED of it. Such an element is a region. So are an
article or main element, in these a container whose text is nearly all links, and each container in which the rest of the page
parts. A region has the score of its best path times its share of text outside links, and is content if that reaches
LEAST of the best one without a sign, or, outside articles, if it holds an h1. The rest as a whole, and articles with links for a part
of their text, as teasers have, are content only if they have OTHER of the text of the largest article or rest.

A class is a sign as a whole ("side", not "side-effects"). A container's classes, outside articles its ids too, are also signs if their last
part is ("user-comments"), if all their parts are signs, places or names of elements ("cookie-notice", "share-buttons"), or if a
part names adverts; but not if the container holds an h1. Scripts, forms, hidden elements and the like are never content.

Markup is read once, left to right, in time linear in the page, whatever is unclosed or misnested: the open elements are a
stack with a count per name, so an end tag without a start is ignored at once, and every element is popped once.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the best path's score from which on a path is content; how many blocks smoothing looks ahead and back.
LEAST, REACH = 0.04, 3
#: What a path through an element with a sign keeps of its score.
SIGNED = 0.005
#: Share of the largest region's characters from which on the rest of the page, or a teaser, is content beside it; the share of
#: its text in links that makes an article a teaser, and the one that makes a container within an article a list of links.
OTHER, TEASER, LINKED = 0.15, 0.2, 0.8
#: Open elements that a path remembers; deeper ones count as these, but for the first with a sign.
DEEPEST = 48

# Elements by their role in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section select
    summary table tbody td template tfoot th thead tr ul video audio canvas object svg math button label""".split())
_NEVER = frozenset("""form script style noscript iframe template select button textarea dialog head title
    object svg math canvas video audio fieldset label option xmp noembed noframes""".split())
_FURNITURE = frozenset("nav aside footer menu".split())
_CLOSES_P = _BLOCK - frozenset("option optgroup button label svg math canvas video audio object".split())
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead")}
_SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dd": ("dl",), "dt": ("dl",), "option": ("select",)}
#: Elements that hold a part of a page.
_PARTS = frozenset("div section article main table tbody tr td center details dl ul ol".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
_SIGNS = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsbygoogle sponsor sponsored promo promotion banner
    sidebar side aside comment comments comment-list commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice notices
    notification alert menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing
    social related recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget widgets tags pagination pager
    skip copyright legal disclaimer""".split())
#: Words that say only where an element stands; with a sign they make a sign ("footer-top", "cookie-box").
_PLACES = frozenset("site top bottom left right container wrapper wrap box area inner outer primary secondary global sticky fixed bar".split())
#: Elements that hold others; the ids of all others name what the text is about.
_HOLDERS = frozenset("div section header ul ol dl table tbody tr td center details figure menu dir".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+", re.I)
_LETTERS = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def _element_name(word: str) -> bool:
    return word in _BLOCK or word in _VOID or word.removesuffix("s") in _BLOCK or word.removesuffix("s") in _VOID


def _is_sign(word: str, in_article: bool) -> bool:
    return word in _SIGNS and not (in_article and word == "header")


def _compound_sign(word: str, in_article: bool) -> bool:
    """Whether a class or id of several words says that its element is something else."""
    parts = _LETTERS.findall(word)
    if len(parts) < 2:
        return False
    signs = [_is_sign(x, in_article) for x in parts]
    return any(signs) and (signs[-1] or any(x.startswith("ad") for x, sign in zip(parts, signs) if sign)
                           or all(sign or x in _PLACES or _element_name(x) for x, sign in zip(parts, signs)))


def _sort(name: str, attributes: str, in_article: bool) -> tuple[str, bool, str]:
    """What an element is called in a path, whether it can hold content, and its sign: "!", "?" for one by a compound, or none."""
    never = name in _NEVER
    sign = name in _FURNITURE or (name == "header" and not in_article)
    compound = False
    if not attributes or attributes.isspace():
        return name, never, "!" if sign else ""
    words: list[str] = []
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key == "role":
            sign |= value.strip() in _ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            never |= key == "aria-hidden" or value != "until-found"
        else:
            words += value.split()
            if name in ("html", "body", "article", "main"):
                continue
            if key == "class" or name in _HOLDERS:
                sign |= any(_is_sign(w, in_article) for w in value.split())
            if name in _HOLDERS and (key == "class" or not in_article):
                compound |= any(_compound_sign(w, in_article) for w in value.split())
    return ".".join((name, *words[:3])), never, "!" if sign else "?" if compound else ""


@dataclass(frozen=True)
class Block:
    """A text with its path, its characters inside links, the outermost article or main element that holds it (its place in
    the path from 1, or 0 without one, and its number), the numbers of the containers within that, and its sign: where in the path
    the first element with one stands (from 1, 0 without one) and its kind."""

    path: tuple[str, ...]
    text: str
    linked: int
    article: tuple[int, int] = (0, 0)
    holders: tuple[int, ...] = ()
    sign: tuple[int, str] = (0, "")

    @property
    def plain(self) -> int:
        return len(self.text) - self.linked


def blocks(page: str) -> list[Block]:
    """Every block that may be content, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str, bool]] = []  # name, name in paths, never content
    signs: list[tuple[int, str]] = []  # elements with one: their places in the stack, from 1, and kinds
    holders: list[tuple[int, int]] = []  # containers within an article: their places and numbers
    numbered = 0
    count: Counter[str] = Counter()
    barred = links = articles = 0
    article = (0, 0)
    text: list[str] = []
    linked = 0
    no_comment_end = no_quote_end = False

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                path, sign = tuple(s[1] for s in stack[:DEEPEST]), signs[0] if signs else (0, "")
                if sign[0] > DEEPEST:
                    path, sign = (*path, stack[sign[0] - 1][1]), (DEEPEST + 1, sign[1])
                out.append(Block(path, joined, min(linked, len(joined)), article if articles else (0, 0),
                                 tuple(h[1] for h in holders[:DEEPEST]), sign))
            text.clear()
        linked = 0

    def pop() -> None:
        nonlocal barred, articles
        if signs and signs[-1][0] == len(stack):
            signs.pop()
        if holders and holders[-1][0] == len(stack):
            holders.pop()
        name, _, never = stack.pop()
        count[name] -= 1
        barred -= never
        articles -= name in ("article", "main")

    at, end = 0, len(page)
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at and not barred:
            text.append(page[at:open_at])
            if links:
                linked += open_at - at
        if open_at == end:
            break
        if page.startswith("<!--", open_at):
            close = -1 if no_comment_end else page.find("-->", open_at + 4)
            if close < 0:  # never closed: the rest is a comment
                no_comment_end = True
                break
            at = close + 3
            continue
        if page[open_at + 1:open_at + 2] in ("!", "?"):
            close = page.find(">", open_at)
            at = end if close < 0 else close + 1
            continue
        match = None if no_quote_end else _TAG.match(page, open_at)
        if match is None and not no_quote_end and re.match(r"</?[a-zA-Z]", page[open_at:open_at + 3]):
            no_quote_end = True  # a quote or tag that never ends; from here tags end at the next ">"
        if match:
            closing, name, attributes, at = match[1], match[2].lower(), match[3], match.end()
        else:
            plain = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)").match(page, open_at)
            close = page.find(">", open_at) if plain else -1
            if close < 0:
                if plain:  # a tag cut off by the page's end
                    break
                if not barred:
                    text.append("<")
                at = open_at + 1
                continue
            closing, name, attributes, at = plain[1], plain[2].lower(), page[plain.end():close], close + 1
        if closing:
            if name in _BLOCK:
                if count[name]:
                    flush()
                    while stack[-1][0] != name:
                        pop()
                    pop()
            elif name == "a":
                links = max(0, links - 1)
            continue
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            close = page.find(">", stop.start()) if stop else -1
            at = end if close < 0 else close + 1
            continue
        if name == "a":
            links = 1
            continue
        if name == "br":
            if not barred:
                text.append(" ")
            continue
        if name not in _BLOCK:
            continue
        flush()
        if name in _VOID:
            continue
        if count["p"] and name in _CLOSES_P:
            while stack[-1][0] != "p":
                pop()
            pop()
        if name in _ENDS and any(count[x] for x in _ENDS[name]):
            scope = _SCOPE.get(name, ("table",))
            while stack and stack[-1][0] not in scope and any(count[x] for x in _ENDS[name]):
                pop()
        label, never, sign = _sort(name, attributes, articles > 0)
        stack.append((name, label, never))
        if sign:
            signs.append((len(stack), sign))
        if articles and name in _PARTS and name not in ("article", "main"):
            numbered += 1
            holders.append((len(stack), numbered))
        count[name] += 1
        barred += never
        if name in ("article", "main"):
            if not articles:
                article = (min(len(stack), DEEPEST), article[1] + 1)
            articles += 1
        links = 0
    flush()
    return out


def _shared(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """The share of the longer path that both begin with."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n / max(len(a), len(b), 1)


def _scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """The score of every path: logarithms, so that one very long block does not outweigh all lists and tables."""
    size: Counter = Counter()
    marks: Counter = Counter()
    nodes: Counter = Counter()
    signed = set()
    for b in found:
        size[b.path] += b.plain
        marks[b.path] += len(_MARKS.findall(b.text)) * b.plain / len(b.text)
        nodes[b.path] += 1
        if b.sign[0]:
            signed.add(b.path)
    paths = [b.path for b in found]
    length = {p: size[p] / nodes[p] for p in nodes}
    points = {p: marks[p] / nodes[p] for p in nodes}
    smooth_l: Counter = Counter()
    smooth_p: Counter = Counter()
    kernel = [math.exp(-(d * d) / (2 * (REACH / 2) ** 2)) for d in range(REACH + 1)]
    for i, path in enumerate(paths):
        weight = sum_l = sum_p = 0.0
        for j in range(max(0, i - REACH), min(len(paths), i + REACH + 1)):
            w = kernel[abs(i - j)] * _shared(path, paths[j]) ** 4
            weight += w
            sum_l += w * length[paths[j]]
            sum_p += w * points[paths[j]]
        weight = weight or 1.0
        smooth_l[path] += sum_l / weight / nodes[path]
        smooth_p[path] += sum_p / weight / nodes[path]
    return {p: (math.log1p(smooth_l[p]) + math.log1p(smooth_p[p])) * (SIGNED if p in signed else 1.0) for p in nodes}


def _containers(paths: set[tuple[str, ...]]) -> dict[tuple[str, ...], tuple[str, ...]]:
    """The container of each path: the element in which it parts from the others, or what all share if that is no container."""
    low, high = min(paths), max(paths)
    n = 0
    while n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return {p: p[:n + 1] if len(p) > n and p[n].partition(".")[0] in _PARTS else p[:n] for p in paths}


def _titled(path: tuple[str, ...]) -> bool:
    return any(x == "h1" or x.startswith("h1.") for x in path)


def _without_titled_signs(found: list[Block]) -> list[Block]:
    """A sign by a compound ("page-header") says nothing about an element that holds an h1."""
    titled = {b.path[:b.sign[0]] for b in found if b.sign[1] == "?" and _titled(b.path[b.sign[0]:])}
    return [replace(b, sign=(0, "")) if b.sign[1] == "?" and b.path[:b.sign[0]] in titled else b for b in found] if titled else found


def _regions(found: list[Block]) -> list[tuple]:
    """The region of each block: (kind, what tells it from others of the kind)."""
    text: Counter = Counter()
    linked: Counter = Counter()
    for b in found:
        for h in b.holders:
            text[h] += len(b.text)
            linked[h] += b.linked
    rest = {b.path for b in found if not b.sign[0] and not b.article[0]}
    container = _containers(rest) if rest else {}
    out: list[tuple] = []
    for b in found:
        if b.sign[0]:
            out.append(("sign", b.path[:b.sign[0]]))
        elif b.article[0]:
            links = next((h for h in b.holders if linked[h] >= LINKED * text[h]), None)
            out.append(("article", b.path[:b.article[0]]) if links is None else ("links", links))
        else:
            out.append(("rest", container[b.path]))
    return out


def content(found: list[Block]) -> list[str]:
    """The texts of the blocks whose region is content."""
    found = _without_titled_signs(found)
    regions, scores = _regions(found), _scores(found)
    best: dict[tuple, float] = {}
    size: Counter = Counter()
    plain: Counter = Counter()
    numbers: dict[tuple, set[int]] = {}
    for b, region in zip(found, regions):
        best[region] = max(scores[b.path], best.get(region, 0.0))
        size[region] += len(b.text)
        plain[region] += b.plain
        numbers.setdefault(region, set()).add(b.article[1])
    score = {r: best[r] * plain[r] / size[r] for r in best}
    # At most about a character a block, however long the best path's are.
    least = min(LEAST * max((score[r] for r in score if r[0] != "sign"), default=math.inf), 0.5)
    titled = {r for b, r in zip(found, regions) if r[0] == "rest" and _titled(b.path)}
    kept = {r for r in score if (score[r] >= least and score[r] > 0) or r in titled}
    # Articles of one path count by their mean, the rest as a whole.
    rest = sum(plain[r] for r in kept if r[0] == "rest")
    mean = {r: plain[r] / len(numbers[r]) for r in kept if r[0] == "article"}
    most = max([rest, *mean.values()], default=0)
    kept -= {r for r in kept if r[0] == "rest" and rest < OTHER * most}
    kept -= {r for r in mean if mean[r] < OTHER * most and size[r] - plain[r] >= TEASER * size[r]}
    return [b.text for b, region in zip(found, regions) if region in kept]


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by line feeds; empty for null, empty and contentless pages."""
    return "\n".join(content(blocks(page))) if page else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                              ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id, url, text, n_chars` of every row: its main text and the number of its characters. Map-side only."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(_texts, f"{kinds}, text string, n_chars long")
