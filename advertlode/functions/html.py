"""Texts and links of elements on raw pages, picked by simple selectors.

Spark has no HTML functions and its XML ones reject ordinary pages, so one Arrow UDF per page kind reads the markup in a
single pass and returns a struct; all that follows is native. A selector is `tag`, `.class` or `tag.class` (more classes
may follow). The text of an element is its text nodes, each stripped, joined by one space; script and style do not
count unless asked for, and the content of a textarea or title is text, not markup. Void tags are empty, and elements
left open end with their parent or at the next sibling of the usual kind. An inline end tag leaves the blocks above it
open, and no end tag reaches out of a table cell. Reading takes time linear in the page: open elements are found by name,
never by a search through all of them, and a match keeps the places of its text, not a copy.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass, fields
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeResult

# Fixed values of the HTML standard: void tags, which open elements a start tag ends, and where that search stops.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = ("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
           "h5 h6 header hr main menu nav ol p pre section table ul").split()
_ENDS = {**{block: frozenset({"p"}) for block in _BLOCKS},
         "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
         "option": frozenset({"option"}), "tr": frozenset({"tr"}),
         "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"})}
_SCOPES = frozenset("html body table td th ul ol dl select button object article section div nav".split())
_END_SCOPES = frozenset("table caption td th object".split())
_TABLE = frozenset("html body table caption colgroup tbody thead tfoot tr td th object".split())
_BLOCK = frozenset(_BLOCKS) | _SCOPES | _TABLE | frozenset(_ENDS)
_ATTRS = r"""([^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+)"""
# What a tag name starts with: the letters that `[a-z]` stands for where case is ignored. A `<` before anything else is text.
_LETTER = r"a-zA-Z\u0130\u0131\u017F\u212A"
_LATER_TEXT = rf"(?:<(?![{_LETTER}/!?])[^<]*+)"


def _plain_element(tag: str) -> str:
    """The start tag and, up to the end tag or the end of the page, the text after it; tag names know ASCII case only."""
    name = "".join(f"[{c}{c.upper()}]" for c in tag)
    return rf"<({name})(?=[\s/>]){_ATTRS}>(.*?(?=(?i:</{tag})[\s/>]|\Z))"


# One token: text; script or style; textarea or title with its attributes and text; any other tag with the text after it; a
# comment; what is left. Only the few letters that need it ignore case, and only tags that may be one of the four are tried as such.
_TOKEN = re.compile(
    rf"""([^<]++{_LATER_TEXT}*+|{_LATER_TEXT}++)
    | (?=<[sS\u017FtT])(?:
        (?i:<(script|style)\b[^>]*+>.*?(?:</\2[^>]*+>|\Z))
        | {_plain_element("textarea")}
        | {_plain_element("title")})
    | <(/?)([{_LETTER}][^\s/>]*+){_ATTRS}>([^<]*+{_LATER_TEXT}*+)
    | <!--.*?(?:-->|\Z)
    | <[^>]*+>?""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*)?((?:\.[\w-]+)*)")


# The default selectors, here and below.
@dataclass(frozen=True)
class ListSelectors:
    """Where a list page keeps its items and, in each, the link, the dates and the id attributes."""

    item: str = ".result-item"
    link: str = "a.result-link"
    published_at: str | None = None
    updated_at: str | None = None
    id_candidates: str | None = None


@dataclass(frozen=True)
class DetailSelectors:
    """Where a detail page keeps its fields; None means the page kind has no such field."""

    title: str | None = None
    job_title: str | None = None
    employer: str | None = None
    locations: str | None = None
    employment_type: str | None = None
    extent: str | None = None
    salary_text: str | None = None
    job_code_blocks: str | None = None
    published_at: str | None = None
    updated_at: str | None = None
    apply_deadline: str | None = None


DEFAULT_LIST = ListSelectors()
DEFAULT_DETAIL = DetailSelectors(
    title="h1.job-title", employer=".employer-name", locations=".job-locations", employment_type=".employment-type",
    extent=".employment-extent", salary_text=".salary", job_code_blocks=".job-codes", published_at="time.published",
    updated_at="time.updated", apply_deadline="time.deadline")


class _Hit:
    """A matching element: its place in the document, its attributes and where its text nodes begin and end."""

    __slots__ = ("name", "start", "end", "attrs", "first", "last")

    def __init__(self, name, start, attrs, first):
        self.name, self.start, self.end, self.attrs, self.first, self.last = name, start, None, attrs, first, None


# What an open element may be, beside its name: a scope of start tags, a scope of end tags, a block.
_KINDS = (_SCOPES, _END_SCOPES, _BLOCK)


class _Open:
    """The open elements of a page, found by name in constant time."""

    def __init__(self):
        self.stack: list[tuple[str, list[_Hit], tuple[int, ...]]] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.kinds: tuple[list[int], ...] = tuple([] for _ in _KINDS)

    def above(self, tags, limit: list[int]) -> int:
        """Depth of the innermost of these tags that is not outside the innermost of `limit`, -1 if none is."""
        depth = -1
        for tag in tags:
            places = self.at[tag]
            if places and places[-1] > depth:
                depth = places[-1]
        return depth if depth >= 0 and (not limit or depth >= limit[-1]) else -1

    def cut(self, depth: int) -> list[_Hit]:
        """Close everything from this depth on; the matches that end with it."""
        ended = []
        while len(self.stack) > depth:
            tag, hits, kinds = self.stack.pop()
            if hits:
                ended += hits
            if tag:
                self.at[tag].pop()
            for kind in kinds:
                self.kinds[kind].pop()
        return ended

    def end(self, tag: str) -> list[_Hit]:
        """An end tag; the matches that end with it."""
        if self.stack and self.stack[-1][0] == tag:
            _, hits, kinds = self.stack.pop()
            self.at[tag].pop()
            for kind in kinds:
                self.kinds[kind].pop()
            return hits
        if not self.at[tag]:
            return []
        depth = self.at[tag][-1]
        _, end_scopes, blocks = self.kinds
        if tag not in _TABLE and end_scopes and end_scopes[-1] > depth:
            return []
        if tag not in _BLOCK and blocks and blocks[-1] > depth:
            # Misnested: the inline element ends, the blocks inside it stay open. It is no scope itself.
            self.at[tag].pop()
            hits = self.stack[depth][1]
            self.stack[depth] = ("", [], ())
            return hits
        return self.cut(depth)


def _rules(selectors) -> list[tuple]:
    """(field name, tag or None, set of classes) per selector that is set."""
    rules = []
    for field in fields(selectors):
        selector = getattr(selectors, field.name)
        if selector:
            match = _SELECTOR.fullmatch(selector.strip())
            if not match:
                raise ValueError(f"only tag, .class and tag.class selectors are supported: {selector!r}")
            tag = match[1].lower() if match[1] else None
            rules.append((field.name, tag, frozenset(match[2].split(".")[1:])))
    return rules


def _attributes(source: str) -> dict:
    found = {}
    for name, double, single, bare in _ATTR.findall(source):
        value = double or single or bare
        found.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return found


def _text(nodes: list[str], joint: str = " ") -> str:
    clean = [(entities.unescape(n) if "&" in n else n).strip() for n in nodes]
    return joint.join([n for n in clean if n]) if len(clean) != 1 else clean[0]


class _Scanner:
    """Finds the elements that match some rules, page after page.

    What a start tag means depends on its text alone, and pages of one site repeat theirs, so that is remembered.
    """

    def __init__(self, rules: list[tuple]):
        self.rules = rules
        self.tags = {tag for _, tag, _ in rules}
        self.known: dict[tuple[str, str], tuple] = {}

    def start_tag(self, name: str, source: str) -> tuple:
        """Lower-case tag, attributes, the fields whose selector matches, which elements it ends, its kinds and whether it is void."""
        tag, attrs, matched = name.lower(), None, ()
        if tag in self.tags or (None in self.tags and "class" in source.lower()):
            attrs = _attributes(source)
            classes = set(attrs.get("class", "").split())
            matched = tuple(field for field, wanted, needed in self.rules
                            if (wanted is None or wanted == tag) and needed <= classes)
        if len(self.known) >= 10_000:
            self.known.clear()
        meaning = self.known[name, source] = (tag, attrs, matched, tuple(_ENDS.get(tag, ())),
                                              tuple(k for k, tags in enumerate(_KINDS) if tag in tags), tag in _VOID)
        return meaning

    def scan(self, page: str) -> tuple[list[_Hit], list[str], list[bool]]:
        """Matching elements in document order, all raw text nodes, and which of these are in the body."""
        hits: list[_Hit] = []
        nodes: list[str] = []
        in_body: list[bool] = []
        tree = _Open()
        stack, at, kinds_at, known = tree.stack, tree.at, tree.kinds, self.known
        scopes, heads, titles = kinds_at[0], at["head"], at["title"]
        place = 0

        def close(ended: list[_Hit]) -> None:
            for hit in ended:
                hit.end, hit.last = place + 1, len(nodes)

        for token in _TOKEN.finditer(page):
            text, _, area, area_attrs, area_text, title, title_attrs, title_text, end, name, source, after = token.groups()
            if end:
                if ended := tree.end(name.lower()):
                    close(ended)
                text = after
            elif not text:
                if name:
                    text = after
                elif area:
                    name, source, text = area, area_attrs, area_text
                elif title:
                    name, source, text = title, title_attrs, title_text
                else:
                    continue
                tag, attrs, matched, ends, kinds, void = known.get((name, source)) or self.start_tag(name, source)
                for ended in ends:
                    if at[ended]:
                        depth = tree.above(ends, scopes)
                        if depth >= 0:
                            close(tree.cut(depth))
                        break
                place += 1
                opened = [_Hit(field, place, attrs, len(nodes)) for field in matched] if matched else ()
                if opened:
                    hits += opened
                if void:
                    close(opened)
                else:
                    depth = len(stack)
                    stack.append((tag, opened, kinds))
                    at[tag].append(depth)
                    for kind in kinds:
                        kinds_at[kind].append(depth)
            if text:
                nodes.append(text)
                in_body.append(not heads and not titles)
        close(tree.cut(0))
        return hits, nodes, in_body


def _fold(text: str | None) -> str | None:
    """Compatibility-decomposed, without combining marks."""
    if text is None or text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")


_FIELDS = tuple(f.name for f in fields(DetailSelectors) if f.name != "job_code_blocks")


def _read_detail(page: str, scanner: _Scanner) -> dict:
    hits, nodes, in_body = scanner.scan(page)
    row = dict.fromkeys(_FIELDS)
    blocks = []
    seen = set()
    for hit in hits:
        if hit.name == "job_code_blocks":
            blocks.append(_text(nodes[hit.first:hit.last]))
        elif hit.name not in seen:
            seen.add(hit.name)
            row[hit.name] = _text(nodes[hit.first:hit.last]) or None
    row["employer_folded"] = _fold(row["employer"])
    row["blocks"] = blocks or [_text([node for node, counts in zip(nodes, in_body) if counts])]
    return row


def _read_items(page: str, scanner: _Scanner) -> list[dict]:
    by_name = {name: [] for name in ("item", "link", "published_at", "updated_at", "id_candidates")}
    hits, texts, _ = scanner.scan(page)
    for hit in hits:
        by_name[hit.name].append(hit)
    starts = {name: [hit.start for hit in hits] for name, hits in by_name.items()}

    def inside(name, item):
        found = by_name[name]
        return found[bisect_left(starts[name], item.start):bisect_left(starts[name], item.end)]

    rows = []
    for item in by_name["item"]:
        links = inside("link", item)
        if not links or not links[0].attrs.get("href"):
            continue
        row = {"href": links[0].attrs["href"],
               "id_candidates": [value for node in inside("id_candidates", item)
                                 for name, value in node.attrs.items() if name.startswith("data-") and value]}
        for name in ("published_at", "updated_at"):
            nodes = inside(name, item)
            row[name] = _text(texts[nodes[0].first:nodes[0].last], "") if nodes else None
        rows.append(row)
    return rows


def _fields_type(texts, lists) -> StructType:
    return StructType([StructField(name, StringType()) for name in texts]
                      + [StructField(name, ArrayType(StringType())) for name in lists])


_DETAIL_TYPE = _fields_type([*_FIELDS, "employer_folded"], ["blocks"])
_ITEMS_TYPE = ArrayType(_fields_type(["href", "published_at", "updated_at"], ["id_candidates"]))


def _struct_array(rows: list[dict], arrow_type: pa.StructType, mask=None) -> pa.StructArray:
    """Rows to Arrow column by column, which is several times faster than row by row."""
    columns = [pa.array([row.get(field.name) for row in rows], field.type) for field in arrow_type]
    return pa.StructArray.from_arrays(columns, fields=list(arrow_type), mask=mask)


def _detail_array(found: list[dict | None]) -> pa.Array:
    return _struct_array([row or {} for row in found], to_arrow_type(_DETAIL_TYPE),
                         pa.array([row is None for row in found], pa.bool_()))


def _items_array(found: list[list[dict] | None]) -> pa.Array:
    ends = list(accumulate((len(items or ()) for items in found), initial=0))
    starts = [None if items is None else start for items, start in zip(found, ends)]
    rows = [row for items in found for row in items or ()]
    return pa.ListArray.from_arrays(pa.array([*starts, ends[-1]], pa.int32()),
                                    _struct_array(rows, to_arrow_type(_ITEMS_TYPE).value_type))


def _page_udf(read, collect, selectors, returned: DataType):
    rules = _rules(selectors)

    @F.arrow_udf(returned)
    def read_pages(pages: pa.Array) -> pa.Array:
        scanner = _Scanner(rules)
        return collect([None if page is None else read(page, scanner) for page in pages.to_pylist()])

    return read_pages


def detail_page(html: Column, selectors: DetailSelectors = DEFAULT_DETAIL) -> Column:
    """Struct with the first text of every field selector (NULL when blank or missing), the employer without accents, and
    `blocks`, the texts of all job-code blocks; without any block, the text of the whole body is the one block.

    Use it inside a generator, `inline(array(detail_page(html)))`: filters on other columns then go below it, to the scan, and
    filters on its fields do not make Spark read the page again."""
    return _page_udf(_read_detail, _detail_array, selectors, _DETAIL_TYPE)(html)


def list_items(html: Column, selectors: ListSelectors = DEFAULT_LIST) -> Column:
    """Array of (href, published_at, updated_at, id_candidates), one per item with a link; the item itself may carry
    the id attributes."""
    return _page_udf(_read_items, _items_array, selectors, _ITEMS_TYPE)(html)


_ITEM_TYPE = _ITEMS_TYPE.elementType


class _PageItems:
    """`page_items(TABLE(pages), item, link, published_at, updated_at, id_candidates)`: see `register_page_items`."""

    def __init__(self):
        self._scanner = None

    @staticmethod
    def analyze(pages, item, link, published_at=None, updated_at=None, id_candidates=None) -> AnalyzeResult:
        if not pages.isTable or "html" not in pages.dataType.names:
            raise ValueError("page_items takes a table with a column html")
        others = [f for f in pages.dataType if f.name != "html"]
        return AnalyzeResult(StructType([*others, StructField("item_no", IntegerType()), *_ITEM_TYPE]))

    def eval(self, row, item, link, published_at=None, updated_at=None, id_candidates=None):
        if self._scanner is None:  # the selectors are constants of the query
            self._scanner = _Scanner(_rules(ListSelectors(item=item, link=link, published_at=published_at, updated_at=updated_at,
                                                          id_candidates=id_candidates)))
        given = row.asDict()
        page = given.pop("html")
        for n, found in enumerate(_read_items(page, self._scanner) if page else ()):
            yield (*given.values(), n, *[found[name] for name in _ITEM_TYPE.names])


def register_page_items(spark: SparkSession, name: str = "page_items") -> None:
    """Make list items a table function of SQL: `SELECT ... FROM page_items(TABLE(pages), item => 'li', link => 'a')`.

    The result has the columns of the given table but for `html`, then `item_no, href, published_at, updated_at,
    id_candidates`; its schema follows from the arguments. Pages without html have no items. Rows stay where they are, and
    filters and columns of the given table reach its scan.
    """
    spark.udtf.register(name, F.udtf(_PageItems))
