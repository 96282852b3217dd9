"""Main text of HTML pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tokens: runs of words, tags, and whole elements of
boilerplate. Each word scores a positive weight by the place it stands in
(paragraph, heading, list, link, ...), each tag a negative one by its kind, a
boilerplate element one negative weight for all of it. A linear scan finds the
contiguous region with the largest sum; its words, block by block, are the text.

Boilerplate are elements named for it (nav, footer, aside, form, ...) or with a
class, id or role that says so (HINTS), unless such an element, told by class
alone, holds most of the page's words. Inside the region they are left out too.
On a page that marks its content (one article, or else one main element), words
outside of it are boilerplate.

The weights are learned from labelled pages: those that mark their content, the
region from its first to its last token being the label. An averaged perceptron
corrects the weights by the difference between the labelled and the best region;
signs are kept. Each page is learned from three times: as it is, without its
content mark, and without any names of boilerplate, so that the weights also
hold for pages that have neither. The sample has at most about `n_pages` pages
of at most `max_chars` characters, chosen by a hash of the id. `weights=` takes
weights from elsewhere; without labelled pages PRIOR holds.

Pages are worked on in tasks, without a shuffle; nothing is dropped or cut.

Defined cases: null html counts as empty; a page without words has the empty
text; null and repeated ids are rows as any other; markup that never ends (a
comment, script or tag at the end) is no text; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import arrow_map, staged, table
from rawgate.llm.registry import query

# Kinds of elements.
INLINE = "b i em strong span u s small sub sup font abbr code cite q mark tt kbd samp var time del ins big label wbr"
HEADINGS = "h1 h2 h3 h4 h5 h6"
LISTS = "ul ol li dl dt dd"
TABLES = "table thead tbody tfoot tr td th caption"
SECTIONS = "html body div section article main header footer nav aside form fieldset center figure figcaption details summary address menu dialog hr"
VOID = "area base br col embed hr img input link meta param source track wbr"
RAW = "script style textarea title iframe xmp noembed noframes"
BOILERPLATE = "nav header footer aside form noscript template svg select button dialog menu head fieldset object canvas video audio label datalist"
HINTS = (
    "ad ads adbox adslot adsense adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner "
    "cookie cookies consent gdpr notice alert popup modal overlay lightbox sidebar sidenav rail menu nav navbar navigation breadcrumb "
    "breadcrumbs toolbar masthead header footer share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search pagination pager widget skip copyright legal disclaimer outbrain taboola"
)
COMMENT_HINTS = "comment comments commentlist disqus respond reply replies discussion"
ROLES = "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar"
#: words of a class that make it say the opposite, and words that name content
TURNED, CONTENT = "no without with has hide", "article post entry content story main"

WORD_KINDS = ("paragraph", "heading", "list", "table", "quote", "link", "bare")
TAG_KINDS = ("p", "br", "inline", "a", "headings", "lists", "tables", "sections", "quotes", "other", "boilerplate", "outside")
KINDS = WORD_KINDS + TAG_KINDS
NUMBER = {k: i for i, k in enumerate(KINDS)}
IS_WORD = np.array([k in WORD_KINDS for k in KINDS])
#: the least a word scores and a tag costs
LEAST = 0.01
#: weights before anything is learned
PRIOR = np.array([1.0, 0.8, 0.8, 0.5, 1.0, 0.1, 0.3, -0.1, -0.05, -0.05, -0.5, -0.1, -0.15, -0.15, -0.5, -0.1, -0.2, -0.5, -1.0])

#: share of the page's words from which an element that only its class calls boilerplate is none
MOST = 0.6

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|$))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW.split()}

_TAG_KIND: dict[str, int] = {"p": NUMBER["p"], "br": NUMBER["br"], "a": NUMBER["a"], "blockquote": NUMBER["quotes"], "pre": NUMBER["quotes"]}
for _names, _kind in ((INLINE, "inline"), (HEADINGS, "headings"), (LISTS, "lists"), (TABLES, "tables"), (SECTIONS, "sections")):
    _TAG_KIND |= dict.fromkeys(_names.split(), NUMBER[_kind])
_OTHER, _BR = NUMBER["other"], NUMBER["br"]
_BLOCKS = frozenset(f"p blockquote pre {HEADINGS} {LISTS} {TABLES} {SECTIONS}".split())
_VOID, _BOILERPLATE = frozenset(VOID.split()), frozenset(BOILERPLATE.split())
_HINTS, _COMMENTS, _ROLES = frozenset(HINTS.split()), frozenset(COMMENT_HINTS.split()), frozenset(ROLES.split())
_TURNED, _CONTENT = frozenset(TURNED.split()), frozenset(CONTENT.split())
#: opening one of these ends an open paragraph, or an open element of the same sort
_ENDS_P = _BLOCKS - {"html", "body"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_PLACE = {"p": "paragraph", "blockquote": "quote", "pre": "quote", "li": "list", "dt": "list", "dd": "list", "td": "table", "th": "table", "caption": "table"}
_PLACE |= dict.fromkeys(HEADINGS.split(), "heading")

NOT, BY_NAME, BY_CLASS, AS_COMMENT = 0, 1, 2, 3


def boilerplate_sort(name: str, attrs: str, in_content: bool) -> int:
    """Whether an element is boilerplate: by its name or role, by its class or id, or as readers' comments."""
    sort = BY_NAME if name in _BOILERPLATE and not (name == "header" and in_content) else NOT
    if not attrs or name in ("html", "body"):
        return sort
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role":
            sort = sort or (BY_NAME if value.strip().lower() in _ROLES else NOT)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            sort = sort or BY_NAME
        elif key in ("class", "id"):
            for one in value.split():
                parts = [x.lower() for x in _PART.findall(one)]
                if not _TURNED.isdisjoint(parts):
                    continue
                if not _COMMENTS.isdisjoint(parts):
                    return AS_COMMENT
                met = _HINTS.intersection(parts)
                if met and name not in ("article", "main") and not (met == {"header"} and (in_content or not _CONTENT.isdisjoint(parts))):
                    sort = sort or BY_CLASS
    return sort


def _is_content(name: str, attrs: str) -> bool:
    if name in ("article", "main"):
        return True
    return any((m[1].lower() in ("class", "id", "role")) and not _CONTENT.isdisjoint(x.lower() for x in _PART.findall(m[2] or m[3] or m[4] or "")) for m in _ATTR.finditer(attrs))


class Tokens:
    """Tokens of a page: kinds and counts; text of runs; ids of the boilerplate and of the marked element around each."""

    def __init__(self, page: str) -> None:
        self.kinds: list[int] = []
        self.counts: list[int] = []
        self.texts: list[str | None] = []  # text of a run; "" for a block's edge; None for other tags
        self.boiler: list[int] = []
        self.marked: list[int] = []
        self.sorts: list[int] = [NOT]  # by boilerplate id
        self.marks: list[str] = [""]  # by id of article or main
        self._read(page)

    def _add(self, kind: int, count: int, text: str | None, boiler: int, marked: int) -> None:
        self.kinds.append(kind)
        self.counts.append(count)
        self.texts.append(text)
        self.boiler.append(boiler)
        self.marked.append(marked)

    def _read(self, page: str) -> None:
        # open elements: name, boilerplate id, marked id, place of words, in a link, in content
        stack: list[tuple[str, int, int, int, bool, bool]] = [("", 0, 0, NUMBER["bare"], False, False)]
        at, link = 0, NUMBER["link"]
        paragraph = NUMBER["paragraph"]
        while True:
            m = _TAG.search(page, at)
            text = page[at : m.start()] if m else page[at:]
            if text:
                _, boiler, marked, place, linked, _ = stack[-1]
                if "&" in text:
                    text = entities.unescape(text)
                n = len(text.split())
                n = max(n, len(text) // 12) if n else 0  # scripts that write without spaces
                self._add(link if linked and place != paragraph else place, n, text, boiler, marked)
            if m is None:
                return
            at = m.end()
            if m["name"] is None:
                continue
            name, attrs = m["name"].lower(), m["attrs"]
            kind, edge = _TAG_KIND.get(name, _OTHER), "" if name in _BLOCKS else None
            if m["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        self._add(kind, 1, edge, stack[i][1], stack[i][2])
                        del stack[i:]
                        break
                else:
                    self._add(kind, 1, edge, stack[-1][1], stack[-1][2])
                continue
            if name in _RAW_END:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
                closing = _TAG.match(page, at) if end else None
                at = closing.end() if closing else at
                continue
            if name in _ENDS_P or name in _SIBLINGS:
                self._close(stack, name)
            _, boiler, marked, place, linked, content = stack[-1]
            if not boiler and (sort := boilerplate_sort(name, attrs, content)):
                boiler = len(self.sorts)
                self.sorts.append(sort)
            if not marked and not boiler and (name in ("article", "main") or "main" in attrs and re.search(r"role\s*=\s*[\"']?main\b", attrs)):
                marked = len(self.marks)
                self.marks.append("article" if name == "article" else "main")
            elif marked and self.marks[marked] == "main" and name == "article" and not boiler:
                self.marks.append("article")  # the article inside of main is the narrower mark
                marked = len(self.marks) - 1
            self._add(kind, 1, edge, boiler, marked)
            if name in _VOID or attrs.endswith("/") and name in ("svg", "path", "iframe"):
                continue
            content = content or _is_content(name, attrs)
            place = NUMBER[_PLACE[name]] if name in _PLACE else NUMBER["bare"] if kind == NUMBER["sections"] else place
            stack.append((name, boiler, marked, place, linked or name == "a", content))

    @staticmethod
    def _close(stack: list, name: str) -> None:
        """What an opening tag ends by itself: an open paragraph, or the sibling before."""
        siblings = _SIBLINGS.get(name, ())
        for i in range(len(stack) - 1, 0, -1):
            open_ = stack[i][0]
            if open_ == "p" or open_ in siblings:
                del stack[i:]
                if not siblings or open_ in siblings:
                    return
            elif open_ in _BLOCKS and not (siblings and open_ in ("p",)):
                return

    def content_mark(self) -> int:
        """Id of the element that the page marks as its content, 0 if there is none: its one article, or its one main."""
        words: dict[int, int] = {}
        for kind, n, b, a in zip(self.kinds, self.counts, self.boiler, self.marked, strict=True):
            if a and IS_WORD[kind] and self.sorts[b] == NOT:
                words[a] = words.get(a, 0) + n
        for sort in ("article", "main"):
            met = [(n, i) for i, n in words.items() if n and self.marks[i] == sort]
            if met:
                best, i = max(met)
                if 3 * best >= 2 * sum(n for n, _ in met):
                    return i
                if sort == "article":
                    return 0
        return 0

    def unhinted(self) -> set[int]:
        """Boilerplate, told by its class alone, that holds most of the page's words."""
        words: dict[int, int] = {}
        for kind, n, b in zip(self.kinds, self.counts, self.boiler, strict=True):
            if IS_WORD[kind] and self.sorts[b] != BY_NAME:
                words[b] = words.get(b, 0) + n
        total = sum(words.values())
        return {b for b, n in words.items() if self.sorts[b] == BY_CLASS and n > MOST * total}

    def scored(self, marks: bool = True, hints: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(kinds, counts) as the scan sees them; boilerplate counts once, what is skipped counts 0."""
        kinds, counts = np.array(self.kinds, dtype=np.int64), np.array(self.counts, dtype=np.float64)
        boiler = np.array(self.boiler, dtype=np.int64)
        if hints and boiler.any():
            keep = self.unhinted()
            inside = (boiler > 0) & ~np.isin(boiler, list(keep))
            first = np.zeros(len(kinds), dtype=bool)
            first[np.unique(boiler, return_index=True)[1]] = True
            kinds[inside], counts[inside] = NUMBER["boilerplate"], 0.0
            counts[inside & first] = 1.0
        if marks and (mark := self.content_mark()):
            outside = (np.array(self.marked) != mark) & IS_WORD[kinds]
            kinds[outside] = NUMBER["outside"]
        return kinds, counts

    def text(self, kinds: np.ndarray, first: int, stop: int) -> str:
        """The words of a region, block by block."""
        blocks: list[str] = []
        parts: list[str] = []
        for i in range(first, stop):
            text = self.texts[i]
            if text == "" and parts:
                blocks.append("".join(parts))
                parts = []
            elif IS_WORD[kinds[i]] and text:
                parts.append(text)
            elif kinds[i] == _BR:
                parts.append("\n")
        blocks.append("".join(parts))
        return "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """first and stop of the contiguous run with the largest sum, in one pass; (0, 0) if nothing is positive."""
    best = total = 0.0
    first, found = 0, (0, 0)
    for i, score in enumerate(scores.tolist()):
        if total <= 0.0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, found = total, (first, i + 1)
    return found


def extract(page: str, weights: np.ndarray = PRIOR) -> str:
    """The main text of one page."""
    tokens = Tokens(page)
    kinds, counts = tokens.scored()
    return tokens.text(kinds, *best_region(weights[kinds] * counts))


# --- learning ---------------------------------------------------------------------------

Example = tuple[np.ndarray, np.ndarray, int, int]


def examples_of(page: str) -> list[Example]:
    """(kinds, counts, first, stop) of a page that marks its content: as it is, without the mark, without names of boilerplate."""
    tokens = Tokens(page)
    mark = tokens.content_mark()
    if not mark:
        return []
    at = [i for i, (a, k, n) in enumerate(zip(tokens.marked, tokens.kinds, tokens.counts, strict=True)) if a == mark and IS_WORD[k] and n]
    return [(*tokens.scored(marks, hints), at[0], at[-1] + 1) for marks, hints in ((True, True), (False, True), (False, False))]


def _signed(weights: np.ndarray) -> np.ndarray:
    return np.where(IS_WORD, np.maximum(weights, LEAST), np.minimum(weights, -LEAST))


def learn(examples: list[Example], epochs: int = 8, rate: float = 0.5) -> np.ndarray:
    """Averaged perceptron over regions, from PRIOR; words keep scoring above 0 and tags below."""
    weights, total, steps = PRIOR.copy(), np.zeros(len(KINDS)), 0
    order = np.random.default_rng(3)

    def measured(kinds: np.ndarray, counts: np.ndarray, first: int, stop: int) -> np.ndarray:
        return np.bincount(kinds[first:stop], weights=counts[first:stop], minlength=len(KINDS))

    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            kinds, counts, first, stop = examples[i]
            found = best_region(weights[kinds] * counts)
            if found != (first, stop):
                wrong = measured(kinds, counts, first, stop) - measured(kinds, counts, *found)
                weights = _signed(weights + rate * wrong / max(np.abs(wrong).sum(), 1.0))
            total, steps = total + weights, steps + 1
    return _signed(total / steps) if steps else PRIOR


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", n_pages: int = 300, max_chars: int = 50_000) -> np.ndarray:
    """Weights from a bounded sample of pages that mark their content."""
    labelled = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).filter(
        (F.length("html") <= max_chars) & F.col("html").rlike(r"(?i)<(article|main)[\s>]")
    )
    n, steps = labelled.count(), 1 << 30
    sample = labelled if n <= n_pages else labelled.filter(F.pmod(F.xxhash64("id"), F.lit(steps)) < steps * n_pages // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for page in batch.column(0).to_pylist() for x in examples_of(page)]
            columns = [pa.array([x[0].tolist() for x in found], pa.list_(pa.int64())), pa.array([x[1].tolist() for x in found], pa.list_(pa.float64()))]
            columns += [pa.array([x[i] for x in found], pa.int64()) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(columns, ["kinds", "counts", "first", "stop"])

    rows = staged(arrow_map(sample.select("html"), run, "kinds array<long>, counts array<double>, first long, stop long"), "html-labelled").collect()
    examples = [(np.array(r["kinds"], np.int64), np.array(r["counts"]), r["first"], r["stop"]) for r in rows]
    examples.sort(key=lambda x: (len(x[0]), x[0].tobytes(), x[1].tobytes()))  # whatever order tasks gave them in
    return learn(examples)


def extracted(pages: DataFrame, weights: np.ndarray | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: a row per page."""
    learned = train(pages, id_col, html_col) if weights is None else weights
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py() or "", learned) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return arrow_map(rows, run, f"{kinds[0]}, {kinds[1]}, text string")


@query("op13_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extracted(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))
