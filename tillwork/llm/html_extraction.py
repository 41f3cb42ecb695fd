"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements with the text blocks as leaves. Every node has a hidden label, content or
not. A node's evidence (its tag, what its class and id names say, and for text blocks length, link share and
punctuation) and its parent's label are tied to the label by potentials; sum-product messages go up the tree and down
again, and a text block is kept where its content marginal is one half or more. Scripts, styles, forms, drawings, frames and
page heads are no text at all; formulas and what stands inside objects, maps and players are.

Potentials are counted on labelled pages: those with an ``article`` or ``main`` element label themselves, with
navigation, asides, footers, forms, adverts and comments inside it labelled as not content. Each such page is counted twice,
the second time with these two tags read as plain divisions, so that pages without them are judged by the other
evidence. Training reads at most ``PAGES`` pages, the first in order of a hash of the id; counts are added by Spark.

Defined results: null and empty pages and pages without content give an empty text; unclosed, stray and truncated tags
end where a browser would end them or at the page's end, a head at the first tag or text that cannot stand in it; pages of any length are read whole; a block whose two labels are equally likely is kept; repeated rows are extracted one by one; an empty table gives no
rows; other columns are carried.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables

PAGES = 2_000
_PRIOR = 50
_SMOOTHING = 0.5
_RARE = 0.01  # the same for tags and names, most of which stand under one label only
_TEXT_WEIGHT = 0.5  # the features of a text block say much the same
#: Before any count, a child has its parent's label with this probability, as if seen _STRENGTH times.
_INHERITED = 0.995
_STRENGTH = 20
#: Log-odds of tags that do not tell their purpose, however one-sided the training pages are, stay within this.
_BOUND = 1.0

# Element names of HTML.
_DROPPED = frozenset(
    "script style noscript template head title form select option textarea button svg iframe datalist".split()
)
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())  # all else ends a head
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "html body article section main nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th"
    " blockquote pre figure figcaption address details summary fieldset center hgroup search dialog menu".split()
) | _DROPPED
_CLOSED_BY_BLOCK = frozenset(["p"])
_SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table body html article section div nav aside header footer main".split())

# Words in class and id names, by what they say.
_NAMED = {
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner",
    "comment": "comment comments disqus replies reply respond discussion",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe subscription paywall",
    "furniture": "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar pagination pager widget",
    "social": "share sharing social related recommended recommendations trending tags meta byline login signup search",
    "content": "article content entry post story main body text articlebody maincontent",
}
_WORDS = {word: kind for kind, words in _NAMED.items() for word in words.split()}
_NOT_CONTENT_NAMES = ("advert", "comment", "notice", "furniture", "social")
_NOT_CONTENT_TAGS = frozenset("nav aside footer form dialog menu search".split())
_CONTENT_TAGS = frozenset(("article", "main"))
#: The frame of a page may be content where a page has no article element; training pages cannot show that.
_FRAME = frozenset(("html", "body"))
_TELLING = _NOT_CONTENT_TAGS | _CONTENT_TAGS | _DROPPED | {"header"}

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ENDS = re.compile(r"[>\"']")
_NAMES = re.compile(r"(?i)(?:^|[\s\"'])(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")



class TagEnds:
    """Where tags end: at the first ``>`` outside of quotes, or, where a quote is never closed, at the first one at all.

    One pass from the end settles this for every place, so no text is looked at again for each tag that begins in it.
    """

    def __init__(self, source: str):
        self.source = source
        self.places = [match.start() for match in _ENDS.finditer(source)]
        self.ends = [-1] * (len(self.places) + 1)
        closing: dict[str, int] = {}
        for k in range(len(self.places) - 1, -1, -1):
            one = source[self.places[k]]
            if one == ">":
                self.ends[k] = self.places[k]
            else:
                self.ends[k] = self.ends[closing[one] + 1] if one in closing else -1
                closing[one] = k

    def after(self, place: int) -> int:
        """The ``>`` of the tag whose name ends at ``place``; -1 if the page ends before."""
        found = self.ends[bisect_left(self.places, place)]
        return found if found >= 0 else self.source.find(">", place)


class Page:
    """The block tree of one page: parallel lists over its nodes, parents before children. Reading takes time in proportion to the page."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.named: list[str] = [""]
        self.text: list[str] = [""]
        self.link_share: list[float] = [0.0]
        self._stack = [0]
        self._open_at: dict[str, list[int]] = {}
        self._buffer: list[str] = []
        self._linked = self._length = 0
        self._links = 0
        self._skipping = 0
        self._read(source)

    def _read(self, source: str) -> None:
        ends, done, size, at = TagEnds(source), 0, len(source), source.find("<")
        while at >= 0:
            closes = source.startswith("/", at + 1)
            name = _NAME.match(source, at + 1 + closes)
            if name is None and not source.startswith(("!", "?"), at + 1):
                at = source.find("<", at + 1)
                continue
            self._words(source[done:at])
            if name is None:
                done = self._markup(source, at)
            else:
                end = ends.after(name.end())
                done = end + 1 if end >= 0 else size
                if end >= 0:
                    done = self._tag(source, name.group().lower(), closes, source[name.end() : end], done)
            at = source.find("<", done)
        self._words(source[done:])
        self._flush()

    def _markup(self, source: str, at: int) -> int:
        """Pass a comment, a declaration or CDATA, whose text is text; returns where it ends."""
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            return end + 3 if end >= 0 else len(source)
        if source.startswith("<![CDATA[", at):
            end = source.find("]]>", at + 9)
            self._words(source[at + 9 : end if end >= 0 else len(source)], False)
            return end + 3 if end >= 0 else len(source)
        end = source.find(">", at)
        return end + 1 if end >= 0 else len(source)

    def _tag(self, source: str, name: str, closes: bool, attributes: str, done: int) -> int:
        """Read a tag that ends at ``done``; returns where to go on."""
        if closes:
            self._close(name)
            return done
        self._open(name, attributes)
        if name in _RAW or name == "noframes" and self._in_head():
            end = re.compile(rf"</{name}\b", re.I).search(source, done)
            done = source.find(">", end.end()) + 1 if end else 0
            self._close(name)
        return done or len(source)

    def _in_head(self) -> bool:
        return self.tag[self._stack[-1]] == "head"

    def _words(self, raw: str, escaped: bool = True) -> None:
        if escaped and self._in_head() and raw.strip(" \t\n\f\r"):
            self._close("head")
        if self._skipping or not raw:
            return
        text = html.unescape(raw) if escaped and "&" in raw else raw
        self._buffer.append(text)
        size = len(text.strip())
        self._length += size
        self._linked += size if self._links else 0

    def _flush(self) -> None:
        text = " ".join("".join(self._buffer).split())
        if text:
            self._add("#text", "")
            self.text[-1] = text
            self.link_share[-1] = self._linked / max(self._length, 1)
        self._buffer, self._linked, self._length = [], 0, 0

    def _add(self, tag: str, named: str) -> None:
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.named.append(named)
        self.text.append("")
        self.link_share.append(0.0)

    def _open(self, name: str, attributes: str) -> None:
        if self._in_head() and name not in _IN_HEAD:
            if name == "head":
                return
            self._close("head")
        if name == "a":
            self._links = 1
        if name in ("br", "hr"):
            self._buffer.append(" ")
        if name not in _BLOCKS or name in _VOID:
            return
        self._flush()
        if self.tag[self._stack[-1]] in _CLOSED_BY_BLOCK and not self._skipping:
            self._pop_to(len(self._stack) - 1)
        if name in _SAME_LEVEL:
            self._close_within(_SAME_LEVEL[name])
        self._add(name, _evidence(attributes))
        self._open_at.setdefault(name, []).append(len(self._stack))
        self._stack.append(len(self.tag) - 1)
        if name in _DROPPED:
            self._skipping += 1

    def _close(self, name: str) -> None:
        if name == "a":
            self._links = 0
        if name not in _BLOCKS:
            return
        self._flush()
        if self._open_at.get(name):
            self._pop_to(self._open_at[name][-1])

    def _innermost(self, names: Iterable[str]) -> int:
        return max((self._open_at[name][-1] for name in names if self._open_at.get(name)), default=0)

    def _close_within(self, names: tuple[str, ...]) -> None:
        depth = self._innermost(names)
        if depth > self._innermost(_SCOPES.difference(names)):
            self._pop_to(depth)

    def _pop_to(self, depth: int) -> None:
        for number in reversed(self._stack[depth:]):
            self._open_at[self.tag[number]].pop()
            if self.tag[number] in _DROPPED:
                self._skipping -= 1
        del self._stack[depth:]

    # Labels and evidence.

    def own_labels(self) -> list[bool] | None:
        """Content or not per node, where the page says so itself."""
        if not _CONTENT_TAGS.intersection(self.tag):
            return None
        labels = [False]
        shut = [False]
        for number in range(1, len(self.tag)):
            above, tag, named = self.parent[number], self.tag[number], self.named[number].split()
            shut.append(shut[above] or tag in _NOT_CONTENT_TAGS or any(one in named for one in _NOT_CONTENT_NAMES))
            labels.append(not shut[number] and (labels[above] or tag in _CONTENT_TAGS))
        return labels

    def evidence(self, number: int, plain: bool) -> list[str]:
        """Names of the observed features of a node; ``plain`` reads article and main as divisions."""
        tag = self.tag[number]
        if tag != "#text":
            tag = "div" if plain and tag in _CONTENT_TAGS else tag
            return [f"tag={tag}", *(f"named={one}" for one in self.named[number].split() if not plain or one != "content")]
        text = self.text[number]
        size = min(int(math.log2(len(text) + 1)), 9)
        marks = min(sum(map(text.count, ".,;:!?")) * 20 // (len(text) + 19), 3)
        return [f"size={size}", f"links={min(int(4 * self.link_share[number]), 3)}", f"marks={marks}", f"copyright={'©' in text}"]

    def kind(self, number: int, plain: bool) -> str:
        tag = self.tag[number]
        return "div" if plain and tag in _CONTENT_TAGS else tag


def _evidence(attributes: str) -> str:
    found = {}
    for match in _NAMES.finditer(attributes):
        for part in _PARTS.findall(match.group(1) or match.group(2) or match.group(3) or ""):
            kind = _WORDS.get(part.lower())
            if kind:
                found[kind] = None
    return " ".join(found)


class Potentials:
    """Log potentials from counts of (kind of factor, name, label, parent's label)."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        counts = Counter(counts)
        # What the names themselves say counts as _PRIOR observations, for kinds that no page has shown.
        for kind in _NOT_CONTENT_NAMES:
            counts["f:named=" + kind, 0, -1] += _PRIOR
        counts["f:named=content", 1, -1] += _PRIOR
        for tag in (*_NOT_CONTENT_TAGS, "header"):
            counts["f:tag=" + tag, 0, -1] += _PRIOR
        for tag in _CONTENT_TAGS:
            counts["f:tag=" + tag, 1, -1] += _PRIOR
        total = Counter()
        for (name, label, _), count in counts.items():
            if name.startswith("f:"):
                total[name.partition("=")[0], label] += count
        for label in (0, 1):  # any element may bear a name
            total["f:named", label] = total["f:tag", label]
        names = {name for name, *_ in counts if name.startswith("f:")}
        self._unary = {}
        for name in names:
            group = name.partition("=")[0]
            least, weight = (_RARE, 1.0) if group in ("f:tag", "f:named") else (_SMOOTHING, _TEXT_WEIGHT)
            odds = [math.log((counts[name, label, -1] + least) / (total[group, label] + least * 20)) for label in (0, 1)]
            value = weight * (odds[1] - odds[0])
            if group == "f:tag" and name.partition("=")[2] in _FRAME:
                value = 0.0
            elif group == "f:tag" and name.partition("=")[2] not in _TELLING:
                value = max(-_BOUND, min(_BOUND, value))
            self._unary[name[2:]] = value
        self._pair = {}
        for kind in {name for name, *_ in counts if name.startswith("p:")} | {"p:"}:
            rows = []
            if kind[2:] in _FRAME:
                self._pair[kind[2:]] = ((math.log(0.5), math.log(0.5)),) * 2
                continue
            for above in (0, 1):
                inherited = [1 - _INHERITED, _INHERITED] if above else [_INHERITED, 1 - _INHERITED]
                seen = [counts[kind, label, above] + _STRENGTH * inherited[label] for label in (0, 1)]
                rows.append(tuple(math.log(one / sum(seen)) for one in seen))
            self._pair[kind[2:]] = tuple(rows)

    def unary(self, names: list[str]) -> float:
        return sum(self._unary.get(name, 0.0) for name in names)

    def pair(self, kind: str) -> tuple[tuple[float, float], tuple[float, float]]:
        """Rows by the parent's label, columns by the node's."""
        return self._pair.get(kind) or self._pair[""]


def _add(x: float, y: float) -> float:
    high = max(x, y)
    return high + math.log1p(math.exp(min(x, y) - high))


def marginals(page: Page, model: Potentials) -> list[float]:
    """Each node's probability of being content, by messages up to the root and down again."""
    count = len(page.tag)
    plain = False
    own = [(0.0, model.unary(page.evidence(k, plain)) if k else 0.0) for k in range(count)]
    pairs = [model.pair(page.kind(k, plain)) for k in range(count)]
    for k in range(1, count):  # a frame that is content may hold anything
        if page.tag[page.parent[k]] in _FRAME:
            pairs[k] = pairs[k][0], (math.log(0.5), math.log(0.5))
    below = [list(one) for one in own]  # own evidence and the messages of the children
    up = [(0.0, 0.0)] * count
    for k in range(count - 1, 0, -1):
        (p00, p01), (p10, p11) = pairs[k]
        b0, b1 = below[k]
        message = (_add(p00 + b0, p01 + b1), _add(p10 + b0, p11 + b1))
        up[k] = message
        parent = below[page.parent[k]]
        parent[0] += message[0]
        parent[1] += message[1]
    belief = [tuple(below[0])] * count
    for k in range(1, count):
        above = belief[page.parent[k]]
        rest = (above[0] - up[k][0], above[1] - up[k][1])
        (p00, p01), (p10, p11) = pairs[k]
        belief[k] = (below[k][0] + _add(rest[0] + p00, rest[1] + p10), below[k][1] + _add(rest[0] + p01, rest[1] + p11))
    return [1 / (1 + math.exp(max(-700.0, min(700.0, b0 - b1)))) for b0, b1 in belief]


def main_text(source: str | None, model: Potentials) -> str:
    if not source:
        return ""
    page = Page(source)
    found = marginals(page, model)
    return " ".join(page.text[k] for k in range(len(page.tag)) if page.text[k] and found[k] >= 0.5)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features and of parent-child labels on pages that label themselves."""
    counts: Counter = Counter()
    for batch in batches:
        for source in batch.column(0).to_pylist():
            page = Page(source or "")
            labels = page.own_labels()
            if labels is None:
                continue
            for plain in (False, True):
                for k in range(1, len(page.tag)):
                    counts["p:" + page.kind(k, plain), int(labels[k]), int(labels[page.parent[k]])] += 1
                    for name in page.evidence(k, plain):
                        counts["f:" + name, int(labels[k]), -1] += 1
    names, own, above = zip(*counts) if counts else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(own, pa.int32()), pa.array(above, pa.int32()), pa.array(list(counts.values()), pa.int64())],
        ["name", "label", "above", "count"],
    )


def train(pages: DataFrame, limit: int = PAGES) -> Potentials:
    """Potentials from at most ``limit`` pages; the number of different counts depends on the element names only."""
    chosen = pages.where("html is not null and page_id is not null").select("page_id")
    chosen = chosen.orderBy(F.xxhash64("page_id"), "page_id").limit(limit).distinct()
    counts = (
        pages.join(F.broadcast(chosen), "page_id", "left_semi")
        .select("html")
        .mapInArrow(_counted, "name string, label int, above int, count bigint")
        .groupBy("name", "label", "above")
        .agg(F.sum("count").alias("count"))
        .collect()
    )
    return Potentials({(row["name"], row["label"], row["above"]): row["count"] for row in counts})


def extract(pages: DataFrame, model: Potentials) -> DataFrame:
    """``pages`` with ``text`` in place of ``html``, and ``n_chars``; one pass, no shuffle."""
    names = [name for name in pages.columns if name.lower() not in ("html", "text", "n_chars")]
    schema = pages.select(*names, F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(batch.schema.get_field_index("html")).to_pylist()
            texts = [main_text(source, model) for source in sources]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(name)) for name in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*names, "text", "n_chars"],
            )

    return pages.mapInArrow(run, schema)


def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = tables.read(spark, folder, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages))
