"""Main text of web pages by a site style tree.

The element trees of a host's pages are merged by style: elements of the same tag, class and id
below the same styles are one node. Over the pages of the host a node has an entropy of the
sequences of its children (presentation) and, for each pair of neighbouring words in its text, one of
the pages that hold it (content): pairs that stand on page after page say little. A branch's
importance is that of its presentation and, as far as this is always the same, of the branches and
text that it holds. Each page is walked from its root: of the branches of an element those go that
are less important than the greatest of them, together with those that HTML itself names as no part
of an article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.llm.common import Batches, map_batches, row_groups, stored, without

# The importance that a branch must have as a share of the greatest beside it: where pages are laid
# out alike, and in an article, in a branch that differs from page to page, and for a heading.
LEAST_SHARE, LEAST_WITHIN = 0.95, 0.2
# What of a presentation's weight each further style of it leaves to the content.
LEFT_BY_STYLE = 0.9
# Pairs of words that a task hands to Spark at once, or those of one page.
FEATURES_AT_ONCE = 1 << 16
# A branch with more than this share of a page's text (numerator, denominator) keeps what its name
# would remove.
MOST = 2, 3

# Names of HTML elements by their role.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
REMOVED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head header iframe input math menu "
    "nav noembed noframes noscript object script search select style svg template textarea title "
    "video xmp".split()
)
MAIN = frozenset(["article", "main"])
# What holds a page or its article as such; whatever its style, it is no branch to remove.
WHOLE = MAIN | {"html", "body"}
# Words that name what is no part of an article, as the last of a class, id or role.
REMOVED_WORDS = frozenset(
    "ad ads adv advert advertisement advertising advertorial banner breadcrumb breadcrumbs byline "
    "comment comments commentlist consent contentinfo cookie cookies disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
    "popup promo promotion related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toc toolbar widget widgets complementary alert disclaimer "
    "skyscraper topbar usermenu adsbygoogle adbox adslot".split()
)
# Words after which the one before names the element, words that also do so if all
# before them are such names, words for comments, words that say a page has or lacks something
# elsewhere, and words that on a heading mean the heading itself.
PARTS = frozenset(
    "area articles bar block bottom box button buttons form icons inner item items left link links "
    "list message posts right stories top".split()
)
AROUND = frozenset("container media section wrapper".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
ELSEWHERE = frozenset("has no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADERS = frozenset("banner header masthead".split())
# The attributes that matter here.
READ = ("class", "id", "role", "hidden", "aria-hidden")
# Elements that end an open one of the first kind up to the nearest of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# What the text is cut by: a comment, a declaration, or the name of a tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)",
    re.S,
)
# Parts of a tag after its name: up to a value or the end, white space, a value without quotes.
NAMES, SPACE, BARE = re.compile(r"[^>=]*+"), re.compile(r"\s*+"), re.compile(r"[^\s>]*+")
CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
WORDS, CAPITAL = re.compile(r"[a-z]{2,}"), re.compile(r"(?<=[a-z])(?=[A-Z])")
# Numbers in names that count things; a single digit tells styles apart.
COUNTED = re.compile(r"[0-9]{2,}")


@dataclass
class Element:
    tag: str
    path: int
    hard: bool
    named: int
    removed: bool
    main: bool
    styled: bool
    above: Element | None
    children: list[str] = field(default_factory=list)
    chars: int = 0
    holds_main: bool = False


@dataclass
class Block:
    """Text of one block and the innermost element that holds it."""

    text: str
    element: Element


def signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def attributes_at(source: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int]:
    """The attributes of a tag whose name ends at `at`, by lower-case name, and where the tag ends.

    Quoted values may have any length and hold anything. `last` has the place of the last quote of
    each sort in the page: a value's quote that no other follows is no quote, and no search for one
    starts that finds nothing, so a page takes linear time.
    """
    found: dict[str, str] = {}
    while True:
        stop = NAMES.match(source, at).end()
        names = source[at:stop].replace("/", " ").lower().split()
        if source[stop : stop + 1] != "=":
            for name in names:
                found.setdefault(name, "")
            return found, min(stop + 1, len(source))
        valued = names.pop() if names else ""
        for name in names:
            found.setdefault(name, "")
        start = SPACE.match(source, stop + 1).end()
        quote = source[start : start + 1]
        if start < last.get(quote, -1):
            start += 1
            end = source.index(quote, start)
            at = end + 1
        else:
            at = end = BARE.match(source, start).end()
        if valued in READ:
            found.setdefault(valued, source[start:end])


def names_no_article(tag: str, names: str, in_main: bool) -> int:
    """Whether a class, id or role names what is no part of an article: 2 for comments, 0 if none.

    The last word of each counts, as "sidebar" of "left-sidebar", "sidebar-box" or
    "sidebar-wrapper", but not of "no-sidebar" or "content-sidebar-wrapper". A capital after a small
    letter starts a word. Of an article's own header every word but that counts.
    """
    for name in names.split():
        words = WORDS.findall(CAPITAL.sub(" ", name).lower())
        if len(words) > 1 and words[-1] in AROUND and REMOVED_WORDS.issuperset(words[:-1]):
            words.pop()
        if not words or not ELSEWHERE.isdisjoint(words[:-1]):
            continue
        if tag == "header" and in_main:
            named = REMOVED_WORDS.intersection(words) - {"header"}
        else:
            while len(words) > 1 and words[-1] in PARTS:
                words.pop()
            named = REMOVED_WORDS.intersection(words[-1:])
        if named - HEADERS if tag in HEADINGS else named:
            return 1 if COMMENTS.isdisjoint(named) else 2
    return 0


def style_of(
    tag: str, attributes: dict[str, str], in_main: bool
) -> tuple[str, bool, bool, int]:
    """Style of an element, whether it is more than its tag, and whether HTML or a name removes it."""
    # A header of the article itself holds its title.
    hard = tag in REMOVED and not (tag == "header" and in_main)
    found = {name: attributes[name].lower() for name in READ if name in attributes}
    if not found:
        return tag, False, hard, 0
    names = " ".join(attributes.get(name, "") for name in ("class", "id", "role"))
    hard = hard or "hidden" in found or found.get("aria-hidden") == "true"
    named = names_no_article(tag, names, in_main)
    look = COUNTED.sub("0", f"{found.get('class', '')}#{found.get('id', '')}")
    page = tag in ("html", "body")
    return f"{tag}.{look}", look != "#", hard and not page, 0 if page else named


class Page:
    """Blocks and merged style nodes of one page."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.elements: list[Element] = []
        self.root = Element("", 0, False, 0, False, False, False, None)
        self.opened: list[Element] = []
        self.stack = [self.root]
        # The depths at which elements of each tag, and blocks of any tag, are open.
        self.depths: dict[str, list[int]] = {}
        self.block_depths: list[int] = []
        self.pieces: list[str] = []
        self._read(source)
        self._end_block()
        if any(element.named for element in self.opened):
            self._settle_names()
        self.has_main = any(e.main and not e.removed for e in self.elements)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        last = {quote: source.rfind(quote) for quote in "\"'"}
        while at < size:
            token = TOKEN.search(source, at)
            if token is None:
                self._text(source[at:])
                return
            self._text(source[at : token.start()])
            at = token.end()
            closing, tag = token.groups()
            if tag is None:
                continue
            tag = tag.lower()
            attributes, at = attributes_at(source, at, last)
            if closing:
                self._close(tag)
                continue
            self._open(tag, attributes)
            if tag in RAW:
                end = CLOSING[tag].search(source, at)
                at = end.start() if end else size

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append(text)

    def _end_block(self) -> None:
        if any(not piece.isspace() for piece in self.pieces):
            text = " ".join(html.unescape("".join(self.pieces)).split())
            self.blocks.append(Block(text, self.stack[-1]))
        self.pieces = []

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if tag in BLOCK:
            self._end_block()
            self._end_open(tag)
        above = self.stack[-1]
        style, styled, hard, named = style_of(tag, attributes, above.main)
        removed = hard or named > 0
        # Runs of inline elements do not start a style of their own.
        if tag not in BLOCK and not styled and not removed:
            if tag not in VOID:
                element = Element(
                    tag, above.path, False, 0, above.removed, above.main, False, above
                )
                self.opened.append(element)
                self._push(element)
            return
        if tag not in BLOCK and removed:
            self._end_block()
        path = signed(xxhash.xxh64_intdigest(f"{above.path} {style}"))
        main = above.main or tag in MAIN
        removed = above.removed or removed
        element = Element(tag, path, hard, named, removed, main, styled, above)
        self._styled_above(above).children.append(style)
        self.elements.append(element)
        self.opened.append(element)
        if tag not in VOID:
            self._push(element)

    def _push(self, element: Element) -> None:
        self.depths.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in BLOCK:
            self.block_depths.append(len(self.stack))
        self.stack.append(element)

    def _end_from(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            self.depths[tag].pop()
            if tag in BLOCK:
                self.block_depths.pop()

    def _deepest(self, tags: Iterable[str]) -> int:
        """The depth of the innermost open element of some tags, 0 if there is none."""
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=0)

    def _styled_above(self, element: Element) -> Element:
        while element.above is not None and element.above.path == element.path:
            element = element.above
        return element

    def _end_open(self, tag: str) -> None:
        if tag not in ENDS:
            if self.block_depths and self.stack[self.block_depths[-1]].tag == "p":
                self._end_from(self.block_depths[-1])
            return
        ended, until = ENDS[tag]
        depth = self._deepest(ended | {"p"})
        while depth > self._deepest(until):
            last = self.stack[depth].tag
            self._end_from(depth)
            if last != "p":
                return
            depth = self._deepest(ended | {"p"})

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
        depth = self._deepest([tag])
        # An inline element is not closed from inside a block that it holds.
        if not depth or (tag not in BLOCK and self.block_depths and self.block_depths[-1] > depth):
            return
        if tag not in BLOCK and self.stack[depth].removed:
            self._end_block()
        self._end_from(depth)

    def _settle_names(self) -> None:
        """Takes back removals by name that would take the page's article or most of its text.

        An element with <main> stays, and on a page without <main> or article one with most of the
        text, unless it is named comments. So does one with an article, if all articles would go: the
        only one of the page, or several with more text than what is left.
        """
        articles, inside = [], {id(self.root): (False, False)}
        for element in self.opened:
            hard, article = inside[id(element.above)]
            hard = hard or element.hard
            if element.tag == "article" and not hard and not article:
                articles.append(element)
            element.holds_main = element.tag == "main" and not hard
            inside[id(element)] = hard, article or element.tag == "article"
        for block in self.blocks:
            if not inside[id(block.element)][0]:
                block.element.chars += len(block.text)
        for element in reversed(self.opened):
            element.above.chars += element.chars
            element.above.holds_main |= element.holds_main
        most = self.root.chars * MOST[0]
        plain = not articles and not self.root.holds_main
        for element in self.opened:
            largest = plain and element.named == 1 and element.chars * MOST[1] > most
            if element.holds_main or largest:
                element.named = 0
        self._remove()
        if articles and all(article.removed for article in articles):
            has_main = any(e.main and not e.removed for e in self.elements)
            left = sum(
                len(block.text)
                for block in self.blocks
                if not block.element.removed and (block.element.main or not has_main)
            )
            if len(articles) == 1 or sum(article.chars for article in articles) > left:
                for element in articles:
                    while element is not None:
                        element.named = 0
                        element = element.above
                self._remove()

    def _remove(self) -> None:
        for element in self.opened:
            element.removed = element.above.removed or element.hard or element.named > 0

    def tree(self) -> Tree:
        """The blocks that HTML and names leave, and the merged styles that hold them.

        In a page with an article, what lies outside is no part of it. A branch can be removed
        unless it is the page or its article; in an article it must have a class or id of its own.
        """
        kept = [
            block
            for block in self.blocks
            if block.text and not block.element.removed and (block.element.main or not self.has_main)
        ]
        tree = Tree([block.text for block in kept], [], [], [], [], [])
        numbers: dict[int, int] = {0: -1}
        styles: dict[int, list[str]] = {}
        for element in self.elements:
            styles.setdefault(element.path, []).append(" ".join(element.children))
        for block in kept:
            chain, element = [], block.element
            while element.path not in numbers:
                element = self._styled_above(element)
                chain.append(element)
                element = element.above
            for element in reversed(chain):
                numbers[element.path] = len(tree.paths)
                tree.paths.append(element.path)
                tree.above.append(numbers[element.above.path])
                tree.kinds.append(self._kind(element))
                shown = "|".join(styles[element.path])
                tree.shown.append(signed(xxhash.xxh64_intdigest(shown)))
            tree.at.append(numbers[block.element.path])
        return tree

    @staticmethod
    def _kind(element: Element) -> int:
        if element.tag in WHOLE or (element.main and not element.styled):
            return STAYS
        return WITHIN if element.main or element.tag in HEADINGS else FREE


# Whether a branch can be removed by its importance, and by which share.
STAYS, WITHIN, FREE = range(3)


@dataclass
class Tree:
    """A page's texts in order, the style that holds each, and its styles from the root downwards.

    A style has its path, the number of the style above it (-1 for none), a hash of its
    presentation, and its kind.
    """

    texts: list[str]
    at: list[int]
    paths: list[int]
    above: list[int]
    shown: list[int]
    kinds: list[int]

    def features(self) -> Counter[tuple[int, int]]:
        """How often each pair of neighbouring words stands in the text of each style, as hashes.

        A block's first word is paired with nothing. Pages without a branch that could be removed
        need none.
        """
        found: Counter[tuple[int, int]] = Counter()
        if all(kind == STAYS for kind in self.kinds):
            return found
        for text, at in zip(self.texts, self.at, strict=True):
            if at >= 0:
                words = text.split()
                pairs = zip(["", *words], words, strict=False)
                path = self.paths[at]
                found.update((path, signed(xxhash.xxh64_intdigest(f"{a} {b}"))) for a, b in pairs)
        return found

    def main(self, rated: dict[int, tuple[float, float, float]]) -> str:
        """The text of the branches that stay.

        `rated` has (pages, content, presentation) of the host's styles; others are important. Of
        the branches and the text of an element the most important stays, so a page never loses all,
        and importance counts for more the fewer pages tell of it.
        """
        count = len(self.paths)
        unrated = (1.0, 1.0, 1.0)
        own, parts = [False] * count, [[] for _ in range(count)]
        top: list[float] = []
        for at in self.at:
            if at >= 0:
                own[at] = True
        worth = [0.0] * count
        for i in reversed(range(count)):
            _, content, shown = rated.get(self.paths[i], unrated)
            held = parts[i] + ([content] if own[i] else [])
            worth[i] = shown + (1 - shown) * sum(held) / len(held)
            (parts[self.above[i]] if self.above[i] >= 0 else top).append(worth[i])
        stays = []
        for i, (path, above, kind) in enumerate(zip(self.paths, self.above, self.kinds, strict=True)):
            pages = rated.get(path, unrated)[0]
            _, content, shown = rated.get(self.paths[above], unrated) if above >= 0 else unrated
            beside = parts[above] + ([content] if own[above] else []) if above >= 0 else top
            share = LEAST_SHARE if kind == FREE and (above < 0 or shown < 0.5) else LEAST_WITHIN
            low = kind != STAYS and worth[i] + 1 / pages < share * max(beside)
            stays.append(not low and (above < 0 or stays[above]))
        kept = (t for t, at in zip(self.texts, self.at, strict=True) if at < 0 or stays[at])
        return "\n".join(kept)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(found, F.lit(""))


LISTS = {"texts": pa.string(), "at": pa.int32(), "paths": pa.int64(), "above": pa.int32(),
         "shown": pa.int64(), "kinds": pa.int32()}
LISTED = (
    "texts array<string>, at array<int>, paths array<long>, above array<int>, shown array<long>, "
    "kinds array<int>"
)


def trees(hosted: DataFrame) -> DataFrame:
    """(page, host, digest, and the lists of `Tree`) of (page, host, html), parsed once and stored."""
    own = hosted.select("page", "host", F.lit(0).cast("long").alias("digest")).schema
    schema = StructType(own.fields + StructType.fromDDL(LISTED).fields)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for group in row_groups(batch, "html"):
                found = [Page(x or "").tree() for x in group.column("html").to_pylist()]
                digests = [
                    signed(xxhash.xxh64_intdigest(repr((t.texts, t.at, t.paths, t.shown))))
                    for t in found
                ]
                lists = [
                    pa.array([getattr(t, name) for t in found], pa.list_(kind))
                    for name, kind in LISTS.items()
                ]
                yield pa.RecordBatch.from_arrays(
                    [group.column("page"), group.column("host"), pa.array(digests, pa.int64()), *lists],
                    ["page", "host", "digest", *LISTS],
                )

    return stored(map_batches(hosted, run, schema), "html-trees")


def weighed(parsed: DataFrame) -> DataFrame:
    """The trees with `weight`: all copies of a page on its host weigh one together.

    Only pages that have copies are joined; their copies are counted by partial sums. Texts of
    pages without a branch that could be removed are not needed and stay behind.
    """
    removable = F.exists("kinds", lambda kind: kind != STAYS)
    slim = parsed.withColumns({name: F.when(removable, F.col(name)) for name in ("texts", "at")})
    copies = parsed.groupBy("host", "digest").agg(F.count("*").alias("copies")).filter("copies > 1")
    weight = 1 / F.coalesce("copies", F.lit(1))
    columns = ["host", *LISTS]
    return slim.join(copies, ["host", "digest"], "left").select(*columns, weight.alias("weight"))


def _page_features(rows: DataFrame) -> DataFrame:
    """(host, path, feature, n, mass): counts c of a page, and c ln c, both times its weight."""

    def written(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in columns],
            ["host", "path", "feature", "n", "mass"],
        )

    def run(batches: Batches) -> Batches:
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(name) for name in ("host", "weight", *LISTS)]
            for i in range(batch.num_rows):
                host, weight, *lists = (column[i].as_py() for column in columns)
                for (path, pair), count in Tree(*lists).features().items():
                    n = weight * count
                    out.append((host, path, pair, n, n * math.log(count)))
                if len(out) >= FEATURES_AT_ONCE:
                    yield written(out)
                    out = []
        if out:
            yield written(out)

    schema = "host string, path long, feature long, n double, mass double"
    return map_batches(rows, run, schema)


def ratings(parsed: DataFrame) -> DataFrame:
    """(host, path, pages, content, presentation) of the styles of each host.

    Sums over pages combine before every exchange, so a host with very many pages sends no more
    rows than its tasks have styles and pairs of words. `presentation` is its entropy, 0 to 1, times
    the weight that its number of styles gives it; `content` is 1 less the mean entropy of the
    pairs, 1 where there are none.
    """
    rows = weighed(parsed)
    style = F.explode(F.arrays_zip("paths", "shown")).alias("style")
    styles = rows.select("host", "weight", style).select(
        "host", "weight", F.col("style.paths").alias("path"), F.col("style.shown").alias("shown")
    )
    styles = styles.groupBy("host", "path", "shown").agg(F.sum("weight").alias("n"))
    entropy = F.log("pages") - F.col("mass") / F.col("pages")
    weight = 1 - F.pow(F.lit(LEFT_BY_STYLE), F.col("styles") - 1)
    shown = (
        styles.groupBy("host", "path")
        .agg(
            F.sum("n").alias("pages"),
            F.sum(F.col("n") * F.log("n")).alias("mass"),
            F.count("*").alias("styles"),
        )
        .filter("pages > 1.5")
        .select("host", "path", "pages", (weight * entropy / F.log("pages")).alias("presentation"))
    )
    pairs = _page_features(rows).groupBy("host", "path", "feature")
    pairs = pairs.agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))
    pair_entropy = F.log("n") - F.col("mass") / F.col("n")
    content = pairs.groupBy("host", "path").agg(F.avg(pair_entropy).alias("mean"))
    lost = F.coalesce(F.col("mean") / F.log("pages"), F.lit(0.0))
    return shown.join(content, ["host", "path"], "left").select(
        "host",
        "path",
        F.round("pages", 6).alias("pages"),
        F.round(1 - lost, 9).alias("content"),
        F.round("presentation", 9).alias("presentation"),
    )


def main_text(pages: DataFrame, url: str = "url", column: str = "html") -> DataFrame:
    """The rows of `pages` with `text` (main text) and `n_chars` instead of the HTML.

    Null and empty pages have an empty text. Pages without a host form a site of their own; a page
    alone on its host loses no branch by its importance, and copies of a page on a host count as one.
    Pages are parsed once; what is stored of them is met by the ratings of their host's styles,
    of which only those go along that lack importance. Repeated rows stay repeated; ties in
    importance stay; an empty table gives an empty one; columns `text` and `n_chars` give way.
    """
    pages = without(pages, "text", "n_chars")
    kept = [c for c in pages.columns if c != column]
    hosted = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"),
        host_of(F.col(url)).alias("host"),
        F.col(column).alias("html"),
    )
    parsed = trees(hosted)
    rated = ratings(parsed).filter(F.col("presentation") < 0.99)
    rated = rated.groupBy("host").agg(
        F.collect_list(F.struct("path", "pages", "content", "presentation")).alias("rated")
    )
    joined = parsed.join(stored(rated, "html-ratings"), "host", "left")
    joined = joined.select("page", *LISTS, "rated")
    schema = joined.select("page", F.lit("").alias("text")).schema

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = []
            lists = [batch.column(name) for name in (*LISTS, "rated")]
            for i in range(batch.num_rows):
                *tree, found = (column[i].as_py() for column in lists)
                host = {
                    r["path"]: (r["pages"], r["content"], r["presentation"]) for r in found or ()
                }
                texts.append(Tree(*tree).main(host))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), pa.array(texts, pa.string())], ["page", "text"]
            )

    found = map_batches(joined, run, schema)
    return found.select("page.*", "text", F.char_length("text").cast("long").alias("n_chars"))
