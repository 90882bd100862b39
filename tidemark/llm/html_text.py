"""Main text of pages, with templates learnt per host by aligning DOM trees.

Pages become trees of all their visible block elements. A text node that says the same on
nearly all different pages of a host is template, whatever its element or class is called.
What varies is content, unless its element or a name in its tag says that it is a menu, a
header, footer, sidebar, notice, advert, form or reader comment. Such names also tell which
pages differ: pages that say the same outside of named elements count once, so copies of an
article with other adverts around it don't make the article a template.

Such a node has the same text under the same elements on nearly all pages, which is
counted first. Pages are reduced to the blocks that this leaves, equal ones of a host to
one with its number, and these few are laid on each other by simple tree matching, the
most frequent first, nodes that only some have kept. So neither the order of pages nor
their partitions matter. What is learnt of a host is the tree of its template nodes alone.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Collection, Iterator, Sequence
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, extended, own
from tidemark.session import stored

LEAST_PAGES = 5     # compared pages before a node can be template
CONSTANT = 0.8      # share of them on which it must say the same
DEEPEST = 200       # levels of the trees; what lies deeper hangs on the last, its text whole
MERGED = 256        # reduced pages of a host that one call lays on each other
EQUAL = 4           # weight of blocks with equal text in an alignment
CELLS = 40_000      # of an alignment table held whole; of larger ones some rows are held, the rest made again
HOSTS_HELD = 2_000  # templates that a task keeps read
REDUCED_HELD = 20_000  # reduced pages that a task counts before it hands them on

# Elements of HTML by their part in a page.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set(
    "select noscript template svg canvas object audio video head script style textarea title iframe noembed "
    "noframes math button".split()
)
NAMED_ELEMENTS = set("nav header footer aside form menu dialog fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
# Words that class and id names of what is not the article end in.
FOREIGN = set(  # never the article, even if they hold most of a page
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "cookie cookies consent gdpr comment comments reply replies respond disqus".split()
)
MARKS = FOREIGN | set(
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager "
    "header masthead topbar footer copyright sidebar aside widget widgets related recommended "
    "share sharing social notice notices alert newsletter subscribe "
    "subscription popup modal overlay signup login search form".split()
)
# Words that may follow a mark in a name.
PARTS = set(
    "area bar block bottom box button buttons col column container group holder icon icons inner item items left "
    "link links list message outer panel right row section slot text thread title top unit wrap wrapper".split()
)
UNMARKED = set("no not has with without free hide".split())  # a name with one of them marks nothing
CONTENT = set("article body content entry main page post story text".split())  # nor do names beside one of them

CLOSED_BY = {  # an open element that a start tag ends, and where to stop looking
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")


def is_mark(name: str) -> str | None:
    """The mark that a class or id name ends in, parts and numbers after it aside.

    `reader-comments`, `siteHeader` and `ad-slot-2` are marked, `page-with-sidebar`, `ad-free`
    and `search-results` are not, nor are headers of an article (`post-header`).
    """
    words = [w.lower() for w in WORD.findall(name)]
    if not UNMARKED.isdisjoint(words):
        return None
    while words and words[-1] not in MARKS and (words[-1] in PARTS or words[-1].isdigit()):
        words.pop()
    own_heading = "header" in words[-1:] and set(words) & CONTENT - {"main", "page"}
    if not words or words[-1] not in MARKS or own_heading:
        return None
    return words[-1]


def marks_of(attributes: str) -> tuple[set[str], bool]:
    """Marks of a tag (its names and role), and whether its role is main."""
    found, main = set(), False
    for key, *values in NAMED.findall(attributes):
        value = "".join(values)
        if key.lower() == "role":
            main |= value.lower() == "main"
            if value.lower() in ROLES:
                found.add("role")
        elif CONTENT.isdisjoint(names := value.split()):
            found |= {m for n in names if (m := is_mark(n))}
    return found, main


class Page:
    """Blocks of text in page order and the tree of elements around them.

    A tree node is [label, children]; a child is a node or the number of a block.
    `content` tells which blocks are the main text.
    """

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.region: list[int] = []  # 1 inside the main part, 2 inside an article, 3 inside both
        self.paragraph: list[bool] = []  # whether the text is in a paragraph
        self.named: list[int] = []  # innermost marked element around, 0 if none
        self.around = [0]  # the marked element around a marked one
        self.spared = [0]  # 2 for marks that may be layout alone, 1 for forms, else 0
        self.tree: list = ["page", []]
        self._parse(source)

    def content(self, template: Collection[int] = ()) -> list[int]:
        """Numbers of the blocks of the main text, given those of the template.

        A marked element does not count as such if nothing but marked text would be left
        and it holds most of it, in paragraphs or in an article or main part. Adverts, notices
        of cookies and comments always do.
        """
        left = [i for i in range(len(self.blocks)) if i not in template]
        lifted: set[int] = set()
        while not (plain := [i for i in left if not self._is_named(i, lifted)]):
            held = self._held(left, lifted)
            most = max(held, key=lambda m: (held[m], -m), default=0)
            if not most or 2 * held[most] <= sum(len(self.blocks[i]) for i in left):
                break
            lifted.add(most)
        if any(self.region[i] == 1 and self.paragraph[i] for i in plain):  # the articles are parts of it
            return [i for i in plain if self.region[i] & 1]
        for part in (2, 1):
            if among := [i for i in plain if self.region[i] & part]:
                return among
        return plain

    def _is_named(self, block: int, lifted: set[int]) -> bool:
        mark = self.named[block]
        while mark in lifted:
            mark = self.around[mark]
        return mark > 0

    def _held(self, left: list[int], lifted: set[int]) -> dict[int, int]:
        """Text in the marked elements that may be spared."""
        held: dict[int, int] = {}
        for i in left:
            mark = self.named[i]
            while mark:
                fits = self.region[i] or self.paragraph[i] and self.spared[mark] == 2
                if self.spared[mark] and fits and mark not in lifted:
                    held[mark] = held.get(mark, 0) + len(self.blocks[i])
                mark = self.around[mark]
        return held

    def _parse(self, source: str) -> None:
        # open elements: name, tree node, region, marked element, whether it is hidden
        stack = [("", self.tree, 0, 0, False)]
        held: list[str] = []

        def flush() -> None:
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                held.clear()
                _, node, region, mark, _ = next(e for e in reversed(stack) if not e[4])
                if text:
                    node[1].append(len(self.blocks))
                    self.blocks.append(text)
                    self.region.append(region)
                    self.named.append(mark)
                    self.paragraph.append(any(e[0] == "p" for e in stack))

        def close(until: int) -> None:
            if any(e[0] in BLOCKS for e in stack[until:]):
                flush()
            del stack[until:]

        at = 0
        for tag in TAG.finditer(source):
            if tag.start() < at:  # inside a raw element
                continue
            if tag.start() > at and not stack[-1][4]:
                held.append(source[at : tag.start()])
            at = tag.end()
            name = (tag[2] or tag[5] or "").lower()
            if not name:
                continue
            if tag[1] or tag[4]:
                if name == "br":
                    held.append(" ")
                found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if found:
                    close(found)
                elif name in BLOCKS:
                    flush()
                continue
            attributes = tag[3] or tag[6] or ""
            if name in RAW:
                end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(source, at)
                at = end.start() if end else len(source)
                continue
            if name in VOID:
                if name in BLOCKS:
                    flush()
                elif name == "br":
                    held.append(" ")
                continue
            self._open(name, attributes, stack, flush, close)
        if at < len(source) and not stack[-1][4]:
            held.append(source[at:])
        flush()

    def _open(self, name: str, attributes: str, stack: list, flush, close) -> None:
        block = name in BLOCKS
        marks, main = marks_of(attributes) if "=" in attributes else (set(), False)
        if main or name in ("html", "body", "main", "article"):
            marks = set()
        if name in NAMED_ELEMENTS:
            marks = marks | {name}
        hidden = stack[-1][4] or name in HIDDEN or bool(marks) and not block
        if not block and hidden == stack[-1][4]:
            return  # an inline element changes nothing
        if block:
            flush()
            ends, stop = CLOSED_BY.get(name, ({"p"}, set()))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in stop:
                    break
                if stack[i][0] in ends or stack[i][0] == "p":
                    close(i)
                    if stack[-1][0] not in ends:
                        break
        _, parent, region, mark, above = stack[-1]
        hidden = hidden or above
        if marks and block and not (name == "header" and region & 2):  # an article's own heading is none
            self.around.append(mark)
            self.spared.append(
                1 if name == "form" else 0 if name in NAMED_ELEMENTS or marks & FOREIGN else 2
            )
            mark = len(self.around) - 1
        if not hidden:
            region |= 2 if name == "article" else 1 if name == "main" or main else 0
        if hidden or len(stack) >= DEEPEST:
            node = parent
        else:
            node = [name, []]
            parent[1].append(node)
        stack.append((name, node, region, mark, hidden))


def _renumbered(node: list, number: dict[int, int]) -> list:
    out = []
    for child in node[1]:
        if isinstance(child, int):
            if child in number:
                out.append(number[child])
        elif (made := _renumbered(child, number))[1]:
            out.append(made)
    return [node[0], out]


def mark_of(text: str) -> int:
    """A 48-bit hash, which JSON keeps exactly."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).digest(), "big")


# -- simple tree matching ----------------------------------------------------------

class Alignment:
    """Pairs of blocks of two trees that simple tree matching lays on each other.

    Nodes match if their labels do. Children are matched in order, so that the number
    of matched nodes is largest, where a block of equal text counts as `EQUAL` nodes.
    With `equal`, blocks match only if they are equal, and nodes only if some of their blocks do.
    """

    def __init__(self, left: list, right: list, of_left: Sequence, of_right: Sequence, equal: bool = False):
        self.of_left, self.of_right, self.known, self.pairs = of_left, of_right, {}, []
        self.equal = equal
        self._pair(left, right)

    def _score(self, a, b) -> int:
        if isinstance(a, int) or isinstance(b, int):
            if isinstance(a, int) and isinstance(b, int):
                return EQUAL if self.of_left[a] == self.of_right[b] else 0 if self.equal else 1
            return 0
        if a[0] != b[0]:
            return 0
        key = (id(a), id(b))
        if (found := self.known.get(key)) is None:
            row = [0] * (len(b[1]) + 1)
            for x in a[1]:
                row = self._row(x, b[1], row)
            found = 1 + row[-1] if row[-1] or not self.equal else 0
            if len(self.known) < CELLS:
                self.known[key] = found
        return found

    def _row(self, a, right: list, above: list[int]) -> list[int]:
        row, best = [0], 0
        for j, b in enumerate(right):
            score = self._score(a, b)
            best = max(best, above[j + 1], above[j] + score if score else 0)
            row.append(best)
        return row

    def _pair(self, a: list, b: list) -> None:
        for x, y in self._matched(a[1], b[1]):
            if isinstance(x, int):
                self.pairs.append((x, y))
            else:
                self._pair(x, y)

    def _matched(self, left: list, right: list) -> list:
        return [(left[i], right[j]) for i, j in self._places(left, right)]

    def _places(self, left: list, right: list) -> list[tuple[int, int]]:
        """Places of matched children, in order.

        Of a large table every `step`th row is held, and the rows after it are made again
        on the way back, so that the matches are those of the whole table.
        """
        step = len(left) + 1 if len(left) * len(right) <= CELLS else isqrt(len(left)) + 1
        held, row = [], [0] * (len(right) + 1)
        for i, a in enumerate(left):
            if i % step == 0:
                held.append(row)
            row = self._row(a, right, row)
        out, i, j = [], len(left), len(right)
        while i and j:
            low = (i - 1) // step * step
            table = [held[low // step]]
            for a in left[low:i]:
                table.append(self._row(a, right, table[-1]))
            while i > low and j:
                if table[i - low][j] == table[i - low - 1][j]:
                    i -= 1
                elif table[i - low][j] == table[i - low][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((i, j))
        return out[::-1]


# -- templates ---------------------------------------------------------------------

class Reference:
    """A page's tree and, for each block, on how many pages it was looked for and the same."""

    def __init__(self, tree: list, marks: list[int], same: list[int] | None = None, pages: int = 1):
        self.tree, self.marks, self.pages = tree, list(marks), pages
        self.same = list(same) if same else [1] * len(marks)

    def add(self, other: Reference) -> None:
        """Another reference, or one page, laid on this one; what only one of them has is kept."""
        align = Alignment(self.tree, other.tree, self.marks, other.marks, equal=True)
        self.tree = self._joined(self.tree, other.tree, other, align)
        self.pages += other.pages

    def _joined(self, a: list, b: list, other: Reference, align: Alignment) -> list:
        out, i, j = [], 0, 0
        for x, y in [*align._places(a[1], b[1]), (len(a[1]), len(b[1]))]:
            out += a[1][i:x]
            out += [self._taken(c, other) for c in b[1][j:y]]
            if x < len(a[1]):
                one, same = a[1][x], b[1][y]
                if isinstance(one, int):
                    self.same[one] += other.same[same]
                    out.append(one)
                else:
                    out.append(self._joined(one, same, other, align))
            i, j = x + 1, y + 1
        return [a[0], out]

    def _taken(self, child, other: Reference):
        if not isinstance(child, int):
            return [child[0], [self._taken(c, other) for c in child[1]]]
        self.marks.append(other.marks[child])
        self.same.append(other.same[child])
        return len(self.marks) - 1

    def dump(self) -> str:
        return json.dumps([self.tree, self.marks, self.same, self.pages], separators=(",", ":"))

    @classmethod
    def load(cls, text: str) -> Reference:
        return cls(*json.loads(text))

    def template(self, least_pages: int, constant: float) -> str | None:
        """The tree of blocks that say the same nearly everywhere, None if there are none."""
        if self.pages < least_pages:
            return None
        kept = [i for i, n in enumerate(self.same) if n >= constant * self.pages]
        if not kept:
            return None
        tree = _renumbered(self.tree, {i: k for k, i in enumerate(kept)})
        return json.dumps([tree, [self.marks[i] for i in kept]], separators=(",", ":"))


def _keys(node: list, blocks: list[str], path: str = "") -> Iterator[tuple[int, int]]:
    """Numbers of blocks with a hash of the text and the elements around it."""
    for child in node[1]:
        if isinstance(child, int):
            yield child, mark_of(f"{path}\0{blocks[child]}")
        else:
            yield from _keys(child, blocks, f"{path}/{child[0]}")


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tree, marks and keys of pages with blocks, and a digest of their content."""
    for batch in batches:
        made: dict[tuple, tuple[str, list[int]]] = {}
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source or "")
            marks = [mark_of(b) for b in page.blocks]
            if marks:
                said = [marks[i] for i in page.content()] or marks
                key = (host, hashlib.blake2b(json.dumps(said).encode(), digest_size=16).digest())
                outline = json.dumps([page.tree, marks], separators=(",", ":"))
                keys = [k for _, k in sorted(_keys(page.tree, page.blocks))]
                made[key] = min((outline, keys), made.get(key, (outline, keys)))
        rows = [
            pa.array([h for h, _ in made], pa.string()), pa.array([d for _, d in made], pa.binary()),
            pa.array([p for p, _ in made.values()], pa.string()),
            pa.array([k for _, k in made.values()], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(rows, ["host", "digest", "page", "keys"])


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages reduced to the blocks of wanted keys, equal ones of a host counted in a batch of pages."""
    held: dict[tuple, int] = {}

    def out() -> pa.RecordBatch:
        rows = [pa.array([k[i] for k in held], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))]
        rows.append(pa.array(held.values(), pa.int64()))
        held.clear()
        return pa.RecordBatch.from_arrays(rows, ["host", "pages", "page", "n"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("host", "pages", "page", "keys", "wanted"))
        for host, pages, page, keys, wanted in zip(*columns, strict=True):
            tree, marks = json.loads(page)
            among = set(wanted)
            kept = [i for i, k in enumerate(keys) if k in among]
            if kept:
                small = [_renumbered(tree, {i: k for k, i in enumerate(kept)}), [marks[i] for i in kept]]
                key = (host, pages, json.dumps(small, separators=(",", ":")))
                held[key] = held.get(key, 0) + 1
        if len(held) >= REDUCED_HELD:
            yield out()
    yield out()


def _referenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduced pages as references, of as many pages as are equal."""
    for batch in batches:
        made = []
        for page, n in zip(batch.column("page").to_pylist(), batch.column("n").to_pylist(), strict=True):
            tree, marks = json.loads(page)
            made.append(Reference(tree, marks, [n] * len(marks), n).dump())
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("pages"), pa.array(made, pa.string()), batch.column("n")],
            ["host", "pages", "reference", "n"],
        )


def _merge(rows: pd.DataFrame) -> Reference:
    """References of a host, those of most pages first."""
    first, *others = [
        Reference.load(r) for _, r in sorted(zip(rows["n"].tolist(), rows["reference"], strict=True), key=lambda r: (-r[0], r[1]))
    ]
    for one in others:
        first.add(one)
    return first


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    whole = _merge(rows)
    return pd.DataFrame(
        {"host": [rows["host"].iloc[0]], "pages": [rows["pages"].iloc[0]], "reference": [whole.dump()], "n": [whole.pages]}
    )


def _in_rounds(reduced: DataFrame, merged: int, space: Scratch) -> DataFrame:
    """One reference for each host, at most about `merged` laid on each other in a call.

    The references of a round are dealt by a hash of what they are, so reruns agree.
    """
    schema = "host string, pages long, reference string, n long"
    while True:
        counts = reduced.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("m"))
        if not (counts.agg(F.max("m")).first()[0] or 0) > merged:
            return reduced.groupBy("host").applyInPandas(_merged, schema)
        parts = F.ceil(F.col("m") / F.lit(merged)).cast("int")
        reduced = space.table(
            reduced.join(counts, F.col("host") == F.col("of"))
            .withColumn("part", F.pmod(F.xxhash64("reference"), parts))
            .groupBy("host", "part").applyInPandas(_merged, schema)
        )


def host_of(url: Column) -> Column:
    """Host of an address in lower case; an address without one is a host of its own name."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(found)


def learn_templates(
    pages: DataFrame, url: str = "url", source: str = "html",
    least_pages: int = LEAST_PAGES, constant: float = CONSTANT, merged: int | None = None,
) -> DataFrame:
    """`host` and `template` (a tree as JSON) of the hosts that have template nodes.

    Pages of a host with equal content are one page, whatever their ids and partitions;
    which of them gives the other blocks is the least by its tree. Null and empty html and
    pages without visible text are no pages here, null and odd addresses no hosts. An empty
    table, and hosts of fewer than `least_pages` pages, give no rows. Only the two named
    columns are read.
    """
    given = pages.select(host_of(F.col(url)).alias("host"), F.col(source).alias("html")).filter("host <> ''")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        whole = Reference.load(rows["reference"].iloc[0])
        whole.pages = int(rows["pages"].iloc[0])  # also those without any of the blocks
        return pd.DataFrame({"host": rows["host"], "template": [whole.template(least_pages, constant)]})

    def finished(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for i in range(len(part)):
                yield one(part.iloc[i : i + 1].reset_index(drop=True))

    with Scratch(pages.sparkSession, "outlines") as space:
        outlines = given.mapInArrow(_outlines, "host string, digest binary, page string, keys array<long>")
        once = outlines.groupBy("host", "digest").agg(F.min(F.struct("page", "keys")).alias("one"))
        once = space.table(once.select("host", "one.page", "one.keys"))
        hosts = space.table(
            once.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least_pages)
        )
        often = (
            once.select("host", F.explode(F.array_distinct("keys")).alias("key"))
            .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= F.lit(constant * least_pages))
        )
        wanted = space.table(
            often.join(hosts, F.col("host") == F.col("of"))
            .filter(F.col("n") >= F.lit(constant) * F.col("pages"))
            .groupBy("of", "pages").agg(F.collect_list("key").alias("wanted"))
        )
        reduced = space.table(
            once.join(wanted, F.col("host") == F.col("of"))
            .select("host", "pages", "page", "keys", "wanted")
            .mapInArrow(_reduced, "host string, pages long, page string, n long")
            .groupBy("host", "pages", "page").agg(F.sum("n").alias("n"))
            .mapInArrow(_referenced, "host string, pages long, reference string, n long")
        )
        learnt = _in_rounds(reduced, merged or MERGED, space).mapInPandas(finished, "host string, template string")
        return space.result(learnt.filter("template is not null"))


def template_blocks(page: Page, template: tuple[list, list[int]] | None) -> set[int]:
    """Numbers of the blocks of a page that match its host's template."""
    if template is None:
        return set()
    marks = [mark_of(b) for b in page.blocks]
    tree, constant = template
    return {j for i, j in Alignment(tree, page.tree, constant, marks).pairs if constant[i] == marks[j]}


def main_text(source: str, template: tuple[list, list[int]] | None) -> str:
    """The blocks of a page's content, a line each, without those that match the template."""
    page = Page(source)
    return "\n".join(page.blocks[i] for i in page.content(template_blocks(page, template)))


def extract_text(
    pages: DataFrame,
    url: str = "url",
    source: str = "html",
    carry: Sequence[str] | None = None,
    least_pages: int = LEAST_PAGES,
    constant: float = CONSTANT,
) -> DataFrame:
    """Add `text`, the main text of every page, and `n_chars` (code points).

    What matches the host's template and what lies in marked elements is left out. Of the
    rest, the main text is what the page's article elements hold; without any, its main part, which
    also goes before articles if it has paragraphs outside of them; without that, its body. Blocks are in page order, each on a line, white space in them made
    one space. A host needs `least_pages` pages before any text counts as its template.
    Null and empty html, and pages without content, have empty text. Pages with null or
    odd addresses belong to no host. One row out for every row in; input columns named
    like an added one are replaced.
    """
    added = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    carried, schema = extended(pages, carry, added)
    names = schema.fieldNames()
    at_html, at_template, at_host = (own(pages, f"_tm_{c}") for c in ("html", "template", "host"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for one, found in zip(batch.column(at_html).to_pylist(), batch.column(at_template).to_pylist(), strict=True):
                if found and found not in known:
                    if len(known) >= HOSTS_HELD:
                        known.clear()
                    known[found] = tuple(json.loads(found))
                texts.append(main_text(one or "", known[found] if found else None))
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names)

    # one row per host at most, kept in the shared folder: Spark broadcasts it by its size
    templates = stored(learn_templates(pages, url, source, least_pages, constant)).select(
        F.col("host").alias(at_host), F.col("template").alias(at_template)
    )
    rows = pages.select(*carried, F.col(source).alias(at_html), host_of(F.col(url)).alias(at_host))
    return rows.join(templates, at_host, "left").drop(at_host).mapInArrow(work, schema)
