"""Main text of web pages by composite text density (operator 5)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that an element of the same row ends, up to the nearest of the elements behind the colon.
ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: What a main text never holds.
APART = frozenset(
    "aside button datalist dialog footer form head header iframe input label menu nav noscript object optgroup option "
    "script select style svg template textarea title".split()
)
#: The same, told by a class, an id or a role.
APART_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter "
    "notice notices notification popup promo promotion related replies respond search share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
#: Those that hold no main text even where they hold most of a page's text.
NEVER_MAIN = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus replies respond "
    "sponsor sponsored".split()
)
#: Prefixes and suffixes such names come with.
AFFIXES = re.compile(
    r"^(?:site|page|main|top|bottom|left|right|user|reader)[-_]"
    r"|[-_](?:box|bar|list|area|block|section|wrap|wrapper|container|\d+)$"
)


class Tree(HTMLParser):
    """Elements in page order, each behind its parent, with what belongs to an element itself."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.link = ["#root"], [-1], [False]
        self.name = [""]  # the word of a class, id or role that sets an element apart
        self.text: list[tuple[int, int, str]] = []  # element, block, text
        self.open = [0]
        self.held: Counter[str] = Counter()  # open elements by tag, so that none is looked for in vain
        self.block = 0

    def close_from(self, depth: int) -> None:
        self.held.subtract(self.tag[i] for i in self.open[depth:])
        del self.open[depth:]

    def deepest(self, tag: str) -> int:
        """Where in the open elements the last one of a tag stands; 0 if there is none."""
        depth = len(self.open) - 1 if self.held[tag] else 0
        while depth and self.tag[self.open[depth]] != tag:
            depth -= 1
        return depth

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.block += 1
            if depth := self.deepest("p"):
                # A block ends an open paragraph, with whatever inline elements are open in it.
                self.close_from(depth)
        if tag in ENDED:
            ends, within = ENDED[tag]
            if depth := max(map(self.deepest, ends)):
                if depth > max(map(self.deepest, within)):
                    self.close_from(depth)
        above = self.open[-1]
        index = len(self.tag)
        self.tag.append(tag)
        self.parent.append(above)
        self.name.append(name_apart(attrs))
        self.link.append(tag == "a" or self.link[above])
        if tag == "br":
            self.text.append((above, self.block, "\n"))  # white space of the block
        if tag not in VOID:
            self.open.append(index)
            self.held[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # only void elements close themselves

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        if depth := self.deepest(tag):
            self.close_from(depth)

    def handle_data(self, data: str) -> None:
        self.text.append((self.open[-1], self.block, data))


def name_apart(attrs: list[tuple[str, str | None]]) -> str:
    """The word of a class, id or role that says the element holds no main text; empty if none does."""
    for name, value in attrs:
        if value and name in ("class", "id", "role"):
            for word in value.lower().split():
                for bare in (word, AFFIXES.sub("", word)):
                    if bare in APART_NAMED:
                        return bare
    return ""


def parsed(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree


def densities(tree: Tree, apart: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of every element, and the sum of its children's densities.

    Characters per tag, weighted by the logarithm of characters per link character and of tags per
    link tag; the base of the logarithm grows with the share of link text in the page.
    """
    n = len(tree.tag)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, _, text in tree.text:
        if not apart[i]:
            size = len("".join(text.split()))
            chars[i] += size
            link_chars[i] += size * tree.link[i]
    for i in range(n - 1, 0, -1):
        if not apart[i]:
            up = tree.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + tree.link[i]
    share = link_chars[0] / max(1, chars[0])
    density, total, leaf = [0.0] * n, [0.0] * n, [True] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not apart[i]:
            c, t = chars[i], max(1, tags[i])
            linked, plain = max(1, link_chars[i]), max(1, c - link_chars[i])
            base = math.log(math.log(c / plain * linked + share * c + math.e))
            density[i] = c / t * math.log(max(1.0, c / linked * t / max(1, link_tags[i]))) / base
            if leaf[i]:
                total[i] = density[i]
        if i:
            total[tree.parent[i]] += density[i]
            leaf[tree.parent[i]] = False
    return density, total


def greatest(tree: Tree, total: list[float]) -> list[int]:
    """The element of greatest sum in each subtree, the outermost among equals."""
    best = list(range(len(total)))
    for i in range(len(total) - 1, 0, -1):
        up = tree.parent[i]
        if total[best[i]] > total[best[up]]:
            best[up] = best[i]
    return best


def set_apart(tree: Tree) -> list[bool]:
    """Which elements hold no main text, by their tag or by what they are called.

    An article or main element, and what holds one, is not set apart. On a page without text in such an
    element the density may speak against a name: where the core lies in named wrappers, in two blocks
    or more with fewer characters in links than out of them, and has more of the latter than all that is not
    set apart, the wrappers around it are no longer. Adverts, consent and reader comments always are.
    """
    n = len(tree.tag)
    holds = [tag in ("article", "main", "body") for tag in tree.tag]
    inside = [tag in ("article", "main") for tag in tree.tag]
    for i in range(n - 1, 0, -1):
        holds[tree.parent[i]] |= holds[i]

    def spread(named: Callable[[int], bool]) -> list[bool]:
        apart = [False] * n
        for i in range(1, n):
            apart[i] = apart[tree.parent[i]] or not holds[i] and (tree.tag[i] in APART or named(i))
        return apart

    apart = spread(lambda i: bool(tree.name[i]))
    for i in range(1, n):
        inside[i] |= inside[tree.parent[i]]
    if any(inside[i] and not apart[i] and not text.isspace() for i, _, text in tree.text):
        return apart
    by_tag = spread(lambda i: tree.name[i] in NEVER_MAIN)
    if by_tag == apart:
        return apart
    core = i = greatest(tree, densities(tree, by_tag)[1])[0]
    wrappers = set()
    while i > 0:
        if tree.name[i] and not holds[i]:
            wrappers.add(i)
        i = tree.parent[i]
    if not wrappers:
        return apart
    within = [i == core for i in range(n)]
    for i in range(1, n):
        within[i] |= within[tree.parent[i]]
    plain, linked, rest, blocks = 0, 0, 0, set()
    for i, block, text in tree.text:
        size = len("".join(text.split()))
        if within[i] and not by_tag[i] and size:
            blocks.add(block)
            linked += size * tree.link[i]
            plain += size * (not tree.link[i])
        elif not apart[i]:
            rest += size * (not tree.link[i])
    if len(blocks) < 2 or plain <= linked or plain <= rest:
        return apart
    return spread(lambda i: bool(tree.name[i]) and i not in wrappers)


def main_text(html: str) -> str:
    """The main text: blocks in page order, one to a line.

    The element with the greatest sum of child densities is the core. The least density on the path
    from the body to the core is the threshold; under every element that reaches it, the element
    of greatest sum belongs to the main text. So do headings beside the path, and the whole of an
    article or main element around the core, however short its blocks. What ``set_apart`` names never
    does. A ``<br>`` is white space inside its block.
    """
    tree = parsed(html)
    n = len(tree.tag)
    apart = set_apart(tree)
    density, total = densities(tree, apart)
    best = greatest(tree, total)
    path, i = set(), best[0]
    while i > 0 and tree.tag[i] != "html":
        path.add(i)
        i = tree.parent[i]
    threshold = min((density[i] for i in path), default=0.0)
    chosen = [i in path and tree.tag[i] in ("article", "main") for i in range(n)]
    for i in range(1, n):
        if tree.tag[i] in HEADINGS and tree.parent[i] in path:
            chosen[i] = True
        if density[i] >= threshold and density[i] > 0 and tree.tag[i] != "html":
            chosen[best[i]] = True
    blocks: dict[int, list[str]] = {}
    for i in range(1, n):
        chosen[i] |= chosen[tree.parent[i]]
    for i, block, text in tree.text:
        if not apart[i] and (chosen[i] or best[0] == 0):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages with their main text in ``main_text`` (replaced if there is one already).

    A null or empty page, and one without text, gives an empty text. Each row is handled by itself
    and whole; repeated rows give repeated results, and other columns are passed on.
    """
    kept = pages.drop("main_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [main_text(x) if x else "" for x in batch.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "main_text"]
                )

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("main_text", T.StringType())]))


def texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )
