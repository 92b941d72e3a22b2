"""Main text of web pages by removal of site templates.

Every element subtree of a page's article, or of the whole page if it marks none, is hashed. Spark
counts, per host, the distinct contents that a subtree stands beside: the longest block of text
outside it, if that is half as long as the subtree at least. So an article that is reprinted under
changing menus counts once. Subtrees that recur are deleted: outside articles those of ``WORDS`` words from
``LEAST_PAGES`` contents on, shorter ones, which recur by chance, from four times as many for each
word less, and any on half of the host's contents. On a host of ``LARGE`` pages, so is what nearly
all of them hold, however long. Elements that are
never part of an article (menus, footers, adverts, forms, scripts, comments and the like, known by
tag, role or class) go as well. If the page marks its article, only that counts. A class name tells
by its first or last word, unless it negates it or names a state (``no-sidebar``, ``comments-open``).
Headings and headers inside an article stay whatever their class, and so do an article and the
elements around it if it has more text than the rest of the page.

Character references are decoded, white space inside a block becomes one space, and blocks are
joined in page order by a line feed. A null or empty page, and one without an article's text, has
the empty text. Pages without a host are compared with no others. Equal pages count once in the
host's statistics; every row gets its result. A page meets the templates that it holds, not all of
its host's. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, two_hashes
from oreflow.session import materialise

# A subtree is template beside so many distinct contents of the host if it is long, or beside such a part of them.
LEAST_PAGES, LEAST_SHARE = 5, 0.5
# Words of a long subtree; below LEAST_WORDS only the share counts.
WORDS, LEAST_WORDS = 8, 3
# On hosts of so many pages, what such a part of them holds is template.
LARGE, NEARLY_ALL = 50, 0.9

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body td th tr tbody thead tfoot li dd dt legend summary title".split())
# A start tag ends an open element of these kinds, up to the nearest container.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("ul ol dl table article section div main body html aside nav footer header form select tbody thead tfoot".split())
# Never part of an article.
NEVER = frozenset(
    "head script style noscript template title nav aside footer form button select textarea input label iframe svg canvas object embed "
    "audio video map menu dialog".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus replies respond "
    "share sharing social related recommended newsletter subscribe subscription popup modal overlay widget pagination pager login signup search "
    "toolbar skip".split()
)
# A class name with one of these words does not say what the element is.
NO_MARK = frozenset("no not non without with has have open opened closed on off enabled disabled".split())
NOT_BY_MARK = frozenset("html body main h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")


# How an element is ruled out: not, by the names of its classes, or by its tag, role or style.
KEPT, MARKED, RULED_OUT = 0, 1, 2


class Node:
    """An element: its tag, how it is ruled out, whether it is inside an article, and its texts and elements in order."""

    __slots__ = ("tag", "never", "inside", "parts", "digest")

    def __init__(self, tag: str, never: int, inside: bool = False):
        self.tag, self.never, self.inside, self.parts, self.digest = tag, never, inside, [], 0


def _never(tag: str, attributes: str, inside: bool) -> int:
    if tag in NEVER:
        return RULED_OUT
    if not attributes or attributes.isspace():
        return KEPT
    values = {name.lower(): html.unescape(a or b or c).lower() for name, a, b, c in ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
        return RULED_OUT
    if tag in NOT_BY_MARK:
        return KEPT
    if values.get("role") in ROLES:
        return RULED_OUT
    if tag == "header" and inside:
        return KEPT
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = re.findall(r"[a-z]+", name)
        # Classes of an article also name its subjects (category-social), so only a whole name counts.
        if tag == "article" and len(words) > 1 or not NO_MARK.isdisjoint(words):
            continue
        if any(word in MARKS and not (inside and word == "header") for word in (words[:1] + words[-1:])):
            return MARKED
    return KEPT


def parse(page: str) -> Node:
    """The page's elements below one root; elements that are not closed end with their parent."""
    root = Node("#root", False)
    stack, at = [root], 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(html.unescape(raw))

    while match := TOKEN.search(page, at):
        text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                # An inline end tag does not end a block.
                if stack[depth].tag in CONTAINERS and tag not in CONTAINERS and tag not in BLOCKS:
                    break
            continue
        if tag in CLOSES_P:
            _end(stack, {"p"})
        if tag in SIBLINGS:
            _end(stack, SIBLINGS[tag])
        attributes = match[3]
        inside = stack[-1].inside or stack[-1].tag == "article"
        node = Node(tag, _never(tag, attributes, inside), inside)
        stack[-1].parts.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            raw = page[at : end.start()] if end else page[at:]
            if tag in ("title", "textarea"):
                raw = html.unescape(raw)
            node.parts.append(raw)
            at = end.end() if end else len(page)
        elif not attributes.rstrip().endswith("/") or tag in BLOCKS:
            stack.append(node)
    text(page[at:])
    _clear_paths(root)
    return root


def _length(node: Node) -> int:
    """Characters of text in the node, without what is ruled out below it."""
    total, open_ = 0, list(node.parts)
    while open_:
        part = open_.pop()
        if isinstance(part, str):
            total += len(part.strip())
        elif not part.never:
            open_ += part.parts
    return total


def _clear_paths(root: Node) -> None:
    """Takes the marks off an article, and off what lies on the path to it, if it has more text than the unmarked rest."""
    for wanted in ("article", "main"):
        scopes, open_ = [], [(root, ())]
        while open_:
            node, marked = open_.pop()
            if node.never == RULED_OUT:
                continue
            if node.never:
                marked = (node, marked)
            if node.tag == wanted:
                if marked:
                    scopes.append((node, marked))
            else:
                open_ += [(part, marked) for part in node.parts if isinstance(part, Node)]
        if scopes:
            rest = _length(root)
            for node, marked in scopes:
                if _length(node) > rest:
                    while marked:
                        marked[0].never, marked = KEPT, marked[1]


def _end(stack: list[Node], tags: set[str]) -> None:
    """Ends the nearest open element of ``tags``, unless a container lies between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in CONTAINERS:
            return


def hash_subtrees(root: Node) -> list[Node]:
    """All elements below the root, children first, each with the hash of its tag, texts and elements."""
    order, open_ = [], [root]
    while open_:
        node = open_.pop()
        order.append(node)
        open_ += [part for part in node.parts if isinstance(part, Node)]
    order.reverse()
    for node in order:
        state = hashlib.blake2b(node.tag.encode(), digest_size=8)
        for part in node.parts:
            if isinstance(part, Node):
                state.update(b"\x01" + part.digest.to_bytes(8, "little", signed=True))
            else:
                state.update(b"\x00" + SPACE.sub(" ", part).strip().encode("utf-8", "replace"))
        node.digest = int.from_bytes(state.digest(), "little", signed=True)
    return order


def _scopes(root: Node, wanted: str, template: frozenset[int] | set[int]) -> list[Node]:
    """The outermost elements with the wanted tag that are not ruled out, in page order."""
    found, open_ = [], [root]
    while open_:
        node = open_.pop()
        if node is not root and (node.never or node.digest in template):
            continue
        if node.tag == wanted:
            found.append(node)
        else:
            open_ += [part for part in reversed(node.parts) if isinstance(part, Node)]
    return found


def _hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def contents(root: Node) -> tuple[int, list[tuple[int, int, int | None]]]:
    """The hash of the page's text, and its subtrees: hash, number of words up to ``WORDS`` (0 in a marked article), and the content it stands beside.

    That is the hash of the longest block outside the subtree, or null if the subtree is more than twice as long.
    """
    blocks: list[tuple[int, int]] = []
    spans: list[tuple[int, int, int, int, int]] = []
    for wanted in ("article", "main", "#root"):
        for scope in _scopes(root, wanted, frozenset()):
            _span(scope, wanted == "article", blocks, spans)
        if blocks:
            break
    in_article = wanted == "article"
    # The longest blocks before and from each place on.
    before, after = [(0, 0)], [(0, 0)]
    for block in blocks:
        before.append(max(before[-1], block))
    for block in reversed(blocks):
        after.append(max(after[-1], block))
    after.reverse()
    found = {}
    for digest, begin, end, size, n_words in spans:
        if begin == end and begin < len(blocks):  # a part of one block, whose rest is outside
            rest = (blocks[begin][0] - size, blocks[begin][1])
            length, beside = max(before[begin], after[begin + 1], rest)
        else:
            length, beside = max(before[begin], after[end])
        # Of a subtree that the page holds twice, one is beside the other; the last one decides.
        found[digest] = (0 if in_article else min(n_words, WORDS), beside if length and 2 * length >= size else None)
    whole = _hash(b"".join(digest.to_bytes(8, "little", signed=True) for _, digest in blocks))
    return whole, [(digest, *found[digest]) for digest in sorted(found)]


def _span(scope: Node, in_article: bool, blocks: list, spans: list) -> None:
    """Adds the scope's blocks (length, hash) and its subtrees with text (hash, first block, end, characters, words)."""
    pieces: list[str] = []
    size = n_words = 0

    def close() -> None:
        if block := SPACE.sub(" ", "".join(pieces)).strip(" "):
            blocks.append((len(block), _hash(block.encode("utf-8", "replace"))))
        pieces.clear()

    open_: list = [scope]
    while open_:
        part = open_.pop()
        if isinstance(part, str):
            pieces.append(part)
            words = part.split()
            n_words += len(words)
            size += len(words) + sum(map(len, words))
        elif isinstance(part, tuple):
            node, begin, size_before, words_before = part
            if node.tag in BLOCKS:
                close()
            if node.tag != "#root" and n_words > words_before:
                spans.append((node.digest, begin, len(blocks), size - size_before, n_words - words_before))
        else:
            if part.tag in BLOCKS:
                close()
            if part is not scope and (part.never or part.tag == "header" and not in_article):
                continue
            if part.tag == "br":
                pieces.append(" ")
            open_.append((part, len(blocks), size, n_words))
            open_ += reversed(part.parts)
    close()


def main_text(root: Node, template: frozenset[int] | set[int]) -> str:
    """Blocks of the article's text, without template subtrees, joined by line feeds."""

    def gone(node: Node) -> bool:
        return node.never or node.digest in template

    blocks: list[str] = []

    def collect(scope: Node, in_article: bool) -> None:
        words: list[str] = []

        def close() -> None:
            if block := SPACE.sub(" ", "".join(words)).strip(" "):
                blocks.append(block)
            words.clear()

        open_: list[Node | str | None] = [scope]
        while open_:
            part = open_.pop()
            if part is None:
                close()
            elif isinstance(part, str):
                words.append(part)
            elif part is not scope and (gone(part) or part.tag == "header" and not in_article):
                if part.tag in BLOCKS:
                    close()
            else:
                if part.tag == "br":
                    words.append(" ")
                if part.tag in BLOCKS:
                    close()
                    open_.append(None)
                open_ += reversed(part.parts)
        close()

    for wanted in ("article", "main", "#root"):
        for scope in _scopes(root, wanted, template):
            collect(scope, wanted == "article")
        if blocks:
            break
    return "\n".join(blocks)


def host(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.when(found != "", found)


SUBTREES = "host string, h1 long, h2 long, content long, subtrees array<struct<subtree:long,words:int,beside:long>>"
SUBTREE = pa.list_(pa.struct([("subtree", pa.int64()), ("words", pa.int32()), ("beside", pa.int64())]))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the hash of its text, and the distinct subtrees that hold text."""
    for batch in batches:
        wholes, lists = [], []
        for page in batch.column("html"):
            root = parse(page.as_py())
            hash_subtrees(root)
            whole, found = contents(root)
            wholes.append(whole)
            lists.append([{"subtree": digest, "words": words, "beside": beside} for digest, words, beside in found])
        columns = [batch.column(name) for name in ("host", "h1", "h2")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(wholes, pa.int64()), pa.array(lists, SUBTREE)], ["host", "h1", "h2", "content", "subtrees"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, known = [], {}
        for page, template in zip(batch.column("html"), batch.column("template"), strict=True):
            key = template.as_py() if template.is_valid else ()
            marks = known.setdefault(tuple(key), frozenset(key))
            root = parse(page.as_py())
            hash_subtrees(root)
            texts.append(main_text(root, marks))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _with_keys(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, host, h1, h2): every row, with two hashes of its page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    h1, h2 = two_hashes(F.col("html"))
    return rows.select("*", h1.alias("h1"), h2.alias("h2"))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """(host, h1, h2, content, subtrees) of the distinct pages of each host."""
    rows = _with_keys(pages).where("host IS NOT NULL").select("host", "h1", "h2", "html")
    return materialise(rows.mapInArrow(_subtrees, SUBTREES).dropDuplicates(["host", "h1", "h2"]), "subtrees")


def site_templates(subtrees: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, subtree): the hashes of each host's template subtrees."""
    sizes = subtrees.groupBy("host", "content").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("contents"), F.sum("n").alias("pages"))
    # By content first, so that neither a host nor a subtree is counted in one task.
    beside = subtrees.select("host", F.explode("subtrees").alias("s")).groupBy("host", "s.subtree", "s.beside").agg(F.max("s.words").alias("words"), F.count("*").alias("n"))
    counts = beside.groupBy("host", "subtree").agg(F.max("words").alias("words"), F.count("beside").alias("n"), F.sum("n").alias("on_pages"))
    # Both sides are stored, so that a join that needs a shuffle can split a large host.
    frequent = materialise(counts.where(F.col("on_pages") >= least_pages), "subtree-counts")
    by_number = (F.col("words") >= LEAST_WORDS) & (F.col("n") >= least_pages * F.pow(F.lit(4.0), WORDS - F.col("words")))
    by_share = F.col("n") >= least_share * F.col("contents")
    everywhere = (F.col("pages") >= LARGE) & (F.col("on_pages") >= NEARLY_ALL * F.col("pages"))
    recurring = frequent.join(materialise(sizes, "host-sizes"), "host").where((F.col("n") >= least_pages) & (by_number | by_share) | everywhere)
    return materialise(recurring.select("host", "subtree"), "templates")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(page_id, url, text): the main text of every row."""
    bounded_batches(pages.sparkSession)
    subtrees = page_subtrees(pages)
    held = subtrees.select("host", "h1", "h2", F.explode("subtrees.subtree").alias("subtree")).join(site_templates(subtrees, least_pages, least_share), ["host", "subtree"], "left_semi")
    marks = materialise(held.groupBy("host", "h1", "h2").agg(F.sort_array(F.collect_list("subtree")).alias("template")), "page-templates")
    joined = _with_keys(pages).join(marks, ["host", "h1", "h2"], "left").select("page_id", "url", "html", "template")
    return joined.mapInArrow(_texts, "page_id long, url string, text string")


def digest(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
