"""Main text of web pages; what a site repeats over its pages is found by Spark and removed.

1. Each page is parsed to its outline: its text in page order and where the
   elements begin and end that may prove to be template, with a hash of each one's
   subtree.  What the page would read with all of them is its content.  Only hashes
   are kept; a page is parsed again when its text is made.
2. Spark counts, per host and subtree, the different contents among the pages that
   hold it; copies of a page count once.  A subtree is template
   * on MIN_PAGES contents: boxes, lists and tables outside the prose of an article;
   * on MIN_PAGES and a share of MIN_SHARE of the host's contents: paragraphs, cells
     and inline elements of pages without an article or main element;
   * on MIN_PAGES and more than PROSE_SHARE of the host's contents: paragraphs,
     lists and tables of an article, so that a sentence that half the articles
     have stays, and a notice that nearly all have goes.
3. Template subtrees are left out of the outlines, as are elements whose tag, role,
   class or id names them as menus, notices, adverts, comments, ...; inside an
   article such a class or id must be the word itself ("notice", not "notice-text").

A page meets its own subtrees' counts by (host, subtree); no list of a host's
templates is held anywhere.  A subtree with more than one in PIECES of all pages
is cut into pieces of about that size before it is joined; a page adds at most
its own subtrees to the PIECES shares, which bounds the list of such subtrees.

Text: blocks in page order, white space inside a block is one space, empty
blocks are left out, one line feed between blocks.  A <br> is white space.

Defined results: a NULL or empty page has the empty text; pages with a NULL url,
or one without a host, belong to no site and lose no subtrees as template;
equal rows give equal results and count as one page; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table

MIN_PAGES = 3
MIN_SHARE = 0.3
PROSE_SHARE = 0.5
PIECES = 1000

# Names of elements, roles and class or id words.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
DROPPED = RAW | set("head nav footer aside form button select option datalist dialog menu svg math canvas object audio video map label input".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption article main".split())
WHOLE = set("p ul ol dl table blockquote pre figure".split())  # prose that is judged as a whole in an article
LAYOUT = (BLOCKS - PROSE) | set("ul ol dl table".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar "
    "footer sidebar aside widget widgets masthead topbar "
    "cookie cookies consent gdpr notice notices popup modal overlay alert "
    "newsletter subscribe subscription signup login share sharing social "
    "comment comments disqus reply replies respond related recommended recommendations outbrain taboola skip".split()
)
DROPPED_OUTSIDE = set("header".split())  # outside an article only: its own may hold its title

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "drop", "parts", "inside", "above")

    def __init__(self, tag: str, drop: bool = False, above: Node | None = None):
        self.tag, self.drop, self.parts, self.above = tag, drop, [], above
        # whether it is, or stands in, an article or main element
        self.inside = tag in ("article", "main") or (above is not None and above.inside)


def _named_out(tag: str, attributes: str, inside: bool) -> bool:
    """Whether the element's attributes name it as something that is not the main text.

    Inside an article a class or id must be such a word; elsewhere it may hold one.
    """
    if tag in ("html", "body", "main", "article") and "comment" not in attributes.lower():
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id"):
            words = value.lower().split() if inside else _WORDS.findall(_CAMEL.sub(r"\1 \2", value).lower())
            if not DROPPED_WORDS.isdisjoint(words):
                return True
    return False


# Which open elements a start tag ends, and where the search for them stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


def _close(stack: list[Node], names: set[str], stops: set[str]) -> None:
    for n in range(len(stack) - 1, 0, -1):
        if stack[n].tag in names:
            del stack[n:]
            return
        if stack[n].tag in stops:
            return


def parse(html: str) -> Node:
    """The page as a tree; text is kept as written."""
    root = Node("#root")
    stack = [root]
    at = 0
    while True:
        found = _TAG.search(html, at)
        begin = found.start() if found else len(html)
        if begin > at:
            stack[-1].parts.append(html[at:begin])
        if not found:
            return root
        at = found.end()
        name = found[2]
        if not name:
            continue
        tag = name.lower()
        if found[1]:
            if tag in BLOCKS:
                _close(stack, {tag}, set())
            else:
                _close(stack, {tag}, BLOCKS)
            continue
        if tag in BLOCKS:
            _close(stack, {"p"}, {"td", "th", "table", "button", "object", "caption"} | (BLOCKS - {"p"}))
        if tag in _ENDS:
            _close(stack, *_ENDS[tag])
        inside = stack[-1].inside
        dropped = tag in DROPPED and not (inside and tag == "label")
        node = Node(tag, dropped or (bool(found[3]) and _named_out(tag, found[3], inside)), stack[-1])
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and not found[3].endswith("/"):
            stack.append(node)


def plain(text: str) -> str:
    return unescape(text) if "&" in text else text


def _region(root: Node) -> list[Node]:
    """Articles that stand in no dropped element and no other article; else the main element; else the page."""
    articles, mains, todo = [], [], [root]
    while todo:
        node = todo.pop()
        if node.drop:
            continue
        if node.tag == "article":
            articles.append(node)
            continue
        if node.tag == "main":
            mains.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return articles or mains or [root]


def _is_site_header(node: Node) -> bool:
    """A header, unless it opens a box that has paragraphs of its own."""
    above = node.above
    if above is None or above.tag in ("#root", "html", "body"):
        return True
    return not any(isinstance(p, Node) and p.tag == "p" for p in above.parts)


def subtree_hashes(root: Node) -> dict[int, int]:
    """Hash of every element with text, by identity: its tag and, in order, the words and subtrees in it."""
    out: dict[int, int] = {}
    texts: dict[int, bytes] = {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, ready = todo.pop()
        if not ready:
            todo.append((node, True))
            todo += [(p, False) for p in node.parts if isinstance(p, Node)]
            continue
        parts = [texts.get(id(p), b"") if isinstance(p, Node) else " ".join(plain(p).split()).encode("utf-8", "surrogatepass") for p in node.parts]
        body = b"\x1f".join(p for p in parts if p)
        if body:
            digest = blake2b(node.tag.encode() + b"\x1e" + body, digest_size=8).digest()
            texts[id(node)] = digest
            out[id(node)] = int.from_bytes(digest, "little", signed=True)
    return out


def _kinds(root: Node) -> dict[int, int]:
    """Of the elements that can be template: 0 boxes, 1 prose of a page without article or main, 2 prose of an article.

    The main region itself, all that holds it, and parts of its prose are none.
    """
    region = {id(n) for n in _region(root)} - {id(root)}
    out, above = {}, {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or id(node) in region
        if inside and not node.drop and (node.tag in PROSE or node.tag not in BLOCKS):
            if node.tag in WHOLE:
                out[id(node)] = 2
        elif node is not root and node.tag not in ("html", "body"):
            out[id(node)] = 0 if region or node.tag in LAYOUT else 1
        for p in node.parts:
            if isinstance(p, Node):
                above[id(p)] = id(node)
                todo.append((p, inside))
    holders: set[int] = set()
    for n in region:
        out.pop(n, None)
        while n in above and above[n] not in holders:
            n = above[n]
            holders.add(n)
            out.pop(n, None)
    return out


def outline(html: str) -> tuple[set[int], list[int], list[str]]:
    """Hashes of all subtrees that can be template, those in the text's way, and the text.

    The text is a list: "t" and a run of text, "f" the end of a block, "<", a kind and
    the place of a hash where such a subtree begins, ">" where it ends.
    """
    root = parse(html)
    hashes, kinds = subtree_hashes(root), _kinds(root)
    region = _region(root)
    in_article = region[0].tag in ("article", "main")
    own: list[int] = []
    out: list[str] = []

    def end_block() -> None:
        if not out or out[-1] != "f":
            out.append("f")

    def add_text(text: str) -> None:
        """White space is one space here already, and none where a block begins."""
        words = " ".join(text.split())
        if words:
            out.append(f"t{' ' * text[0].isspace()}{words}{' ' * text[-1].isspace()}")
        elif text and out and out[-1] != "f":
            out.append("t ")

    todo: list = list(reversed(region))
    while todo:
        node = todo.pop()
        if node is None:
            end_block()
        elif node is Node:
            out.append(">")
        elif isinstance(node, str):
            add_text(plain(node))
        elif node.tag == "br":
            add_text(" ")
        elif node.drop or (not in_article and node.tag in DROPPED_OUTSIDE and _is_site_header(node)):
            if node.tag in BLOCKS:
                end_block()
        else:
            if id(node) in kinds and id(node) in hashes:
                out.append(f"<{kinds[id(node)]}{len(own)}")
                own.append(hashes[id(node)])
                todo.append(Node)
            if node.tag in BLOCKS:
                end_block()
                todo.append(None)
            todo += reversed(node.parts)
    return {hashes[n] for n in kinds if n in hashes}, own, out


def rendered(own: list[int], pieces: list[str], levels: dict[int, int]) -> str:
    """The text without the subtrees whose level reaches their kind."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    depth = 0  # of open elements inside a left-out one, and that one
    for piece in pieces:
        if piece[0] == "<":
            if depth:
                depth += 1
            elif levels and levels.get(own[int(piece[2:])], -1) >= int(piece[1]):
                flush()
                depth = 1
            else:
                continue
        elif piece[0] == ">":
            depth -= depth > 0
        elif depth:
            continue
        elif piece[0] == "f":
            flush()
        else:
            run.append(piece[1:])
    flush()
    return "\n".join(blocks)


def template_candidates(html: str) -> set[int]:
    return outline(html)[0]


def main_text(html: str, templates: frozenset[int] = frozenset()) -> str:
    _, own, pieces = outline(html)
    return rendered(own, pieces, dict.fromkeys(templates, 2))


# ---------------------------------------------------------------- Spark


OUTLINE = "host string, page bigint, content bigint, subtrees array<bigint>, own array<bigint>"


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contents, subtrees, owns = [], [], []
        for html in batch.column(2).to_pylist():
            found, own, pieces = outline(html or "")
            content = rendered(own, pieces, {}).encode("utf-8", "surrogatepass")
            contents.append(int.from_bytes(blake2b(content, digest_size=8).digest(), "little", signed=True))
            subtrees.append(sorted(found))
            owns.append(sorted(set(own)))
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(contents, pa.int64()), pa.array(subtrees, lists), pa.array(owns, lists)], names=["host", "page", "content", "subtrees", "own"]
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, marks in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            _, own, pieces = outline(html or "")
            texts.append(rendered(own, pieces, {m["subtree"]: m["level"] for m in marks or ()}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.when(host != "", host).alias("host"), F.col("html").cast("string").alias("html")
    )


def subtree_levels(outlines: DataFrame, total: int) -> DataFrame:
    """(host, subtree, rows, level): template subtrees with the highest kind they are template for, and, without a level, other frequent ones."""
    contents = outlines.groupBy("host", "content").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("contents"))
    each = outlines.select("host", "content", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree", "content").agg(F.count("*").alias("rows"))
    counts = each.groupBy("host", "subtree").agg(F.count("*").alias("n"), F.sum("rows").alias("rows"))
    counts = counts.where((F.col("n") >= MIN_PAGES) | (F.col("rows") * PIECES > total)).join(contents, "host")
    level = F.when(F.col("n") > PROSE_SHARE * F.col("contents"), 2).when(F.col("n") >= MIN_SHARE * F.col("contents"), 1).otherwise(0)
    return counts.select("host", "subtree", "rows", F.when(F.col("n") >= MIN_PAGES, level).alias("level"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    Equal pages of a host have equal subtrees and so the same marks; they meet by
    host and a hash of the page.
    """
    shipped(pages.sparkSession)
    hosted = with_host(pages).withColumn("page", F.xxhash64("html"))
    outlines = stored(hosted.where("host is not null").select("host", "page", "html").mapInArrow(_outlines, OUTLINE), "outlines")
    total = outlines.count()
    levels = stored(subtree_levels(outlines, total), "subtrees")
    number = F.ceil(F.col("rows") * PIECES / F.lit(max(1, total)))
    frequent = levels.where(F.col("rows") * PIECES > total).select("host", "subtree", number.alias("pieces"))
    held = outlines.select("host", "page", F.explode("own").alias("subtree")).distinct()
    held = held.join(frequent, ["host", "subtree"], "left").withColumn("piece", F.pmod(F.xxhash64("page"), F.coalesce("pieces", F.lit(1).cast("long")))).drop("pieces")
    listed = levels.where("level is not null").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(number, F.lit(1)) - 1)))
    marks = held.join(listed.select("host", "subtree", "piece", "level"), ["host", "subtree", "piece"])
    marks = marks.groupBy("host", "page").agg(F.collect_list(F.struct("subtree", "level")).alias("marks"))  # at most a page's own
    rows = hosted.join(marks, ["host", "page"], "left")
    return rows.select("page_id", "url", "html", "marks").mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
