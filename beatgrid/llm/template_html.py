"""Main text of web pages, with the templates of each site removed.

Every element's subtree (its tag, classes, text and children) is hashed on each page;
Spark counts, per host, the distinct pages that hold a subtree. Subtrees on at least
``LEAST_PAGES`` pages of their host, however large it is, are its template (menus,
notices, footers) and are deleted wherever they stand. Elements that HTML itself names as no article text (``nav``,
``footer``, ``script`` and the like, or such classes and roles) go on any page, also
where a host has too few pages to count. Inside an ``article`` or ``main`` element,
paragraphs, headings, list items and the like stay even if they recur, since passages
that several articles quote are text of each of them.

What is left of ``main`` is the text, if it holds all articles that stay; without it, or
with an article beside it, what is left of the whole page.

Defined cases: an absent or empty page has an empty text; pages with an absent or
unreadable address have no host, so only the rules by name apply to them; equal pages
of a host count once; unclosed, stray and wrongly nested tags are closed as browsers
do for blocks; a quote that is never closed ends with its tag; nesting may be of any depth; an empty table gives no rows; other
columns, whatever their names, stay in ``row``.
"""

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

LEAST_PAGES = 5

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title xmp noembed noframes template".split())
DRAWING = frozenset(["svg", "math"])
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre table tr td th tbody thead dl dt dd ul ol figure figcaption".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
FENCE = frozenset("ul ol dl table article section main div body html td th blockquote nav aside form header footer".split())
# What is not the article, by tag, role, and words of class and id.
NOT_TEXT = frozenset(
    "head nav footer aside form button select datalist option label input canvas object embed audio video dialog menu map".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs masthead footer sidebar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup share sharing social comment comments commentlist disqus respond reply replies related recommended "
    "recommendations pagination pager paging widget widgets toolbar skip search login banner topbar".split())
MAIN_SAFE_WORDS = frozenset(["header", "notice", "banner", "menu", "search", "reply", "related", "promotion", "subscription"])

# A quote opens a value after an equals sign alone, and closes it only where the tag can go on; else the tag ends at the next bracket.
TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^=>]++|=\s*(?:"[^"]*"|'[^']*')(?=[\s/>]|[\w:.\-]+\s*=|\Z)|=)*+)>?|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "attributes", "parent", "parts")

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Node | None"):
        self.tag, self.attributes, self.parent, self.parts = tag, attributes, parent, []


def attributes_of(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")).lower() for m in ATTRIBUTE.finditer(text)}


def self_closed(attributes: str | None) -> bool:
    """Whether a tag ends in a slash that is no part of a value without quotes."""
    return bool(attributes) and attributes.endswith("/") and (len(attributes) == 1 or attributes[-2] in " \t\r\n\f\"'" or "=" not in attributes.split()[-1])


def after_drawing(page: str, tag: str, at: int) -> int:
    """Where a drawing that opened before ``at`` ends, nested ones included; ``at`` itself if it is never closed."""
    depth = 1
    for m in re.compile(rf"<(/?){tag}\b([^>]*)>", re.I).finditer(page, at):
        depth += -1 if m[1] else 0 if self_closed(m[2]) else 1
        if not depth:
            return m.end()
    return at


def parse(page: str) -> list[Node]:
    """All elements in page order; the first one is the root. Text is in ``parts`` beside the elements."""
    root = Node("html", {}, None)
    nodes, here, at, end = [root], root, 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                text = m[0]
                here.parts.append(html.unescape(text) if "&" in text else text)
            continue
        tag = tag.lower()
        if m[1]:
            there = here
            while there is not None and there.tag != tag:
                there = there.parent if there.tag not in ("table", "body") or tag in ("html", "body") else None
            if there is not None and there.parent is not None:
                here = there.parent
            continue
        if tag == "html":
            continue
        if tag in DRAWING:
            at = at if self_closed(m[3]) else after_drawing(page, tag, at)
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag == "body" and here.tag == "head":
            here = here.parent
        closing = CLOSED_BY.get(tag, ())
        there = here
        if tag in BLOCK:
            while there.parent is not None and there.tag != "p" and there.tag not in FENCE:
                there = there.parent
            if there.tag == "p":
                here = there.parent
        if closing:
            there = here
            while there.parent is not None and there.tag not in closing and (there.tag not in FENCE or there.tag in closing):
                there = there.parent
            if there.tag in closing:
                here = there.parent
                if tag == "tr" and here.tag == "tr":
                    here = here.parent
        node = Node(tag, attributes_of(m[3]), here)
        here.parts.append(node)
        nodes.append(node)
        if tag not in VOID and not self_closed(m[3]):
            here = node
    return nodes


def is_furniture(node: Node, in_main: bool, holds_main: bool = False, by_words: bool = True) -> bool:
    """Whether tag, role or class say that the element is no article text.

    An element around a main part that stays is judged by its tag and by whether it is
    hidden, not by role, class or id, nor as a form or label.
    """
    tag, a = node.tag, node.attributes
    if tag in ("html", "body", "main", "article"):
        return tag == "article" and bool({"comment", "comments", "teaser", "related"} & set(WORD.findall(a.get("class", ""))))
    if tag in NOT_TEXT and not (holds_main and tag in ("form", "label")) or tag == "header" and not in_main:
        return True
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    if holds_main:
        return False
    if a.get("role") in NOT_TEXT_ROLES:
        return True
    if not by_words:
        return False
    words = set(WORD.findall(a.get("class", "") + " " + a.get("id", "")))
    unwanted = words & NOT_TEXT_WORDS
    if not in_main:
        return bool(unwanted) or "header" in words
    return bool(unwanted - MAIN_SAFE_WORDS) or bool(unwanted) and tag not in PROSE


def in_main_flags(nodes: list[Node]) -> dict[int, bool]:
    flags: dict[int, bool] = {}
    for node in nodes:
        parent = flags[id(node.parent)] if node.parent is not None else False
        flags[id(node)] = parent or node.tag in ("main", "article") or node.attributes.get("role") == "main"
    return flags


def furniture(nodes: list[Node], in_main: dict[int, bool], by_words: bool = True) -> set[int]:
    """The elements that go by name; children are judged before their parents. Words of class and id may be left out."""
    gone: set[int] = set()
    holds: set[int] = set()
    for node in reversed(nodes):
        is_main = id(node) in holds or node.tag in ("main", "article") or node.attributes.get("role") == "main"
        if is_furniture(node, in_main[id(node)], is_main, by_words):
            gone.add(id(node))
        elif is_main and node.parent is not None:
            holds.add(id(node.parent))
    return gone


def subtree_hashes(nodes: list[Node]) -> dict[int, int]:
    """A signed 64-bit hash of each element that has text, by ``id``; children come after their parent in ``nodes``."""
    hashes: dict[int, int] = {}
    for node in reversed(nodes):
        parts, empty = [], True
        for part in node.parts:
            if isinstance(part, str):
                text = " ".join(part.split())
                if text:
                    parts.append(text)
                    empty = False
            elif (h := hashes.get(id(part))) is not None:
                parts.append(f"<{h}>")
                empty = False
        if not empty:
            whole = f"{node.tag}.{node.attributes.get('class', '')}\0" + "\0".join(parts)
            hashes[id(node)] = xxhash.xxh64_intdigest(whole.encode("utf-8", "replace")) - (1 << 63)
    return hashes


def deletable(nodes: list[Node], in_main: dict[int, bool]) -> list[Node]:
    """Block elements that may be template: not the page, not its main part, and no prose inside that."""
    holds_main: set[int] = set()
    for node in reversed(nodes):
        if node.tag in ("html", "body", "main", "article") or id(node) in holds_main:
            holds_main.add(id(node))
            if node.parent is not None and node.tag in ("main", "article"):
                holds_main.add(id(node.parent))
    for node in reversed(nodes):
        if id(node) in holds_main and node.parent is not None:
            holds_main.add(id(node.parent))
    return [n for n in nodes if n.tag in BLOCK and id(n) not in holds_main and not (in_main[id(n)] and n.tag in PROSE)]


def below(nodes: list[Node], gone: set[int]) -> set[int]:
    """The elements of ``gone`` and all below them."""
    lost: set[int] = set()
    for node in nodes:
        if id(node) in gone or node.parent is not None and id(node.parent) in lost:
            lost.add(id(node))
    return lost


def page_hashes(page: str) -> tuple[list[int], list[int]]:
    """Distinct hashes of the subtrees that may be template, and those of them that the rules by name leave."""
    nodes = parse(page)
    hashes, in_main = subtree_hashes(nodes), in_main_flags(nodes)
    lost = below(nodes, furniture(nodes, in_main))
    may = [n for n in deletable(nodes, in_main) if id(n) in hashes]
    return sorted({hashes[id(n)] for n in may}), sorted({hashes[id(n)] for n in may if id(n) not in lost})


def main_text(page: str, template: frozenset[int] | set[int]) -> str:
    """The text that is left, one line per block.

    Words of class and id are hints: where they leave a page without any text, they do not apply to it.
    """
    nodes = parse(page)
    in_main = in_main_flags(nodes)
    recurring = set()
    if template:
        hashes = subtree_hashes(nodes)
        recurring = {id(n) for n in deletable(nodes, in_main) if hashes.get(id(n)) in template}
    for by_words in (True, False):
        found = kept_blocks(nodes, below(nodes, furniture(nodes, in_main, by_words) | recurring))
        if found:
            break
    return "\n".join(found)


def kept_blocks(nodes: list[Node], lost: set[int]) -> list[str]:
    articles, mains = ([n for n in nodes if n.tag == tag and id(n) not in lost] for tag in ("article", "main"))
    roots = [n for n in mains if not any(p.tag == "main" for p in ancestors(n))]
    inside = all(any(p.tag == "main" for p in ancestors(n)) for n in articles)
    if not inside or not any(blocks(root, lost) for root in roots):
        roots = [nodes[0]]
    return [block for root in roots for block in blocks(root, lost)]


def ancestors(node: Node):
    while (node := node.parent) is not None:
        yield node


def blocks(root: Node, lost: set[int]) -> list[str]:
    """Texts of the blocks below an element, in page order."""
    found, open_text, stack = [], [], [(root, 0)]

    def close() -> None:
        text = " ".join("".join(open_text).split())
        if text:
            found.append(text)
        open_text.clear()

    while stack:
        node, at = stack.pop()
        if not at and node.tag in BLOCK:
            close()
        for i in range(at, len(node.parts)):
            part = node.parts[i]
            if isinstance(part, str):
                open_text.append(part)
            elif id(part) not in lost:
                stack.append((node, i + 1))
                stack.append((part, 0))
                break
        else:
            if node.tag in BLOCK:
                close()
            elif node.tag in ("br", "td", "th", "img"):
                open_text.append(" ")
    close()
    return found


def host_of(url: Column) -> Column:
    """The lower-case host of an address; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_digest(page: str) -> Column:
    return F.unhex(F.md5(page))


def site_templates(pages: DataFrame, page: str = "html", url: str = "url", least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(host, digest, template)``: for each page its subtrees that recur on the host's pages.

    Hashes meet the recurring ones as rows, so a list is never longer than its page. All
    subtrees are counted; a page lists only those that the rules by name leave on it, so
    that pages without any need no row.
    """
    known = (pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("html"))
             .filter(F.col("host").isNotNull() & F.col("html").isNotNull())
             .select("host", page_digest("html").alias("digest"), "html"))

    def work(batches):
        for batch in batches:
            hashes = [page_hashes(x) for x in batch.column(2).to_pylist()]
            lists = [pa.array([h[k] for h in hashes], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["host", "digest", "hashes", "left"])

    seen = materialise(map_batches(known, work, "host string, digest binary, hashes array<long>, left array<long>").dropDuplicates(["host", "digest"]), "subtrees")
    rows = seen.select("host", "digest", F.explode("left").alias("hash"))
    recurring = seen.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages).drop("n")
    return rows.join(recurring, ["host", "hash"], "left_semi").groupBy("host", "digest").agg(F.collect_list("hash").alias("template"))


def extract(pages: DataFrame, page: str = "html", url: str = "url", **options) -> DataFrame:
    """All columns but the page packed in ``row``, with its main ``text``."""
    templates = materialise(site_templates(pages, page, url, **options), "templates")
    rest = [c for c in pages.columns if c != page]
    packed = pages.select(host_of(F.col(url)).alias("host"), page_digest(page).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
                          F.col(page).alias("html"))
    joined = packed.join(templates, ["host", "digest"], "left").select("row", "html", "template")

    def work(batches):
        for batch in batches:
            texts = [main_text(p, frozenset(t or ())) if p else "" for p, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return map_batches(joined, work, f"row {packed.schema['row'].dataType.simpleString()}, text string")


def op3_site_text(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    return extract(pages.select("page_id", "url", "html")).select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
