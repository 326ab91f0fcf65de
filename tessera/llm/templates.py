"""Main text of web pages by removal of site templates.

Every page is parsed into an element tree where it is read. Each block element
has a hash of its subtree (tags and text). Spark counts on how many pages of a
host each hash occurs, pages with equal bodies once; a subtree that recurs on
many pages of its host is the site's template and is deleted there: ``ENOUGH``
pages are many on every host, on smaller hosts ``PART`` of its pages. Elements
that are no article by their own marks (navigation, footers, forms, adverts,
notices, comments, scripts) are deleted on every page, so that hosts with few
pages are served too. What is left of the articles, with the headlines and leads
beside them in the main element (else of the main element, else of the body), is
the text.

Inside an article only containers count as template, never its paragraphs,
headings and list items: articles that are copies of one another stay whole.

Blocks are the stretches of text between block-level tags: character references
decoded, white space turned into single spaces, joined by two line feeds.

Counting moves one (host, hash) row per task and page kind, summed before the
shuffle. Templates are (host, hash) rows; while few (checked) they are broadcast,
else joined with the pages' own subtrees by host and hash, so that a page meets
only those it has and a large host is no single key.

Defined cases: null, empty or markup-only html gives ''; pages without a host
have no template; unclosed, crossed and unknown tags are tolerated; elements
may be nested to any depth; repeated pages are each returned.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage, table

LEAST_PAGES = 5      # pages (of different bodies) a template recurs on,
PART = 0.05          # and their part of the host's pages,
ENOUGH = 50          # or so many pages on a host of any size
BROADCAST = 500_000  # hashes of templates that are broadcast at most

# a quote opens a value after "=" only, and a value may have any length
_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe svg object canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt figcaption td th tr tbody".split())
# tags that end an open element of these names, up to the nearest scope
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
}
_SCOPE = frozenset("article section div ul ol dl table body main aside nav form header footer blockquote html".split())
_DROP = frozenset(
    "nav aside footer form button select input label dialog menu head applet embed fieldset "
    "annotation annotation-xml".split()
) | _RAW
# beside an article inside the main element these belong to it: headline and lead
_LEAD = frozenset("h1 h2 h3 h4 h5 h6 header hgroup p blockquote pre figure".split())
# words of class, id and role that mark what is no article
_MARKS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer contentinfo complementary ad ads advert "
    "adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "popup modal overlay dialog alert newsletter subscribe subscription signup login share sharing social "
    "related recommended comment comments disqus respond replies pagination pager toolbar search widget".split()
)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "kids", "digest")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids, self.digest = tag, attrs, [], 0

    def close(self) -> None:
        parts = [self.tag]
        for k in self.kids:
            parts.append(f"\1{k.digest}" if isinstance(k, Node) else " ".join(k.split()))
        self.digest = xxhash.xxh3_64_intdigest("\0".join(p for p in parts if p).encode("utf-8", "surrogatepass")) >> 1


def parse(page: str | None) -> Node:
    """Tree of a page; text is decoded, comments are gone."""
    root = Node("#root")
    stack, page, at = [root], page or "", 0
    places: dict[str, list[int]] = {}   # of the open elements, by tag
    scopes = [0]                        # places of those that bound what a tag ends

    def pop() -> None:
        node = stack.pop()
        node.close()
        places[node.tag].pop()
        if node.tag in _SCOPE:
            scopes.pop()

    def close(place: int) -> None:
        while len(stack) > place:
            pop()

    def end(names: tuple[str, ...]) -> None:
        last = max((places[n][-1] for n in names if places.get(n)), default=0)
        if last > scopes[-1]:
            close(last)

    last = page.rfind(">") + 1   # no tag ends beyond it
    while True:
        m = _TAG.search(page, at, last)
        text = page[at : m.start()] if m else page[at:].partition("<!--")[0]
        if text:
            stack[-1].kids.append(entities.unescape(text))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break   # a comment that never ends
            continue
        tag = m[2].lower()
        if m[1]:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in _BLOCK:
            end(("p",))
        if tag in _CLOSES:
            end(_CLOSES[tag])
        node = Node(tag, m[3])
        stack[-1].kids.append(node)
        if tag in _RAW and not m[3].endswith("/"):
            tail = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag in ("title", "textarea"):
                node.kids.append(entities.unescape(page[at : tail.start() if tail else len(page)]))
            at = tail.end() if tail else len(page)
            node.close()
        elif tag in _VOID or m[3].endswith("/"):
            node.close()
        else:
            places.setdefault(tag, []).append(len(stack))
            if tag in _SCOPE:
                scopes.append(len(stack))
            stack.append(node)
    close(1)
    root.close()
    return root


def _marked(node: Node, inside: bool) -> bool:
    """No part of an article by its tag or marks."""
    if node.tag in _DROP or node.tag == "header" and not inside:
        return True
    if not node.attrs or node.tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(node.attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id", "role"):
            words = set(_WORD.findall(value))
            if words & _MARKS and not (node.tag in ("article", "main") and words & {"article", "post", "main"}):
                return True
            if "header" in words and not inside and node.tag != "article":
                return True
    return False


def _roots(node: Node, tags: tuple[str, ...]) -> list[Node]:
    """Outermost elements of these tags, outside what is marked."""
    out, waiting = [], node.kids[::-1]
    while waiting:
        k = waiting.pop()
        if isinstance(k, Node) and not _marked(k, False):
            if k.tag in tags or "main" in tags and _is_main(k):
                out.append(k)
            else:
                waiting += k.kids[::-1]
    return out


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(re.search(r"role\s*=\s*[\"']?main", node.attrs))


def _with_lead(root: Node, articles: list[Node]) -> list[Node]:
    """The articles and, in page order, the headlines and leads beside them or
    beside what holds them, inside the main element."""
    parent, waiting = {}, [root]
    while waiting:
        node = waiting.pop()
        for k in node.kids:
            if isinstance(k, Node):
                parent[id(k)] = node
                waiting.append(k)
    own, above = {id(a) for a in articles}, set()
    for node in articles:
        while id(node) in parent and id(parent[id(node)]) not in above:
            node = parent[id(node)]
            above.add(id(node))
    out, waiting = [], [(root, False)]
    while waiting:
        node, inside = waiting.pop()
        if id(node) in own or inside and node.tag in _LEAD and id(node) not in above and not _marked(node, True):
            out.append(node)
        elif id(node) in above:
            inside = inside or _is_main(node)
            waiting += [(k, inside) for k in node.kids[::-1] if isinstance(k, Node)]
    return out


def _main(root: Node) -> tuple[list[Node], bool]:
    found = _roots(root, ("article",))
    if found:
        return _with_lead(root, found), True
    found = _roots(root, ("main",))
    return (found, True) if found else ([root], False)


def subtrees(root: Node) -> set[int]:
    """Hashes of the subtrees that can be templates."""
    inside = {id(n) for n in _main(root)[0] if n is not root}
    out: set[int] = set()

    waiting = [(root, False)]
    while waiting:
        node, within = waiting.pop()
        for k in node.kids:
            if isinstance(k, Node):
                if k.tag in _BLOCK and k.tag not in ("html", "body", "article", "main") and not (
                        within and k.tag in _PROSE):
                    out.add(k.digest)
                waiting.append((k, within or id(k) in inside))
    return out


def main_text(root: Node, templates: frozenset[int] = frozenset()) -> str:
    """The text of a page, without marked elements and templates."""
    roots, known = _main(root)
    blocks, now = [], []

    def cut() -> None:
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            blocks.append(text)

    def walk(node: Node) -> None:
        under = [(iter(node.kids), False)]   # what is left of the open elements, and whether they are blocks
        while under:
            kids, block = under[-1]
            for k in kids:
                if not isinstance(k, Node):
                    now.append(k)
                elif k.tag in ("br", "wbr"):
                    now.append(" " if k.tag == "br" else "")
                elif not _marked(k, known) and not (k.digest in templates and not (known and k.tag in _PROSE)):
                    if k.tag in _BLOCK:
                        cut()
                    under.append((iter(k.kids), k.tag in _BLOCK))
                    break
            else:
                under.pop()
                if block:
                    cut()

    for r in roots:
        if r.tag not in _LEAD or r.digest not in templates:
            cut()
            walk(r)
            cut()
    return "\n\n".join(blocks)


_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)
    return pages.withColumn("_host", F.lower(host))


def _subtrees_of(given: DataFrame, key: str) -> DataFrame:
    """_site, hash, body: hashes of the subtrees of every page, and -1 for the
    page itself; ``body`` is column ``key``, or the hash of the whole tree."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part_ = batch.slice(at, 500)
                hosts, bodies, hashes = [], [], []
                for host, page, body in zip(*(part_.column(c).to_pylist() for c in ("_host", "html", "_body"))):
                    root = parse(page)
                    own = [-1, *subtrees(root)]
                    hosts += [host] * len(own)
                    bodies += [root.digest if body is None else body] * len(own)
                    hashes += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(bodies, pa.int64())],
                    names=["_site", "hash", "body"])

    body = F.col(key) if key else F.lit(None).cast("long")
    given = given.filter(F.col("_host") != "").select("_host", "html", body.alias("_body"))
    return given.mapInArrow(run, "_site string, hash long, body long").distinct()


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, part: float = PART,
              enough: int = ENOUGH) -> DataFrame:
    """_site, hash of the subtrees that recur on a host."""
    seen = _subtrees_of(_with_host(pages.select("url", "html")), "")
    counts = stage(seen.groupBy("_site", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages),
                   "template-counts")
    sites = counts.filter("hash = -1").select("_site", F.col("n").alias("_pages"))
    many = F.least(part * F.col("_pages"), F.lit(float(enough)))
    return counts.filter("hash <> -1").join(sites, "_site").filter(F.col("n") >= many).select("_site", "hash")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, part: float = PART,
            enough: int = ENOUGH) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = stage(templates(pages, least_pages, part, enough), "templates")
    given = _with_host(pages.select("page_id", "url", "html"))
    sent = None
    if found.count() <= BROADCAST:
        known: dict[str, list[int]] = {}
        for site, digest in found.collect():
            known.setdefault(site, []).append(digest)
        sent = pages.sparkSession.sparkContext.broadcast({k: frozenset(v) for k, v in known.items()})
        given = given.withColumn("templates", F.lit(None).cast("array<long>"))
    else:
        # the templates that each page has, by host and content
        given = given.withColumn("_key", F.xxhash64("_host", "html"))
        own = _subtrees_of(given, "_key").join(found, ["_site", "hash"]).groupBy("body").agg(
            F.collect_list("hash").alias("templates"))
        given = given.join(stage(own, "page-templates"), F.col("_key") == F.col("body"), "left")
    given = given.select("page_id", "url", "html", "_host", "templates")

    def run(batches):
        none = frozenset()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part_ = batch.slice(at, 500)
                texts = []
                for page, host, own in zip(*(part_.column(c).to_pylist() for c in ("html", "_host", "templates"))):
                    texts.append(main_text(parse(page), frozenset(own or ()) if sent is None else sent.value.get(host, none)))
                yield pa.RecordBatch.from_arrays(
                    [part_.column("page_id"), part_.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    schema = pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return given.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
