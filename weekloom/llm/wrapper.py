"""HTML extraction by wrapper induction.

The block elements of a page are a tree. Every page is aligned by simple tree matching with a
reference page of its host, and with one of its layout where a host has several; a node whose text
is the same on nearly all different pages of the host or of the layout is template, a node whose
text varies is a slot. The main text is what stands in the slots of the
article region, without menus, adverts, forms, comments and the like.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.staging import stage

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/>])(?:"[^"]*"|'[^']*'|[^'">])*/>"""
    r"""|<(script|style|noscript|template|title|textarea|svg|iframe|object|math)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*>""", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong"
    " sub sup time tt u var".split())
#: An open element of the second kind ends when one of the first kind starts.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("ul ol dl table html body article main section div td th".split())
NOT_IN_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav"
    " ol p pre section table ul".split())
#: Elements and words in class, id or role that mark what is not the article.
DROP_TAGS = frozenset("head nav footer aside form button select option dialog menu input datalist fieldset canvas audio video".split())
DROP_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar sidenav aside ad ads adv advert adverts advertisement"
    " advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login social share sharing related recommended pagination pager comment comments"
    " disqus reply replies respond discussion form search widget toolbar tooltip masthead topbar skip contentinfo"
    " complementary dialog".split())
#: Reader comments, which are never taken for the article, however long.
COMMENT_WORDS = frozenset("comment comments reply replies disqus respond discussion".split())
#: Words that mark an element in any compound; the others must be half of the compound's words at least.
SURE_WORDS = COMMENT_WORDS | frozenset("nav navbar breadcrumb breadcrumbs sidebar cookie cookies advert advertisement newsletter pagination".split())
#: Compounds that begin so tell of the layout around, not of the element; ``WHOLE_WORDS`` mark only alone.
STATE = re.compile(r"(?:has|have|no|not|is|with|without|hide|show)[-_]")
WHOLE_WORDS = frozenset(("form", "search", "alert", "head"))
#: An element of a listed word is a container after all if it holds more than so many per cent of the page's text, a form half.
CONTAINER_PERCENT, FORM_PERCENT = 75, 50
HEADER_WORDS = frozenset(("header", "head"))
MAIN_WORDS = frozenset(("main", "articlebody"))
DEEPEST = 120
#: Of at least so many different pages, so many per cent hold a template node's text.
LEAST_PAGES, TEMPLATE_PERCENT = 2, 90
#: What fewer pages than this share is template only if it is at most half of a page's text: pages
#: that share more are versions of one article.
SURE_PAGES = 5
#: What stands in an article rather than makes its layout, and how deep the layout is looked at.
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption".split())
LAYOUT_DEPTH, WHOLE = 6, -1


@dataclass
class Page:
    """Block elements in page order, and the blocks of text with the element each stands in."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    words: list[frozenset] = field(default_factory=list)
    owner: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)


def _attributes(raw: str) -> frozenset:
    if not raw or "=" not in raw and "hidden" not in raw:
        return frozenset()
    found = set()
    for m in ATTRIBUTE.finditer(raw):
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.add("popup")
        else:
            for compound in value.split():
                found |= _marks(compound)
    return frozenset(found)


def _marks(compound: str) -> set[str]:
    """The words of one class, id or role; listed ones that do not mark the element follow a dash."""
    parts = [w for w in re.split(r"[^a-z0-9]+", compound) if w]
    listed = {w for w in parts if w in DROP_WORDS or w in HEADER_WORDS or w in MAIN_WORDS}
    if STATE.match(compound):
        marks: set[str] = set()
    else:
        marks = {w for w in listed if len(parts) == 1 or w not in WHOLE_WORDS}
        if 2 * sum(w in marks for w in parts) < len(parts):
            marks &= SURE_WORDS
    return {w if w in marks or w not in listed else f"-{w}" for w in parts}


def parse(source: str) -> Page:
    """The tree of block elements; wrong nesting and missing ends are mended as browsers do."""
    page = Page(["#"], [-1], [frozenset()])
    stack: list[tuple[str, int]] = [("#", 0)]
    piece: list[str] = []
    skipped = 0  # depth within an inline element that is to be dropped

    def end_block() -> None:
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            if text:
                page.owner.append(stack[-1][1])
                page.text.append(text)
            piece.clear()

    def pop_to(k: int) -> None:
        end_block()
        del stack[k:]

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at and not skipped:
            piece.append(source[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag, closing = m[3].lower(), m[2]
        if tag in INLINE:
            if tag == "span" and (skipped or not closing and _attributes(m[4]) & DROP_WORDS):
                skipped += -1 if closing else 1
            continue
        skipped = 0
        if tag in VOID:
            if tag in ("br", "hr"):
                end_block()
            continue
        if closing:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if k:
                pop_to(k)
            else:
                end_block()
            continue
        ends = CLOSES.get(tag, ())
        if tag in NOT_IN_P:
            ends = (*ends, "p")
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    pop_to(i)
                    break
                if stack[i][0] in SCOPES and not (tag in ("tr", "td", "th") and stack[i][0] in ends):
                    break
        end_block()
        if m[4].endswith("/") and tag not in ("p", "div"):
            continue
        if len(stack) > DEEPEST:
            stack.append((tag, stack[-1][1]))
            continue
        page.tag.append(tag)
        page.parent.append(stack[-1][1])
        page.words.append(_attributes(m[4]))
        stack.append((tag, len(page.tag) - 1))
    if at < len(source) and not skipped:
        piece.append(source[at:] if "<" not in source[at:] else source[at : source.index("<", at)])
    end_block()
    return page


def _region(page: Page, i: int) -> bool:
    """Whether an element is one for the article; reader comments are none."""
    return (page.tag[i] in ("article", "main") or bool(page.words[i] & MAIN_WORDS)) and not page.words[i] & COMMENT_WORDS


def dropped(page: Page) -> list[bool]:
    """For each element whether it or one above it marks what is not the article.

    A form or an element of a listed word that holds most of the page's text is a container, not a
    mark. Where every region for the article would go, the largest that stands in no menu, footer,
    sidebar or comments stays, with all that it stands in.
    """
    n = len(page.tag)
    size = [0] * n
    for o, t in zip(page.owner, page.text, strict=True):
        size[o] += len(t)
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
    inside = [False] * n  # of an article or the main element
    own = [False] * n
    firm = [False] * n  # never a container, and nothing in it is the article
    for i in range(1, n):
        tag, words, up = page.tag[i], page.words[i], page.parent[i]
        inside[i] = inside[up] or tag in ("article", "main") or bool(words & MAIN_WORDS)
        by_tag = tag in DROP_TAGS or tag == "header" and not inside[i]
        by_word = tag not in ("html", "body", "main") and (
            bool(words & DROP_WORDS) or not inside[up] and tag != "article" and bool(words & HEADER_WORDS))
        firm[i] = firm[up] or by_tag and tag not in ("form", "header") or bool(words & COMMENT_WORDS) and by_word
        most = FORM_PERCENT if tag == "form" or "form" in words else CONTAINER_PERCENT
        own[i] = (by_tag or by_word) and (firm[i] or 100 * size[i] <= most * size[0])

    def spread() -> list[bool]:
        out = [False] * n
        for i in range(1, n):
            out[i] = own[i] or out[page.parent[i]]
        return out

    out = spread()
    regions = [i for i in range(1, n) if size[i] and _region(page, i)]
    if regions and all(out[i] for i in regions):
        free = [i for i in regions if not firm[i]]
        if free:
            i = max(free, key=lambda i: (size[i], -i))
            while i > 0:
                own[i] = False
                i = page.parent[i]
            out = spread()
    return out


def main_text(page: Page, template: frozenset = frozenset()) -> str:
    """Blocks of all article regions in page order, without dropped elements and template blocks."""
    bad = dropped(page)
    n = len(page.tag)
    size = [0] * n
    for i, (o, t) in enumerate(zip(page.owner, page.text, strict=True)):
        if not bad[o] and i not in template:
            size[o] += len(t)
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
    regions = {i for i in range(1, n) if not bad[i] and size[i] and page.tag[i] == "article"}
    regions = regions or {i for i in range(1, n) if not bad[i] and size[i] and (page.tag[i] == "main" or page.words[i] & MAIN_WORDS)}
    regions = regions or {0}
    under = [False] * n
    for i in range(n):
        under[i] = i in regions or i > 0 and under[page.parent[i]]
    return " ".join(t for i, (o, t) in enumerate(zip(page.owner, page.text, strict=True))
                    if under[o] and not bad[o] and i not in template)


# -- alignment ------------------------------------------------------------------------------


class Tree:
    """Tags and children, with one number for each distinct shape."""

    def __init__(self, tag: list[str], parent: list[int], shapes: dict):
        self.tag = tag
        self.kids: list[list[int]] = [[] for _ in tag]
        self.size = [1] * len(tag)
        self.shape = [0] * len(tag)
        for i in range(1, len(tag)):
            self.kids[parent[i]].append(i)
        for i in range(len(tag) - 1, -1, -1):
            self.shape[i] = shapes.setdefault((tag[i], *(self.shape[k] for k in self.kids[i])), len(shapes))
            if i:
                self.size[parent[i]] += self.size[i]


def align(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: the largest top-down, order-keeping match of nodes of ``a`` to ``b``."""
    memo: dict[tuple[int, int], int] = {}

    def same_ends(x: list[int], y: list[int]) -> tuple[int, int]:
        lo = 0
        while lo < len(x) and lo < len(y) and a.shape[x[lo]] == b.shape[y[lo]]:
            lo += 1
        hi = 0
        while hi < len(x) - lo and hi < len(y) - lo and a.shape[x[-1 - hi]] == b.shape[y[-1 - hi]]:
            hi += 1
        return lo, hi

    def weight(i: int, j: int) -> int:
        if a.tag[i] != b.tag[j]:
            return 0
        if a.shape[i] == b.shape[j]:
            return a.size[i]
        key = (a.shape[i], b.shape[j])
        if key not in memo:
            x, y = a.kids[i], b.kids[j]
            lo, hi = same_ends(x, y)
            ends = sum(a.size[k] for k in x[:lo]) + sum(a.size[k] for k in x[len(x) - hi :])
            memo[key] = 1 + ends + table(x[lo : len(x) - hi], y[lo : len(y) - hi])[-1][-1]
        return memo[key]

    def table(x: list[int], y: list[int]) -> list[list[int]]:
        rows = [[0] * (len(y) + 1)]
        for i in x:
            row, up = [0], rows[-1]
            for n, j in enumerate(y):
                row.append(max(row[n], up[n + 1], up[n] + weight(i, j)))
            rows.append(row)
        return rows

    out: dict[int, int] = {}
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        out[i] = j
        x, y = a.kids[i], b.kids[j]
        if a.shape[i] == b.shape[j]:
            todo += zip(x, y, strict=True)
            continue
        lo, hi = same_ends(x, y)
        todo += zip(x[:lo], y[:lo], strict=True)
        todo += zip(x[len(x) - hi :], y[len(y) - hi :], strict=True)
        x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
        m = table(x, y)
        p, q = len(x), len(y)
        while p and q:
            if m[p][q] == m[p - 1][q]:
                p -= 1
            elif m[p][q] == m[p][q - 1]:
                q -= 1
            else:
                p, q = p - 1, q - 1
                todo.append((x[p], y[q]))
    return out


# -- Spark ----------------------------------------------------------------------------------

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def _slots(page: Page) -> list[tuple[int, int]]:
    """``(element, place)`` of every block: its element and how many blocks that held before."""
    seen: dict[int, int] = {}
    out = []
    for o in page.owner:
        out.append((o, seen.get(o, 0)))
        seen[o] = seen.get(o, 0) + 1
    return out


def layout(page: Page, bad: list[bool]) -> int:
    """A number for the containers around the article: their paths, tags and class words, each once."""
    path: list[tuple | None] = [()]
    for i in range(1, len(page.tag)):
        up, tag, words = path[page.parent[i]], page.tag[i], page.words[i]
        if up is None or bad[i] or tag in CONTENT or len(up) >= LAYOUT_DEPTH or up and (up[-1][0] in ("article", "main") or up[-1][2]):
            path.append(None)
            continue
        named = " ".join(sorted(w for w in words if w.isalpha()))
        path.append((*up, (tag, named, bool(words & MAIN_WORDS))))
    return _hash(repr(sorted({x for x in path if x})))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, layout, a signature of the text that is not dropped, and the page without its text."""
    for batch in batches:
        out: list[list] = [[] for _ in range(9)]
        for host, key, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            page = parse(source.as_py() or "")
            bad = dropped(page)
            keep = [(s, _hash(t)) for s, t in zip(_slots(page), page.text, strict=True) if not bad[s[0]]]
            sig = _hash("\n".join(t for o, t in zip(page.owner, page.text, strict=True) if not bad[o]))
            for column, value in zip(out, (host, key, layout(page, bad), sig, " ".join(page.tag), page.parent,
                                           [s[0] for s, _ in keep], [s[1] for s, _ in keep], [h for _, h in keep]), strict=True):
                column.append(value)
        ints = pa.list_(pa.int32())
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), ints, ints, ints, pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], SKELETON.names)


class SKELETON:
    names = ["host", "key", "layout", "sig", "tags", "parents", "owner", "place", "hash"]
    schema = "host string, key long, layout long, sig long, tags string, parents array<int>, owner array<int>, place array<int>, hash array<long>"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a page the element of the reference that its element is aligned with."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        shapes: dict = {}
        trees: dict[tuple, Tree] = {}
        for row in batch.to_pylist():
            group = row["host"], row["layout"]
            if group not in trees:
                trees[group] = Tree(row["ref_tags"].split(), row["ref_parents"], shapes)
            match = align(Tree(row["tags"].split(), row["parents"], shapes), trees[group])
            for o, p, h in zip(row["owner"], row["place"], row["hash"], strict=True):
                if o in match:
                    for column, value in zip(out, (*group, match[o], p, h), strict=True):
                        column.append(value)
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["host", "layout", "node", "place", "hash"])


def _refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's pages the one of the smallest signature for each group."""
    best: dict[tuple, tuple] = {}
    for batch in batches:
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for i, (g, s) in enumerate(zip(groups, batch.column(2).to_pylist(), strict=True)):
            if g not in best or s < best[g][0]:
                best[g] = (s, batch.column(3)[i].as_py(), batch.column(4)[i].as_py())
    rows = [(*g, *v) for g, v in best.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                     ["host", "layout", "sig", "tags", "parents"])


def _groups(seen: DataFrame) -> DataFrame:
    """The different pages of each host, as layout ``WHOLE``, and of each layout of a host of several."""
    page = F.struct("tags", "parents", "owner", "place", "hash")
    one = stage(seen.groupBy("host", "layout", "sig").agg(F.min(page).alias("x")), "pages")
    whole = one.groupBy("host", "sig").agg(F.min("x").alias("x")).withColumn("layout", F.lit(WHOLE).cast("long"))
    # counts of a host come from counts of its layouts, which are few
    counts = one.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("pages"))
    several = counts.groupBy("host").agg(F.count(F.lit(1)).alias("layouts")).where("layouts > 1")
    own = stage(counts.where(f"pages >= {LEAST_PAGES}").join(several, "host", "left_semi").select("host", "layout"), "layouts")
    part = one.join(own, ["host", "layout"], "left_semi")
    return stage(whole.unionByName(part).select("host", "layout", "sig", "x.*"), "groups")


def wrappers(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(host, key, layout)`` of the pages and ``(host, layout, wrappers)`` of the layouts that have template nodes.

    ``pages``: ``(host, key, html)``. Pages whose text is equal but for dropped elements count
    once, so that copies do not make a template.
    """
    group = ["host", "layout"]
    skeletons = stage(pages.where("host is not null").select("host", "key", "html").mapInArrow(_skeletons, SKELETON.schema), "skeletons")
    at = skeletons.select("host", "key", "layout").distinct()
    seen = _groups(skeletons)
    count = seen.groupBy(*group).agg(F.count(F.lit(1)).alias("pages")).where(f"pages >= {LEAST_PAGES}")
    first = seen.select(*group, "sig", "tags", "parents").mapInArrow(_refs, "host string, layout long, sig long, tags string, parents array<int>")
    first = first.groupBy(*group).agg(F.min(F.struct("sig", "tags", "parents")).alias("r"))
    refs = stage(first.join(count, group).select(*group, F.col("r.tags").alias("ref_tags"), F.col("r.parents").alias("ref_parents"), "pages"), "refs")
    nodes = seen.join(refs, group).mapInArrow(_aligned, "host string, layout long, node int, place int, hash long")
    nodes = nodes.groupBy(*group, "node", "place", "hash").agg(F.count(F.lit(1)).alias("n"))
    const = nodes.join(refs.select(*group, "pages"), group).where(f"100 * n >= {TEMPLATE_PERCENT} * pages")
    const = const.groupBy(*group).agg(F.collect_list(F.struct("node", "place", "hash")).alias("nodes"))
    made = refs.join(const, group).select(*group, F.struct("pages", "ref_tags", "ref_parents", "nodes").alias("w"))
    made = stage(made, "wrappers")
    of_host = made.where(f"layout = {WHOLE}").select("host", F.col("w").alias("whole"))
    known = skeletons.select(*group).distinct().join(of_host, "host", "left").join(made, group, "left")
    known = known.select(*group, F.array_compact(F.array("whole", "w")).alias("wrappers")).where("size(wrappers) > 0")
    return at, stage(known, "known")


def _template(page: Page, wrapper: dict) -> frozenset:
    """The blocks of a page that are template by one wrapper."""
    shapes: dict = {}
    ref = Tree(wrapper["ref_tags"].split(), wrapper["ref_parents"], shapes)
    match = align(Tree(page.tag, page.parent, shapes), ref)
    const = {(x["node"], x["place"], x["hash"]) for x in wrapper["nodes"]}
    found = frozenset(k for k, ((o, p), t) in enumerate(zip(_slots(page), page.text, strict=True))
                      if (match.get(o), p, _hash(t)) in const)
    if found and wrapper["pages"] < SURE_PAGES:
        bad = dropped(page)
        size = sum(len(t) for o, t in zip(page.owner, page.text, strict=True) if not bad[o])
        if 2 * sum(len(page.text[k]) for k in found) > size:
            return frozenset()
    return found


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for wrapped, source in zip(batch.column(3), batch.column(2), strict=True):
            page = parse(source.as_py() or "")
            template = frozenset().union(*(_template(page, w) for w in wrapped.as_py() or ()))
            texts.append(main_text(page, template))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of every row of ``pages``.

    A null html is an empty page with an empty text. A page whose url is null or names no host is
    extracted without a template, as is the only page of its host. What all of two to four pages
    share is template unless it is over half of a page's text. Null and repeated ids stay as they are. Elements nested deeper than 120 join the one they stand in.
    Other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", F.lower(F.nullif(F.regexp_extract("url", HOST, 1), F.lit(""))))
    rows = rows.withColumn("key", F.xxhash64("html"))
    at, known = wrappers(rows)
    at = stage(at.join(known, ["host", "layout"], "left_semi"), "layout_of")
    both = rows.join(at, ["host", "key"], "left").join(known, ["host", "layout"], "left").select("page_id", "url", "html", "wrappers")
    return both.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
