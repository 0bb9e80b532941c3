"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_column, arrow_map, written

#: Share of the other pages with one reference that repeat a node's text where their template has it.
CONSTANT = 0.9
#: Containers whose marks, down to a depth below the body, are a page's layout.
CONTAINERS, DEPTH = frozenset("article aside body div footer form header main nav section table".split()), 3
#: Shares of a reference's article text that a template may take: within marked articles, and on pages that mark none.
#: Beyond, the pages are copies of an article and not pages of a template.
COPIES, COPIES_UNMARKED = 0.5, 0.9
#: Elements that are never article text, and the words of class, id and role that mark others.
NEVER = frozenset(
    "nav footer aside form script style noscript template head title iframe object embed svg math canvas audio video button select "
    "option input textarea label dialog menu datalist".split()
)
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising advertorial sponsor sponsored banner promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond pagination pager "
    "toolbar skip search masthead topbar contentinfo complementary dialog".split()
)
#: Marks of the top of a page; inside an article they hold its own heading.
TOPS = frozenset(("header", "masthead", "banner"))
REGIONS = frozenset(("article", "main"))
#: Marks of reader comments, which are often articles of their own.
REPLIES = frozenset(("comment", "comments", "reply", "replies"))
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
MARKED = re.compile(r"class|id\s*=|role|hidden|display", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def host(url: str = "url") -> Column:
    """The host of a URL in lower case, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def noise(node, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside``: it is within one."""
    from panelwright.llm.dom import attribute

    if node.tag in NEVER or node.tag == "header" and not inside:
        return True
    given = node.attributes
    if not given or not MARKED.search(given):
        return False
    words = set(re.findall(r"[a-z]+", " ".join(attribute(given, name) for name in ("class", "id", "role")).lower()))
    marks = words & (MARKS | TOPS)
    if marks and not (node.tag in REGIONS and not marks & REPLIES) and not (inside and marks <= TOPS) and not holds_article(node):
        return True
    return bool(attribute(given, "hidden")) or attribute(given, "aria-hidden") == "true" or bool(HIDDEN.search(attribute(given, "style")))


def holds_article(node) -> bool:
    """Whether an article lies below an element that is marked as something else, as in a frame of text and sidebar."""
    from panelwright.llm.dom import attribute

    todo = list(node.kids)
    while todo:
        kid = todo.pop()
        if kid.tag in REGIONS and not set(re.findall(r"[a-z]+", attribute(kid.attributes, "class").lower())) & MARKS:
            return True
        if kid.tag not in NEVER:
            todo += kid.kids
    return False


def region(node) -> bool:
    from panelwright.llm.dom import attribute

    if node.tag in REGIONS:
        return True
    return "main" in node.attributes and attribute(node.attributes, "role") == "main" or attribute(node.attributes, "itemprop") == "articleBody"


def blocks_of(root, constant: frozenset, only: bool) -> list[str]:
    """Text blocks in page order, of marked articles only or of all that are not mostly links."""
    from html import unescape

    buffer, linked, out = [], [0], []

    def flush():
        text = " ".join(unescape("".join(buffer)).split())
        if text and (only or 2 * linked[0] < len(text)):
            out.append(text)
        buffer.clear()
        linked[0] = 0

    # (item, inside a region, inside a link); None ends a block.
    todo = [(root, False, False)]
    while todo:
        item, inside, link = todo.pop()
        if item is None:
            flush()
        elif type(item) is str:
            if inside or not only:
                buffer.append(item)
                linked[0] += len(item) * link
        elif not noise(item, inside):
            starts = item.tag in BLOCKS
            if starts:
                flush()
                todo.append((None, inside, link))
            elif item.tag in ("br", "wbr"):
                buffer.append(" " if item.tag == "br" else "")
            inside, link = inside or region(item), link or item.tag == "a"
            bare = item.at in constant
            todo += [(x, inside, link) for x in reversed(item.items) if not (bare and type(x) is str)]
    flush()
    return out


def blocks(root, constant: frozenset) -> list[str]:
    """Text blocks in page order: those of articles where a page marks any, else all that are not mostly links."""
    return blocks_of(root, constant, True) or blocks_of(root, constant, False)


def layout(root) -> int:
    """A checksum of the marks of a page's outer containers; what stands inside an article does not count."""
    from zlib import crc32

    from panelwright.llm.dom import attribute

    found, todo = set(), [(root, 0, "")]
    while todo:
        node, depth, path = todo.pop()
        for kid in node.kids:
            if kid.tag not in CONTAINERS:
                todo += [(kid, depth, path)] * (kid.tag == "html")
                continue
            at = f"{path}/{kid.tag}.{attribute(kid.attributes, 'class')}#{attribute(kid.attributes, 'id')}"
            found.add(at)
            if depth < DEPTH and not region(kid):
                todo.append((kid, depth + 1, at))
    return crc32("\n".join(sorted(found)).encode())


def template_places(root, places: set[int]) -> list[int]:
    """The constant places of a reference that are template: all, or those outside its articles if they hold most of its article text."""
    marked = blocks_of(root, frozenset(), True)
    whole = marked or blocks_of(root, frozenset(), False)
    left = blocks_of(root, frozenset(places), bool(marked))
    size = sum(map(len, whole))
    if sum(map(len, left)) >= (1 - (COPIES if marked else COPIES_UNMARKED)) * size:
        return sorted(places)
    if not marked:
        return []
    inside, todo = set(), [(root, False)]
    while todo:
        node, within = todo.pop()
        within = within or region(node)
        if within:
            inside.add(node.at)
        todo += [(kid, within) for kid in node.kids]
    return sorted(places - inside)


def _trees():
    """Parsed reference pages of a worker, and the shapes scored so far; both start anew when large."""
    from panelwright.llm.dom import align, parse

    trees, known = {}, {}

    def pairs(tree, reference: str):
        if len(trees) > 200:
            trees.clear()
        if len(known) > 200_000:
            known.clear()
        if reference not in trees:
            trees[reference] = parse(reference)
        return align(trees[reference], tree, known)

    return pairs


def laid_out(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(_id, _url, _host, _page, _layout): every page with its host and the layout of its tree, written once for the steps that follow."""
    def make():
        from panelwright.llm.dom import parse

        return lambda pages: [layout(parse(p)) for p in pages.to_pylist()]

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host(url_col).alias("_host"), F.coalesce(html_col, F.lit("")).alias("_page"))
    return written(rows.withColumn("_layout", arrow_column(rows, F.col("_page"), "long", make)))


def references(laid: DataFrame) -> DataFrame:
    """(_host, _layout, _reference, _first): a page of each layout that two or more pages of a host share.

    The page of a layout is that of the least hash. The host's commonest layout is marked
    as first: pages whose layout no other page shares are aligned with it. A host without
    two pages of one layout has no reference.
    """
    least = F.min(F.struct(F.xxhash64("_id", "_page").alias("_x"), "_page")).alias("_least")
    each = laid.filter(F.length("_page") > 0).groupBy("_host", "_layout").agg(least, F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = written(each.select("_host", "_layout", F.col("_least._page").alias("_reference"), "_n"))
    commonest = shared.groupBy("_host").agg(F.max_by("_layout", F.struct("_n", -F.col("_layout"))).alias("_common"))
    return shared.join(commonest, "_host").select("_host", "_layout", "_reference", (F.col("_layout") == F.col("_common")).alias("_first"))


def templates(laid: DataFrame) -> DataFrame:
    """(_host, _layout, _reference, _first, _constant array<int>): the places of each reference tree whose text is template.

    Every page is aligned with the reference of its layout; a place is template if nearly
    all the other pages of that layout match it with the same text. If that
    would take most of the article text of the reference, its pages are taken for copies
    and their articles for content.
    """
    chosen = written(references(laid))

    def make():
        import pyarrow as pa

        from panelwright.llm.dom import parse

        pairs = _trees()

        def step(hosts, layouts, pages, references):
            count = {}
            for name, own, page, reference in zip(hosts.to_pylist(), layouts.to_pylist(), pages.to_pylist(), references.to_pylist()):
                count[name, own, -1] = count.get((name, own, -1), 0) + 1  # pages of the reference
                for x, y in pairs(parse(page), reference):
                    if any(type(i) is str for i in x.items) and (text := x.own_text()) and text == y.own_text():
                        count[name, own, x.at] = count.get((name, own, x.at), 0) + 1
            keys = list(count)
            kinds = (pa.string(), pa.int64(), pa.int32())
            return [*[pa.array([k[i] for k in keys], kind) for i, kind in enumerate(kinds)], pa.array([count[k] for k in keys], pa.int64())]

        return step

    joined = laid.filter(F.length("_page") > 0).select("_host", "_layout", "_page").join(chosen, ["_host", "_layout"])
    equal = arrow_map(joined, ["_host", "_layout", "_page", "_reference"], "_host string, _layout long, at int, n long", make)
    equal = equal.groupBy("_host", "_layout", "at").agg(F.sum("n").alias("n"))
    # Bounded by the reference page.
    by_reference = equal.groupBy("_host", "_layout").agg(F.max(F.when(F.col("at") < 0, F.col("n"))).alias("_pages"), F.collect_list(F.struct("at", "n")).alias("_found"))
    others = lambda f: (f["at"] >= 0) & (F.col("_pages") > 1) & (f["n"] - 1 >= CONSTANT * (F.col("_pages") - 1))
    places = by_reference.select("_host", "_layout", F.transform(F.filter("_found", others), lambda f: f["at"]).alias("_places"))
    both = chosen.join(places, ["_host", "_layout"], "left").withColumn("_places", F.coalesce("_places", F.array().cast("array<int>")))

    def settle():
        from panelwright.llm.dom import parse

        def step(hosts, layouts, references, first, places):
            kept = [template_places(parse(r), set(p)) if p else [] for r, p in zip(references.to_pylist(), places.to_pylist())]
            return [hosts, layouts, references, first, kept]

        return step

    schema = "_host string, _layout long, _reference string, _first boolean, _constant array<int>"
    return written(arrow_map(both, ["_host", "_layout", "_reference", "_first", "_places"], schema, settle))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the main text of every whole page, one line a block.

    Nodes that match the template of their host's layout, and menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles and reader comments are left out;
    what varies between pages stays, and so do articles that all pages of a host share.
    Character references are decoded, white space inside a block is one blank. A null or
    empty page, or one without text, gives an empty text; a null url is a host of its own.
    Every row gives a row, repeated rows and null ids included; other columns are left out.
    A page joins the one reference of its layout, or its host's first, so a host can have
    any number of layouts, and one with a third of all pages is split like any other.
    """
    laid = laid_out(pages, id_col, url_col, html_col)
    known = templates(laid)

    def make():
        from panelwright.llm.dom import parse

        pairs = _trees()

        def step(ids, urls, pages, references, constants):
            texts = []
            for page, reference, places in zip(pages.to_pylist(), references.to_pylist(), constants.to_pylist()):
                tree, constant = parse(page), frozenset()
                if places:
                    own = set(places)
                    constant = frozenset(y.at for x, y in pairs(tree, reference) if x.at in own and x.own_text() == y.own_text())
                texts.append("\n".join(blocks(tree, constant) or (blocks(tree, frozenset()) if constant else [])))
            return [ids, urls, texts, [len(t) for t in texts]]

        return step

    # Pages of a shared layout never take the first reference, even if theirs has no template.
    own = known.select("_host", "_layout", F.lit(True).alias("_shared"), "_reference", "_constant")
    first = known.filter("_first").select(F.col("_host").alias("_at"), F.col("_reference").alias("_reference_1"), F.col("_constant").alias("_constant_1"))
    joined = laid.join(own, ["_host", "_layout"], "left")
    joined = joined.join(first, (F.col("_host") == F.col("_at")) & F.col("_shared").isNull(), "left")
    reference, constant = F.coalesce("_reference", "_reference_1"), F.coalesce("_constant", "_constant_1")
    kinds = dict(pages.dtypes)
    schema = f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long"
    return arrow_map(joined, ["_id", "_url", "_page", reference, constant], schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    return extract(table(spark, sf_dir, "pages"))
