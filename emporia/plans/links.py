"""Link extraction from stored pages.

The source crawled one site with a browser and kept list items with a child link
that has ``target="_blank"``, a ``title`` and an ``href``.  Here the pages are rows
of a table; each is read once, tag by tag, with a stack of the open elements, in the
tasks that scan the table.  Decoding, completion and dedupe are Spark expressions.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.text import absolute_url, strip_ws, unescape_html, url_origin

# The scan runs in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A comment, a script or style with its text, or a tag.  What is not closed takes the
# rest of the page, so no page is gone through twice.
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)
    |<(?:script|style)(?=[\s/>])[^>]*+(?:>(?:.*?</(?:script|style)\s*>|.*))?
    |<(/?)([a-z][^\s/>]*+)((?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^'">]++)*+)(?:>|\Z)""",
    re.S | re.I | re.X,
)
ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
CLOSED = re.compile(r"""(?:^|[\s"'])/$""")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
LISTS = {"ul", "ol", "menu", "dir"}
# Elements that end a paragraph which is still open.
BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
          "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


class Element:
    __slots__ = ("anchors", "attrs", "begin", "name", "text")

    def __init__(self, name: str):
        self.name, self.anchors, self.attrs, self.begin, self.text = name, [], None, 0, ""


def list_items(html: str) -> list[list[Element]]:
    """The anchors directly in each list item of a page, items in order.

    As in a browser, an item ends with its list, at its end tag or at the next item of
    the same list, a paragraph at the next block, an anchor at the next anchor; an end
    tag closes what is open inside, and one without a start is ignored.
    """
    items: list[list[Element]] = []
    stack: list[Element] = []
    opened: Counter[str] = Counter()

    def close_to(depth: int, at: int) -> None:
        while len(stack) > depth:
            done = stack.pop()
            opened[done.name] -= 1
            if done.attrs is not None:
                done.text = html[done.begin : at]

    def find(name: str, walls: set[str]) -> int:
        """The innermost open ``name`` that no wall is in front of; -1 without one."""
        for k in range(len(stack) - 1, -1, -1) if opened[name] else ():
            if stack[k].name == name:
                return k
            if stack[k].name in walls:
                return -1
        return -1

    for m in TOKEN.finditer(html):
        if m.group(2) is None:
            continue
        name, at = m.group(2).lower(), m.start()
        if m.group(1):
            k = find(name, LISTS if name == "li" else {"li"} if name in ("p", "a") else set())
            if k >= 0:
                close_to(k, at)
            continue
        k = find("li", LISTS) if name == "li" else find("a", {"li"}) if name == "a" else find("p", {"li"}) if name in BLOCKS else -1
        if k >= 0:
            close_to(k, at)
        element = Element(name)
        if name == "li":
            items.append(element.anchors)
        elif name == "a":
            element.attrs, element.begin = {}, m.end()
            for a in ATTR.finditer(m.group(3)):
                element.attrs.setdefault(a.group(1).lower(), next((v for v in a.groups()[1:] if v is not None), ""))
            if stack and stack[-1].name == "li":
                stack[-1].anchors.append(element)
        if name not in VOID and not CLOSED.search(m.group(3)):
            stack.append(element)
            opened[name] += 1
    close_to(0, len(html))
    return items


def extract_links(
    pages: DataFrame,
    base: str | None = None,
    require_blank_target: bool = True,
    require_title: bool = True,
) -> DataFrame:
    """One row per qualifying list item: page_id, pos, href, title.

    An item qualifies when one anchor directly in it has an href, and a title and
    ``target="_blank"`` where these are required.  Its href is the first anchor's that
    has one, its title the first anchor's that has one (else the text of the first
    with an href).  Tag and attribute names match in any case, values in either
    quotes or none.  ``pos`` counts the page's items.  ``href`` is made absolute
    against ``base`` (default: the page's own origin); entities in both are decoded
    and whitespace around them is stripped.  A null page has no items.
    """

    def fits(a: Element) -> bool:
        keep = "href" in a.attrs and ("title" in a.attrs or not require_title)
        return keep and (a.attrs.get("target") == "_blank" or not require_blank_target)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, html in enumerate(batch.column("html").to_pylist()):
                for pos, anchors in enumerate(list_items(html or "")):
                    if any(map(fits, anchors)):
                        linked = next(a for a in anchors if "href" in a.attrs)
                        title = next((a.attrs["title"] for a in anchors if "title" in a.attrs), None)
                        out.append((row, pos, linked.attrs["href"], re.sub("<[^>]*>", "", linked.text) if title is None else title))
            at = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").take(at), batch.column("url").take(at), pa.array([x[1] for x in out], pa.int32()), *(pa.array([x[k] for x in out], pa.string()) for k in (2, 3))],
                names=["page_id", "url", "pos", "href", "title"],
            )

    rows = pages.select("page_id", "url", "html")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("title", T.StringType())])
    root = F.lit(base.rstrip("/")) if base else url_origin("url")
    return rows.mapInArrow(scan, schema).select(
        "page_id", "pos", absolute_url(unescape_html("href"), root).alias("href"), strip_ws(unescape_html("title")).alias("title")
    )


def dedupe_links(links: DataFrame) -> DataFrame:
    """One row per href, the first seen (lowest page_id, then position).

    A min over a struct per href: map-side combine keeps one candidate per
    task, so a link present on every page costs one row per task.
    """
    first = links.groupBy("href").agg(F.min(F.struct("page_id", "pos", "title")).alias("_f"))
    return first.select("href", F.col("_f.title").alias("title"), F.col("_f.page_id").alias("page_id"),
                        F.col("_f.pos").alias("pos"))


def page_links(pages: DataFrame, base: str | None = None, require_blank_target: bool = True,
               require_title: bool = True) -> DataFrame:
    """G5 + F23 + A14: deduplicated absolute links with titles."""
    return dedupe_links(extract_links(pages, base, require_blank_target, require_title))
