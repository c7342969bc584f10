"""Container-scoped first links of listing pages.

Which link belongs to which product container depends on the element tree
(nesting, unclosed tags, comments, entity-decoded attributes), which no
regex gets right.  This is the one Python helper on the catalogue path: an
Arrow-batched pandas UDF over the stdlib HTML tokenizer, returning one
struct per container; the caller explodes it, so Spark partitions the pages
and nothing is gathered.  Input batches are bounded by both
``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``
(64 MB by default), so large pages do not pile up in one Python worker.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTAINER_LINKS = T.ArrayType(T.StructType([
    T.StructField("container_no", T.IntegerType()),
    T.StructField("href", T.StringType()),
]))

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _ContainerLinks(HTMLParser):
    def __init__(self, tag: str, classes: list[str]):
        super().__init__(convert_charrefs=True)
        self.tag, self.classes = tag, classes
        self.stack: list[tuple[str, int | None]] = []   # (tag, container index or None)
        self.found: list[list] = []                      # [container_no, href]

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "a" and "href" in attrs:
            for _, idx in self.stack:
                if idx is not None and self.found[idx][1] is None:
                    self.found[idx][1] = attrs["href"] or ""
        idx = None
        if tag == self.tag and (attrs.get("class") or "").split() == self.classes:
            idx = len(self.found)
            self.found.append([idx, None])
        if tag not in _VOID:
            self.stack.append((tag, idx))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.stack and self.stack[-1][0] == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for pos in range(len(self.stack) - 1, -1, -1):
            if self.stack[pos][0] == tag:
                del self.stack[pos:]
                return


def container_links_py(html: str | None, container_class: str, tag: str = "div") -> list[dict]:
    if not html:
        return []
    parser = _ContainerLinks(tag, container_class.split())
    parser.feed(html)
    parser.close()
    return [{"container_no": i, "href": h} for i, h in parser.found]


def container_links(html: Column | str, container_class: str, tag: str = "div") -> Column:
    """array<struct<container_no, href>>: every element ``tag`` whose class
    list equals ``container_class`` (order-sensitive), with the first
    descendant ``<a>`` that has an href (null when there is none)."""

    @F.pandas_udf(CONTAINER_LINKS)
    def _links(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: container_links_py(h, container_class, tag))

    return _links(F.col(html) if isinstance(html, str) else html)
