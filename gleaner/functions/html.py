"""Catalyst expressions over raw HTML text (no Python on the hot path)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comments and script elements as one token stream: a script token swallows
# a "<!--" inside its body, a comment token swallows a script inside it.
_TOKENS = r"(?is)(<!--.*?-->|<script\b[^>]*>.*?</script\s*>)"


def script_by_id(html: Column | str, element_id: str) -> Column:
    """Body text of the first ``<script>`` whose id attribute equals
    ``element_id`` exactly (quoted or bare), ignoring commented-out markup.
    Empty string when there is none."""
    html = F.col(html) if isinstance(html, str) else html
    ident = re.escape(element_id)
    # tag and attribute names are case-insensitive, the id itself is not
    id_attr = (rf"(?s)^<(?i:script)\b[^>]*?\s(?i:id)\s*=\s*"
               rf"(\"{ident}\"|'{ident}'|{ident}(?=[\s>/]))")
    tokens = F.regexp_extract_all(html, F.lit(_TOKENS), 1)
    hits = F.filter(tokens, lambda t: t.rlike(id_attr))
    first = F.get(hits, 0)
    body = F.regexp_extract(first, r"(?is)^<script\b[^>]*>(.*)</script\s*>$", 1)
    # The cheap substring test skips the tokenizer on pages without the id.
    return F.when(F.instr(html, element_id) > 0, F.coalesce(body, F.lit(""))).otherwise(F.lit(""))


def anchor_hrefs(html: Column | str) -> Column:
    """All double-quoted href values of ``<a>`` tags, in document order
    (regex path: entities are not decoded)."""
    html = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)
