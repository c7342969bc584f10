"""RFC 3986 reference resolution against a site root, as a Catalyst
expression.  Matches ``urllib.parse.urljoin(root, href)`` when ``root`` is
``scheme://host`` with no path, query or fragment (the only base used)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What URL parsers strip in front of a reference.
_LEADING = "".join(map(chr, range(0x21)))
_REST = 1 << 30


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once: a lambda variable, not
    a copy of its expression at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fold_segments(segments: Column) -> Column:
    """Remove dot segments: '.' is skipped, '..' drops the previous one."""
    empty = F.array().cast("array<string>")
    return F.aggregate(
        segments, empty,
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.array_append(acc, seg)),
    )


def _path_of(path: Column) -> Column:
    """An absolute path: merged with the empty base path, dots folded."""
    def fold(segs: Column) -> Column:
        last = F.element_at(segs, -1)
        folded = _fold_segments(segs)
        return F.array_join(F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded), "/")

    def segments(parts: Column) -> Column:
        # a relative path drops its empty inner segments, an absolute one keeps them
        rel = F.concat(F.array(F.lit("")), F.filter(parts, lambda x: x != ""))
        rel = F.when(F.element_at(parts, -1) == "", F.array_append(rel, F.lit(""))).otherwise(rel)
        return F.when(F.get(parts, F.lit(0)) == "", parts).otherwise(rel)

    joined = _bind(_bind(F.split(path, "/"), segments), fold)
    return _bind(joined, lambda j: F.when(F.startswith(j, F.lit("/")), j).otherwise(F.concat(F.lit("/"), j)))


def _tail_of(tail: Column) -> Column:
    """Query and fragment; an empty one loses its mark."""
    def build(t: Column) -> Column:
        at = F.instr(t, "#")
        query = F.when(at > 0, F.substring(t, F.lit(1), at - 1)).otherwise(t)
        frag = F.when(at > 0, F.substring(t, at, F.lit(_REST))).otherwise(F.lit(""))
        drop = lambda c, mark: F.when(c == mark, F.lit("")).otherwise(c)
        return F.concat(drop(query, "?"), drop(frag, "#"))
    return _bind(tail, build)


def resolve_url(href: Column | str, root: str) -> Column:
    href = F.col(href) if isinstance(href, str) else href
    root = root.rstrip("/")
    scheme = root.split(":", 1)[0].lower()

    def with_parts(p: Column) -> Column:
        """p: rest (the reference without the base's own scheme)."""
        authority = F.regexp_extract(p, r"^//([^/?#]*)", 1)

        def local(ref: Column) -> Column:
            return _bind(F.regexp_extract(ref, r"^([^?#]*)", 1), lambda path: _bind(
                F.substring(ref, F.length(path) + 1, F.lit(_REST)), lambda tail: F.concat(
                    F.lit(root), F.when(path == "", F.lit("")).otherwise(_path_of(path)), _tail_of(tail))))

        # "//" with an empty authority keeps the base host: resolve what follows
        return (F.when(authority != "", F.concat(F.lit(scheme + ":"), p))
                .otherwise(_bind(F.regexp_replace(p, "^//", ""), local)))

    def with_scheme(h: Column) -> Column:
        return _bind(F.regexp_extract(h, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), lambda s: (
            F.when(h == "", F.lit(root))
            .when((s != "") & (F.lower(s) != scheme), h)
            .otherwise(_bind(F.when(s != "", F.substring(h, F.length(s) + 2, F.lit(_REST))).otherwise(h), with_parts))))

    # leading controls and blanks go, and tabs and line ends anywhere
    clean = F.translate(F.ltrim(href, F.lit(_LEADING)), "\t\r\n", "")
    # an absolute path that needs no folding is the common case
    plain = href.rlike(r"^/[^/?#\x00-\x20][^?#\t\r\n]*\z") & ~F.contains(href, F.lit("/."))
    return (F.when(href.isNull(), F.lit(None).cast("string")).when(plain, F.concat(F.lit(root), href))
            .otherwise(_bind(clean, with_scheme)))
