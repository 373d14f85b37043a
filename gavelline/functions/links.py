"""Link handling as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)"


def canonical_link(link: Column) -> Column:
    """scheme://host/path without query, fragment or parameters; a link without scheme or host stays as it is."""
    scheme = F.lower(F.regexp_extract(link, _ABSOLUTE, 1))
    host = F.regexp_extract(link, _ABSOLUTE, 2)
    path = F.regexp_replace(F.regexp_extract(link, _ABSOLUTE, 3), r";[^/]*$", "")
    return F.when(link.rlike(_ABSOLUTE), F.concat(scheme, F.lit("://"), host, path)).otherwise(link)


def site_of(link: Column) -> Column:
    """scheme://host of a link whose path starts right after it, else ''."""
    return F.regexp_extract(link, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)/", 1)


def _without_dots(path: Column) -> Column:
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(p == ".", acc)
        .otherwise(F.concat(acc, F.array(p))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), tail)).otherwise(path)


def resolve_link(page: Column, link: Column) -> Column:
    """The link as seen from its page: absolute, scheme-relative, rooted, relative, query or fragment only."""
    scheme = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base = F.regexp_extract(page, r"^([^?#]*)", 1)
    folder = F.concat(F.regexp_replace(F.substr(base, F.length(origin) + 1), r"[^/]*$", ""))
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.substr(link, F.length(path) + 1)
    return (
        F.when(link == "", page)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(path), rest))
        .when(link.startswith("?"), F.concat(base, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(page, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), rest))
    )


def viewer_link(path: Column, viewer: str) -> Column:
    """Link that hands a file path to the viewer page; the slash stays readable."""
    quoted = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    for code, char in (("%2F", "/"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(code), F.lit(char))
    return F.concat(F.lit(viewer + "?data="), F.replace(quoted, F.lit("*"), F.lit("%2A")))
