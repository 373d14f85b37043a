"""Text cleaning as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelline.constants import NOISE

BLANKS = " \t\n\r\x0b\x0c\u00a0"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space, no-break spaces included."""
    return F.btrim(c, F.lit(BLANKS))


def once(c: Column, use) -> Column:
    """use(c) with a costly c evaluated one time, however often `use` refers to it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Trimmed upper-case text; noise words become null."""
    v = F.upper(strip(c))
    return F.when(~v.isin(NOISE), v)


def not_noise(c: Column) -> Column:
    """Whether cleaning would leave a text; as a filter it costs one pass over the text."""
    return ~F.upper(strip(c)).isin(NOISE)


def ascii_lower(c: Column) -> Column:
    """Lower-case the letters A to Z only, as a case-blind LIKE compares them."""
    return F.translate(c, _UPPER, _UPPER.lower())


def slug(c: Column) -> Column:
    """Lower-case text with every run of blanks turned into one hyphen."""
    return F.regexp_replace(F.lower(c), r"\s+", "-")


def holds(c: Column, term: str) -> Column:
    """Case-blind substring test; a null text holds nothing."""
    return F.coalesce(F.contains(F.lower(c), F.lit(term.lower())), F.lit(False))


def grouped(c: Column, decimals: int = 0) -> Column:
    """Number text with thousands separators, ties to even on the exact binary value."""
    return F.format_number(c, decimals)


def fixed(c: Column, decimals: int) -> Column:
    """Number text without thousands separators."""
    return F.replace(F.format_number(c, decimals), F.lit(","), F.lit(""))


def signed(c: Column, decimals: int) -> Column:
    """Number text that always carries its sign."""
    return F.concat(F.when(c >= 0, F.lit("+")).otherwise(F.lit("")), fixed(c, decimals))


def plain_text(html: Column) -> Column:
    """Visible text of an HTML fragment: tags dropped, common entities resolved, blanks collapsed."""
    bare = F.regexp_replace(html, "(?s)<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return strip(F.regexp_replace(bare, r"\s+", " "))
