"""Column expressions for tag strings, weights, labels and user fields.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's behaviour:
#   a post's tags arrive as one string "<a><b><c>";
#   cleanup turns "<" and ">" into a blank, then one pass of "  " -> " ", then trim;
#   tokens are split at a single blank;
#   tag-list text and user fields keep ASCII characters only;
#   an edge is named "<from>-<to>", a month label is "<year>-<month>" (no padding);
#   a spoilt user name is a printed tuple: strip "(", ")" and '"', split at ",",
#   part 1 is the name, part 2 the website.
NON_ASCII = "[^\\x00-\\x7F]"
TUPLE_MARKS = "[()]"
TUPLE_STRIP = '[()"]'


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_tag_text(tags: str | Column) -> Column:
    """F1 + F2: ``<a><b>`` -> ``a b``."""
    s = F.replace(_c(tags), F.lit("<"), F.lit(" "))
    s = F.replace(s, F.lit(">"), F.lit(" "))
    s = F.replace(s, F.lit("  "), F.lit(" "))
    return F.trim(s)


def split_tags(techlist: str | Column) -> Column:
    """split at a blank; empty tokens are dropped (decision D15)."""
    return F.filter(F.split(_c(techlist), " "), lambda t: t != F.lit(""))


def post_weight(answer: str | Column, comment: str | Column,
                favorite: str | Column) -> Column:
    """answer + comment + favorite counts, a missing count is 0."""
    total = (F.coalesce(_c(answer), F.lit(0)).cast("bigint")
             + F.coalesce(_c(comment), F.lit(0)).cast("bigint")
             + F.coalesce(_c(favorite), F.lit(0)).cast("bigint"))
    return total


def ascii_only(text: str | Column) -> Column:
    """F8 without trim: drop every non-ASCII character."""
    return F.regexp_replace(_c(text), NON_ASCII, "")


def clean_list_text(techlist: str | Column) -> Column:
    """F8: ASCII only, trimmed; the whole text, whatever its length."""
    return F.trim(ascii_only(techlist))


def edge_name(node1: str | Column, node2: str | Column) -> Column:
    """F10."""
    return F.concat(_c(node1), F.lit("-"), _c(node2))


def month_label(year: str | Column, month: str | Column) -> Column:
    """``1996-3``."""
    return F.concat(_c(year).cast("string"), F.lit("-"), _c(month).cast("string"))


def month_index(day: str | Column) -> Column:
    """A month number that orders (year, month)."""
    return F.year(_c(day)) * 12 + F.month(_c(day))


def is_spoilt_name(name: str | Column) -> Column:
    """A name holding ``(`` or ``)`` is a printed tuple."""
    return _c(name).rlike(TUPLE_MARKS)


def repaired_name(name: str | Column) -> Column:
    """F14, name part."""
    parts = F.split(F.regexp_replace(_c(name), TUPLE_STRIP, ""), ",")
    return F.when(is_spoilt_name(name), F.get(parts, 0)).otherwise(_c(name))


def repaired_website(name: str | Column, website: str | Column) -> Column:
    """F14 + F13 + D20: website part, or the stored one, '' when absent."""
    parts = F.split(F.regexp_replace(_c(name), TUPLE_STRIP, ""), ",")
    return F.when(is_spoilt_name(name), F.coalesce(F.get(parts, 1), F.lit(""))) \
            .otherwise(F.coalesce(_c(website), F.lit("")))
