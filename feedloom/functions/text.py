"""Text cleaning as native column expressions.

Whitespace means Unicode whitespace plus the four ASCII separators U+001C to U+001F, so that
non-breaking spaces are collapsed and stripped as well.
"""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s\x1C-\x1F]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# The patterns that define the cleaned text and hence every stored hash.
HTML_TAG = r"<[^>]+>"
HTML_TAG_ON_ONE_LINE = r"<[^\n]*?>"
URL = r"https?://[^\s\x1C-\x1F]+"
NOT_ALPHANUMERIC = r"[^a-zA-Z0-9\s\x1C-\x1F]"
BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos);)"
WEB_ADDRESS = r"^https?://"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only knows U+0020)."""
    return F.btrim(col, F.lit(SPACES))


def collapse(col: Column) -> Column:
    """Turn each whitespace run into one blank and strip the ends."""
    return F.trim(F.regexp_replace(col, f"(?U){SPACE}+", " "))


def blank_to_null(col: Column) -> Column:
    """Strip; an empty string becomes null."""
    return F.nullif(strip(col), F.lit(""))


def clean_for_hash(col: Column) -> Column:
    """Tags, web addresses and punctuation out, whitespace collapsed, lower case; null gives ''."""
    text = F.coalesce(col, F.lit(""))
    text = F.regexp_replace(text, HTML_TAG, " ")
    text = F.regexp_replace(text, f"(?U){URL}", " ")
    text = F.regexp_replace(text, f"(?U){NOT_ALPHANUMERIC}", " ")
    return F.lower(collapse(text))


def clean_html(col: Column) -> Column:
    """Drop tags that open and close on one line, collapse whitespace; null gives ''."""
    return collapse(F.regexp_replace(F.coalesce(col, F.lit("")), HTML_TAG_ON_ONE_LINE, ""))


def plain_excerpt(col: Column, length: int = 400) -> Column:
    """Text without tags, collapsed, cut to ``length`` characters (a display field)."""
    text = collapse(F.regexp_replace(F.coalesce(col, F.lit("")), HTML_TAG, ""))
    return F.substring(text, 1, length)


def ellipsis(col: Column, length: int = 100) -> Column:
    """Cut to ``length`` characters and mark the cut with three dots."""
    return F.when(F.length(col) > length, F.concat(F.substring(col, 1, length), F.lit("..."))).otherwise(col)


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def _only_where(condition: Column, col: Column, fn: Callable[[Column], Column]) -> Column:
    """Send only the values that need ``fn`` to Python; the others cross as null."""
    return F.coalesce(fn(F.when(condition, col)), col)


def unescape_entities(col: Column) -> Column:
    """Resolve HTML entities. Spark has no built-in; values without ``&`` never leave the JVM."""
    return _only_where(F.contains(col, F.lit("&")), col, _unescape)


def unescape_web_address(col: Column) -> Column:
    """Resolve entities only in values that start with http:// or https://."""
    return _only_where(col.rlike(WEB_ADDRESS) & F.contains(col, F.lit("&")), col, _unescape)


def repair_xml(col: Column) -> Column:
    """Drop NUL characters and escape ampersands that start none of the five XML entities."""
    return F.regexp_replace(F.translate(col, "\x00", ""), BARE_AMPERSAND, "&amp;")


def employment_type(col: Column) -> Column:
    """FULL_TIME when the letters and digits spell FULLTIME, else PART_TIME (also for null)."""
    letters = F.upper(F.regexp_replace(F.coalesce(col, F.lit("")), "[^A-Za-z0-9]", ""))
    return F.when(letters == "FULLTIME", F.lit("FULL_TIME")).otherwise(F.lit("PART_TIME"))


# Words that mark a posting as closed.
CLOSED_WORDS = ["closed", "expired", "filled", "inactive", "not available"]


def posting_status(col: Column) -> Column:
    """CLOSED when any closing word occurs, else ACTIVE (also for null)."""
    closed = F.lower(col).rlike("|".join(CLOSED_WORDS))
    return F.when(F.coalesce(closed, F.lit(False)), F.lit("CLOSED")).otherwise(F.lit("ACTIVE"))


def truth(col: Column) -> Column:
    """True for the texts true, 1 and yes in any case; null stays null."""
    return F.lower(col.cast("string")).isin("true", "1", "yes")


def number(col: Column, default: float | None = None) -> Column:
    """A double, or ``default`` when the text is not a decimal number, infinite or not a number."""
    decimal = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)\s*$"
    parsed = F.when(col.cast("string").rlike(decimal), col.try_cast("double"))
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def join_terms(col: Column, separator: str = ", ") -> Column:
    """One text from an array of terms; null gives ''."""
    return F.coalesce(F.array_join(col, separator), F.lit(""))
