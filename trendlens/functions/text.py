"""Column expressions for cleaning, counting and tokenising text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: marker that the article feed puts in place of text behind a paywall.
PAYWALL_MARKER = "ONLY AVAILABLE IN PAID PLANS"

# Patterns removed while cleaning. White space is listed code point by code point
# because regex engines differ on what \s holds beyond ASCII.
HTML_TAG = r"<[^>]+>"
_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = rf"http[s]?://[^{_SPACE}]+|www\.[^{_SPACE}]+"
WHITESPACE = rf"[{_SPACE}]+"
NOT_SPACE = rf"[^{_SPACE}]+"
# The same runs without single spaces, which stay as they are: most of a text is passed over without a replacement.
_RUN = rf" [{_SPACE}]+|[{_SPACE.replace("x20", "x1f", 1)}][{_SPACE}]*"

# Anything that is neither letter, digit nor underscore separates words.
WORD_BREAK = r"[^\p{L}\p{N}_]+"


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def strip_html(col: Column) -> Column:
    return F.regexp_replace(col, HTML_TAG, "")


def strip_urls(col: Column) -> Column:
    return F.regexp_replace(col, URL, "")


def collapse_ws(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, _RUN, " "))


def word_count(col: Column) -> Column:
    """Whitespace-separated tokens; 0 for NULL and blank text."""
    return F.regexp_count(text_or_empty(col), F.lit(NOT_SPACE)).cast("long")


def flat_word_count(flat: Column) -> Column:
    """Words of a text whose words are parted by single spaces: one more than it has spaces."""
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def is_paywalled(col: Column) -> Column:
    return F.coalesce(F.contains(col, F.lit(PAYWALL_MARKER)), F.lit(False))


def choose_text(text: Column, title: Column, description: Column, content: Column) -> Column:
    """Full text when there is one, else title, description and content joined by spaces."""
    joined = F.concat_ws(" ", text_or_empty(title), text_or_empty(description), text_or_empty(content))
    missing = text.isNull() | (text == "") | (text == PAYWALL_MARKER)
    return F.when(missing, joined).otherwise(text)


def scrub(col: Column) -> Column:
    """Tags out, then urls, then whitespace runs, in this order."""
    return collapse_ws(strip_urls(strip_html(col)))


def lead(col: Column, chars: int | None) -> Column:
    """First ``chars`` characters; the whole text when ``chars`` is None."""
    return col if chars is None else F.substring(col, 1, chars)


def parse_ts(col: Column) -> Column:
    """Timestamp without zone, NULL when the text is no timestamp."""
    return col.try_cast("timestamp_ntz")


def clean_title(col: Column) -> Column:
    return F.trim(F.replace(col, F.lit(" - N/A"), F.lit("")))


def words(col: Column) -> Column:
    """Lower-case words of a text, in order, empties dropped."""
    return F.filter(F.split(F.lower(text_or_empty(col)), WORD_BREAK), lambda w: w != "")


def dup_text(title: Column, text: Column, max_chars: int | None = None, title_only: bool = False) -> Column:
    """Text compared by the copy detector: title, a space and the (leading part of the) text."""
    if title_only:
        return text_or_empty(title)
    return F.concat(text_or_empty(title), F.lit(" "), lead(text_or_empty(text), max_chars))
