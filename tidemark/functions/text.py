"""Text expressions: HTML to text elements, tokens, term hits, value normalisation.

The patterns use only what Java and RE2 regular expressions share, so results
do not depend on the engine that evaluates them.
"""

from __future__ import annotations

import html.entities
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import col

HIDDEN_BLOCKS = (
    r"(?s)<!--.*?-->",
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
)
BLOCK_TAG = (r"(?i)</?(title|head|body|html|article|section|header|footer|nav|main|aside|div|p|br|hr"
             r"|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|td|th|pre|blockquote)([ \t\r\n][^>]*)?/?>")
# A tag begins with a letter, a slash or an exclamation mark; other "<" are text.
ANY_TAG = r"<[A-Za-z/!][^>]*>"
BLANKS = r"[ \t\r\f]+"
# A character reference behind its ampersand: decimal, hexadecimal or a name.
REFERENCE = r"^(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
REPLACEMENT = "\ufffd"


def reference_names() -> dict[str, str]:
    """Character by name: the named character references of HTML 4, the apostrophe, and
    for the numbers 128 to 159, which pages use for Windows characters, these. A
    no-break space is a space."""
    found = {name: chr(point) for name, point in html.entities.name2codepoint.items()}
    found["apos"] = "'"
    for point in range(128, 160):
        char = bytes([point]).decode("cp1252", "ignore")
        if char:
            found[f"#{point}"] = char
    return {**found, "nbsp": " ", "#160": " "}


def decode_references(text: Column) -> Column:
    """Every character reference once: what one decodes to is never decoded again.

    The text is cut at its ampersands, so each piece begins with at most one reference.
    Unknown names stay as they are; numbers that are no character become U+FFFD.
    """
    names = F.create_map(*[F.lit(x) for pair in sorted(reference_names().items()) for x in pair])

    def piece(part: Column) -> Column:
        name = F.regexp_extract(part, REFERENCE, 1)
        point = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(
            name.startswith("#"), F.substr(name, F.lit(2))).cast("bigint")
        known = F.try_element_at(names, F.when(point.isNotNull(), F.concat(
            F.lit("#"), point.cast("string"))).otherwise(name))
        valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        coded = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).when(
            point.isNotNull(), REPLACEMENT)
        char = F.coalesce(known, coded)
        return F.when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(
            F.concat(char, F.substr(part, F.length(name) + 2)))
    pieces = F.split(text, "&", -1)
    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), piece)
    return F.when(~text.contains("&"), text).otherwise(
        F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, "")))


def html_elements(page: str | Column) -> Column:
    """The visible text of a page as an array of non-empty block texts."""
    text = col(page)
    for pattern in HIDDEN_BLOCKS:
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(text, BLOCK_TAG, "\n")
    text = F.regexp_replace(text, ANY_TAG, "")
    text = decode_references(text)
    text = F.regexp_replace(text, BLANKS, " ")
    blocks = F.transform(F.split(text, "\n"), lambda b: F.trim(b))
    return F.filter(blocks, lambda b: b != "")


def tokens(text: str | Column, terms: Sequence[str]) -> Column:
    """The text's lower-case runs of letters that are one of ``terms``."""
    return F.filter(F.split(F.lower(col(text)), r"[^\p{L}]+"), lambda t: t.isin(*terms))


def term_hits(token_array: Column, terms: Sequence[str]) -> Column:
    """How many tokens are one of ``terms``; ``isin`` is a hash lookup for longer lists."""
    return F.size(F.filter(token_array, lambda t: t.isin(*terms))).cast("bigint")


def first_match(text: str | Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, trimmed; NULL when there is none or it is empty."""
    return F.nullif(F.trim(F.regexp_extract(col(text), pattern, group)), F.lit(""))


def to_number(raw: Column) -> Column:
    """``$1,234.50`` -> 1234.5 and ``18%`` -> 0.18; NULL when not a number."""
    digits = F.regexp_replace(raw, r"[$,% \t]|USD", "")
    # Only digits, a sign, a point and an exponent: the cast alone also takes words.
    number = F.when(digits.rlike(r"^[-+]?[0-9.]+([eE][-+]?[0-9]+)?$"), digits.try_cast("double"))
    return F.when(raw.endswith("%"), number / F.lit(100.0)).otherwise(number)


def to_iso_date(raw: Column) -> Column:
    """ISO text as a date; NULL for anything else."""
    return F.when(raw.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), raw.try_cast("date"))
