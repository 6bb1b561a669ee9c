"""Text and values out of HTML and XML, by pattern.

These are patterns, not parsers. Known limits: a ``>`` inside an attribute value
ends the tag, and named entities without a semicolon are left as they are.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from factspark.functions.strings import WHITESPACE_CLASS, first_int, let, strip

# What counts as markup, and where a search response states its hits.
HAS_TAG = r"<[^>]+>"
COUNT = r"<Count>(\d+)</Count>"

# Left to right, whichever starts first: a comment, a block whose content is not
# text, then any other tag. An unclosed comment or block runs to the end. The bracket
# stands before the alternatives, so that they are tried at brackets only.
NOT_TEXT = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|template\b[^>]*>.*?(?:</template\s*>|\z)"
    r"|/?[a-z][^>]*>|[!?][^>]*>)"
)

_NAMED = {name: text for name, text in html5.items() if name.endswith(";")}
# A reference, or text without one: a text is a sequence of these.
_PIECE = r"(?s)&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);|[^&]+|&"

# The most frequent ones are looked at first, the others in the whole table.
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;")


def _replaced(code: int) -> str | None:
    """What a number stands for where it is not its own character; None where it is."""
    if code == 0 or 0xD800 <= code <= 0xDFFF or code > 0x10FFFF:
        return "\ufffd"
    if 0x80 <= code <= 0x9F:
        return bytes([code]).decode("windows-1252", "ignore") or chr(code)
    control = code < 0x20 and chr(code) not in "\t\n\x0c\r"
    return "" if control or code == 0x7F or 0xFDD0 <= code <= 0xFDEF or code & 0xFFFE == 0xFFFE else None


_REPLACED = {code: _replaced(code) for code in [*range(0x20), *range(0x7F, 0xA0)]}


def _character(code: Column) -> Column:
    """What a numeric reference stands for. ``code`` is NULL for a number too large to read."""
    listed = F.from_json(
        F.lit(json.dumps({str(c): t for c, t in _REPLACED.items() if t is not None})),
        "map<string,string>",
    )
    no_character = code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    nothing = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    own = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(no_character, "\ufffd")
        .when(nothing, "")
        .when(code < 0xA0, F.coalesce(listed[code.cast("string")], own))
        .otherwise(own)
    )


def _decode_reference(ref: Column) -> Column:
    """``&name;``, ``&#1;`` or ``&#x1;`` as text; an unknown name stays as it is."""
    name = F.substr(ref, F.lit(2))
    named = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")  # folded to a constant
    known = F.coalesce(named[name], ref)
    for frequent in reversed(_FREQUENT):
        known = F.when(name == frequent, _NAMED[frequent]).otherwise(known)
    # Leading zeros don't count; what is left of a code point has at most seven digits.
    hexa = F.regexp_extract(ref, r"^&#[xX]0*([0-9A-Fa-f]*);$", 1)
    decimal = F.regexp_extract(ref, r"^&#0*([0-9]*);$", 1)
    code = F.when(
        ref.rlike("^&#[xX]"), F.when(F.length(hexa) <= 7, F.conv(F.concat(F.lit("0"), hexa), 16, 10))
    ).otherwise(F.when(F.length(decimal) <= 7, F.concat(F.lit("0"), decimal)))
    return F.when(ref.startswith("&#"), _character(code.cast("bigint"))).otherwise(known)


def decode_entities(c: Column) -> Column:
    """Character references to characters, in one pass, so that nothing is decoded twice."""
    pieces = F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0))
    is_reference = lambda p: p.startswith("&") & (F.length(p) > 1)
    decoded = F.transform(pieces, lambda p: F.when(is_reference(p), _decode_reference(p)).otherwise(p))
    return F.when(c.contains("&"), F.array_join(decoded, "")).otherwise(c)


def has_tag(c: Column) -> Column:
    return c.rlike(HAS_TAG)


def squeeze(c: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return strip(F.regexp_replace(c, WHITESPACE_CLASS + "+", " "))


def html_to_text(c: Column) -> Column:
    """The text of a page; text without any tag is returned as it is."""
    return F.when(has_tag(c), squeeze(_without_markup(c))).otherwise(c)


def without_markup(c: Column) -> Column:
    """As ``html_to_text``, with white space as it is left: the words are the same."""
    return F.when(has_tag(c), _without_markup(c)).otherwise(c)


def _without_markup(c: Column) -> Column:
    return let(F.regexp_replace(c, NOT_TEXT, " "), decode_entities)


# One root element, after any declarations and comments, closed by the last tag.
_OUTSIDE = r"\s*(?:<!--.*?-->\s*|<\?.*?\?>\s*|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>\s*)*"
_CLOSED_ROOT = rf"(?s)^{_OUTSIDE}<([A-Za-z_][\w:.-]*)[^>]*>.*</\1\s*>{_OUTSIDE}\z"


def xml_id_texts(c: Column) -> Column:
    """The ids of the first id list in a search response as written; NULL where there is none.

    Built-in XPath stops the job on one malformed record, a pattern does not. A
    response whose root element is not closed at the end is taken as malformed; tags
    that cross each other inside it are not noticed.
    """
    block = F.regexp_extract(c, r"(?s)<IdList(?:\s[^>]*)?(?:/>|>(.*?)</IdList\s*>)", 1)
    ids = F.regexp_extract_all(block, F.lit(r"<Id(?:\s[^>]*)?>([^<]+)</Id\s*>"), F.lit(1))
    return F.when(c.rlike(_CLOSED_ROOT) & (block != ""), ids)


def xml_ids(c: Column) -> Column:
    return F.transform(xml_id_texts(c), strip)


def first_count(c: Column) -> Column:
    """The number in the first ``<Count>`` element; NULL where there is none."""
    return first_int(c, COUNT)


def page_heading(html: Column) -> Column:
    """The text that directly follows the first ``h1`` tag; NULL where there is none."""
    return F.nullif(
        F.regexp_extract(html, r"(?i)<h1(?:\s[^>]*)?>([^<]+)", 1), F.lit("")
    )


def embedded_json(html: Column, element_id: str) -> Column:
    """The body of the script element with an id; NULL where there is none."""
    pattern = rf'(?is)<script\b[^>]*\bid="{element_id}"[^>]*>(.*?)</script\s*>'
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
