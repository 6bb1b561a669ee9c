"""String functions that follow Python's rules where Spark's built-ins differ."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() take as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"[\x09-\x0d\x1c-\x1f\x85\p{Z}]"

# Where a cased letter follows something else.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
LETTER_AFTER_OTHER = rf"(?<=[^{_CASED}])(?=[{_CASED}])"
_MARK = "\x02 "


def strip(c: Column) -> Column:
    """Remove white space, of any kind, from both ends (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def title_case(c: Column) -> Column:
    """A capital after every non-letter: ``maine-coon`` is ``Maine-Coon``.

    ``initcap`` sees words between blanks only, so each run of letters gets a marked
    blank before it, which is taken out again.
    """
    apart = F.regexp_replace(c, LETTER_AFTER_OTHER, _MARK)
    return F.replace(F.initcap(apart), F.lit(_MARK), F.lit(""))


def split_strip(c: Column, sep: str) -> Column:
    """Split on a literal separator and strip each part."""
    return F.transform(F.split(c, rf"\Q{sep}\E"), strip)


def before_first(c: Column, sep: str) -> Column:
    """The text before the first separator; all of it where there is none."""
    return F.substring_index(c, sep, 1)


def after_first(c: Column, sep: str) -> Column:
    """The text after the first separator; NULL where there is none."""
    place = F.instr(c, sep)
    return F.when(place > 0, F.substr(c, place + len(sep)))


def words(c: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(c, WHITESPACE_CLASS + "+"), lambda w: w != "")


def without_prefix(c: Column, prefix: str) -> Column:
    """Drop as many leading characters as ``prefix`` has."""
    return F.substr(c, F.lit(len(prefix) + 1))


def tag(label: str | Column, value: Column) -> Column:
    """A fact string ``LABEL:value``."""
    label = F.lit(label) if isinstance(label, str) else label
    return F.concat(label, F.lit(":"), value)


def feature_tag(key: Column, value: Column) -> Column:
    """A fact string ``FEATURE:key=value``."""
    return F.concat(F.lit("FEATURE:"), key, F.lit("="), value)


def first_int(c: Column, pattern: str) -> Column:
    """The number in the pattern's first group; NULL where it does not match or fit."""
    return F.regexp_extract(c, pattern, 1).try_cast("bigint")


def concat_or_empty(*cols: Column, sep: str = " ") -> Column:
    """Join with a separator, NULL counting as the empty text."""
    return F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in cols])


def first_present(*cols: Column, default: str | None = None) -> Column:
    """The first value that is neither NULL nor empty, else ``default``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(default))


def array_where(*pairs: tuple[Column, Column]) -> Column:
    """An array of the values whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(cond, value) for cond, value in pairs]))


def sorted_set(c: Column) -> Column:
    """The distinct elements in code-point order."""
    return F.sort_array(F.array_distinct(c))


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, for a costly value that is used several times."""
    return F.get(F.transform(F.array(c), use), F.lit(0))
