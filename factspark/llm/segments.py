"""Where tokens start in a flat array of UTF-8 bytes, found without a loop over texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_WORD_BREAK = np.zeros(256, bool)
_WORD_BREAK[[0x20, *range(0x09, 0x0E)]] = True

#: Classes of characters for the byte-level pattern.
BLANK, SPACE, LETTER, NUMBER, OTHER = range(5)
_EDGE = 9


def words(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``[^\\x20\\x09-\\x0D]``; ``bounds`` part texts."""
    return runs_of(~_WORD_BREAK[flat], bounds)


def runs_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values that no bound parts."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(inside))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def characters(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The position and the code point of each character."""
    positions = np.flatnonzero((flat & 0xC0) != 0x80)
    lead = flat[positions]
    points = lead.astype(np.int32)
    padded = np.concatenate([flat, np.zeros(4, np.uint8)])
    for low, high, extra in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        rows = np.flatnonzero((lead >= low) & (lead < high))
        value = lead[rows].astype(np.int32) & (0x3F >> extra)
        for k in range(1, extra + 1):
            value = (value << 6) | (padded[positions[rows] + k] & 0x3F)
        points[rows] = np.minimum(value, 0x10FFFF)
    return positions, points


@lru_cache(1)
def character_classes() -> np.ndarray:
    """The class of every code point, as the tokenizers library sees it.

    Letters, numbers and white space lie in the first four planes of Unicode.
    """
    from tokenizers import Regex, pre_tokenizers

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000)]))
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, code in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        found = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True).pre_tokenize_str(everything)
        classes[[ord(c) for piece, _ in found for c in piece]] = code
    classes[0x20] = BLANK
    return classes


def byte_level(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the pieces of the byte-level pattern; each piece ends where the next starts.

    Pieces are runs of letters, of numbers or of other characters, each with one blank
    before it, the short English endings after an apostrophe, and what is left of runs
    of white space.
    """
    if not len(flat):
        return np.zeros(0, np.int64)
    if flat.max() < 0x80:
        positions, points = None, flat
        first = bounds[:-1][np.diff(bounds) > 0]
    else:
        positions, points = characters(flat)
        first = np.searchsorted(positions, bounds[:-1][np.diff(bounds) > 0])
    cls = character_classes()[points]
    n = len(cls)
    opens = np.zeros(n + 1, bool)
    opens[first] = True
    opens[n] = True
    before = np.empty_like(cls)
    before[1:] = cls[:-1]
    before[opens[:-1]] = _EDGE
    after = np.empty_like(cls)
    after[:-1] = cls[1:]
    after[opens[1:]] = _EDGE
    white = cls <= SPACE
    starts = np.where(
        white,
        (before > SPACE) | ((after > SPACE) & (after != _EDGE)),
        (before != cls) & (before != BLANK),
    )
    _endings(points, starts, cls, opens)
    found = np.flatnonzero(starts)
    return found if positions is None else positions[found]


def _endings(points: np.ndarray, starts: np.ndarray, cls: np.ndarray, opens: np.ndarray) -> None:
    """Join 's 't 'm 'd 're 've 'll to one piece where the apostrophe starts one."""
    marks = np.flatnonzero((points == 0x27) & starts)
    n = len(points)
    marks = marks[marks + 1 < n]
    marks = marks[~opens[marks + 1]]
    one, second = points[marks + 1], np.minimum(marks + 2, n - 1)
    two = points[second]
    single = np.isin(one, [0x73, 0x74, 0x6D, 0x64])
    double = ((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))
    double &= (marks + 2 < n) & ~opens[second]
    for hit, size in ((single, 1), (double, 2)):
        at = marks[hit]
        starts[at + 1] = False
        rest = at + size + 1
        rest = rest[rest < n]
        starts[rest] |= cls[rest] == LETTER


def blank_led(flat: np.ndarray, bounds: np.ndarray, joinable: np.ndarray) -> np.ndarray:
    """Starts of pieces that begin with a run of blanks, or are one character that joins nothing.

    ``joinable`` tells for each code point if any longer vocabulary entry holds it.
    """
    if not len(flat):
        return np.zeros(0, np.int64)
    positions, points = characters(flat)
    blank = points == 0x20
    alone = ~joinable[points]
    starts = alone.copy()
    starts[1:] |= alone[:-1] | (blank[1:] & ~blank[:-1])
    starts[np.searchsorted(positions, bounds[:-1][np.diff(bounds) > 0])] = True
    return positions[starts]
