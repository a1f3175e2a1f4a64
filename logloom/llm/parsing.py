"""Content-defined phrases of byte strings: the parsing step of duplicate removal.

A trigger is the place of the smallest rolling hash of ``GRAM`` bytes among those of a window of ``LENGTH`` bytes, the last one of equals. It depends on
the window's bytes alone, so that equal windows have their trigger at the same place, and every window has one. Consecutive windows with one
trigger make a phrase: it owns these windows' starts, and its bytes reach to the end of the last window. Phrases
overlap by LENGTH - 1 bytes, each window lies in exactly one, and no phrase is a proper prefix of what another one with its trigger owns.

A phrase's key is the hash of the trigger with REACH bytes more on the side where all its windows have them. Windows that reach so far to
the left make one phrase, the others, which all reach so far to the right, the next. In a large corpus nearly every GRAM bytes
occur somewhere else, but GRAM + REACH bytes hardly do unless a passage is repeated.
"""

from __future__ import annotations

import numpy as np

LENGTH = 50
GRAM = 16
REACH = (LENGTH - GRAM) // 2
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each place on (the last GRAM - 1 places have none), of parts with doubled lengths."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[0]
    h ^= h >> np.uint64(29)
    whole, length, span, rest = None, 0, 1, GRAM
    for multiplier in _MULTIPLIERS:
        if rest & 1:
            whole = h if whole is None else _joined(h, whole, span, multiplier)
            length += span
        rest >>= 1
        if not rest:
            break
        h = _joined(h, h, span, multiplier)
        span *= 2
    whole = whole * _MULTIPLIERS[0]
    return whole ^ (whole >> np.uint64(32))


def _joined(first: np.ndarray, second: np.ndarray, span: int, multiplier: np.uint64) -> np.ndarray:
    """Hashes of parts of ``span`` bytes, each with the part that follows it."""
    n = min(len(first), len(second) - span)
    h = first[:n] * multiplier + second[span : span + n]
    return h ^ (h >> np.uint64(31))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _reaching(h: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hash of the GRAM + REACH bytes from each of the places on, of parts that overlap; the parts are hashed already."""
    whole = h[place] * _MULTIPLIERS[1] + h[place + REACH]
    whole ^= whole >> np.uint64(31)
    whole = whole * _MULTIPLIERS[2] + h[place + REACH - 1]
    whole = (whole ^ (whole >> np.uint64(29))) * _MULTIPLIERS[0]
    return whole ^ (whole >> np.uint64(32))


def phrases(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, number of windows, key) of each phrase of texts that lie one after the other.

    ``ends`` has the end of each text; no window reaches over one. At most 2**24 bytes.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64)
    h = rolling_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    low = np.uint64(0xFFFFFF)
    least = _sliding_least((h & ~low) | (low - place), LENGTH - GRAM + 1)
    trigger = (low - (least & low)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    inside = np.cumsum(inside[: len(trigger)]) > 0
    left = trigger - np.arange(len(trigger)) >= REACH
    new = inside.copy()
    new[1:] &= (trigger[1:] != trigger[:-1]) | (left[1:] != left[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= new[1:] | ~inside[1:]
    new[starts[long]] = True
    at = np.flatnonzero(new)
    n = np.flatnonzero(last) - at + 1
    return at, n, _reaching(h, trigger[at] - np.where(left[at], REACH, 0))


def all_phrases(data: np.ndarray, ends: np.ndarray, most: int = 8 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``phrases`` of texts of any size, taken in parts. A cut splits a phrase in two that share its trigger."""
    if len(data) <= most:
        return phrases(data, ends)
    found = []
    for begin in range(0, len(data), most):
        part = data[begin : begin + most + LENGTH - 1]
        inner = np.unique(np.minimum(np.maximum(ends - begin, 0), len(part)))
        at, n, keys = phrases(part, inner[inner > 0] if len(inner[inner > 0]) and inner[-1] == len(part) else np.append(inner[inner > 0], len(part)))
        own = at < most
        found.append((at[own] + begin, np.minimum(n[own], most - at[own]), keys[own]))
    return tuple(np.concatenate(column) for column in zip(*found))


def suffix_groups(strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each LENGTH-byte string, whether an equal one belongs to a smaller document.

    The strings are suffixes of phrases cut at LENGTH bytes. They are put in order, and those whose common prefix with the one before is
    LENGTH bytes long are equal.
    """
    order = np.argsort(strings)
    ordered = strings[order]
    firsts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    least = np.minimum.reduceat(docs[order], firsts)
    out = np.zeros(len(strings), dtype=bool)
    out[order] = np.repeat(least, np.diff(np.append(firsts, len(strings)))) < docs[order]
    return out
