"""Counting quotient filters over packed n-grams of word ids, in numpy.

An n-gram of ids of ``bits`` bits is packed into a key of n * bits bits and permuted by an invertible mix, so that keys are
spread evenly. The top bits of the permuted key are its *quotient*, all other bits its *remainder*. A filter keeps, in order of the
permuted keys, the length of each quotient's run (unary), the remainders and the counts. Nothing is cut from a
remainder, so the keys come back and counts are exact.

Keys are pairs (high, low) of unsigned 64-bit arrays, low with up to 64 bits, high with the rest (up to 32).
"""

from __future__ import annotations

import struct

import numpy as np

MOST_ID_BITS = 32
# Odd multipliers of the mix, any odd numbers would do.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_HEADER = struct.Struct("<BBBqqq")  # bits of a key, bits of a quotient, bytes of a remainder, first quotient, quotients, entries
# A count of this byte stands in the list of large counts.
_LARGE = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _split(bits: int) -> tuple[int, int]:
    """Bits of the high and the low half of a key."""
    low = min(bits, 64)
    return bits - low, low


def pack(ids: list[np.ndarray], id_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of n-grams, given the ids at each of their n places; the first id has the top bits."""
    if id_bits > MOST_ID_BITS or len(ids) > 3:
        raise ValueError(f"no room for {len(ids)} ids of {id_bits} bits")
    low = np.zeros(len(ids[0]), np.uint64)
    high = np.zeros(len(ids[0]), np.uint64)
    for i, column in enumerate(reversed(ids)):
        column, at = column.astype(np.uint64), i * id_bits
        if at < 64:
            low |= column << np.uint64(at)
        if at + id_bits > 64:
            high |= column >> np.uint64(64 - at) if at < 64 else column << np.uint64(at - 64)
    return high, low


def unpack(high: np.ndarray, low: np.ndarray, n: int, id_bits: int) -> list[np.ndarray]:
    """The ids at each place; the inverse of :func:`pack`."""
    ids = []
    for i in reversed(range(n)):
        at = i * id_bits
        column = low >> np.uint64(at) if at < 64 else high >> np.uint64(at - 64)
        if at < 64 < at + id_bits:
            column = column | (high << np.uint64(64 - at))
        ids.append((column & _mask(id_bits)).astype(np.int64))
    return ids


def _mix(low: np.ndarray, bits: int, undo: bool) -> np.ndarray:
    """Invertible mix of numbers of ``bits`` bits: shift-xors and multiplications by odd numbers."""
    mask, shift = _mask(bits), np.uint64(max(bits // 2, 1) if bits > 1 else 1)
    for multiplier in reversed(_MULTIPLIERS) if undo else _MULTIPLIERS:
        factor = np.uint64(multiplier & int(mask))
        if undo:
            low = (low * np.uint64(pow(int(factor), -1, 1 << bits))) & mask
            low = _unxor(low, int(shift), bits)
        else:
            low = low ^ (low >> shift)
            low = (low * factor) & mask
    return low


def _unxor(value: np.ndarray, shift: int, bits: int) -> np.ndarray:
    out, done = value, shift
    while done < bits:
        out = value ^ (out >> np.uint64(shift))
        done += shift
    return out


def _round(low: np.ndarray, bits: int) -> np.ndarray:
    return (low * np.uint64(_MULTIPLIERS[1]) >> np.uint64(64 - bits)) if bits else np.zeros_like(low)


def permute(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spread keys of ``bits`` bits evenly; :func:`restore` gives them back."""
    high_bits, low_bits = _split(bits)
    low = _mix(low, low_bits, False)
    if high_bits:
        high = high ^ _round(low, high_bits)
        low = low ^ _mix(high, 64, False)
        high = high ^ _round(low, high_bits)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    high_bits, low_bits = _split(bits)
    if high_bits:
        high = high ^ _round(low, high_bits)
        low = low ^ _mix(high, 64, False)
        high = high ^ _round(low, high_bits)
    return high, _mix(low, low_bits, True)


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts (1 each where none are given)."""
    if not len(low):
        return high, low, np.zeros(0, np.uint64)
    narrow = not high.any()
    if narrow and counts is None:
        low = np.sort(low)
        high = np.zeros_like(low)
    else:
        # Counts that are given come in few sorted runs, which the stable sort only merges.
        order = np.argsort(low, kind="stable") if narrow else np.lexsort((low, high))
        high, low = high[order], low[order]
        counts = None if counts is None else counts[order]
    first = np.empty(len(low), bool)
    first[0] = True
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(first)
    if counts is None:
        totals = np.diff(np.append(at, len(low))).astype(np.uint64)
    else:
        totals = np.add.reduceat(counts, at)
    return high[at], low[at], totals


def top_bits(high: np.ndarray, low: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The top ``n`` (at most 32) bits of keys of ``bits`` bits."""
    high_bits, low_bits = _split(bits)
    if n <= high_bits:
        return high >> np.uint64(high_bits - n)
    rest = n - high_bits
    part = low >> np.uint64(low_bits - rest) if rest < 64 else low
    return (high << np.uint64(rest)) | part


def encode(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int, first_part: int, part_bits: int) -> bytes:
    """A filter of distinct permuted keys in order, all within part ``first_part`` of the 2**part_bits that their top bits name."""
    n = len(low)
    quotient_bits = max(part_bits, min(bits, 32, part_bits + max(n, 1).bit_length()))
    spread = quotient_bits - part_bits
    first, slots = first_part << spread, 1 << spread
    quotients = (top_bits(high, low, bits, quotient_bits).astype(np.int64) - first) if quotient_bits else np.zeros(n, np.int64)
    # Unary run lengths: a 1 for each entry, a 0 after each quotient's run.
    runs = np.zeros(n + slots, np.uint8)
    runs[np.arange(n) + quotients] = 1
    high_bits, low_bits = _split(bits)
    remainder_bits = bits - quotient_bits
    size = -(-remainder_bits // 8)
    rest_high = high & _mask(max(high_bits - quotient_bits, 0))
    rest_low = low & _mask(min(low_bits, remainder_bits))
    wide = np.empty((n, 16), np.uint8)
    wide[:, :8] = rest_low.astype("<u8").view(np.uint8).reshape(n, 8)
    wide[:, 8:] = rest_high.astype("<u8").view(np.uint8).reshape(n, 8)
    small = np.minimum(counts, _LARGE).astype(np.uint8)
    large = counts[small == _LARGE].astype("<u8")
    return b"".join((_HEADER.pack(bits, quotient_bits, size, first, slots, n), np.packbits(runs).tobytes(), wide[:, :size].tobytes(), small.tobytes(), large.tobytes()))


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, counts) of a filter, in order of the permuted keys."""
    bits, quotient_bits, size, first, slots, n = _HEADER.unpack_from(data)
    at = _HEADER.size
    n_runs = -(-(n + slots) // 8)
    runs = np.unpackbits(np.frombuffer(data, np.uint8, n_runs, at), count=n + slots)
    quotients = (np.flatnonzero(runs) - np.arange(n) + first).astype(np.uint64)
    at += n_runs
    wide = np.zeros((n, 16), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    at += n * size
    low = wide[:, :8].copy().view("<u8").reshape(n).astype(np.uint64)
    high = wide[:, 8:].copy().view("<u8").reshape(n).astype(np.uint64)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
    large = np.flatnonzero(counts == _LARGE)
    counts[large] = np.frombuffer(data, "<u8", len(large), at + n)
    high_bits, low_bits = _split(bits)
    if quotient_bits <= high_bits:
        high |= quotients << np.uint64(high_bits - quotient_bits)
    else:
        below = quotient_bits - high_bits
        if high_bits:
            high |= quotients >> np.uint64(below)
        low |= (quotients & _mask(below)) << np.uint64(low_bits - below)
    return high, low, counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of filters: distinct permuted keys in order with their counts over all filters."""
    parts = [decode(data) for data in filters]
    high, low, counts = (np.concatenate([part[i] for part in parts]) if parts else np.zeros(0, np.uint64) for i in range(3))
    return summed(high, low, counts)
