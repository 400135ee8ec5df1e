"""Windows of bytes and their digits, for use inside tasks.

A window is ``width`` bytes that start at one place. Each window is read from its anchor outwards: the anchor is the place
in it whose gram (a quarter of the window) has the least hash, the first of equal ones, so it depends on the window's bytes
alone. Neighbouring windows mostly have one anchor; they are one item: the anchor's place, and the range of ``lead``, the
bytes of a window before its anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from struct import Struct

import numpy as np

from canteiro.llm.shingles import mixed

# windows looked at in one go
CHUNK = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mixed(np.arange(256, dtype=np.uint64))
_SPAN = Struct("<HH")
# bits of a lead in a spot
_LEAD = 12


def _powers(base: int) -> np.ndarray:
    table = np.full(CHUNK + (1 << _LEAD) * 2, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


_UP: list[np.ndarray] = []


def _grams(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram."""
    if not _UP:
        _UP.extend((_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))))
    up, down = _UP
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * down[: len(raw) - gram + 1])


def anchors(data: bytes, width: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(gram's hash, place, first start, last start) of the runs of windows with one anchor, in parts of a long text."""
    reach = width - gram + 1
    for begin in range(0, len(data) - width + 1, CHUNK):
        raw = np.frombuffer(data, dtype=np.uint8)[begin : begin + CHUNK + width - 1]
        hashes = _grams(raw, gram)
        # the least hash of each window, with its place in the low bits
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        span, n = 1, len(hashes) - reach + 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:n], least[reach - span : reach - span + n])
        places = (least & _PLACE).astype(np.int64)
        cuts = np.flatnonzero(np.diff(places)) + 1
        first = np.append(0, cuts)
        last = np.append(cuts, n) - 1
        at = places[first]
        yield hashes[at].view(np.int64), at + begin, first + begin, last + begin


def spot(place: int, low: int, high: int) -> int:
    """An item's place and its range of leads in one number."""
    return place << 2 * _LEAD | low << _LEAD | high


def unspot(number: int) -> tuple[int, int, int]:
    mask = (1 << _LEAD) - 1
    return number >> 2 * _LEAD, number >> _LEAD & mask, number & mask


def key(kind: bytes, low: int, high: int, data: bytes) -> int:
    """64-bit key of bytes and the range of leads that they stand for; keys of two kinds have nothing in common."""
    return int.from_bytes(blake2b(_SPAN.pack(low, high) + data, digest_size=8, person=kind).digest(), "little", signed=True)


def whole_key(data: bytes, place: int, low: int, high: int, width: int, base: int = 0) -> int:
    """Key of all bytes that the windows with these leads cover."""
    return key(b"whole", low, high, data[place - high + 1 - base : place - low + width - base])


def common_key(data: bytes, place: int, low: int, high: int, width: int, base: int = 0) -> int:
    """Key of the bytes that every window with these leads has."""
    return key(b"common", low, high, data[place - low - base : place - high + 1 + width - base])


def cut(low: int, high: int, ways: int) -> list[tuple[int, int]]:
    """A range in parts, the same for everyone."""
    ends = sorted({low + (high - low) * k // ways for k in range(ways + 1)})
    return list(zip(ends[:-1], ends[1:], strict=True))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out
