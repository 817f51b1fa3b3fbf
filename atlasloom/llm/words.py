"""Words of whole texts as numpy arrays, straight from the bytes of an Arrow string column.

A word is a run of bytes outside [\\x20\\x09-\\x0D]; those are ASCII, so byte runs and code point runs agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mixed

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: An odd multiplier for the byte positions, and a 64-bit value for each byte.
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}
#: Bytes whose positions are hashed at once; what a worker keeps is bounded by it, whatever the length of a text.
BLOCK = 1 << 20


def _positions(step: int, n: int) -> np.ndarray:
    """Powers of step, modulo 2**64."""
    if len(_powers.get(step, ())) < n:
        more = np.full(n, step, np.uint64)
        more[0] = 1
        np.multiply.accumulate(more, out=more)
        _powers[step] = more
    return _powers[step][:n]


@dataclass
class Spans:
    """Byte ranges and their 64-bit hashes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    value: np.ndarray


class Texts:
    """The texts of one slice: raw bytes with row offsets that begin at 0."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = _LOWER[raw] if lower else raw
        self.offsets = offsets
        self.rows = len(offsets) - 1
        self.space = _SPACE[self.raw]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of ascending ranges. Equal bytes give equal values wherever they stand, in any slice: the sums are moved back to position 0."""
        out, n = np.zeros(len(start), np.uint64), len(self.raw)
        for low in range(0, n + 1, BLOCK):
            a, b = np.searchsorted(start, [low, low + BLOCK])
            if a == b:
                continue
            high = min(n, low + BLOCK)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE[self.raw[low:high]] * _positions(_STEP, min(n, BLOCK) + 1)[: high - low], out=sums[1:])
            first, last = start[a:b] - low, np.minimum(end[a:b], high) - low
            out[a:b] = (sums[last] - sums[first]) * _positions(_BACK, min(n, BLOCK) + 1)[first]
            for i in np.flatnonzero(end[a:b] > high).tolist():  # ranges that go on in later blocks: one at most, as ranges do not overlap
                out[a + i] = self._rest(int(start[a + i]), int(end[a + i]), high, int(out[a + i]))
        return mixed(out + (end - start).astype(np.uint64))

    def _rest(self, start: int, end: int, at: int, total: int) -> int:
        """The sum of a range of which `total` is the part before `at`."""
        for low in range(at, end, BLOCK):
            part = self.raw[low : min(end, low + BLOCK)]
            total += int((_BYTE[part] * _positions(_STEP, BLOCK + 1)[: len(part)]).sum()) * pow(_STEP, low - start, 1 << 64)
        return total % (1 << 64)

    def words(self) -> Spans:
        n = len(self.raw)
        begins = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        inside = ~self.space
        first = inside.copy()
        first[1:] &= self.space[:-1]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= self.space[1:]
        ends = self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1
        last[ends] = inside[ends]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(self.offsets, start, side="right") - 1 if n else np.zeros(0, np.int64)
        return Spans(start, end, row, self.hashes(start, end))

    def lines(self) -> Spans:
        """Parts between newlines; a text without any is one line, and an empty text one empty line."""
        cut = np.flatnonzero(self.raw == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], cut + 1]), kind="stable")
        end = np.sort(np.concatenate([cut, self.offsets[1:]]), kind="stable")
        row = np.repeat(np.arange(self.rows), 1 + np.diff(np.searchsorted(cut, self.offsets)))
        return Spans(start, end, row, self.hashes(start, end))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys
