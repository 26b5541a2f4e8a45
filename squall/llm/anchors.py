"""Content-defined anchors: for every string of a given length, one place inside it that
depends on the string alone.

The anchor of a window of ``length`` bytes is the start of its ``gram``-byte substring
with the smallest hash (the leftmost of equals). Equal windows have equal anchors, so
whatever equal windows share can be found among rows that share an anchor's gram; about
two anchors fall on every ``length - gram`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

_U = np.uint64
#: bits that hold a place within a chunk
PLACE = 22
CHUNK = 1 << 20


def _splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    z = np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


@dataclass
class Anchored:
    """Anchors of some texts, in order: arrays of equal length.

    ``text``: which text; ``place``: byte of the anchor; the windows that share it
    reach from ``place - left`` to ``place + right``; ``gram``: hash of the gram;
    ``segment``: hash of everything between these two and of the anchor's place in it.
    """

    text: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gram: np.ndarray
    segment: np.ndarray


class Anchors:
    def __init__(self, length: int, gram: int):
        if not 0 < gram <= length:
            raise ValueError("the gram must fit into the window")
        self.length, self.gram = length, gram
        size = CHUNK + length + 1
        base, inverse = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
        self.values = _splitmix(256, 7)
        self.up, self.down = (np.full(size, b, np.uint64) for b in (base, inverse))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.cumprod(powers, out=powers)

    def __call__(self, texts: Iterable[bytes]) -> Iterator[Anchored]:
        """Anchors of all windows inside the texts, piece by piece of bounded size."""
        held, size = [], 0
        for t, text in enumerate(texts):
            for begin in range(0, len(text) - self.length + 1, CHUNK // 2):
                piece = text[begin : begin + CHUNK // 2 + self.length - 1]
                if size + len(piece) > CHUNK:
                    yield self._anchored(held)
                    held, size = [], 0
                held.append((t, begin, piece))
                size += len(piece)
        if held:
            yield self._anchored(held)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums from which any substring's hash follows."""
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[begin]) * self.down[begin]

    def _anchored(self, pieces: list[tuple[int, int, bytes]]) -> Anchored:
        data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
        n, k = len(data), self.gram
        sums = self.sums(data)
        grams = (sums[k:] - sums[:-k]) * self.down[: n - k + 1]
        low = _U((1 << PLACE) - 1)
        order = (mix(grams) & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = (sliding_min(order, self.length - k + 1) & low).astype(np.int64)
        sizes = np.array([len(p) for _, _, p in pieces])
        first = np.cumsum(sizes) - sizes
        count = sizes - self.length + 1  # windows inside each piece
        which = np.repeat(np.arange(len(pieces)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which]
        place = least[start]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (which[1:] != which[:-1])]))
        begin, place, which = start[new], place[new], which[new]
        end = start[np.concatenate([new[1:], [len(start)]]) - 1] + self.length
        offset = np.array([b for _, b, _ in pieces])[which] - first[which]
        left, right = place - begin, end - place
        segment = self.hashes(sums, begin, end) + left.astype(np.uint64) * _U(0xA0761D6478BD642F)
        segment += right.astype(np.uint64) * _U(0xE7037ED1A0B428DB)
        return Anchored(
            np.array([t for t, _, _ in pieces])[which], place + offset, left, right, mix(grams[place]), mix(segment)
        )
