"""Words of many texts at once, as numbers.

A word is a run of bytes other than ASCII white space. Words get 64-bit hashes that depend
on their bytes alone, so they are the same in every task and every run.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_TAIL = np.array([2 ** (8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    numbers = (numbers ^ (numbers >> np.uint64(32))) * _B
    numbers = (numbers ^ (numbers >> np.uint64(32))) * _B
    return numbers ^ (numbers >> np.uint64(32))


def paired(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Numbers for ordered pairs."""
    return mixed(mixed(one + _A) * np.uint64(3) + other)


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, a blank between them
    starts: np.ndarray  # of words, in bytes
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each text, and of all words at last

    def hashes(self) -> np.ndarray:
        """One to each word; collisions of different words are as rare as 64 bits make them."""
        padded = np.concatenate((self.data, np.zeros(8, dtype=np.uint8)))
        blocks = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
        lengths = self.ends - self.starts
        out = mixed(lengths.astype(np.uint64) + _A)
        active = np.arange(len(out))
        at, left = self.starts, lengths
        while len(active):
            part = blocks[at] & _TAIL[np.minimum(left, 8)]
            out[active] = paired(out[active], part)
            keep = left > 8
            active, at, left = active[keep], at[keep] + 8, left[keep] - 8
        return out


def words_of(texts: list[str], lower: bool = False) -> Words:
    """`lower` makes small letters of A to Z, and of nothing else."""
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    if lower:
        encoded = [one.lower() for one in encoded]
    data = np.frombuffer(b" ".join(encoded), dtype=np.uint8)
    lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    borders = np.concatenate(([0], np.cumsum(lengths)))
    return Words(data, starts, ends, np.searchsorted(starts, borders))
