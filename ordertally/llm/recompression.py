"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A round first replaces each run of one symbol by a symbol for the run, then each pair of a
left symbol followed by a right one by a symbol for the pair; a bit of a symbol's own name
says which of the two it is. New names are hashes of what they stand for, so they are the
same wherever they arise, in every task, and no table of names is needed. What a symbol
becomes depends on its neighbours alone, so equal stretches of words get equal symbols but
for some at their ends.

Each symbol carries the stretch of words that its making looked at: wherever that stretch
occurs again, the same symbol arises at the same place in it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ordertally.llm.words import mixed, paired

# Beyond any text: what depends on where a text begins or ends is bound to no words.
_FAR = np.int64(2**40)


@dataclass
class Symbols:
    names: np.ndarray
    text: np.ndarray  # which text each is in
    low: np.ndarray  # the stretch of words looked at, from
    high: np.ndarray  # and up to, by number of the word in all texts

    def take(self, keep: np.ndarray) -> Symbols:
        return Symbols(self.names[keep], self.text[keep], self.low[keep], self.high[keep])


def _before(symbols: Symbols) -> np.ndarray:
    """Where the looked-at stretch of the symbol before begins; far off at a text's start."""
    out = np.full(len(symbols.names), -_FAR)
    inner = symbols.text[1:] == symbols.text[:-1]
    out[1:][inner] = symbols.low[:-1][inner]
    return out


def _after(symbols: Symbols) -> np.ndarray:
    out = np.full(len(symbols.names), _FAR)
    inner = symbols.text[1:] == symbols.text[:-1]
    out[:-1][inner] = symbols.high[1:][inner]
    return out


def _name_runs(symbols: Symbols) -> Symbols:
    count = len(symbols.names)
    same = (symbols.names[1:] == symbols.names[:-1]) & (symbols.text[1:] == symbols.text[:-1])
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    last = np.append(first[1:], count) - 1
    lengths = (last - first + 1).astype(np.uint64)
    names = symbols.names[first]
    names = np.where(lengths > 1, paired(names, lengths + np.uint64(2**32)), names)
    low = np.minimum(symbols.low[first], _before(symbols)[first])
    high = np.maximum(symbols.high[last], _after(symbols)[last])
    return Symbols(names, symbols.text[first], low, high)


def _name_pairs(symbols: Symbols, turn: int) -> Symbols:
    right = (mixed(symbols.names + np.uint64(turn)) >> np.uint64(63)).astype(bool)
    joins = np.zeros(len(right) + 1, dtype=bool)  # this symbol with the one before it
    joins[1:-1] = right[1:] & ~right[:-1] & (symbols.text[1:] == symbols.text[:-1])
    first, second = joins[1:], joins[:-1]
    low = np.where(~first & right & ~second, np.minimum(symbols.low, _before(symbols)), symbols.low)
    high = np.where(~first & ~right, np.maximum(symbols.high, _after(symbols)), symbols.high)
    names = symbols.names.copy()
    at = np.flatnonzero(first)
    names[at] = paired(names[at], names[at + 1])
    low[at] = np.minimum(symbols.low[at], symbols.low[at + 1])
    high[at] = np.maximum(symbols.high[at], symbols.high[at + 1])
    return Symbols(names, symbols.text, low, high).take(~second)


def least_of_neighbours(symbols: Symbols, reach: int) -> Symbols:
    """The symbols whose scrambled name is less than those of `reach` neighbours each way.

    They look at what their neighbours look at.
    """
    ranks = mixed(symbols.names + np.uint64(97))
    keep = np.ones(len(ranks), dtype=bool)
    low, high = symbols.low.copy(), symbols.high.copy()
    for step in range(1, reach + 1):
        inner = symbols.text[step:] == symbols.text[:-step]
        keep[step:] &= inner & (ranks[step:] < ranks[:-step])
        keep[:-step] &= inner & (ranks[:-step] < ranks[step:])
        keep[:step] = False
        keep[len(keep) - step :] = False
        low[step:] = np.minimum(low[step:], symbols.low[:-step])
        high[:-step] = np.maximum(high[:-step], symbols.high[step:])
    return Symbols(symbols.names, symbols.text, low, high).take(keep)


def recompress(words: np.ndarray, first: np.ndarray, rounds: int) -> Symbols:
    """The symbols of texts after some rounds; `first` numbers each text's first word."""
    numbers = np.arange(len(words), dtype=np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    symbols = Symbols(words, text, numbers, numbers + 1)
    for turn in range(rounds):
        if not len(symbols.names):
            break
        symbols = _name_pairs(_name_runs(symbols), turn)
    return symbols
