"""Token ids of texts by a public tokenizer, a word at a time.

Both vocabularies in use split a text before they look anything up: none of their pieces
spans the border between a character that is no white space and white space after it. So the
ids of a text are those of its words, each with the blank or line break before it, one after
the other. Nor does a piece span the border between a letter or digit and the marks that
follow it at the word's end. A bounded memo keeps the ids of words already seen; new ones go
through the tokenizer together. Texts with other white space, or more of it between two
words, or at an end, are encoded whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
# Text encoded at a time: the more, the fewer distinct words in proportion.
SLICE_BYTES = 8 * 2**20
# Words of a generation in a Python worker's memo, which holds two; about 200 bytes a word.
MEMO_WORDS = 500_000
BRIEF_WORDS = 200_000
# Marks that no contraction contains.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Stands between words that are encoded together; a piece of its own in both vocabularies.
_MARK = "\x01"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _combines(texts: pa.Array) -> bool:
    """Whether combining marks may occur: some compose with small letters alone."""
    if texts.buffers()[2] is None:
        return False
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    start, end = offsets[texts.offset], offsets[texts.offset + len(texts)]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[start:end]
    return bool(np.any(data == 0xCC) or np.any(data == 0xCD))


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.memo_words = memo_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = sorted({token.content for token in added if token.content})
        self.mark = np.frombuffer(self.whole([" " + _MARK])[0], dtype="<u4")
        self.caseless = self.whole(["ABC Xyz Q"]) == self.whole(["abc xyz q"])
        # Of each word the ids; 0 for a word that does not stand alone.
        self.memo: dict[str, bytes | int] = {}
        self.older: dict[str, bytes | int] = {}
        self.tails: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _spells_added(self, word: str) -> bool:
        return any(content in word for content in self.added)

    def _with_added(self, texts: pa.Array) -> np.ndarray:
        """Which texts spell out an added token."""
        found = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            found |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        return found

    def _learn(self, words: set[str]) -> None:
        """Take words into the memo; those that are new go through the tokenizer as one text."""
        memo, older = self.memo, self.older
        new, ended = [], []
        for word in words:
            known = older.get(word)
            if known is not None:
                memo[word] = known
            elif not word or word[-1].isspace() or _MARK in word or self._spells_added(word):
                memo[word] = 0
            else:
                stem = word.rstrip(_MARKS)
                # A last letter can have a small form that ends in a combining mark.
                if stem != word and stem and all(c.isalnum() for c in stem[-1].lower()):
                    ended.append((word, stem))
                    if stem in memo or stem in words:
                        continue
                    word = stem
                    if (known := older.get(stem)) is not None:
                        memo[stem] = known
                        continue
                new.append(word)
        new = list(dict.fromkeys(new))
        if new:
            pieces = [word if word[0] == "\n" else " " + word for word in new]
            data = self.whole([f" {_MARK}".join(pieces) + f" {_MARK}"])[0]
            borders = np.flatnonzero(np.frombuffer(data, dtype="<u4") == self.mark[-1])
            after = 4 * (borders + 1)
            starts = np.concatenate(([0], after[:-1])).tolist()
            ends = (after - 4 * len(self.mark)).tolist()
            for word, start, end in zip(new, starts, ends, strict=True):
                memo[word] = data[start:end]
        for word, stem in ended:
            tail = word[len(stem) :]
            if tail not in self.tails:
                if len(self.tails) >= MEMO_WORDS:
                    self.tails.clear()
                self.tails[tail] = self.whole([tail])[0]
            memo[word] = memo[stem] + self.tails[tail]

    def _known(self, words: list[str]) -> list[bytes | int]:
        """The ids of distinct words."""
        if len(self.memo) > self.memo_words:
            self.older, self.memo = self.memo, {}
        ids = list(map(self.memo.get, words))
        missing = [i for i, known in enumerate(ids) if known is None]
        if missing:
            self._learn({words[i] for i in missing})
            for i in missing:
                ids[i] = self.memo[words[i]]
        return ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        given = texts
        added = self._with_added(given)
        if self.caseless and not _combines(texts):
            texts = pc.ascii_lower(texts)
            # What only becomes one by small letters is none: it must not be looked up so.
            added |= self._with_added(texts)
        # A line break opens a word as a blank does, and stays with it.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        borders = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten()
        coded = words.dictionary_encode()
        ids = self._known(coded.dictionary.to_pylist())
        numbers = coded.indices
        odd = np.array([type(one) is int for one in ids])[numbers.to_numpy()]
        parts = pa.array([b"" if type(one) is int else one for one in ids], pa.large_binary())
        joined = parts.take(numbers)
        offsets = np.frombuffer(joined.buffers()[1], np.int64, len(words) + 1, 8 * joined.offset)
        data = memoryview(joined.buffers()[2] or b"")
        # Nothing stands before the first word, so the memo does not serve it.
        heads = words.take(pa.array(borders[:-1])).to_pylist()
        after = borders[:-1] + 1
        seen = np.concatenate(([0], np.cumsum(odd)))
        whole = seen[borders[1:]] > seen[after]
        starts, ends = offsets[after].tolist(), offsets[borders[1:]].tolist()
        out: list[bytes] = []
        singly = []
        distinct = list(dict.fromkeys(heads))
        head_ids = dict(zip(distinct, self.whole(distinct), strict=True))
        for i, head in enumerate(map(head_ids.__getitem__, heads)):
            first = heads[i]
            if added[i] or whole[i] or first[-1:].isspace() or (not first and after[i] < borders[i + 1]):
                singly.append(i)
            out.append(head + data[starts[i] : ends[i]])
        if singly:
            rest = given.take(pa.array(singly)).to_pylist()
            for i, found in zip(singly, self.whole(rest), strict=True):
                out[i] = found
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One to a worker and vocabulary, with its memo."""
    return Encoder(path)
