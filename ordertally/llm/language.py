"""Language identification by cross-parsing.

For each language a suffix automaton holds every substring of some labelled text. A text is
parsed against it from left to right into phrases, each the longest match there is (or one
letter that the labelled text lacks). The phrases of a text, normalised to bits per letter by
the logarithm of the labelled text's length, estimate its cross-entropy with the language;
the language that needs fewest wins, the first by name among equals.

Texts are composed (NFC), their letters made small, and everything between letters becomes
one blank. The whole of every text is parsed, in segments of `SEGMENT` letters, many at a
time in step. Matches go on over the borders of segments: where one does, the segment behind
the border is parsed again from there, up to the letter where it comes to the state that it
had by itself, so the phrases are those of the text as a whole, whatever the segments.

The automata are learned from at most `TRAIN_LETTERS` letters of each language, taken from
whole texts in an order by hash until the bound is reached, where the last one is cut: the
bound of the labelled sample. It is sized by the letters of distinct texts and drawn from
them, so copies and texts without letters take nothing from it; a language whose draw falls
short of the bound is drawn again with a larger share, up to all its texts. Null texts and texts without a letter are `und` with score 0,
as is every text if nothing was learned. A null key is never learned from and not held out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, slices

TRAIN_LETTERS = 40_000
SEGMENT = 256
_BLANK, _OTHER = 0, 1
# Characters that the JVM may not know yet (Cn) may be letters.
_NO_LETTER = r"[^\p{L}\p{Cn}]+"
_NO_PART = r"[^\p{L}\p{M}\p{Cn}]+"
_SHARPNESS = 4.0
_RESULT = "doc_id bigint, held_out boolean, lang_pred string, score double"


def suffix_automaton(codes: list[int], letters: int) -> np.ndarray:
    """The next state for each state and code, or -1; state 0 is the empty string."""
    edges: list[dict[int, int]] = [{}]
    links, depths = [-1], [0]
    last = 0
    for code in codes:
        new = len(edges)
        edges.append({})
        depths.append(depths[last] + 1)
        links.append(0)
        state = last
        while state >= 0 and code not in edges[state]:
            edges[state][code] = new
            state = links[state]
        if state >= 0:
            target = edges[state][code]
            if depths[target] == depths[state] + 1:
                links[new] = target
            else:
                copy = len(edges)
                edges.append(edges[target].copy())
                depths.append(depths[state] + 1)
                links.append(links[target])
                links[target] = links[new] = copy
                while state >= 0 and edges[state].get(code) == target:
                    edges[state][code] = copy
                    state = links[state]
        last = new
    table = np.full((len(edges), letters), -1, dtype=np.int32)
    for state, follow in enumerate(edges):
        for code, target in follow.items():
            table[state, code] = target
    return table


def letters_of(text: str) -> str:
    """Small letters, words apart by one blank."""
    text = unicodedata.normalize("NFC", text)
    small = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    return " ".join(small.split())


class Parser:
    def __init__(self, labelled: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in labelled]
        alphabet = sorted({c for _, text in labelled for c in text} - {" "})
        code_of = {c: k + 2 for k, c in enumerate(alphabet)}
        self.codes = np.zeros(0x110000, dtype=np.uint16)
        for number in range(0x110000):
            letter = chr(number)
            if letter.isalpha():
                self.codes[number] = code_of.get(letter.lower()[0], _OTHER)
        self.width = len(alphabet) + 2
        tables, self.bits = [], []
        for _, text in labelled:
            tables.append(suffix_automaton([code_of.get(c, _BLANK) for c in text], self.width))
            self.bits.append(np.log2(max(len(text), 2)))
        # One table for all languages; a state is the start of its row.
        sizes = np.cumsum([0, *(len(table) for table in tables)])
        self.roots = (sizes[:-1] * self.width).astype(np.int32)
        for table, size in zip(tables, sizes, strict=False):
            table[table >= 0] += size
        rows = np.concatenate(tables) if tables else np.zeros((0, self.width), np.int32)
        self.table = np.where(rows >= 0, rows * self.width, -1).astype(np.int32).ravel()

    def encode(self, text: str) -> np.ndarray:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        data = text.encode("utf-32-le", "surrogatepass")
        codes = self.codes[np.frombuffer(data, dtype="<u4")]
        keep = codes != _BLANK
        keep[1:] |= keep[:-1]  # the first blank after a letter stays
        return codes[keep]

    def _parse(self, codes: np.ndarray, lengths: np.ndarray, root: int):
        """Each segment by itself: states and phrases so far after each step. Segments are
        sorted, the longest first."""
        steps, total = codes.shape
        states = np.empty((steps, total), dtype=np.int32)
        counts = np.empty((steps, total), dtype=np.int32)
        state = np.full(total, root, dtype=np.int32)
        found = np.zeros(total, dtype=np.int32)
        active = np.searchsorted(-lengths, -np.arange(steps), "left")
        for step in range(steps):
            n = active[step]
            if n:
                state[:n], ended = self._step(state[:n], codes[step, :n], root)
                found[:n] += ended
            states[step], counts[step] = state, found
        return states, counts

    def _step(self, now: np.ndarray, code: np.ndarray, root: int):
        """The states after one more letter, and how many phrases have ended."""
        after = self.table[now + code]
        ended = np.flatnonzero(after < 0)
        found = np.zeros(len(now), dtype=np.int32)
        # A letter that no match goes on with begins the next phrase; one that the
        # language lacks is a phrase itself.
        found[ended] = now[ended] != root
        again = self.table[root + code[ended]]
        lacking = again < 0
        found[ended] += lacking
        again[lacking] = root
        after[ended] = again
        return after, found

    def phrases(self, encoded: list[np.ndarray]) -> np.ndarray:
        """For each text and language the number of phrases."""
        sizes = np.array([len(codes) for codes in encoded], dtype=np.int64)
        joined = np.concatenate((*encoded, np.zeros(SEGMENT, np.uint16)))
        counts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(encoded)), counts)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(np.cumsum(sizes) - sizes, counts) + turn * SEGMENT
        lengths = np.minimum(np.repeat(sizes, counts) - turn * SEGMENT, SEGMENT)
        order = np.argsort(-lengths, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        # The segment after each one in its text, or -1.
        goes_on = np.concatenate((turn[1:] > 0, [False])) if len(turn) else np.zeros(0, bool)
        after = np.where(goes_on, np.append(place[1:], -1) if len(place) else place, -1)[order]
        owner, starts, lengths = owner[order], starts[order], lengths[order]
        out = np.zeros((len(encoded), len(self.names)))
        if not len(owner):
            return out
        codes = joined[starts[None, :] + np.arange(SEGMENT)[:, None]].astype(np.int32)
        last = lengths - 1, np.arange(len(owner))
        for k, root in enumerate(self.roots):
            states, founds = self._parse(codes, lengths, root)
            own_ends, alone = states[last], founds[last].astype(np.int64)
            ends, totals = own_ends.copy(), alone.copy()
            # Where a match goes on over a border, the segment behind it is parsed again from
            # there, up to where it comes to the state that it had by itself.
            wrong = after[(ends != root) & (after >= 0)]
            before = np.full(len(owner), -1)
            before[after[after >= 0]] = np.flatnonzero(after >= 0)
            while len(wrong):
                rest, state = wrong, ends[before[wrong]]
                found = np.zeros(len(rest), dtype=np.int64)
                changed = []
                for step in range(SEGMENT):
                    if not len(rest):
                        break
                    state, ended = self._step(state, codes[step, rest], root)
                    found += ended
                    same = state == states[step, rest]
                    over = ~same & (lengths[rest] == step + 1)
                    if not (same.any() or over.any()):
                        continue
                    totals[rest[same]] = found[same] + alone[rest[same]] - founds[step, rest[same]]
                    totals[rest[over]] = found[over]
                    for done, new in ((same, own_ends[rest[same]]), (over, state[over])):
                        which = rest[done]
                        changed.append(which[ends[which] != new])
                        ends[which] = new
                    going = ~(same | over)
                    rest, state, found = rest[going], state[going], found[going]
                wrong = after[np.concatenate(changed)] if changed else np.zeros(0, np.int64)
                wrong = np.unique(wrong[wrong >= 0])
            totals += (ends != root) & (after < 0)
            out[:, k] = np.bincount(owner, weights=totals, minlength=len(encoded))
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        encoded = [self.encode(text or "") for text in texts]
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        known = [i for i, codes in enumerate(encoded) if len(codes)]
        if not known or not self.names:
            return out
        sizes = np.array([len(encoded[i]) for i in known])
        entropies = self.phrases([encoded[i] for i in known]) * np.array(self.bits)
        entropies /= sizes[:, None]
        best = np.argmin(entropies, axis=1)
        shares = np.exp2(-_SHARPNESS * (entropies - entropies.min(axis=1, keepdims=True)))
        scores = 1 / shares.sum(axis=1)
        for i, k, score in zip(known, best.tolist(), scores.tolist(), strict=True):
            out[i] = (self.names[k], score)
        return out


@lru_cache(maxsize=1)
def parser(labelled: tuple[tuple[str, str], ...]) -> Parser:
    """One to a Python worker."""
    return Parser(labelled)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def learn(documents: DataFrame, letters: int = TRAIN_LETTERS) -> tuple[tuple[str, str], ...]:
    """A bounded text for each language, from rows that are not held out."""
    spark = documents.sparkSession
    labelled = documents.where(
        (F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
        & F.col("lang").isNotNull()
        & (F.length("text") > 0)
    ).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    labelled = labelled.withColumn("mark", F.xxhash64("text"))
    # Of copies one counts, only letters do, and of these no more than may be used.
    size = F.max(F.least(F.length(F.regexp_replace("text", _NO_LETTER, "")), F.lit(letters)))
    single = labelled.groupBy("lang", "mark").agg(size.alias("size"))
    sizes = single.groupBy("lang").agg(F.sum("size").alias("size")).where("size > 0").collect()
    # Eight times what is used, by expectation.
    shares = {row["lang"]: min(1.0, 8 * letters / row["size"]) for row in sizes}
    draw = F.pmod(F.col("mark"), F.lit(2**30)) / 2**30
    texts: dict[str, str] = {}
    while shares:
        chances = spark.createDataFrame(list(shares.items()), "its_lang string, chance double")
        known = labelled.join(F.broadcast(chances), F.col("lang") == F.col("its_lang"))
        # What is no letter, and no mark that may become part of one, is not moved, nor what
        # lies beyond the bound whatever comes before.
        text = F.substring(F.trim(F.regexp_replace("text", _NO_PART, " ")), 1, letters).alias("text")
        drawn = known.where(draw < F.col("chance")).select("lang", text, draw.alias("draw"))
        drawn = drawn.where("text <> ''").distinct().collect()
        texts |= dict.fromkeys(shares, "")
        for row in sorted(drawn, key=lambda row: (row["draw"], row["text"])):
            if len(texts[row["lang"]]) < letters:
                texts[row["lang"]] += " " + letters_of(row["text"])
        short = {lang: share for lang, share in shares.items() if len(texts[lang]) < letters}
        shares = {lang: min(1.0, 8 * share) for lang, share in short.items() if share < 1}
    return tuple((lang, text[:letters]) for lang, text in sorted(texts.items()) if text.strip())


def identify(documents: DataFrame, labelled: tuple[tuple[str, str], ...]) -> DataFrame:
    """Language and score of every text."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parser(labelled)
        for batch in slices(batches):
            found = known.predict(batch.column("text").to_pylist())
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([name for name, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    key = F.col("doc_id").cast("bigint")
    rows = documents.select(
        key.alias("doc_id"), held_out(key).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(predict, _RESULT)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return identify(documents, learn(documents))
