"""Removal of repeated passages, found by recompression.

A window is `WINDOW` consecutive words of one document; each word goes that is covered by a
window whose words also start anywhere else, in the same document or another.

1. Each document's words are recompressed for some rounds, which name runs and pairs of
   symbols alike in all documents. Symbols with the least name among their neighbours are
   its anchors: each is bound to a stretch of words and occurs wherever that stretch does.
2. An anchor whose name occurs once in the corpus shows that no window around its stretch
   is repeated. What is left are windows among shared anchors, and the few without any.
3. These windows are verified by a hash of all their words, compared across the corpus.

Names and hashes are compared in the same way, see `matching`. Of documents with equal
texts, one takes part; with a window of words at least, all of their words are repeated.

Texts, names and windows are told apart by 64-bit hashes (equal texts by SHA-1). A null text
has no words. Rows that repeat a key and a text repeat each other's words. Each text is
handled whole, by one task. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import marked_copies, read_table, slices, work_folder
from ordertally.llm.matching import SENT, Chunk, repeated
from ordertally.llm.recompression import Symbols, least_of_neighbours, recompress
from ordertally.llm.words import Words, mixed, words_of

WINDOW = 35
ROUNDS, REACH = 3, 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def places_of(sent: DataFrame) -> DataFrame:
    """For each key the places of names that occur more than once."""
    return repeated(sent).groupBy("key").agg(F.collect_set("place").alias("places"))


def _anchors(words: Words, hashes: np.ndarray, window: int) -> Symbols:
    """Anchors that a window can hold whole."""
    symbols = least_of_neighbours(recompress(hashes, words.first, ROUNDS), REACH)
    return symbols.take(symbols.high - symbols.low <= window)


def _flags(batch: pa.RecordBatch, firsts: np.ndarray, total: int) -> np.ndarray:
    """True at the listed places of each text, numbered through all texts."""
    out = np.zeros(total, dtype=bool)
    column = batch.column("places")
    values = column.flatten().to_numpy()
    counts = np.array([len(one) if one is not None else 0 for one in column.to_pylist()])
    out[values + np.repeat(firsts, counts)] = True
    return out


def _window_hashes(hashes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A polynomial in the words' hashes, from sums over all that come before."""
    powers = np.multiply.accumulate(np.full(len(hashes) + 1, _ODD, dtype=np.uint64))
    undo = np.multiply.accumulate(np.full(len(hashes) + 1, _UNDO, dtype=np.uint64))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mixed(hashes) * powers[: len(hashes)], out=sums[1:])
    return mixed((sums[starts + window] - sums[starts]) * undo[starts])


def _spans(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """True from each start up to its end, without it."""
    steps = np.bincount(starts, minlength=total + 1) - np.bincount(ends, minlength=total + 1)
    return np.cumsum(steps)[:total] > 0


def remove_repeats(documents: DataFrame, folder: str, window: int = WINDOW) -> DataFrame:
    """Of each document the number of words, of those removed, and a digest of the rest."""

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in slices(batches):
            words = words_of(batch.column("text").to_pylist())
            anchors = _anchors(words, words.hashes(), window)
            counts = np.bincount(anchors.text, minlength=batch.num_rows)
            firsts = np.cumsum(counts) - counts
            keys = batch.column("key").to_numpy()
            places = np.arange(len(anchors.names)) - firsts[anchors.text]
            if chunk.add(anchors.names, keys[anchors.text], places):
                yield from chunk.close()
        yield from chunk.close()

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in slices(batches):
            words = words_of(batch.column("text").to_pylist())
            hashes = words.hashes()
            total = len(hashes)
            anchors = _anchors(words, hashes, window)
            counts = np.bincount(anchors.text, minlength=batch.num_rows)
            shared = _flags(batch, np.cumsum(counts) - counts, len(anchors.names))
            single = anchors.take(~shared)
            # No window that holds a single anchor whole is repeated.
            low = np.maximum(single.high - window, words.first[single.text])
            ruled_out = _spans(low, single.low + 1, total)
            last = np.maximum(words.first[1:] - window + 1, words.first[:-1])
            possible = _spans(words.first[:-1], last, total)
            starts = np.flatnonzero(possible & ~ruled_out)
            text = np.searchsorted(words.first, starts, "right") - 1
            keys = batch.column("key").to_numpy()
            names = _window_hashes(hashes, starts, window)
            if chunk.add(names, keys[text], starts - words.first[text]):
                yield from chunk.close()
        yield from chunk.close()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            encoded = [text.encode("utf-8", "surrogatepass").split() for text in texts]
            sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
            ends = np.cumsum(sizes)
            firsts = ends - sizes
            total = int(ends[-1])
            starts = np.flatnonzero(_flags(batch, firsts, total))
            gone = _spans(starts, starts + window, total)
            removed, digests = [], []
            whole = batch.column("whole").to_pylist()
            for words, copied, first, end in zip(
                encoded, whole, firsts.tolist(), ends.tolist(), strict=True
            ):
                out = gone[first:end]
                if copied and end - first >= window:
                    words, count = [], end - first
                elif count := int(out.sum()):
                    words = compress(words, (~out).tolist())
                removed.append(count)
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(digests)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    shape = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    marked = marked_copies(documents, folder).withColumn("key", F.xxhash64("doc_id", "text"))
    # A group of copies without any key is left as it is: its rows repeat each other.
    active = marked.where("not whole or first").select("key", "doc_id", "text", "whole")
    others = marked.where("whole and not first").select("key", "doc_id", "text", "whole")
    dealt = active.repartition("key")
    shared = places_of(active.select("key", "text").mapInArrow(send_anchors, SENT))
    sent = dealt.join(shared, "key", "left").mapInArrow(send_windows, SENT)
    unique = dealt.join(places_of(sent), "key", "left")
    nothing = others.withColumn("places", F.lit(None).cast("array<int>"))
    return unique.mapInArrow(finish, shape).union(nothing.mapInArrow(finish, shape))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), work_folder(spark))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
),
w AS (
  SELECT doc_id, r, unnest(generate_series(1, len(ws) - 34)) AS s, ws FROM d WHERE len(ws) >= 35
),
h AS (SELECT doc_id, r, s, md5(array_to_string(ws[s:s+34], ' ')) AS m FROM w),
rep AS (
  SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY m) AS n FROM h) WHERE n > 1
),
cov AS (SELECT DISTINCT r, unnest(generate_series(s, s + 34)) AS i FROM rep),
word AS (SELECT r, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i FROM d),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n
  FROM word ANTI JOIN cov USING (r, i) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
