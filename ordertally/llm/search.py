"""Ranked lexical search: short lists term at a time, long lists document at a time.

Documents are indexed in segments, each a row of a stored table: the keys and lengths of its
documents, and for each term wanted its list of documents and counts. Segments come from
whole texts in one pass; the number of documents that hold a term, and the corpus totals, are
sums over them. Every segment is then searched for every item on its own:

1. The item's lists are ordered by length. The shortest ones, up to `SHORT` postings in all,
   are taken term at a time: their scores are added up in accumulators.
2. The accumulators, sorted by document and bounded by their largest sum, are from then on
   one list among the long ones.
3. These are taken document at a time, a range of documents after the other. Lists whose
   bounds add up to less than the least score that counts are not walked: they are skipped
   through, by binary search, for documents that the others brought up, and a document is
   left as soon as its sum and the bounds that remain fall below that score.

The least score that counts is that of an item's tenth document so far, over all segments of
a task. Only what is less is left, so ties are decided by key. A task hands on ten documents
for each item, and the best ten of these are found by Spark, which keeps ten for each task.

Items are taken in blocks of `BLOCK_ITEMS`, so that what tasks are sent has a size that does
not grow with their number; a block looks up its own terms in the documents, those alone.

A null text has no terms and is not counted; a null key comes after all others; repeated
rows are documents, or items, of their own. An item without terms, or an empty table, gives
no rows. Texts of any length are taken whole. Terms are told apart by their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, slices, stored, texts_of, work_folder
from ordertally.llm.words import Words

TOP = 10
# Postings of an item in a segment that are added up at once.
SHORT = 2**12
SEGMENT_BYTES = 2**22
SEGMENT_DOCUMENTS = 2**15
BLOCK_ITEMS = 10_000
_TAIL = np.array([2 ** (8 * k) - 1 for k in range(9)], dtype=np.uint64)
# Documents of a segment are gone through in so many ranges.
RANGES = 8
LAST = np.iinfo(np.int64).max

# Digits, letters and all that is no ASCII, A to Z in small; the rest separates.
_FOLD = bytes(
    ord(chr(c).lower()) if chr(c).isalnum() or c > 127 else 32 for c in range(128)
) + bytes(range(128, 256))
_SEGMENTS = (
    "documents bigint, words bigint, keys binary, lengths binary, terms binary, counts binary, "
    "places binary, times binary"
)
_HITS = "item bigint, doc_id bigint, score bigint"


def terms_of(texts: list[str]) -> Words:
    """All terms of all texts."""
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" ".join(encoded).translate(_FOLD), dtype=np.uint8)
    lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = data != 32
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    borders = np.concatenate(([0], np.cumsum(lengths)))
    return Words(data, starts, ends, np.searchsorted(starts, borders))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as a number."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))


class Vocabulary:
    """The distinct terms wanted, known by number."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        ends = np.cumsum([len(term) for term in terms], dtype=np.int64)
        self.lengths = np.diff(ends, prepend=0)
        self.starts = ends - self.lengths
        self.data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        joined = np.frombuffer(b" ".join(terms), dtype=np.uint8)
        shift = np.arange(len(terms))
        hashes = Words(joined, self.starts + shift, ends + shift, shift).hashes()
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def numbers(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are wanted, and the numbers of their terms."""
        hashes = words.hashes()
        low = np.searchsorted(self.hashes, hashes, "left")
        high = np.searchsorted(self.hashes, hashes, "right")
        wanted, found = [], []
        step = 0
        at = np.flatnonzero(high > low)
        while len(at):  # further rounds only where hashes of two terms collide
            number = self.order[low[at] + step]
            equal = self._equal(words, at, number)
            wanted.append(at[equal])
            found.append(number[equal])
            step += 1
            at = at[~equal]
            at = at[high[at] - low[at] > step]
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(wanted), np.concatenate(found)

    def _equal(self, words: Words, at: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether words and terms have the same bytes."""
        starts = words.starts[at]
        lengths = words.ends[at] - starts
        equal = lengths == self.lengths[number]
        ours, theirs = _eights(words.data), _eights(self.data)
        rest = np.flatnonzero(equal)
        done = 0
        while len(rest):
            mask = _TAIL[np.minimum(lengths[rest] - done, 8)]
            differ = (ours[starts[rest] + done] ^ theirs[self.starts[number[rest]] + done]) & mask
            equal[rest[differ != 0]] = False
            done += 8
            rest = rest[(differ == 0) & (lengths[rest] > done)]
        return equal


class _Open:
    """The segment that a task is filling."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.documents = self.bytes = 0

    def add(self, batch: pa.RecordBatch, vocabulary: Vocabulary) -> None:
        words = terms_of(batch.column("text").to_pylist())
        lengths = np.diff(words.first)
        at, terms = vocabulary.numbers(words)
        text = np.searchsorted(words.first, at, "right") - 1
        full = np.flatnonzero(lengths)  # documents without terms are not counted
        place = np.cumsum(lengths > 0) - 1 + self.documents
        keys = batch.column("doc_id").fill_null(LAST).to_numpy()
        self.keys.append(keys[full])
        self.lengths.append(lengths[full])
        self.pairs.append((terms, place[text]))
        self.documents += len(full)
        self.bytes += len(words.data)

    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or self.documents >= SEGMENT_DOCUMENTS

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.documents:
            pairs = np.concatenate([terms << 31 | places for terms, places in self.pairs])
            pairs, times = np.unique(pairs, return_counts=True)
            terms, counts = np.unique(pairs >> 31, return_counts=True)
            lengths = np.concatenate(self.lengths)
            columns = [
                np.concatenate(self.keys),
                lengths,
                terms,
                counts,
                (pairs & (2**31 - 1)).astype(np.int32),
                times.astype(np.int64),
            ]
            row = [pa.array([self.documents]), pa.array([int(lengths.sum())])]
            row += [pa.array([column.tobytes()], pa.binary()) for column in columns]
            names = ["documents", "words", "keys", "lengths", "terms", "counts", "places", "times"]
            yield pa.RecordBatch.from_arrays(row, names)
        self.__init__()


def segments(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The index: a row for each segment, with the lists of the terms wanted."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = _Open()
        for batch in slices(batches):
            current.add(batch, vocabulary)
            if current.full():
                yield from current.close()
        yield from current.close()

    return texts_of(documents).mapInArrow(index, _SEGMENTS)


def counted(index: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Documents and terms of the corpus, and the documents that hold each term wanted: a row
    for each term of a block of items at most."""
    total = index.agg(F.sum("documents").alias("n"), F.sum("words").alias("l")).first()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(*(batch.column(c).to_pylist() for c in ("terms", "counts")), strict=True):
                columns = (pa.array(np.frombuffer(column, np.int64)) for column in (terms, counts))
                yield pa.RecordBatch.from_arrays(list(columns), ["term", "df"])

    sums = index.select("terms", "counts").mapInArrow(count, "term bigint, df bigint")
    table = sums.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    return total["n"] or 0, total["l"] or 0, table["term"].to_numpy(), table["df"].to_numpy()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def damping(lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    if 75 * int(lengths.max(initial=0)) * documents < 2**63:
        return 100 - 75 + (75 * lengths * documents) // words
    exact = [100 - 75 + (75 * n * documents) // words for n in lengths.tolist()]
    return np.array(exact, dtype=np.int64)


class Best:
    """An item's best documents so far: highest score first, then the least key."""

    def __init__(self, top: int = TOP):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.int64)

    def least(self) -> int:
        """The least score that may count; a document with no score does not."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        good = scores >= self.least()
        scores = np.concatenate((self.scores, scores[good]))
        keys = np.concatenate((self.keys, keys[good]))
        if len(scores) > 8 * self.top:
            cut = np.partition(scores, -self.top)[-self.top]
            scores, keys = scores[scores >= cut], keys[scores >= cut]
        order = np.lexsort((keys, -scores))[: self.top]
        self.scores, self.keys = scores[order], keys[order]


List = tuple  # documents in order, their scores, the largest of these


def accumulated(lists: list[List]) -> List:
    """The sums of several lists as one list."""
    places = np.concatenate([one[0] for one in lists])
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    sums = np.add.reduceat(np.concatenate([one[1] for one in lists])[order], first)
    return places[first], sums, int(sums.max())


def search(lists: list[List], keys: np.ndarray, best: Best, short: int = SHORT, ranges: int = RANGES) -> int:
    """Take the documents of a segment into an item's best; how many postings were read."""
    lists = sorted((one for one in lists if len(one[0])), key=lambda one: len(one[0]))
    sizes = np.cumsum([len(one[0]) for one in lists])
    few = int(np.searchsorted(sizes, short, "right"))
    read = int(sizes[few - 1]) if few else 0
    if few > 1:
        lists = [accumulated(lists[:few]), *lists[few:]]
    lists.sort(key=lambda one: one[2])
    bounds = np.cumsum([one[2] for one in lists])
    cuts = np.linspace(0, len(keys), ranges + 1).astype(np.int64)
    borders = [np.searchsorted(one[0], cuts) for one in lists]
    for turn in range(ranges):
        least = best.least()
        # Lists that together cannot bring a document to the least score.
        skipped = int(np.searchsorted(bounds, least, "left"))
        if skipped == len(lists):
            return read
        parts = []
        for one, border in zip(lists, borders, strict=True):
            part = slice(border[turn], border[turn + 1])
            parts.append((one[0][part], one[1][part]))
        walked = [(*part, 0) for part in parts[skipped:] if len(part[0])]
        if not walked:
            continue
        read += sum(len(part[0]) for part in walked)
        places, sums = walked[0][:2] if len(walked) == 1 else accumulated(walked)[:2]
        for k in range(skipped - 1, -1, -1):
            # What is left of the lists allows no more than this.
            keep = sums + bounds[k] >= least
            places, sums = places[keep], sums[keep]
            listed, scores = parts[k]
            if not len(places):
                break
            if not len(listed):
                continue
            at = np.minimum(np.searchsorted(listed, places), len(listed) - 1)
            read += len(at)
            sums = sums + np.where(listed[at] == places, scores[at], 0)
        best.add(sums, keys[places])
    return read


def _searched(items: list[list[tuple[int, int]]], weights: np.ndarray, documents: int, words: int, top: int):
    """The function that searches the segments of a task for all items of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                whole = lambda name, kind=np.int64, r=row: np.frombuffer(r[name], kind)
                keys, terms = whole("keys"), whole("terms")
                m = damping(whole("lengths"), documents, words)
                places, times = whole("places", np.int32), whole("times")
                impacts = (1_000_000_000 * times) // (1000 * times + 8 * m[places])
                lists, start = {}, 0
                for term, count in zip(terms.tolist(), whole("counts").tolist(), strict=True):
                    own = slice(start, start := start + count)
                    scores = impacts[own] * weights[term]
                    lists[term] = places[own], scores, int(scores.max())
                for one, wanted in zip(best, items, strict=True):
                    own = []
                    for term, times_in_item in wanted:
                        if (found := lists.get(term)) is not None:
                            if times_in_item > 1:
                                found = found[0], found[1] * times_in_item, found[2] * times_in_item
                            own.append(found)
                    if own:
                        search(own, keys, one)
        for item, one in enumerate(best):
            if len(one.keys):
                known = pa.array(one.keys, mask=one.keys == LAST)
                columns = [pa.array(np.full(len(one.keys), item)), known, pa.array(one.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return run


def _block(documents: DataFrame, texts: list[str], folder: str, top: int) -> DataFrame | None:
    """The best documents of a block of items, by place in the block."""
    words = terms_of(texts)
    data = words.data.tobytes()
    spans = zip(words.starts.tolist(), words.ends.tolist(), strict=True)
    found = [data[a:b] for a, b in spans]
    number = {term: k for k, term in enumerate(dict.fromkeys(found))}
    if not number:
        return None
    items = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        times: dict[int, int] = {}
        for term in found[a:b]:
            times[number[term]] = times.get(number[term], 0) + 1
        items.append(list(times.items()))
    index = stored(segments(documents, Vocabulary(list(number))), f"{folder}/segments")
    total, length, terms, df = counted(index)
    weights = np.zeros(len(number), np.int64)
    for term, count in zip(terms.tolist(), df.tolist(), strict=True):
        weights[term] = weight(total, count)
    hits = index.mapInArrow(_searched(items, weights, total, length, top), _HITS)
    by_score = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return stored(ranked, f"{folder}/ranked")


def ranked_search(
    documents: DataFrame,
    items: DataFrame,
    folder: str,
    top: int = TOP,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The `top` best documents for each item of `item_id, text`."""
    spark = documents.sparkSession
    asked = items.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    asked = stored(asked, f"{folder}/items")
    shape = "item_id bigint, rank int, doc_id bigint, score bigint"
    results = []
    block: list = []

    def answer() -> None:
        number = len(results)
        found = _block(documents, [row["text"] for row in block], f"{folder}/block-{number}", top)
        if found is not None:
            ids = spark.createDataFrame(
                [(k, row["item_id"]) for k, row in enumerate(block)], "asked bigint, item_id bigint"
            )
            named = found.join(F.broadcast(ids), F.col("item") == F.col("asked"))
            results.append(named.select("item_id", "rank", "doc_id", "score"))
        block.clear()

    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) >= block_items:
            answer()
    if block:
        answer()
    out = spark.createDataFrame([], shape)
    for one in results:
        out = out.unionByName(one)
    return out


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    items = read_table(spark, sf_dir, "benchmark")
    return ranked_search(documents, items, f"{work_folder(spark)}/search")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), size AS (
  SELECT place, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size
), posting AS (
  SELECT place, term, count(*) AS tf
  FROM (SELECT place, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM posting, total GROUP BY term, docs
), wanted AS (
  SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, place,
         CAST(sum(times * w * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN posting USING (term) JOIN weighed USING (term) JOIN size USING (place), total
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, place) AS rank
  FROM scored WHERE score > 0
) WHERE rank <= 10
"""
