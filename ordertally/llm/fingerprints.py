"""Fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of a text; it depends on the last 32 bytes only, so a
border that it sets moves with the text around it. Borders are normalised: a chunk has at
least `MIN` bytes, up to `NORMAL` bytes the stricter mask must be met, from there on the
looser one, and at `MAX` bytes the chunk ends anyway. A fingerprint is the set of the chunks'
64-bit digests, each with the chunk's length as its weight. The likeness of two fingerprints
is the smaller of their two containments: the weight they share over the larger weight; 1 if
both are empty, 0 if one is.

Null texts are empty. The next document is the one with the next smaller key; null keys come
last, rows that repeat a key in the order of their texts, and after the last document comes
the first. A single row is its own next. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, slices, texts_of

MIN, NORMAL, MAX = 16, 64, 256
# Seven bits up to the normal size, five after it; the upper bits look back furthest.
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF8000000)
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], dtype=np.uint32)
_BLOCK = 2**20
# Ranges of keys for each shuffle partition, so that hashing them leaves none overfull.
RANGES_A_PARTITION = 4
_LEAST = -(2**63)

Fingerprint = dict[int, int]


def _gear(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the gear values of the last 32, shifted by their distance."""
    hashes = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(hashes)
        shifted[width:] = hashes[:-width] << np.uint32(width)
        hashes = hashes + shifted
    return hashes


def _candidates(data: bytes) -> tuple[list[int], list[int]]:
    """Ends of possible chunks, by the strict and by the loose mask."""
    whole = np.frombuffer(data, dtype=np.uint8)
    strict, loose = [], []
    for start in range(0, len(whole), _BLOCK):
        lead = min(start, 31)
        hashes = _gear(whole[start - lead : start + _BLOCK])[lead:]
        strict.append(np.flatnonzero(hashes & STRICT == 0) + start + 1)
        loose.append(np.flatnonzero(hashes & LOOSE == 0) + start + 1)
    return np.concatenate(strict).tolist(), np.concatenate(loose).tolist()


def borders(data: bytes) -> list[int]:
    """Ends of the chunks."""
    size = len(data)
    if size <= MIN:
        return [size] if size else []
    strict, loose = _candidates(data)
    strict.append(size)
    loose.append(size)
    ends = []
    at = s = l = 0
    while at < size:
        low, middle, high = at + MIN, at + NORMAL, at + MAX
        while s < len(strict) - 1 and strict[s] < low:
            s += 1
        end = strict[s]
        if end > middle:
            while l < len(loose) - 1 and loose[l] <= middle:
                l += 1
            end = min(end, loose[l], high)
        at = min(end if end > at else size, size)
        ends.append(at)
    return ends


def fingerprint(text: str) -> Fingerprint:
    data = text.encode("utf-8", "surrogatepass")
    digest = xxhash.xxh3_64_intdigest
    chunks: Fingerprint = {}
    start = 0
    for end in borders(data):
        chunks[digest(data[start:end])] = end - start
        start = end
    return chunks


def as_string(chunks: Fingerprint) -> str:
    """Digests in order, then their weights, in base 64."""
    digests = np.fromiter(chunks, dtype="<u8", count=len(chunks))
    weights = np.fromiter(chunks.values(), dtype="<u2", count=len(chunks))
    order = np.argsort(digests)
    packed = digests[order].tobytes() + weights[order].tobytes()
    return base64.b64encode(packed).decode()


def from_string(text: str) -> Fingerprint:
    packed = base64.b64decode(text)
    count = len(packed) // 10
    digests = np.frombuffer(packed[: 8 * count], dtype="<u8")
    weights = np.frombuffer(packed[8 * count :], dtype="<u2")
    return dict(zip(digests.tolist(), weights.tolist(), strict=True))


def likeness(one: Fingerprint, other: Fingerprint) -> float:
    most = max(sum(one.values()), sum(other.values()))
    if not most:
        return 1.0
    return sum(one[key] for key in one.keys() & other.keys()) / most


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the document that follows."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range, in descending order of keys, each range with its follower at its end."""
    held: tuple | None = None  # range, key, text, fingerprint of the row that waits for its next
    for batch in slices(batches):
        rows: list[tuple] = []
        columns = (batch.column(name).to_pylist() for name in ("range", "doc_id", "text", "after"))
        for place, key, text, after in zip(*columns, strict=True):
            if after and (held is None or held[0] != place):
                continue  # the range has its follower already
            chunks = fingerprint(text)
            if held is not None and held[0] == place:
                _, own_key, own, own_chunks = held
                changed = edited(own, text)
                new = fingerprint(changed)
                rows.append(
                    (
                        own_key,
                        len(own),
                        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_string(own_chunks),
                        as_string(new),
                        likeness(own_chunks, new),
                        likeness(own_chunks, chunks),
                    )
                )
            held = None if after else (place, key, text, chunks)
        kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)
        names = [part.split()[0] for part in _RESULT.split(", ")]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
        )


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    Keys are cut into ranges by approximate quantiles; the first row of a range, in
    descending order, is also sent to the range above as the follower of its last row.
    What the driver holds is a few numbers for each shuffle partition.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_A_PARTITION
    key = F.coalesce("doc_id", F.lit(_LEAST))
    rows = texts_of(documents).withColumn("key", key)
    keys = rows.select("key")
    chances = [k / parts for k in range(1, parts)]
    cuts = keys.stat.approxQuantile("key", chances, 0.1 / parts)
    bounds = np.unique(np.array(cuts, dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), "right").astype(np.int32))

    tops = keys.groupBy(range_of("key").alias("range")).agg(F.max("key").alias("top"))
    ranges = sorted(tuple(row) for row in tops.collect())
    used = np.array([place for place, _ in ranges], dtype=np.int64)
    heads = np.array([top for _, top in ranges], dtype=np.int64)
    # The first row of a range follows the last of the range above; of the lowest, the highest.
    above = np.roll(used, -1)

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        numbers = keys.to_numpy()
        own = np.searchsorted(bounds, numbers, "right")
        at = np.searchsorted(used, own)
        first = heads[at] == numbers
        return pd.Series(
            [[a, b] if c else [a] for a, b, c in zip(own, above[at], first, strict=True)]
        )

    if not ranges:
        return spark.createDataFrame([], _RESULT)
    sent = rows.select("doc_id", "text", "key", F.posexplode(ranges_of("key")).alias("after", "range"))
    dealt = sent.withColumn("after", F.col("after") > 0).repartition("range")
    ordered = dealt.sortWithinPartitions("range", "after", F.desc("key"), "text")
    return ordered.mapInArrow(_compare, _RESULT)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read_table(spark, sf_dir, "documents"))
