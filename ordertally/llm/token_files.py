"""Token ids in binary files, with the borders of documents in Elias-Fano code.

A file holds the ids of some documents, in ascending order of their keys, as one array of
16-bit integers (32-bit where the vocabulary needs it), then the documents' ends within it
and the documents' keys, both non-decreasing and both in Elias-Fano code, then a footer. A
reader holds the borders in their code and reads ids by ranges, at the places that it selects.

Null keys come first, repeated keys stay beside each other in the order of a hash of their
texts, a null text is empty; a document has its end id at least. No rows, no files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import filesystem, read_table, slices, texts_of, work_folder
from ordertally.llm.elias_fano import EliasFano
from ordertally.llm.tokens import END_ID, SLICE_BYTES, encoder, public_path

# A file is closed once it holds so many ids or documents.
FILE_IDS = 2**23
FILE_DOCUMENTS = 2**18
# Documents of which the ids are read at once.
RUN = 2**8
_LENGTH = struct.Struct("<q")
_FILES = "task int, place int, name string, documents bigint, tokens bigint"


def pack_file(keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of a file; `ids` has each document's ids as unsigned 32-bit integers."""
    lengths = np.fromiter((len(one) // 4 for one in ids), dtype=np.int64, count=len(ids))
    body = np.frombuffer(b"".join(ids), dtype="<u4").astype(f"<u{width}").tobytes()
    ends = EliasFano.build(np.cumsum(lengths)).to_bytes()
    known = np.array([key for key in keys if key is not None], dtype=np.int64)
    names = EliasFano.build(known).to_bytes()
    footer = {"width": width, "documents": len(keys), "nulls": len(keys) - len(known)}
    footer |= {"sizes": [len(body), len(ends), len(names)]}
    text = json.dumps(footer).encode()
    return b"".join((body, ends, names, text, _LENGTH.pack(len(text))))


class TokenFile:
    """A file read back by ranges: the borders are held, of the ids what is asked for alone."""

    def __init__(self, source: pa.NativeFile):
        self.source, end = source, source.size() - _LENGTH.size
        size = _LENGTH.unpack(source.read_at(_LENGTH.size, end))[0]
        footer = json.loads(source.read_at(size, end - size))
        body, ends, names = footer["sizes"]
        self.width = footer["width"]
        self.ends = EliasFano.from_bytes(source.read_at(ends, body))
        self.keys = EliasFano.from_bytes(source.read_at(names, body + ends))
        self.documents, self.nulls = footer["documents"], footer["nulls"]

    def key(self, place: int) -> int | None:
        return None if place < self.nulls else self.keys.select(place - self.nulls)

    def ids(self, start: int, end: int) -> np.ndarray:
        data = self.source.read_at(self.width * (end - start), self.width * start)
        return np.frombuffer(data, dtype=f"<u{self.width}")

    def document(self, place: int) -> np.ndarray:
        start = self.ends.select(place - 1) if place else 0
        return self.ids(start, self.ends.select(place))

    def run(self, place: int, count: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Keys of consecutive documents, where each begins, and the end of the last; their ids."""
        nulls = min(max(self.nulls - place, 0), count)
        known = self.keys.some(place + nulls - self.nulls, count - nulls) if count > nulls else []
        first = self.ends.select(place - 1) if place else 0
        borders = np.concatenate(([first], self.ends.some(place, count)))
        return [None] * nulls + list(map(int, known)), borders, self.ids(first, int(borders[-1]))


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID
) -> DataFrame:
    """Encode and write; a table of the files, in order, that is stored beside them.

    A file that a lost or repeated task leaves behind is in no table, so no reader sees it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        width = 2 if encode.tokenizer.get_vocab_size() <= 2**16 else 4
        system, root = filesystem(f"{folder}/ids")
        system.create_dir(root, recursive=True)
        task = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        keys: list[int | None] = []
        ids: list[bytes] = []
        count = place = 0

        def close() -> pa.RecordBatch:
            name = f"{task:07d}-{place:05d}-{uuid.uuid4().hex}.ids"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_file(keys, ids, width))
            row = {"task": task, "place": place, "name": name}
            row |= {"documents": len(keys), "tokens": count}
            kinds = {"task": pa.int32(), "place": pa.int32(), "name": pa.string()}
            columns = [pa.array([v], kinds.get(k, pa.int64())) for k, v in row.items()]
            return pa.RecordBatch.from_arrays(columns, names=list(row))

        for batch in slices(batches, limit=SLICE_BYTES):
            found = encode.encode(batch.column("text"))
            for key, one in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                keys.append(key)
                ids.append(one + end)
                count += len(one) // 4 + 1
                if count >= FILE_IDS or len(keys) >= FILE_DOCUMENTS:
                    yield close()
                    keys, ids, count, place = [], [], 0, place + 1
        if keys:
            yield close()

    # By text as well, so that rows without a key, or of one key, are dealt over ranges, too.
    order = "doc_id", F.xxhash64("text")
    rows = texts_of(documents).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    rows.mapInArrow(write, _FILES).write.parquet(f"{folder}/files")
    return token_files(documents.sparkSession, folder)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with the number of ids in those before it."""
    before = W.orderBy("task", "place").rowsBetween(W.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    files = spark.read.schema(_FILES).parquet(f"{folder}/files")
    return files.select("*", base)


def described(one: TokenFile, place: int, base: int) -> pa.RecordBatch:
    """Key, start, length and checksum of a run of a file's documents."""
    keys, borders, ids = one.run(place, min(RUN, one.documents - place))
    data = memoryview(ids.astype("<u4").tobytes())
    cuts = (4 * (borders - borders[0])).tolist()
    sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    columns = [keys, borders[:-1] + base, np.diff(borders), sums]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Key, global start, length and checksum of each document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(f"{folder}/ids")
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['name']}") as source:
                    one = TokenFile(source)
                    for place in range(0, one.documents, RUN):
                        yield described(one, place, row["base"])

    files = token_files(spark, folder).select("name", "base")
    # A file to a task: a task that is lost reads one file again.
    spread = files.repartition(F.col("name"))
    return spread.mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/tokens"
    documents = read_table(spark, sf_dir, "documents")
    write_token_files(documents, folder, public_path("word_bpe_49k.json"))
    return read_token_files(spark, folder)
