"""WARC archives with a two-level capture index.

Records are gzip members, one after the other, so that a record is read by its offset and
length alone. The index has a line for each capture, sorted by its key: the URL with the
host's labels reversed, then the page's identifier, so that a host or a URL with very many
captures spreads over many shards. A shard holds its lines in compressed blocks and, at its
end, a sparse directory with the first key of each block. A look-up goes by binary search to
a shard, to a block and to a line, and from there to one range read in an archive.

Of pages with equal payloads of at least `least` bytes, the one with the largest identifier
is a response and the others are revisits that name it; a null identifier is smaller than
any. Rows that repeat an identifier are records of their own with the same type. A null html
is an empty payload; a null or unreadable URL has the empty key. An empty table gives no
archives and no rows. Files that a lost task leaves behind are in no table, so nobody reads
them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import filesystem, read_table, slices, work_folder
from ordertally.operators.sizes import fits_broadcast

ARCHIVE_BYTES = 64 * 2**20
BLOCK_LINES = 256
# A shard's directory is small enough to be held while the shard is searched.
SHARD_LINES = 2**18
COMPRESSION = 3
_LENGTH = struct.Struct("<q")
_CAPTURES = "key string, archive string, offset bigint, length bigint"
_SHARDS = "first_key string, shard string, lines bigint"
_RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint"
)


def surt(url: str | None) -> str:
    """The host's labels reversed, then path and query; without scheme and fragment."""
    if not url:
        return ")"
    rest = url.split("#", 1)[0].split("://", 1)[-1]
    cuts = [at for mark in "/?" if (at := rest.find(mark)) >= 0]
    border = min(cuts, default=len(rest))
    host = rest[:border].rsplit("@", 1)[-1].split(":", 1)[0].lower().removeprefix("www.")
    return f"{','.join(reversed(host.split('.')))}){rest[border:] or '/'}"


def capture_key(url: str | None, page_id: int | None) -> str:
    """Keys sort as code points do; the identifier makes them differ."""
    key = surt(url).translate({number: f"%{number:02X}" for number in range(33)})
    return f"{key} {'-' if page_id is None else format(page_id + 2**63, '020d')}"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, html: str, refers_to: int | None) -> bytes:
    """A response, or a revisit if it refers to another page."""
    payload = html.encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url:
        fields["WARC-Target-URI"] = url.translate({n: f"%{n:02X}" for n in range(33)})
    if refers_to is not None:
        fields["WARC-Refers-To"] = _name(refers_to)
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    block = http if refers_to is not None else http + payload
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    data = head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    packer = zlib.compressobj(COMPRESSION, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(member: bytes) -> tuple:
    """Page, payload length and digest, type and reference of a record that was read."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page_id = _number(fields["WARC-Record-ID"])
    return page_id, length, digest, kind, _number(fields.get("WARC-Refers-To"))


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """Each page with the one it revisits, if any."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    groups = rows.where(F.octet_length("html") >= least).groupBy("digest")
    several = groups.agg(F.max("page_id").alias("latest"), F.count("*").alias("pages"))
    shared = several.where("pages > 1").select("digest", "latest")
    # The pages stay where they are unless the shared digests are too many to be sent.
    known = F.broadcast(shared) if fits_broadcast(shared) else shared
    own = F.col("page_id").eqNullSafe(F.col("latest"))
    refers_to = F.when(~own, F.col("latest")).alias("refers_to")
    return rows.join(known, "digest", "left").select("page_id", "url", "html", refers_to)


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Archives, and a table of the captures in them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(f"{folder}/archives")
        system.create_dir(root, recursive=True)
        name, out, offset = "", None, 0
        for batch in slices(batches, "html"):
            rows = []
            for page in batch.to_pylist():
                if out is None:
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data = record(page["page_id"], page["url"], page["html"], page["refers_to"])
                out.write(data)
                key = capture_key(page["url"], page["page_id"])
                rows.append({"key": key, "archive": name, "offset": offset, "length": len(data)})
                offset += len(data)
                if offset >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(rows)
        if out is not None:
            out.close()

    rows = with_references(pages, least)
    rows.mapInArrow(write, _CAPTURES).write.parquet(f"{folder}/captures")


def pack_shard(lines: list[tuple]) -> bytes:
    """Blocks of lines, then the directory, then its length."""
    blocks, directory, offset = [], [], 0
    for start in range(0, len(lines), BLOCK_LINES):
        part = lines[start : start + BLOCK_LINES]
        data = zlib.compress("\n".join(json.dumps(line) for line in part).encode())
        directory.append((part[0][0], offset, len(data)))
        blocks.append(data)
        offset += len(data)
    tail = zlib.compress(json.dumps(directory).encode())
    return b"".join((*blocks, tail, _LENGTH.pack(len(tail))))


def write_index(spark: SparkSession, folder: str) -> None:
    """Sort the captures into shards; a table names them with their first keys."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(f"{folder}/index")
        system.create_dir(root, recursive=True)
        lines: list[tuple] = []

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.cdx"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_shard(lines))
            row = {"first_key": lines[0][0], "shard": name, "lines": len(lines)}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for row in batch.to_pylist():
                lines.append((row["key"], row["archive"], row["offset"], row["length"]))
                if len(lines) >= SHARD_LINES:
                    yield close()
                    lines = []
        if lines:
            yield close()

    captures = spark.read.schema(_CAPTURES).parquet(f"{folder}/captures")
    ordered = captures.repartitionByRange("key").sortWithinPartitions("key", "archive", "offset")
    ordered.mapInArrow(write, _SHARDS).write.parquet(f"{folder}/shards")


class Index:
    """Look-ups in the shards; what it holds is one shard's directory and one block."""

    def __init__(self, folder: str, shards: list[tuple[str, str]]):
        self.system, self.root = filesystem(folder)
        self.first_keys = [key for key, _ in shards]
        self.names = [name for _, name in shards]
        self.shard = self.block = -1

    def _open(self, shard: int) -> None:
        self.file = self.system.open_input_file(f"{self.root}/index/{self.names[shard]}")
        size = self.file.size()
        tail = _LENGTH.unpack(self.file.read_at(_LENGTH.size, size - _LENGTH.size))[0]
        data = zlib.decompress(self.file.read_at(tail, size - _LENGTH.size - tail))
        self.directory = json.loads(data)
        self.block_keys = [row[0] for row in self.directory]
        self.shard, self.block = shard, -1

    def _load(self, block: int) -> None:
        _, offset, length = self.directory[block]
        text = zlib.decompress(self.file.read_at(length, offset)).decode()
        self.lines = [json.loads(line) for line in text.split("\n")]
        self.keys = [line[0] for line in self.lines]
        self.block = block

    def find(self, key: str) -> list[list]:
        """The captures with a key: archive, offset and length of each."""
        found = []
        # Equal keys may lie across borders, so the search starts before the first of them.
        shard = max(bisect_left(self.first_keys, key) - 1, 0)
        while shard < len(self.names) and (not found or self.first_keys[shard] <= key):
            if self.first_keys[shard] > key:
                break
            if shard != self.shard:
                self._open(shard)
            block = max(bisect_left(self.block_keys, key) - 1, 0)
            while block < len(self.block_keys) and self.block_keys[block] <= key:
                if block != self.block:
                    self._load(block)
                begin, end = bisect_left(self.keys, key), bisect_right(self.keys, key)
                found += [line[1:] for line in self.lines[begin:end]]
                block += 1
            shard += 1
        return found


def read_pages(requests: DataFrame, folder: str) -> DataFrame:
    """The records of all captures of the requested `page_id, url`, by way of the index."""
    spark = requests.sparkSession
    table = spark.read.schema(_SHARDS).parquet(f"{folder}/shards").select("first_key", "shard")
    # One row for up to SHARD_LINES captures.
    shards = sorted(tuple(row) for row in table.collect())

    @F.pandas_udf("string")
    def key_of(urls, ids):
        import pandas as pd

        known = ids.notna()
        return pd.Series(
            [
                capture_key(url, int(number) if there else None)
                for url, number, there in zip(urls, ids, known, strict=True)
            ]
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, shards)
        system, root = filesystem(f"{folder}/archives")
        opened: dict = {}
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for name, offset, length in index.find(key):
                    if name not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened))).close()
                        opened[name] = system.open_input_file(f"{root}/{name}")
                    rows.append(parse(opened[name].read_at(length, offset)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
            )

    ids = F.col("page_id").cast("bigint")
    # Identifiers as text: pandas would make floats of a column with nulls.
    keys = requests.select(key_of(F.col("url").cast("string"), ids.cast("string")).alias("key"))
    # As many tasks as a shuffle has, or shards if they are more: keys are short, so Spark
    # would put all of them in one.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(shards))
    wanted = keys.distinct().repartitionByRange(tasks, "key").sortWithinPartitions("key")
    return wanted.mapInArrow(read, _RECORDS)


def archive_and_read(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    write_archives(pages, folder, least)
    write_index(pages.sparkSession, folder)
    return read_pages(pages, folder)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(read_table(spark, sf_dir, "pages"), f"{work_folder(spark)}/warc")
