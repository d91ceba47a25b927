"""Deterministic sharded WARC writer, and its reader.

Pages are dealt into shards by ranges of page_id: the extendible directory of :mod:`sharding` over the id itself
(its bits keep the order) gives ranges of bounded bytes that depend on the rows alone, not on cluster, partitions
or samples. A task writes a shard in id order, one gzip member a record, and rolls to a new file once a file's
compressed bytes reach ``ROLL``. Each file is written under a temporary name of the attempt and moved to its final
name when whole, so a lost or repeated task leaves the same files. The manifest table, written last, names every
file with size, record count and digest; readers open nothing else.

Equal payloads of at least ``SHARED`` bytes are stored once, in the record of the smallest page_id; the others are
revisit records that refer to it. Headers and digests are made anew for every record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import sharding
from millwright.llm.common import text_slices, utf8
from millwright.session import scratch_dir, written

SHARED, SHARD_BYTES, ROLL, LEVEL = 100, 32 << 20, 8 << 20, 5
DATE = "2025-01-01T00:00:00Z"
_ID = "urn:page:"
_MANIFEST = "file string, n_records bigint, n_bytes bigint, sha256 string"
_RECORD = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(path)


def _texts(pages: DataFrame) -> DataFrame:
    """page_id, url and text; a null html is the empty text."""
    text = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("text")
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), text)


def planned(texts: DataFrame) -> DataFrame:
    """payload_bytes, copies, record_type and refers_to per page_id and payload_digest; payloads themselves stay behind.

    Pages that share payload and smallest page_id are all responses; a null page_id is never the smallest unless all
    are null, and then the page is a response.
    """
    payload = F.encode("text", "UTF-8")
    narrow = texts.select("page_id", F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    rows = written(narrow.groupBy("page_id", "payload_digest", "payload_bytes").agg(F.count("*").alias("copies")), "pages")
    large = rows.where(F.col("payload_bytes") >= SHARED)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.sum("copies").alias("n")).where("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return (
        rows.join(first, "payload_digest", "left")
        .withColumn("refers_to", refers)
        .drop("first")
        .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    )


def _packed(texts: DataFrame) -> DataFrame:
    """page_id, url, payload_digest and the payload, compressed: it moves twice, to meet its plan and to its shard."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in text_slices(batches):
            payloads = utf8(batch.column("text"))
            digest = pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string())
            packed = pa.array([packer.compress(p) for p in payloads], pa.binary())
            arrays = [batch.column("page_id"), batch.column("url"), digest, packed]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "payload_digest", "packed"])

    return texts.mapInArrow(pack, "page_id bigint, url string, payload_digest string, packed binary")


def _with_shards(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """Rows with ``shard``, zeros and ones of a range of page ids."""
    least, most = rows.agg(F.min("page_id"), F.max("page_id")).first()
    bits = max(1, int((most or 0) - (least or 0)).bit_length())
    offset = F.coalesce(F.col("page_id") - F.lit(least or 0), F.lit(0)).cast("bigint")
    # of a page the range only needs id and size; ids of one shard are whole unless one id alone is too large
    key = rows.groupBy(offset.alias("hash")).agg(F.sum(F.col("payload_bytes") * F.col("copies")).alias("bytes"))
    # an id too large for a shard is one of its own, named by its place among the ids
    alone = F.when(F.col("shard").startswith("row"), F.concat(F.lit("id"), F.col("hash").cast("string"))).otherwise(F.col("shard"))
    shards = sharding.assign(key, shard_bytes, min(bits, 62)).select(F.col("hash").alias("offset"), alone.alias("shard"))
    return rows.withColumn("offset", offset).join(shards, "offset").drop("offset")


def _clean(url: str | None) -> str:
    """A URL fit for a header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record with fresh headers; a revisit has no payload of its own."""
    name = f"<{_ID}{'' if page_id is None else page_id}>"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The rolling files of one shard."""

    def __init__(self, folder: str, shard: str, roll: int):
        self.store, self.folder = _place(folder)
        self.shard, self.roll = shard or "all", roll
        self.number, self.out = 0, None

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary/{uuid.uuid4().hex}.warc.gz"
            self.out, self.sha, self.size, self.count = self.store.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0
        member = gzip.compress(raw, LEVEL, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.count += 1

    def full(self) -> bool:
        return self.out is not None and self.size >= self.roll

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self.out.close()
        self.out = None
        name = f"{self.shard}-{self.number:05d}.warc.gz"
        self.number += 1
        self.store.move(self.temporary, f"{self.folder}/{name}")
        return [(name, self.count, self.size, self.sha.hexdigest())]


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll: int = ROLL) -> DataFrame:
    """Write the pages as WARC files in ``folder`` and return the manifest as read back from ``folder/manifest``.

    ``folder`` must be reachable by all executors. An empty table gives an empty manifest.
    """
    store, path = _place(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)
    texts = _texts(pages)
    plan = written(_with_shards(planned(texts), shard_bytes).select("shard", "page_id", "payload_digest", "refers_to"), "warc-plan")
    packed = _packed(texts)
    planned_for = (packed["payload_digest"] == plan["payload_digest"]) & packed["page_id"].eqNullSafe(plan["page_id"])
    joined = packed.join(plan, planned_for).select(packed["*"], "shard", "refers_to")
    dealt = joined.repartition("shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "payload_digest", "url")
    dealt = dealt.select("shard", "page_id", "url", "packed", "payload_digest", "refers_to")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, made, unpacker = None, [], zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):  # one page at a time: a batch of payloads is not copied whole
                shard, page_id, url, packed, digest, refers_to = (c[i].as_py() for c in columns)
                if files is None or files.shard != (shard or "all"):
                    made += files.close() if files else []
                    files = _Files(folder, shard, roll)
                files.add(record(page_id, url, unpacker.decompress(packed), digest, refers_to))
                if files.full():
                    made += files.close()
        made += files.close() if files else []
        columns = list(zip(*made)) if made else [[], [], [], []]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "n_records", "n_bytes", "sha256"])

    dealt.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")
    store.delete_dir(f"{path}/_temporary")
    return pages.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode().split("\r\n")[1:])}


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(_ID)
    return int(number) if number else None


def parse(raw: bytes) -> tuple:
    """The fields of ``_RECORD`` of one WARC record; its digests and lengths are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    if warc["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"damaged record {warc.get('warc-record-id')}")
    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    size = int(warc["payload-length"])
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {warc['warc-record-id']}")
    refers = _page(warc["warc-refers-to"]) if kind == "revisit" else None
    return _page(warc["warc-record-id"]), warc["warc-target-uri"], payload, size, digest, kind, refers


def members(stream: io.RawIOBase, step: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one after another."""
    open_, held, out = zlib.decompressobj(31), b"", []
    while chunk := held or stream.read(step):
        out.append(open_.decompress(chunk))
        held = open_.unused_data
        if open_.eof:
            yield b"".join(out)
            open_, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all files of the manifest: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Without ``payloads`` that column is null; records are checked all the same. Revisits have no payload of their own.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    listed = manifest.repartitionByRange("file").select("file", "n_bytes")
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(os.path.join(path, name), compression=None) as stream:
                    for raw in members(stream):
                        found = parse(raw)
                        rows.append(found if payloads else (*found[:2], None, *found[3:]))
                        size += len(raw)
                        if size >= 4 << 20 or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return listed.mapInArrow(run, _RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to a fresh shared folder and read the records back, without payloads."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    write_archives(pages, folder)
    return read_archives(spark, folder, payloads=False)
