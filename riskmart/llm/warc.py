"""WARC archives whose records are compressed one by one with a dictionary kept in the file.

An archive begins with a skippable Zstandard frame that holds a dictionary built from its own first
records; every record after it is a frame of its own. So any record can be read alone, given the
dictionary, and small records still compress well.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import scratch_path

#: Fixed values of the archive format: magic number of the dictionary's frame, protocol profile of revisits.
DICTIONARY_FRAME = 0x184D2A5D
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads shorter than this are always stored.
LEAST_REVISIT = 1000
#: The dictionary is built from this many bytes of an archive's first records.
SAMPLE_BYTES = 2_000_000
DICTIONARY_BYTES = 112_640
#: An archive ends with the record that fills it; readers take one archive each.
ARCHIVE_BYTES = 256_000_000
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"


def with_record_types(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): what is to be archived.

    Of records with equal payloads of `least` bytes or more, that with the largest page_id is the
    response, and the others refer to it; shorter ones are all responses. Null html is an empty
    payload. Repeated rows with the largest id are all responses; null ids refer to the largest
    id, and are responses where there is none.

    Digests are combined before they are shuffled, so a payload that a third of all pages share
    costs one row a task, and the left side of the join may be split by adaptive execution.
    """
    payload = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = rows.filter(F.octet_length("payload") >= least)
    kept = long.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    refers = F.when((F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))
    return rows.join(kept, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    name = "" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{name}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block = http + payload
    else:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
        block = http
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def _information(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for records like `samples`; empty where there is too little to learn from."""
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 4096:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 16)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Writes records to a binary stream; the first ones wait until the dictionary is built."""

    def __init__(self, out: BinaryIO, sample_bytes: int = SAMPLE_BYTES):
        self._out = out
        self._waiting: list[bytes] | None = []
        self._sample_bytes, self._held = sample_bytes, 0
        self.written = 0

    def write(self, record: bytes) -> None:
        if self._waiting is None:
            self._frame(record)
            return
        self._waiting.append(record)
        self._held += len(record)
        if self._held >= self._sample_bytes:
            self._begin()

    def _begin(self) -> None:
        waiting, self._waiting, self._held = self._waiting or [], None, 0
        learnt = dictionary([r[:65_536] for r in waiting])
        if learnt:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(learnt)) + learnt)
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(learnt) if learnt else None)
        for record in waiting:
            self._frame(record)

    def _put(self, raw: bytes) -> None:
        self._out.write(raw)
        self.written += len(raw)

    def _frame(self, record: bytes) -> None:
        self._put(self._compressor.compress(record))

    @property
    def size(self) -> int:
        """Bytes written, and those that wait."""
        return self.written + self._held

    def close(self) -> None:
        if self._waiting is not None:
            self._begin()
        self._out.close()


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Writes (page_id, url, payload, digest, refers_to) to archives below `folder`; (path, records, bytes).

    Each task writes its rows as they come to archives of its own and reports them when they are
    closed. File names are new in every attempt, so what a lost or repeated attempt wrote is in no
    report. The result is lazy: store it once, since reading it twice writes twice. An empty table
    makes no archive. `folder` is a URI of a file system that pyarrow can write to.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        writer, name, n = None, "", 0

        def report() -> pd.DataFrame:
            writer.close()
            return pd.DataFrame({"path": [name], "records": [n], "bytes": [writer.written]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if writer is None:
                    name, n = f"{uuid.uuid4().hex}.warc.zst", 0
                    writer = ArchiveWriter(system.open_output_stream(f"{base}/{name}"))
                    writer.write(_information(date))
                page = None if pd.isna(row.page_id) else int(row.page_id)
                refers = None if pd.isna(row.refers_to) else int(row.refers_to)
                writer.write(_record(page, row.url if isinstance(row.url, str) else None, row.payload, row.digest, refers, date))
                n += 1
                if writer.size >= archive_bytes:
                    yield report()
                    writer = None
        if writer is not None:
            yield report()

    # Ids beyond 2^53 would not survive as floating-point numbers, which pandas makes of nulls.
    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]
    return records.select(ids[0], "url", "payload", "digest", ids[1]).mapInPandas(write, "path string, records long, bytes long")


def _frames(stream: BinaryIO) -> Iterator[bytes]:
    """Records of an archive, one at a time."""
    decoder = zstandard.ZstdDecompressor()
    data = b""
    head = stream.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        learnt = stream.read(struct.unpack("<I", head[4:])[0])
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learnt))
    else:
        data = head
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            return
        one, out = decoder.decompressobj(), []
        while True:
            out.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            data = stream.read(1 << 20)
            if not data:
                raise EOFError("the archive ends inside a record")
        yield b"".join(out)


def _parsed(record: bytes) -> dict | None:
    """What a response or revisit says of its page; the payload's digest is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["x-payload-length"])):
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    page = lambda name: fields.get(name, "").removeprefix("<urn:x-page:").removesuffix(">") or None
    return {
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(fields["x-payload-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "payload": payload if kind == "response" else None,
    }


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of the archives reported in `archives`: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, and the payload of responses. Each archive streams through one task."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["path"]:
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}") as stream:
                    for record in _frames(stream):
                        row = _parsed(record)
                        if row:
                            rows.append(row)
                            size += len(record)
                        if size > 8_000_000:
                            yield pd.DataFrame(rows)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    found = archives.select("path").mapInPandas(read, schema)
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def archive(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Writes every page to archives in the shared folder, once, and returns the folder and its list of archives.

    The list is stored beside the archives, as a table.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    write_archives(with_record_types(pages), f"{folder}/archives", archive_bytes).write.parquet(f"{folder}/list")
    listed = spark.read.parquet(f"{folder}/list")
    n = listed.count()
    return f"{folder}/archives", listed.repartition(max(n, 1)) if n else listed
