import hashlib
import io
import struct

import zstandard
from pyspark.sql import types as T

from riskmart.llm import warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("payload", T.IntegerType()), T.StructField("digest", T.IntegerType())])


class Kept(io.BytesIO):
    def close(self):
        pass


def test_dictionary_leads_and_records_stand_alone():
    records = [warc._record(i, f"http://h/{i}", b"<html>the same words %d</html>" % i * 9, "00" * 20, None, warc.DATE) for i in range(400)]
    out = Kept()
    writer = warc.ArchiveWriter(out, sample_bytes=20_000)
    for r in records:
        writer.write(r)
    writer.close()
    raw = out.getvalue()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICTIONARY_FRAME
    learnt = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    assert learnt.dict_id()
    first = zstandard.ZstdDecompressor(dict_data=learnt).decompressobj()
    assert first.decompress(raw[8 + size :]) == records[0] and first.eof
    assert list(warc._frames(io.BytesIO(raw))) == records
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(raw) < alone


def test_few_records_have_no_dictionary():
    out = Kept()
    writer = warc.ArchiveWriter(out)
    writer.write(b"one")
    writer.close()
    assert list(warc._frames(io.BytesIO(out.getvalue()))) == [b"one"]
    empty = Kept()
    warc.ArchiveWriter(empty).close()
    assert list(warc._frames(io.BytesIO(empty.getvalue()))) == []


def test_odd_pages(spark, tmp_path):
    long = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 100
    rows = [
        (1, "http://a/\r\nX: y", long),
        (5, None, long),
        (3, "http://b/ c", long),
        (None, "u", long),
        (4, "", None),
        (6, "x", ""),
        (7, "x", "short"),
        (8, "x", "short"),
        ((1 << 53) + 1, "big", "z" * 3_000_000),
        (9, "d", "twice" * 300),
        (9, "d", "twice" * 300),
        (None, "n", "none" * 300),
        (None, "n", "none" * 300),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    folder, listed = warc.archive(df, str(tmp_path / "w"), archive_bytes=500)
    got = warc.read_archives(listed, folder).collect()
    assert listed.count() > 3 and sum(r.records for r in listed.collect()) == len(rows)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        refers = max(same) if len(raw) >= 1000 and same and page != max(same) else None
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers, raw if refers is None else None))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in got]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert {r.url for r in got if r.page_id == 1} == {"http://a/%0D%0AX:%20y"}


def test_empty_table(spark, tmp_path):
    folder, listed = warc.archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_archives(listed, folder).collect() == []
