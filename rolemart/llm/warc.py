"""WARC archives written and read by an index.

Writing gives, besides the archive files, one index row per record: file, offset, length, URL and payload digest. Reading
takes selected index rows, sorts them by file and offset, joins neighbouring byte ranges into larger reads, and parses the
records out of those; archives are never scanned. Records are compressed one by one, so each can be read on its own.

Scale: each task writes an archive of its own under a name that no other attempt has, and its index rows count only if the
attempt succeeded, so a lost executor leaves at most a file that no index row names. Equal payloads are found by their
digest: pages are counted per digest before the shuffle, and a digest is looked up in parts, so a payload that a third of
the pages share loads no single task. Payloads move once, by page_id and digest, to meet what was decided about them. Files go through ``pyarrow.fs``, which reaches
local and shared folders and the common object stores.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import bytes_of, landed
from rolemart.session import new_scratch

_PARTS = 32
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, file string, offset long, length long, url string, payload_digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, payload binary"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[6:]
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header_value(text: str | None) -> str:
    return " ".join((text or "").split())


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: the payload under its HTTP header, or for a revisit the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_header_value(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join([*fields, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields (names in lower case), payload length by the HTTP header, and the payload that is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not at the start of a record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut or followed by other bytes")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, size, payload


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [c.split() for c in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per page: page_id, url, payload, digest (hex), and as refers_to the page whose record carries an equal payload.

    Of equal payloads of at least ``least_bytes`` bytes, the page with the largest page_id is the original. Pages of a digest
    that occurs once are not looked up anywhere.
    """
    payload = bytes_of(pages, "html")
    read = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    hashed = read.withColumn("digest", F.sha1("payload"))
    groups = (
        hashed.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 AND original IS NOT NULL").drop("n")
    )
    # ids only: each shared digest is there once per part, each page asks one part
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    asked = hashed.select("page_id", "digest", F.octet_length("payload").alias("size")).withColumn("part", F.pmod(F.xxhash64("page_id"), F.lit(_PARTS)).cast("int"))
    revisits = (
        asked.where(F.col("page_id").isNotNull() & (F.col("size") >= least_bytes)).join(parts, ["digest", "part"])
        .where(F.col("page_id") < F.col("original")).select("page_id", "digest", F.col("original").alias("refers_to")).distinct()
    )
    return hashed.join(revisits.hint("shuffle_hash"), ["page_id", "digest"], "left")  # the payload side needs no sort


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write one record per page into archives under ``folder`` and return the index, one row per record.

    A NULL or empty html is an empty payload. A page_id that occurs again with the same payload gives one more response
    record. A page without page_id, or whose payload no other page has, is a response record. An empty table writes no
    archive and gives an empty index. Further columns are not archived. White space in URLs becomes single spaces.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        out, at = None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        filesystem.create_dir(root, recursive=True)
                        out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
                    data = _gzip(record_bytes(page_id, url, payload, sha1, refers_to))
                    out.write(data)
                    rows.append((page_id, name, at, len(data), url, sha1, "response" if refers_to is None else "revisit", refers_to))
                    at += len(data)
                yield _table(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    found = originals(pages, least_bytes).select("page_id", "url", "payload", "digest", "refers_to")
    return landed(found.mapInArrow(in_task, INDEX), "warc-index")


def byte_ranges(index: DataFrame, gap: int = 65_536, most: int = 8_388_608) -> DataFrame:
    """Coalesced reads: file, start, end, records (array of page_id, offset, length, refers_to), sorted by offset.

    Neighbouring records share a read if at most ``gap`` unread bytes lie between them and both start in the same
    ``most`` bytes of the file, so a read and what one task holds are bounded for archives of any size.
    """
    cell = index.withColumn("cell", (F.col("offset") / most).cast("long"))
    records = F.sort_array(F.collect_list(F.struct("offset", "length", "page_id", "refers_to")))
    cells = cell.groupBy("file", "cell").agg(records.alias("records"))  # at most ``most`` bytes of records each

    def join(runs, r):
        last = F.element_at(runs, -1)
        fresh = (F.size(runs) == 0) | (r["offset"] - F.coalesce(F.try_element_at(runs, F.lit(-1))["end"], F.lit(0)) > gap)
        end = r["offset"] + r["length"]
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))
        return F.when(fresh, F.concat(runs, F.array(F.struct(r["offset"].alias("start"), end.alias("end"))))).otherwise(
            F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(wider)))

    runs = F.aggregate("records", F.array().cast("array<struct<start:bigint,end:bigint>>"), join)
    each = cells.withColumn("run", F.explode(runs))
    inside = F.filter("records", lambda r: (r["offset"] >= F.col("run.start")) & (r["offset"] < F.col("run.end")))
    return each.select("file", F.col("run.start").alias("start"), F.col("run.end").alias("end"), inside.alias("records"))


def read(index: DataFrame, folder: str, gap: int = 65_536, most: int = 8_388_608) -> DataFrame:
    """Records of the given index rows: RECORD columns. A revisit's payload is NULL; its size is that of its original.

    Every payload that is there is checked against its digest; a record that is cut, moved or changed fails the job. An
    empty index reads nothing.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with filesystem.open_input_file(f"{root}/{r['file']}") as file:
                    data = file.read_at(r["end"] - r["start"], r["start"])
                rows = []
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    fields, size, payload = parse_record(zlib.decompress(data[at : at + x["length"]], 31))
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-record-id"] != record_id(x["page_id"]) or kind == "response" and (len(payload), digest_of(payload)) != (size, digest):
                        raise ValueError(f"record of page {x['page_id']} in {r['file']} is not what the index says")
                    if kind == "revisit" and fields["warc-refers-to"] != record_id(x["refers_to"]):
                        raise ValueError(f"revisit of page {x['page_id']} refers to another record")
                    rows.append((x["page_id"], fields["warc-target-uri"], digest, size, kind, x["refers_to"], payload if kind == "response" else None))
                yield _table(rows, RECORD)

    return byte_ranges(index, gap, most).mapInArrow(in_task, RECORD)


def archive_folder(spark) -> str:
    return new_scratch(spark, "warc")
