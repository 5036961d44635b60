"""WARC archives with a two-level capture index.

``write_archives`` writes records (one gzip member each) to files of bounded size in a shared folder and gives a row per record.
``write_index`` sorts them by capture key, the URL with its host reversed followed by the record id, into index files: blocks of
``LINES`` compressed lines, then a sparse directory of the blocks' first keys. The first key of each index file makes the upper level.
``lookup`` finds the file of a key among these (one entry per file), binary-searches the file's directory, reads that block alone,
binary-searches its lines, and then reads the byte range of the record in its archive. ``read_archives`` reads whole archives.

A file belongs to the archive only if the task that wrote it ended well and so reported it; a lost task leaves a file that nobody
reads. Files are opened through ``pyarrow.fs``, so the folder may be on any shared store that it knows.

Of records with equal payloads the one with the largest page_id is a response, the others are revisits that refer to it by URL and
record id. Payload groups are pre-aggregated, and only groups of several rows are joined back.

Defined results: a null html is an empty payload, a null url gives no target and the key ``-``; a null page_id counts as smaller than
any number; rows that share the largest page_id of a group are all responses. Empty tables give an index without lines. Only the
three columns named are read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.llm.common import shuffle_partitions
from tapelake.plans.staging import new_folder, stage

ARCHIVE_BYTES = 64 << 20
LINES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The tables hold no capture time.
DATE = "1970-01-01T00:00:00Z"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(text: str) -> str:
    """Text without spaces and control characters, as a field of an index line or header needs it."""
    return re.sub(r"[\x00-\x20%\x7f-\x9f  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


def capture_key(url: str | None) -> str:
    """``http://www.Example.com:81/a?b#c`` -> ``com,example,www:81)/a?b``; other texts stand for themselves."""
    if url is None:
        return "-"
    _, mark, rest = url.partition("://")
    if not mark:
        return one_line(url) or "-"
    host, tail = re.match(r"([^/?#]*)([^#]*)", rest, re.DOTALL).groups()
    name, colon, port = host.rpartition(":") if re.search(r":\d*$", host) else (host, "", "")
    return one_line(",".join(reversed(name.lower().split("."))) + colon + port + ")" + tail)


def record_id(page_id: int | None, url: str | None) -> str:
    return str(uuid.UUID(bytes=hashlib.md5(json.dumps([page_id, url]).encode()).digest()))


# ---- records ------------------------------------------------------------------------------------------------------------
def record(page_id, url, payload: bytes, refers_to: tuple | None) -> bytes:
    """One record, uncompressed; ``refers_to`` (page_id, url) makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {"WARC-Type": "revisit" if refers_to else "response", "WARC-Record-ID": f"<urn:uuid:{record_id(page_id, url)}>", "WARC-Date": DATE}
    if url is not None:
        fields["WARC-Target-URI"] = one_line(url)
    if page_id is not None:
        fields["Page-ID"] = page_id
    fields["WARC-Payload-Digest"] = "sha1:" + payload_digest(payload)
    if refers_to:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:uuid:{record_id(*refers_to)}>", "WARC-Refers-To-Date": DATE, "WARC-Refers-To-Key": capture_key(refers_to[1])}
        if refers_to[1] is not None:
            fields["WARC-Refers-To-Target-URI"] = one_line(refers_to[1])
    block = http if refers_to else http + payload
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def packed(data: bytes) -> bytes:
    """A gzip member."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a file's gzip members, one at a time."""
    press, out, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        out.append(press.decompress(data))
        if press.eof:
            yield b"".join(out)
            data, out, press = press.unused_data, [], zlib.decompressobj(31)
            data = data or stream.read(chunk)
        else:
            data = stream.read(chunk)
    if out and any(out):
        raise ValueError("archive ends inside a record")


# ---- writing ------------------------------------------------------------------------------------------------------------
ENTRY = "key string, archive string, offset long, length long"


def _write(folder: str, limit: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        out, name, place = None, "", 0
        for batch in batches:
            found = []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                page_id, url, payload, revisit, first_id, first_url = row
                if out is None or place >= limit:
                    if out is not None:
                        out.close()
                    name, place = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                data = packed(record(page_id, url, payload.encode(), (first_id, first_url) if revisit else None))
                out.write(data)
                found.append((f"{capture_key(url)} {record_id(page_id, url)}", name, place, len(data)))
                place += len(data)
            columns = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return rows


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, revisit, first_id, first_url."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("first")).where("n > 1")
    groups = stage(groups.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("shared")), "payloads")
    revisit = F.coalesce("shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", revisit.alias("revisit"), "first_id", "first_url")


def write_archives(pages: DataFrame, folder: str, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page (page_id, url, html) below ``folder``; a row per record: key, archive, offset, length."""
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    return stage(with_roles(pages).mapInArrow(_write(folder, limit), ENTRY), "records")


def _write_index(folder: str, lines: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        name, directory, held, first, place = f"{uuid.uuid4().hex}.idx", [], [], None, 0
        out = None
        for batch in batches:
            for key, archive, offset, length in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    out, first = store.open_output_stream(f"{path}/{name}", compression=None), key
                held.append(f"{key} {archive} {offset} {length}")
                if len(held) == lines:
                    place += _block(out, held, directory, place)
        if out is None:
            return
        if held:
            _block(out, held, directory, place)
        data = zlib.compress(json.dumps(directory).encode())
        out.write(data + struct.pack("<Q", len(data)))
        out.close()
        yield pa.record_batch({"first": pa.array([first]), "file": pa.array([name])})

    return rows


def _block(out, held: list[str], directory: list, place: int) -> int:
    data = zlib.compress("\n".join(held).encode())
    out.write(data)
    directory.append((" ".join(held[0].split(" ")[:2]), place, len(data)))
    held.clear()
    return len(data)


def write_index(entries: DataFrame, folder: str, lines: int = LINES) -> list[tuple[str, str]]:
    """Write the capture index below ``folder``; the first key and name of each index file, in order."""
    parts = shuffle_partitions(entries.sparkSession)
    ordered = entries.repartitionByRange(parts, "key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")
    files = stage(ordered.mapInArrow(_write_index(folder, lines), "first string, file string"), "index")
    return [tuple(row) for row in files.orderBy("first").collect()]


# ---- reading ------------------------------------------------------------------------------------------------------------
class IndexFile:
    """One index file: its directory, and the block read last."""

    def __init__(self, store: fs.FileSystem, path: str) -> None:
        self.file = store.open_input_file(path)
        size = self.file.size()
        (length,) = struct.unpack("<Q", self.file.read_at(8, size - 8))
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.firsts = [entry[0] for entry in self.directory]
        self.number, self.lines = -1, []

    def find(self, key: str) -> tuple[str, int, int] | None:
        """(archive, offset, length) of the first record with a key."""
        # A key that begins a block may also end the block before.
        number = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while number < len(self.firsts) and self.firsts[number] <= key:
            if number != self.number:
                _, place, length = self.directory[number]
                self.number, self.lines = number, zlib.decompress(self.file.read_at(length, place)).decode().split("\n")
            at = bisect.bisect_left(self.lines, key + " ")
            if at < len(self.lines) and self.lines[at].startswith(key + " "):
                archive, offset, length = self.lines[at][len(key) + 1 :].split(" ")
                return archive, int(offset), int(length)
            number += 1
        return None


FOUND = "key string, page_id long, payload_bytes long, payload_digest string"


def _file_of(index: list[tuple[str, str]]):
    firsts = [first for first, _ in index]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            # Equal keys may run over from the file before; start there, the reader goes on.
            numbers = [max(0, bisect.bisect_left(firsts, key) - 1) for key in keys]
            yield pa.record_batch({"key": batch.column(0), "number": pa.array(numbers, pa.int32())})

    return rows


def _resolve(folder: str, index: list[tuple[str, str]]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        number, held, archive, file = -1, None, None, None
        for batch in batches:
            found = []
            for key, start in zip(batch.column("key").to_pylist(), batch.column("number").to_pylist(), strict=True):
                hit = None
                for at in range(start, len(index)):
                    if index[at][0] > key:
                        break
                    if at != number:
                        number, held = at, IndexFile(store, f"{path}/{index[at][1]}")
                    if hit := held.find(key):
                        break
                if hit is None:
                    raise ValueError(f"no capture {key}")
                if hit[0] != archive:
                    archive, file = hit[0], store.open_input_file(f"{path}/{hit[0]}")
                fields, payload = parsed(zlib.decompress(file.read_at(hit[2], hit[1]), 31))
                found.append((key, int(fields["Page-ID"]) if "Page-ID" in fields else None, len(payload), payload_digest(payload)))
            columns = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["key", "page_id", "payload_bytes", "payload_digest"])

    return rows


def lookup(keys: DataFrame, folder: str, index: list[tuple[str, str]]) -> DataFrame:
    """For distinct capture keys: key, page_id, payload_bytes, payload_digest of the record found by range reads."""
    parts = shuffle_partitions(keys.sparkSession)
    placed = keys.select("key").mapInArrow(_file_of(index), "key string, number int")
    dealt = placed.repartitionByRange(parts, "number", "key").sortWithinPartitions("number", "key")
    return dealt.mapInArrow(_resolve(folder, index), FOUND)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_key string"


def _read(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, payload = parsed(data)
                        page, kind = fields.get("Page-ID"), fields["WARC-Type"]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        refers = None
                        if kind == "revisit":
                            refers = fields["WARC-Refers-To-Key"] + " " + fields["WARC-Refers-To"].removeprefix("<urn:uuid:").removesuffix(">")
                        elif payload_digest(payload) != digest:
                            raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {name}")
                        found.append((None if page is None else int(page), len(payload), digest, kind, refers))
                columns = list(zip(*found, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_key"])

    return rows


def read_archives(entries: DataFrame, folder: str, index: list[tuple[str, str]]) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Payload size, digest and page_id of what a revisit refers to come from the record found through the index.
    """
    # Dealt first and made distinct then: the other way round the planner would drop the dealing and adaptive execution pack all
    # names, tiny as they are, into one task.
    names = entries.select("archive").repartition(shuffle_partitions(entries.sparkSession), "archive").distinct()
    rows = stage(names.mapInArrow(_read(folder), READ), "captures")
    revisits = rows.where("record_type = 'revisit'")
    found = lookup(revisits.select(F.col("refers_key").alias("key")).distinct(), folder, index)
    found = found.select(F.col("key").alias("refers_key"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("found_bytes"), F.col("payload_digest").alias("found_digest"))
    found = stage(found, "referred")
    joined = revisits.join(found, "refers_key")
    digest = F.when(F.col("found_digest") == F.col("payload_digest"), F.col("found_digest")).otherwise(F.raise_error(F.lit("a revisit refers to another payload")))
    own = rows.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(joined.select("page_id", F.col("found_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to"))


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive pages in a new shared folder, index them, and read them back."""
    folder = new_folder(spark, "warc")
    entries = write_archives(pages, folder)
    index = write_index(entries, folder)
    return read_archives(entries, folder, index)
