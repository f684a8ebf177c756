"""WARC archives with a two-level capture index.

Captures are sorted by key (the URL with its host reversed, then the page's id) over range partitions. Each partition
writes one archive, a gzip member per record, and one index shard: the sorted index lines in compressed blocks, and after
them a sparse directory with the first key of each block. A lookup finds the shard among the shards' first keys (one
per partition, so their number is bounded by ``spark.sql.shuffle.partitions``), binary-searches its directory, reads
and expands one block by its range, binary-searches its lines and reads the record by its range.

Of captures with equal payloads that with the largest page_id is stored, the others are revisits of it. Payloads are
moved once, by key; roles are found on (key, digest) alone and meet the payloads in key order. Digests are joined table
to table, so a payload that a third of all pages share is split over tasks.

Files go to the shared folder under names of their own, so that a task that runs again leaves the first run's files
unread; a shard counts only if its task's result came back. The folder is reached through pyarrow's file systems.

Defined results: a null html is an empty payload; a null url has an empty key; a null page_id is the smallest, and where
all ids of a payload are null all its rows are responses, as are rows that repeat the largest id; rows that repeat are
captures of their own; without pages there are no archives; a page is one record whatever its length (a task holds a
few times the longest); extra columns play no part.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import new_folder
from .common import materialize

#: Index lines of a block.
BLOCK_LINES = 512
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
_URN = "<urn:capture:{}>"


def capture_key(url: Column, page_id: Column) -> Column:
    """Host labels from the last to the first, path and query; then the page's id, so that keys sort as strings."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?"
    has_host = url.rlike(pattern)
    rest = F.regexp_replace(url, pattern, "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.regexp_replace(F.substring(rest, F.length(host) + 1, F.length(rest)), r"#.*$", "")
    surt = F.when(has_host, F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)).otherwise(F.coalesce(url, F.lit("")))
    high = F.when(page_id.isNull(), F.lit("-")).otherwise(F.concat(F.when(page_id < 0, F.lit("0")).otherwise(F.lit("1")), F.lpad((page_id.bitwiseAND(F.lit((1 << 63) - 1))).cast("string"), 19, "0")))
    return F.concat(F.regexp_replace(surt, r"[\x00-\x20]", "%20"), F.lit(" "), high)


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, kind: str) -> bytes:
    """One record; a revisit has the HTTP head alone."""
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", _URN.format("none" if page_id is None else page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _URN.format(refers_to))]
    head.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def read_record(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of a record; checked against its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or len(rest) != size + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a whole record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError("the payload does not match its header")

    def number(name):
        text = re.fullmatch(r"<urn:capture:(.*)>", fields[name])[1]
        return None if text == "none" else int(text)

    return {"page_id": number("WARC-Record-ID"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To") if kind == "revisit" else None, "payload": payload}


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return the shards: archive, shard, first_key, last_key, n, at, size.

    Equal payloads of less than ``revisit_from`` bytes are all stored.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    captures = pages.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), F.col("page_id").cast("long"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    # both sides of the join are tables, so that Spark can split a digest with any share of the rows
    narrow = materialize(captures.where(F.col("size") >= revisit_from).select("key", "page_id", "digest"), "captures")
    first = narrow.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = materialize(first, "firsts")
    again = narrow.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first_id"))).select("key", "digest", F.col("first_id").alias("refers_to"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("html", "string"), ("size", "int"))]
    both = captures.select("key", "digest", "page_id", "url", "html", "size", F.lit(None).cast("long").alias("refers_to"), F.lit(True).alias("capture")).unionByName(
        again.distinct().select("key", "digest", *empty, "refers_to", F.lit(False).alias("capture"))
    )
    dealt = both.repartitionByRange(parts, "key").sortWithinPartitions("key", "digest", "capture")

    def write(batches):
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        archive, shard = f"{root}/{name}.warc.gz", f"{root}/{name}.index"
        out = index = None
        at = n = 0
        lines, directory, keys = [], [], []
        role = (None, None, None)

        def flush():
            raw = zlib.compress("\n".join(lines).encode())
            directory.append([lines[0].rsplit(" ", 2)[0], index.tell(), len(raw)])
            index.write(raw)
            lines.clear()

        for batch in batches:
            for key, digest, page_id, url, html, size, refers_to, capture in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if not capture:
                    role = (key, digest, refers_to)
                    continue
                if out is None:
                    out, index = system.open_output_stream(archive, compression=None), system.open_output_stream(shard, compression=None)
                    keys = [key, key]
                kind = "revisit" if role[:2] == (key, digest) else "response"
                raw = gzip.compress(record(page_id, url, None if kind == "revisit" else (html or "").encode(), size, base32(digest), role[2], kind), LEVEL, mtime=0)
                out.write(raw)
                lines.append(f"{key} {at} {len(raw)}")
                at, n, keys[1] = at + len(raw), n + 1, key
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        start, raw = index.tell(), zlib.compress(json.dumps(directory).encode())
        index.write(raw)
        out.close()
        index.close()
        yield pa.RecordBatch.from_pylist([{"archive": f"{name}.warc.gz", "shard": f"{name}.index", "folder": folder, "first_key": keys[0], "last_key": keys[1], "n": n, "at": start, "size": len(raw)}])

    shards = dealt.mapInArrow(write, "archive string, shard string, folder string, first_key string, last_key string, n long, at long, size long")
    return materialize(shards, "shards")


@dataclass
class Index:
    """Looks captures up; remembers the shard, block and archive of the last lookup, so sorted keys read each once."""

    shards: list[dict]

    def __post_init__(self):
        self.shards = sorted(self.shards, key=lambda s: s["first_key"])
        self.firsts = [s["first_key"] for s in self.shards]
        self.open = self.block = (None, None)
        self.directory: tuple = (None, [], [])

    def _read(self, folder: str, name: str, at: int, size: int) -> bytes:
        if self.open[0] != (folder, name):
            if self.open[1]:
                self.open[1].close()
            system, root = _file_system(folder)
            self.open = ((folder, name), system.open_input_file(f"{root}/{name}"))
        self.open[1].seek(at)
        return self.open[1].read(size)

    def _lines(self, shard: dict, entry: list) -> list[str]:
        where = (shard["shard"], entry[1])
        if self.block[0] != where:
            self.block = (where, zlib.decompress(self._read(shard["folder"], shard["shard"], entry[1], entry[2])).decode().split("\n"))
        return self.block[1]

    def find(self, key: str) -> Iterator[tuple[dict, int, int]]:
        """Shard, offset and length of every capture with this key."""
        i = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        for shard in self.shards[i:]:
            if shard["first_key"] > key:
                return
            if shard["last_key"] < key:
                continue
            if self.directory[0] != shard["shard"]:
                found = json.loads(zlib.decompress(self._read(shard["folder"], shard["shard"], shard["at"], shard["size"])))
                self.directory = (shard["shard"], found, [e[0] for e in found])
            _, entries, firsts = self.directory
            for entry in entries[max(bisect.bisect_left(firsts, key) - 1, 0) :]:
                if entry[0] > key:
                    return
                lines = self._lines(shard, entry)
                for line in lines[bisect.bisect_left(lines, key + " ") :]:
                    own, at, size = line.rsplit(" ", 2)
                    if own != key:
                        break
                    yield shard, int(at), int(size)

    def records(self, key: str) -> Iterator[dict]:
        for shard, at, size in list(self.find(key)):
            yield read_record(gzip.decompress(self._read(shard["folder"], shard["archive"], at, size)))


_CAPTURE = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def look_up(keys: DataFrame, shards: DataFrame) -> DataFrame:
    """The captures of the distinct ``key`` values: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = keys.sparkSession
    found = [r.asDict() for r in shards.collect()]  # a row for each partition that was written
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches):
        index = Index(found)
        for batch in batches:
            out = []
            places = [p for key in batch.column("key").to_pylist() for p in index.find(key)]
            for shard, at, size in places:  # in the archive's order, as keys are sorted
                got = read_record(gzip.decompress(index._read(shard["folder"], shard["archive"], at, size)))
                out.append({c: got[c] for c in _CAPTURE.names})
            yield pa.RecordBatch.from_pylist(out, _CAPTURE)

    sorted_keys = keys.select("key").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Write the pages' archives, then look every page up in them."""
    shards = write_archives(pages, revisit_from=revisit_from)
    return look_up(pages.select(capture_key(F.col("url"), F.col("page_id").cast("long")).alias("key")), shards)


def read_stream(raw: bytes) -> Iterator[dict]:
    """All records of an archive, one after another, without its index."""
    stream = io.BytesIO(raw)
    while stream.tell() < len(raw):
        expand = zlib.decompressobj(31)
        at = stream.tell()
        record_bytes = expand.decompress(raw[at:])
        stream.seek(len(raw) - len(expand.unused_data))
        yield read_record(record_bytes)


def oracle_sql(pages: str = "pages") -> str:
    """DuckDB SQL for ``archive_and_read`` of a table with page_id, url and html."""
    nibble = "CAST('0x' || substr(hex, {}, 1) AS INTEGER)"
    byte = f"({nibble.format('i * 5 // 4 + 1')} * 16 + {nibble.format('i * 5 // 4 + 2')})"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM {pages}),
first AS (SELECT hex, max(page_id) AS first_id FROM p GROUP BY hex)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
 list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({byte} >> CAST(3 - i * 5 % 4 AS INTEGER)) & 31 AS INTEGER) + 1, 1)), 'string_agg', '') AS payload_digest,
 CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM p JOIN first USING (hex)"""
