"""WARC archives through a chunked record table.

A page's payload becomes rows (record, chunk number) of bounded size. A task
hands the chunks of a record through running digests, so each row carries the
size and digests of all bytes up to its end, and the last row those of the whole
payload; no step after the first holds a payload in one piece. Records that
share a payload are found by digests alone, then chunks are dealt by record,
and tasks write them one after the other into compressed archives of the shared
folder. Reading takes the archives apart by the same chunks and checks them.

Results in odd cases: a null payload is an empty one; an empty payload is one
empty chunk; rows with equal ids and payloads are records of their own, the
first of which answers for the others; a null id is larger than every other; a
null URL leaves its header out, blanks and control characters in URLs are
written as %XX; an empty table writes no archive and reads back no row; other
columns are not looked at. Ids are whole numbers.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1, sha256
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import saved, table
from wayfare.session import scratch_path

#: Bytes of a payload that one row, and one step of a writer or reader, holds at most.
CHUNK_BYTES = 1 << 18
#: Compressed bytes after which a writer opens its next archive; a record is never parted.
FILE_BYTES = 32 << 20
LEVEL = 4
#: Payloads that more than one record in so many has are looked up by broadcast: there are fewer of them than this.
HEAVY_PART = 1000
CRAWLED = "1970-01-01T00:00:00Z"
SUFFIX = ".warc.gz"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK_COLUMNS = {"record_id": "long", "chunk_no": "long", "data": "binary", "last": "boolean", "n_bytes": "long",
                  "sha1": "binary", "sha256": "binary", "page_id": "long", "url": "string"}


# -- the chunked record table ------------------------------------------------------

def chunked(pages: DataFrame, payload: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (record_id, chunk_no, data, last, n_bytes, sha1, sha256, page_id, url), written to the shared folder.

    n_bytes and the digests run up to the end of the row's chunk; sha256 is
    given with the last one only.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("record_id"), F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("whole"))
    rows = rows.withColumn("chunks", F.greatest(F.ceil(F.length("whole") / chunk_bytes), F.lit(1)).cast("long"))
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    rows = rows.select(
        "record_id", "chunk_no", F.col("whole").substr(F.col("chunk_no").cast("int") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"),
        (F.col("chunk_no") == F.col("chunks") - 1).alias("last"), "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = long = None
        size = 0
        for batch in batches:
            sizes, shorts, longs = [], [], []
            for number, data, last in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                if number == 0:
                    short, long, size = sha1(), sha256(), 0
                part = data.as_buffer()
                short.update(part)
                long.update(part)
                size += len(part)
                sizes.append(size)
                shorts.append(short.copy().digest())
                longs.append(long.digest() if last else None)
            added = [pa.array(sizes, pa.int64()), pa.array(shorts, pa.binary()), pa.array(longs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *added, *batch.columns[4:]], names=list(_CHUNK_COLUMNS))

    made = rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _CHUNK_COLUMNS.items()))
    path = scratch_path(pages.sparkSession, "chunks")
    made.write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(made.schema).parquet(path)


def decided(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per record: its size and digests, and the record that answers for its payload (null: itself).

    Only digests are grouped and joined. Payloads shared by more than a
    thousandth of all records, fewer than a thousand, are looked up by
    broadcast, so that no task gets all copies of one of them.
    """
    keys = ["sha256", "sha1", "n_bytes"]
    heads = chunks.where("last").select("record_id", "page_id", "url", *keys)
    groups = heads.where(F.col("n_bytes") >= min_bytes).groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url")).alias("first"))
    groups = saved(groups.where("n > 1"), "payloads")
    many = F.col("n") * HEAVY_PART > heads.count()
    first = heads.join(F.broadcast(groups.where(many).drop("n")), keys, "left")
    rest = first.where("first is null").drop("first").join(groups.where(~many).drop("n"), keys, "left")
    both = first.where("first is not null").unionByName(rest)
    own = F.col("first.record_id").isNull() | (F.col("first.record_id") == F.col("record_id"))
    return both.select(
        "record_id", "page_id", "url", "n_bytes", "sha1", own.alias("own"), F.col("first.page_id").alias("to_page"),
        F.col("first.record_id").alias("to_record"), F.col("first.url").alias("to_url"))


# -- writing ------------------------------------------------------------------------

def _urn(page_id: int | None, record_id: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{record_id}>"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").split(":")[2]
    return int(number) if number else None


def _target(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


class Archive:
    """One archive being written: each record a gzip member of its own, visible under its name once closed."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self._store, self._base = fs.FileSystem.from_uri(folder)
        self._store.create_dir(self._base, recursive=True)
        self.name = name
        self._own = f"{self._base}/_{name}.{uuid.uuid4().hex}"
        self._out = self._store.open_output_stream(self._own, compression=None)
        self.n_records = self.n_bytes = 0
        fields = b"format: WARC File Format 1.1\r\n"
        self.begin([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{name}>"), ("WARC-Date", CRAWLED), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(fields)))])
        self.add(fields)
        self.end()

    def begin(self, headers: list[tuple[str, str]]) -> None:
        self._packer = zlib.compressobj(LEVEL, wbits=31)
        self.add("".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in headers), "\r\n"]).encode())

    def add(self, data) -> None:
        self._put(self._packer.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self._put(self._packer.flush())
        self.n_records += 1

    def _put(self, data: bytes) -> None:
        if data:
            self._out.write(data)
            self.n_bytes += len(data)

    def close(self) -> None:
        self._out.close()
        self._store.move(self._own, f"{self._base}/{self.name}")


def _heading(page_id, record_id, url, n_bytes, digest, own, to_page, to_record, to_url) -> tuple[list[tuple[str, str]], bytes]:
    """Headers of a record, and the HTTP head its block begins with; that of a revisit still gives the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if own else "revisit"), ("WARC-Record-ID", _urn(page_id, record_id)), ("WARC-Date", CRAWLED)]
    if url is not None:
        headers.append(("WARC-Target-URI", _target(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{b32encode(digest).decode()}"))
    if not own:
        headers += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", _urn(to_page, to_record)), ("WARC-Refers-To-Date", CRAWLED)]
        if to_url is not None:
            headers.append(("WARC-Refers-To-Target-URI", _target(to_url)))
    headers += [("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(http) + (n_bytes if own else 0)))]
    return headers, http


def write(pages: DataFrame, folder: str, payload: str = "html", min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; returns their list (file, n_records, n_bytes).

    A record's heading is a row before its chunks. Rows are dealt by record and
    sorted, so a writer meets each record whole and in order, a chunk at a time.
    """
    chunks = chunked(pages, payload, chunk_bytes)
    head = ["page_id", "record_id", "url", "n_bytes", "sha1", "own", "to_page", "to_record", "to_url"]
    rows = decided(chunks, min_bytes).select(
        "record_id", F.lit(-1).cast("long").alias("chunk_no"), F.lit(None).cast("binary").alias("data"), F.struct(*head).alias("head"))
    rows = rows.unionByName(chunks.select("record_id", "chunk_no", "data"), allowMissingColumns=True)
    rows = rows.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        archive: Archive | None = None
        inside = own = False

        def close():
            archive.close()
            return pa.RecordBatch.from_pydict(
                {"file": [archive.name], "n_records": [archive.n_records], "n_bytes": [archive.n_bytes]}, schema=schema)

        for batch in batches:
            heads = batch.column(3)
            for i, (chunk_no, data) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                if chunk_no >= 0:
                    if own:
                        archive.add(data.as_buffer())
                    continue
                if inside:
                    archive.end()
                    if archive.n_bytes >= file_bytes:
                        yield close()
                        archive, number = None, number + 1
                if archive is None:
                    archive = Archive(folder, f"part-{part:06d}-{number:06d}{SUFFIX}")
                about = heads[i].as_py()
                headers, http = _heading(*(about[name] for name in head))
                archive.begin(headers)
                archive.add(http)
                inside, own = True, about["own"]
        if inside:
            archive.end()
            yield close()

    return saved(rows.mapInArrow(run, "file string, n_records long, n_bytes long"), "archives")


# -- reading ------------------------------------------------------------------------

def _headers(stream) -> tuple[dict[str, str], int]:
    """Header lines up to the blank one, and the bytes read."""
    found, size = {}, 0
    while line := stream.readline():
        size += len(line)
        if line == b"\r\n":
            break
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found, size


def records(stream, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Rows of the chunked record table from one archive's stream of plain bytes, warcinfo left out.

    A revisit is one row without data. Sizes and digests of stored payloads are
    counted anew and have to agree with the headers.
    """
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a record: {line[:40]!r}")
        about, _ = _headers(stream)
        left = int(about["content-length"])
        if about["warc-type"] == "warcinfo":
            stream.read(left)
        else:
            status = stream.readline()
            http, size = _headers(stream)
            n_bytes = int(http["content-length"])
            left -= len(status) + size
            said = about["warc-payload-digest"].removeprefix("sha1:")
            row = {"page_id": _page(about["warc-record-id"]), "url": about.get("warc-target-uri"), "record_type": about["warc-type"],
                   "refers_to": _page(about["warc-refers-to"]) if "warc-refers-to" in about else None, "last": True,
                   "chunk_no": 0, "data": None, "n_bytes": n_bytes, "digest": said}
            if about["warc-type"] == "revisit":
                yield row
            else:
                running, done, number = sha1(), 0, 0
                while number == 0 or left:
                    data = stream.read(min(left, chunk_bytes))
                    if left and not data:
                        raise ValueError(f"{about['warc-record-id']} ends early")
                    running.update(data)
                    left, done = left - len(data), done + len(data)
                    digest = b32encode(running.copy().digest()).decode()
                    if not left and (done, digest) != (n_bytes, said):
                        raise ValueError(f"{about['warc-record-id']} has {done} bytes of digest {digest}, not {n_bytes} of {said}")
                    yield row | {"last": not left, "chunk_no": number, "data": data, "n_bytes": done, "digest": digest}
                    number += 1
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def read_chunks(spark: SparkSession, folder: str, listed: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the listed archives; without data only the last row of each record.

    Spark lists the files and deals them by size, without reading them; a task
    opens each as a stream.
    """
    kinds = {"file": pa.string(), "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
             "chunk_no": pa.int64(), "last": pa.bool_(), "n_bytes": pa.int64(), "digest": pa.string()}
    ddl = "file string, page_id long, url string, record_type string, refers_to long, chunk_no long, last boolean, n_bytes long, digest string"
    if with_data:
        kinds["data"], ddl = pa.binary(), f"{ddl}, data binary"
    schema = pa.schema(list(kinds.items()))
    if listed.isEmpty():
        return spark.createDataFrame([], ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for name in chain.from_iterable(batch.column(0).to_pylist() for batch in batches):
            name = name.rsplit("/", 1)[-1]
            held: list[dict] = []
            waiting = 0
            with store.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for row in records(stream, chunk_bytes):
                    if with_data or row["last"]:
                        held.append(row | {"file": name} if with_data else {**row, "file": name, "data": None})
                        waiting += len(held[-1]["data"] or b"")
                    if len(held) == 1024 or waiting >= 16 * chunk_bytes:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, waiting = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path")
    return files.mapInArrow(run, ddl)


def read(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, from the archives."""
    return read_chunks(spark, folder, listed, with_data=False).select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op12_warc_archives(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    return read(spark, folder, write(table(spark, sf_dir, "pages"), folder))


OP12_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, 1 + 5 * (j // 4)::INT, 5))::BIGINT >> (15 - 5 * (j % 4))::INT) & 31)::INT, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM p
"""
