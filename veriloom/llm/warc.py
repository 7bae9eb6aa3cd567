"""WARC archives in Zstandard with a shared dictionary: ``.warc.zst`` files.

Each file starts with a skippable frame that holds the dictionary; every record is a frame of its own, so that records can be
read singly. Tasks write files to the shared folder and report them; only files reported by a finished task are read, so repeated or
lost tasks leave no trace in the result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import bounded_sample, byte_slices
from veriloom.session import materialise, work_dir

#: Fixed values of the formats: the skippable frame for dictionaries, the start of a dictionary, the profile of revisits.
SKIPPABLE, DICT_MAGIC = 0x184D2A5D, 0xEC30A437
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAMPLE_ROWS, SAMPLE_RECORD, DICT_BYTES = 1000, 16 << 10, 112_640
FILE_BYTES = 64 << 20
SLICE_BYTES = 4 << 20


def train(pages: DataFrame, html: str = "html", page: str = "page_id") -> bytes:
    """A dictionary from at most SAMPLE_ROWS whole records of up to SAMPLE_RECORD bytes each (so 16 MB in all), those with the
    smallest hashes of their ids; empty if they don't suffice. It only affects how well archives compress, never what they hold."""
    import zstandard

    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page).alias("page_id"), text.alias("text")).where(F.octet_length("text").between(1, SAMPLE_RECORD))
    rows = bounded_sample(rows, SAMPLE_ROWS, "page_id").select("text").collect()
    samples = sorted(r["text"].encode() for r in rows)
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def plan(pages: DataFrame, html: str = "html", page: str = "page_id", url: str = "url", least: int = 1000) -> DataFrame:
    """Rows to write: page_id, url, payload, digest, refers_to. Of equal payloads of ``least`` bytes and more, the one with the
    largest id is archived in full and others refer to it.

    Payloads stay where they are: only digests with several rows are gathered, as one row each, and joined back.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = (pages.select(F.col(page).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
            .withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("bigint")))
    groups = (rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first_id", F.lit(least).alias("_least")))
    groups = materialise(groups, "equal")
    joined = rows.join(groups, (rows["digest"] == groups["digest"]) & (rows["bytes"] >= groups["_least"]), "left").drop(groups["digest"])
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("refers_to"))


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(kind: str, name: str, target: str | None, date: str, digest: str, payload: bytes, refers: str | None = None) -> bytes:
    """A WARC 1.1 record. A revisit keeps the HTTP header, whose length is that of the full payload, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{name}>"), ("WARC-Date", date),
            ("WARC-Target-URI", _clean(target) if target else f"urn:x-page:{name}"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:x-page:{refers}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-info>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


class _File:
    """An archive being written: counts what it holds."""

    def __init__(self, folder: str, name: str, dictionary: bytes, date: str):
        import zstandard
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        self.path, self.records, self.size = f"{folder}/{name}", 0, 0
        self.out = system.open_output_stream(f"{root}/{name}", compression=None)  # else the name makes it compress again
        known = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **known)
        if dictionary:
            self._put(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        self._put(self.zstd.compress(_info(date)))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.zstd.compress(data))
        self.records += 1


def write(rows: DataFrame, folder: str, dictionary: bytes, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of :func:`plan` and return the stored list of files: path, records, bytes."""
    source = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, file, n = TaskContext.get(), None, 0
        done: list[_File] = []

        def close() -> None:
            file.out.close()
            done.append(file)

        for batch in batches:
            for part in byte_slices(batch, "payload", SLICE_BYTES):
                for row in part.to_pylist():
                    if file is None:
                        file = _File(folder, f"{context.partitionId():06d}-{context.taskAttemptId()}-{n:04d}.warc.zst", dictionary, date)
                        n += 1
                    kind = "response" if row["refers_to"] is None else "revisit"
                    file.add(record(kind, row["page_id"] or "", row["url"], date, row["digest"], row["payload"], row["refers_to"]))
                    if file.size > FILE_BYTES:
                        close()
                        file = None
        if file:
            close()
        if done:
            yield pa.RecordBatch.from_pydict({"path": [f.path for f in done], "records": [f.records for f in done], "bytes": [f.size for f in done]})

    return materialise(source.mapInArrow(archive, "path string, records bigint, bytes bigint"), "archives")


def read_file(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive, one at a time."""
    import zstandard
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as raw:
        start = raw.read(8)
        known, rest = {}, start
        if len(start) == 8 and struct.unpack("<II", start)[0] == SKIPPABLE:
            data = raw.read(struct.unpack("<II", start)[1])
            if data[:4] != struct.pack("<I", DICT_MAGIC):
                data = zstandard.ZstdDecompressor().decompress(data)
            known, rest = {"dict_data": zstandard.ZstdCompressionDict(data)}, b""
        parts, buffer = _frames(raw, rest, zstandard.ZstdDecompressor(**known)), bytearray()

        def fill(n: int) -> bool:
            while len(buffer) < n:
                if (more := next(parts, None)) is None:
                    return False
                buffer.extend(more)
            return True

        while True:
            while (end := buffer.find(b"\r\n\r\n")) < 0:
                if not fill(len(buffer) + 1):
                    if buffer:
                        raise ValueError(f"{uri} ends within a record")
                    return
            lines = bytes(buffer[:end]).decode().split("\r\n")
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(fields["content-length"])
            if not fill(end + 4 + size + 4):
                raise ValueError(f"{uri} ends within a record")
            block = bytes(buffer[end + 4:end + 4 + size])
            del buffer[:end + 8 + size]
            yield fields, block


def _frames(raw, data: bytes, zstd) -> Iterator[bytes]:
    """What the frames of a stream hold, in parts; ``data`` was read from it before. A frame cut short is an error."""
    frame, data = None, data or raw.read(1 << 16)
    while data:
        frame = frame or zstd.decompressobj()
        if out := frame.decompress(data):
            yield out
        data, frame = (frame.unused_data, None) if frame.eof else (b"", frame)
        data = data or raw.read(1 << 16)
    if frame:
        raise ValueError("the last frame isn't complete")


def read(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record in the files listed in ``path``.

    The payload of a response is hashed again and must equal its digest; a revisit states length and digest of the payload it
    refers to.
    """
    def name(uri: str | None) -> str | None:
        return (uri or "").removeprefix("<urn:x-page:").removesuffix(">") or None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        for batch in batches:
            for uri, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows: list[tuple] = []
                n = 0
                for fields, block in read_file(uri):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    stated = int(head.rsplit(b"Content-Length:", 1)[1])
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record {fields['warc-record-id']} in {uri}")
                    n += 1
                    rows.append((name(fields["warc-record-id"]), stated, digest, kind, name(fields.get("warc-refers-to"))))
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pydict(dict(zip(columns, map(list, zip(*rows)))), schema=arrow)
                        rows = []
                if n != records:
                    raise ValueError(f"{uri} has {n} records of {records}")
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(columns, map(list, zip(*rows)))), schema=arrow)

    text = pa.string()
    arrow = pa.schema([("page_id", text), ("payload_bytes", pa.int64()), ("payload_digest", text), ("record_type", text), ("refers_to", text)])
    schema = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    spread = files.select("path", "records").repartition(max(1, min(files.count(), 10_000)), "path")
    return spread.mapInArrow(parse, schema).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive(pages: DataFrame, folder: str | None = None, html: str = "html", page: str = "page_id", url: str = "url", least: int = 1000) -> DataFrame:
    """Write every row of ``pages`` into archives below ``folder`` (else the shared folder) and read them back.

    Runs jobs when called. Null payloads are empty; a null URL is replaced by the record's own name, a null id is read back as null.
    Repeated rows are records each; if several rows share the largest id of equal payloads, all of them are responses. No rows
    give no files and no rows.
    """
    dictionary = train(pages, html, page)
    files = write(plan(pages, html, page, url, least), folder or work_dir(pages.sparkSession, "warc"), dictionary)
    return read(files, pages.schema[page].dataType.simpleString())
