"""WARC archives compressed record by record with a dictionary of their own.

An archive starts with a skippable Zstandard frame that holds a dictionary built from the archive's first records; every
record follows as a frame of its own, so a reader can start at any record once it has the dictionary. A payload seen
before is not stored again: a revisit record refers to the response that holds it.

Archives are written by tasks through Arrow's file systems into a shared folder. Names carry a random part, and the
stored list of archives, which only finished tasks enter, says which count: an attempt that was lost leaves a file
that nobody reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch, fresh_path

ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEAST_SHARED = 100

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LISTING = "archive string, records long, bytes long"
_RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
            "payload binary")


def serialize(page_id, url, payload, digest, refers_to, date: str) -> bytes:
    """One WARC record. Ids are URNs of the page; white space and control characters of the address are quoted."""
    from urllib.parse import quote

    printable = "".join(map(chr, range(0x21, 0x7F)))
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe=printable) if url else "about:blank"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block += b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        block += b"\r\n"
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES):
    """A dictionary trained on records, cut into short samples; None where there is too little to train on."""
    import zstandard

    total = sum(map(len, records))
    piece = max(128, min(4096, total // 256))
    samples = [record[at:at + piece] for record in records for at in range(0, len(record), piece)]
    size = min(size, total // 8)
    if len(samples) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def link_revisits(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): the least page with an equal payload, null for itself."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"))
    # Payloads too short to share get a key of their own, so that they do not meet in one task.
    key = F.when(F.octet_length("payload") >= least_shared, F.col("payload_digest")).otherwise(
        F.concat(F.lit("short "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    first = (
        rows.where(F.octet_length("payload") >= least_shared).groupBy(F.col("payload_digest").alias("key"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    )
    return rows.withColumn("key", key).join(first, "key", "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def write_archives(linked: DataFrame, folder: str, scratch: Scratch, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Write records of ``link_revisits`` into ``folder``; returns the stored list (archive, records, bytes).

    A task writes one archive after another, each closed at about ``archive_bytes``; it holds the records its
    dictionary is built from (``SAMPLE_BYTES`` and one record) and one Arrow batch.
    """
    def write(batches):
        import struct
        import uuid

        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)

        def records():
            for batch in batches:
                columns = (batch.column(name) for name in ("page_id", "url", "payload", "payload_digest", "refers_to"))
                for row in zip(*columns):
                    yield serialize(*(value.as_py() for value in row), date)

        waiting = records()
        record = next(waiting, None)
        while record is not None:
            sample = []
            while record is not None and sum(map(len, sample)) < SAMPLE_BYTES:
                sample.append(record)
                record = next(waiting, None)
            name, count, written = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
            dictionary = build_dictionary(sample)
            press = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
            with system.open_output_stream(name, compression=None) as out:
                if dictionary is not None:
                    content = dictionary.as_bytes()
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
                for ready in sample:
                    frame = press.compress(ready)
                    out.write(frame)
                    count, written = count + 1, written + len(frame)
                sample = []
                while record is not None and written < archive_bytes:
                    frame = press.compress(record)
                    out.write(frame)
                    count, written = count + 1, written + len(frame)
                    record = next(waiting, None)
            yield pa.record_batch([pa.array([name]), pa.array([count]), pa.array([written])],
                                  names=["archive", "records", "bytes"])

    return scratch.keep(linked.mapInArrow(write, _LISTING), "archives")


def read_archives(listing: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of listed archives: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    One archive is one task's unit and is read as a stream, a record at a time. A response's digest and length are
    taken from the payload read and must agree with its header; a revisit has those of its header. ``payload`` is
    null unless asked for.
    """
    def read(batches):
        import hashlib
        import struct

        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)

        def frames(source):
            waiting = source.read(8)
            dictionary = None
            if len(waiting) == 8 and struct.unpack("<II", waiting)[0] == DICTIONARY_MAGIC:
                dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", waiting)[1]))
                waiting = b""
            opener = zstandard.ZstdDecompressor(dict_data=dictionary)
            while True:
                waiting = waiting or source.read(1 << 18)
                if not waiting:
                    return
                frame, parts = opener.decompressobj(), []
                while not frame.eof:
                    if not waiting:
                        raise ValueError("an archive ends within a record")
                    parts.append(frame.decompress(waiting))
                    waiting = frame.unused_data if frame.eof else source.read(1 << 18)
                yield b"".join(parts)

        def urn(value):
            page = (value or "").removeprefix("<urn:page:").removesuffix(">")
            return int(page) if page else None

        def parsed(record):
            head, _, rest = record.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            block = rest[:int(fields["Content-Length"])]
            digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
            content = None
            if fields["WARC-Type"] == "response":
                content = block.partition(b"\r\n\r\n")[2]
                if (hashlib.sha256(content).hexdigest(), len(content)) != (digest, size):
                    raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
            return (urn(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                    urn(fields.get("WARC-Refers-To")), size, digest, content if payloads else None)

        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

        def batch_of(rows):
            return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for archive in batch.column("archive"):
                rows, held = [], 0
                with system.open_input_stream(archive.as_py(), compression=None) as source:
                    for record in frames(source):
                        rows.append(parsed(record))
                        held += len(rows[-1][-1] or b"") + 200
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return listing.select("archive").repartition(max(1, listing.count())).mapInArrow(read, _RECORDS)


def archive_pages(pages: DataFrame, scratch: Scratch | None = None, payloads: bool = False) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in the shared folder and read them back.

    Defined cases: a null html is an empty payload; a null or empty url is about:blank; payloads under
    ``LEAST_SHARED`` bytes are always responses. Rows that repeat the least page_id of a payload are all responses,
    as are rows without page_id. Other columns are ignored; an empty table gives no rows.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    folder = fresh_path(pages.sparkSession, "warc")
    listing = write_archives(link_revisits(pages), folder, scratch)
    return read_archives(listing, folder, payloads)
