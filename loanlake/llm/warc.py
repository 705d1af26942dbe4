"""WARC records in seekable Zstandard bundles (operator 9)."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import pick, table
from loanlake.session import shared_dir, stage

#: Equal payloads of at least so many bytes are stored once.
MIN_SHARED_BYTES = 1000
#: Record bytes of a frame and compressed bytes of a bundle, after which they are closed.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 25
LEVEL = 3
#: Tasks that read bundles, at most.
MAX_READERS = 100_000
#: Fixed values of the seekable format: skippable frame, footer and its size.
SEEK_FRAME = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
FOOTER_BYTES = 9
#: Fixed values of the record format.
VERSION = b"WARC/1.1"
LINE_END = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ID_PREFIX = "urn:x-page:"


def place_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by a URI or a plain path."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def record_bytes(
    page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str
) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    revisit = refers_to is not None
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{ID_PREFIX}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "X-Payload-Bytes": str(len(payload)),
    }
    if url is not None:
        head["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if revisit:
        head["WARC-Refers-To"] = f"<{ID_PREFIX}{refers_to}>"
        head["WARC-Profile"] = REVISIT_PROFILE
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head["Content-Length"] = str(len(block))
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in head.items()]]
    return LINE_END.join(lines) + LINE_END * 2 + block + LINE_END * 2


def parse_record(data: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """Header, payload and end of the record at ``offset`` of a frame."""
    head_end = data.index(LINE_END * 2, offset)
    version, *lines = data[offset:head_end].split(LINE_END)
    if version != VERSION:
        raise ValueError(f"no record at {offset}")
    head = dict(line.decode().split(": ", 1) for line in lines)
    begin = head_end + 2 * len(LINE_END)
    end = begin + int(head["Content-Length"])
    if data[end : end + 4] != LINE_END * 2:
        raise ValueError(f"record at {offset} is cut short")
    return head, data[begin + len(HTTP_HEAD) : end], end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer frame with the compressed and plain size of every frame."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEK_FOOTER)
    return struct.pack("<II", SEEK_FRAME, len(entries) + len(footer)) + entries + footer


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of every frame of a bundle."""
    size = file.size()
    file.seek(size - FOOTER_BYTES)
    count, _, magic = struct.unpack("<IBI", file.read(FOOTER_BYTES))
    if magic != SEEK_FOOTER:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(size - FOOTER_BYTES - 8 * count)
    frames, offset = [], 0
    for compressed, plain in struct.iter_unpack("<II", file.read(8 * count)):
        frames.append((offset, compressed, plain))
        offset += compressed
    return frames


def read_frame(file: pa.NativeFile, frame: tuple[int, int, int]) -> bytes:
    offset, compressed, plain = frame
    file.seek(offset)
    return zstandard.ZstdDecompressor().decompress(file.read(compressed), max_output_size=plain)


def read_record(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index; reads the seek table and one frame."""
    files, path = place_of(folder)
    with files.open_input_file(f"{path}/{bundle}") as file:
        head, payload, _ = parse_record(read_frame(file, read_seek_table(file)[frame]), offset)
    return head, payload


class BundleWriter:
    """Groups records into frames and frames into files of a folder.

    ``index`` gets ``(number of the record, bundle, frame, offset in the frame)``
    for the records of a bundle once its file is closed.
    """

    def __init__(self, folder: str):
        self.files, self.path = place_of(folder)
        self.files.create_dir(self.path, recursive=True)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.index: list[tuple[int, str, int, int]] = []
        self.begin()

    def begin(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = None
        self.frames: list[tuple[int, int]] = []
        self.size = 0
        self.pending: list[bytes] = []
        self.plain = 0
        self.waiting: list[tuple[int, str, int, int]] = []

    def add(self, number: int, record: bytes) -> None:
        self.waiting.append((number, self.name, len(self.frames), self.plain))
        self.pending.append(record)
        self.plain += len(record)
        if self.plain >= FRAME_BYTES:
            self.end_frame()
            if self.size >= BUNDLE_BYTES:
                self.close()

    def end_frame(self) -> None:
        if not self.pending:
            return
        if self.file is None:
            self.file = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        frame = self.compressor.compress(b"".join(self.pending))
        self.file.write(frame)
        self.frames.append((len(frame), self.plain))
        self.size += len(frame)
        self.pending, self.plain = [], 0

    def close(self) -> None:
        self.end_frame()
        if self.file is not None:
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.index += self.waiting
        self.begin()


def deduplicated(pages: DataFrame, id: str, url: str, html: str) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` (null for responses).

    Digests are counted on small columns; the payloads themselves meet only the
    groups with copies, a join whose hot groups Spark splits and which needs no
    shuffle while those groups are few.
    """
    rows = pick(pages, page_id=id, url=url, payload=html)
    rows = rows.withColumn("payload", F.coalesce("payload", F.lit("")).cast("binary"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= MIN_SHARED_BYTES
    groups = (
        rows.where(large)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("response_id").isNotNull())
        .select(F.col("digest").alias("shared"), "response_id")
    )
    groups = stage(groups, "payload-groups")
    joined = rows.join(groups, large & (F.col("digest") == F.col("shared")), "left")
    other = ~F.col("page_id").eqNullSafe(F.col("response_id"))
    refers_to = F.when(other, F.col("response_id")).alias("refers_to")
    return joined.select("page_id", "url", "payload", "digest", refers_to)


def write_bundles(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for every row and return the index of the bundles.

    The index holds ``page_id``, ``bundle`` (a file of ``folder``), ``frame`` and
    ``offset`` in the plain frame. Frames are independent, and each bundle ends in
    a seek table. Every attempt of a task writes files of its own and only the
    attempts whose index rows Spark commits count: files that no index row names
    are left-overs of lost executors. ``folder`` has to be one that Arrow's file
    systems reach from every executor.

    Null html is an empty payload. Rows with the largest ``page_id`` of their
    payload, repeated rows included, are responses, as are all rows of a payload
    without any id. An empty table writes no bundle. Runs when it is called.
    """
    rows = deduplicated(pages, id, url, html)
    kind = rows.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder)
        ids: list = []

        def committed() -> pa.RecordBatch:
            done, writer.index = writer.index, []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[one[0]] for one in done], arrow_kind),
                    pa.array([one[1] for one in done], pa.string()),
                    pa.array([one[2] for one in done], pa.int32()),
                    pa.array([one[3] for one in done], pa.int64()),
                ],
                names=["page_id", "bundle", "frame", "offset"],
            )

        arrow_kind = None
        for batch in batches:
            arrow_kind = batch.schema.field("page_id").type
            for page_id, address, payload, digest, refers_to in zip(*batch.columns, strict=True):
                page_id = page_id.as_py()
                record = record_bytes(
                    page_id, address.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), date
                )
                writer.add(len(ids), record)
                ids.append(page_id)
            if writer.index:
                yield committed()
        writer.close()
        if writer.index:
            yield committed()

    index = rows.mapInArrow(write, f"page_id {kind}, bundle string, frame int, offset long")
    return stage(index, "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` of all records.

    Every bundle that ``index`` names is read whole through its seek table, a
    frame at a time, in a task of its own, up to ``MAX_READERS`` tasks. Their number
    is counted and stated: bundle names are few bytes, and Spark would merge tasks
    by those, not by what they read. The digest and size of a response are taken from its payload
    and must agree with its header, or reading fails.
    """
    kind = index.schema["page_id"].dataType.simpleString()
    number = "string" not in kind

    def page(text: str):
        text = text.strip("<>").removeprefix(ID_PREFIX)
        return (int(text) if number else text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = place_of(folder)
        for batch in batches:
            for bundle in batch.column("bundle").to_pylist():
                with files.open_input_file(f"{path}/{bundle}") as file:
                    for frame in read_seek_table(file):
                        yield records(read_frame(file, frame))

    def records(data: bytes) -> pa.RecordBatch:
        found = []
        offset = 0
        while offset < len(data):
            head, payload, offset = parse_record(data, offset)
            size, digest = int(head["X-Payload-Bytes"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
            if head["WARC-Type"] == "response" and (
                size != len(payload) or digest != hashlib.sha1(payload).hexdigest()
            ):
                raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
            refers_to = page(head.get("WARC-Refers-To", ""))
            found.append((page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers_to))
        columns = list(zip(*found, strict=True))
        ids = pa.int64() if number else pa.string()
        kinds = [ids, pa.int64(), pa.string(), pa.string(), ids]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, one) for column, one in zip(columns, kinds, strict=True)], names=names
        )

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    wide = "long" if number else "string"
    schema = (
        f"page_id {wide}, payload_bytes long, payload_digest string, record_type string, "
        f"refers_to {wide}"
    )
    bundles = stage(index.select("bundle").distinct(), "warc-bundles")
    readers = min(max(1, bundles.count()), MAX_READERS)
    # By ranges of the names: a hash of so few would leave tasks without any.
    dealt = bundles.repartitionByRange(readers, "bundle")
    found = dealt.mapInArrow(read, schema)
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"),
        *names[1:4],
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    bundles = f"{shared_dir(spark)}/loanlake/warc-{uuid.uuid4().hex}"
    index = write_bundles(table(spark, folder, "pages"), bundles)
    return read_bundles(index, bundles)


ORACLE = f"""
with told as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages
),
shared as (
  select payload_digest, max(page_id) as response_id from told
  where payload_bytes >= {MIN_SHARED_BYTES} group by payload_digest having count(*) > 1
)
select page_id, payload_bytes, payload_digest,
  case when response_id <> page_id then 'revisit' else 'response' end as record_type,
  case when response_id <> page_id then response_id end as refers_to
from told left join shared using (payload_digest)
"""
