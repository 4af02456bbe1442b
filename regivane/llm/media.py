"""Media columns: PNG members in archives, read by a custom Spark data source.

``write_archives`` stores each payload as the samples of an 8-bit grey PNG, a tar archive per
partition, with an index file of member offsets beside it.  ``MediaArchives`` reads a folder
of such archives, or of any tar archives of PNG files: it plans partitions by byte range from
the file sizes alone; a reader takes the members that begin in its range (from the index, or
without one by hopping from header to header), streams them through Arrow in bounded batches,
and retries each one by itself at its offset, on a connection opened anew.

Defined results: a null text counts as empty; an empty payload is filled up to one unit; a
member that still fails after all attempts (one that is no such PNG too) gives a row with
``error`` set and null media; members of an archive without an index have a null doc_id; an
empty folder or table gives no rows; repeated rows give a member each; doc_id is a long; a
member is as long as its text, which a task holds whole; other columns are ignored.
"""

from __future__ import annotations

import struct
import tarfile
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from regivane.llm.common import kept_fields, portions, shared_path

UNIT, FILL, WIDTH = 576, 255, 576
RANGE_BYTES, BATCH_BYTES, ATTEMPTS = 16 << 20, 8 << 20, 4
SCHEMA = "archive string, member_offset bigint, doc_id bigint, media binary, payload binary, error string"

#: Fixed value: the eight bytes that begin every PNG file.
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: What an index entry knows of its member.
_DOC, _CRC = 1, 2
_INDEX = np.dtype([("header", "<i8"), ("data", "<i8"), ("size", "<i8"), ("doc_id", "<i8"), ("crc", "<u4"), ("known", "<u4")])


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes filled up with 255 to a positive multiple of 576."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes([FILL]) * (-len(raw) % UNIT if raw else UNIT)


def encode_png(payload: bytes) -> bytes:
    """A PNG of 8-bit grey samples, one row for each 576 bytes, no filter."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), dtype=np.uint8)
    rows[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(media: bytes) -> bytes:
    """The samples of such a PNG, every checksum verified."""
    if media[:8] != _SIGNATURE:
        raise ValueError("no PNG signature")
    at, data, shape = 8, b"", None
    while at < len(media):
        if at + 12 > len(media):
            raise ValueError("cut off")
        size, kind = struct.unpack_from(">I4s", media, at)
        body = media[at + 8 : at + 8 + size]
        if len(body) != size or struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"bad checksum in {kind!r}")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data += body
        elif kind == b"IEND":
            break
        at += 12 + size
    if shape is None or shape[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey picture")
    rows = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(shape[1], shape[0] + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean, deviation, entropy and edge energy of the samples, and a 16-bin histogram, as text."""
    x = np.frombuffer(payload, dtype=np.uint8)
    n = np.bincount(x, minlength=256)
    p = n[n > 0] / len(x)
    mean = float((n * np.arange(256)).sum() / len(x))
    spread = float(np.sqrt((n * (np.arange(256) - mean) ** 2).sum() / len(x)))
    edge = float(np.abs(np.diff(x.astype(np.int16))).mean()) if len(x) > 1 else 0.0
    bins = ",".join(str(v) for v in n.reshape(16, 16).sum(1).tolist())
    return f"{mean:.6f};{spread:.6f};{float(-(p * np.log2(p)).sum()):.6f};{edge:.6f};{bins}"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_archives(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """One archive and index per partition of ``docs``.

    Names depend on the partition alone and files appear whole, so a task that runs again
    after a lost executor writes the same files over.
    """
    filesystem, root = _file_system(folder)
    filesystem.create_dir(root, recursive=True)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        filesystem, root = _file_system(folder)
        final, part = f"{root}/part-{task:06d}.tar", f"{root}/_part-{task:06d}-{attempt}"
        index: list[tuple] = []
        at = 0
        with filesystem.open_output_stream(part) as out:
            for batch in portions(batches):
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    media = encode_png(payload_of(value))
                    info = tarfile.TarInfo(f"{len(index):09d}.png")
                    info.size = len(media)
                    head = info.tobuf(tarfile.GNU_FORMAT)
                    out.write(head + media + bytes(-len(media) % 512))
                    index.append((at, at + len(head), len(media), doc or 0, zlib.crc32(media), _CRC | (_DOC if doc is not None else 0)))
                    at += len(head) + len(media) + -len(media) % 512
            out.write(bytes(1024))
        if index:
            with filesystem.open_output_stream(f"{part}.idx") as out:
                out.write(np.array(index, dtype=_INDEX).tobytes())
            filesystem.move(f"{part}.idx", f"{final}.idx")
            filesystem.move(part, final)
        else:
            filesystem.delete_file(part)
        yield pa.RecordBatch.from_pydict({"members": pa.array([len(index)], pa.int64())})

    docs.select(doc_id, text).mapInArrow(written, "members bigint").agg(F.sum("members")).collect()


@dataclass
class ByteRange(InputPartition):
    archive: str
    first: int
    last: int


class MediaArchives(DataSource):
    """``spark.read.format("media_archives").load(folder)``; option ``range_bytes`` sets the partitions' size."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)))


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int):
        self.folder, self.range_bytes = folder, range_bytes

    def partitions(self) -> list[ByteRange]:
        filesystem, root = _file_system(self.folder)
        found = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        ranges = [ByteRange(f.path, at, min(at + self.range_bytes, f.size)) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".tar") for at in range(0, f.size, self.range_bytes)]
        return ranges or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        filesystem, _ = _file_system(self.folder)
        handle = _Handle(filesystem, partition.archive)
        try:
            index = filesystem.open_input_stream(f"{partition.archive}.idx")
        except FileNotFoundError:
            index = None
        if index:
            with index:
                entries = np.frombuffer(index.read(), dtype=_INDEX)
            own = entries[(entries["header"] >= partition.first) & (entries["header"] < partition.last)]
        else:
            own = headers(handle.read_at, partition.first, partition.last)
        rows, size = [], 0
        for entry in own:
            media, payload, error = read_member(handle.read_at, entry)
            doc = int(entry["doc_id"]) if entry["known"] & _DOC else None
            rows.append((partition.archive, int(entry["header"]), doc, media, payload, error))
            size += len(media or b"") + len(payload or b"")
            if size > BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


class _Handle:
    """An open archive; after an error the next read opens it anew."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.filesystem, self.path, self.file = filesystem, path, None

    def read_at(self, at: int, n: int) -> bytes:
        try:
            if self.file is None:
                self.file = self.filesystem.open_input_file(self.path)
            return bytes(self.file.read_at(n, at))
        except OSError:
            self.file = None
            raise


def headers(read_at: Callable[[int, int], bytes], first: int, last: int) -> Iterator[np.void]:
    """Index entries of an archive's files whose headers begin in a range, found from header to header."""
    at = 0
    while at < last:
        head = read_at(at, tarfile.BLOCKSIZE)
        if len(head) < tarfile.BLOCKSIZE or not any(head):
            return
        info = tarfile.TarInfo.frombuf(head, tarfile.ENCODING, "surrogateescape")
        if at >= first and info.isreg():
            yield np.array([(at, at + tarfile.BLOCKSIZE, info.size, 0, 0, 0)], dtype=_INDEX)[0]
        at += tarfile.BLOCKSIZE + info.size + -info.size % tarfile.BLOCKSIZE


def read_member(read_at: Callable[[int, int], bytes], entry, attempts: int = ATTEMPTS, pause: float = 0.05):
    """(media, payload, error) of one member; each attempt reads it anew at its offset."""
    error = ""
    for attempt in range(attempts):
        try:
            media = bytes(read_at(int(entry["data"]), int(entry["size"])))
            if len(media) != entry["size"] or (entry["known"] & _CRC and zlib.crc32(media) != entry["crc"]):
                raise ValueError("stored bytes differ from the index")
            return media, decode_png(media), None
        except (OSError, ValueError, zlib.error, struct.error) as e:
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < attempts:
                time.sleep(pause * 2**attempt)
    return None, None, error


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
    names = ["archive", "member_offset", "doc_id", "media", "payload", "error"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").option("range_bytes", str(range_bytes)).load(folder)


def with_features(media: DataFrame, payload: str = "payload", out: str = "feature") -> DataFrame:
    """Append ``out``: the feature text of each payload (null: null)."""
    schema = T.StructType([*kept_fields(media, [out]), T.StructField(out, T.StringType())])
    names = [f.name for f in schema][:-1]

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            features = [None if p is None else feature_of(p) for p in batch.column(batch.schema.get_field_index(payload)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(features, pa.string())], [*names, out])

    return media.mapInArrow(computed, schema)


def store_and_read(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the texts of ``docs`` to archives in the shared folder and read them back with features."""
    folder = shared_path(docs.sparkSession, "media")
    write_archives(docs, folder, doc_id, text)
    return with_features(read_archives(docs.sparkSession, folder))
