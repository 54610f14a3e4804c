"""Media columns: payloads in archives on shared storage, and a Spark data source that reads them by byte range.

`write_archives` packs a payload of each row into zip archives (members stored as they are) and returns a manifest with
the archives of the tasks that Spark committed, so retried or speculative tasks leave no row twice. Members are written
to storage as they come; a worker holds one of them and the directory of one archive. The data source "media_archive"
plans byte ranges over the archives of a manifest: a partition holds one or more ranges, of RANGE_BYTES together or of
as many as keep the partitions at MOST_PARTITIONS. A task reads the directory at an archive's end, takes the members
that begin in its range, and streams them in Arrow batches of bounded size. A member whose bytes can't be read or don't
match their checksum is read again, alone, by its offset through a newly opened file; a directory is read again too.
Paths without a scheme are given the one of the cluster's file system when archives are written.

The media form used here is an 8-bit greyscale PNG, 192 samples wide, with the unpadded length in a text chunk; it is
lossless and depends on the payload alone.

Defined results: null and empty texts give a payload of 192 blanks; repeated rows and repeated or null ids are members
of their own; texts of any length are one member; an empty table gives no archive and an empty result; further columns
of the input are left out.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .util import lean_batches, qualified, scratch, table

WIDTH = 192
#: zlib's level; the same bytes come out for the same payload.
LEVEL = 2
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
MOST_PARTITIONS = 20_000
BATCH_BYTES = 4 << 20
ATTEMPTS = 4


def open_store(path: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Unpadded length and the bytes of a text, blanks appended up to a positive multiple of WIDTH."""
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode_png(payload: bytes, length: int) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"length\0%d" % length) + _chunk(b"IDAT", zlib.compress(lines, LEVEL)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> tuple[int, bytes]:
    """Unpadded length and payload of a stored image; raises ValueError if it isn't whole."""
    if media[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, length, packed = 8, 0, []
    while at < len(media):
        (n,), kind = struct.unpack(">I", media[at : at + 4]), media[at + 4 : at + 8]
        data = media[at + 8 : at + 8 + n]
        if zlib.crc32(data, zlib.crc32(kind)) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk's checksum differs")
        if kind == b"tEXt" and data.startswith(b"length\0"):
            length = int(data[7:])
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(-1, WIDTH + 1)
    return length, lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """A 64-bit difference hash over the image's columns, and its mean and spread."""
    columns = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH).astype(np.float64)
    profile = columns.mean(axis=0)
    folded = profile.reshape(64, 3).mean(axis=1)
    bits = np.packbits(np.append(folded[1:] > folded[:-1], folded[0] > folded[-1]))
    return f"{bits.tobytes().hex()}:{profile.mean():.4f}:{profile.std():.4f}"


def write_archives(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of (id, text) as images into archives below `path`; returns the manifest (archive, bytes, members)."""
    folder = f"{qualified(rows.sparkSession, path)}/archives"
    store, at = open_store(folder)
    store.create_dir(at, recursive=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = open_store(folder)
        done: list[tuple[str, int, int]] = []
        name, out, archive, members = "", None, None, 0

        def close() -> None:
            archive.close()
            done.append((f"{folder}/{name}", out.tell(), members))
            out.close()

        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                if archive is None:
                    name, members = f"{uuid.uuid4().hex}.zip", 0
                    out = store.open_output_stream(f"{at}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                length, payload = payload_of(text.as_py())
                member = f"{members}" if key.as_py() is None else f"{members}/{key.as_py()}"
                archive.writestr(zipfile.ZipInfo(member), encode_png(payload, length))
                members += 1
                if out.tell() >= archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["archive", "bytes", "members"])

    return rows.mapInArrow(pack, "archive string, bytes long, members long")


class ArchiveRange(InputPartition):
    """Ranges (archive, first, stop) of archives: the members that begin in them."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


def again(what: str, attempt_once):
    """The result of attempt_once(attempt), tried ATTEMPTS times where storage fails or bytes are broken."""
    why: Exception | None = None
    for attempt in range(ATTEMPTS):
        try:
            return attempt_once(attempt)
        except (OSError, zipfile.BadZipFile) as e:
            why = e
            time.sleep(0.05 * 4**attempt)
    raise OSError(f"{what}: {why}")


def read_directory(path: str) -> list[zipfile.ZipInfo]:
    def once(_: int) -> list[zipfile.ZipInfo]:
        store, at = open_store(path)
        with zipfile.ZipFile(store.open_input_file(at)) as z:
            return z.infolist()

    return again(f"{path}, directory", once)


def read_member(path: str, info: zipfile.ZipInfo, opened: dict) -> bytes:
    """The bytes of a member by its offset; tried again, with a newly opened file, where reading fails or the checksum differs."""

    def once(attempt: int) -> bytes:
        if attempt or "file" not in opened:
            store, at = open_store(path)
            opened["file"] = store.open_input_file(at)
        f = opened["file"]
        f.seek(info.header_offset)
        head = f.read(30)
        if head[:4] != b"PK\x03\x04":
            raise OSError("no member begins here")
        f.seek(info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30])))
        data = f.read(info.compress_size)
        if len(data) != info.compress_size or zlib.crc32(data) != info.CRC:
            raise OSError("the checksum differs")
        return data

    return again(f"{path}, member at {info.header_offset}", once)


def plan_ranges(archives: list[tuple[str, int]], range_bytes: int, most: int = MOST_PARTITIONS) -> list[list[tuple[str, int, int]]]:
    """Ranges by partition: pieces of archives, or whole archives together, of `range_bytes`, or more where partitions would be more than `most`."""
    range_bytes = max(range_bytes, -(-sum(size for _, size in archives) // most))
    found, now, held = [], [], 0
    for archive, size in archives:
        for first in range(0, size, range_bytes):
            stop = min(first + range_bytes, size)
            if now and held + stop - first > range_bytes:
                found.append(now)
                now, held = [], 0
            now.append((archive, first, stop))
            held += stop - first
    return found + [now] if now else found


class MediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives, self.range = options["manifest"], int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self) -> list[ArchiveRange]:
        import pyarrow.dataset as ds

        store, at = open_store(self.archives)
        manifest = ds.dataset(at, filesystem=store, format="parquet").to_table(columns=["archive", "bytes"]).sort_by("archive")
        planned = plan_ranges(list(zip(manifest["archive"].to_pylist(), manifest["bytes"].to_pylist(), strict=True)), self.range)
        return [ArchiveRange(ranges) for ranges in planned] or [ArchiveRange([])]

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        def batch(keys: list, media: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(media, pa.binary())], names=["key", "media"])

        keys, media, held = [], [], 0
        for archive, first, stop in partition.ranges:
            opened: dict = {}
            members = [i for i in read_directory(archive) if first <= i.header_offset < stop]
            for info in sorted(members, key=lambda i: i.header_offset):
                data = read_member(archive, info, opened)
                keys.append(info.filename.partition("/")[2] if "/" in info.filename else None)
                media.append(data)
                held += len(data)
                if held >= BATCH_BYTES:
                    yield batch(keys, media)
                    keys, media, held = [], [], 0
        if keys:
            yield batch(keys, media)


class MediaArchives(DataSource):
    """spark.read.format("media_archive").option("manifest", path).load(): one row a member, with its key and bytes."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "key string, media binary"

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


def store_media(docs: DataFrame) -> DataFrame:
    """(key, media): every text stored as an image in archives and read back through the data source."""
    spark = docs.sparkSession
    lean_batches(spark)
    path = scratch(spark, "media")
    write_archives(docs.select("doc_id", "text"), path).write.parquet(f"{path}/manifest")
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archive").option("manifest", f"{path}/manifest").load()


def describe(media: DataFrame) -> DataFrame:
    """Facts of each stored image and of the payload read back from it."""
    names = ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, stored in zip(b.column(0), b.column(1), strict=True):
                data = stored.as_py()
                length, payload = decode_png(data)
                rows.append((key.as_py(), length, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(payload)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return media.mapInArrow(facts, "key string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = describe(store_media(table(spark, sf_dir, "documents")))
    return found.select(F.col("key").cast("long").alias("doc_id"), *found.columns[1:])
