"""Media columns: archives of sample files read through a Spark data source.

:func:`store` writes each text as an 8-bit PCM sample file (WAV, mono, one
byte a sample) into ZIP archives of bounded size in a shared folder; the
archives' own central directories are the index. :class:`ArchiveSource`
(format ``media_archive``) plans byte ranges over the archives: a reader opens
the archive's directory, takes the members whose header lies in its range, and
streams their payloads as Arrow batches of bounded size. A member that fails to
read is tried again alone, by its own offset, on a newly opened file.

Edge cases: null text is the empty text; null and repeated ids give one member
a row; an empty table gives an empty folder and an empty result; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FRAME = 192  # bytes of a frame; payloads are padded to a positive multiple
RATE = 8000  # samples a second in the header
MEMBER_SCHEMA = "doc_id long, n_bytes long, media binary"


def payload(text: str | None) -> tuple[bytes, int]:
    """Padded UTF-8 bytes and how many of them are text."""
    data = (text or "").encode()
    return data + b" " * (-len(data) % FRAME if data else FRAME), len(data)


def wav(samples: bytes) -> bytes:
    """A RIFF file of unsigned 8-bit mono samples."""
    return (
        struct.pack("<4sI4s", b"RIFF", 36 + len(samples), b"WAVE")
        + struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
        + struct.pack("<4sI", b"data", len(samples))
        + samples
    )


def samples_of(media: bytes) -> bytes:
    """The data chunk of a RIFF file."""
    at = 12
    while at + 8 <= len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def store(df: DataFrame, folder: str, archive_bytes: int = 64 << 20) -> None:
    """Write ``df(doc_id, text)`` as archives of about ``archive_bytes`` of payload.

    An archive appears under its final name only when it is complete, and only
    the attempts that succeed report names, so a lost executor leaves at most
    files that no manifest names.
    """
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        names, archive, size, count = [], None, 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    raw = fs.open_output_stream(f"{path}/_{name}")
                    archive = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                data, n = payload(text.as_py())
                archive.writestr(f"{count}/{'' if doc_id is None else doc_id}/{n}.wav", wav(data))
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    archive.close()
                    raw.close()
                    fs.move(f"{path}/_{name}", f"{path}/{name}")
                    names.append(name)
                    archive, size = None, 0
        if archive is not None:
            archive.close()
            raw.close()
            fs.move(f"{path}/_{name}", f"{path}/{name}")
            names.append(name)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    df.select("doc_id", "text").mapInArrow(run, "name string").write.parquet(f"{folder}/manifest")


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.range_bytes = int(options.get("rangebytes", 16 << 20))
        self.batch_bytes = int(options.get("batchbytes", 4 << 20))
        self.retries = int(options.get("retries", 3))

    def partitions(self) -> list[ByteRange]:
        """Byte ranges over the archives that the manifest names; no archive is opened."""
        import pyarrow.dataset as ds

        fs, path = filesystem(self.folder)
        named = set(ds.dataset(f"{path}/manifest", filesystem=fs, format="parquet").to_table()["name"].to_pylist())
        found = fs.get_file_info(pyarrow.fs.FileSelector(path))
        return [
            ByteRange(f.path, at, at + self.range_bytes)
            for f in sorted(found, key=lambda f: f.path)
            if f.base_name in named
            for at in range(0, f.size, self.range_bytes)
        ]

    def _member(self, fs, part: ByteRange, info: zipfile.ZipInfo, archive: zipfile.ZipFile) -> bytes:
        for attempt in range(self.retries + 1):
            try:
                return archive.read(info)  # checks the member's CRC
            except (OSError, zipfile.BadZipFile, zlib.error):
                if attempt == self.retries:
                    raise
                time.sleep(0.1 * 2**attempt)
                archive = zipfile.ZipFile(fs.open_input_file(part.path))
        raise AssertionError

    def read(self, part: ByteRange | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark hands over where there is nothing to plan
            return
        fs, _ = filesystem(self.folder)
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
        rows, size = [], 0
        with fs.open_input_file(part.path) as raw, zipfile.ZipFile(raw) as archive:
            for info in archive.infolist():
                if not part.start <= info.header_offset < part.end:
                    continue
                _, doc_id, rest = info.filename.split("/")
                rows.append((int(doc_id) if doc_id else None, int(rest.removesuffix(".wav")), self._member(fs, part, info, archive)))
                size += len(rows[-1][2])
                if size >= self.batch_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class ArchiveSource(DataSource):
    """``spark.read.format("media_archive").load(folder)`` after :func:`store`."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def load(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("media_archive").options(**options).load(folder)


def feature_of(samples: bytes) -> str:
    """Mean, root mean square, crossing rate of the mean level and peak, as text."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    n, total = len(x), int(x.sum())
    above = x * n >= total
    crossings = int((above[1:] != above[:-1]).sum())
    return f"mean={total / n:.4f};rms={(int((x * x).sum()) / n) ** 0.5:.4f};crossings={crossings};peak={int(x.max())}"


def features(members: DataFrame) -> DataFrame:
    """Digests and features of stored members, from the bytes read back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for media in batch.column(2):
                media = media.as_py()
                data = samples_of(media)
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(data)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return members.mapInArrow(
        run,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
    )
