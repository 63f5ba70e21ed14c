"""FASTQ by byte ranges: each task finds the first record that starts in its range by itself, so no line is shuffled."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, at long, name string, description string, seq string, qual string"
NAME = re.compile(r"\S*", re.ASCII)
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
RANGES, LARGEST = 200, 64 << 20  # ranges of an input, beyond which they become longer in place of more, up to so many bytes


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return pyarrow.fs.LocalFileSystem(), path


def records(f: io.BufferedIOBase, start: int, end: int) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, four lines) of the records that start in [start, end) of an open file.

    A record starts at a line that begins with @ and whose second next line
    begins with +. No other line of a record does: a quality may begin with @, but
    two lines after it comes a sequence. Lines that belong to no record are passed over.
    """
    if start:
        f.seek(start - 1)
        start += len(f.readline()) - 1
    at, ahead = start, []

    def fill(n: int) -> bool:
        nonlocal at
        while len(ahead) < n:
            line = f.readline()
            if not line:
                return False
            ahead.append((at, line.rstrip(b"\r\n")))
            at += len(line)
        return True

    while fill(3) and ahead[0][0] < end:
        if ahead[0][1][:1] == b"@" and ahead[2][1][:1] == b"+":
            if not fill(4):
                ahead.append((at, b""))  # the file ends before the quality
            yield ahead[0][0], [line for _, line in ahead]
            ahead.clear()
        else:
            ahead.pop(0)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["path"].split("\n")
        self.range_bytes = int(options.get("rangebytes", LARGEST))
        self.batch_rows = int(options.get("batchrows", 10_000))
        self.strict = options.get("strict", "false") == "true"

    def partitions(self) -> list[ByteRange]:
        """Ranges of all files of the paths; a compressed file is one range, hidden files are left out.

        A range is a task, whose start costs far more than a short range: so ranges
        have ``range_bytes`` at least, and are longer where that would make many.
        """
        files = []
        for path in self.paths:
            fs, inner = _filesystem(path)
            info = fs.get_file_info(inner)
            if info.type == pyarrow.fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.type == pyarrow.fs.FileType.File else fs.get_file_info(pyarrow.fs.FileSelector(inner))
            for f in sorted(found, key=lambda f: f.path):
                if f.type == pyarrow.fs.FileType.File and f.base_name[0] not in "._":
                    files.append(f)
        fair = max(self.range_bytes, min(LARGEST, sum(f.size for f in files) // RANGES))
        out = []
        for f in files:
            step = f.size or 1 if f.path.endswith(COMPRESSED) else fair
            out += [ByteRange(f.path, a, a + step) for a in range(0, f.size, step)]
        return out

    def read(self, part: ByteRange | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        fs, _ = _filesystem(self.paths[0])
        raw = fs.open_input_stream(part.path) if part.path.endswith(COMPRESSED) else fs.open_input_file(part.path)
        with raw, io.BufferedReader(raw, 1 << 20) as f:
            rows: list[tuple] = []
            for at, lines in records(f, part.start, 1 << 62 if part.path.endswith(COMPRESSED) else part.end):
                header, seq, _, qual = (x.decode("utf-8", "replace") for x in lines)
                if len(seq) != len(qual):
                    if self.strict:
                        raise ValueError(f"bad FASTQ record at byte {at} of {part.path}")
                    continue
                name = NAME.match(header, 1)[0]
                rows.append((part.path, at, name, header[1 + len(name) :].strip(" "), seq, qual))
                if len(rows) >= self.batch_rows:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in SCHEMA.split(", ")])


class FastqSource(DataSource):
    """``spark.read.format("fastq_records").load(path)``, after :func:`register`."""

    @classmethod
    def name(cls) -> str:
        return "fastq_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def fastq_records(spark: SparkSession, paths: str | list[str], strict: bool = False, range_bytes: int = LARGEST) -> DataFrame:
    """(file, at, name, description, seq, qual): the good records of FASTQ files, ``at`` the byte that a record starts at.

    What :func:`seqlake.sources.text.fastq_scan` gives for well-formed files,
    without a shuffle and without record numbers. Where lines are missing, reading
    goes on at the next record, while the scan by line numbers has lost its place
    for the rest of the file. Paths are those that Arrow's file systems open. Ranges have
    ``range_bytes`` at least; they are longer where an input would have over ``RANGES`` of them.
    """
    spark.dataSource.register(FastqSource)
    options = {"path": "\n".join([paths] if isinstance(paths, str) else paths), "strict": str(strict).lower(), "rangebytes": str(range_bytes)}
    return spark.read.format("fastq_records").options(**options).load()
