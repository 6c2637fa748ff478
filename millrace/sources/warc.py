"""Reading web archives: ``spark.read.format("warc")``, a partition per file."""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.schemas import WARC_RECORD


def _headers(stream: BinaryIO) -> dict[str, str] | None:
    found: dict[str, str] = {}
    while line := stream.readline():
        line = line.strip()
        if not line:
            return found
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found or None


def _body(headers: dict[str, str], data: bytes) -> bytes:
    if headers.get("transfer-encoding", "").lower() == "chunked":
        parts, at = [], 0
        try:
            while (end := data.index(b"\r\n", at)) and (size := int(data[at:end].split(b";")[0], 16)):
                parts.append(data[end + 2 : end + 2 + size])
                at = end + 2 + size + 2
            data = b"".join(parts)
        except ValueError:
            pass
    if headers.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        try:
            data = zlib.decompress(data, zlib.MAX_WBITS | 32)
        except zlib.error:
            pass
    return data


#: Type of the rows that stand for bytes that are no record.
DAMAGED = "damaged"
_CHUNK = 1 << 16


def _skip(stream: BinaryIO, size: int) -> int:
    left = size
    while left and (part := stream.read(min(left, _CHUNK))):
        left -= len(part)
    return size - left


def records(stream: BinaryIO, largest: int | None = None) -> Iterator[tuple[str | None, str | None, str | None, bytes]]:
    """Type, target URL, HTTP content type and body of each record of an unpacked archive.

    Lines that begin no record are passed over up to the next that does, and a
    record cut off by the end of the file or by packed bytes that can't be
    unpacked ends the reading; each gives one row of type ``damaged``, so that
    it can be counted.  Of a record of more than ``largest`` bytes the body is
    left out.
    """
    lost = False
    try:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                if not lost:
                    yield DAMAGED, None, None, b""
                lost = True
                continue
            lost = False
            own = _headers(stream) or {}
            try:
                size = max(0, int(own.get("content-length", 0)))
            except ValueError:
                lost = True
                yield DAMAGED, own.get("warc-target-uri"), None, b""
                continue
            if largest is not None and size > largest:
                whole, block = _skip(stream, size) == size, b""
            else:
                block = stream.read(size)
                whole = len(block) == size
            if not whole:
                yield DAMAGED, own.get("warc-target-uri"), None, b""
                return
            kind, content_type, body = own.get("warc-type"), None, block
            if own.get("content-type", "").startswith("application/http") and kind in ("response", "revisit"):
                inner = io.BytesIO(block)
                inner.readline()
                http = _headers(inner) or {}
                content_type, body = http.get("content-type"), _body(http, inner.read())
            yield kind, own.get("warc-target-uri"), content_type, body
    except (OSError, EOFError, zlib.error):
        yield DAMAGED, None, None, b""


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_file(path: str) -> BinaryIO:
    """A file's bytes: of this machine, by http(s), or of any storage that Arrow knows by its scheme (hdfs, s3, gs, ...)."""
    scheme = path.split("://", 1)[0] if "://" in path else "file"
    if scheme == "file":
        return open(path.removeprefix("file://"), "rb")
    if scheme in ("http", "https"):
        from urllib.request import urlopen

        return urlopen(path, timeout=60)
    system, inner = _filesystem(path)
    return system.open_input_stream(inner, compression=None)


def list_files(pattern: str) -> list[str]:
    """The files of a glob by name, here or in a storage that Arrow knows; a path without wildcards stays as it is."""
    import fnmatch
    import glob

    if not any(c in pattern for c in "*?[") or pattern.startswith(("http://", "https://")):
        return [pattern]
    if "://" not in pattern or pattern.startswith("file://"):
        return sorted(glob.glob(pattern.removeprefix("file://")))
    from pyarrow import fs

    fixed = re.split(r"[*?\[]", pattern)[0].rsplit("/", 1)[0]
    system, inner = _filesystem(fixed)
    prefix = fixed.removesuffix(inner)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(prefix + f.path for f in found if f.is_file and fnmatch.fnmatchcase(prefix + f.path, pattern))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], open_: Callable[[str], BinaryIO]):
        self.paths, self.open = [p for p in options.get("path", "").split(",") if p], open_
        self.largest = int(options["largest"]) if "largest" in options else None

    def partitions(self) -> list[InputPartition]:
        return [_File(x) for p in self.paths for x in list_files(p)]

    def read(self, partition: _File) -> Iterator[tuple]:
        with self.open(partition.path) as raw:
            stream = io.BufferedReader(raw, 1 << 20) if not hasattr(raw, "peek") and hasattr(raw, "readinto") else raw
            packed = stream.peek(2)[:2] == b"\x1f\x8b" if hasattr(stream, "peek") else False
            yield from records(gzip.open(stream) if packed else stream, self.largest)


class WarcSource(DataSource):
    """Rows ``rec_type, url, content_type, payload``; ``path`` is a file, a glob or several by commas.

    Option ``largest``: bytes beyond which a record's body is left out.
    """

    open: Callable[[str], BinaryIO] = staticmethod(open_file)

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return WARC_RECORD

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, type(self).open)


def register(spark: SparkSession) -> None:
    """Makes ``spark.read.format("warc")`` known to the session."""
    spark.dataSource.register(WarcSource)
