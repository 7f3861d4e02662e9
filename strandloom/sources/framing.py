"""Lines of text in the public snappy framing format, as a Spark data source that reads ranges of chunks and writes parts.

A chunk begins with four bytes, its kind and length, so an index of chunks needs these alone: it is made once on the
driver by hopping from chunk to chunk. A range of chunks gives the lines that begin in it, and one that begins where it
ends; the sums of what chunks hold are checked. No file is ever held whole.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage

from .stores import Range, files, store

#: What a stream begins with; bytes of a chunk before compression at most; bytes of a range of chunks.
MAGIC, CHUNK, RANGE = b"\xff\x06\x00\x00sNaPpY", 65536, 32 << 20
_LANE = 256
# The polynomial of CRC-32C, bits in reverse, and what is added to a sum.
_POLYNOMIAL, _ADDED = 0x82F63B78, 0xA282EAD8


@cache
def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The table of one byte's step, and for lanes of 256, 512, ... bytes what zeros of that length make of a sum."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(_POLYNOMIAL), step >> 1).astype(np.uint32)
    shift = (np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    for _ in range(_LANE):
        shift = step[shift & 255] ^ shift >> 8
    shifts = [shift]
    while _LANE << len(shifts) < CHUNK:
        shifts.append(_shifted(shifts[-1], shifts[-1]))
    return step, shifts


def _shifted(sums: np.ndarray, by: np.ndarray) -> np.ndarray:
    return by[0][sums & 255] ^ by[1][sums >> 8 & 255] ^ by[2][sums >> 16 & 255] ^ by[3][sums >> 24]


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each part, of at most a chunk's bytes. Lanes of all parts advance together, then are joined by twos."""
    step, shifts = _tables()
    lanes = np.zeros((len(parts), CHUNK), np.uint8)
    for row, part in zip(lanes, parts):
        if part:  # zeros before a message change nothing if its first four bytes are inverted in place of the start value
            row[-len(part) :] = np.frombuffer(part, np.uint8)
            row[CHUNK - len(part) : CHUNK - len(part) + 4] ^= 255
    lanes = np.ascontiguousarray(lanes.reshape(len(parts), -1, _LANE).transpose(2, 0, 1))
    sums = np.zeros(lanes.shape[1:], np.uint32)
    for column in lanes:
        sums = step[(sums ^ column) & 255] ^ sums >> 8
    for shift in shifts:
        sums = _shifted(sums[:, 0::2], shift) ^ sums[:, 1::2]
    out = ~sums[:, 0]
    for k, part in enumerate(parts):
        if len(part) < 4:
            short = 0xFFFFFFFF
            for b in part:
                short = int(step[(short ^ b) & 255]) ^ short >> 8
            out[k] = short ^ 0xFFFFFFFF
    return out


def masked(sums: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (sums >> 15 | sums << 17) + np.uint32(_ADDED)


def chunked(data: bytes) -> bytes:
    """Chunks of data, compressed where that is shorter."""
    parts = [data[k : k + CHUNK] for k in range(0, len(data), CHUNK)]
    out, codec = [], pa.Codec("snappy")
    for part, check in zip(parts, masked(crc32c(parts)).tolist() if parts else []):
        body = codec.compress(part, asbytes=True)
        kind, body = (0, body) if len(body) < len(part) else (1, part)
        out.append(struct.pack("<I", kind | len(body) + 4 << 8) + struct.pack("<I", check) + body)
    return b"".join(out)


def framed(data: bytes) -> bytes:
    """A whole stream."""
    return MAGIC + chunked(data)


def content(kind: int, body: bytes) -> tuple[bytes, int | None]:
    """(what a chunk holds, the sum that it should have)."""
    if kind == 0:
        length, shift, k = 0, 0, 4
        while True:
            length |= (body[k] & 127) << shift
            shift, k = shift + 7, k + 1
            if body[k - 1] < 128:
                break
        return pa.Codec("snappy").decompress(body[4:], decompressed_size=length, asbytes=True), struct.unpack("<I", body[:4])[0]
    if kind == 1:
        return body[4:], struct.unpack("<I", body[:4])[0]
    if 2 <= kind <= 127:
        raise ValueError(f"unknown chunk {kind}")
    return b"", None


def chunks(read, start: int, size: int, check: bool = True) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the chunks from ``start`` on; a wrong sum (with ``check``) or a chunk that is cut short is an
    error."""
    held: list[tuple[int, bytes, int]] = []

    def checked() -> Iterator[tuple[int, bytes]]:
        sums = [want for _, _, want in held] if not check else masked(crc32c([data for _, data, _ in held])).tolist() if held else []
        for (at, data, want), got in zip(held, sums):
            if got != want:
                raise ValueError(f"the chunk at byte {at} has a wrong sum")
            yield at, data
        held.clear()

    at = start
    while at < size:
        head = read(4, at)
        length = int.from_bytes(head[1:4], "little")
        body = read(length, at + 4)
        if len(head) < 4 or len(body) < length:
            raise ValueError(f"the chunk at byte {at} is cut short")
        data, want = content(head[0], body)
        if want is not None:
            held.append((at, data, want))
        at += 4 + length
        if len(held) == 16:
            yield from checked()
    yield from checked()


def unframed(data: bytes) -> bytes:
    """The content of a whole stream."""
    return b"".join(part for _, part in chunks(lambda n, at: data[at : at + n], 0, len(data)))


def index(read, size: int, wanted: int = RANGE) -> list[int]:
    """Where ranges of about ``wanted`` bytes begin, each at a chunk, and where the last one ends."""
    at, starts = 0, [0]
    while at < size:
        if at - starts[-1] >= wanted:
            starts.append(at)
        at += 4 + int.from_bytes(read(4, at)[1:4], "little")
    return [*starts, size]


def lines(read, start: int, end: int, size: int, check: bool = True) -> Iterator[list[bytes]]:
    """The lines of a range of chunks, some at a time: those that begin in it, not with it (but for the first range), or
    right where it ends."""
    begun: list[bytes] = []  # of a line whose end is in a later chunk
    skipping = start > 0
    for at, data in chunks(read, start, size, check):
        if at >= end:  # one more line end, and the range is complete
            if skipping:
                return
            cut = data.find(b"\n")
            begun.append(data if cut < 0 else data[:cut])
            if cut < 0:
                continue
            yield [b"".join(begun)]
            return
        if skipping:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skipping = data[cut + 1 :], False
        first, *whole = data.split(b"\n")
        if not whole:
            begun.append(first)
            continue
        *whole, rest = whole
        yield [b"".join([*begun, first]), *whole]
        begun = [rest] if rest else []
    if any(begun):
        yield [b"".join(begun)]


class FramedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("rangeBytes", RANGE))
        self.totals = options.get("totals") == "true"

    def partitions(self) -> list[Range]:
        where, found = store(self.path)[0], []
        for name, size in files(self.path):
            with where.open_input_file(name) as f:
                starts = index(lambda n, at: f.read_at(n, at), size, self.size)  # noqa: B023
            found += [Range(name, a, b) for a, b in zip(starts, starts[1:])]
        return found

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without files has no ranges
            return
        with store(self.path)[0].open_input_file(partition.file) as f:
            place = 0
            if self.totals:  # the rows' own reading checks the sums
                n = sum(map(len, lines(lambda n, at: f.read_at(n, at), partition.start, partition.end, f.size(), False)))
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array([partition.file]), pa.array([partition.start]), pa.array([n])], names=["file", "block", "n"])
                return
            for some in lines(lambda n, at: f.read_at(n, at), partition.start, partition.end, f.size()):
                n = len(some)
                text = pa.array([x.removesuffix(b"\r") for x in some], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([text, pa.array([partition.file] * n, pa.string()), pa.array(np.full(n, partition.start)), pa.array(np.arange(place, place + n))], names=["value", "file", "block", "place"])
                place += n


@dataclass
class Part(WriterCommitMessage):
    temporary: str
    name: str


class FramedWriter(DataSourceArrowWriter):
    """Each task writes a part under a name of its own; the driver gives parts their names once all are there."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.run = options["path"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        where, top = store(self.path)
        context = TaskContext.get()
        temporary = f"{top}/_{self.run}/{uuid.uuid4().hex}"
        where.create_dir(f"{top}/_{self.run}", recursive=True)
        rest = bytearray()
        with where.open_output_stream(temporary) as out:
            out.write(MAGIC)
            for batch in iterator:
                for text in batch.column(0).to_pylist():
                    rest += (text or "").encode() + b"\n"
                whole = len(rest) // CHUNK * CHUNK
                if whole:
                    out.write(chunked(bytes(rest[:whole])))
                    del rest[:whole]
            out.write(chunked(bytes(rest)))
        return Part(temporary, f"part-{context.partitionId():05d}.sz")

    def commit(self, messages: list[Part]) -> None:
        where, top = store(self.path)
        if self.overwrite:
            for old in where.get_file_info(fs.FileSelector(top, allow_not_found=True)):
                if old.type == fs.FileType.File:
                    where.delete_file(old.path)
        for m in messages:
            if m is not None:
                where.move(m.temporary, f"{top}/{m.name}")
        where.create_dir(top, recursive=True)
        self._clear(where, top)
        where.open_output_stream(f"{top}/_SUCCESS").close()

    def abort(self, messages: list[Part]) -> None:
        self._clear(*store(self.path))

    def _clear(self, where: fs.FileSystem, top: str) -> None:
        if where.get_file_info(f"{top}/_{self.run}").type != fs.FileType.NotFound:
            where.delete_dir(f"{top}/_{self.run}")


class FramedSource(DataSource):
    """spark.read.format("strandloom_framed").load(path): value, file, block (where a range begins) and place of lines,
    or, with the option ``totals``, file, block and n, how many lines begin in a range;
    df.write.format("strandloom_framed").save(path): parts of the lines of a column ``value``, in the order of rows."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_framed"

    def schema(self) -> str:
        if self.options.get("totals") == "true":
            return "file string, block bigint, n bigint"
        return "value string, file string, block bigint, place bigint"

    def reader(self, schema) -> FramedReader:
        return FramedReader(self.options)

    def writer(self, schema, overwrite: bool) -> FramedWriter:
        return FramedWriter(self.options, overwrite)
