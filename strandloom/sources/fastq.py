"""FASTQ as a Spark data source whose partitions are byte ranges, each of which begins reading at a record.

In four-line records no line but a header begins with @ or > and has a line that begins with + two lines later: a
sequence begins with neither sign, and two lines after a quality line there is a sequence. So a range finds its first
record by itself, and owns the records whose headers begin in it. Nothing is counted or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader

from .stores import Range, files, store

#: Bytes of a range, and of a read beyond its end.
RANGE, MORE = 32 << 20, 64 << 10
_COMPRESSED = (".gz", ".bz2", ".zst")
_NEWLINE = 10


def line_ends(data: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(data, np.uint8) == _NEWLINE)


def first_record(data: bytes, ends: np.ndarray) -> int | None:
    """Which line of data, the first of which begins where the data do, is the first header; None if more is needed."""
    starts = [0, *(ends[:12] + 1).tolist()]
    for i in range(len(starts) - 2):
        if starts[i + 2] >= len(data):
            break
        if data[starts[i] : starts[i] + 1] in (b"@", b">") and data[starts[i + 2] : starts[i + 2] + 1] == b"+":
            return i
        if i > 7:
            raise ValueError("these lines are no FASTQ records")
    return None


def batch_of(data: bytes, ends: np.ndarray, records: int) -> pa.RecordBatch:
    """name and seq of the first ``records`` records of data that begin with one; ends of lines without their break."""
    offsets = np.concatenate([[0], ends[: 4 * records - 1] + 1, [ends[4 * records - 1]]]) if records else np.zeros(1, np.int64)
    lines = pa.LargeStringArray.from_buffers(4 * records, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    pick = lambda k: pc.ascii_rtrim(lines.take(pa.array(np.arange(k, 4 * records, 4))), characters="\r\n").cast(pa.string())
    return pa.RecordBatch.from_arrays([pick(0), pick(1)], names=["name", "seq"])


def owned(read, start: int, end: int, size: int) -> pa.RecordBatch:
    """The records whose headers begin from ``start`` to before ``end``; ``read(length, at)`` gives bytes of the file."""
    begin = max(0, start - 1)
    data, at = read(end - begin, begin), end
    skip = 0
    while True:
        ends = line_ends(data)
        if start:  # the first whole line begins after a line break at start - 1 or later
            skip = int(ends[0]) + 1 if len(ends) else len(data)
        last = at >= size
        own = data[skip:]
        inner = ends[1:] - skip if start else ends
        if last and own and not own.endswith(b"\n"):
            inner = np.append(inner, len(own))
        first = 0 if not start else first_record(own, inner) if len(own) else None
        if first is not None:
            here = int(inner[first - 1]) + 1 if first else 0
            lines = np.concatenate([[here], inner[first:] + 1])
            headers = lines[0 : len(lines) : 4]
            mine = int((headers + skip + begin < end).sum())
            whole = (len(lines) - 1) // 4
            if whole >= mine or last:
                return batch_of(own[here:], inner[first:] - here, min(mine, whole))
        elif last or skip + begin >= end and len(ends):
            return batch_of(b"", np.zeros(0, np.int64), 0)
        more = read(min(max(MORE, len(data) // 8), size - at), at)
        data, at = data + more, at + len(more)


def streamed(stream) -> Iterator[pa.RecordBatch]:
    """All records of a stream, some of them at a time."""
    rest = b""
    while block := stream.read(RANGE):
        data = rest + block
        ends = line_ends(data)
        n = len(ends) // 4
        if n:
            yield batch_of(data, ends, n)
        rest = data[int(ends[4 * n - 1]) + 1 :] if n else data
    ends = line_ends(rest)
    if rest and not rest.endswith(b"\n"):
        ends = np.append(ends, len(rest))
    if len(ends) // 4:
        yield batch_of(rest, ends, len(ends) // 4)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("rangeBytes", RANGE))

    def partitions(self) -> list[Range]:
        found = []
        for name, size in files(self.path):
            if name.endswith(_COMPRESSED):
                found.append(Range(name, 0, -1))
            else:
                found += [Range(name, k, min(size, k + self.size)) for k in range(0, size, self.size)]
        return found

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # files without a byte have no ranges
            return
        where = store(self.path)[0]
        if partition.end < 0:
            with where.open_input_stream(partition.file) as f:
                yield from streamed(f)
            return
        with where.open_input_file(partition.file) as f:
            found = owned(lambda n, at: f.read_at(n, at), partition.start, partition.end, f.size())
        step = 1 << 14
        yield from (found.slice(k, step) for k in range(0, found.num_rows, step))


class FastqSource(DataSource):
    """spark.read.format("strandloom_fastq").option("rangeBytes", n).load(path): name (the whole header) and seq."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_fastq"

    def schema(self) -> str:
        return "name string, seq string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)
