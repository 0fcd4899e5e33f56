"""Raw event-stream text, as captured from the wire, cut into frames.

A folder holds one file per connection, named in order; only the last one grows.
A frame ends with a blank line. What a connection had not ended is left out, as
the next connection sends it again from the last whole frame's id on.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "event_frames"
RANGE_BYTES = 16 << 20
STEP_BYTES = 64 << 10

_BLANK = re.compile(rb"(?<=\n)\r?\n")
_BLANK_BYTES = 3  # the line end before a blank line, and the blank line
_ID_LINE = re.compile(rb"(?<=\n)id: ?([^\r\n]*)\r?\n")

_NAMES: WeakKeyDictionary[SparkSession, str] = WeakKeyDictionary()

# Workers get this module with the source, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_frames(spark: SparkSession, path: str, stream: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Feed lines (id, event, data) of the captured text under ``path``.

    As a stream it goes on behind the last whole frame that it took; that place
    and the last id are its offset.
    """
    reader = spark.readStream if stream else spark.read
    return feed_lines(reader.format(_format(spark)).option("rangeBytes", range_bytes).load(path))


def _format(spark: SparkSession) -> str:
    """The source's name in this session.

    A session neither finds what another one registered nor takes that name again,
    so each has its own. A stream's checkpoint does not hold the name.
    """
    if spark not in _NAMES:
        _NAMES[spark] = f"{FORMAT}_{uuid.uuid4().hex}"
        named = {"name": classmethod(lambda cls, name=_NAMES[spark]: name)}
        spark.dataSource.register(type("NamedFrameSource", (FrameSource,), named))
    return _NAMES[spark]


def feed_lines(frames: DataFrame) -> DataFrame:
    """Frames as id, event and data; the lines of a message's data are joined again.

    Comments and unknown fields are skipped, and so are frames without data. An
    event without a name is a message.
    """
    lines = F.split("frame", "\r?\n")
    named = frames.select(_values(lines, "id").alias("ids"), _values(lines, "event").alias("events"), _values(lines, "data").alias("parts"))
    event = F.nullif(F.try_element_at("events", F.lit(-1)), F.lit(""))
    return named.filter(F.size("parts") > 0).select(
        F.try_element_at("ids", F.lit(-1)).alias("id"),
        F.coalesce(event, F.lit("message")).alias("event"),
        F.array_join("parts", "\n").alias("data"),
    )


def _values(lines: Column, field: str) -> Column:
    """Values of all lines of a field, without the one blank that may follow the colon."""
    own = F.filter(lines, lambda line: (line == field) | line.startswith(f"{field}:"))
    return F.transform(own, lambda line: F.regexp_replace(line, f"^{field}:? ?", ""))


@dataclass
class _Range(InputPartition):
    """Frames that start at ``low`` or behind it, and before ``high``."""

    file: str
    low: int
    high: int


class _Folder:
    def __init__(self, path: str):
        from pyarrow import fs

        if "://" in path or path.startswith("file:"):
            self.system, self.path = fs.FileSystem.from_uri(path)
        else:
            self.system, self.path = fs.LocalFileSystem(), path

    def files(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        own = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
        return sorted((f.base_name, f.size) for f in own)

    def open(self, name: str):
        return self.system.open_input_file(f"{self.path.rstrip('/')}/{name}")

    def last(self, name: str, size: int, wanted: re.Pattern) -> tuple[int, re.Match | None]:
        """Where the last match before ``size`` ends, and the match; looked for from the end."""
        with self.open(name) as file:
            high = size
            while high > 0:
                low = max(high - STEP_BYTES, 0)
                # A match that is cut by a step is found with the one before.
                buffer = file.read_at(min(high + STEP_BYTES, size) - low, low)
                found = None
                for found in wanted.finditer(buffer):
                    pass
                if found:
                    return low + found.end(), found
                high = low
        return 0, None


def cut(file, low: int, high: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of every whole frame that starts in ``[low, high)``."""
    at = max(low - _BLANK_BYTES, 0)
    buffer = file.read_at(high - at, at)
    start, seen = (0 if low == 0 else None), 0
    while True:
        for blank in _BLANK.finditer(buffer, seen):
            if start is not None and at + blank.start() > start:
                yield start, buffer[start - at : blank.start()]
            end, seen = at + blank.end(), blank.end()
            if end >= high:
                return
            if end >= low:
                start = end
        more = file.read_at(STEP_BYTES, at + len(buffer))
        if not more:
            return
        # The end of what was read may be the first half of a blank line.
        seen = max(seen, len(buffer) - 1)
        drop = max(min(seen - 1, len(buffer) if start is None else start - at), 0)
        buffer, at, seen = buffer[drop:] + more, at + drop, seen - drop


class _Reading:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def ranges(self, spans: list[tuple[str, int, int]]) -> list[_Range]:
        step = self.range_bytes
        return [_Range(file, a, min(a + step, high)) for file, low, high in spans for a in range(low, high, step)]

    def read(self, partition: _Range | None) -> Iterator[tuple]:
        if partition is None:  # what a folder without files gives
            return
        with _Folder(self.path).open(partition.file) as file:
            for place, frame in cut(file, partition.low, partition.high):
                yield partition.file, place, frame.decode("utf-8", "replace")


class _BatchReader(_Reading, DataSourceReader):
    def partitions(self) -> list[_Range]:
        return self.ranges([(name, 0, size) for name, size in _Folder(self.path).files()])


class _StreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"file": "", "at": 0, "id": ""}

    def latestOffset(self) -> dict:
        folder = _Folder(self.path)
        files = folder.files()
        if not files:
            return self.initialOffset()
        name, size = files[-1]
        at, _ = folder.last(name, size, _BLANK)
        _, line = folder.last(name, at, _ID_LINE)
        return {"file": name, "at": at, "id": line[1].decode("utf-8", "replace") if line else ""}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        spans = []
        for name, size in _Folder(self.path).files():
            if start["file"] <= name <= end["file"]:
                low = start["at"] if name == start["file"] else 0
                spans.append((name, low, end["at"] if name == end["file"] else size))
        return self.ranges(spans)

    def commit(self, end: dict) -> None:
        """Nothing is held for taken frames."""


class FrameSource(DataSource):
    """The frames under ``path``; ``rangeBytes`` is what one task reads."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, place long, frame string"

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)
