"""Append-only logs of JSON lines, read from a cursor of bytes: a Spark data source for batches and streams.

An outbox is a folder of files (names that begin with a dot or an underscore don't count), or one file, to which writers only append. A cursor names for each file the byte up to which
it has been read, always the end of a line, so a reader resumes in the middle of a file. Each file's unread bytes are split into ranges
that tasks read on their own. A file that is shorter than its cursor, or gone, stops the reader, and so does a line that isn't UTF-8. A last line
without its newline is still being written: it waits.

The file system is the one that the path names (pyarrow's), not the driver's disk.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

LINES = "file string, byte_offset bigint, line string"
SPLIT_BYTES, BATCH_BYTES, CHUNK, LINES_AT_ONCE = 64 << 20, 16 << 20, 1 << 20, 8192


def located(path: str) -> tuple[stores.FileSystem, str]:
    if path.startswith("file:"):
        return stores.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return stores.FileSystem.from_uri(path) if "://" in path else (stores.LocalFileSystem(), path)


def sizes(path: str) -> dict[str, int]:
    """Bytes of each file of the outbox, by path."""
    store, root = located(path)
    info = store.get_file_info(root)
    if info.type == stores.FileType.File:
        return {root: info.size}
    if info.type == stores.FileType.NotFound:
        return {}
    found = store.get_file_info(stores.FileSelector(root))
    return {f.path: f.size for f in found if f.type == stores.FileType.File and f.base_name[0] not in "._"}


def checked(path: str, cursor: Mapping[str, int]) -> dict[str, int]:
    """The sizes, none of which may be under the cursor."""
    now = sizes(path)
    for file, at in cursor.items():
        if at < 0 or now.get(file, -1) < at:
            raise ValueError(f"{file} was cut before the cursor: {at} bytes were read, it has {now.get(file, 'gone')}")
    return now


def last_line_end(path: str, file: str, begin: int, most: int | None, size: int) -> int:
    """The end of the last whole line in the bytes from begin, most of them; of the first line where that is longer."""
    stop = size if most is None else min(size, begin + most)
    with located(path)[0].open_input_file(file) as f:
        high = stop
        while high > begin:
            low = max(begin, high - CHUNK)
            f.seek(low)
            if (at := f.read(high - low).rfind(b"\n")) >= 0:
                return low + at + 1
            high = low
        f.seek(stop)
        while stop < size:
            part = f.read(min(CHUNK, size - stop))
            if (at := part.find(b"\n")) >= 0:
                return stop + at + 1
            stop += len(part)
    return begin


@dataclass
class FileRange(InputPartition):
    file: str
    begin: int
    end: int
    whole: bool  # whether begin is the beginning of a line


def ranges(start: Mapping[str, int], end: Mapping[str, int]) -> list[FileRange]:
    found = []
    for file in sorted(end):
        first = start.get(file, 0)
        found += [FileRange(file, at, min(end[file], at + SPLIT_BYTES), at == first) for at in range(first, end[file], SPLIT_BYTES)]
    return found


def read_range(path: str, part: FileRange | None) -> Iterator[pa.RecordBatch]:
    """The lines that begin in the range (none: nothing is unread), with the byte each begins at."""
    if part is None:
        return
    offsets, lines = [], []
    with io.BufferedReader(located(path)[0].open_input_file(part.file), CHUNK) as f:
        f.seek(part.begin if part.whole else part.begin - 1)
        if not part.whole:
            f.readline()  # it belongs to the range before; only a newline if the range begins with a line
        at = f.tell()
        while at < part.end:
            raw = f.readline()
            if not raw:
                break
            try:
                line = raw.decode().strip()
            except UnicodeDecodeError as e:
                raise ValueError(f"{part.file} is not UTF-8 at byte {at}: {e.reason}") from e
            if line:
                offsets.append(at)
                lines.append(line)
            at += len(raw)
            if len(lines) == LINES_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array([part.file] * len(lines)), pa.array(offsets, pa.int64()), pa.array(lines)], ["file", "byte_offset", "line"])
                offsets, lines = [], []
    if lines:
        yield pa.RecordBatch.from_arrays([pa.array([part.file] * len(lines)), pa.array(offsets, pa.int64()), pa.array(lines)], ["file", "byte_offset", "line"])


class OutboxReader(DataSourceReader):
    def __init__(self, path: str, start: dict[str, int], end: dict[str, int]):
        self.path, self.start, self.end = path, start, end

    def partitions(self):
        return ranges(self.start, self.end)

    def read(self, partition):
        return read_range(self.path, partition)


class OutboxStreamReader(DataSourceStreamReader):
    """Offsets are cursors. A batch takes at most batch_bytes more of each file (or one line).

    Spark gives a reader its offsets only after asking for the next, so what was committed is also written to the file named by ``cursor``, beside the
    stream's checkpoint: after a restart batches are measured from there.
    """

    def __init__(self, path: str, batch_bytes: int, cursor: str | None):
        self.path, self.batch_bytes, self.cursor = path, batch_bytes, cursor
        self.at: dict[str, int] = {}
        self.steps = 1
        if cursor is not None:
            store, file = located(cursor)
            if store.get_file_info(file).type == stores.FileType.File:
                with store.open_input_stream(file) as f:
                    self.at = json.loads(f.read())
                self.steps = 2  # the commit of the last batch may not have been told

    def initialOffset(self):
        return {}

    def latestOffset(self):
        now = checked(self.path, self.at)
        for file, size in sorted(now.items()):
            begin = self.at.get(file, 0)
            if size > begin:
                self.at[file] = last_line_end(self.path, file, begin, self.batch_bytes * self.steps, size)
        self.steps = 1
        return dict(self.at)

    def partitions(self, start, end):
        checked(self.path, end)
        return ranges(start, end)

    def read(self, partition):
        return read_range(self.path, partition)

    def commit(self, end):
        if self.cursor is not None:
            store, file = located(self.cursor)
            store.create_dir(file.rpartition("/")[0])
            with store.open_output_stream(f"{file}.new") as f:
                f.write(json.dumps(end).encode())
            store.move(f"{file}.new", file)


class Outbox(DataSource):
    """Options: path; for a batch start and end (cursors as JSON, by default nothing and all whole lines); for a stream batch_bytes and cursor (a file)."""

    @classmethod
    def name(cls):
        return "outbox"

    def schema(self):
        return LINES

    def reader(self, schema):
        path, start = self.options["path"], json.loads(self.options.get("start", "{}"))
        end = json.loads(self.options["end"]) if "end" in self.options else line_ends(path, start)
        return OutboxReader(path, start, end)

    def streamReader(self, schema):
        return OutboxStreamReader(self.options["path"], int(self.options.get("batch_bytes", BATCH_BYTES)), self.options.get("cursor"))


def line_ends(path: str, start: Mapping[str, int]) -> dict[str, int]:
    return {file: last_line_end(path, file, start.get(file, 0), None, size) for file, size in checked(path, start).items()}


def read_unread(spark: SparkSession, path: str, cursor: Mapping[str, int] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """The lines after the cursor, and the cursor after them."""
    spark.dataSource.register(Outbox)
    start = dict(cursor or {})
    end = line_ends(path, start)
    return spark.read.format("outbox").option("path", path).option("start", json.dumps(start)).option("end", json.dumps(end)).load(), end


def stream_lines(spark: SparkSession, path: str, batch_bytes: int = BATCH_BYTES, cursor: str | None = None) -> DataFrame:
    """A stream of lines; cursor is a file beside the checkpoint of the query that reads it."""
    spark.dataSource.register(Outbox)
    stream = spark.readStream.format("outbox").option("path", path).option("batch_bytes", batch_bytes)
    return (stream if cursor is None else stream.option("cursor", cursor)).load()


#: The kinds of messages between stages.
MESSAGE_TYPES = ("source_result_ready", "candidate_site_found", "site_gate_decision", "deep_parse_done", "host_event", "company_completed")
REQUIRED = ("run_id", "ts", "message_type", "stage", "inn")


def messages(lines: DataFrame) -> DataFrame:
    """file, byte_offset and the fields of a message; a line that isn't a whole message stops the reader.

    Texts are trimmed and may not be empty, row_index is a positive whole number, payload is JSON other than null.
    """
    refuse = lambda why: F.raise_error(F.concat(F.lit(f"{why} at byte "), F.col("byte_offset").cast("string"), F.lit(" of "), F.col("file")))
    schema = ", ".join(f"{c} string" for c in (*REQUIRED, "row_index", "payload"))
    parsed = F.from_json("line", schema, {"mode": "FAILFAST"})
    rows = lines.withColumn("m", F.when(F.col("line").startswith("{"), parsed).otherwise(refuse("no JSON object").cast(parsed_type())))
    rows = rows.select("file", "byte_offset", *[F.trim(f"m.{c}").alias(c) for c in REQUIRED], F.trim("m.row_index").try_cast("bigint").alias("row_index"), "m.payload")
    whole = F.col("message_type").isin(*MESSAGE_TYPES) & (F.col("row_index") > 0) & F.col("payload").isNotNull()
    for c in REQUIRED:
        whole = whole & (F.col(c) != "")
    return rows.filter(F.when(F.coalesce(whole, F.lit(False)), True).otherwise(refuse("a message lacks a field or has an unknown type").cast("boolean")))


def parsed_type() -> str:
    return "struct<" + ", ".join(f"{c}: string" for c in (*REQUIRED, "row_index", "payload")) + ">"


def append_messages(rows: DataFrame, path: str) -> None:
    """Rows with the fields of a message, written as new files of the outbox; payload is JSON text."""
    whole = F.struct(*REQUIRED, "row_index", F.parse_json("payload").alias("payload"))
    rows.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value")).write.mode("append").option("lineSep", "\n").text(path)
