"""Logs that grow, as a stream with keyed state.

What is appended to a log arrives as chunks ``file, start, data``: the bytes of ``data``
stand at ``start`` in ``file``. Chunks end anywhere, also within a line, may come more than once
and out of order. The state of a file is the offset up to which it is known, the number of
lines so far, the unfinished line, and chunks that came before their turn. A line leaves
when its line end is there, with its number, and is never given twice: so many appends, however
cut, give the rows of one read of the whole log.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHUNK = "file string, start long, data binary"
LINE = "file string, line_no long, line string"
#: Lines that leave in one frame, about; chunks may be a few lines each.
FRAME_LINES = 20_000
STATE = "offset long, n_lines long, rest binary, early_start array<long>, early_data array<binary>"


class Tail:
    """One file's reading place."""

    def __init__(self, offset: int = 0, n_lines: int = 0, rest: bytes = b"", early: dict[int, bytes] | None = None):
        self.offset, self.n_lines, self.rest, self.early = offset, n_lines, rest, early or {}
        self.starts = sorted(self.early)  # a heap: the chunk whose turn may be next is found without a look at all

    def add(self, start: int, data: bytes) -> list[tuple[int, str]]:
        """Lines that are whole now, with their numbers."""
        held = self.early.get(start)
        if held is None:
            heappush(self.starts, start)
        if held is None or len(data) > len(held):
            self.early[start] = data
        pieces = []
        while self.starts and self.starts[0] <= self.offset:
            at = heappop(self.starts)
            piece = self.early.pop(at)[self.offset - at:]  # what is known already is skipped
            pieces.append(piece)
            self.offset += len(piece)
        if not any(pieces):
            return []
        *whole, self.rest = (self.rest + b"".join(pieces)).split(b"\n")
        first = self.n_lines
        self.n_lines += len(whole)
        return [(first + k, line.decode("utf-8", "replace")) for k, line in enumerate(whole)]


def _frames(key: tuple, lines: list[tuple[int, str]]) -> Iterator[pd.DataFrame]:
    for k in range(0, len(lines), FRAME_LINES):
        some = lines[k:k + FRAME_LINES]
        yield pd.DataFrame({"file": key[0], "line_no": [n for n, _ in some], "line": [x for _, x in some]})


def follow(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    tail = Tail()
    if state.exists:
        offset, n_lines, rest, starts, data = state.get
        tail = Tail(offset, n_lines, bytes(rest), dict(zip(list(starts), map(bytes, data))))
    lines: list[tuple[int, str]] = []
    for frame in chunks:
        for start, data in sorted(zip(frame["start"], frame["data"]), key=lambda c: c[0]):
            lines += tail.add(int(start), bytes(data))
            if len(lines) >= FRAME_LINES:
                yield from _frames(key, lines)
                lines = []
    yield from _frames(key, lines)
    state.update((tail.offset, tail.n_lines, tail.rest, list(tail.early), list(tail.early.values())))


def tail_lines(chunks: DataFrame) -> DataFrame:
    """``file, line_no, line`` of the whole lines of a stream of chunks."""
    return chunks.groupBy("file").applyInPandasWithState(follow, LINE, STATE, "append", GroupStateTimeout.NoTimeout)


def tail_logs(spark: SparkSession, chunk_dir: str, target_dir: str, checkpoint: str) -> DataFrame:
    """Take all chunks that are new and append their whole lines to ``target_dir``; returns all lines so far."""
    stream = spark.readStream.schema(CHUNK).parquet(chunk_dir)
    query = (tail_lines(stream).writeStream.format("parquet").option("path", target_dir).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(LINE).parquet(target_dir)
