"""What a video's container says of it, from the headers of its boxes alone.

An ISO base media file (mp4, mov, m4v) is a sequence of boxes, each behind its size and kind. The movie box holds the
duration and, for each track, its kind, time scale and the runs of equal sample durations. A task walks the boxes of a
file by their sizes with small reads at places; the media box, which is nearly all of a file, is stepped over.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import rational
from .readers import store_of

PROBED = "path string, duration double, has_audio boolean, has_video boolean, frames long, average_rate string, base_rate string, width int, height int, problem string"
#: Bytes of the tables inside a track that are read at most (a table of sample times is longer for odd streams only).
TABLE = 8 << 20
# Kinds of boxes that hold boxes.
NESTED = ("moov", "trak", "mdia", "minf", "stbl")


class BadContainer(ValueError):
    pass


def boxes(source: BinaryIO, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """(kind, start of its content, end) of the boxes between two places."""
    at = start
    while at + 8 <= end:
        source.seek(at)
        head = source.read(16)
        if len(head) < 8:
            raise BadContainer("it ends inside a box")
        size, kind, body = int.from_bytes(head[:4], "big"), head[4:8].decode("latin-1"), at + 8
        if size == 1:
            if len(head) < 16:
                raise BadContainer("it ends inside a box")
            size, body = int.from_bytes(head[8:16], "big"), at + 16
        last = end if size == 0 else at + size
        if last < body or last > end:
            raise BadContainer(f"a box {kind!r} that does not fit")
        yield kind, body, last
        at = last


def content(source: BinaryIO, start: int, end: int, most: int = 256) -> bytes:
    source.seek(start)
    return source.read(min(end - start, most))


def timing(data: bytes) -> tuple[int, int]:
    """(time scale, duration) of a movie's or track's header box."""
    wide = data[:1] == b"\x01"
    scale, duration = struct.unpack_from(">IQ" if wide else ">II", data, 20 if wide else 12)
    return scale, 0 if duration in (0xFFFFFFFF, 0xFFFFFFFFFFFFFFFF) else duration


class Track:
    def __init__(self) -> None:
        self.kind, self.scale, self.duration, self.samples, self.common, self.width, self.height = "", 0, 0, 0, 0, 0, 0

    def read(self, source: BinaryIO, kind: str, start: int, end: int) -> None:
        if kind == "mdhd":
            self.scale, self.duration = timing(content(source, start, end))
        elif kind == "hdlr":
            self.kind = content(source, start, end)[8:12].decode("latin-1")
        elif kind == "tkhd":
            self.width, self.height = (x >> 16 for x in struct.unpack(">II", content(source, end - 8, end)))
        elif kind == "stts":
            data = content(source, start, end, TABLE)
            runs = [struct.unpack_from(">II", data, 8 + 8 * i) for i in range(min(int.from_bytes(data[4:8], "big"), (len(data) - 8) // 8))]
            self.samples = sum(n for n, _ in runs)
            # The duration that most samples have is that of the base rate.
            counts: dict[int, int] = {}
            for n, delta in runs:
                counts[delta] = counts.get(delta, 0) + n
            self.common = max(counts, key=lambda d: (counts[d], -d), default=0)


def walk(source: BinaryIO, start: int, end: int, track: Track | None, tracks: list[Track], movie: list[tuple[int, int]]) -> None:
    for kind, body, last in boxes(source, start, end):
        own = track
        if kind == "trak":
            own = Track()
            tracks.append(own)
        if kind in NESTED:
            walk(source, body, last, own, tracks, movie)
        elif kind == "mvhd":
            movie.append(timing(content(source, body, last)))
        elif own is not None:
            own.read(source, kind, body, last)


def probe_file(source: BinaryIO, size: int) -> tuple:
    """The columns of PROBED behind the path."""
    tracks: list[Track] = []
    movie: list[tuple[int, int]] = []
    try:
        walk(source, 0, size, None, tracks, movie)
        if not movie:
            raise BadContainer("no movie box")
    except (BadContainer, struct.error) as e:
        return (None,) * 8 + (str(e),)
    video = next((t for t in tracks if t.kind == "vide"), None)
    scale, duration = movie[0]
    seconds = duration / scale if scale and duration else max((t.duration / t.scale for t in tracks if t.scale), default=None)
    average = f"{video.samples * video.scale}/{video.duration}" if video and video.duration else None
    base = f"{video.scale}/{video.common}" if video and video.common else None
    return seconds, any(t.kind == "soun" for t in tracks), video is not None, video.samples if video else None, average, base, video.width if video else None, video.height if video else None, None


def probe(files: DataFrame) -> DataFrame:
    """path, duration (seconds), has_audio, has_video, frames, average_rate and base_rate (N/D), width, height, problem of ``files`` (path).

    Each file is opened in a task through ``pyarrow.fs`` and walked box by box. Edge cases: what is no such container,
    ends inside a box, has no movie box or cannot be opened has a problem and nothing else; unknown durations are the
    longest track's; files without a video track have no rates; null paths are left out; an empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PROBED.split(", ")]
        types = [pa.string(), pa.float64(), pa.bool_(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                try:
                    store, place = store_of(path)
                    with store.open_input_file(place) as source:
                        rows.append((path, *probe_file(source, source.size())))
                except (OSError, pa.ArrowException) as e:
                    rows.append((path, *(None,) * 8, f"cannot be opened: {type(e).__name__}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return files.select("path").where("path is not null").mapInArrow(read, PROBED)


def frame_rate(average: Column, base: Column, fallback: float = 30.0) -> Column:
    """The first positive of two rational rates."""
    return F.coalesce(rational(average), rational(base), F.lit(fallback))
