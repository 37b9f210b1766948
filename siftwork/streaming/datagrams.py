"""A source of datagrams that can be read again.

``readStream.format("datagrams")`` listens at a local UDP port (options port and folder). What has arrived is written to a
segment in the folder, which driver and executors share, before a batch is told of it; offsets are a segment and a place
in it. So a batch that is tried again, also by a query that is started anew from its checkpoint, reads the same packets
again, and none twice. Executors read the segments, in several tasks (option tasks).

Segments stay until a later commit and until there are more than ``keep`` of them behind it (option, 16).
"""

from __future__ import annotations

import re
import socket
import struct
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LENGTH = struct.Struct("<I")
NAME = re.compile(r"segment-([0-9]{12})-([0-9]{9})\.bin$")


def segment_name(number: int, packets: int) -> str:
    return f"segment-{number:012d}-{packets:09d}.bin"


def write_segment(folder: str, number: int, packets: list[bytes]) -> None:
    """A file of packets, each behind its length; it has its name only when it is whole."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    whole = f"{root}/{segment_name(number, len(packets))}"
    with store.open_output_stream(f"{whole}.part", compression=None) as out:
        for p in packets:
            out.write(LENGTH.pack(len(p)) + p)
    store.move(f"{whole}.part", whole)


def read_segment(folder: str, number: int, packets: int) -> Iterator[bytes]:
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{segment_name(number, packets)}", compression=None) as source:
        while head := source.read(LENGTH.size):
            yield source.read(LENGTH.unpack(head)[0])


def segments(folder: str) -> dict[int, int]:
    """The number of packets of each segment in the folder."""
    store, root = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {int(m[1]): int(m[2]) for f in found if (m := NAME.search(f.path))}


def drop_segments(folder: str, numbers: list[tuple[int, int]]) -> None:
    store, root = fs.FileSystem.from_uri(folder)
    for n, packets in numbers:
        store.delete_file(f"{root}/{segment_name(n, packets)}")


class DatagramSource(DataSource):
    """``readStream.format("datagrams")``: segment, place (in the segment, from 0) and packet."""

    @classmethod
    def name(cls) -> str:
        return "datagrams"

    def schema(self) -> str:
        return "segment long, place long, packet binary"

    def streamReader(self, schema) -> DatagramReader:
        return DatagramReader(int(self.options["port"]), self.options["folder"].rstrip("/"), int(self.options.get("tasks", 4)), int(self.options.get("keep", 16)), int(self.options.get("batch", 100_000)))


class Places(InputPartition):
    """Some places of a segment."""

    def __init__(self, segment: int, packets: int, first: int, end: int):
        super().__init__(segment)
        self.segment, self.packets, self.first, self.end = segment, packets, first, end


class DatagramReader(DataSourceStreamReader):
    """An offset is (segment, place): all segments before, and the places before in this one, have been read."""

    def __init__(self, port: int, folder: str, tasks: int, keep: int, batch: int):
        self.port, self.folder, self.tasks, self.keep, self.batch, self.socket = port, folder, tasks, keep, batch, None

    def initialOffset(self) -> dict:
        # A new query begins behind what earlier ones have left.
        return {"segment": max(segments(self.folder), default=-1) + 1, "place": 0}

    def latestOffset(self) -> dict:
        """Writes what has arrived as the next segment."""
        if self.socket is None:
            self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
            self.socket.setsockopt(socket.SOL_SOCKET, socket.SO_REUSEADDR, 1)
            self.socket.bind(("127.0.0.1", self.port))
            self.socket.setblocking(False)
        got = []
        while len(got) < self.batch:
            try:
                got.append(self.socket.recv(65535))
            except BlockingIOError:
                break
        number = max(segments(self.folder), default=-1) + 1
        if not got:
            return {"segment": number, "place": 0}
        write_segment(self.folder, number, got)
        return {"segment": number, "place": len(got)}

    def partitions(self, start: dict, end: dict) -> list[Places]:
        """What lies between two offsets, cut into runs of places; the segments say how many packets they hold."""
        there, out = segments(self.folder), []
        for number in range(start["segment"], end["segment"] + 1):
            first = start["place"] if number == start["segment"] else 0
            last = end["place"] if number == end["segment"] else there.get(number, 0)
            if last > first:
                if number not in there:
                    raise FileNotFoundError(f"segment {number} of {self.folder} is gone: raise the option keep")
                step = -(-(last - first) // self.tasks)
                out += [Places(number, there[number], at, min(at + step, last)) for at in range(first, last, step)]
        return out

    def read(self, partition: Places) -> Iterator[tuple]:
        for place, packet in enumerate(read_segment(self.folder, partition.segment, partition.packets)):
            if place >= partition.end:
                return
            if place >= partition.first:
                yield partition.segment, place, packet

    def commit(self, end: dict) -> None:
        old = [x for x in sorted(segments(self.folder).items()) if x[0] < end["segment"]]
        drop_segments(self.folder, old[: -self.keep] if self.keep else old)

    def stop(self) -> None:
        if self.socket is not None:
            self.socket.close()
            self.socket = None
