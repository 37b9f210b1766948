"""Many files with differing headers, and what containers say of themselves."""

import io
import struct

from pyspark.sql import functions as F

from siftwork.sources import containers, headers, readers

HEADERS = [["path", "a"], ["path", "a", "b"], ["b", "path"], ["path", "note c"], ["x", "y", "z"]]


def test_a_thousand_files_with_five_headers(spark, tmp_path):
    folder = tmp_path / "logs of runs"
    folder.mkdir()
    for i in range(1000):
        names = HEADERS[i % 5]
        (folder / f"{i:04d}.csv").write_text(",".join(names) + "\n" + ",".join(f"{n}{i}" for n in names) + "\n")
    (folder / "1000.csv").write_bytes(b"")
    (folder / "1001.csv").write_bytes(b"path,\xff\xfe\n1,2\n")
    (folder / "1002.csv").write_bytes(b"path,path\n1,2\n")
    files = spark.read.format("binaryFile").load(str(folder)).select("path").union(spark.createDataFrame([(str(folder / "1000.csv"),), (None,)], "path string"))  # a listing leaves empty files out
    index = headers.header_index(files)
    bad = {r.path.rpartition("/")[2]: r.problem for r in index.where("problem is not null").collect()}
    assert bad == {"1000.csv": "empty", "1001.csv": "not UTF-8", "1002.csv": "a name of two columns"}
    assert index.where("problem is null").select("header").distinct().count() == 5
    table = headers.read_tables(spark, index)
    assert table.columns == ["path", "a", "b", "note c", "x", "y", "z", "src_file"]
    assert table._jdf.queryExecution().executedPlan().toString().count("Scan csv") <= 5 * 2  # the plan, and once more below its adaptive root
    assert table._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 5
    rows = {r.src_file[-8:-4]: r for r in table.collect()}
    assert len(rows) == 1000
    for i in range(1000):
        assert {n: rows[f"{i:04d}"][n] for n in table.columns[:-1]} == {n: f"{n}{i}" if n in HEADERS[i % 5] else None for n in table.columns[:-1]}
    assert readers.read_csvs(spark, [str(folder)]).count() == 1000
    assert readers.read_csvs(spark, [str(folder / "1000.csv"), str(folder / "none")]) is None


def test_headers():
    of = lambda b, whole=True: headers.header_of(b, whole)
    assert of(b'\xef\xbb\xbfa,"b ""q"""\n1,2') == (["a", 'b "q"'], None)
    assert of(b'"a\nb",c\n') == (["a\nb", "c"], None)
    assert of(b"a,,c\n")[1] == "a column without a name" and of(b"a\0b")[1] == "not a text" and of(b" \n")[1] == "empty"
    assert of(b'"never ends', False)[1] == "no header in its first bytes"


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I", 8 + len(body)) + kind + body


def wide_box(kind, size):
    """The head of a box whose content is not there."""
    return struct.pack(">I4sQ", 1, kind, 16 + size)


def movie(scale, duration, tracks):
    out = []
    for kind, track_scale, track_duration, runs, size in tracks:
        header = box(b"tkhd", bytes(76), struct.pack(">II", size[0] << 16, size[1] << 16))
        times = box(b"stts", bytes(4), struct.pack(">I", len(runs)), *(struct.pack(">II", *r) for r in runs))
        media = box(b"mdia", box(b"mdhd", struct.pack(">IIIIII", 0, 0, 0, track_scale, track_duration, 0)), box(b"hdlr", bytes(8), kind, bytes(13)), box(b"minf", box(b"stbl", times)))
        out.append(box(b"trak", header, media))
    return box(b"moov", box(b"mvhd", struct.pack(">IIIII", 0, 0, 0, scale, duration), bytes(80)), *out)


VIDEO = (b"vide", 12800, 128000, [(249, 512), (1, 1024)], (1280, 720))
AUDIO = (b"soun", 48000, 480000, [(468, 1024)], (0, 0))


class Counted(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def test_media_bytes_are_not_read():
    data = box(b"ftyp", b"isom") + box(b"mdat", bytes(5_000_000)) + movie(1000, 10000, [VIDEO, AUDIO])
    source = Counted(data)
    assert containers.probe_file(source, len(data)) == (10.0, True, True, 250, "3200000/128000", "12800/512", 1280, 720, None)
    assert source.got < 5_000


def test_probe(spark, tmp_path):
    good = box(b"ftyp", b"isom") + movie(1000, 10000, [VIDEO, AUDIO])
    names = {
        "good.mp4": good,
        "silent.mp4": movie(600, 0xFFFFFFFF, [VIDEO]),  # the movie does not know its duration
        "sound only.m4a": movie(1000, 2500, [AUDIO]),
        "cut.mp4": good[:-20],
        "text.mp4": b"not a container at all, just words",
        "empty.mp4": b"",
        "no movie.mp4": box(b"ftyp", b"isom") + box(b"mdat", b"x"),
    }
    for name, data in names.items():
        (tmp_path / name).write_bytes(data)
    with (tmp_path / "long.mp4").open("wb") as f:  # six gigabytes of media that are not on the disk
        f.write(wide_box(b"mdat", 6 << 30))
        f.seek(6 << 30, 1)
        f.write(movie(1000, 10000, [VIDEO]))
    files = spark.createDataFrame([(str(tmp_path / n),) for n in [*names, "none.mp4", "long.mp4"]] + [(None,)], "path string")
    got = {r.path.rpartition("/")[2]: r for r in containers.probe(files).collect()}
    assert len(got) == 9
    assert (got["good.mp4"].duration, got["good.mp4"].has_audio, got["good.mp4"].width) == (10.0, True, 1280)
    assert (got["silent.mp4"].duration, got["silent.mp4"].has_audio, got["silent.mp4"].frames) == (10.0, False, 250)
    assert (got["sound only.m4a"].duration, got["sound only.m4a"].has_video, got["sound only.m4a"].average_rate) == (2.5, False, None)
    assert got["long.mp4"].frames == 250 and got["long.mp4"].problem is None
    for bad in ("cut.mp4", "text.mp4", "empty.mp4", "no movie.mp4", "none.mp4"):
        assert got[bad].problem and got[bad].duration is None
    rates = containers.probe(files).where("path like '%good.mp4' or path like '%sound only%'").select(containers.frame_rate(F.col("average_rate"), F.col("base_rate")).alias("r"))
    assert sorted(r.r for r in rates.collect()) == [25.0, 30.0]
