"""Raw event-stream text: frames over range and file ends, runs that resume."""

import io
import json

import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st

from editpulse.sources import frames
from editpulse.streaming.layers import ONCE


class _File(io.BytesIO):
    def read_at(self, size, at):
        self.seek(at)
        return self.read(size)


def _whole(data: bytes) -> list[bytes]:
    """Frames that a blank line ends, line by line."""
    found, lines = [], []
    for line in data.split(b"\n")[:-1]:
        if line.rstrip(b"\r"):
            lines.append(line)
        elif lines:
            found.append(b"\n".join(lines))
            lines = []
    return found


@given(
    st.lists(st.sampled_from([b"data: a", b"id: 1", b"\n", b"\r\n", b"\n\n", b"\r\n\r\n", b":"]), max_size=30),
    st.integers(1, 12),
    st.integers(1, 5),
)
@hypothesis_settings(max_examples=300, deadline=None)
def test_ranges_cut_every_frame_once(pieces, step, read_ahead):
    data, before = b"".join(pieces), frames.STEP_BYTES
    frames.STEP_BYTES = read_ahead
    try:
        cuts = [x for a in range(0, len(data), step) for x in frames.cut(_File(data), a, min(a + step, len(data)))]
    finally:
        frames.STEP_BYTES = before
    places = [place for place, _ in cuts]
    assert places == sorted(set(places))
    assert [b"\n".join(x for x in frame.split(b"\n") if x.strip(b"\r")) for _, frame in cuts if frame.strip(b"\r\n")] == _whole(data)


def test_fields(spark, tmp_path):
    text = (
        ": hello\n\nid: 1\ndata: {\"a\":\ndata:  1}\n\nevent: heartbeat\nid\ndata\n\n"
        "event:\r\nretry: 5\r\ndata:x: y\r\n\r\nid: 9\nevent: message\n\ndataset: no\n\ndata: cut of"
    )
    (tmp_path / "0").write_bytes(text.encode())
    for size in (1, 7, 1 << 20):
        rows = frames.read_frames(spark, str(tmp_path), range_bytes=size).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(
            [("1", "message", '{"a":\n 1}'), ("", "heartbeat", ""), (None, "message", "x: y")], key=str
        )


def _run(spark, tmp_path):
    rows = frames.read_frames(spark, str(tmp_path / "wire"), stream=True, range_bytes=64)
    writer = rows.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(**ONCE)
    writer.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    return sorted(int(r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def _offset(tmp_path):
    newest = max((p for p in (tmp_path / "checkpoint/offsets").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    return json.loads(newest.read_text().splitlines()[-1])


def test_a_stream_resumes_behind_the_last_whole_frame(spark, tmp_path):
    frame = lambda i: f"event: message\nid: {i}\ndata: text {i}\n\n"
    wire = tmp_path / "wire"
    wire.mkdir()
    assert frames._StreamReader({"path": str(wire)}).latestOffset()["file"] == ""
    (wire / "001").write_text("".join(map(frame, range(20))) + frame(20)[:-1])
    assert _run(spark, tmp_path) == list(range(20))
    assert (_offset(tmp_path)["file"], _offset(tmp_path)["id"]) == ("001", "19")
    with open(wire / "001", "a") as file:  # the frame ends, the next breaks off
        file.write("\n" + frame(21) + frame(22)[:9])
    assert _run(spark, tmp_path) == list(range(22))
    (wire / "002").write_text("".join(map(frame, range(22, 30))))
    assert _run(spark, tmp_path) == list(range(30))
    assert _run(spark, tmp_path) == list(range(30))
    assert _offset(tmp_path)["id"] == "29"


def test_the_last_match_is_found_over_steps(tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "STEP_BYTES", 16)
    data = b"\nid: seven\ndata: " + b"x" * 100 + b"\n\n" + b"y" * 70
    (tmp_path / "f").write_bytes(data)
    folder = frames._Folder(str(tmp_path))
    at, _ = folder.last("f", len(data), frames._BLANK)
    assert at == len(data) - 70
    assert folder.last("f", at, frames._ID_LINE)[1][1] == b"seven"
    assert folder.last("f", 0, frames._BLANK) == (0, None)


@pytest.mark.parametrize("stream", [False, True])
def test_an_empty_folder_has_no_frames(spark, tmp_path, stream):
    (tmp_path / "wire").mkdir()
    if stream:
        frames.read_frames(spark, str(tmp_path / "wire"), stream=True)
    else:
        assert frames.read_frames(spark, str(tmp_path / "wire")).count() == 0
