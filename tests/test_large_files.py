"""Trade files that are large for a task: their lines go out in pieces."""

import gzip

import pyarrow as pa
import pytest

from barlake.sources import trades


def lines_of(name, data):
    batch = pa.RecordBatch.from_arrays([pa.array([f"/landing/{name}"]), pa.array([data], pa.binary())], names=["path", "content"])
    return [found.column(0).to_pylist() for found in trades._unpacked([batch])]


@pytest.mark.parametrize("name", ["a.json", "a.json.gz", "a"])
def test_a_file_goes_out_in_pieces_as_splitlines_has_it(monkeypatch, name):
    text = '{"a": "é"}\r\n\n\r{"b": "😀"} \n{"c": 1}\n' * 50 + "no end"
    data = text.encode() + b"\xff"
    for piece in (1, 7, 1000):
        monkeypatch.setattr(trades, "PIECE", piece, raising=False)
        found = lines_of(name, data if name == "a.json" else gzip.compress(data))
        assert sum(found, []) == data.decode("utf-8", errors="replace").splitlines()
        assert max(map(len, found)) <= piece + 1


def test_damage_at_the_end_keeps_every_line_back(monkeypatch):
    monkeypatch.setattr(trades, "PIECE", 100, raising=False)
    packed = gzip.compress(b"".join(b'{"line": %d}\n' % n for n in range(10_000)))
    for damaged in (packed[:-3], packed[:-8] + b"\0" * 8):
        (only,) = sum(lines_of("a.json.gz", damaged), [])
        assert only.startswith(trades.UNREADABLE)
