import random

import pytest

from tallyloom.sources import paged_text
from tallyloom.sources.paged_text import FileRange, PagedTextReader, read_pages


def split(data):
    parts = data.split(b"\f")
    return [p.decode("utf-8", "replace") for p in (parts if parts[-1] else parts[:-1])]


FILES = {
    "a.txt": "eins\fzwei ü\f\f\fend".encode(), "b.TXT": b"", "c.txt": b"\f", "d.txt": b"one page", "e.txt": b"\f\fx\f", "sub/f.txt": "ж\f".encode() * 50,
    "g.txt": b"\xff\xfe\fok", "_hidden.txt": b"no", "h.csv": b"no\fno"}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    for name, data in FILES.items():
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def local(folder, size, counted):
    reader = PagedTextReader(folder, ".txt", size, counted)
    return [row for r in reader.partitions() for b in reader.read(r) for row in b.to_pylist()]


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_every_page_is_in_one_range(folder, size, block, monkeypatch):
    monkeypatch.setattr(paged_text, "BLOCK", block)
    rows = local(folder, size, False)
    for name, data in FILES.items():
        if name.lower().endswith("txt") and name[0] != "_":
            assert [r["text"] for r in rows if r["source_file"] == name] == split(data), name
    counted = {(r["source_file"], r["part"]): r["pages"] for r in local(folder, size, True)}
    for key, n in counted.items():
        assert n == sum((r["source_file"], r["part"]) == key for r in rows), key


def test_random_files(tmp_path, monkeypatch):
    rng = random.Random(1)
    for trial in range(200):
        data = bytes(rng.choice(b"ab\f") for _ in range(rng.randrange(1, 40)))
        (tmp_path / "x.txt").write_bytes(data)
        monkeypatch.setattr(paged_text, "BLOCK", rng.randrange(1, 9))
        size = rng.randrange(1, 12)
        rows, counted = local(str(tmp_path), size, False), local(str(tmp_path), size, True)
        assert [r["text"] for r in rows] == split(data)
        before = {r["part"]: sum(c["pages"] for c in counted if c["part"] < r["part"]) for r in counted}
        assert [before[r["part"]] + r["place"] for r in rows] == list(range(len(rows)))


def test_numbered_pages(spark, folder):
    got = [tuple(r) for r in read_pages(spark, folder, range_bytes=7).collect()]
    want = [(name, i + 1, text) for name, data in FILES.items() if name.lower().endswith("txt") and name[0] != "_" for i, text in enumerate(split(data))]
    assert sorted(got) == sorted(want)


def test_no_files(spark, tmp_path):
    assert read_pages(spark, str(tmp_path)).count() == 0


def test_only_blocks_are_held(tmp_path):
    """A range that holds no page start reads one byte and its breaks; a long page is read by the range that begins it."""
    (tmp_path / "long.txt").write_bytes(b"x" * 5_000_000 + b"\fend")
    reader = PagedTextReader(str(tmp_path), ".txt", 1_000_000, False)
    sizes = [[len(t) for b in reader.read(r) for t in b.column("text").to_pylist()] for r in reader.partitions()]
    assert sizes == [[5_000_000], [], [], [], [], [3]] and isinstance(reader.partitions()[0], FileRange)
