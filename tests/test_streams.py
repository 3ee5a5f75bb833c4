"""Chunked hashing and unzipping of single files, without Spark."""

from __future__ import annotations

import gzip
import hashlib
import os

import pytest

from warcaudit.sources import streams

PLAIN = b"one" * 1000
MEMBERS = gzip.compress(PLAIN) + gzip.compress(b"two") + gzip.compress(b"")
CASES = [
    (MEMBERS, PLAIN + b"two", None),
    (MEMBERS + b"\0" * 600, PLAIN + b"two", None),
    (MEMBERS + b"trailing", PLAIN + b"two", streams.TRAILING),
    (MEMBERS + b"x", PLAIN + b"two", streams.TRAILING),
    (MEMBERS[:-3], None, streams.TRUNCATED),
    (gzip.compress(PLAIN)[:20], None, streams.TRUNCATED),
    (b"", None, streams.TRUNCATED),
    (b"WARC/1.0", None, streams.NOT_GZIP),
    (gzip.compress(PLAIN)[:-8] + b"\0" * 8, None, streams.DAMAGED),
]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("content, unzipped, reason", CASES)
def test_any_chunking_gives_the_same(content, unzipped, reason, size):
    gunzip = streams.Gunzip()
    out = b"".join(b"".join(gunzip.feed(content[i:i + size])) for i in range(0, len(content), size))
    gunzip.close()
    assert gunzip.reason == reason
    assert unzipped is None or out == unzipped


def test_a_highly_compressed_file_comes_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(streams, "_CHUNK", 1000)
    gunzip = streams.Gunzip()
    pieces = list(gunzip.feed(gzip.compress(b"a" * 100_000)))
    gunzip.close()
    assert gunzip.reason is None and b"".join(pieces) == b"a" * 100_000 and max(map(len, pieces)) <= 1000


def test_check_file(tmp_path):
    source, target = str(tmp_path / "a.warc.gz"), str(tmp_path / "out" / "a.warc")
    with open(source, "wb") as file:
        file.write(MEMBERS)
    md5 = hashlib.md5(MEMBERS).hexdigest()
    assert streams.check_file(source) == (md5, len(MEMBERS), None, None)
    assert streams.check_file(source, target, "0" * 32) == (md5, len(MEMBERS), None, None)
    assert os.listdir(tmp_path / "out") == []
    assert streams.check_file("file:" + source, "file:" + target, md5) == (md5, len(MEMBERS), len(PLAIN) + 3, None)
    assert os.listdir(tmp_path / "out") == ["a.warc"]
    assert streams.check_file(source + ".missing", target, md5) == (None, None, None, "No such file or directory")


def test_only_seed_folders_are_removed(tmp_path):
    os.makedirs(tmp_path / "1234")
    for name in ("", ".", "..", "a/b"):
        with pytest.raises(ValueError):
            streams.remove_folder(str(tmp_path), name)
    assert streams.remove_folder(str(tmp_path), "1234") and not streams.remove_folder(str(tmp_path), "1234")


def test_paths_are_taken_as_they_are(tmp_path):
    name = str(tmp_path / "a #b%20" / "c d.gz")
    for path in (name, f"file:{name}", f"file://{name}"):
        streams.write_file(path, b"x")
        assert streams.open_path(path)[1] == name and streams.check_file(path)[1] == 1
    assert streams.check_file("nowhere://host/x")[3] is not None
