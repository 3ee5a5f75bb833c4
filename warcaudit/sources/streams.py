"""Chunked work on single files, called inside tasks. Any filesystem that pyarrow can open."""

from __future__ import annotations

import hashlib
import os
import posixpath
import uuid
import zlib

from pyarrow import fs

_CHUNK = 4 * 1024 * 1024

TRUNCATED = "unexpected end of file"
NOT_GZIP = "not in gzip format"
DAMAGED = "invalid compressed data--format violated"
TRAILING = "decompression OK, trailing garbage ignored"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and plain path of a URI or a local path.

    Only the root of a URI is parsed: what follows is a path as Spark gives it, with spaces, ``#`` and ``%`` as they are.
    """
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or len(scheme) < 2:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inner = rest.removeprefix("//").partition("/")
    found, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return found, f"{root.rstrip('/')}/{inner}"


def _make_folder(place: fs.FileSystem, folder: str) -> None:
    if isinstance(place, fs.LocalFileSystem):
        os.makedirs(folder, exist_ok=True)
    else:
        place.create_dir(folder, recursive=True)


def _reading(place: fs.FileSystem, path: str):
    return open(path, "rb", buffering=0) if isinstance(place, fs.LocalFileSystem) else place.open_input_stream(path, compression=None)


def _writing(place: fs.FileSystem, path: str):
    return open(path, "wb") if isinstance(place, fs.LocalFileSystem) else place.open_output_stream(path, compression=None)


def _name(place: fs.FileSystem, part: str, path: str) -> None:
    """Give a file its final name."""
    if isinstance(place, fs.LocalFileSystem):
        os.replace(part, path)
    else:
        place.move(part, path)


class Gunzip:
    """Decode gzip members one after the other as chunks arrive.

    ``reason`` says what is wrong once the input has ended; zero padding after a member is allowed.
    """

    def __init__(self) -> None:
        self._member = None
        self._members = 0
        self._head = b""
        self.reason: str | None = None

    @property
    def stopped(self) -> bool:
        return self.reason is not None

    def feed(self, chunk: bytes):
        data = self._head + chunk
        self._head = b""
        while not self.stopped:
            if self._member is None:
                if self._members:
                    data = data.lstrip(b"\0")
                if len(data) < 2:
                    self._head = data
                    return
                if data[:2] != b"\x1f\x8b":
                    self.reason = TRAILING if self._members else NOT_GZIP
                    return
                self._member = zlib.decompressobj(wbits=31)
            try:
                # A bounded output size keeps a highly compressed chunk from filling the memory.
                out = self._member.decompress(data, _CHUNK)
            except zlib.error:
                self.reason = DAMAGED
                return
            if out:
                yield out
            if self._member.eof:
                data, self._member = self._member.unused_data, None
                self._members += 1
            else:
                data = self._member.unconsumed_tail
                if not data and len(out) < _CHUNK:
                    return

    def close(self) -> None:
        if self.stopped:
            return
        if self._member is not None or not self._members:
            self.reason = TRUNCATED
        elif self._head:
            self.reason = TRAILING


def check_file(path: str, target: str | None = None, md5: str | None = None):
    """MD5 and size of a file and, with a target, the unzipped file.

    Returns ``(md5, size, unzipped size, reason)``; the MD5 is None when the file cannot be read. The target
    appears only if the MD5 is the expected one and the content could be decoded.
    """
    digest, size, written, gunzip, part, sink = hashlib.md5(), 0, 0, Gunzip(), None, None
    target_fs = None
    try:
        source_fs, source_path = open_path(path)
        with _reading(source_fs, source_path) as source:
            if target is not None:
                target_fs, target_path = open_path(target)
                folder, name = posixpath.split(target_path)
                _make_folder(target_fs, folder)
                # Hidden names are left out of file listings, so an abandoned part is never counted.
                part = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
                sink = _writing(target_fs, part)
            while chunk := source.read(_CHUNK):
                digest.update(chunk)
                size += len(chunk)
                if sink is not None:
                    for out in gunzip.feed(chunk):
                        written += sink.write(out) or len(out)
    except FileNotFoundError:
        return None, None, None, "No such file or directory"
    except (OSError, ValueError) as error:
        _drop(target_fs, part, sink)
        return None, None, None, str(error)
    actual = digest.hexdigest()
    if sink is None:
        return actual, size, None, None
    sink.close()
    gunzip.close()
    if gunzip.reason in (None, TRAILING) and md5 in (None, actual):
        _name(target_fs, part, target_path)
        return actual, size, written, gunzip.reason
    target_fs.delete_file(part)
    return actual, size, None, gunzip.reason


def _drop(target_fs, part, sink) -> None:
    if sink is not None:
        sink.close()
        target_fs.delete_file(part)


def write_file(path: str, content: bytes) -> None:
    """Write a small file under a hidden name first, so that it is there whole or not at all."""
    target_fs, target_path = open_path(path)
    folder, name = posixpath.split(target_path)
    _make_folder(target_fs, folder)
    part = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
    with _writing(target_fs, part) as sink:
        sink.write(content)
    _name(target_fs, part, target_path)


def remove_folder(root: str, name: str) -> bool:
    """Delete one folder directly below a root, if it is there."""
    if not name or "/" in name or name in (".", ".."):
        raise ValueError(f"'{name}' is not the name of a seed folder")
    root_fs, root_path = open_path(root)
    folder = posixpath.join(root_path, name)
    if root_fs.get_file_info(folder).type != fs.FileType.Directory:
        return False
    root_fs.delete_dir(folder)
    return True


def child_names(path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    path_fs, inner = open_path(path)
    found = path_fs.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(info.base_name for info in found)
