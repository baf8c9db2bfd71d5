"""Blocked gzip files and their binning index, read by virtual offset: a block's place in the file, and a byte within the block."""

from __future__ import annotations

import fnmatch
import glob
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

#: The empty block that ends a whole file. A fixed value of the format.
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def filesystem(path: str):
    """A file system and the path in it: pyarrow's for a URI, the machine's own for a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def listed(pattern: str) -> list[str]:
    """Files that a path or pattern names, in order."""
    if "://" not in pattern:
        return sorted(glob.glob(pattern))
    from pyarrow import fs

    if not any(c in pattern for c in "*?["):
        return [pattern]
    parent = pattern.rpartition("/")[0]
    store, inner = fs.FileSystem.from_uri(parent)
    head = parent[: len(parent) - len(inner)]
    return sorted(head + i.path for i in store.get_file_info(fs.FileSelector(inner)) if fnmatch.fnmatch(i.path.rpartition("/")[2], pattern.rpartition("/")[2]))


def exists(path: str) -> bool:
    from pyarrow import fs

    store, inner = filesystem(path)
    return store.get_file_info(inner).type == fs.FileType.File


def opened(path: str):
    store, inner = filesystem(path)
    return store.open_input_file(inner)


class Blocks:
    """Bytes of a file from a virtual offset on, with the offset of what comes next."""

    def __init__(self, path: str, offset: int = 0):
        self.path, self._file = path, opened(path)
        self._next, self._block, self.data, self.at = offset >> 16, offset >> 16, b"", 0
        if offset & 0xFFFF:
            self._read()
            self.at = offset & 0xFFFF

    def _read(self) -> bool:
        self._file.seek(self._next)
        head = self._file.read(18)
        if not head:
            return False
        if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
            raise ValueError(f"not a BGZF block in {self.path}")
        extra, size = struct.unpack_from("<H", head, 10)[0], struct.unpack_from("<H", head, 16)[0] + 1
        body = self._file.read(size - 18)
        if len(body) < size - 18:
            raise ValueError(f"truncated file: {self.path}")
        self._block, self._next = self._next, self._next + size
        self.data, self.at = zlib.decompress(body[extra - 6 : -8], -15), 0
        return True

    def offset(self) -> int | None:
        """The virtual offset of the next byte; None at the file's end."""
        while self.at >= len(self.data):
            if not self._read():
                return None
        return self._block << 16 | self.at

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            if self.offset() is None:
                raise ValueError(f"truncated file: {self.path}")
            part = self.data[self.at : self.at + n]
            self.at, n = self.at + len(part), n - len(part)
            parts.append(part)
        return b"".join(parts)

    def close(self) -> None:
        self._file.close()


def bins_of(start: int, end: int) -> list[int]:
    """Bins of the index that may hold what overlaps [start, end), from 0. The levels' sizes are the format's fixed values."""
    found = [0]
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        found += range(first + (start >> shift), first + (end - 1 >> shift) + 1)
    return found


@dataclass
class Index:
    """For each reference its bins' chunks (virtual offsets from, to), and the least offset of each 16 kb."""

    bins: list[dict[int, list[tuple[int, int]]]]
    linear: list[list[int]]

    @classmethod
    def read(cls, path: str) -> Index:
        with opened(path) as f:
            raw = f.read()
        if raw[:4] != b"BAI\x01":
            raise ValueError(f"not an index: {path}")
        at, bins, linear = 8, [], []
        for _ in range(struct.unpack_from("<i", raw, 4)[0]):
            held: dict[int, list[tuple[int, int]]] = {}
            n = struct.unpack_from("<i", raw, at)[0]
            at += 4
            for _ in range(n):
                name, k = struct.unpack_from("<Ii", raw, at)
                at += 8
                chunks = list(struct.iter_unpack("<QQ", raw[at : at + 16 * k]))
                at += 16 * k
                if name < 37450:  # the pseudo-bin holds counts
                    held[name] = chunks
            n = struct.unpack_from("<i", raw, at)[0]
            linear.append(list(struct.unpack_from(f"<{n}Q", raw, at + 4)))
            at += 4 + 8 * n
            bins.append(held)
        return cls(bins, linear)

    def chunks(self, tid: int, start: int, end: int) -> list[tuple[int, int]]:
        """Offsets of what may overlap 1-based [start, end] of a reference."""
        if not 0 <= tid < len(self.bins):
            return []
        lines = self.linear[tid]
        first = max(start - 1, 0)
        least = lines[min(first >> 14, len(lines) - 1)] if lines else 0
        return [(max(a, least), b) for bin_ in bins_of(first, min(end, 1 << 29)) for a, b in self.bins[tid].get(bin_, []) if b > least]

    def starts(self) -> list[int]:
        """Offsets at which a record starts, in order."""
        return sorted({a for held in self.bins for chunks in held.values() for a, _ in chunks} | {x for lines in self.linear for x in lines if x})


def merged(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks in order, those that overlap or touch as one."""
    found: list[tuple[int, int]] = []
    for a, b in sorted(chunks):
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def index_of(path: str) -> str | None:
    """The index beside a file: its name and .bai, or .bai in place of .bam."""
    return next((p for p in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai") if exists(p)), None)


def whole_head(path: str) -> bool:
    with opened(path) as f:
        return f.read(4) == EOF[:4]


def whole_tail(path: str) -> bool:
    with opened(path) as f:
        size = f.size()
        f.seek(max(size - len(EOF), 0))
        return f.read(len(EOF)) == EOF


def payloads(path: str) -> Iterator[bytes]:
    blocks = Blocks(path)
    while blocks.offset() is not None:
        yield blocks.data[blocks.at :]
        blocks.at = len(blocks.data)
