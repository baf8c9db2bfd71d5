"""Alignments and headers of BAM files through Python data sources: splits by virtual offset, regions by index, Arrow batches."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .bgzf import Blocks, Index, index_of, listed, merged

SCHEMA = "sample_id string, qname string, flag int, chrom string, pos long, mapq int, cigar string, mate_chrom string, mate_pos long, nh int, tid int, split int, row long, ordered boolean"
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in SCHEMA.split(", ")])
_INTEGERS = {b"c": "<b", b"C": "<B", b"s": "<h", b"S": "<H", b"i": "<i", b"I": "<I"}
_SIZES = {b"A": 1, b"c": 1, b"C": 1, b"s": 2, b"S": 2, b"i": 4, b"I": 4, b"f": 4}
#: Compressed bytes a task reads, where the index allows it; rows of an Arrow batch.
SPLIT, ROWS = 64 << 20, 8192


def read_head(blocks: Blocks) -> tuple[str, list[tuple[str, int]]]:
    """The header's text and (name, length) of each reference."""
    if blocks.take(4) != b"BAM\x01":
        raise ValueError(f"not a BAM file: {blocks.path}")
    text = blocks.take(struct.unpack("<i", blocks.take(4))[0]).rstrip(b"\0").decode()
    references = []
    for _ in range(struct.unpack("<i", blocks.take(4))[0]):
        name = blocks.take(struct.unpack("<i", blocks.take(4))[0])[:-1].decode()
        references.append((name, struct.unpack("<i", blocks.take(4))[0]))
    return text, references


def parsed(b: bytes, names: list[str]) -> tuple:
    """qname, flag, chrom, pos, mapq, cigar, mate_chrom, mate_pos, nh and tid of a record."""
    tid, pos, l_name, mapq, _, n_cigar, flag, l_seq, mtid, mpos, _ = struct.unpack_from("<iiBBHHHiiii", b)
    k = 32 + l_name
    cigar = "".join(f"{v >> 4}{'MIDNSHP=X'[v & 15]}" for v in struct.unpack_from(f"<{n_cigar}I", b, k)) or None
    k += 4 * n_cigar + (l_seq + 1) // 2 + l_seq
    nh = None
    while k < len(b):
        tag, kind = b[k : k + 2], b[k + 2 : k + 3]
        k += 3
        if kind in (b"Z", b"H"):
            k = b.index(b"\0", k) + 1
        elif kind == b"B":
            k += 5 + _SIZES[b[k : k + 1]] * struct.unpack_from("<i", b, k + 1)[0]
        else:
            if tag == b"NH" and kind in _INTEGERS:
                nh = struct.unpack_from(_INTEGERS[kind], b, k)[0]
            k += _SIZES[kind]
    return b[32 : 31 + l_name].decode(), flag, names[tid] if tid >= 0 else None, pos + 1, mapq, cigar, names[mtid] if mtid >= 0 else None, mpos + 1, nh, tid


def covered(cigar: str | None) -> int:
    """Bases of the reference that a CIGAR covers, 1 at least."""
    total = digits = 0
    for c in cigar or "":
        if c.isdigit():
            digits = digits * 10 + int(c)
        else:
            total, digits = total + (digits if c in "MDN=X" else 0), 0
    return max(total, 1)


def regions_of(text: str) -> list[tuple[str, int, int]]:
    """(chrom, start, end) of "chr1:5-90,chr2", both ends counted; a name alone is the whole of it, one with a colon too if no places follow."""
    found = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, _, span = part.rpartition(":")
        lo, dash, hi = span.partition("-")
        if name and dash and lo.isdigit() and hi.isdigit():
            found.append((name, max(int(lo), 1), int(hi)))
        else:
            found.append((part, 1, 1 << 29))
    return found


class Split(InputPartition):
    """Records of a file that start in any of the chunks; the last chunk of a whole scan has no end."""

    def __init__(self, path: str, number: int, chunks: list[tuple[int, int | None]]):
        self.path, self.number, self.chunks = path, number, chunks


class BamSource(DataSource):
    """spark.dataSource.register(BamSource); spark.read.format("bam").load(path, pattern or URI).

    sample_id is the file's name. A file with an index is read by many tasks of about ``splitBytes`` compressed bytes;
    without one by one. Option ``regions`` ("chr1:5-90,chr2") keeps what overlaps any region and reads the index's chunks
    alone; without an index it is an error. With option ``pushFilters`` (it needs spark.sql.python.filterPushdown.enabled)
    comparisons of chrom and pos with values prune chunks likewise, and Spark still filters. ``split`` and ``row`` number a file's splits and a split's
    rows, ``ordered`` tells whether a row doesn't come before the row ahead of it.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        kind = PushingReader if self.options.get("pushFilters", "false").lower() == "true" else BamReader
        return kind(self.options["path"], int(self.options.get("splitBytes", SPLIT)), self.options.get("regions"))


class BamReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, regions: str | None):
        self.path, self.split_bytes = path, split_bytes
        self.regions = None if regions is None else regions_of(regions)
        self.chroms: set[str] | None = None
        self.low, self.high = 1, 1 << 29

    def partitions(self):
        found = listed(self.path)
        if not found:
            raise FileNotFoundError(self.path)
        return [s for p in found for s in self._splits(p)]

    def _splits(self, path: str) -> list[Split]:
        index = index_of(path)
        blocks = Blocks(path)
        _, references = read_head(blocks)
        first = blocks.offset()
        blocks.close()
        if first is None:
            return []
        wanted = self.regions
        if wanted is None and self.chroms is not None and index:
            wanted = [(c, self.low, self.high) for c in sorted(c for c in self.chroms if c is not None)] if self.low <= self.high else []
        if wanted is not None:
            if index is None:
                raise ValueError(f"regions need an index: {path}")
            held, number = Index.read(index), {n: k for k, (n, _) in enumerate(references)}
            chunks: list[tuple[int, int | None]] = list(merged([c for n, a, b in wanted for c in held.chunks(number.get(n, -1), a, b)]))
        else:
            edges = [first]
            for at in Index.read(index).starts() if index else []:
                if (at >> 16) - (edges[-1] >> 16) >= self.split_bytes:
                    edges.append(at)
            return [Split(path, k, [(a, b)]) for k, (a, b) in enumerate(zip(edges, [*edges[1:], None]))]
        groups: list[list] = []
        size = self.split_bytes
        for a, b in chunks:
            if size >= self.split_bytes:
                groups.append([])
                size = 0
            groups[-1].append((a, b))
            size += max((b >> 16) - (a >> 16), 1)
        return [Split(path, k, g) for k, g in enumerate(groups)]

    def _records(self, split: Split) -> Iterator[tuple]:
        blocks = Blocks(split.path)
        names = [n for n, _ in read_head(blocks)[1]]
        blocks.close()
        sample = os.path.basename(split.path).removesuffix(".bam")
        row, last = 0, (-1, 0)
        for a, b in split.chunks:
            blocks = Blocks(split.path, a)
            while (at := blocks.offset()) is not None and (b is None or at < b):
                r = parsed(blocks.take(struct.unpack("<i", blocks.take(4))[0]), names)
                here = (r[9] if r[9] >= 0 else 1 << 31, r[3])
                ordered, last, row = here >= last, here, row + 1
                if self.regions is None or any(r[2] == n and r[3] <= hi and r[3] + covered(r[5]) - 1 >= lo for n, lo, hi in self.regions):
                    yield (sample, *r, split.number, row - 1, ordered)
            blocks.close()

    def read(self, partition: Split | None):
        rows: list[tuple] = []
        for r in self._records(partition) if partition else ():  # no split at all: Spark asks once with None
            rows.append(r)
            if len(rows) == ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


class PushingReader(BamReader):
    """A reader that takes filters; Spark refuses one where pushdown is off."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("chrom",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.chroms = named if self.chroms is None else self.chroms & named
            elif f.__class__ in (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual) and f.attribute == ("pos",):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            yield f


class BamHeaderSource(DataSource):
    """spark.read.format("bam_header").load(path or pattern): a row for each header line and each reference, a task for each file.

    kind is HD, SQ, RG, PG or CO as in the text, or REF for the binary list's references (tags SN and LN); line counts
    from 0 within a kind of source.
    """

    @classmethod
    def name(cls) -> str:
        return "bam_header"

    def schema(self) -> str:
        return "sample_id string, line int, kind string, tags map<string,string>, text string"

    def reader(self, schema) -> DataSourceReader:
        return BamHeaderReader(self.options["path"])


class BamHeaderReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        found = listed(self.path)
        if not found:
            raise FileNotFoundError(self.path)
        return [InputPartition(p) for p in found]

    def read(self, partition):
        blocks = Blocks(partition.value)
        text, references = read_head(blocks)
        blocks.close()
        sample = os.path.basename(partition.value).removesuffix(".bam")
        for k, line in enumerate(text.splitlines()):
            fields = line.split("\t")
            yield sample, k, fields[0].lstrip("@"), dict(f.split(":", 1) for f in fields[1:] if ":" in f) if fields[0] != "@CO" else {}, line
        for k, (name, length) in enumerate(references):
            yield sample, k, "REF", {"SN": name, "LN": str(length)}, ""


class BamProbeSource(DataSource):
    """spark.read.format("bam_probe").load(pattern): for each file whether its first block, its last one and an index are there, without reading between."""

    @classmethod
    def name(cls) -> str:
        return "bam_probe"

    def schema(self) -> str:
        return "sample_id string, path string, found boolean, head boolean, tail boolean, indexed boolean"

    def reader(self, schema) -> DataSourceReader:
        return BamProbeReader(self.options["path"])


class BamProbeReader(DataSourceReader):
    def __init__(self, path: str):
        self.paths = path.split(",")

    def partitions(self):
        return [InputPartition(p) for pattern in self.paths for p in (listed(pattern) or [pattern])]

    def read(self, partition):
        from .bgzf import exists, whole_head, whole_tail

        path, found = partition.value, exists(partition.value)
        yield os.path.basename(path).removesuffix(".bam"), path, found, found and whole_head(path), found and whole_tail(path), found and index_of(path) is not None


SOURCES = (BamSource, BamHeaderSource, BamProbeSource)
