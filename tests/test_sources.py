import struct
import zlib

import pytest

from spliceframe.operators import harvest
from spliceframe.sources.bam import BamSource
from spliceframe.sources.gtf import read_gtf, write_gtf
from spliceframe.sources.tables import CHUNK, fetch, read_bed, read_fasta, read_sheet
from spliceframe.streaming.census import stream_census


def bgzf(data: bytes, block: int = 60) -> bytes:
    out = b""
    for k in range(0, len(data) + 1, block):
        part = data[k : k + block]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        out += b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def record(name, flag, tid, pos, mapq, cigar, tags=b""):
    ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
    body = struct.pack("<iiBBHHHiiii", tid, pos, len(name) + 1, mapq, 0, len(cigar), flag, 4, -1, -1, 0) + name.encode() + b"\0" + ops + b"\x11\x11" + b"!!!!" + tags
    return struct.pack("<i", len(body)) + body


def test_bam_round_trip(spark, tmp_path):
    head = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    data += record("a", 0, 0, 9, 60, [(10, "M"), (50, "N"), (10, "M")], b"XSA+" + b"NHC\x01" + b"ZZZtext\0" + b"BBBc" + struct.pack("<i", 2) + b"\1\2")
    data += record("b", 16, 0, 99, 3, [(20, "M")])
    (tmp_path / "s1.bam").write_bytes(bgzf(data))
    spark.dataSource.register(BamSource)
    rows = spark.read.format("bam").load(str(tmp_path / "*.bam")).orderBy("qname").collect()
    assert [(r["sample_id"], r["qname"], r["flag"], r["chrom"], r["pos"], r["mapq"], r["cigar"], r["nh"]) for r in rows] == [("s1", "a", 0, "chr1", 10, 60, "10M50N10M", 1), ("s1", "b", 16, "chr1", 100, 3, "20M", None)]
    (tmp_path / "bad.bam").write_bytes(bgzf(data)[:-40])
    with pytest.raises(Exception, match="truncated|BGZF"):
        spark.read.format("bam").load(str(tmp_path / "bad.bam")).collect()


def test_gtf(spark, tmp_path):
    p = tmp_path / "g.gtf"
    p.write_text('#c\nchr1\tx\tgene\t10\t200\t.\t+\t.\tgene_id "A"; gene_name "N 1"; gene_biotype lncRNA;\nchr1\tx\texon\t10\t80\t.\t*\t.\tgene_id "A"; transcript_id "A.1"; cov "2.5";\n')
    a, b = read_gtf(spark, str(p)).orderBy("end", ascending=False).collect()
    assert (a["gene_id"], a["gene_name"], a["biotype"], a["transcript_id"], a["strand"]) == ("A", "N 1", "lncRNA", None, "+")
    assert (b["transcript_id"], b["cov"], b["strand"], b["gene_name"]) == ("A.1", 2.5, ".", None)
    t = spark.sql("SELECT 'chr1' AS chrom, '+' AS strand, 'R' AS gene_id, 'R.1' AS transcript_id, array(named_struct('start', 1L, 'end', 5L), named_struct('start', 9L, 'end', 12L)) AS exons")
    write_gtf(t, str(tmp_path / "out"))
    assert sorted((r["start"], r["end"], r["gene_id"]) for r in read_gtf(spark, str(tmp_path / "out")).collect()) == [(1, 5, "R"), (9, 12, "R")]
    p.write_text("chr1\tx\tgene\t10\n")
    with pytest.raises(Exception, match="bad GTF row"):
        read_gtf(spark, str(p)).collect()
    assert read_gtf(spark, str(p), strict=False).count() == 0


def test_bed_sheet_fasta(spark, tmp_path):
    (tmp_path / "r.bed").write_text("track x\nchr1\t0\t10\tALU\nchr1\t20\t21\n")
    assert [tuple(r) for r in read_bed(spark, str(tmp_path / "r.bed")).orderBy("start").collect()] == [("chr1", 1, 10, "ALU"), ("chr1", 21, 21, None)]
    (tmp_path / "s.tsv").write_text("sample_id\tbam\tgroup\tstrandedness\na\ta.bam\tcontrol\trf\nb\tb.bam\tcontrol\trf\nc\tc.bam\ttreat\trf\n")
    assert [(r["sample_id"], r["replicate"]) for r in read_sheet(spark, str(tmp_path / "s.tsv")).orderBy("sample_id").collect()] == [("a", 1), ("b", 2), ("c", 1)]
    seq = "acgtTTGGCA" * 14000
    (tmp_path / "g.fa").write_text(">chr1 one\n" + "\n".join(seq[k : k + 60] for k in range(0, len(seq), 60)) + "\n>chr2\nACGT\n")
    spans = [(0, "chr1", 5, 9), (1, "chr1", CHUNK - 3, CHUNK + 4), (2, "chr2", 2, 4)]
    got = {r["k"]: r["bases"] for r in fetch(read_fasta(spark, str(tmp_path / "g.fa")), spark.createDataFrame(spans, "k int, chrom string, start long, end long"), "k").collect()}
    assert got == {0: "TTGGC", 1: seq.upper()[CHUNK - 4 : CHUNK + 4], 2: "CGT"}


def test_streamed_census_equals_batch(spark, tmp_path):
    rows = [("s1", "control", "rf", "chr1", 10 + k % 3, 60, 0, f"q{k}", 1, "10M50N10M") for k in range(9)]
    df = spark.createDataFrame(rows, "sample_id string, grp string, library string, chrom string, pos long, mapq int, flag int, qname string, nh int, cigar string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    q = stream_census(spark, str(tmp_path / "in"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)).writeStream.format("memory").queryName("census").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    cols = ["sample_id", "grp", "chrom", "start", "end", "strand", "n"]
    assert sorted(map(tuple, spark.table("census").select(cols).collect())) == sorted(map(tuple, harvest.census(harvest.junction_reads(df)).select(cols).collect()))
