"""Splits, regions, headers and checks over files written here."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from test_sources import bgzf, record

from spliceframe.operators import preflight
from spliceframe.sources.bam import SOURCES, covered, regions_of
from spliceframe.sources.bgzf import EOF, Blocks, Index, bins_of, merged

REFERENCES = [("chr1", 400_000), ("chr2", 90_000), ("HLA:01", 5_000)]


def head(text, references=REFERENCES):
    return b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(references)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length) for n, length in references)


def text(so="coordinate", program="@PG\tID:STAR\tPN:STAR\n@PG\tID:samtools\tPN:samtools\n", references=REFERENCES):
    return f"@HD\tVN:1.6\tSO:{so}\n" + "".join(f"@SQ\tSN:{n}\tLN:{length}\n" for n, length in references) + program + "@CO\tnote: free\ttext\n"


def index_bytes(path, reads, first):
    """The binning index of a file, made from the offsets of its records."""
    blocks = Blocks(str(path), first)
    held, linear = [{} for _ in REFERENCES], [{} for _ in REFERENCES]
    for tid, pos, cigar in reads:
        a = blocks.offset()
        blocks.take(struct.unpack("<i", blocks.take(4))[0])
        b = blocks.offset() or (len(path.read_bytes()) << 16)
        if tid < 0:
            continue
        end = pos + covered("".join(f"{n}{o}" for n, o in cigar))
        bin_ = next((((1 << 3 * k) - 1) // 7 + (pos >> s) for k, s in ((5, 14), (4, 17), (3, 20), (2, 23), (1, 26)) if pos >> s == end - 1 >> s), 0)
        chunks = held[tid].setdefault(bin_, [])
        if chunks and chunks[-1][1] == a:
            chunks[-1] = (chunks[-1][0], b)
        else:
            chunks.append((a, b))
        for w in range(pos >> 14, (end - 1 >> 14) + 1):
            linear[tid].setdefault(w, a)
    out = b"BAI\x01" + struct.pack("<i", len(REFERENCES))
    for h, line in zip(held, linear):
        out += struct.pack("<i", len(h) + 1) + b"".join(struct.pack("<Ii", k, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for k, c in h.items())
        out += struct.pack("<Ii", 37450, 2) + struct.pack("<QQQQ", 0, 0, 0, 0)
        n = max(line, default=-1) + 1
        filled, last = [], 0
        for w in range(n):
            last = line.get(w, last)
            filled.append(last)
        out += struct.pack("<i", n) + b"".join(struct.pack("<Q", x) for x in filled)
    return out


def write(folder, name, reads, header=None, indexed=True, tail=True):
    start = head(header or text())
    body = b"".join(record(f"q{k}", 4 if tid < 0 else 0, tid, pos, 60, cigar) for k, (tid, pos, cigar) in enumerate(reads))
    first = bgzf(start, 500)
    path = folder / f"{name}.bam"
    path.write_bytes(first + bgzf(body, 300) + (EOF if tail else b""))
    if indexed:
        (folder / f"{name}.bam.bai").write_bytes(index_bytes(path, reads, len(first) << 16))
    return path


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    for s in SOURCES:
        spark.dataSource.register(s)
    r = random.Random(4)
    at = tmp_path_factory.mktemp("bam")
    reads = sorted((r.choice([0, 0, 1, 2]), 0) for _ in range(900))
    reads = sorted((t, r.randrange(REFERENCES[t][1] - 200), r.choice([[(30, "M")], [(10, "M"), (r.choice([60, 40_000]), "N"), (10, "M")], [(5, "S"), (20, "M")]])) for t, _ in reads)
    reads += [(-1, -1, [])] * 5
    write(at, "a", reads)
    write(at, "b", reads[::3])
    return at


def plain(df):
    return sorted((r["sample_id"], r["qname"], r["chrom"], r["pos"], r["cigar"]) for r in df.collect())


def test_a_file_is_read_once_by_many_tasks(spark, folder):
    whole = spark.read.format("bam").load(f"{folder}/*.bam")
    assert whole.rdd.getNumPartitions() == 2
    split = spark.read.format("bam").option("splitBytes", "2000").load(f"{folder}/*.bam")
    assert split.rdd.getNumPartitions() > 10
    assert plain(split) == plain(whole) and whole.count() == 905 + 302
    assert split.where("NOT ordered").count() == 0 and preflight.order_breaks(split).count() == 0


@pytest.mark.parametrize("regions", ["chr1:1-400000", "chr1:50000-50100,chr1:120000-200000,chr2:7-9", "HLA:01", "chr2", "chr1:399990-400000", "nowhere:1-5"])
def test_regions_equal_the_filtered_scan(spark, folder, regions):
    got = spark.read.format("bam").option("regions", regions).option("splitBytes", "3000").load(f"{folder}/*.bam")
    length = F.aggregate(F.regexp_extract_all("cigar", F.lit("([0-9]+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    wanted = F.lit(False)
    for n, lo, hi in regions_of(regions):
        wanted = wanted | ((F.col("chrom") == n) & (F.col("pos") <= hi) & (F.col("pos") + length - 1 >= lo))
    assert plain(got) == plain(spark.read.format("bam").load(f"{folder}/*.bam").where(wanted))


def test_pushed_filters_prune_and_stay_right(spark, folder):
    whole = spark.read.format("bam").load(f"{folder}/*.bam").cache()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for test in ("chrom = 'chr1' AND pos >= 100000 AND pos < 130000", "chrom IN ('chr2', 'HLA:01')", "chrom = 'chr1' AND pos > 390000", "pos = 17", "chrom = 'chr1' AND chrom = 'chr2'", "chrom = 'chr1' AND pos > 9 AND pos < 5"):
            pushed = spark.read.format("bam").option("pushFilters", "true").option("splitBytes", "1000").load(f"{folder}/*.bam").where(test)
            assert plain(pushed) == plain(whole.where(test)), test
        few = spark.read.format("bam").option("pushFilters", "true").option("splitBytes", "1000").load(f"{folder}/a.bam").where("chrom = 'HLA:01'").rdd.getNumPartitions()
        assert few < spark.read.format("bam").option("splitBytes", "1000").load(f"{folder}/a.bam").rdd.getNumPartitions() / 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_regions_need_an_index(spark, folder, tmp_path):
    write(tmp_path, "plain", [(0, 5, [(9, "M")])], indexed=False)
    with pytest.raises(Exception, match="regions need an index"):
        spark.read.format("bam").option("regions", "chr1").load(f"{tmp_path}/plain.bam").collect()
    with pytest.raises(Exception, match="none.bam"):
        spark.read.format("bam").load(f"{tmp_path}/none.bam").collect()
    assert spark.read.format("bam").load(f"{folder.as_uri()}/a.bam").count() == 905
    assert spark.read.format("bam").load(f"{folder.as_uri()}/*.bam").count() == 905 + 302


def test_index_parts():
    assert bins_of(0, 1) == [0, 1, 9, 73, 585, 4681] and len(bins_of(0, 1 << 29)) == 37449
    assert merged([(5, 9), (1, 3), (3, 4), (8, 12)]) == [(1, 4), (5, 12)]
    assert regions_of("a:1-5, HLA:01 ,b:0-2,") == [("a", 1, 5), ("HLA:01", 1, 1 << 29), ("b", 1, 2)]
    assert (covered("10M5N3I2D4S"), covered(None)) == (17, 1)
    with pytest.raises(ValueError, match="not an index"):
        Index.read(__file__)


def test_headers(spark, folder):
    rows = spark.read.format("bam_header").load(f"{folder}/a.bam").collect()
    assert [(r["tags"]["SN"], r["tags"]["LN"]) for r in rows if r["kind"] == "SQ"] == [(n, str(x)) for n, x in REFERENCES] == [(r["tags"]["SN"], r["tags"]["LN"]) for r in rows if r["kind"] == "REF"]
    assert [r["tags"].get("SO") for r in rows if r["kind"] == "HD"] == ["coordinate"]
    assert [r["text"] for r in rows if r["kind"] == "CO"] == ["@CO\tnote: free\ttext"]


def sheet_of(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, grp string, strandedness string")


GOOD = [("a", "control", "rf"), ("b", "control", "rf"), ("c", "treat", "rf"), ("d", "treat", "rf")]


@pytest.mark.parametrize(
    "rows,want",
    [
        (GOOD, []),
        ([], ["sheet_empty"]),
        (GOOD[:1], ["replicates", "samples"]),
        (GOOD + [("", "treat", "rf")], ["sample_id"]),
        (GOOD + [("a", "treat", "rf")], ["sample_repeated"]),
        (GOOD + [("e", "case", "rf"), ("f", None, "rf")], ["group"]),
        (GOOD + [("e", "treat", "xx")], ["strandedness", "strandedness_mixed"]),
        (GOOD[:3], ["replicates"]),
    ],
)
def test_sheet(spark, rows, want):
    assert sorted(r["check"] for r in preflight.sheet_checks(sheet_of(spark, rows)).collect()) == want


def test_files_headers_and_reads(spark, folder, tmp_path):
    names = [n for n, _ in REFERENCES]
    good = [(0, 5, [(9, "M")]), (0, 9, [(9, "M")]), (1, 2, [(9, "M")])]
    for s in "ab":
        write(tmp_path, s, good)
    models = spark.createDataFrame([(n,) for n in names], "chrom string")
    lengths = spark.createDataFrame(REFERENCES, "chrom string, length long")
    sheet = sheet_of(spark, GOOD)

    def failed(pattern="*.bam", lengths=lengths, models=models, layout="auto", paths=None):
        load = lambda kind: spark.read.format(kind).load(f"{tmp_path}/{pattern}")
        probe = spark.read.format("bam_probe").load(paths or f"{tmp_path}/{pattern}")
        return preflight.preflight(sheet, probe, load("bam_header"), load("bam"), lengths, models, layout)

    checks = lambda *a, **k: sorted({(r["check"], r["sample_id"]) for r in failed(*a, **k).collect()}, key=str)
    assert checks() == [] and preflight.first_failure(failed()) is None
    preflight.require(failed())
    assert checks(layout="paired") == [("layout", "a"), ("layout", "b")]
    assert checks(paths=f"{tmp_path}/*.bam,{tmp_path}/zz.bam") == [("missing", "zz")]
    assert checks(lengths=lengths.where("chrom <> 'chr2'")) == [("contig_unknown", "a"), ("contig_unknown", "b")]
    assert checks(lengths=lengths.withColumn("length", F.col("length") + 1)) == [("contig_length", "a"), ("contig_length", "b")]
    assert checks(models=spark.createDataFrame([("1",), ("2",)], "chrom string")) == [("chr_prefix", None)]
    assert checks(models=spark.createDataFrame([("chr1",), ("zz",)], "chrom string")) == [("contig_without_reads", None)]
    assert checks(models=models.where("false")) == [("annotation_empty", None)]
    write(tmp_path, "c", good, indexed=False, tail=False)
    write(tmp_path, "d", good[::-1], text("unsorted"), indexed=False)
    write(tmp_path, "e", good, text(program="@PG\tID:bowtie2\tPN:bowtie2\n"))
    write(tmp_path, "f", good, text(program=""))
    write(tmp_path, "g", good, text(program="@PG\tID:hisat2\tPN:hisat2\n"))
    write(tmp_path, "h", good, text(references=REFERENCES[:2]))
    want = [("truncated", "c"), ("no_index", "c"), ("no_index", "d"), ("unsorted", "d"), ("aligner_forbidden", "e"), ("aligner", "f"), ("aligners_mixed", None), ("references_differ", "h")]
    assert checks() == sorted(want, key=str)
    assert preflight.first_failure(failed()).startswith("c: truncated:")
    with pytest.raises(ValueError, match="c: truncated"):
        preflight.require(failed())


def test_order_over_split_borders(spark):
    rows = [("s", 0, k, 0, 10 + k, True) for k in range(3)] + [("s", 1, 0, 0, 5, True), ("s", 1, 1, -1, 0, True), ("t", 0, 0, 0, 9, True), ("t", 0, 1, 0, 2, False), ("u", 0, 0, 1, 1, True), ("u", 1, 0, -1, 0, True)]
    got = preflight.order_breaks(spark.createDataFrame(rows, "sample_id string, split int, row long, tid int, pos long, ordered boolean")).collect()
    assert sorted(map(tuple, got)) == [("s", 1, 0, True), ("t", 0, 1, False)]


def test_layouts_and_duplicates(spark):
    rows = [("p", 3)] * 99 + [("p", 0)] + [("m", 3)] * 9 + [("m", 0)] + [("s", 1024)] + [("s", 0)] + [("s", 260), ("s", 3 | 2048)]
    reads = spark.createDataFrame(rows, "sample_id string, flag int")
    assert sorted((r["sample_id"], r["layout"], r["mixed"], r["duplicates_seen"]) for r in preflight.layouts(reads).collect()) == [("m", "paired", True, False), ("p", "paired", False, False), ("s", "single", False, True)]
    assert sorted((r["check"], r["sample_id"]) for r in preflight.layout_checks(reads.where("sample_id <> 's'"), "single").collect()) == [("layout", "m"), ("layout", "p"), ("layout_mixed", "m")]
    skipped = lambda p: {(r["sample_id"], r["skip_duplicates"]) for r in preflight.duplicate_policy(reads, p).collect()}
    assert skipped("auto") == {("p", False), ("m", False), ("s", True)} and skipped("never") == {(s, False) for s in "pms"}
    for call in (lambda: preflight.layout_checks(reads, "x"), lambda: preflight.duplicate_policy(reads, "x")):
        with pytest.raises(ValueError, match="must be"):
            call()
