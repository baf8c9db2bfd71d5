"""Queries over reads, intervals, coverage and the harvest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R
from ..operators import coverage, harvest, preflight, residual
from ..operators.intervals import clip, gap, nearest, nearest_stranded, overlap_join
from .bridge import ctes, view
from .catalog import query

PASS = "(flag & 2820) = 0 AND mapq >= 10 AND (flag & 1024) = 0"
STRAND = """CASE library WHEN 'rf' THEN CASE WHEN ((flag & 1) <> 0 AND (flag & 128) <> 0) = ((flag & 16) = 0) THEN '+' ELSE '-' END
 WHEN 'fr' THEN CASE WHEN ((flag & 1) = 0 OR (flag & 64) <> 0) = ((flag & 16) = 0) THEN '+' ELSE '-' END END"""
#: Operations of each CIGAR with their places.
OPS = """z AS (SELECT *, row_number() OVER () AS rid FROM aln),
o AS (SELECT *, unnest(regexp_extract_all(cigar, '[0-9]+[MIDNSHPX=]')) AS t, generate_subscripts(regexp_extract_all(cigar, '[0-9]+[MIDNSHPX=]'), 1) AS k FROM z),
c AS (SELECT *, right(t, 1) AS op, CAST(regexp_extract(t, '[0-9]+') AS BIGINT) AS n FROM o),
p AS (SELECT *, pos + coalesce(sum(CASE WHEN op IN ('M', '=', 'X', 'D', 'N') THEN n ELSE 0 END) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM c)"""
JUNCTIONS = f"""{OPS},
i AS (SELECT DISTINCT rid, sample_id, grp, qname, chrom, flag, coalesce({STRAND}, '.') AS strand, CAST(s AS BIGINT) AS "start", CAST(s + n - 1 AS BIGINT) AS "end" FROM p WHERE op = 'N' AND n > 0 AND {PASS}),
full_ AS (SELECT sample_id, qname FROM aln WHERE {PASS} AND (flag & 3) = 3 GROUP BY ALL HAVING count(*) = 2),
j AS (SELECT sample_id, grp, chrom, strand, "start", "end" FROM i WHERE (flag & 1) = 0
 UNION ALL SELECT sample_id, grp, chrom, strand, "start", "end" FROM (SELECT DISTINCT sample_id, grp, qname, chrom, strand, "start", "end" FROM i JOIN full_ USING (sample_id, qname) WHERE (flag & 3) = 3)),
census AS (SELECT sample_id, grp, chrom, "start", "end", strand, count(*) AS n FROM j GROUP BY ALL)"""
RECUR = JUNCTIONS + """,
r AS (SELECT chrom, "start", "end", strand, CAST(sum(n) AS BIGINT) AS support_sum, count(*) AS n_detected, coalesce(max(n) FILTER (grp = 'control'), 0) AS control_max, count(*) FILTER (grp = 'control') AS control_n,
 CAST(coalesce(sum(n) FILTER (grp = 'treat'), 0) AS BIGINT) AS treat_sum, count(*) FILTER (grp = 'treat') AS treat_n FROM census GROUP BY ALL HAVING count(*) >= 2 AND sum(n) >= 2),
rec AS (SELECT *, CASE WHEN NOT EXISTS (SELECT 1 FROM aln WHERE grp = 'control') THEN 'cohort' WHEN control_max <= 0 THEN 'silent' ELSE 'shared' END AS cohort FROM r)"""


@query("scan_filter_reads", ctes("aln") + f" SELECT sample_id, count(*) AS n_pass, count(*) FILTER (coalesce(nh, 0) = 1) AS n_unique, CAST(sum(pos) AS BIGINT) AS pos_sum FROM aln WHERE {PASS} GROUP BY sample_id")
def scan_filter_reads(spark: SparkSession, d: str) -> DataFrame:
    aln = view(spark, d, "aln").where(R.passes(F.col("flag"), F.col("mapq")))
    return aln.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_pass"), F.count_if(F.coalesce("nh", F.lit(0)) == 1).alias("n_unique"), F.sum("pos").alias("pos_sum"))


@query("fragment_pairing", ctes("aln") + f" SELECT sample_id, qname, CAST(min(pos) AS BIGINT) AS first_pos, CAST(max(pos) AS BIGINT) AS last_pos FROM aln WHERE {PASS} AND (flag & 3) = 3 GROUP BY ALL HAVING count(*) = 2")
def fragment_pairing(spark: SparkSession, d: str) -> DataFrame:
    aln = view(spark, d, "aln").where(R.passes(F.col("flag"), F.col("mapq")) & ((F.col("flag").bitwiseAND(3)) == 3))
    return aln.groupBy("sample_id", "qname").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("_n")).where("_n = 2").drop("_n")


@query("inferred_strand", ctes("aln") + f" SELECT library, flag, {STRAND} AS strand, count(*) AS n FROM aln GROUP BY ALL")
def inferred_strand(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "aln").withColumn("strand", R.inferred_strand(F.col("flag"), F.col("library"))).groupBy("library", "flag", "strand").agg(F.count(F.lit(1)).alias("n"))


@query("strand_compat", ctes("aln") + f", s AS (SELECT {STRAND} AS r, strand AS l FROM aln) SELECT l AS locus_strand, count(*) FILTER (r IS NULL OR r = l OR l = '.') AS n_compatible FROM s GROUP BY l")
def strand_compat(spark: SparkSession, d: str) -> DataFrame:
    ok = R.strand_compatible(R.inferred_strand(F.col("flag"), F.col("library")), F.col("strand"))
    return view(spark, d, "aln").groupBy(F.col("strand").alias("locus_strand")).agg(F.count_if(ok).alias("n_compatible"))


@query("cigar_blocks", ctes("aln") + f", {OPS} SELECT read_id, CAST(s AS BIGINT) AS block_start, CAST(s + n - 1 AS BIGINT) AS block_end FROM p WHERE op IN ('M', '=', 'X')")
def cigar_blocks(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "aln", costly=True).select("read_id", F.inline(R.aligned_blocks(F.col("pos"), F.col("cigar"))).alias("block_start", "block_end"))


@query("cigar_introns", ctes("aln") + f", {OPS} SELECT read_id, intron_start, intron_end FROM (SELECT DISTINCT rid, read_id, CAST(s AS BIGINT) AS intron_start, CAST(s + n - 1 AS BIGINT) AS intron_end FROM p WHERE op = 'N' AND n > 0)")
def cigar_introns(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "aln", costly=True).select("read_id", F.inline(R.introns(F.col("pos"), F.col("cigar"))).alias("intron_start", "intron_end"))


@query("junction_census", ctes("aln") + ", " + JUNCTIONS + " SELECT * FROM census")
def junction_census(spark: SparkSession, d: str) -> DataFrame:
    return harvest.census(harvest.junction_reads(view(spark, d, "aln", costly=True)))


@query("cohort_recurrence", ctes("aln") + ", " + RECUR + " SELECT * FROM rec")
def cohort_recurrence(spark: SparkSession, d: str) -> DataFrame:
    return harvest.recurrence(junction_census(spark, d))


KNOWN = """known AS (SELECT DISTINCT concat('chr', l_partkey % 5 + 1) AS chrom, l_partkey * 40 + 100 AS ks, l_partkey * 40 + 140 + (l_partkey % 9) * 20 AS ke, CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS kst FROM lineitem WHERE l_partkey % 3 = 0)"""


@query("known_intron_anti", ctes("aln") + ", " + RECUR + ", " + KNOWN + """ SELECT * FROM rec WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.chrom = rec.chrom AND ks = "start" AND ke = "end" AND (kst = strand OR strand = '.'))""")
def known_intron_anti(spark: SparkSession, d: str) -> DataFrame:
    known = view(spark, d, "aln").where("(j_start - 100) div 40 % 3 = 0").select("chrom", F.col("j_start").alias("start"), F.col("j_end").alias("end"), F.expr("CASE WHEN (j_start - 100) div 40 % 2 = 0 THEN '+' ELSE '-' END").alias("strand"))
    return harvest.without_known(cohort_recurrence(spark, d), known)


@query("select_junctions", ctes("aln", "genes") + ", " + RECUR + """ SELECT * FROM rec WHERE "end" - "start" + 1 >= 50 AND NOT EXISTS (SELECT 1 FROM genes g WHERE g.chrom = rec.chrom AND g."start" <= rec."end" AND rec."start" <= g."end")""")
def select_junctions(spark: SparkSession, d: str) -> DataFrame:
    return harvest.select_junctions(cohort_recurrence(spark, d), view(spark, d, "genes").select("chrom", "start", "end"))


def _nearest_sql(locus: str, same: str = "") -> str:
    match = same or "true"
    return f""" SELECT l.*, n.gene_id AS nearest_id, CAST(n.dist AS BIGINT) AS distance FROM {locus} l LEFT JOIN (SELECT l.locus_id, g.gene_id, greatest(0, g."start" - l."end" - 1, l."start" - g."end" - 1) AS dist,
 row_number() OVER (PARTITION BY l.locus_id ORDER BY greatest(0, g."start" - l."end" - 1, l."start" - g."end" - 1), g.gene_id) AS k FROM {locus} l JOIN genes g ON g.chrom = l.chrom AND {match}) n ON n.locus_id = l.locus_id AND n.k = 1"""


@query("nearest_same_strand", ctes("loci", "genes") + _nearest_sql("loci", "(l.strand = '.' OR g.strand = l.strand)"))
def nearest_same_strand(spark: SparkSession, d: str) -> DataFrame:
    return nearest_stranded(view(spark, d, "loci"), view(spark, d, "genes"))


@query("nearest_structure", ctes("loci", "genes") + _nearest_sql("loci", "(l.strand = '.' OR g.strand = '.' OR g.strand = l.strand)"))
def nearest_structure(spark: SparkSession, d: str) -> DataFrame:
    return nearest_stranded(view(spark, d, "loci"), view(spark, d, "genes"), wild_bodies=True)


@query("nearest_any_strand", ctes("loci", "genes") + _nearest_sql("loci"))
def nearest_any_strand(spark: SparkSession, d: str) -> DataFrame:
    return nearest(view(spark, d, "loci"), view(spark, d, "genes"))


@query("interval_overlap_join", ctes("aln", "genes") + """ SELECT read_id, gene_id, CAST(least(j_end, "end") - greatest(j_start, "start") + 1 AS BIGINT) AS bases FROM aln JOIN genes USING (chrom) WHERE j_start <= "end" AND "start" <= j_end""")
def interval_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    reads = view(spark, d, "aln").select("read_id", "chrom", F.col("j_start").alias("start"), F.col("j_end").alias("end"))
    pairs = overlap_join(reads, view(spark, d, "genes").select("chrom", "start", "end", "gene_id"))
    return pairs.select("read_id", F.col("r_gene_id").alias("gene_id"), (F.least("end", "r_end") - F.greatest("start", "r_start") + 1).alias("bases"))


@query("interval_gap", ctes("loci", "genes") + """ SELECT locus_id, gene_id, CAST(CASE WHEN l."start" <= g."end" AND g."start" <= l."end" THEN 0 WHEN g."start" > l."end" THEN g."start" - l."end" - 1 ELSE l."start" - g."end" - 1 END AS BIGINT) AS gap FROM loci l JOIN genes g USING (chrom) WHERE l."start" - 2000 <= g."end" AND g."start" <= l."end" + 2000""")
def interval_gap(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap_join(view(spark, d, "loci"), view(spark, d, "genes").select("chrom", "start", "end", "gene_id"), pad=2000)
    return pairs.select("locus_id", F.col("r_gene_id").alias("gene_id"), gap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end")).alias("gap"))


_OVER = """ (SELECT 1 FROM genes g WHERE g.chrom = l.chrom AND g."start" <= l."end" + {pad} AND l."start" - {pad} <= g."end"{more})"""


@query("overlap_semi", ctes("loci", "genes") + " SELECT l.* FROM loci l WHERE EXISTS" + _OVER.format(pad=0, more=""))
def overlap_semi(spark: SparkSession, d: str) -> DataFrame:
    return overlap_join(view(spark, d, "loci"), view(spark, d, "genes"), how="semi")


@query("overlap_anti", ctes("loci", "genes") + " SELECT l.* FROM loci l WHERE NOT EXISTS" + _OVER.format(pad=0, more=""))
def overlap_anti(spark: SparkSession, d: str) -> DataFrame:
    return overlap_join(view(spark, d, "loci"), view(spark, d, "genes"), how="anti")


@query("within_distance_semi", ctes("loci", "genes") + " SELECT l.* FROM loci l WHERE EXISTS" + _OVER.format(pad=200, more=" AND biotype = 'snRNA'"))
def within_distance_semi(spark: SparkSession, d: str) -> DataFrame:
    # fewer than 200 bases between is at most 199, so intervals meet when padded by 200
    return overlap_join(view(spark, d, "loci"), view(spark, d, "genes").where("biotype = 'snRNA'"), how="semi", pad=200)


@query("clip_intervals", ctes("loci") + """ SELECT locus_id, least(greatest(1, "start" - 300), n) AS "start", least(n, "end" + 300) AS "end" FROM loci JOIN (SELECT chrom, max("end") AS n FROM loci GROUP BY chrom) USING (chrom)""")
def clip_intervals(spark: SparkSession, d: str) -> DataFrame:
    # the tables name no contig lengths, so a contig ends with its last locus
    loci = view(spark, d, "loci")
    wide = loci.select("locus_id", "chrom", (F.col("start") - 300).alias("start"), (F.col("end") + 300).alias("end"))
    return clip(wide, loci.groupBy("chrom").agg(F.max("end").alias("length"))).drop("chrom")


@query("union_length", ctes("genes") + """, m AS (SELECT chrom, "start", "end", max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM genes)
 SELECT chrom, CAST(sum(greatest(0, "end" - greatest("start", coalesce(ahead + 1, "start")) + 1)) AS BIGINT) AS union_length FROM m GROUP BY chrom""")
def union_length(spark: SparkSession, d: str) -> DataFrame:
    return coverage.union_length(view(spark, d, "genes"), "chrom")


_DEPTH = """, e AS (SELECT chrom, "start" AS x, 1 AS d FROM loci UNION ALL SELECT chrom, "end" + 1, -1 FROM loci), n AS (SELECT chrom, x AS "start", sum(d) AS d FROM e GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT chrom, "start", CAST(lead("start") OVER w - 1 AS BIGINT) AS "end", CAST(sum(d) OVER w AS BIGINT) AS depth FROM n WINDOW w AS (PARTITION BY chrom ORDER BY "start"))"""


@query("depth_rle", ctes("loci") + _DEPTH + " SELECT * FROM runs WHERE depth > 0")
def depth_rle(spark: SparkSession, d: str) -> DataFrame:
    return coverage.depth_runs(view(spark, d, "loci"), "chrom")


@query("mean_depth", ctes("loci", "genes") + _DEPTH + """ SELECT gene_id, round(CAST(coalesce(sum(depth * (least(g."end", r."end") - greatest(g."start", r."start") + 1)) FILTER (r.chrom IS NOT NULL), 0) AS DOUBLE) / any_value(g."end" - g."start" + 1), 6) AS mean_depth
 FROM genes g LEFT JOIN runs r ON r.depth > 0 AND r.chrom = g.chrom AND r."start" <= g."end" AND g."start" <= r."end" GROUP BY gene_id""")
def mean_depth(spark: SparkSession, d: str) -> DataFrame:
    genes = view(spark, d, "genes").select("gene_id", "chrom", "start", "end")
    hit = overlap_join(genes, depth_rle(spark, d)).groupBy("gene_id").agg(F.sum(F.col("r_depth") * (F.least("end", "r_end") - F.greatest("start", "r_start") + 1)).alias("bases"))
    return genes.join(hit, "gene_id", "left").select("gene_id", F.round(F.coalesce("bases", F.lit(0)).cast("double") / (F.col("end") - F.col("start") + 1), 6).alias("mean_depth"))


@query("valley_min", ctes("loci", "genes") + _DEPTH + """, w AS (SELECT gene_id, chrom, unnest(range("start", "end" - 200 + 2, 50)) AS s FROM genes WHERE "end" - "start" + 1 >= 200),
 m AS (SELECT gene_id, s, CAST(coalesce(sum(depth * (least(s + 199, r."end") - greatest(s, r."start") + 1)) FILTER (r.chrom IS NOT NULL), 0) AS DOUBLE) / 200 AS v FROM w LEFT JOIN runs r ON r.depth > 0 AND r.chrom = w.chrom AND r."start" <= s + 199 AND s <= r."end" GROUP BY ALL)
 SELECT gene_id, "end" - "start" + 1 >= 200 AS possible, round(min(v), 6) AS valley FROM genes LEFT JOIN m USING (gene_id) GROUP BY ALL""")
def valley_min(spark: SparkSession, d: str) -> DataFrame:
    genes = view(spark, d, "genes").select("gene_id", "chrom", "start", "end")
    windows = genes.select("gene_id", "chrom", F.explode(coverage.window_starts(F.col("start"), F.col("end"), 200, 50)).alias("start")).withColumn("end", F.col("start") + 199)
    bases = overlap_join(windows, depth_rle(spark, d)).groupBy("gene_id", "start").agg(F.sum(F.col("r_depth") * (F.least("end", "r_end") - F.greatest("start", "r_start") + 1)).alias("b"))
    means = windows.join(bases, ["gene_id", "start"], "left").groupBy("gene_id").agg(F.round(F.min(F.coalesce("b", F.lit(0)).cast("double") / 200), 6).alias("valley"))
    return genes.join(means, "gene_id", "left").select("gene_id", (F.col("end") - F.col("start") + 1 >= 200).alias("possible"), "valley")


@query("terminal_walk", ctes("loci", "genes") + """, c AS (SELECT gene_id, greatest(l."start" - g."end", 1) AS a, least(l."end" - g."end", 2000) AS b FROM genes g JOIN loci l USING (chrom) WHERE l."end" - g."end" >= 1 AND l."start" - g."end" <= 2000),
 h AS (SELECT *, CASE WHEN a - coalesce(max(b) OVER (PARTITION BY gene_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1 > 20 THEN 1 ELSE 0 END AS hole FROM c),
 k AS (SELECT *, sum(hole) OVER (PARTITION BY gene_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS holes FROM h) SELECT gene_id, CAST(max(CASE WHEN holes = 0 THEN b ELSE 0 END) AS BIGINT) AS reach FROM k GROUP BY gene_id""")
def terminal_walk(spark: SparkSession, d: str) -> DataFrame:
    ahead = view(spark, d, "genes").select("gene_id", "chrom", (F.col("end") + 1).alias("start"), (F.col("end") + 2000).alias("end"))
    runs = overlap_join(ahead, view(spark, d, "loci").select("chrom", "start", "end")).select("gene_id", (F.col("r_start") - F.col("start") + 1).alias("a"), (F.col("r_end") - F.col("start") + 1).alias("b"))
    return coverage.walk_end(runs, "gene_id", 20, 2000)


_EDGES = """, e AS (SELECT a.node AS u, b.node AS v FROM nodes a JOIN nodes b ON a.chrom = b.chrom AND a.strand = b.strand AND a.node < b.node AND ((a."start" <= b."end" AND b."start" <= a."end")
 OR greatest(b."start" - a."end" - 1, a."start" - b."end" - 1) BETWEEN 30 AND 2000)),
 twice AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
 reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT r.node, b.v FROM reach r JOIN twice b ON r.other = b.u),
 comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return harvest.components(view(spark, d, "nodes"), max_exon=2000)


@query("cluster_components", ctes("nodes") + _EDGES + " SELECT nodes.*, component FROM nodes JOIN comp USING (node)")
def cluster_components(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d)


_RECORD = """, rec AS (SELECT component, any_value(chrom) AS chrom, any_value(strand) AS strand, min("start") AS "start", max("end") AS "end", count(*) AS n_junctions, CAST(sum(support) AS BIGINT) AS support_sum,
 CAST(max(n_detected) AS BIGINT) AS n_detected, max(control_max) AS control_max, CASE WHEN max(control_max) > 0 THEN 'shared' ELSE 'silent' END AS cohort FROM nodes JOIN comp USING (node) GROUP BY component)"""


@query("cluster_aggregate", ctes("nodes") + _EDGES + _RECORD + " SELECT * FROM rec")
def cluster_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return harvest.cluster_record(_clusters(spark, d))


@query("residual_rank", ctes("nodes") + _EDGES + _RECORD + """ SELECT *, row_number() OVER o AS rank, concat('RSDL.', row_number() OVER o) AS residual_id FROM rec WINDOW o AS (ORDER BY n_junctions DESC, support_sum DESC, n_detected DESC, chrom, "start", "end", strand, component)""")
def residual_rank(spark: SparkSession, d: str) -> DataFrame:
    return harvest.number_residuals(cluster_aggregate(spark, d))


@query("shared_site_count", ctes("nodes") + _EDGES + """, s AS (SELECT component, 's' AS side, "start" AS x FROM nodes JOIN comp USING (node) UNION ALL SELECT component, 'e', "end" FROM nodes JOIN comp USING (node))
 SELECT component, count(*) FILTER (n > 1) AS n_shared_site FROM (SELECT component, side, x, count(*) AS n FROM s GROUP BY ALL) GROUP BY component""")
def shared_site_count(spark: SparkSession, d: str) -> DataFrame:
    return harvest.shared_sites(_clusters(spark, d))


_CHAIN = """, r AS (SELECT component, "start" AS s, "end" AS e, row_number() OVER (PARTITION BY component ORDER BY support DESC, "start", "end") AS k FROM nodes JOIN comp USING (node)),
g(component, k, kept) AS (SELECT component, k, [{'s': s, 'e': e}] FROM r WHERE k = 1
 UNION ALL SELECT g.component, r.k, CASE WHEN len(list_filter(g.kept, lambda y: r.s <= y.e AND y.s <= r.e)) = 0 THEN list_append(g.kept, {'s': r.s, 'e': r.e}) ELSE g.kept END FROM g JOIN r ON r.component = g.component AND r.k = g.k + 1)"""


@query("greedy_chain", ctes("nodes") + _EDGES + _CHAIN + " SELECT component, array_to_string(list_transform(list_sort(kept), lambda y: concat(y.s, '-', y.e)), ',') AS chain FROM (SELECT component, arg_max(kept, k) AS kept FROM g GROUP BY component)")
def greedy_chain(spark: SparkSession, d: str) -> DataFrame:
    grouped = _clusters(spark, d).groupBy("component").agg(F.collect_list(F.struct("start", "end", "support")).alias("m"))
    return grouped.select("component", F.array_join(F.transform(harvest.greedy_chain(F.col("m")), lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("chain"))


@query("residual_build")
def residual_build(spark: SparkSession, d: str) -> DataFrame:
    # nodes have no recurrence of their own but support, samples and controls
    junctions = view(spark, d, "nodes").withColumnRenamed("support", "support_sum")
    loci = view(spark, d, "loci")
    lengths = junctions.select("chrom", F.col("end").alias("length")).unionByName(loci.select("chrom", F.col("end").alias("length"))).groupBy("chrom").agg(F.max("length").alias("length"))
    return residual.build(junctions, view(spark, d, "genes"), lengths, loci.select("chrom", "start", "end", F.when(F.col("strand") != ".", F.col("strand")).alias("strand")), max_exon=2000)


@query("preflight_layout", ctes("aln") + """, n AS (SELECT sample_id, count(*) FILTER (flag % 2 = 1) AS n_paired, count(*) FILTER (flag % 2 = 0) AS n_single, count(*) FILTER (flag // 1024 % 2 = 1) > 0 AS duplicates_seen FROM aln WHERE flag // 4 % 2 = 0 AND flag // 256 % 2 = 0 AND flag // 2048 % 2 = 0 GROUP BY sample_id)
 SELECT *, n_paired > 0.01 * (n_paired + n_single) AND n_single > 0.01 * (n_paired + n_single) AS mixed, CASE WHEN n_paired >= n_single THEN 'paired' ELSE 'single' END AS layout FROM n""")
def preflight_layout(spark: SparkSession, d: str) -> DataFrame:
    return preflight.layouts(view(spark, d, "aln"))


@query("interval_reach", ctes("repeats") + """ SELECT chrom, "start", max("end") OVER (PARTITION BY chrom ORDER BY "start") AS reach FROM (SELECT chrom, "start", max("end") AS "end" FROM repeats GROUP BY ALL)""")
def interval_reach(spark: SparkSession, d: str) -> DataFrame:
    return coverage.reach(view(spark, d, "repeats"), "chrom")
