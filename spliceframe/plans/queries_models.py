"""Queries over gene models, counts and structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..operators import coverage, evidence, expression, models, quantify
from ..operators.intervals import overlap_join
from .bridge import ctes, view
from .catalog import query

#: Genes split into equal blocks with exons of two thirds of each.
EXONS = """exons AS (SELECT gene_id, chrom, strand, gene_id AS transcript_id, "start" + k * w AS "start", "start" + k * w + w * 2 // 3 AS "end" FROM (SELECT *, unnest(range(0, n_exons)) AS k, ("end" - "start" + 1) // n_exons AS w FROM genes))"""


def exons(spark: SparkSession, d: str) -> DataFrame:
    g = view(spark, d, "genes").withColumn("w", F.expr("(`end` - start + 1) div n_exons")).withColumn("k", F.explode(F.expr("sequence(0L, n_exons - 1)")))
    return g.select("gene_id", "chrom", "strand", F.col("gene_id").alias("transcript_id"), F.expr("start + k * w").alias("start"), F.expr("start + k * w + w * 2 div 3").alias("end"))


@query("exon_to_intron", ctes("genes") + ", " + EXONS + """, i AS (SELECT gene_id, "end" + 1 AS s, lead("start") OVER (PARTITION BY gene_id ORDER BY "start") - 1 AS e FROM exons) SELECT gene_id, CAST(s AS BIGINT) AS intron_start, CAST(e AS BIGINT) AS intron_end FROM i WHERE e >= s""")
def exon_to_intron(spark: SparkSession, d: str) -> DataFrame:
    chains = exons(spark, d).groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("x"))
    pairs = F.zip_with(F.expr("slice(x, 1, size(x) - 1)"), F.expr("slice(x, 2, size(x))"), lambda a, b: F.struct((a["end"] + 1).alias("s"), (b["start"] - 1).alias("e")))
    return chains.where("size(x) > 1").select("gene_id", F.inline(F.filter(pairs, lambda x: x["e"] >= x["s"])).alias("intron_start", "intron_end"))


FEATURES = """f AS (SELECT gene_id, chrom, strand, CASE WHEN suppressed THEN 'note' ELSE 'gene' END AS feature, "start", "end" FROM (SELECT *, CAST(substr(gene_id, 2) AS BIGINT) % 3 = 0 AS suppressed FROM genes) UNION ALL SELECT gene_id, chrom, strand, 'exon', "start", "end" FROM exons)"""


def features(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.expr("CAST(substr(gene_id, 2) AS BIGINT) % 3 = 0"), "note").otherwise("gene")
    return view(spark, d, "genes").select("gene_id", "chrom", "strand", kind.alias("feature"), "start", "end").unionByName(exons(spark, d).drop("transcript_id").withColumn("feature", F.lit("exon")))


@query("gene_body_fallback", ctes("genes") + ", " + EXONS + ", " + FEATURES + """ SELECT chrom, gene_id, coalesce(min("start") FILTER (feature = 'gene'), min("start") FILTER (feature = 'exon')) AS "start", coalesce(max("end") FILTER (feature = 'gene'), max("end") FILTER (feature = 'exon')) AS "end", any_value(strand) AS strand, count(*) FILTER (feature = 'gene') = 0 AS derived FROM f GROUP BY chrom, gene_id""")
def gene_body_fallback(spark: SparkSession, d: str) -> DataFrame:
    return models.gene_bodies(features(spark, d))


@query("feature_filter", ctes("genes") + ", " + EXONS + ", " + FEATURES + " SELECT * FROM f WHERE feature IN ('gene', 'transcript', 'exon')")
def feature_filter(spark: SparkSession, d: str) -> DataFrame:
    return features(spark, d).where(F.col("feature").isin("gene", "transcript", "exon"))


@query("gtf_attr_parse", ctes("genes") + """ SELECT gene_id, gene_name, biotype FROM genes""")
def gtf_attr_parse(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.gtf import attribute

    text = F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('"; gene_name "'), F.col("gene_name"), F.lit('"; gene_biotype '), F.col("biotype"), F.lit(";"))
    rows = view(spark, d, "genes").select(text.alias("attributes"))
    return rows.select(attribute(F.col("attributes"), "gene_id").alias("gene_id"), attribute(F.col("attributes"), "gene_name").alias("gene_name"), attribute(F.col("attributes"), "gene_biotype").alias("biotype"))


@query("universe_union", ctes("genes", "loci") + """ SELECT gene_id, chrom, "start", "end", strand, 'model' AS origin FROM genes UNION ALL SELECT concat('RSDL.', locus_id), chrom, "start", "end", strand, 'residual' FROM loci""")
def universe_union(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "genes").select("gene_id", "chrom", "start", "end", "strand", F.lit("model").alias("origin"))
    r = view(spark, d, "loci").select(F.concat(F.lit("RSDL."), "locus_id").alias("gene_id"), "chrom", "start", "end", "strand", F.lit("residual").alias("origin"))
    return models.universe(m, r)


_CLASS = EXONS + """, q AS (SELECT locus_id AS t, chrom, strand, "start", "start" + ("end" - "start") // 2 AS "end", "start" AS ts, "end" AS te FROM loci),
 span AS (SELECT gene_id, min("start") AS rs, max("end") AS re FROM exons GROUP BY gene_id),
 e AS (SELECT t, x.gene_id, q.strand = '.' OR x.strand = '.' OR q.strand = x.strand AS same, least(q."end", x."end") - greatest(q."start", x."start") + 1 AS bases FROM q JOIN exons x ON q.chrom = x.chrom AND q."start" <= x."end" AND x."start" <= q."end"),
 g AS (SELECT t, gene_id, bool_or(same) AS same, sum(bases) FILTER (same) AS bases FROM e GROUP BY ALL),
 best AS (SELECT t, rs, re FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY bases DESC, gene_id) AS k FROM g WHERE same) JOIN span USING (gene_id) WHERE k = 1),
 a AS (SELECT t, bool_or(same) AS same_exon FROM g GROUP BY t), b AS (SELECT t, bool_or(q.strand = '.' OR x.strand = '.' OR q.strand = x.strand) AS same_body FROM q JOIN genes x ON q.chrom = x.chrom AND q."start" <= x."end" AND x."start" <= q."end" GROUP BY t),
 cls AS (SELECT t AS transcript_id, CASE WHEN same_exon IS NULL AND same_body IS NULL THEN 'u' WHEN same_exon THEN CASE WHEN ts < rs OR te > re THEN 'extension' ELSE 'overlap' END WHEN same_exon IS NOT NULL THEN 'x' WHEN same_body THEN 'i' ELSE 'x' END AS class FROM q LEFT JOIN a USING (t) LEFT JOIN b USING (t) LEFT JOIN best USING (t))"""


@query("class_code", ctes("loci", "genes") + ", " + _CLASS + " SELECT * FROM cls")
def class_code(spark: SparkSession, d: str) -> DataFrame:
    q = view(spark, d, "loci").select(F.col("locus_id").alias("transcript_id"), "chrom", "strand", "start", F.expr("start + (`end` - start) div 2").alias("end"), F.col("start").alias("tx_start"), F.col("end").alias("tx_end"))
    x = exons(spark, d)
    span = x.groupBy("gene_id").agg(F.min("start").alias("ref_start"), F.max("end").alias("ref_end"))
    ref = x.join(span, "gene_id").select(F.col("gene_id").alias("ref_id"), "chrom", "strand", "start", "end", "ref_start", "ref_end")
    return models.class_codes(q, ref, view(spark, d, "genes").select("chrom", "strand", "start", "end"))


_ISO = """, iso AS (SELECT transcript_id, class, concat('H', CAST(substr(transcript_id, 2) AS BIGINT) // 3) AS locus_id, CAST(substr(transcript_id, 2) AS BIGINT) * 7 % 50 AS length_nt FROM cls)"""


def _isoforms(spark: SparkSession, d: str) -> DataFrame:
    n = F.expr("CAST(substr(transcript_id, 2) AS BIGINT)")
    return class_code(spark, d).select("transcript_id", "class", F.concat(F.lit("H"), F.expr("CAST(substr(transcript_id, 2) AS BIGINT) div 3").cast("string")).alias("locus_id"), (n * 7 % 50).alias("length_nt"))


@query("locus_class", ctes("loci", "genes") + ", " + _CLASS + _ISO + " SELECT locus_id, arg_max(class, CASE class WHEN 'overlap' THEN 4 WHEN 'extension' THEN 3 WHEN 'x' THEN 2 WHEN 'i' THEN 1 ELSE 0 END) AS locus_class, count(*) AS n_isoforms, bool_and(class = 'u') AS all_u FROM iso GROUP BY locus_id")
def locus_class(spark: SparkSession, d: str) -> DataFrame:
    return models.locus_classes(_isoforms(spark, d))


@query("representative_pick", ctes("loci", "genes") + ", " + _CLASS + _ISO + " SELECT locus_id, transcript_id FROM (SELECT *, row_number() OVER (PARTITION BY locus_id ORDER BY length_nt DESC, transcript_id) AS k, bool_and(class = 'u') OVER (PARTITION BY locus_id) AS u FROM iso) WHERE k = 1 AND u")
def representative_pick(spark: SparkSession, d: str) -> DataFrame:
    return models.representatives(_isoforms(spark, d))


@query("naming_priority", ctes("loci", "genes") + """, p AS (SELECT locus_id, g.gene_id, row_number() OVER (PARTITION BY locus_id ORDER BY k, g."start", g.gene_id) AS r, k FROM (SELECT l.locus_id, g.*, CASE WHEN l.strand = g.strand AND biotype = 'protein_coding' THEN 0 WHEN l.strand = g.strand THEN 1 ELSE 2 END AS k FROM loci l JOIN genes g ON l.chrom = g.chrom AND l."start" <= g."end" AND g."start" <= l."end") g)
 SELECT locus_id, CASE WHEN k IS NULL THEN 'none' WHEN k = 0 THEN 'protein_coding' ELSE 'annotated' END AS named_overlap, p.gene_id FROM loci LEFT JOIN (SELECT * FROM p WHERE r = 1) p USING (locus_id)""")
def naming_priority(spark: SparkSession, d: str) -> DataFrame:
    genes = view(spark, d, "genes").withColumn("chrom", F.expr("CASE WHEN n_exons = 2 THEN substr(chrom, 4) ELSE chrom END"))
    return models.name_loci(view(spark, d, "loci"), genes)


@query("repeat_fraction", ctes("loci", "repeats") + """ SELECT locus_id, round(CAST(coalesce(sum(least(l."end", r."end") - greatest(l."start", r."start") + 1) FILTER (r.chrom IS NOT NULL), 0) AS DOUBLE) / any_value(l."end" - l."start" + 1), 6) AS rmsk_frac FROM loci l LEFT JOIN repeats r ON l.chrom = r.chrom AND l."start" <= r."end" AND r."start" <= l."end" GROUP BY locus_id""")
def repeat_fraction(spark: SparkSession, d: str) -> DataFrame:
    loci = view(spark, d, "loci")
    p = overlap_join(loci, view(spark, d, "repeats")).groupBy("locus_id").agg(F.sum(F.least("end", "r_end") - F.greatest("start", "r_start") + 1).alias("n"))
    return loci.join(p, "locus_id", "left").select("locus_id", F.round(F.coalesce("n", F.lit(0)).cast("double") / (F.col("end") - F.col("start") + 1), 6).alias("rmsk_frac"))


@query("conservation_mean", ctes("loci", "repeats") + """, w AS (SELECT locus_id, value, CASE WHEN r."end" - r."start" <= 1 THEN 1 ELSE r."end" - r."start" END AS n FROM loci l JOIN repeats r ON l.chrom = r.chrom AND l."start" <= r."end" AND r."start" <= l."end")
 SELECT locus_id, CAST(sum(n) AS BIGINT) AS n, round(sum(value * n) / sum(n), 4) AS mean, max(value) AS max, round(sum(CASE WHEN value > 950 THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE), 6) AS frac_pos FROM w GROUP BY locus_id""")
def conservation_mean(spark: SparkSession, d: str) -> DataFrame:
    p = overlap_join(view(spark, d, "loci"), view(spark, d, "repeats")).withColumn("n", F.greatest(F.lit(1).cast("long"), F.col("r_end") - F.col("r_start")))
    total = F.sum("n")
    return p.groupBy("locus_id").agg(total.alias("n"), F.round(F.sum(F.col("r_value") * F.col("n")) / total, 4).alias("mean"), F.max("r_value").alias("max"), F.round(F.sum(F.when(F.col("r_value") > 950, F.col("n")).otherwise(0)) / total.cast("double"), 6).alias("frac_pos"))


_HITS = EXONS + """, hits AS (SELECT DISTINCT sample_id, read_id AS fragment, x.gene_id, x.transcript_id FROM aln a JOIN exons x ON a.chrom = x.chrom AND j_start - 50 <= x."end" AND x."start" <= j_end + 50 AND (a.strand = '.' OR a.strand = x.strand OR x.strand = '.')),
 one AS (SELECT sample_id, fragment, min(gene_id) AS gene_id, count(DISTINCT transcript_id) AS t FROM hits GROUP BY ALL HAVING count(DISTINCT gene_id) = 1), counts AS (SELECT sample_id, gene_id, count(DISTINCT fragment) AS n FROM one GROUP BY ALL)"""


def _hits(spark: SparkSession, d: str) -> DataFrame:
    blocks = view(spark, d, "aln").select("sample_id", F.col("read_id").alias("fragment"), "chrom", F.when(F.col("strand") != ".", F.col("strand")).alias("strand"), (F.col("j_start") - 50).alias("start"), (F.col("j_end") + 50).alias("end"))
    return quantify.exon_hits(blocks, exons(spark, d))


@query("read_exon_join", ctes("aln", "genes") + ", " + _HITS + " SELECT * FROM hits")
def read_exon_join(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d)


@query("unique_gene_count", ctes("aln", "genes") + ", " + _HITS + " SELECT * FROM counts")
def unique_gene_count(spark: SparkSession, d: str) -> DataFrame:
    return quantify.gene_counts(quantify.unique_gene(_hits(spark, d)))


@query("fractional_isoform", ctes("aln", "genes") + ", " + _HITS + " SELECT sample_id, gene_id AS transcript_id, round(sum(CAST(1 AS DOUBLE) / t), 6) AS n FROM one GROUP BY ALL")
def fractional_isoform(spark: SparkSession, d: str) -> DataFrame:
    return quantify.unique_gene(_hits(spark, d)).groupBy("sample_id", "transcript_id").agg(F.round(F.sum("share"), 6).alias("n"))


_ZERO = _HITS + """, zero AS (SELECT gene_id, sample_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT gene_id FROM genes) CROSS JOIN (SELECT DISTINCT sample_id FROM aln) LEFT JOIN counts USING (gene_id, sample_id)),
 len AS (SELECT gene_id, CAST(sum("end" - "start" + 1) AS BIGINT) AS length FROM exons GROUP BY gene_id), rate AS (SELECT gene_id, sample_id, n, length, n / CAST(length AS DOUBLE) AS r FROM zero JOIN len USING (gene_id)),
 tpm AS (SELECT gene_id, sample_id, n, length, round(CASE WHEN sum(r) OVER (PARTITION BY sample_id) > 0 THEN r / sum(r) OVER (PARTITION BY sample_id) * 1e6 ELSE 0 END, 4) AS tpm FROM rate)"""


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    return quantify.zero_filled(unique_gene_count(spark, d), view(spark, d, "genes"), view(spark, d, "aln").select("sample_id").distinct())


@query("zero_fill_matrix", ctes("aln", "genes") + ", " + _ZERO + " SELECT * FROM zero")
def zero_fill_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d)


@query("tpm", ctes("aln", "genes") + ", " + _ZERO + " SELECT * FROM tpm")
def tpm(spark: SparkSession, d: str) -> DataFrame:
    length = coverage.union_length(exons(spark, d), "gene_id").withColumnRenamed("union_length", "length")
    return quantify.tpm(_matrix(spark, d).join(length, "gene_id")).withColumn("tpm", F.round("tpm", 4))


@query("pivot_samples", ctes("aln", "genes") + ", " + _ZERO + " SELECT gene_id, " + ", ".join(f"CAST(sum(n) FILTER (sample_id = 's{k}') AS BIGINT) AS s{k}" for k in range(6)) + " FROM zero GROUP BY gene_id")
def pivot_samples(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d).groupBy("gene_id").pivot("sample_id", [f"s{k}" for k in range(6)]).agg(F.first("n"))


@query("size_factors", ctes("obs") + """, m AS (SELECT locus_id AS gene_id, sample_id, CAST(sum(reads) + 1 AS BIGINT) AS n FROM obs GROUP BY ALL), g AS (SELECT gene_id, avg(ln(n)) AS g FROM m GROUP BY gene_id) SELECT sample_id, round(exp(median(ln(n) - g)), 6) AS size_factor FROM m JOIN g USING (gene_id) GROUP BY sample_id""")
def size_factors(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "obs").groupBy(F.col("locus_id").alias("gene_id"), "sample_id").agg((F.sum("reads") + 1).alias("n"))
    return quantify.size_factors(m)


@query("differential_expression")
def differential_expression(spark: SparkSession, d: str) -> DataFrame:
    obs = view(spark, d, "obs")
    return expression.differential_expression(obs.select(F.col("locus_id").alias("gene_id"), "sample_id", F.col("reads").alias("n")), obs.select("sample_id", "grp").distinct())


@query("junction_support", ctes("aln") + """ SELECT chrom, j_start, j_end, count(DISTINCT CASE WHEN nh = 1 THEN qname WHEN nh IS NULL THEN concat(qname, ':', pos, ':', cigar) END) AS support FROM aln GROUP BY chrom, j_start, j_end""")
def junction_support(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("nh") == 1, F.col("qname")).when(F.col("nh").isNull(), F.concat_ws(":", "qname", F.col("pos").cast("string"), "cigar"))
    return view(spark, d, "aln").withColumn("key", key).groupBy("chrom", "j_start", "j_end").agg(F.count_distinct("key").alias("support"))


@query("open_gap", ctes("loci", "genes") + """, n AS (SELECT l.*, g."start" AS gs, g."end" AS ge, row_number() OVER (PARTITION BY locus_id ORDER BY greatest(0, g."start" - l."end" - 1, l."start" - g."end" - 1), g.gene_id) AS k FROM loci l JOIN genes g USING (chrom))
 SELECT locus_id, CAST(CASE WHEN gs > "end" + 1 THEN "end" + 1 WHEN ge < "start" - 1 THEN ge + 1 END AS BIGINT) AS gap_start, CAST(CASE WHEN gs > "end" + 1 THEN gs - 1 WHEN ge < "start" - 1 THEN "start" - 1 END AS BIGINT) AS gap_end FROM n WHERE k = 1""")
def open_gap(spark: SparkSession, d: str) -> DataFrame:
    return models.open_gaps(view(spark, d, "loci"), view(spark, d, "genes")).select("locus_id", "gap_start", "gap_end")


@query(
    "bridge_reads",
    ctes("loci", "genes")
    + ", "
    + EXONS
    + """, n AS (SELECT l.*, CAST(substr(locus_id, 2) AS BIGINT) AS c, g.gene_id, g."start" AS gs, g."end" AS ge, row_number() OVER (PARTITION BY locus_id ORDER BY greatest(0, g."start" - l."end" - 1, l."start" - g."end" - 1), g.gene_id) AS k FROM loci l JOIN genes g USING (chrom)),
 e AS (SELECT locus_id, c, n.chrom, CASE WHEN gs > n."end" + 1 THEN n."end" + 1 ELSE x."end" + 1 END AS s, CASE WHEN gs > n."end" + 1 THEN x."start" - 1 ELSE n."start" - 1 END AS e FROM n JOIN exons x USING (gene_id) WHERE k = 1 AND (gs > n."end" + 1 OR ge < n."start" - 1)),
 i AS (SELECT chrom, s, e + CASE WHEN c % 3 = 0 THEN 1 ELSE 0 END AS e, concat('q', c % 20, '_', s % 2) AS q FROM e)
 SELECT n.locus_id, count(DISTINCT q) AS bridges FROM n LEFT JOIN e USING (locus_id) LEFT JOIN i ON i.chrom = e.chrom AND i.s = e.s AND i.e = e.e WHERE k = 1 GROUP BY n.locus_id""",
)
def bridge_reads(spark: SparkSession, d: str) -> DataFrame:
    # reads that join each locus to its gene's exons; those of every third locus end one base late
    gaps, x = models.open_gaps(view(spark, d, "loci"), view(spark, d, "genes")), exons(spark, d)
    met = gaps.where("before IS NOT NULL").join(x.select(F.col("gene_id").alias("nearest_id"), F.col("start").alias("xs"), F.col("end").alias("xe")), "nearest_id")
    c = F.expr("CAST(substr(locus_id, 2) AS BIGINT)")
    i = met.select("chrom", c.alias("c"), F.expr("if(before, gap_start, xe + 1)").alias("start"), F.expr("if(before, xs - 1, gap_end)").alias("end"))
    i = i.select("chrom", "start", (F.col("end") + F.when(F.col("c") % 3 == 0, 1).otherwise(0)).alias("end"), F.expr("concat('q', c % 20, '_', start % 2)").alias("fragment"))
    return models.bridge_support(gaps, i, x)


@query("assembly_evidence", ctes("loci", "repeats") + """ SELECT locus_id, value > 1000 AS treat, count(*) AS n_isoforms, max(value) AS max_cov, CAST(max(greatest(abs(l."start" - r."start"), abs(l."end" - r."end"))) AS BIGINT) AS max_delta FROM loci l JOIN repeats r ON l.chrom = r.chrom AND l."start" <= r."end" AND r."start" <= l."end" GROUP BY ALL""")
def assembly_evidence(spark: SparkSession, d: str) -> DataFrame:
    p = overlap_join(view(spark, d, "loci"), view(spark, d, "repeats"))
    delta = F.greatest(F.abs(F.col("start") - F.col("r_start")), F.abs(F.col("end") - F.col("r_end")))
    return p.groupBy("locus_id", (F.col("r_value") > 1000).alias("treat")).agg(F.count(F.lit(1)).alias("n_isoforms"), F.max("r_value").alias("max_cov"), F.max(delta).alias("max_delta"))


@query("first_wins_union", ctes("loci", "genes") + """ SELECT locus_id, chrom, origin FROM (SELECT *, row_number() OVER (PARTITION BY locus_id ORDER BY origin) AS k FROM (SELECT locus_id, chrom, 0 AS origin FROM loci WHERE n_exons > 2 UNION ALL SELECT locus_id, concat(chrom, 'b'), 1 FROM loci)) WHERE k = 1""")
def first_wins_union(spark: SparkSession, d: str) -> DataFrame:
    loci = view(spark, d, "loci")
    a = loci.where("n_exons > 2").select("locus_id", "chrom", F.lit(0).alias("origin"))
    b = loci.select("locus_id", F.concat("chrom", F.lit("b")).alias("chrom"), F.lit(1).alias("origin"))
    return models.first_wins([a, b], "locus_id")


@query("replicate_ordinal", ctes("loci") + """ SELECT locus_id, strand AS grp, CAST(coalesce(CASE WHEN n_exons = 1 THEN 9 END, row_number() OVER (PARTITION BY strand ORDER BY CAST(substr(locus_id, 2) AS BIGINT))) AS INT) AS replicate FROM loci""")
def replicate_ordinal(spark: SparkSession, d: str) -> DataFrame:
    sheet = view(spark, d, "loci").select("locus_id", F.col("strand").alias("grp"), F.expr("CAST(substr(locus_id, 2) AS BIGINT)").alias("row"), F.expr("CASE WHEN n_exons = 1 THEN 9 END").alias("replicate"))
    return models.replicate_ordinals(sheet).select("locus_id", "grp", "replicate")


@query("contig_setops", ctes("loci", "genes") + """ SELECT chrom, 'both' AS side FROM (SELECT chrom FROM loci INTERSECT SELECT chrom FROM genes) UNION ALL SELECT concat('x', chrom), 'loci' FROM (SELECT chrom FROM loci EXCEPT SELECT chrom FROM genes WHERE chrom <> 'chr1')""")
def contig_setops(spark: SparkSession, d: str) -> DataFrame:
    a, b = view(spark, d, "loci").select("chrom"), view(spark, d, "genes").select("chrom")
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b.where("chrom <> 'chr1'")).select(F.concat(F.lit("x"), "chrom").alias("chrom"), F.lit("loci").alias("side")))


@query("contig_digest", ctes("genes") + """ SELECT sha256(string_agg(concat(chrom, ':', n), ',' ORDER BY chrom)) AS digest FROM (SELECT chrom, max("end") AS n FROM genes GROUP BY chrom)""")
def contig_digest(spark: SparkSession, d: str) -> DataFrame:
    c = view(spark, d, "genes").groupBy("chrom").agg(F.max("end").alias("n"))
    return c.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "chrom", F.col("n").cast("string")))), ",").cast("binary"), 256).alias("digest"))


@query("nearest_gene_record", ctes("loci", "genes") + """, n AS (SELECT locus_id, g.*, CASE WHEN l."start" <= g."end" AND g."start" <= l."end" THEN 0 ELSE greatest(g."start" - l."end" - 1, l."start" - g."end" - 1) END AS distance FROM loci l JOIN genes g ON l.chrom = g.chrom AND (l.strand = '.' OR l.strand = g.strand)),
 k AS (SELECT *, row_number() OVER (PARTITION BY locus_id ORDER BY distance, n_exons = 1, gene_id) AS r FROM n)
 SELECT l.locus_id, EXISTS (SELECT 1 FROM genes g WHERE g.chrom = l.chrom AND g."start" <= l."end" AND l."start" <= g."end") AS overlaps_gene, gene_id AS nearest_id, gene_name AS nearest_name, CAST(distance AS BIGINT) AS distance, k.strand AS nearest_strand, k."start" AS body_start, k."end" AS body_end FROM loci l LEFT JOIN k ON k.locus_id = l.locus_id AND r = 1""")
def nearest_gene_record(spark: SparkSession, d: str) -> DataFrame:
    loci = view(spark, d, "loci").select("locus_id", "chrom", "strand", "start", "end")
    bodies = view(spark, d, "genes").withColumn("derived", F.col("n_exons") == 1)
    return models.nearest_genes(loci, bodies).drop("chrom", "strand", "start", "end")


@query("assembly_summary", ctes("loci", "repeats") + """, t AS (SELECT *, concat('s', repeat_id % 6) AS sample_id, CASE repeat_id % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand FROM repeats),
 e AS (SELECT locus_id, sample_id, greatest(abs(min(t."start") - any_value(l."start")), abs(max(t."end") - any_value(l."end"))) AS delta FROM loci l JOIN t ON l.chrom = t.chrom AND l."start" <= t."end" AND t."start" <= l."end" AND (l.strand = '.' OR t.strand = '.' OR l.strand = t.strand) GROUP BY ALL)
 SELECT locus_id, coalesce(string_agg(sample_id, ',' ORDER BY sample_id), '') AS assembled_in, count(*) FILTER (sample_id IN ('s0', 's1')) AS n_control, count(*) FILTER (sample_id > 's1') AS n_treat, CAST(max(delta) AS BIGINT) AS max_delta FROM loci LEFT JOIN e USING (locus_id) GROUP BY locus_id""")
def assembly_summary(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("repeat_id") % 3
    t = view(spark, d, "repeats").select(F.concat(F.lit("s"), (F.col("repeat_id") % 6).cast("string")).alias("sample_id"), "chrom", F.when(n == 0, "+").when(n == 1, "-").otherwise(".").alias("strand"), "start", "end", F.col("value").alias("cov"))
    sheet = t.select("sample_id").distinct().select("sample_id", F.when(F.col("sample_id").isin("s0", "s1"), "control").otherwise("treat").alias("grp"), F.col("sample_id").alias("row"))
    loci = view(spark, d, "loci")
    return evidence.assembly_summary(loci, evidence.assemblies(loci, t), sheet)
