"""Genomic views over the relational test tables, written once for both engines ("//" is integer division)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: view -> (table, columns as SQL expressions)
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "aln": (
        "lineitem",
        {
            "read_id": "l_orderkey * 10 + l_linenumber",
            "qname": "concat('q', l_orderkey, '_', (l_linenumber + 1) // 2)",
            "sample_id": "concat('s', l_suppkey % 6)",
            "grp": "CASE WHEN l_suppkey % 6 < 2 THEN 'control' ELSE 'treat' END",
            "library": "CASE l_suppkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'fr' ELSE 'unstranded' END",
            "chrom": "concat('chr', l_partkey % 5 + 1)",
            "pos": "l_partkey * 40 + l_linenumber",
            "strand": "CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE '.' END",
            "mapq": "cast(l_quantity AS int)",
            "flag": "cast((CASE WHEN l_orderkey % 3 <> 0 THEN 3 + (CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END) ELSE 0 END) + (CASE WHEN l_linenumber % 4 < 2 THEN 16 ELSE 0 END) + (CASE WHEN l_suppkey % 17 = 0 THEN 1024 ELSE 0 END) + (CASE WHEN l_partkey % 23 = 0 THEN 256 ELSE 0 END) + (CASE WHEN l_partkey % 31 = 0 THEN 4 ELSE 0 END) AS int)",
            "nh": "cast(CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 3 THEN 2 ELSE 1 END AS int)",
            "cigar": "concat(CASE WHEN l_linenumber % 3 = 0 THEN '5S' ELSE '' END, 100 - l_linenumber, 'M', CASE WHEN l_linenumber % 5 = 0 THEN '2I3M4D' ELSE '' END, 41 + (l_partkey % 9) * 20, 'N50M', CASE WHEN l_linenumber = 7 THEN '30N20M3H' ELSE '' END)",
            "j_start": "l_partkey * 40 + 100",
            "j_end": "l_partkey * 40 + 140 + (l_partkey % 9) * 20",
        },
    ),
    "genes": (
        "supplier",
        {
            "gene_id": "concat('G', s_suppkey)",
            "gene_name": "s_name",
            "biotype": "CASE s_nationkey % 4 WHEN 0 THEN 'protein_coding' WHEN 1 THEN 'lncRNA' WHEN 2 THEN 'snRNA' ELSE 'protein_coding' END",
            "chrom": "concat('chr', s_nationkey % 5 + 1)",
            "start": "s_suppkey * 800 + 1",
            "end": "s_suppkey * 800 + 101 + s_nationkey * 12",
            "strand": "CASE WHEN s_suppkey % 7 = 0 THEN '.' WHEN s_suppkey % 2 = 0 THEN '+' ELSE '-' END",
            "n_exons": "1 + s_suppkey % 4",
        },
    ),
    "loci": (
        "customer",
        {
            "locus_id": "concat('L', c_custkey)",
            "chrom": "concat('chr', c_nationkey % 5 + 1)",
            "start": "c_custkey * 53 + 1",
            "end": "c_custkey * 53 + 61 + c_custkey % 400",
            "strand": "CASE c_custkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END",
            "n_exons": "1 + c_custkey % 4",
        },
    ),
    "repeats": ("part", {"repeat_id": "p_partkey", "chrom": "concat('chr', p_size % 5 + 1)", "start": "p_partkey * 37", "end": "p_partkey * 37 + p_size * 3", "value": "p_retailprice"}),
    "nodes": (
        "part",
        {
            "node": "p_partkey",
            "chrom": "concat('chr', p_partkey % 3 + 1)",
            "strand": "CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END",
            "start": "(p_partkey * 7919) % 4000000 + 1",
            "end": "(p_partkey * 7919) % 4000000 + 50 + p_size * 4",
            "support": "p_size",
            "n_detected": "1 + p_size % 4",
            "control_max": "CASE WHEN p_size % 5 = 0 THEN 2 ELSE 0 END",
        },
    ),
    "obs": (
        "orders",
        {
            "obs_id": "o_orderkey",
            "locus_id": "concat('L', o_custkey)",
            "sample_id": "concat('s', o_orderkey % 6)",
            "grp": "CASE WHEN o_orderkey % 6 < 2 THEN 'control' ELSE 'treat' END",
            "tpm": "round((o_orderkey * 37 % 1000) / 250.0, 6)",
            "reads": "o_orderkey * 31 % 400",
            "lfc": "round((o_orderkey * 13 % 800) / 100.0 - 4, 6)",
            "pvalue": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE round((o_orderkey * 17 % 1000) / 1000.0, 6) END",
            "padj": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round((o_orderkey * 29 % 500) / 1000.0, 6) END",
            "valley": "round((o_orderkey * 11 % 300) / 100.0, 6)",
            "gap": "round((o_orderkey * 19 % 300) / 100.0, 6)",
            "depth": "round((o_orderkey * 23 % 2000) / 100.0, 6)",
            "bridge": "o_orderkey % 4",
            "support_text": "concat(o_orderkey % 5, ',', o_orderkey % 7, ',', o_orderkey % 3)",
        },
    ),
    "seqs": (
        "documents",
        {
            "seq_id": "doc_id",
            "seq": "translate(upper({strip}), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGACGTCGTACGT')",
        },
    ),
}
_STRIP = {"spark": "regexp_replace(coalesce(text, ''), '[^A-Za-z]', '')", "duckdb": "regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')"}


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files have fewer splits than there are cores; as it is otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def view(spark: SparkSession, sf_dir: str, name: str, costly: bool = False) -> DataFrame:
    """The view's rows; costly ones over all cores, as sequences always are."""
    table, columns = VIEWS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if costly or name == "seqs":
        df = spread(df.select(*sorted({c for c in df.columns if any(c in x for x in columns.values())} | ({"text"} if name == "seqs" else set()))))
    return df.select(*[F.expr(_spark(x)).alias(c) for c, x in columns.items()])


def _spark(x: str) -> str:
    x = x.replace("{strip}", _STRIP["spark"]).replace("//", "div")
    return x.replace("/ 250.0", "/ 250.0D").replace("/ 100.0", "/ 100.0D").replace("/ 1000.0", "/ 1000.0D")


def _duckdb(x: str) -> str:
    x = x.replace("{strip}", _STRIP["duckdb"])
    return x.replace("/ 250.0", "/ CAST(250 AS DOUBLE)").replace("/ 100.0", "/ CAST(100 AS DOUBLE)").replace("/ 1000.0", "/ CAST(1000 AS DOUBLE)")


def ctes(*names: str) -> str:
    """WITH and the views' definitions, for DuckDB."""
    return "WITH RECURSIVE " + ",\n".join("{} AS (SELECT {} FROM {})".format(n, ", ".join(f'{_duckdb(x)} AS "{c}"' for c, x in VIEWS[n][1].items()), VIEWS[n][0]) for n in names)
