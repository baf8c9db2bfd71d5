"""Secret scans with multipart credential linking (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points to either side within which parts of a credential belong together.
SCOPE = 400
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A long run of key characters, a secret only beside an access identifier if it mixes cases and digits.
LOOSE = r"[A-Za-z0-9+/_=-]{32,}"
#: An address, reported only beside an access identifier and a secret.
ENDPOINT = r"""[a-z][a-z0-9+]{1,15}://[^\x00-\x20"'<>]+"""
#: kind, expression, what a text must hold for it to be tried, whether it is reported by itself.
KINDS = (
    ("assign", ASSIGN, "text LIKE '%=%' OR text LIKE '%:%'", True),
    ("access", ACCESS, "text LIKE '%AKIA%'", True),
    ("hex", HEX, "true", True),
    ("secret", LOOSE, "text LIKE '%AKIA%'", False),
    ("endpoint", ENDPOINT, "text LIKE '%AKIA%' AND text LIKE '%://%'", False),
)
MASK = "[SECRET]"


def _found(kind: int) -> Column:
    """Matches of one kind in order, each with the length of the text before it since the last one."""
    _, pattern, needs, _ = KINDS[kind]
    p = F.lit(pattern)
    parts = F.zip_with(F.split("text", pattern, -1), F.regexp_extract_all("text", p, F.lit(0)), lambda gap, m: F.struct(F.lit(kind).alias("kind"), F.length(gap).cast("long").alias("gap"), m.alias("m")))
    parts = F.filter(parts, lambda x: x["m"].isNotNull())
    return F.when(F.expr(needs) & F.col("text").rlike(pattern), parts).otherwise(F.array().cast("array<struct<kind:int,gap:bigint,m:string>>"))


def _parts(docs: DataFrame, carried: Column) -> DataFrame:
    """A row for each part of each document and one of kind -1 that carries what is wanted back: _row, _back, kind, start, end, reported.

    Places are running sums of gaps and matches. Parts meet their document's others in a range frame of SCOPE code
    points, an interval join that makes no pairs. All windows share one exchange by _row; texts stay behind unless carried.
    """
    text = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).select(F.monotonically_increasing_id().alias("_row"), carried.alias("_back"), "text")
    head = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("gap"), F.lit("").alias("m")))
    exploded = text.select("_row", "_back", F.posexplode(F.concat(head, *[_found(k) for k in range(len(KINDS))])).alias("_at", "p")).select("_row", F.when(F.col("_at") == 0, F.col("_back")).alias("_back"), "_at", "p.kind", "p.gap", F.length("p.m").cast("long").alias("size"), "p.m")
    m = F.col("m")
    good = (
        F.when(F.col("kind") == 0, F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
        .when(F.col("kind") == 3, m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"))
        .otherwise(True)
    )
    dealt = exploded.withColumn("good", good).drop("m").repartition("_row")
    so_far = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size")).where("good")
    near = Window.partitionBy("_row").orderBy("start").rangeBetween(-SCOPE, SCOPE)
    has = lambda *kinds: F.max(F.col("kind").isin(*kinds)).over(near)
    reported = F.when(F.col("kind") == 3, has(1)).when(F.col("kind") == 4, has(1) & has(0, 2, 3)).otherwise(F.col("kind") >= 0)
    return placed.withColumn("reported", reported)


def _named(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), kind + 1)


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and found (array of start, kind, end) of every document.

    Base kinds are always reported; a loose secret only within SCOPE of an access identifier, an endpoint only within
    SCOPE of one and of a secret. Places are code points, ends exclusive. Null and empty texts have none. Each row is
    a document of its own, so repeated rows and null ids stay; other columns aren't read. One exchange of a row for
    each part and document, dealt by row, so no key gathers more than one text's parts.
    """
    found = F.array_sort(F.collect_list(F.when(F.col("reported"), F.struct("start", "kind", "end"))))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k][0]}") for k in range(3)]
    told = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", _named(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    grouped = _parts(docs, F.struct("doc_id")).groupBy("_row").agg(F.first("_back", ignorenulls=True).alias("_back"), *counts, found.alias("found"))
    base = F.filter("found", lambda x: x["kind"] < 3)
    return grouped.select("_back.doc_id", "n_assign", "n_access", "n_hex", F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("found")).alias("spans"), "found")


def _suspect() -> Column:
    any_ = F.lit(False)
    for _, pattern, needs, alone in KINDS:
        if alone:
            any_ = any_ | (F.expr(needs) & F.col("text").rlike(pattern))
    return F.coalesce(any_, F.lit(False))


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """docs with every reported span of text replaced by ``mask``; spans that overlap become one mask.

    Only documents with a base match leave their task (weak parts are reported beside base ones alone). All columns
    keep their names, order and other values; null texts stay null.
    """
    columns = docs.columns
    carried = F.struct(*[F.col(c) for c in columns])
    before = Window.partitionBy("_row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    parts = _parts(docs.where(_suspect()), carried).where("reported OR kind = -1")
    parts = parts.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
    piece = F.when(F.col("kind") >= 0, F.struct("start", "end", "kind", "from"))
    whole = parts.groupBy("_row").agg(F.first("_back", ignorenulls=True).alias("_back"), F.array_sort(F.collect_list(piece)).alias("cuts"), F.max("end").cast("int").alias("to"))
    text = F.col("_back").getField("text").cast("string")
    kept = F.transform("cuts", lambda x: F.concat(F.substring(text, x["from"].cast("int") + 1, F.greatest(x["start"] - x["from"], F.lit(0)).cast("int")), F.when(x["start"] >= x["from"], F.lit(mask)).otherwise("")))
    clean = F.concat(F.array_join(kept, ""), F.substring(text, F.col("to") + 1, F.length(text)))
    changed = whole.select(*[(clean if c == "text" else F.col("_back").getField(c)).alias(c) for c in columns])
    return docs.where(~_suspect()).unionByName(changed)
