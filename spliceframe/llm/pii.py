"""Personal data by weak supervision (operator 8).

Candidates come from strict (base) and loose expressions. Four labelers vote on each: 1, 0, or nothing. Votes of the
whole corpus are counted by pattern, of which there are a bounded number; expectation-maximisation over those counts
estimates each labeler's reliability and each pattern's probability, and a logistic span classifier is trained on
these probabilities. Base spans are always reported, loose ones where the classifier agrees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points before a candidate in which the context labeler looks for cues.
CONTEXT = 40
_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Kind:
    """pattern: possessive, and tried where a run begins only, so that long runs take linear time. needs: what a text must have."""

    name: str
    base: bool
    pattern: str
    needs: str
    good: str
    gazetteer: str
    cues: str
    against: str


_LUHN = "aggregate(sequence(1, length(d)), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN ascii(substring(d, -i, 1)) - 48 WHEN ascii(substring(d, -i, 1)) > 52 THEN 2 * (ascii(substring(d, -i, 1)) - 48) - 9 ELSE 2 * (ascii(substring(d, -i, 1)) - 48) END) % 10 = 0"
#: Kinds in the order of reports; gazetteers and cues are fixed values, in place as expressions over m (the match), d (its digits) and cue (what stands before).
KINDS = (
    Kind("email", True, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "text LIKE '%@%'", "true", "lower(m) rlike '[.](com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$'", "mail|contact|write|correo|courriel|kontakt", "git|version"),
    Kind("ip", True, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "text LIKE '%.%.%.%'", f"m rlike '^{_BYTE}(?:[.]{_BYTE}){{3}}$'", "NOT m rlike '^(0|127|255)[.]'", "ip|host|server|address|client|login|adresse", "version|release|section|chapter"),
    Kind("card", True, r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "text rlike '[0-9](?:[ -]?[0-9]){15}'", f"CASE WHEN length(d) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END", "d rlike '^(4|5[1-5]|2[2-7]|3[47]|35|6)'", "card|visa|credit|tarjeta|carte|karte|pay", "order|invoice|serial|isbn|hash"),
    Kind("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", "text LIKE '%+%'", "length(d) BETWEEN 8 AND 15", "d rlike '^(1|33|34|39|41|43|44|49|7|81|86|91)'", "phone|tel|call|mobile|fax|contact|anruf|appel", "version|sum|score"),
    Kind("local_phone", False, r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "text rlike '[0-9]{4}'", "true", "d rlike '^[2-9]'", "phone|tel|call|mobile|fax|contact|anruf|appel", "order|invoice|serial|isbn|version"),
    Kind("national_id", False, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "text LIKE '%-%-%'", "true", "NOT d rlike '^(000|666|9)'", "ssn|social|security|insurance", "order|invoice|serial|isbn|part"),
    Kind("iban", False, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "text rlike '[A-Z]{2}[0-9]{2}'", "true", "m rlike '^(AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)'", "iban|account|bank|konto|cuenta|compte", "serial|part|model"),
    Kind("name", False, r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+", "text rlike '(?:Mr|Mrs|Ms|Dr|Prof)[. ]'", "true", "m rlike ' (James|John|Mary|Maria|Anna|Peter|Paul|Hans|Jean|Pierre|Juan|Jose|Carlos|Michael|David|Smith|Jones|Brown|Miller|Garcia|Martin|Schmidt)$'", "name|dear|signed|contact|patient", "street|avenue"),
)
LABELERS = ("regex", "gazetteer", "context", "shape")


def _found(k: int) -> Column:
    kind = KINDS[k]
    parts = F.zip_with(
        F.split("text", kind.pattern, -1),
        F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)),
        lambda gap, m: F.struct(F.lit(k).alias("kind"), F.length(gap).cast("long").alias("gap"), F.lower(F.right(gap, F.lit(CONTEXT))).alias("cue"), m.alias("m")),
    )
    parts = F.filter(parts, lambda x: x["m"].isNotNull())
    return F.when(F.expr(kind.needs) & F.col("text").rlike(kind.pattern), parts).otherwise(F.array().cast("array<struct<kind:int,gap:bigint,cue:string,m:string>>"))


def _by_kind(part: str) -> Column:
    out = F.when(F.col("kind") == 0, F.expr(getattr(KINDS[0], part)))
    for k in range(1, len(KINDS)):
        out = out.when(F.col("kind") == k, F.expr(getattr(KINDS[k], part)))
    return out


def _cued(part: str) -> Column:
    out = F.when(F.col("kind") == 0, F.col("cue").rlike(getattr(KINDS[0], part)))
    for k in range(1, len(KINDS)):
        out = out.when(F.col("kind") == k, F.col("cue").rlike(getattr(KINDS[k], part)))
    return F.coalesce(out, F.lit(False))


def _candidates(docs: DataFrame, placed: bool) -> DataFrame:
    """Each candidate with its votes (1, 0, or -1 for none), and if placed each document's own row of kind -1, with _row, start and end."""
    text = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).select(F.monotonically_increasing_id().alias("_row"), F.struct("doc_id").alias("_back"), "text")
    head = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("gap"), F.lit("").alias("cue"), F.lit("").alias("m")))
    every = [_found(k) for k in range(len(KINDS))]
    rows = text.select("_row", "_back", F.posexplode(F.concat(head, *every) if placed else F.concat(*every)).alias("_at", "p")).select("_row", F.when(F.col("_at") == 0, F.col("_back")).alias("_back"), "_at", "p.*")
    rows = rows.withColumn("d", F.regexp_replace("m", "[^0-9]", ""))
    strict = F.col("kind") < sum(k.base for k in KINDS)
    votes = [
        F.when(strict, 1).otherwise(-1).alias("regex"),
        F.coalesce(_by_kind("gazetteer"), F.lit(False)).cast("int").alias("gazetteer"),
        F.when(_cued("cues"), 1).when(_cued("against"), 0).otherwise(-1).alias("context"),
        F.when(F.length("d") < 6, -1).when(F.col("d").rlike(r"^(.)\1*$|123456789|0000000"), 0).otherwise(1).alias("shape"),
    ]
    rows = rows.select("_row", "_back", "_at", "kind", "gap", F.length("m").cast("long").alias("size"), F.coalesce(_by_kind("good"), F.lit(True)).alias("good"), *votes)
    if not placed:
        return rows.where("good")
    so_far = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return rows.repartition("_row").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size")).where("good")


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> tuple[list[dict[int, tuple[float, float]]], dict[int, float], dict[tuple[int, tuple[int, ...]], float]]:
    """Dawid-Skene over (kind, votes, count): P(vote | personal or not) by labeler, the share of personal data by kind, P(personal) by pattern."""
    belief = {(k, v): min(0.95, max(0.05, (1 + sum(x == 1 for x in v)) / (2 + sum(x >= 0 for x in v)))) for k, v, _ in patterns}
    table: list[dict[int, tuple[float, float]]] = []
    prior: dict[int, float] = {}
    for _ in range(rounds):
        table = []
        for j in range(len(LABELERS)):
            mass = {x: [1.0 + 2.0 * (x == 1), 1.0 + 2.0 * (x == 0)] for x in (-1, 0, 1)}  # a labeler is thought better than chance
            for k, v, n in patterns:
                mass[v[j]][0] += n * belief[k, v]
                mass[v[j]][1] += n * (1 - belief[k, v])
            total = [sum(m[y] for m in mass.values()) for y in (0, 1)]
            table.append({x: (m[0] / total[0], m[1] / total[1]) for x, m in mass.items()})
        share: dict[int, list[float]] = {}
        for k, v, n in patterns:
            s = share.setdefault(k, [1.0, 2.0])
            s[0] += n * belief[k, v]
            s[1] += n
        prior = {k: a / b for k, (a, b) in share.items()}
        for k, v, _ in patterns:
            odds = math.log(prior[k] / (1 - prior[k])) + sum(math.log(table[j][x][0] / table[j][x][1]) for j, x in enumerate(v))
            belief[k, v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return table, prior, belief


def features(kind: int, votes: tuple[int, ...]) -> list[float]:
    """Kind, and every labeler's vote but the regex's, which is the same within a kind."""
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *[float(v == y) for v in votes[1:] for y in (0, 1)]]


def train_classifier(patterns: list[tuple[int, tuple[int, ...], int]], belief: dict, rounds: int = 400, rate: float = 2.0, shrink: float = 1e-3) -> list[float]:
    """Weights of a logistic span classifier, trained on the patterns' probabilities by their share of candidates."""
    total = sum(n for _, _, n in patterns) or 1
    rows = [(features(k, v), belief[k, v], n / total) for k, v, n in patterns]
    w = [0.0] * len(features(0, (0,) * len(LABELERS)))
    w[0] = -0.5  # what was never seen isn't reported
    for _ in range(rounds):
        slope = [shrink * x for x in w]
        for x, p, n in rows:
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for i, a in enumerate(x):
                if a:
                    slope[i] += n * (q - p) * a
        w = [a - rate * b for a, b in zip(w, slope)]
    return w


def fit(docs: DataFrame) -> list[float]:
    """Weights from the vote counts of all documents: one aggregation whose groups are bounded by kinds and votes."""
    counted = _candidates(docs, False).groupBy("kind", *LABELERS).count().collect()
    patterns = sorted((r["kind"], tuple(r[x] for x in LABELERS), r["count"]) for r in counted)
    return train_classifier(patterns, expectation_maximisation(patterns)[2])


def pii_spans(docs: DataFrame, weights: list[float]) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and found (array of kind, start, end) of every document.

    Base spans stay; a loose one is added if the classifier gives it half or more and no base span overlaps it. Places
    are code points, ends exclusive. Null and empty texts have none. Each row is a document of its own, so repeated
    rows and null ids stay; other columns aren't read. One exchange of small rows by document row.
    """
    p = _candidates(docs, True)
    bases = sum(k.base for k in KINDS)
    base = F.col("kind").between(0, bases - 1)
    value = F.lit(weights[0])
    for k in range(len(KINDS)):
        value = value + F.when(F.col("kind") == k, weights[1 + k]).otherwise(0.0)
    for j, name in enumerate(LABELERS[1:]):
        for y in (0, 1):
            value = value + F.when(F.col(name) == y, weights[1 + len(KINDS) + 2 * j + y]).otherwise(0.0)
    up = Window.partitionBy("_row").orderBy(F.col("start"), F.col("kind")).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("_row").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("left", F.max(F.when(base, F.col("end"))).over(up)).withColumn("right", F.min(F.when(base, F.col("start"))).over(down))
    clear = (F.coalesce(F.col("left"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("right"), F.col("end")) >= F.col("end"))
    reported = base | ((F.col("kind") >= bases) & (value >= 0) & clear)
    told = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    grouped = p.groupBy("_row").agg(
        F.first("_back", ignorenulls=True).alias("_back"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k].name}") for k in range(bases)],
        F.array_sort(F.collect_list(F.when(reported, F.struct("kind", "start", "end")))).alias("found"),
    )
    strict = F.filter("found", lambda x: x["kind"] < bases)
    return grouped.select("_back.doc_id", *[f"n_{KINDS[k].name}" for k in range(bases)], F.sha2(told(strict).cast("binary"), 256).alias("base_sha256"), told(F.col("found")).alias("spans"), "found")
