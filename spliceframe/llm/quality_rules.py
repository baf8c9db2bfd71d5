"""Quality rules as one projection (operator 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Frequent short words of the four languages. Fixed values.
STOP_WORDS = (
    "the of and to in is that it for was on are as with his they at be this from have or by one had not but what all were when we there can an your which their if "
    "de la le et les des un une du en que qui dans pour pas au sur est par avec "
    "der die und das von zu mit den ist im des ein eine nicht auf für sich dem "
    "el los las y del por con una no se al como para su"
).split()
#: name, measure, least and most allowed value (None: no bound). A document is kept if all hold.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean_word_length", "word_chars / n_words", 2.0, 25.0),
    ("symbol_ratio", "n_symbols / n_words", None, 0.25),
    ("shout_ratio", "n_shouts / n_words", None, 0.3),
    ("bar_ratio", "n_bars / n_words", None, 0.1),
    ("dup_line_ratio", "n_dup_lines / n_lines", None, 0.5),
    ("stop_word_ratio", "n_stop_words / n_words", 0.02, None),
)


def measures(text: Column) -> dict[str, Column]:
    """The arrays and counts that rules draw on, by step; a later step may name columns of an earlier one."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {"_text": text, "_words": words, "_lines": lines}


def _repeat_words(n: int) -> Column:
    """Words in windows of n that stand twice or more in the text.

    Windows are hashed to 64 bits. Only a text with equal hashes sorts (hash, place), keeps the places whose
    neighbour has the same hash, and adds up what each place covers before the next one. No step compares all pairs.
    """
    return F.expr(
        f"""CASE WHEN size(array_distinct(_hashes)) = size(_hashes) THEN 0L ELSE
        aggregate(array_sort(filter(_sorted, (x, k) -> x.h = get(_sorted, k - 1).h OR x.h = get(_sorted, k + 1).h).i),
          named_struct('n', 0L, 'to', 0), (a, i) -> named_struct('n', a.n + i + {n} - greatest(i, a.to), 'to', i + {n}), a -> a.n) END"""
    )


def quality_rules(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, a pass flag for each rule, and kept.

    Null and empty texts have no words and fail the base rule. A ratio over zero counts as null and passes. Each row
    stands alone: repeated rows and null ids stay; other columns aren't read. Everything is built-in expressions in
    one stage without a shuffle, and linear in the text but for a sort of the windows of texts that repeat one.
    """
    d = docs.select("doc_id", *[c.alias(k) for k, c in measures(F.col("text")).items()])
    d = d.withColumn("_hashes", F.expr(f"CASE WHEN size(_words) >= {WINDOW} THEN transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))) ELSE array() END"))
    d = d.withColumn("_sorted", F.expr("CASE WHEN size(array_distinct(_hashes)) = size(_hashes) THEN array() ELSE array_sort(transform(_hashes, (h, i) -> named_struct('h', h, 'i', i))) END"))
    d = d.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(WINDOW).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.endswith("!!"))).cast("long").alias("n_shouts"),
        F.size(F.filter("_words", lambda w: w == "|")).cast("long").alias("n_bars"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
    )
    d = d.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    passed = {}
    for name, measure, least, most in rules:
        top, bottom = measure.split(" / ")
        value = F.expr(f"{top} / nullif({bottom}, 0)")
        tests = [value >= least] * (least is not None) + [value <= most] * (most is not None)
        ok = tests[0]
        for t in tests[1:]:
            ok = ok & t
        passed[name] = F.coalesce(ok, F.lit(True))
    every = F.lit(True)
    for ok in passed.values():
        every = every & ok
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & every).alias("kept"), *[c.alias(f"ok_{k}") for k, c in passed.items()])
