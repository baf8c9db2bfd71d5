"""Running folds along a coordinate in two levels, and groups along it joined over block borders: no task holds a chromosome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut

#: log2 of a block's places. Rows should be one for each place or few, so a block's rows are bounded by its places.
BITS = 18

_JOIN = {"max": F.greatest, "min": F.least, "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))}
_FOLD = {"max": F.max, "min": F.min, "sum": F.sum}


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """The names' null-safe equality, right ones prefixed with k_."""
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"k_{n}"))
    return on


def running(rows: DataFrame, key: list[str], at: str, folds: dict[str, tuple[Column, str]], backward: bool = False, inclusive: bool = True, bits: int = BITS) -> DataFrame:
    """rows with, for each name, the fold (max, min or sum) of a column over the rows of its key up to its place.

    Up to: from the least place upward, or backward from the largest down; rows of the same place count if inclusive.
    Within (key, block of places) a window folds; what comes from earlier blocks is a window over one row a block. Null
    keys are a key of their own; rows without a place get null.
    """
    named = {f"_v{i}": column for i, (column, _) in enumerate(folds.values())}
    place = F.col(at).cast("long")
    placed = rows.withColumns({"_p": -place if backward else place, **named}).withColumn("_block", F.shiftright("_p", bits))
    blocks = placed.groupBy(*key, "_block").agg(*[_FOLD[how](v).alias(v) for v, (_, how) in zip(named, folds.values())])
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*[F.col(c).alias(f"k_{c}") for c in (*key, "_block")], *[_FOLD[how](v).over(before).alias(f"_c{i}") for i, (v, (_, how)) in enumerate(zip(named, folds.values()))])
    within = Window.partitionBy(*key, "_block").orderBy("_p").rangeBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    here = placed.withColumns({f"_h{i}": _FOLD[how](v).over(within) for i, (v, (_, how)) in enumerate(zip(named, folds.values()))})
    both = here.join(carried, same(here, carried, [*key, "_block"]), "left")
    return both.select(*rows.columns, *[_JOIN[how](F.col(f"_h{i}"), F.col(f"_c{i}")).alias(name) for i, (name, (_, how)) in enumerate(folds.items())])


def _united(edges: DataFrame, key: list[str], bits: int | None) -> DataFrame:
    """key, label and root (the least label joined with it) of the labels of edges within one block."""
    block = F.lit(0).cast("long") if bits is None else F.shiftright("u", bits + 1)

    def unite(rows):
        import pandas as pd

        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for u, v in zip(rows["u"].tolist(), rows["v"].tolist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
        found = pd.DataFrame({"label": list(root), "root": [find(x) for x in root]})
        return found.assign(**{k: rows[k].iloc[0] for k in key})

    types = {f.name: f.dataType.simpleString() for f in edges.schema}
    return edges.withColumn("_block", block).groupBy(*key, "_block").applyInPandas(unite, ", ".join(["label long", "root long", *[f"`{k}` {types[k]}" for k in key]]))


def joined(edges: DataFrame, key: list[str], levels: tuple[int | None, ...] = (BITS, None)) -> DataFrame:
    """key, label and component of the labels that edges (key, u, v) join: the least label that can be reached.

    A label is twice a place, or that plus one. Edges within a block are united there; edges that cross are renamed by
    what their ends became and go on to the next level's blocks, at last to the whole key, so a group holds what is
    within a block or meets the borders of the level before. Labels without edges are left out.
    """
    found = None
    for bits in levels:
        inside = F.lit(True) if bits is None else F.shiftright("u", bits + 1) == F.shiftright("v", bits + 1)
        level = cut(_united(edges.where(inside).where("u <> v"), key, bits))
        names = level.select(*[F.col(k).alias(f"k_{k}") for k in key], F.col("label").alias("k_label"), F.col("root").alias("k_root"))
        if bits is not None:
            edges = edges.where(~inside)
            for end in ("u", "v"):
                met = edges.withColumn("label", F.col(end))
                edges = met.join(names, same(met, names, [*key, "label"]), "left").withColumn(end, F.coalesce("k_root", end)).select(*key, "u", "v")
            edges = cut(edges.distinct())
        if found is None:
            found = level
        else:
            old = found.withColumn("_l", F.col("label")).withColumn("label", F.col("root"))
            moved = old.join(names, same(old, names, [*key, "label"]), "left").select(*key, F.col("_l").alias("label"), F.coalesce("k_root", "root").alias("root"))
            held = found.select(*[F.col(c).alias(f"k_{c}") for c in (*key, "label")])
            fresh = level.join(held, same(level, held, [*key, "label"]), "left_anti")
            found = moved.unionByName(fresh.select(*key, "label", "root"))
    return found.withColumnRenamed("root", "component")
