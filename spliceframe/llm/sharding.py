"""Shards of near-equal bytes by a k-d tree over metadata, split at weighted medians that are found by counting."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ranked

#: Shards to make, and bytes that a row takes besides its text.
SHARDS, ROW_BYTES = 24, 8
#: log2 of the bins that a search for a median counts at once; the driver gets at most 2 ** BITS + 1 counts a node.
BITS = 10
#: Metadata dimensions a node may be split along.
DIMENSIONS = ("lang", "source", "n_chars", "doc_id")
#: What orders rows of one place on a dimension.
TIES = ("doc_id", "crc", "size", "row")


def category(name: str) -> Column:
    """A place from 1 for a string without an order of its own, by its hash; 0 for null."""
    text = F.col(name).cast("string")
    return F.coalesce(F.conv(F.substring(F.sha2(text, 256), 1, 7), 16, 10).cast("long") + 1, F.lit(0).cast("long"))


def number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))


def slim(docs: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of every row, its places, and a row number; cut, so the number stays the row's own."""
    text = F.col("text").cast("string")
    places = {f"_{d}": category(d) if d in ("lang", "source") else number(d) for d in DIMENSIONS}
    rows = docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), *[c.alias(k) for k, c in places.items()])
    return cut(rows.withColumns({"_crc": F.col("text_crc32"), "_size": F.col("size"), "_row": F.monotonically_increasing_id()}))


@dataclass
class Node:
    """A part of the rows that becomes ``shards`` shards from ``first`` on; with a split, what comes up to ``cut`` goes left."""

    first: int
    shards: int
    order: tuple[str, ...] = ()
    cut: tuple[int, ...] | None = None
    with_cut: bool = True
    children: list[Node] = field(default_factory=list)

    def holds(self) -> Column:
        """Whether a row with the tree's verdict so far, in _shard, is the node's."""
        return F.col("_shard").between(self.first, self.first + self.shards - 1)

    def goes_left(self) -> Column:
        """Whether a row's places come before the cut, or at it."""
        verdict = F.lit(self.with_cut)
        for name, at in reversed(list(zip(self.order, self.cut))):
            verdict = (F.col(name) < at) | ((F.col(name) == at) & verdict)
        return verdict

    def shard(self) -> Column:
        return F.when(self.goes_left(), self.children[0].shard()).otherwise(self.children[1].shard()) if self.children else F.lit(self.first)


@dataclass
class Search:
    """A node's median, narrowed: rows with the places ``fixed``, whose next one is from low to high, hold it; ``before`` bytes come first."""

    node: Node
    total: int
    order: tuple[str, ...]
    low: int
    high: int
    before: int = 0
    fixed: tuple[int, ...] = ()

    @property
    def shift(self) -> int:
        shift = 0
        while (self.high >> shift) - (self.low >> shift) > 1 << BITS:
            shift += 1
        return shift

    @property
    def place(self) -> Column:
        return F.col(self.order[len(self.fixed)])

    def active(self) -> Column:
        inside = self.node.holds() & self.place.between(self.low, self.high)
        for name, at in zip(self.order, self.fixed):
            inside = (F.col(name) == at) & inside
        return inside

    def wanted(self, weight: int) -> bool:
        """Whether weight (doubled) is within the left child's part of the total."""
        return weight * self.node.shards <= 2 * self.total * (self.node.shards // 2)

    def narrow(self, bins: list) -> bool:
        """Takes in the bins' bytes; True when the cut is known."""
        last = None
        for b in sorted(bins, key=lambda b: b["bin"]):
            if not self.wanted(2 * (self.before + b["bytes"])):
                break
            self.before += b["bytes"]
            last = b
        else:
            b = None
        if b is None or not self.wanted(2 * self.before + 1):
            # the bins up to the last one fill the left child's part
            return self._found(last["top"] if last else self.low, last is not None)
        if b["rows"] == 1:
            whole = tuple(b[f"low{i}"] for i in range(len(self.order) - len(self.fixed)))
            self.node.cut, self.node.with_cut = (*self.fixed, *whole), self.wanted(2 * self.before + b["bytes"])
            return True
        self.low, self.high = b["low0"], b["top"]
        if self.low == self.high and len(self.fixed) + 1 < len(self.order):
            self.fixed, self.low, self.high = (*self.fixed, self.low), b["low1"], b["high1"]
        return False

    def _found(self, at: int, with_it: bool) -> bool:
        self.node.order, self.node.cut, self.node.with_cut = self.order[: len(self.fixed) + 1], (*self.fixed, at), with_it
        return True


def _count(rows: DataFrame, searches: list[Search]) -> list[list]:
    """For each search the bytes of its bins, all by one pass that shuffles at most 2 ** BITS + 1 rows a search and task."""
    which = which_bin = F.lit(None)
    places = [F.lit(None).cast("long")] * (len(TIES) + 1)
    for k, s in enumerate(searches):
        ok = s.active()
        which = F.when(ok, F.lit(k)).otherwise(which)
        which_bin = F.when(ok, F.shiftright(s.place, s.shift) - F.lit(s.low >> s.shift)).otherwise(which_bin)
        for i, name in enumerate(s.order[len(s.fixed) :]):
            places[i] = F.when(ok, F.col(name)).otherwise(places[i])
    found = rows.select(which.alias("k"), which_bin.alias("bin"), "size", *[p.alias(f"p{i}") for i, p in enumerate(places)]).where("k IS NOT NULL").groupBy("k", "bin")
    least = [F.min(f"p{i}").alias(f"low{i}") for i in range(len(places))]
    counted = found.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("p0").alias("top"), F.max("p1").alias("high1"), *least).collect()
    return [[r for r in counted if r["k"] == k] for k in range(len(searches))]


def _spans(rows: DataFrame, nodes: list[Node]) -> list:
    """Bytes of each node and its extent on every dimension."""
    node = F.lit(None)
    for n in nodes:
        node = F.when(n.holds(), F.lit(n.first)).otherwise(node)
    extents = [f(f"_{d}").alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("low", F.min), ("high", F.max))]
    found = {r["node"]: r for r in rows.groupBy(node.alias("node")).agg(F.sum("size").alias("bytes"), *extents).collect()}
    return [found.get(n.first) for n in nodes]


def grow(rows: DataFrame, shards: int = SHARDS) -> Node:
    """The tree: every level's nodes are split together, each along its widest dimension at the weighted median.

    Widths are parts of the whole table's extent. A node of k shards gives its left child k // 2 of them and as much of
    its bytes: the rows whose middle byte lies there, in order of place, then doc_id, crc32, size and row. A level takes
    one pass for the extents and a few for the medians, over the slim rows; only the tree and counts reach the driver.
    """
    root, extent = Node(0, shards), None
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        dealt = rows.withColumn("_shard", root.shard())
        spans = _spans(dealt, level)
        extent = extent or spans[0]
        if extent is None:
            return root
        searches = []
        for node, span in zip(level, spans):
            if span is None:  # a node without rows splits anywhere
                node.order, node.cut = ("_row",), (0,)
                continue
            width = lambda s, d: s[f"high_{d}"] - s[f"low_{d}"]
            widest = max(DIMENSIONS, key=lambda d: (width(span, d) / max(width(extent, d), 1), -DIMENSIONS.index(d)))
            node.order = (f"_{widest}", *[f"_{t}" for t in TIES if t != widest])
            searches.append(Search(node, span["bytes"], node.order, span[f"low_{widest}"], span[f"high_{widest}"]))
        while searches:
            searches = [s for s, bins in zip(searches, _count(dealt, searches)) if not s.narrow(bins)]
        for node in level:
            node.children = [Node(node.first, node.shards // 2), Node(node.first + node.shards // 2, node.shards - node.shards // 2)]
        level = [c for n in level for c in n.children]
    return root


def shards(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    A null text counts as empty, nulls in lang and source have a place of their own, in doc_id and n_chars that of 0.
    Repeated rows and ties are told apart by a row number, so a group of equal rows of any size is split like others.
    An empty table gives no rows; with fewer rows than shards some shards are empty. Slots follow doc_id within a shard.
    Other columns don't count.
    """
    rows = slim(docs)
    placed = rows.select("doc_id", "size", "text_crc32", "_row", grow(rows, count).shard().alias("shard"))
    return ranked(placed, ["shard"], ["doc_id", "text_crc32", "size", "_row"]).select("doc_id", "size", "text_crc32", "shard", F.col("_rank").alias("slot"))


def sharded(docs: DataFrame) -> DataFrame:
    """As shards, with the law that holds (sizes near equal) and no shard after growth, as the law gives none."""
    return shards(docs).withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def write(docs: DataFrame, path: str, count: int = SHARDS) -> None:
    """docs as Parquet, a folder shard=k each. Rows meet their shard by the same expression, without a join."""
    text = F.col("text").cast("string")
    made = {f"_{d}": category(d) if d in ("lang", "source") else number(d) for d in DIMENSIONS}
    clash = [c for c in docs.columns if c in {*made, "_crc", "_size", "_row", "shard", "size"}]
    if clash:
        raise ValueError(f"rename {clash} first")
    tree = grow(slim(docs), count)
    made |= {"_crc": F.crc32(F.coalesce(text, F.lit("")).cast("binary")), "_size": (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long"), "_row": F.monotonically_increasing_id()}
    docs.withColumns(made).withColumn("shard", tree.shard()).drop(*made).write.partitionBy("shard").parquet(path)
