"""A Merkle tree over a dataset's rows, one subtree for each language, with the authentication path of every row."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ranked

#: Levels of an aligned block: a task holds 2 ** LEVELS digests of a tree at once, whatever its size.
LEVELS = 12
#: Levels of each of the stacked subtrees of a block.
SUBTREE = 4
#: What a row's leaf is made of, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """sha256 of the fields, each "-" if null, else its UTF-8 bytes' count, ":" and the value."""
    as_text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in as_text]), 256)


def _digest(*parts: bytes) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def _height(nodes: int) -> int:
    return max(nodes - 1, 0).bit_length()


def block_root(leaves: list[bytes], height: int) -> bytes:
    """The node ``height`` levels over an aligned block's leaves; a lone node of a level is hashed by itself."""
    level = leaves
    for _ in range(height):
        level = [_digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0]


class Subtree:
    """The nodes of levels bottom to bottom + height - 1 under one node, built leaf by leaf.

    Only these nodes and a stack of one node a level are held. ``width`` is how many leaves the block has; a subtree that
    the end cuts short is closed by hashing lone nodes up.
    """

    def __init__(self, index: int, bottom: int, height: int, width: int):
        self.bottom, self.top = bottom, bottom + height
        self.next, self.end = index << self.top, min((index + 1) << self.top, width)
        self.kept: dict[tuple[int, int], bytes] = {}
        self._open: dict[int, bytes] = {}

    @property
    def whole(self) -> bool:
        return self.next >= self.end

    def grow(self, leaves: list[bytes]) -> None:
        """Takes the next leaf in and hashes what is complete by it."""
        index, level, node, last = self.next, 0, leaves[self.next], self.next + 1 == self.end
        self.next += 1
        while True:
            if self.bottom <= level < self.top:
                self.kept[level, index] = node
            if level == self.top:
                return
            if index % 2:
                node = _digest(self._open.pop(level), node)
            elif last:
                node = _digest(node)
            else:
                self._open[level] = node
                return
            index, level = index // 2, level + 1


def authentication_paths(leaves: list[bytes], height: int) -> Iterator[list[str]]:
    """For each leaf in turn the siblings up to ``height``, by fractal traversal.

    A stack of existing subtrees covers the levels of the current path; beside each, the desired subtree that follows
    it grows by one leaf a step, so it is whole when the path enters it. What is held is two subtrees a stage and their
    open nodes, not the block's tree. A sibling reads "L" or "R" (its side) and its digest, or "" where a node is alone.
    """
    width, stages = len(leaves), range(0, height, SUBTREE)
    existing = [Subtree(0, b, min(SUBTREE, height - b), width) for b in stages]
    for tree in existing:
        while not tree.whole:
            tree.grow(leaves)
    follow = lambda tree, i: Subtree(i, tree.bottom, tree.top - tree.bottom, width)
    desired = [follow(tree, 1) for tree in existing]
    for leaf in range(width):
        path = []
        for tree in existing:
            for level in range(tree.bottom, tree.top):
                node = tree.kept.get((level, (leaf >> level) ^ 1))
                path.append("" if node is None else ("L" if leaf >> level & 1 else "R") + node.decode())
        yield path
        for k, tree in enumerate(desired):
            if not tree.whole:
                tree.grow(leaves)
            if (leaf + 1) % (1 << tree.top) == 0:
                existing[k] = tree
                desired[k] = follow(tree, ((leaf + 1) >> tree.top) + 1)


def _sorted(block: pa.Table, levels: int) -> tuple[pa.Table, list[bytes], int]:
    """A block in order, its digests and how many levels it has below the next stage's node."""
    block = block.sort_by("_rank")
    total = block["_total"][0].as_py()
    return block, [d.encode() for d in block["digest"].to_pylist()], levels if total > 1 << levels else _height(total)


def _roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The next stage: a node for each aligned block of every tree."""

    def root(block: pa.Table) -> pa.Table:
        block, leaves, height = _sorted(block, levels)
        rank, total = block["_rank"][0].as_py() >> levels, -(-block["_total"][0].as_py() >> levels)
        return pa.table({"tree": block["tree"][:1], "_rank": pa.array([rank], pa.int64()), "_total": pa.array([total], pa.int64()), "digest": [block_root(leaves, height).decode()]})

    slim = nodes.select("tree", "_rank", "_total", "digest")
    return slim.groupBy("tree", F.shiftright("_rank", levels).alias("_block")).applyInArrow(root, "tree string, _rank long, _total long, digest string")


def _stages(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """nodes and the stages over them, up to one node a tree; each but the first is 2 ** levels times smaller, and cut."""
    found = [nodes]
    while True:
        found.append(cut(_roots(found[-1], levels)))
        if (found[-1].agg(F.max("_total").alias("n")).first()["n"] or 0) <= 1:
            return found


def _with_paths(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """nodes with proof, subroot and root: each block's own paths, then the proof of its node in the stage above."""
    paths = [f.name for f in above.schema if f.name in ("proof", "subroot", "root")]

    def extend(block: pa.Table, over: pa.Table) -> pa.Table:
        block, leaves, height = _sorted(block, levels)
        upper = over["proof"][0].as_py()
        for name in paths:
            if name == "proof":
                made = pa.array([p + upper for p in authentication_paths(leaves, height)], pa.list_(pa.string()))
            else:
                made = pa.array([over[name][0].as_py()] * len(leaves), pa.string())
            block = block.append_column(name, made)
        return block.drop_columns(["_block"])

    left = nodes.withColumn("_block", F.shiftright("_rank", levels)).groupBy("tree", "_block")
    right = above.select("tree", F.col("_rank").alias("_block"), *paths).groupBy("tree", "_block")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return left.cogroup(right).applyInArrow(extend, f"{fields}, " + ", ".join(f"{c} {'array<string>' if c == 'proof' else 'string'}" for c in paths))


def tree_proofs(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """rows (tree, _rank, _total, digest and others) with proof, subroot (of the row's tree) and root (over all trees' subroots by tree).

    Blocks of 2 ** levels consecutive nodes are one group each; the stages of block nodes above are distributed alike.
    A proof lists the siblings from the leaf to the root.
    """
    lower = _stages(rows, levels)
    upper = _stages(ranked(lower[-1].select(F.lit("").alias("tree"), F.col("tree").alias("_name"), "digest"), ["tree"], ["_name"]), levels)
    above = upper[-1].select("tree", "_rank", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("root"))
    for nodes in reversed(upper[:-1]):
        above = _with_paths(nodes, above, levels)
    above = above.select(F.col("_name").alias("tree"), F.lit(0).cast("long").alias("_rank"), "proof", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(lower[1:-1]):
        above = _with_paths(nodes, above, levels)
    return _with_paths(rows, cut(above), levels)


def manifest(docs: DataFrame, levels: int = LEVELS, **carry: Column) -> DataFrame:
    """doc_id, lang, leaf, subroot, root and proof of every row; ``carry`` names further columns to compute from a row.

    A null lang is a tree of its own, before the others; null doc_ids come first in theirs; rows of one doc_id follow
    by their leaves, and repeated rows have a leaf each. Null and empty texts are different leaves. A lone leaf is its
    subroot, a lone subroot the root. An empty table gives no rows. Other columns of docs don't count.
    """
    lang = F.col("lang").cast("string")
    made = {"_c_" + k: v for k, v in carry.items()}
    rows = docs.select(F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("tree"), "doc_id", lang.alias("lang"), leaf_digest([F.col(c) for c in FIELDS]).alias("digest"), *[v.alias(k) for k, v in made.items()])
    proven = tree_proofs(ranked(rows, ["tree"], ["doc_id", "digest"]), levels)
    return proven.select("doc_id", "lang", F.col("digest").alias("leaf"), "subroot", "root", "proof", *[F.col("_c_" + k).alias(k) for k in carry])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(node: Column, sibling: Column) -> Column:
        digest = F.substring(sibling, 2, 64)
        return F.sha2(F.when(sibling == "", node).when(F.substring(sibling, 1, 1) == "L", F.concat(digest, node)).otherwise(F.concat(node, digest)), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """sha256 of a proof's siblings in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.substring(x, 2, 64)), ""), 256)


def tampered_digest() -> Column:
    """The leaf of a row whose n_chars is one more where 7 divides the id's crc32; of the row as it is elsewhere."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    n_chars = F.when(hit, F.try_add(F.col("n_chars").cast("long"), F.lit(1))).otherwise(F.col("n_chars").cast("long"))
    return leaf_digest([n_chars if c == "n_chars" else F.col(c) for c in FIELDS])


def tamper_check(docs: DataFrame) -> DataFrame:
    """Digests of the manifest of docs, and for each row whether its proof still leads to the root after tampering."""
    proven = manifest(docs, tampered=tampered_digest())
    return proven.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.col("tampered"), F.col("proof")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
