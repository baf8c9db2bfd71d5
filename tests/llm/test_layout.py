"""The manifest, the clusters and the shards against brute force, on odd rows and at block borders."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spliceframe.llm import centroids, merkle, sharding
from spliceframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, _rank int, digest string, shard int, size int, _row int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, f"text {k} é", ("en", "de", None)[min(k % 5, 2)], f"s{k % 3}", 10 + k) for k in range(-3, 40)]
    rows += [(None, None, None, None, None), (None, "", "", "s0", 0), (7, "same", "en", None, None), (7, "same", "en", None, None), (6, "漢字" * 50_000, "zz", "s1", 100_000), (8, "other", "en", "s1", None)]
    return spark.createDataFrame([(*r, "clash", 5, "x", 99, 98, 97) for r in rows], SCHEMA).repartition(3)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    found = []
    for level in levels[:-1]:
        found.append((i ^ 1, level[i ^ 1] if i ^ 1 < len(level) else None))
        i //= 2
    return found


def climb(node, found):
    for j, sibling in found:
        node = digest(node) if sibling is None else digest(node, sibling) if j % 2 else digest(sibling, node)
    return node


@pytest.mark.parametrize("levels", [1, 2, 5, 12])
def test_manifest_against_whole_trees(odd, levels):
    trees = defaultdict(list)
    for r in odd.collect():
        trees["" if r["lang"] is None else "=" + r["lang"]].append(r)
    for rows in trees.values():
        rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    built = {t: levels_of([leaf(r) for r in rows]) for t, rows in trees.items()}
    names = sorted(built, key=lambda t: t.encode())
    top = levels_of([built[t][-1][0] for t in names])
    want = []
    for t, rows in trees.items():
        for i, r in enumerate(rows):
            found = path(built[t], i) + path(top, names.index(t))
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = climb(leaf(r, int(hit)), found)
            want.append((r["doc_id"], leaf(r), built[t][-1][0], top[-1][0], digest(*[s or "" for _, s in found]), folded, folded == top[-1][0]))
    proven = merkle.manifest(odd, levels, tampered=merkle.tampered_digest())
    got = proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), merkle.fold(F.col("tampered"), F.col("proof")).alias("f")).withColumn("ok", F.col("f") == F.col("root")).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert 0 < sum(not w[-1] for w in want) < len(want)


def test_manifest_of_nothing_and_of_one(odd):
    assert merkle.tamper_check(odd.where("false")).count() == 0
    (one,) = merkle.tamper_check(odd.where("doc_id = 8 AND text = 'other'")).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == digest("")


def test_fractal_paths_equal_the_whole_tree():
    for n in [1, 2, 3, 16, 17, 31, 64, 255, 256, 300]:
        leaves = [digest(str(i)) for i in range(n)]
        levels = levels_of(leaves)
        for height in {len(levels) - 1, 10}:
            tall = levels + [[digest(levels[-1][0])]] if height > len(levels) - 1 else levels
            while len(tall) - 1 < height:
                tall.append([digest(tall[-1][0])])
            want = [[("" if s is None else ("R" if j % 2 else "L") + s) for j, s in path(tall, i)] for i in range(n)]
            assert list(merkle.authentication_paths([x.encode() for x in leaves], height)) == want
            assert merkle.block_root([x.encode() for x in leaves], height).decode() == tall[-1][0]


def lloyd(vectors, ids, k, rounds):
    """Plain integer k-means, in the order of the hashes of ids."""
    v = np.floor(np.asarray(vectors, np.float64) * 256).astype(np.int64)
    order = sorted((i for i in range(len(v)) if ids[i] is not None), key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), list(vectors[i])))[:k]
    c = v[order].copy()
    for r in range(rounds + 1):
        d = ((v[:, None] - c[None]) ** 2).sum(2)
        a = d.argmin(1)
        if r < rounds:
            for j in range(len(c)):
                if (a == j).any():
                    c[j] = [int(s) // int((a == j).sum()) for s in v[a == j].sum(0)]
    return a, d.min(1), c


def test_clusters_against_plain_rounds(spark):
    r = np.random.default_rng(5)
    made = r.normal(size=(12, 64)).astype(np.float32)
    vectors = [made[k % 12] + np.float32(0.3) * r.normal(size=64).astype(np.float32) for k in range(300)]
    vectors += [vectors[0]] * 60 + [np.zeros(64, np.float32), np.full(64, 3000, np.float32), np.full(64, -3000.7, np.float32)]
    ids = [k // 2 * 3 for k in range(len(vectors) - 1)] + [None]
    bad = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 63 + [None]), (5, [1.0] * 63 + [float("nan")]), (6, [float("inf")] + [0.0] * 63)]
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)] + bad
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("own"), "v": F.lit(1), "upper": F.lit(2)}).repartition(4)
    a, d, c = lloyd(vectors, ids, 40, 5)
    got = centroids.cluster_digests(df).collect()
    per = {j: int(d[a == j].sum()) for j in range(len(c))}
    text = {j: hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest() for j in range(len(c))}
    key = lambda x: tuple(str(y) for y in x)
    assert sorted([(x["vec_id"], x["cluster"], x["distance"], x["cluster_inertia"], x["inertia"], x["centroid_sha256"]) for x in got], key=key) == sorted([(i, int(j), int(s), per[j], int(d.sum()), text[j]) for i, j, s in zip(ids, a, d)], key=key)
    assert centroids.clusters(df.where("false")).count() == 0
    few = centroids.clusters(df.where("vec_id < 9")).collect()
    assert max(x["cluster"] for x in few) < len(few) == 6 and all(x["distance"] >= 0 for x in few)


def test_bounds_prune_and_keep_ties():
    r = np.random.default_rng(1)
    v = (r.integers(0, 8, size=(40, 64))[r.integers(0, 40, 2000)] * 100 + r.integers(-3, 4, size=(2000, 64))).astype(np.int64)
    c = v[r.choice(2000, 30, replace=False)].copy()
    c[7] = c[3]
    b = centroids.Bounds.first(v, c)
    whole, skipped = b.computed, 0
    for _ in range(6):
        new = c + r.integers(-4, 5, size=c.shape)
        new[7] = new[3]
        b.move(centroids.above(np.sqrt(centroids.squared(new, c).astype(float))).astype(float))
        c, b.computed = new, 0
        b.assign(c)
        assert (b.cluster == ((v[:, None] - c[None]) ** 2).sum(2).argmin(1)).all()
        skipped += b.computed < whole / 2
    assert skipped == 6
    assert (centroids.squared_all(v * 50_000, c * 50_000) == ((v[:, None] - c[None]) ** 2).sum(2) * 50_000**2).all()


def halves(rows, first, shards, extent):
    """row number -> shard, by sorting each node whole."""
    if shards == 1 or not rows:
        return {r["_row"]: first for r in rows}
    width = lambda d: max(r["_" + d] for r in rows) - min(r["_" + d] for r in rows)
    extent = extent or {d: max(width(d), 1) for d in sharding.DIMENSIONS}
    by = max(sharding.DIMENSIONS, key=lambda d: (width(d) / extent[d], -sharding.DIMENSIONS.index(d)))
    rows = sorted(rows, key=lambda r: (r["_" + by], r["_doc_id"], r["_crc"], r["_size"], r["_row"]))
    total, upto, left = sum(r["size"] for r in rows), 0, 0
    for r in rows:
        upto += r["size"]
        left += (2 * upto - r["size"]) * shards <= 2 * total * (shards // 2)
    return halves(rows[:left], first, shards // 2, extent) | halves(rows[left:], first + shards // 2, shards - shards // 2, extent)


@pytest.mark.parametrize("count", [1, 2, 5, 24])
def test_shards_against_sorting(spark, odd, count):
    copies = odd.where("doc_id = 7").crossJoin(spark.range(150)).drop("id")
    rows = sharding.slim(odd.unionByName(copies)).cache()
    tree = sharding.grow(rows, count)
    got = {r["_row"]: r["s"] for r in rows.select("_row", tree.shard().alias("s")).collect()}
    assert got == halves(rows.collect(), 0, count, None)


def test_shards_are_near_equal_and_slots_gapless(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    got = sharding.sharded(docs).collect()
    texts = sorted((-1 if r["doc_id"] is None else r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append((r["slot"], r["size"]))
    largest = max(s for _, s in sum(slots.values(), []))
    total = sum(s for _, s in sum(slots.values(), []))
    for held in slots.values():
        assert sorted(k for k, _ in held) == list(range(len(held)))
        assert abs(sum(s for _, s in held) - total / 24) <= 2 * largest
    assert sharding.shards(docs.where("false")).count() == 0


def test_shard_folders_hold_every_row(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write(docs, str(tmp_path / "shards"), 6)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.drop("shard").exceptAll(docs.select(*back.drop("shard").columns)).count() == 0 and back.count() == docs.count()
    assert back.select("shard").distinct().count() == 6


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_centroid_clusters", "op13_sharding"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()))) == sorted(map(str, con.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()))
