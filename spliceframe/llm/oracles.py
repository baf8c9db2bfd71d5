"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .quality_rules import RULES, STOP_WORDS, WINDOW
from .secrets import ACCESS, ASSIGN, ENDPOINT, HEX, KINDS, LOOSE, SCOPE


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def quality_rules() -> str:
    tests = {}
    for name, measure, least, most in RULES:
        top, bottom = measure.split(" / ")
        value = f"{top} / nullif({bottom}, 0)"
        tests[name] = " AND ".join([f"coalesce({value} >= {least}, true)"] * (least is not None) + [f"coalesce({value} <= {most}, true)"] * (most is not None))
    stops = ", ".join(_quote(w) for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
u AS (SELECT rid, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM w WHERE len(words) >= {WINDOW}),
p AS (SELECT rid, i, {" || ' ' || ".join(f"lead(x, {k}) OVER n" for k in range(WINDOW))} AS q FROM u WINDOW n AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, q) AS c FROM p WHERE q IS NOT NULL),
r AS (SELECT rid, i, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {WINDOW})) AS covers FROM g WHERE c > 1),
s AS (SELECT rid, CAST(sum(covers) AS BIGINT) AS n FROM r GROUP BY rid),
c AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(s.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda x: ends_with(x, '!!'))) AS n_shouts,
  len(list_filter(words, lambda x: x = '|')) AS n_bars, len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM w LEFT JOIN s USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {", ".join(f"{t} AS ok_{k}" for k, t in tests.items())} FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(f"ok_{k}" for k in tests)} AS kept, {", ".join(f"ok_{k}" for k in tests)} FROM b
"""


def secret_spans() -> str:
    good = {0: f"length(regexp_extract(m, {_quote(ASSIGN)}, 2)) >= 6", 3: "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')"}
    parts = "\nUNION ALL\n".join(
        f"SELECT rid, {k} AS kind, '{KINDS[k][0]}' AS named, unnest(regexp_extract_all(text, {_quote(p)})) AS m, unnest(string_split_regex(text, {_quote(p)})) AS gap, generate_subscripts(string_split_regex(text, {_quote(p)}), 1) AS i FROM d"
        for k, p in enumerate((ASSIGN, ACCESS, HEX, LOOSE, ENDPOINT))
    )
    near = lambda *kinds: f"bool_or(kind IN ({', '.join(map(str, kinds))})) OVER n"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({parts}),
e AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e FROM m WHERE m IS NOT NULL),
g AS (SELECT rid, kind, named, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM e WHERE CASE kind {" ".join(f"WHEN {k} THEN {t}" for k, t in good.items())} ELSE true END),
r AS (SELECT *, CASE kind WHEN 3 THEN {near(1)} WHEN 4 THEN {near(1)} AND {near(0, 2, 3)} ELSE true END AS reported FROM g
  WINDOW n AS (PARTITION BY rid ORDER BY s RANGE BETWEEN {SCOPE} PRECEDING AND {SCOPE} FOLLOWING)),
a AS (SELECT rid, count_if(kind = 0) AS n0, count_if(kind = 1) AS n1, count_if(kind = 2) AS n2,
  string_agg(concat_ws(':', named, s, e), ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(concat_ws(':', named, s, e), ',' ORDER BY s, kind) AS spans
  FROM r WHERE reported GROUP BY rid)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)
"""


def contamination() -> str:
    return r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
v AS (SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [w] ELSE list_transform(range(1, len(w) - 11), lambda i: list_slice(w, i, i + 12)) END) AS p FROM b),
p AS (SELECT DISTINCT item_id, p, len(p) AS n FROM v),
sizes AS (SELECT DISTINCT n FROM p),
s AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
o AS (SELECT rid, i, s.n, item_id FROM (SELECT rid, n, i, list_slice(w, i, i + n - 1) AS q FROM s) s JOIN p ON q = p AND s.n = p.n),
h AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT rid, i, n FROM o)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT rid, item_id FROM o) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


#: crc32's table, made by its rule from 8 halvings a byte.
_CRC_TABLE = f"(SELECT list(c ORDER BY b) FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {0xEDB88320}) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b)))"


def _crc32(text: str, table: str, hex_: str | None = None) -> str:
    """crc32 of a text's UTF-8 bytes, given the table as a column, and the bytes in hex where a column has them."""
    hex_ = hex_ or f"hex(encode({text}))"
    each = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr({hex_}, 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {each}), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)"


def tamper_check() -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda n: f"sha256({field('doc_id')} || {field('source')} || {field('lang')} || {field(n)} || {field('text')})"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {leaf("n_chars")} AS leaf,
  {leaf("(n_chars + CASE WHEN doc_id IS NOT NULL AND " + _crc32("coalesce(CAST(doc_id AS VARCHAR), '')", "t") + " % 7 = 0 THEN 1 ELSE 0 END)")} AS tampered FROM documents, (SELECT {_CRC_TABLE} AS t)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d),
nodes(tree, lvl, i, n, h) AS (SELECT tree, 0, i, n, leaf FROM leaves
  UNION ALL SELECT tree, lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 2),
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
over(lvl, i, n, h) AS (SELECT 0, i, n, h FROM tops
  UNION ALL SELECT lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM over WHERE n > 1 GROUP BY lvl, i // 2),
walk(rid, tree, lvl, i, n, f, p) AS (SELECT rid, tree, 0, i, n, tampered, '' FROM leaves
  UNION ALL SELECT w.rid, w.tree, w.lvl + 1, w.i // 2, (w.n + 1) // 2, sha256(CASE WHEN s.h IS NULL THEN f WHEN w.i % 2 = 0 THEN f || s.h ELSE s.h || f END), p || coalesce(s.h, '')
  FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1),
climb(rid, lvl, i, n, f, p, subroot) AS (SELECT rid, 0, t.i, t.n, f, p, t.h FROM walk w JOIN tops t USING (tree) WHERE w.n = 1
  UNION ALL SELECT w.rid, w.lvl + 1, w.i // 2, (w.n + 1) // 2, sha256(CASE WHEN s.h IS NULL THEN f WHEN w.i % 2 = 0 THEN f || s.h ELSE s.h || f END), p || coalesce(s.h, ''), subroot
  FROM climb w LEFT JOIN over s ON s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, o.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = o.h AS verified
FROM leaves JOIN climb c USING (rid), over o WHERE c.n = 1 AND o.n = 1
"""


def cluster_digests() -> str:
    from .centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE

    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT rid, c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{r} m USING (k) GROUP BY rid, c) GROUP BY rid)""")
        if r < ROUNDS:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT o.c, o.k, coalesce(n.x, o.x) AS x FROM c{r} o LEFT JOIN (SELECT a.c, v.k, CAST(floor(sum(v.x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS x FROM a{r} a JOIN v USING (rid) GROUP BY a.c, v.k) n USING (c, k))""")
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}),
v AS MATERIALIZED (SELECT rid, k, CAST(floor({SCALE} * CAST(embedding[k] AS DOUBLE)) AS BIGINT) AS x FROM e, range(1, {DIMENSIONS + 1}) t(k)),
f AS (SELECT rid, row_number() OVER (ORDER BY sha256('2:' || vec_id), embedding) - 1 AS c FROM e WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT c, k, x FROM f JOIN v USING (rid)),{",".join(steps)},
h AS (SELECT c, sha256(string_agg(x, ',' ORDER BY k)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN e USING (rid) JOIN h USING (c)
"""


def sharded() -> str:
    from .sharding import DIMENSIONS, ROW_BYTES, SHARDS

    place = {d: f"coalesce(CAST('0x' || substr(sha256({d}), 1, 7) AS BIGINT) + 1, 0)" if d in ("lang", "source") else f"coalesce({d}, 0)" for d in DIMENSIONS}
    steps, most = [], SHARDS
    while most > 1:
        k = len(steps)
        ratio = lambda d: f"(max(_{d}) - min(_{d})) / CAST(greatest((SELECT max(_{d}) - min(_{d}) FROM r0), 1) AS DOUBLE)"
        ratios = ", ".join(ratio(d) for d in DIMENSIONS)
        steps.append(f"""
e{k} AS MATERIALIZED (SELECT first, CAST(sum(size) AS BIGINT) AS total, list_position([{ratios}], greatest({ratios})) AS dim FROM r{k} GROUP BY first),
o{k} AS (SELECT *, CAST(sum(size) OVER (PARTITION BY first ORDER BY CASE dim {" ".join(f"WHEN {i + 1} THEN _{d}" for i, d in enumerate(DIMENSIONS))} END, _doc_id, text_crc32, size, rid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM r{k} JOIN e{k} USING (first)),
r{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (first, n, total, dim, upto, half, left_), CASE WHEN n = 1 OR left_ THEN first ELSE first + half END AS first, CASE WHEN n = 1 THEN 1 WHEN left_ THEN half ELSE n - half END AS n
  FROM (SELECT *, n // 2 AS half, (2 * upto - size) * n <= 2 * total * (n // 2) AS left_ FROM o{k}))""")
        most -= most // 2
    return f"""
WITH t AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc),
d AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
r0 AS MATERIALIZED (SELECT rid, doc_id, CAST(strlen(body) + {ROW_BYTES} AS BIGINT) AS size, {_crc32("body", "crc", "bytes")} AS text_crc32, {", ".join(f"{x} AS _{c}" for c, x in place.items())}, 0 AS first, {SHARDS} AS n FROM d, t),{",".join(steps)}
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(first AS INT) AS shard, row_number() OVER (PARTITION BY first ORDER BY doc_id NULLS FIRST, text_crc32, size, rid) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM r{len(steps)}
"""
