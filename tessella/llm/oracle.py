"""SQL for the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_ASSIGNED = "[A-Za-z0-9+/_.=-]+"
_KEYS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_PATTERNS = (
    ("assign", f"({_KEYS})" + r"""["'']?\x20*[:=]\x20*["'']?(""" + _ASSIGNED + ")"),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
)


def _matches(kind: str, rank: int, pattern: str) -> str:
    least = {"assign": f"length(regexp_extract(m, '[:=]\\x20*[\"'']?({_ASSIGNED})$', 1)) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24"}[kind]
    return f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind, b AS start, b + length(m) AS stop FROM (
      SELECT doc_id, found[i] AS m,
             list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS b
      FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS gaps FROM d)))
    WHERE {least}"""


OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_matches(k, r, p) for r, (k, p) in enumerate(_PATTERNS))}),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS k FROM p),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM h) WHERE least < doc_id),
r AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM f)),
q AS (SELECT doc_id, count(*) AS n, list(j) AS js FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE (SELECT coalesce(list(w[x] ORDER BY x), []) FROM (
         SELECT unnest(range(1, len(w) + 1)) AS x) WHERE NOT list_contains(js, x)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id)"""

_MASKS = ("1101101", "111001001", "100101011")


def _seeds(source: str, keys: str) -> str:
    parts = []
    for mask in _MASKS:
        words = ", ".join(f"w[i+{k}]" for k, bit in enumerate(mask) if bit == "1")
        parts.append(f"SELECT {keys}, i, w, {len(mask)} AS span, concat_ws(' ', '{mask}', {words}) AS seed FROM {source} WHERE i + {len(mask) - 1} <= len(w)")
    return " UNION ALL ".join(parts)


def _windows(name: str, key: str) -> str:
    return rf"""SELECT {key}, w, unnest(range(1, len(w) + 1)) AS i FROM (
      SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {name})
      WHERE len(w) >= 10"""


def _run(at) -> str:
    """The length of the best run of places whose words ``at`` gives on both sides, and its equal words."""
    one, other = at
    score = f"list_transform(range(0, 25), lambda k: 2 * len(list_filter(range(1, k + 1), lambda j: {one} = {other})) - k)"
    return f"list_position({score}, list_max({score})) - 1"


_LEFT = ("(CASE WHEN a > j THEN x[a - j] END)", "(CASE WHEN b > j THEN y[b - j] END)")
_RIGHT = ("x[a + span - 1 + j]", "y[b + span - 1 + j]")

OP10 = f"""
WITH dw AS ({_windows("documents", "doc_id")}), bw AS ({_windows("benchmark", "item_id")}),
ds AS ({_seeds("dw", "doc_id")}), bs AS ({_seeds("bw", "item_id")}),
j AS (SELECT doc_id, item_id, p.span, p.i AS a, p.w AS x, q.w AS y, q.i AS b FROM ds p JOIN bs q USING (seed)),
r AS (SELECT *, {_run(_LEFT)} AS ln, {_run(_RIGHT)} AS rn FROM j),
e AS (
  SELECT doc_id, item_id, a, a - 1 - ln AS first, a - 1 + span + rn AS stop, ln + span + rn AS compared,
         len(list_filter(range(-ln, span + rn), lambda j: x[a + j] = y[b + j])) AS equal FROM r),
g AS (SELECT doc_id, item_id, a, min(first) AS first, max(stop) AS stop, max(equal / compared) AS share
  FROM e WHERE equal >= 10 AND equal >= 0.6 * compared GROUP BY doc_id, item_id, a)
SELECT doc_id, item_id, CAST(min(first) AS BIGINT) AS first_word, CAST(max(stop) AS BIGINT) AS end_word,
       count(*) AS n_hits, max(share) AS best_share
FROM g GROUP BY doc_id, item_id"""


def _clustering(number: int = 16, rounds: int = 3) -> str:
    """Rounds of plain assignment to all centroids."""
    steps = [
        """v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
            row_number() OVER () AS r FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x AS c FROM (
          SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {number}))""",
    ]
    for k in range(rounds + 1):
        apart = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
        steps.append(f"""a{k} AS (SELECT r, vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, CAST(min(d) AS BIGINT) AS distance
          FROM (SELECT r, vec_id, x, cluster, {apart} AS d FROM v, c{k}) GROUP BY r, vec_id, x)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS (SELECT cluster, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
              SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
                SELECT cluster, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT cluster, x, unnest(range(1, 65)) AS i FROM a{k}) GROUP BY cluster, i)
              GROUP BY cluster) USING (cluster))""")
    last = f"""SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
      CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} USING (cluster)"""
    return "WITH " + ",\n".join(steps) + "\n" + last


_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i]))), lambda a, b:
  list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP13 = rf"""
WITH t AS (
  SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT conv_id, ts, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT conv_id, ts, CAST(conv_id AS VARCHAR) AS s FROM t)),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1 : CAST(h AS BIGINT)], c.ts[CAST(h AS BIGINT) + 1 :]) AS ts
  FROM c LEFT JOIN t AS b ON b.conv_id = base),
p AS (SELECT conv_id, len(ts) AS n, ts, unnest(range(0, len(ts) + 1)) AS d FROM r),
n AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
  FROM (SELECT conv_id, n, d, ts[1 : d] AS path FROM p) GROUP BY d, path),
v AS (
  SELECT n.*, u.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children,
         (n_convs - 1) * CASE WHEN n.d = 0 THEN 0 ELSE len(list_filter(string_split_regex(n.path[n.d][2], '[ 	-
]+'), lambda x: x <> '')) END AS saved
  FROM n LEFT JOIN (SELECT d, path, conv_id FROM n) AS u ON n.d = u.d + 1 AND n.path[1 : n.d - 1] = u.path
  LEFT JOIN (SELECT d - 1 AS d, path[1 : d - 1] AS path, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL) AS k ON n.d = k.d AND n.path = k.path),
a AS (SELECT path[1 : k] AS path, k AS d, saved, n_children FROM (SELECT path, saved, n_children, unnest(range(0, d + 1)) AS k FROM v)),
s AS (SELECT d, path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY d, path)
SELECT v.conv_id, v.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM v JOIN s ON v.d = s.d AND v.path = s.path"""

ORACLE = {"op3_secret_ledger": OP3, "op7_block_anchors": OP7, "op10_spaced_seed_decontamination": OP10, "op12_hadamard_centroids": _clustering(), "op13_prefix_trie": OP13}
